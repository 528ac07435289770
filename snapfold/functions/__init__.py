"""Column helpers; none of them builds a Column at import time."""

from snapfold.functions.casting import CastSpec, cast_all, safe_cast
from snapfold.functions.classify import band, first_match, payment_status
from snapfold.functions.keys import fallback_key, hash_key
from snapfold.functions.measures import (
    as_of_date,
    days_since,
    exact_row_sum,
    exact_sum,
    from_cents,
    next_period,
    row_sum,
    safe_ratio,
    to_cents,
    years_between,
)
from snapfold.functions.names import season_from_name, snapshot_ts
from snapfold.functions.nulls import (
    false_if_null,
    fill_defaults,
    null_if_listed,
    replace_sentinel,
    text_or,
    yes_no,
    zero_fill,
)
from snapfold.functions.text import (
    clean_columns,
    column,
    has_text,
    split_first,
    split_last,
    text_clean,
)

__all__ = [
    "CastSpec",
    "as_of_date",
    "band",
    "cast_all",
    "clean_columns",
    "column",
    "days_since",
    "exact_row_sum",
    "exact_sum",
    "fallback_key",
    "false_if_null",
    "fill_defaults",
    "first_match",
    "from_cents",
    "has_text",
    "hash_key",
    "next_period",
    "null_if_listed",
    "payment_status",
    "replace_sentinel",
    "row_sum",
    "safe_cast",
    "safe_ratio",
    "season_from_name",
    "snapshot_ts",
    "split_first",
    "split_last",
    "text_clean",
    "text_or",
    "to_cents",
    "years_between",
    "yes_no",
    "zero_fill",
]
