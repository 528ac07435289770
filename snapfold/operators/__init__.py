"""DataFrame operators."""

from snapfold.operators.cohorts import (
    dim_scd1,
    membership_rollup,
    prior_period_flag,
    prior_period_flag_unique,
    roster_counts,
)
from snapfold.operators.conform import (
    conform_union,
    drop_present,
    ensure_columns,
    null_if_denied,
    rename_present,
    rename_slots,
    stamp,
)
from snapfold.operators.dedup import distinct_by, latest_by_key, latest_snapshot_rows
from snapfold.operators.hierarchy import forward_fill, group_id, row_bucket, row_kind, split_ghosts
from snapfold.operators.periods import Periods
from snapfold.operators.quality import DROP, WARN, Checked, Rule, check, finite, keep_passing, observed
from snapfold.operators.reshape import pivot_sum, unpivot_blocks
from snapfold.operators.scanned import fill_scanned
from snapfold.operators.sketches import distinct_sketches, merged_distinct

__all__ = [
    "Checked",
    "DROP",
    "Periods",
    "Rule",
    "WARN",
    "check",
    "conform_union",
    "dim_scd1",
    "distinct_by",
    "distinct_sketches",
    "drop_present",
    "ensure_columns",
    "fill_scanned",
    "finite",
    "forward_fill",
    "group_id",
    "keep_passing",
    "latest_by_key",
    "latest_snapshot_rows",
    "membership_rollup",
    "merged_distinct",
    "null_if_denied",
    "observed",
    "pivot_sum",
    "prior_period_flag",
    "prior_period_flag_unique",
    "rename_present",
    "rename_slots",
    "roster_counts",
    "row_bucket",
    "row_kind",
    "split_ghosts",
    "stamp",
    "unpivot_blocks",
]
