"""What a file name says about its content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The naming convention of the exports,
# ``<Entity>_<yyyy>Season<free text>_<yyyyMMddHHmmss>.csv``.
SNAPSHOT_PATTERN = r"_(\d{14})\.csv$"
SNAPSHOT_FORMAT = "yyyyMMddHHmmss"
SEASON_PATTERN = r"_(\d{4})Season"


def snapshot_ts(path: Column) -> Column:
    """Export time in the file name; NULL when the name carries none."""
    return F.try_to_timestamp(F.regexp_extract(path, SNAPSHOT_PATTERN, 1), F.lit(SNAPSHOT_FORMAT))


def season_from_name(path: Column) -> Column:
    """Season in the file name; NULL when the name carries none."""
    return F.regexp_extract(path, SEASON_PATTERN, 1).try_cast("int")
