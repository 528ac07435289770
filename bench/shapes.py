"""The obvious shape of an operator against the one used here, on the same rows.

Run as ``python bench/shapes.py``; prints one JSON line per pair.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from catalogue.base import table  # noqa: E402
from catalogue.drops import cleaned_lake  # noqa: E402
from snapfold import operators as O  # noqa: E402
from snapfold.functions import column  # noqa: E402
from snapfold.plans import constants as K  # noqa: E402
from snapfold.session import local_session, scratch_dir  # noqa: E402


def seconds(make) -> float:
    def once() -> float:
        started = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    once()
    return round(statistics.median(once() for _ in range(3)), 2)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    lake = cleaned_lake(spark, sf)
    registered = lake.scan("silver", "silver_registrations")
    people = lake.scan("silver", "silver_players")
    keep = [c for c in registered.columns if not c.startswith("Player")]

    def unpivot(slots):
        return O.unpivot_blocks(registered, slots, K.PLAYER_ATTRIBUTES, keep, "PlayerSlot", "PlayerSurname")

    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    flags = {"A": "a", "N": "n", "R": "r"}

    # All invoice rows in one file: the hot-file case.
    folder = scratch_dir(spark, "one-file")
    lake.ingested("bronze_registration_invoices").withColumns(
        {"_row_seq": F.monotonically_increasing_id(), "_source_file": F.lit("one")}
    ).write.parquet(folder)
    one_file = spark.read.parquet(folder)
    parent = column("Reference").isNotNull()

    def fill(bucket):
        return O.forward_fill(
            one_file, ["_source_file"], ["_row_seq"], K.INVOICE_HEADER, restart=parent, bucket=bucket
        )

    grain = people.select("player_id", "Season").distinct()
    debts = lake.ingested("bronze_players_debts")
    pairs = {
        "unpivot: one select per slot, united | inline": (
            lambda: reduce(lambda a, b: a.unionByName(b), [unpivot([n]) for n in K.PLAYER_SLOTS]),
            lambda: unpivot(K.PLAYER_SLOTS),
        ),
        "bucket sums: pivot | conditional sums": (
            lambda: lines.groupBy("l_orderkey").pivot("l_returnflag", list(flags)).agg(F.sum("l_quantity")),
            lambda: O.pivot_sum(lines, ["l_orderkey"], "l_returnflag", flags, "l_quantity"),
        ),
        "forward fill of one large file: one window | in buckets": (
            lambda: fill(None),
            lambda: fill([O.row_bucket("_row_seq")]),
        ),
        "latest: distinct then window | window": (
            lambda: O.latest_by_key(debts.dropDuplicates(["InvoiceRef"]), ["InvoiceRef"], ["_source_file"], ["_row_seq"]),
            lambda: O.latest_by_key(debts, ["InvoiceRef"], ["_source_file"], ["_row_seq"]),
        ),
        "renewal flag: self-join | window": (
            lambda: O.prior_period_flag(grain, "player_id", "Season", "renewed"),
            lambda: O.prior_period_flag_unique(grain, "player_id", "Season", "renewed"),
        ),
    }
    for name, (plain, ours) in pairs.items():
        print(json.dumps({"pair": name, "plain": seconds(plain), "here": seconds(ours)}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
