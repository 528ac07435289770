"""Collections that take in only what changed.

A new ingest batch replaces the debts it holds newer versions of; only the buckets they lie in are
rewritten.  What the totals gain is the new rows less those they replaced, so neither the
unchanged debts nor the unchanged totals are read.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.functions import days_since, safe_ratio
from snapfold.operators import keep_passing
from snapfold.plans import constants as K
from snapfold.plans.debts import debts
from snapfold.plans.star import COLLECTION_EVENTS, COLLECTION_KEYS, COLLECTION_TOTALS
from snapfold.sources import FILE_ORDER, KeyedTable, Lake, fold_totals, retraction
from snapfold.sources.tables import exists

BRONZE = "bronze_players_debts"
#: Days are part of the totals' key: a latest day cannot be taken back, a count by day can.
DAYS = ("last_payment_date", "last_credit_date")
KEYS = (*COLLECTION_KEYS, *DAYS)
SUMS = (*COLLECTION_TOTALS, *COLLECTION_EVENTS)
COUNT = "invoice_count"
STATE = "state string, since long"


class Collections:
    """The debts of a lake by invoice and their totals by player, team, season and day, kept by changes."""

    def __init__(self, lake: Lake, buckets: int = 64):
        self.lake = lake
        self.debts = KeyedTable(lake.spark, lake.path("silver", "debts_by_invoice"), ("InvoiceRef", "Season", "_own"), buckets)
        self.totals = KeyedTable(lake.spark, lake.path("gold", "collection_totals"), KEYS, buckets)

    def take_in(self) -> None:
        """Bring in the batches ingested since the last call; after a reload under a new run, all rows afresh.

        May be repeated after a failure: debts take in a row twice like once, and totals that do not
        belong to the debts as they are get added up from all of them.
        """
        state = self._state()
        batches = self.lake.ingested_batches(BRONZE)
        runs = {str(s): self.lake.shown_run(BRONZE, s) for s in batches}
        again = state is None or any(state["runs"].get(s, run) != run for s, run in runs.items())
        taken = {} if again else {s: state["batches"][str(s)] for s in batches if str(s) in state["batches"]}
        whole = again or state["debts"] != _newest(self.debts) or state["totals"] != _newest(self.totals)
        if taken == batches and not whole:
            return

        new = debts(self.lake.ingested(BRONZE, after=taken))
        own = F.when(F.col("InvoiceRef").isNull(), F.concat_ws("|", "_source_file", *FILE_ORDER))
        new = new.withColumn("_own", own)
        ties = ["_source_file", *FILE_ORDER]
        if again:
            self.debts.replace(new)
            change = None
        else:
            change = self.debts.upsert(new, ["snapshot_ts"], ties)
        if whole:
            everything = self.debts.read()
            parts = _parts(everything)
            self.totals.replace(
                parts.groupBy(*KEYS).agg(*[F.sum(s).alias(s) for s in SUMS], F.count(F.lit(1)).alias(COUNT))
            )
        else:
            gained = retraction(type(change)(_parts(change.before), _parts(change.after)), KEYS, SUMS, COUNT)
            self.totals.update(gained, fold_totals(KEYS, SUMS, COUNT))
        self._note(
            {"batches": {str(s): b for s, b in batches.items()}, "runs": runs, "debts": _newest(self.debts), "totals": _newest(self.totals)}
        )

    def fact(self, as_of: dt.date | str | None = None) -> DataFrame:
        """``fact_collections`` from the totals; amounts that are no number add nothing."""
        grouped = (
            self.totals.read()
            .groupBy(*COLLECTION_KEYS)
            .agg(
                F.sum(COUNT).alias(COUNT),
                *[F.sum(s).cast("double").alias(s) for s in COLLECTION_TOTALS],
                *[F.sum(s).cast("long").alias(s) for s in COLLECTION_EVENTS],
                *[F.max(d).alias(d) for d in DAYS],
            )
        )
        return grouped.withColumns(
            {
                "days_since_last_payment": days_since(F.col("last_payment_date"), as_of),
                "player_collection_rate": safe_ratio(F.col("total_paid"), F.col("total_billed")),
                "is_in_arrears": F.col("total_outstanding") > 0,
            }
        )

    def _state(self) -> dict | None:
        path = self.lake.path("gold", "collection_state")
        if not exists(self.lake.spark, path):
            return None
        newest = self.lake.spark.read.schema(STATE).parquet(path).agg(F.max_by("state", "since")).first()[0]
        return json.loads(newest)

    def _note(self, state: dict) -> None:
        row = self.lake.spark.createDataFrame([(json.dumps(state), dt.datetime.now(dt.UTC).timestamp() * 1e6)], "state string, since double")
        row.select("state", F.col("since").cast("long")).coalesce(1).write.mode("append").parquet(self.lake.path("gold", "collection_state"))


def _newest(table: KeyedTable) -> int:
    return max(table.versions().values(), default=0)


def _parts(rows: DataFrame) -> DataFrame:
    """What each debt that passes the rules adds: amounts as decimals, which can be taken away exactly."""
    names = {"player_surname": "PlayerSurname", "player_first_name": "PlayerFirstName", "team_name": "TeamName", "season": "Season"}
    return keep_passing(rows, K.DEBT_RULES).select(
        *[F.col(names[k]).alias(k) for k in COLLECTION_KEYS],
        F.col("LastPaymentDate").alias(DAYS[0]),
        F.col("LastCreditDate").alias(DAYS[1]),
        *[F.col(source).try_cast("decimal(38,4)").alias(total) for total, source in COLLECTION_TOTALS.items()],
        *[F.col(source).cast("decimal(38,4)").alias(total) for total, source in COLLECTION_EVENTS.items()],
    )
