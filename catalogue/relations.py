"""Grouping, windows, joins and set operations on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import query, table
from snapfold import functions as S
from snapfold import operators as O


def _orders(spark, sf):
    return table(spark, sf, "orders").withColumn("season", F.year("o_orderdate"))


@query(
    "h1_group_totals",
    """SELECT o_custkey, year(o_orderdate)::INT AS season, o_orderstatus, count(*) AS orders,
        sum(o_totalprice::DECIMAL(18, 2))::DOUBLE AS billed,
        sum(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice::DECIMAL(18, 2) END)::DOUBLE AS owed,
        max(o_orderdate)::DATE AS last_order,
        sum(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice::DECIMAL(18, 2) END) > 0 AS in_arrears
    FROM orders GROUP BY ALL""",
)
def group_totals(spark, sf):
    cents = S.to_cents(F.col("o_totalprice"))
    grouped = _orders(spark, sf).groupBy("o_custkey", "season", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"),
        S.from_cents(F.sum(cents)).alias("billed"),
        S.from_cents(F.sum(F.when(F.col("o_orderstatus") == "F", 0).otherwise(cents))).alias("owed"),
        F.max("o_orderdate").cast("date").alias("last_order"),
    )
    return grouped.withColumn("in_arrears", F.col("owed") > 0)


# Amounts as exports have them: sub-cent, far beyond any decimal, infinite, not a number.
ANY_AMOUNT = """CASE WHEN o_orderkey % 53 = 0 THEN 'NaN' WHEN o_orderkey % 37 = 0 THEN 'Infinity'
    WHEN o_orderkey % 29 = 0 THEN '1180591620717411303424' WHEN o_orderkey % 7 = 0 THEN '0.3333' ELSE CAST(o_totalprice AS string) END"""


@query(
    "h1_any_amount",
    f"""SELECT o_custkey, year(o_orderdate)::INT AS season, bool_or(o_orderkey % 53 = 0) AS not_a_number,
        bool_or(o_orderkey % 37 = 0) AND NOT bool_or(o_orderkey % 53 = 0) AS infinite,
        CASE WHEN bool_or(o_orderkey % 37 = 0 OR o_orderkey % 53 = 0) THEN NULL ELSE count(*) FILTER (o_orderkey % 29 = 0) END AS huge,
        CASE WHEN NOT bool_or(o_orderkey % 53 = 0 OR o_orderkey % 37 = 0 OR o_orderkey % 29 = 0)
            THEN sum(CASE WHEN o_orderkey % 7 = 0 THEN 0.3333 ELSE o_totalprice::DECIMAL(18, 4) END)::DOUBLE END AS billed,
        count(*) FILTER (o_orderkey % 53 = 0 OR o_orderkey % 37 = 0) AS failed_rule
    FROM orders GROUP BY ALL""",
)
def any_amount(spark, sf):
    """No cell fails a total: exact where amounts are, else what doubles make of it; the rule counts what is no amount."""
    typed = _orders(spark, sf).select("o_custkey", "season", S.safe_cast(F.expr(ANY_AMOUNT), "double").alias("amount"))
    total = S.exact_sum(F.col("amount"))
    grouped = typed.groupBy("o_custkey", "season").agg(total.alias("total"), F.count_if(~F.expr(O.finite("amount"))).alias("failed_rule"))
    infinite = F.col("total") == F.lit(float("inf"))
    usual = F.col("total") < 1e15
    return grouped.select(
        "o_custkey",
        "season",
        F.isnan("total").alias("not_a_number"),
        infinite.alias("infinite"),
        F.when(~F.isnan("total") & ~infinite, F.floor(F.col("total") / F.lit(2.0**70))).alias("huge"),
        F.when(usual, F.col("total")).alias("billed"),
        "failed_rule",
    )


@query(
    "h2_conditional_counts",
    """SELECT year(o_orderdate)::INT AS season, count(*) FILTER (o_orderstatus = 'O') AS open,
        count(*) FILTER (o_totalprice > 100000) AS large FROM orders GROUP BY 1""",
)
def conditional_counts(spark, sf):
    return _orders(spark, sf).groupBy("season").agg(
        F.count_if(F.col("o_orderstatus") == "O").alias("open"),
        F.count_if(F.col("o_totalprice") > 100000).alias("large"),
    )


@query(
    "h3_two_distinct_counts",
    """SELECT year(o_orderdate)::INT AS season, count(DISTINCT o_custkey) AS customers,
        count(DISTINCT o_orderdate) AS days FROM orders GROUP BY 1""",
)
def two_distinct_counts(spark, sf):
    return _orders(spark, sf).groupBy("season").agg(
        F.count_distinct("o_custkey").alias("customers"), F.count_distinct("o_orderdate").alias("days")
    )


@query(
    "h4_membership",
    """SELECT o_custkey, array_to_string(list_sort(list(DISTINCT year(o_orderdate))), ',') AS seasons,
        min(year(o_orderdate))::INT AS first_season, max(year(o_orderdate))::INT AS last_season, count(*) AS orders
    FROM orders GROUP BY 1""",
)
def membership(spark, sf):
    rolled = O.membership_rollup(
        _orders(spark, sf), "o_custkey", "season", ("seasons", "first_season", "last_season", "orders")
    )
    return rolled.withColumn("seasons", F.array_join(F.col("seasons").cast("array<string>"), ","))


@query(
    "h5_pivot_sums",
    """SELECT l_orderkey, coalesce(sum(l_quantity) FILTER (l_returnflag = 'A'), 0) AS accepted,
        coalesce(sum(l_quantity) FILTER (l_returnflag = 'N'), 0) AS new,
        coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0) AS returned
    FROM lineitem GROUP BY 1""",
)
def pivot_sums(spark, sf):
    return O.pivot_sum(
        table(spark, sf, "lineitem"),
        ["l_orderkey"],
        "l_returnflag",
        {"A": "accepted", "N": "new", "R": "returned"},
        "l_quantity",
    )


@query(
    "i1_latest_per_key",
    """SELECT 'customer' AS kind, o_custkey AS key, o_orderkey AS newest FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1
    UNION ALL SELECT 'user', user_id, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""",
)
def latest_per_key(spark, sf):
    orders = O.latest_by_key(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate"], ["o_orderkey"])
    events = O.latest_by_key(table(spark, sf, "events"), ["user_id"], ["ts"], ["event_id"])
    return orders.select(
        F.lit("customer").alias("kind"), F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("newest")
    ).unionByName(
        events.select(F.lit("user").alias("kind"), F.col("user_id").alias("key"), F.col("event_id").alias("newest"))
    )


@query(
    "i1_newest_batch_per_key",
    """SELECT o_orderkey, o_custkey FROM orders
    JOIN (SELECT o_custkey, max(year(o_orderdate)) AS newest FROM orders GROUP BY 1) USING (o_custkey)
    WHERE year(o_orderdate) = newest""",
)
def newest_batch_per_key(spark, sf):
    return O.latest_snapshot_rows(_orders(spark, sf), ["o_custkey"], "season").select("o_orderkey", "o_custkey")


@query(
    "i2_running_group",
    """SELECT conv_id, turn, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END)
        OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS grp FROM conversations""",
)
def running_group(spark, sf):
    return O.group_id(
        table(spark, sf, "conversations").select("conv_id", "turn", "role"),
        ["conv_id"],
        ["turn"],
        F.col("role") == "user",
        "grp",
        bucket=[O.row_bucket("turn", 1_000)],
    ).drop("role")


FILLED = """SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
        OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS value FROM events"""


def _purchases(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("value")
    )


@query("i3_forward_fill", FILLED)
def forward_fill(spark, sf):
    """Work is split by user and day, so a user with a third of all events is many tasks."""
    filled = O.forward_fill(
        _purchases(spark, sf), ["user_id"], ["ts", "event_id"], ["value"], bucket=[F.to_date("ts")]
    )
    return filled.select("event_id", "value")


@query("i3_forward_fill_in_buckets", FILLED)
def forward_fill_in_buckets(spark, sf):
    """The same with finer pieces, by hour."""
    filled = O.forward_fill(
        _purchases(spark, sf),
        ["user_id"],
        ["ts", "event_id"],
        ["value"],
        bucket=[F.date_trunc("hour", "ts")],
    )
    return filled.select("event_id", "value")


@query(
    "i3_forward_fill_with_restart",
    """SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
        OVER (PARTITION BY user_id, visit ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS value
    FROM (SELECT *, sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS visit FROM events)""",
)
def forward_fill_with_restart(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id",
        "user_id",
        "ts",
        "event_type",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("value"),
    )
    filled = O.forward_fill(
        events,
        ["user_id"],
        ["ts", "event_id"],
        ["value"],
        restart=F.col("event_type") == "view",
        bucket=[F.date_trunc("hour", "ts")],
    )
    return filled.select("event_id", "value")


@query("j1_distinct_keys", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_keys(spark, sf):
    return O.distinct_by(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"])


@query(
    "k2_prior_period",
    """SELECT o_orderkey, year(o_orderdate)::INT AS season, EXISTS (SELECT 1 FROM orders p
        WHERE p.o_custkey = o.o_custkey AND year(p.o_orderdate) = year(o.o_orderdate) - 1) AS renewed
    FROM orders o""",
)
def prior_period(spark, sf):
    flagged = O.prior_period_flag(
        _orders(spark, sf).select("o_orderkey", "o_custkey", "season"), "o_custkey", "season", "renewed"
    )
    return flagged.select("o_orderkey", "season", "renewed")


@query(
    "k3_full_outer",
    """SELECT month, orders, lines FROM
        (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders FROM orders GROUP BY 1)
    FULL JOIN (SELECT strftime(l_shipdate + INTERVAL 2 MONTH, '%Y-%m') AS month, count(*) AS lines FROM lineitem GROUP BY 1)
    USING (month)""",
)
def full_outer(spark, sf):
    orders = table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    lines = table(spark, sf, "lineitem").groupBy(
        F.date_format(F.add_months("l_shipdate", 2), "yyyy-MM").alias("month")
    )
    return orders.agg(F.count(F.lit(1)).alias("orders")).join(
        lines.agg(F.count(F.lit(1)).alias("lines")), "month", "outer"
    )


@query(
    "l1_conforming_union",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance, NULL::VARCHAR AS note FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal, NULL FROM supplier
    UNION ALL SELECT n_nationkey, n_name, NULL, NULL, NULL FROM nation""",
)
def conforming_union(spark, sf):
    customers = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")
    suppliers = table(spark, sf, "supplier").selectExpr("s_acctbal AS balance", "s_name AS name", "s_suppkey AS id")
    nations = table(spark, sf, "nation").selectExpr("CAST(n_nationkey AS bigint) AS id", "n_name AS name")
    return O.ensure_columns(O.conform_union([customers, suppliers, nations]), {"note": "string", "id": "long"})


@query(
    "n1_unpivot_slots",
    """SELECT id, slot, surname, amount FROM (
        SELECT l_orderkey AS id, 1 AS slot, l_returnflag AS surname, l_quantity AS amount, NULL AS x FROM lineitem
        UNION ALL SELECT l_orderkey, 2, l_linestatus, l_tax, NULL FROM lineitem WHERE l_linestatus <> 'F'
        UNION ALL SELECT l_orderkey, 3, 'z', NULL, NULL FROM lineitem WHERE l_linenumber > 2)""",
)
def unpivot_slots(spark, sf):
    wide = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS id",
        "l_returnflag AS P1Surname",
        "l_quantity AS P1Amount",
        "CASE WHEN l_linestatus = 'F' THEN '' ELSE l_linestatus END AS P2Surname",
        "l_tax AS P2Amount",
        "CASE WHEN l_linenumber > 2 THEN 'z' END AS P3Surname",
    )
    return O.unpivot_blocks(
        wide,
        (1, 2, 3),
        {"surname": ("P{n}Surname", "string"), "amount": ("P{n}Amount", "double")},
        keep=["id"],
        slot_name="slot",
        required="surname",
    )


@query(
    "p6_season_summary",
    """WITH invoice AS (
        SELECT o_orderkey, year(o_orderdate)::INT AS season, sum(l_extendedprice::DECIMAL(18, 2)) AS amount,
            coalesce(sum(l_extendedprice::DECIMAL(18, 2)) FILTER (l_returnflag = 'A'), 0) AS a,
            coalesce(sum(l_extendedprice::DECIMAL(18, 2)) FILTER (l_returnflag = 'N'), 0) AS n,
            coalesce(sum(l_extendedprice::DECIMAL(18, 2)) FILTER (l_returnflag = 'R'), 0) AS r
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2),
    paid AS (SELECT *, amount * CASE o_orderkey % 4 WHEN 0 THEN 0.0 WHEN 1 THEN 0.5 WHEN 2 THEN 1.0 ELSE 1.1 END AS paid FROM invoice),
    status AS (SELECT *, CASE WHEN amount - paid <= 0 THEN CASE WHEN paid > amount THEN 'Overpaid' ELSE 'Paid' END
        WHEN paid > 0 THEN 'Partial' ELSE 'Outstanding' END AS status FROM paid),
    fin AS (SELECT season, count(*) AS invoice_count, sum(amount)::DOUBLE AS total_billed, round(sum(paid), 2)::DOUBLE AS total_collected,
        round(sum(amount - paid), 2)::DOUBLE AS total_outstanding, sum(a)::DOUBLE AS accepted_total, sum(n)::DOUBLE AS new_total,
        sum(r)::DOUBLE AS returned_total, count(*) FILTER (status = 'Outstanding') AS outstanding_invoices,
        CASE WHEN sum(amount) > 0 THEN round(sum(paid)::DOUBLE / sum(amount)::DOUBLE, 6) ELSE 0.0 END AS collection_rate
        FROM status GROUP BY 1),
    seen AS (SELECT DISTINCT o_custkey, year(o_orderdate)::INT AS season FROM orders),
    reg AS (SELECT season, count(*) AS distinct_players,
        count(*) FILTER (EXISTS (SELECT 1 FROM seen p WHERE p.o_custkey = s.o_custkey AND p.season = s.season - 1)) AS renewed_players
        FROM seen s GROUP BY 1)
    SELECT *, CASE WHEN distinct_players > 0 THEN round(renewed_players / distinct_players, 6) ELSE 0.0 END AS renewal_rate
    FROM fin FULL JOIN reg USING (season) ORDER BY season""",
)
def season_summary(spark, sf):
    """Season KPIs: orders as invoices, their lines as fees, customers as players."""
    fees = {"A": "accepted", "N": "new", "R": "returned"}
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_returnflag", S.to_cents(F.col("l_extendedprice")).alias("cents")
    )
    # Fees are summed per order before the join, so the lines are shuffled once.
    invoices = O.pivot_sum(lines, ["l_orderkey"], "l_returnflag", fees, "cents", fill=0)
    orders = _orders(spark, sf)
    # Amounts are whole cents and payments whole tenths of a cent: sums are exact.
    billed = F.col("billed")
    tenths = F.expr("billed * CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 5 WHEN 2 THEN 10 ELSE 11 END")
    money = (
        orders.select("o_orderkey", "season")
        .join(invoices, F.col("o_orderkey") == F.col("l_orderkey"))
        .withColumn("billed", S.row_sum([F.col(f) for f in fees.values()]))
        .withColumn("paid", tenths)
        .withColumn("owed", billed * 10 - F.col("paid"))
        .withColumn("status", S.payment_status(billed * 10, F.col("paid"), F.col("owed")))
    )
    sums = {"accepted": "accepted", "new": "new", "returned": "returned", "billed": "billed", "paid": "paid", "owed": "owed"}
    finances = money.groupBy("season").agg(
        F.count(F.lit(1)).alias("invoice_count"),
        *[F.sum(c).alias(c) for c in sums],
        F.count_if(F.col("status") == "Outstanding").alias("outstanding_invoices"),
    )

    def tenths_to_amount(c):
        return F.round(F.col(c).cast("decimal(38,3)") / 1000, 2).cast("double")

    financial = finances.select(
        "season",
        "invoice_count",
        S.from_cents(F.col("billed")).alias("total_billed"),
        tenths_to_amount("paid").alias("total_collected"),
        tenths_to_amount("owed").alias("total_outstanding"),
        *[S.from_cents(F.col(f)).alias(f"{f}_total") for f in fees.values()],
        "outstanding_invoices",
        F.round(S.safe_ratio(F.col("paid") / 1000, F.col("billed") / 100), 6).alias("collection_rate"),
    )
    players = O.distinct_by(orders, ["o_custkey", "season"])
    membership = (
        O.prior_period_flag_unique(players, "o_custkey", "season", "renewed")
        .groupBy("season")
        .agg(
            F.count(F.lit(1)).alias("distinct_players"),
            F.count_if("renewed").alias("renewed_players"),
        )
        .withColumn(
            "renewal_rate", F.round(S.safe_ratio(F.col("renewed_players"), F.col("distinct_players")), 6)
        )
    )
    return financial.join(membership, "season", "outer").orderBy("season")
