"""Column helpers: names, null policy, typing, text, dates, ratios, categories, keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import query, table
from snapfold import functions as S
from snapfold import operators as O

AS_OF = "2002-01-01"


@query("b1_season_stamp", "SELECT o_orderkey, year(o_orderdate)::INT AS season, 'orders' AS entity, 1 AS version FROM orders")
def season_stamp(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("season"))
    return O.stamp(orders, entity="orders", version=1)


@query(
    "b2_file_names",
    """SELECT o_orderkey,
        CASE WHEN o_orderkey % 7 > 0 AND o_orderkey % 11 > 0 THEN strftime(o_orderdate, '%Y-%m-%d 23:59:58') END AS exported_at,
        CASE WHEN o_orderkey % 5 > 0 THEN year(o_orderdate)::INT END AS season
    FROM orders""",
)
def file_names(spark, sf):
    name = F.expr(
        """concat('/drops/Orders_', CASE WHEN o_orderkey % 5 = 0 THEN 'Summer' ELSE CAST(year(o_orderdate) AS string) END,
            'Season-All(x)__',
            CASE WHEN o_orderkey % 7 = 0 THEN 'latest'
                 WHEN o_orderkey % 11 = 0 THEN '20001399000000'
                 ELSE concat(date_format(o_orderdate, 'yyyyMMdd'), '235958') END, '.csv')"""
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format(S.snapshot_ts(name), "yyyy-MM-dd HH:mm:ss").alias("exported_at"),
        S.season_from_name(name).alias("season"),
    )


@query(
    "b3_conform_columns",
    """SELECT c_custkey AS customer, c_name AS "Slot1Previous", c_mktsegment AS "Slot2Previous" FROM customer""",
)
def conform_columns(spark, sf):
    exported = table(spark, sf, "customer").select(
        "c_custkey",
        F.col("c_name").alias("Slot12023Club"),
        F.col("c_mktsegment").alias("Slot22023Club"),
        F.col("c_acctbal").alias("Notes"),
    )
    renamed = O.rename_slots(exported, "Slot{n}{year}Club", "Slot{n}Previous", range(1, 6), year=2023)
    return O.rename_present(O.drop_present(renamed, ["Notes", "Fax"]), {"c_custkey": "customer", "fax": "f"})


@query(
    "c1_text_present",
    """SELECT o_orderkey, o_orderpriority AS priority FROM orders
    WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')""",
)
def text_present(spark, sf):
    priority = F.expr("CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN '' ELSE o_orderpriority END")
    return table(spark, sf, "orders").select("o_orderkey", priority.alias("priority")).filter(
        S.has_text(F.col("priority"))
    )


@query(
    "c3_deny_list",
    """SELECT p_partkey, CASE WHEN p_type NOT IN ('PROMO', 'SMALL') THEN p_type END AS p_type,
        CASE WHEN p_brand NOT IN (SELECT p_brand FROM part WHERE p_retailprice > 0 AND p_size = 1) THEN p_brand END AS p_brand
    FROM part""",
)
def deny_list(spark, sf):
    part = table(spark, sf, "part")
    denied = part.filter("p_retailprice > 0 AND p_size = 1").select("p_brand")
    scrubbed = part.select(
        "p_partkey", S.null_if_listed(F.col("p_type"), ["PROMO", "SMALL"]).alias("p_type"), "p_brand"
    )
    return O.null_if_denied(scrubbed, "p_brand", denied)


ORDER_RULES = [
    O.Rule("key_present", "o_orderkey IS NOT NULL"),
    O.Rule("not_pending", "o_orderstatus <> 'P'", O.DROP),
    O.Rule("known_priority", "nullif(o_orderpriority, '4-NOT SPECIFIED') <> '5-LOW'"),
]
CUSTOMER_RULES = [O.Rule("balance_non_negative", "c_acctbal >= 0", O.DROP)]


@query(
    "c4_rule_report",
    """SELECT 'orders' AS dataset, 'key_present' AS rule, 'warn' AS action, count(*) AS n_rows, count(*) FILTER (o_orderkey IS NULL) AS n_failed FROM orders
    UNION ALL SELECT 'orders', 'not_pending', 'drop', count(*), count(*) FILTER (o_orderstatus = 'P') FROM orders
    UNION ALL SELECT 'orders', 'known_priority', 'warn', count(*), count(*) FILTER (o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')) FROM orders
    UNION ALL SELECT 'customer', 'balance_non_negative', 'drop', count(*), count(*) FILTER (c_acctbal < 0) FROM customer""",
)
def rule_report(spark, sf):
    orders = O.check(table(spark, sf, "orders"), ORDER_RULES, "orders").report
    return orders.unionByName(O.check(table(spark, sf, "customer"), CUSTOMER_RULES, "customer").report)


@query(
    "c5_drop_and_quarantine",
    """SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal < 0 THEN 'balance_non_negative' ELSE '' END AS failed FROM customer""",
)
def drop_and_quarantine(spark, sf):
    checked = O.check(table(spark, sf, "customer"), CUSTOMER_RULES, "customer")
    kept = checked.kept.select("c_custkey", "c_acctbal", F.lit("").alias("failed"))
    return kept.unionByName(
        checked.quarantine.select("c_custkey", "c_acctbal", F.array_join("_failed_rules", ",").alias("failed"))
    )


@query(
    "d1_tolerant_casts",
    """SELECT o_orderkey,
        CASE WHEN o_orderkey % 7 = 0 THEN 0.0 ELSE o_totalprice END AS price,
        CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate::DATE END AS ordered,
        CASE WHEN o_orderkey % 3 = 0 THEN 4000 ELSE (o_orderkey % 1000)::INT END AS postcode,
        o_orderdate::DATE AS ordered_any_format,
        o_totalprice AS price_with_separators
    FROM orders""",
)
def tolerant_casts(spark, sf):
    text = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS string) END AS price",
        "CASE WHEN o_orderkey % 5 = 0 THEN '2024-02-30' ELSE concat(' ', date_format(o_orderdate, 'yyyy-MM-dd')) END AS ordered",
        "CASE WHEN o_orderkey % 3 = 0 THEN '7.5' ELSE concat(o_orderkey % 1000, ' ') END AS postcode",
        "date_format(o_orderdate, CASE WHEN o_orderkey % 2 = 0 THEN 'dd/MM/yyyy' ELSE 'yyyy-MM-dd' END) AS ordered_any_format",
        "format_number(o_totalprice, 2) AS price_with_separators",
    )
    return S.cast_all(
        text,
        [
            S.CastSpec("price", "double", 0.0),
            S.CastSpec("ordered", "date"),
            S.CastSpec("postcode", "int", 4000),
            S.CastSpec("ordered_any_format", "date", formats=("dd/MM/yyyy",)),
            S.CastSpec("price_with_separators", "double", group_separator=","),
            S.CastSpec("absent", "int"),
        ],
    )


@query(
    "d2_null_policy",
    """SELECT c_custkey,
        CASE WHEN c_custkey % 3 = 0 THEN 'none' WHEN c_custkey % 3 = 1 THEN '' ELSE c_name END AS name,
        CASE WHEN c_custkey % 4 = 0 THEN 'unknown' ELSE c_mktsegment END AS segment,
        CASE WHEN c_custkey % 3 < 2 THEN 'No team' ELSE c_name END AS team,
        CASE WHEN c_custkey % 5 = 0 THEN 0.0 ELSE c_acctbal END AS balance
    FROM customer""",
)
def null_policy(spark, sf):
    dirty = table(spark, sf, "customer").selectExpr(
        "c_custkey",
        "CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE c_name END AS name",
        "CASE WHEN c_custkey % 4 = 0 THEN '/' ELSE c_mktsegment END AS segment",
        "CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE c_name END AS team",
        "CASE WHEN c_custkey % 5 > 0 THEN c_acctbal END AS balance",
    )
    filled = S.fill_defaults(dirty, {"name": "none", "absent": "x"})
    return S.zero_fill(filled, ["balance"]).withColumns(
        {
            "segment": S.replace_sentinel(F.col("segment"), "/", "unknown"),
            "team": S.text_or(F.col("team"), "No team"),
        }
    )


@query(
    "e1_text_clean",
    r"""SELECT doc_id, length(t) AS n_chars, sha256(t) AS digest
    FROM (SELECT doc_id, regexp_replace(text, '[\x00-\x1F]', '', 'g') AS t FROM documents)""",
)
def text_clean(spark, sf):
    cleaned = S.clean_columns(table(spark, sf, "documents").select("doc_id", "text"), ["text", "absent"])
    return cleaned.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("digest")
    )


@query(
    "e2_split_ends",
    """SELECT p_partkey, p_name AS fee,
        CASE WHEN p_partkey % 4 = 0 THEN p_name ELSE p_brand END AS person
    FROM part""",
)
def split_ends(spark, sf):
    cell = F.expr(
        """CASE p_partkey % 4 WHEN 0 THEN p_name
            WHEN 1 THEN concat(p_name, chr(13), p_brand) ELSE concat(p_name, chr(13), p_type, chr(13), p_brand) END"""
    )
    return table(spark, sf, "part").select(
        "p_partkey", S.split_first(cell, "\r").alias("fee"), S.split_last(cell, "\r").alias("person")
    )


BANDS = [(14, "under 14"), (16, "14-15"), (18, "16-17"), (20, "18-19")]


@query(
    "f1_years_and_bands",
    """SELECT o_orderkey, years,
        CASE WHEN years < 14 THEN 'under 14' WHEN years < 16 THEN '14-15' WHEN years < 18 THEN '16-17'
             WHEN years < 20 THEN '18-19' WHEN years IS NOT NULL THEN '20 and over' ELSE 'unknown' END AS band
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 9 > 0 THEN
            floor(date_diff('day', o_orderdate::DATE, DATE '2015-06-30') / 365.25)::INT END AS years FROM orders)""",
)
def years_and_bands(spark, sf):
    born = F.expr("CASE WHEN o_orderkey % 9 > 0 THEN CAST(o_orderdate AS date) END")
    aged = table(spark, sf, "orders").select(
        "o_orderkey", S.years_between(F.lit("2015-06-30").cast("date"), born).alias("years")
    )
    return aged.withColumn("band", S.band(F.col("years"), BANDS, "20 and over", "unknown"))


@query(
    "f2_days_since",
    f"SELECT o_orderkey, date_diff('day', o_orderdate::DATE, DATE '{AS_OF}')::INT AS days FROM orders",
)
def days_since(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", S.days_since(F.col("o_orderdate"), AS_OF).alias("days"))


@query(
    "f3_guarded_ratio",
    """SELECT o_custkey, season, CASE WHEN billed > 0 THEN paid / billed ELSE 0.0 END AS rate,
        CASE WHEN balance <> 0 THEN paid / balance ELSE 0.0 END AS signed_rate
    FROM (SELECT o_custkey, year(o_orderdate)::INT AS season,
            sum(CASE WHEN o_orderstatus = 'F' THEN round(o_totalprice * 100)::BIGINT ELSE 0 END)::BIGINT AS paid,
            CASE WHEN o_custkey % 5 > 0 THEN sum(round(o_totalprice * 100)::BIGINT)::BIGINT WHEN o_custkey % 2 > 0 THEN 0 END AS billed,
            (o_custkey % 3 - 1)::BIGINT AS balance
        FROM orders GROUP BY 1, 2)""",
)
def guarded_ratio(spark, sf):
    cents = S.to_cents(F.col("o_totalprice"))
    totals = (
        table(spark, sf, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("season"))
        .agg(
            F.sum(F.when(F.col("o_orderstatus") == "F", cents).otherwise(0)).alias("paid"),
            F.sum(cents).alias("billed"),
        )
        .withColumns(
            {
                "billed": F.expr("CASE WHEN o_custkey % 5 > 0 THEN billed WHEN o_custkey % 2 > 0 THEN 0 END"),
                "balance": F.expr("o_custkey % 3 - 1"),
            }
        )
    )
    return totals.select(
        "o_custkey",
        "season",
        S.safe_ratio(F.col("paid"), F.col("billed")).alias("rate"),
        S.safe_ratio(F.col("paid"), F.col("balance"), positive_only=False).alias("signed_rate"),
    )


@query(
    "f4_bucket_check_sum",
    """SELECT l_orderkey, (sum(l_quantity) FILTER (l_returnflag = 'A')) AS a, (sum(l_quantity) FILTER (l_returnflag = 'N')) AS n,
        (sum(l_quantity) FILTER (l_returnflag = 'A')) + (sum(l_quantity) FILTER (l_returnflag = 'N')) AS check_sum
    FROM lineitem GROUP BY 1""",
)
def bucket_check_sum(spark, sf):
    buckets = O.pivot_sum(
        table(spark, sf, "lineitem"), ["l_orderkey"], "l_returnflag", {"A": "a", "N": "n"}, "l_quantity", fill=None
    )
    return buckets.withColumn("check_sum", S.row_sum([F.col("a"), F.col("n")]))


PART_RULES = [
    ("thermal", ["hot", "cold"]),
    ("fastener", ["bolt", "gear", "rod"]),
    ("coloured", ["red", "blue", "green"]),
    ("sized", ["small", "large", "old"]),
]


@query(
    "g1_first_matching_keyword",
    """SELECT p_partkey, CASE
        WHEN contains(n, 'hot') OR contains(n, 'cold') THEN 'thermal'
        WHEN contains(n, 'bolt') OR contains(n, 'gear') OR contains(n, 'rod') THEN 'fastener'
        WHEN contains(n, 'red') OR contains(n, 'blue') OR contains(n, 'green') THEN 'coloured'
        WHEN contains(n, 'small') OR contains(n, 'large') OR contains(n, 'old') THEN 'sized'
        ELSE 'other' END AS category
    FROM (SELECT p_partkey, CASE WHEN p_partkey % 10 > 0 THEN p_name END AS n FROM part)""",
)
def first_matching_keyword(spark, sf):
    name = F.expr("CASE WHEN p_partkey % 10 > 0 THEN initcap(p_name) END")
    return table(spark, sf, "part").select("p_partkey", S.first_match(name, PART_RULES, "other").alias("category"))


@query(
    "g2_payment_status",
    """SELECT o_orderkey, CASE WHEN owed <= 0 THEN CASE WHEN paid > o_totalprice THEN 'Overpaid' ELSE 'Paid' END
        WHEN paid > 0 THEN 'Partial' ELSE 'Outstanding' END AS status
    FROM (SELECT *, CASE o_orderkey % 6 WHEN 0 THEN 0.0 WHEN 1 THEN 10.0 WHEN 2 THEN o_totalprice WHEN 3 THEN o_totalprice + 1 WHEN 4 THEN NULL ELSE 5.0 END AS paid,
        CASE o_orderkey % 6 WHEN 0 THEN o_totalprice WHEN 1 THEN 1.0 WHEN 2 THEN 0.0 WHEN 3 THEN -1.0 WHEN 4 THEN 0.0 END AS owed FROM orders)""",
)
def payment_status(spark, sf):
    paid = F.expr(
        "CASE o_orderkey % 6 WHEN 0 THEN 0.0D WHEN 1 THEN 10.0D WHEN 2 THEN o_totalprice WHEN 3 THEN o_totalprice + 1 WHEN 4 THEN NULL ELSE 5.0D END"
    )
    owed = F.expr(
        "CASE o_orderkey % 6 WHEN 0 THEN o_totalprice WHEN 1 THEN 1.0D WHEN 2 THEN 0.0D WHEN 3 THEN -1.0D WHEN 4 THEN 0.0D END"
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", S.payment_status(F.col("o_totalprice"), paid, owed).alias("status")
    )


@query(
    "o1_hash_key",
    """SELECT c_custkey, sha256(concat_ws('|', c_name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END, c_nationkey::VARCHAR)) AS household
    FROM customer""",
)
def hash_key(spark, sf):
    segment = F.expr("CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END")
    return table(spark, sf, "customer").select(
        "c_custkey", S.hash_key([F.col("c_name"), segment, F.col("c_nationkey")]).alias("household")
    )


@query(
    "o2_fallback_key",
    """SELECT c_custkey, CASE WHEN c_custkey % 10 > 1 THEN sha256(c_custkey::VARCHAR)
        ELSE sha256(concat_ws('|', c_name, c_mktsegment, '')) END AS person
    FROM customer""",
)
def fallback_key(spark, sf):
    natural = F.expr("CASE c_custkey % 10 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE c_custkey END")
    parts = [F.col("c_name"), F.col("c_mktsegment"), F.lit(None).cast("date")]
    return table(spark, sf, "customer").select("c_custkey", S.fallback_key(natural, parts).alias("person"))
