"""Source files for the queries: driver tables turned into messy CSV exports.

Every export covers the whole table.  Spark writes the files in parallel; only
file names pass through the driver.

A query gets the ingest tables it reads and no others.  They are filled season by
season, and the exports of a season are emptied once they are in, so the disk holds those of
a season or two and not of all.  Of many lines, a season is exported in slices, ranges of orders,
one after the other; lines are ranked slice by slice, once for all tables a query needs, and freed when these
have them, and cleaned datasets are stored season by season.  Shuffles then hold a slice or a season.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.base import once_per_session, table
from snapfold.functions import column
from snapfold.plans import constants as K
from snapfold.plans.build import SEASONAL as BRONZE_OF_SEASONS
from snapfold.plans.build import SILVER_RULES, ingest
from snapfold.plans.debts import debts
from snapfold.plans.invoices import invoice_lines, invoices
from snapfold.plans.registrations import players, registrations
from snapfold.plans.teams import team_details, team_lists
from snapfold.session import emptied, scratch_dir, shuffles_released
from snapfold.sources import WINDOWS_1252, Dialect, Lake, encode_windows_1252
from snapfold.sources.tables import FIRST_RUN

# The order years 1995 to 2001 stand for these seasons.
SEASON_OFFSET = 25
SEASONS = tuple(range(2020, 2027))
DENIED_NOTES = ["leaked\nnote"]
#: Seasons whose exports are on disk at once.
SEASONS_AT_ONCE = 2
#: Lines are ranked and exported in slices of about so many, of all seasons, and in no more slices than that:
#: every slice scans the lines.
LINES_A_SLICE = 5_000_000
MOST_SLICES = 8


def side_by_side(action, items, most: int = 8) -> None:
    """Submit independent small Spark jobs together."""
    with ThreadPoolExecutor(most) as pool:
        list(pool.map(action, items))


def write_drop(
    df: DataFrame,
    folder: str,
    name: str,
    order: list[str],
    dialect: Dialect = WINDOWS_1252,
    quote_all: bool = False,
    parts: int | None = None,
) -> None:
    """Write ``<name>_<part>_<_stamp>.csv`` files, ``parts`` or as many as Spark sees fit; rows of a file follow ``order``.

    Columns with a leading underscore steer the writing and are not exported.
    ``{season}`` in the name is filled from ``_season``.
    """
    spark = df.sparkSession
    keys = [k for k in ("_season", "_stamp") if k in df.columns]
    cells = [c for c in df.columns if not c.startswith("_")]
    encode = encode_windows_1252 if dialect.is_windows_1252 else (lambda c: c)
    staging = scratch_dir(spark, "staging")
    (
        df.repartitionByRange(*([parts] if parts else []), *keys, *order[:1])
        .sortWithinPartitions(*keys, *order)
        .select(*keys, *[encode(column(c).cast("string")).alias(c) for c in cells])
        .write.partitionBy(*keys)
        .options(
            header="true",
            sep=dialect.delimiter,
            escape='"',
            quoteAll=str(quote_all).lower(),
            encoding="ISO-8859-1" if dialect.is_windows_1252 else dialect.encoding,
            lineSep="\n",
            ignoreLeadingWhiteSpace="false",
            ignoreTrailingWhiteSpace="false",
        )
        .csv(staging)
    )
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(staging)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(hadoop.Path(folder))
    for part, found in enumerate(files.globStatus(hadoop.Path(staging + "/*=*" * len(keys) + "/*.csv"))):
        path = found.getPath()
        values = dict(p.split("=", 1) for p in path.toString().split("/") if "=" in p)
        final = f"{name.format(season=values.get('_season'))}_{part:05d}_{values['_stamp']}.csv"
        files.rename(path, hadoop.Path(f"{folder}/{final}"))


def with_snapshots(df: DataFrame, stale: dict[str, str]) -> DataFrame:
    """The frame as exported twice a season: earlier with the ``stale`` values, then as it is.

    Both come from one row, so that what is before them is worked out once.
    """
    twice = df.withColumn("_now", F.explode(F.array(F.lit(True), F.lit(False))))
    stamp = F.concat(F.col("_season"), F.when(F.col("_now"), "0901120000").otherwise("0301120000"))
    older = {n: F.when(F.col("_now"), F.col(n)).otherwise(F.expr(e)) for n, e in stale.items()}
    return twice.withColumns({**older, "_stamp": stamp}).drop("_now")


def order_season() -> Column:
    return F.year("o_orderdate") + SEASON_OFFSET


def ranked_lines(spark: SparkSession, sf_dir: str, within=lambda key: F.lit(True), **more: Column) -> DataFrame:
    """Lines numbered 1, 2, … within their order, with order, customer and part, and ``more`` columns of all lines.

    Of the orders whose key is ``within``, all unless given.
    """
    lines = table(spark, sf_dir, "lineitem").where(within(F.col("l_orderkey"))).selectExpr(
        "*",
        """row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
           l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS pos""",
    ).withColumns(more)
    orders = table(spark, sf_dir, "orders").where(within(F.col("o_orderkey"))).withColumn("_season", order_season())
    # Customers meet the orders, which are fewer than the lines.
    bought = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return lines.join(bought, F.col("l_orderkey") == F.col("o_orderkey")).join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )


# SQL twin of ranked_lines, for the answers.
RANKED_LINES = f"""
    SELECT *, (year(o_orderdate) + {SEASON_OFFSET})::INT AS season FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
            l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS pos
        FROM lineitem)
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey
"""


LINE_COLUMNS = """o_orderkey o_orderdate o_orderstatus o_orderpriority c_custkey c_name c_mktsegment c_nationkey
    p_partkey p_name p_brand p_type p_size l_linenumber l_extendedprice l_returnflag l_linestatus pos cents _season""".split()


class Lines(NamedTuple):
    """``ranked_lines`` by slice and season, with the cents of all lines of their order, stored for the exports made of them."""

    rows: DataFrame
    slices: int
    folder: str

    def of(self, seasons: Sequence[int], part: int | None = None) -> DataFrame:
        """Lines of some seasons, of all slices or of one."""
        found = self.rows.where(F.col("_season").isin(list(seasons)))
        return (found if part is None else found.where(F.col("_slice") == part)).drop("_slice")


def stored_lines(spark: SparkSession, sf_dir: str) -> Lines:
    cents = F.expr("sum(CAST(round(l_extendedprice * 100) AS bigint)) OVER (PARTITION BY l_orderkey)")
    n = min(MOST_SLICES, -(-table(spark, sf_dir, "lineitem").count() // LINES_A_SLICE))
    shares = [k / n for k in range(1, n)]
    found = table(spark, sf_dir, "orders").approxQuantile("o_orderkey", shares, 0.01) if shares else []
    # A slice ends with its cut, the last one nowhere; later slices have larger keys, as later files have.
    cuts = [None, *sorted({int(c) for c in found}), None]

    def within(after, last):
        def condition(key: Column) -> Column:
            above = F.lit(True) if after is None else key > after
            return above if last is None else above & (key <= last)

        return condition

    path = scratch_dir(spark, "ranked-lines")
    with shuffles_released(spark):
        for k, ends in enumerate(zip(cuts, cuts[1:])):
            lines = ranked_lines(spark, sf_dir, within(*ends), cents=cents).select(F.lit(k).alias("_slice"), *LINE_COLUMNS)
            lines.write.mode("append").option("compression", "zstd").partitionBy("_slice", "_season").parquet(path)
    return Lines(spark.read.schema(lines.schema).parquet(path), len(cuts) - 1, path)


def slice_name(name: str, part: int | None) -> str:
    """Files of later slices have later names: the newest of equally new rows is the one of the last file."""
    return name if part is None else f"{name}_{part:03d}"


def write_registrations(lines: Lines, folder: str, seasons: Sequence[int] = SEASONS, part: int | None = None) -> None:
    """A household is a customer, a registration an order, a player slot a line.

    Orders with more than five lines fill several registrations.
    """
    person = {
        "Surname": "replace(p_name, ' ', concat(' ', chr(2)))",
        "FirstName": "p_brand",
        "MiddleName": "CAST(NULL AS string)",
        "Gender": "l_returnflag",
        "DateofBirth": "CAST(date_add(DATE'1980-01-01', CAST(p_partkey % 9000 AS int)) AS string)",
        "FFANumber": "CASE WHEN p_partkey % 10 = 0 THEN 'unknown' ELSE CAST(p_partkey AS string) END",
        "PreferredPlayingGroup": "p_type",
        "PlayedLastSeason": "l_linestatus",
        "ClubName": "CASE WHEN p_size % 3 = 0 THEN '/' WHEN p_size % 3 = 1 THEN p_brand END",
        "SchoolName": "CAST(NULL AS string)",
        "OtherSchool": "CAST(NULL AS string)",
        "SchoolGrade": "CAST(p_size AS string)",
    }
    wide = (
        lines.of(seasons, part)
        .withColumns({"_slot": F.expr("CAST((pos - 1) % 5 + 1 AS int)"), "_block": F.expr("(pos - 1) DIV 5")})
        .groupBy("_season", "o_orderkey", "_block", "o_orderdate", "c_custkey", "c_name", "c_mktsegment", "c_nationkey", "o_orderstatus")
        .agg(
            # At most five slots by construction.
            F.map_from_entries(
                F.collect_list(
                    F.struct("_slot", F.struct(*[F.expr(e).alias(a) for a, e in person.items()]))
                )
            ).alias("_slots")
        )
        .withColumns(
            {
                f"Player{n}{attribute}": F.col("_slots")[n][attribute]
                for n in K.PLAYER_SLOTS
                for attribute in person
            }
        )
        .withColumns(
            {
                "RegistrationDate": F.expr(
                    "CASE WHEN o_orderkey % 50 = 0 THEN 'soon' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END"
                ),
                "RegistrationTime": F.lit("12:00"),
                "RegistrationStatus": F.lit("Active"),
                "Suburb": F.expr("concat('Saint-André ', c_nationkey)"),
                "State": F.col("o_orderstatus"),
                "Postcode": F.expr("CASE WHEN c_nationkey = 7 THEN '40x0' ELSE CAST(4000 + c_nationkey AS string) END"),
                "PrimaryMemberSurname": F.expr("concat(chr(1), replace(c_name, '#', '\n#'))"),
                "PrimaryMemberFirstName": F.col("c_mktsegment"),
                "PrimaryMemberEmailAddress": F.expr("CASE WHEN c_custkey % 4 > 0 THEN concat(c_custkey, '@example.org') END"),
                "PrimaryMemberNotes": F.expr("CASE WHEN c_custkey % 2 = 0 THEN 'leaked\nnote' ELSE 'fine' END"),
                "PrimaryMemberPhoneNumber": F.expr("CASE WHEN c_custkey % 3 = 0 THEN '0' || c_custkey END"),
            }
        )
        .drop("_slots", "o_orderdate", "c_name", "c_mktsegment", "c_nationkey", "o_orderstatus")
    )
    # Customers with a key ending in 3 are missing from the later export.
    exported = with_snapshots(wide, {"RegistrationStatus": "'Pending'"}).filter(
        "NOT (c_custkey % 10 = 3 AND _stamp LIKE '%0901120000')"
    )

    def write_season(season: int) -> None:
        names = {f"Player{n}ClubName": f"Player{n}{season - 1}ClubName" for n in K.PLAYER_SLOTS}
        rows = exported.filter(F.col("_season") == season).withColumnsRenamed(names)
        if season == 2026:
            rows = rows.withColumn("Player1FQFeeBypassCode", F.lit(None).cast("string"))
        write_drop(
            rows.drop("c_custkey").withColumnsRenamed({"o_orderkey": "_order"}),
            folder,
            slice_name("Registrations_{season}Season", part),
            ["_order", "_block"],
        )

    side_by_side(write_season, seasons)


# Fee text by line number; the answers use the resulting column directly.
FEE_TEXT = """CASE l_linenumber % 6
    WHEN 0 THEN 'Volunteer Levy' WHEN 1 THEN 'Senior Player Fee' WHEN 2 THEN 'Governing Body Levy'
    WHEN 3 THEN 'Sibling Discount for Senior' WHEN 4 THEN 'MASTERS 2nd team' ELSE 'Socks' END"""


def write_invoices(lines: Lines, folder: str, seasons: Sequence[int] = SEASONS, part: int | None = None) -> None:
    """An invoice is an order: a parent row with the first line, child rows, a blank row.

    Every tenth order is followed by an amount that belongs to no invoice.
    """
    described = with_snapshots(
        lines.of(seasons, part).withColumns(
            {
                "amount": F.expr("cents / 100.0D"),
                "paid": F.expr("CASE o_orderkey % 4 WHEN 0 THEN 0.0D WHEN 1 THEN (cents DIV 2) / 100.0D WHEN 2 THEN cents / 100.0D ELSE (cents + 500) / 100.0D END"),
                "owed": F.expr("CASE o_orderkey % 4 WHEN 0 THEN cents / 100.0D WHEN 1 THEN (cents - cents DIV 2) / 100.0D WHEN 2 THEN 0.0D ELSE -5.0D END"),
            }
        ),
        {"paid": "0.0D", "owed": "amount", "l_extendedprice": "l_extendedprice * 2"},
    )
    header = {
        "Reference": "CAST(o_orderkey AS string)",
        "Surname": "concat('Zoë ', c_name)",
        "First Name": "c_mktsegment",
        "Date": "date_format(o_orderdate, 'yyyy-MM-dd')",
        "Invoice Amount": "CAST(amount AS string)",
        "Paid Amount": "CAST(paid AS string)",
        "Outstanding Amount": "CAST(owed AS string)",
        "Commitment Amount": "'0'",
        "Pending Amount": "'n/a'",
        "Payable Amount": "CAST(owed AS string)",
        "Adjustment Indicator": "CASE WHEN o_orderkey % 3 > 0 THEN 'N' END",
        "Component": "'Season'",
        "Component Description": "o_orderpriority",
        "Event Type": "o_orderstatus",
    }
    line = {
        "Line Nbr": "CAST(pos AS string)",
        "Line Amount": "CAST(l_extendedprice AS string)",
        "Line Description": f"concat({FEE_TEXT}, CASE WHEN pos % 5 > 0 THEN concat(chr(13), p_name) ELSE '' END)",
    }
    keys = ["_season", "_stamp", "o_orderkey AS _order"]
    full = described.selectExpr(
        *keys,
        "CAST(pos AS int) AS _pos",
        *[f"CASE WHEN pos = 1 THEN {e} END AS `{n}`" for n, e in header.items()],
        *[f"{e} AS `{n}`" for n, e in line.items()],
    )
    blank = [f"CAST(NULL AS string) AS `{n}`" for n in [*header, *line]]
    orphan = [
        "'9.99' AS `Invoice Amount`" if n == "Invoice Amount" else f"CAST(NULL AS string) AS `{n}`"
        for n in [*header, *line]
    ]
    after = described.filter("pos = 1")
    ghosts = after.selectExpr(*keys, "1000000000 AS _pos", *blank)
    orphans = after.filter("o_orderkey % 10 = 0").selectExpr(*keys, "1000000001 AS _pos", *orphan)
    write_drop(
        full.unionByName(ghosts).unionByName(orphans),
        folder,
        slice_name("RegistrationInvoices_{season}Season", part),
        ["_order", "_pos"],
    )


def debt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One debt per order, as exported."""
    orders = table(spark, sf_dir, "orders").withColumn("_season", order_season())
    return (
        orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "_season",
            "o_orderkey AS _order",
            "CAST(o_orderkey AS string) AS InvoiceRef",
            "concat('Zoë ', c_name) AS PlayerSurname",
            "c_mktsegment AS PlayerFirstName",
            "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE n_name END AS TeamName",
            "date_format(o_orderdate, 'yyyy-MM-dd') AS InvoiceDate",
            "CASE WHEN o_orderkey % 20 = 0 THEN 'tbc' ELSE CAST(o_totalprice AS string) END AS InvoiceAmount",
            "CAST(CASE o_orderkey % 4 WHEN 0 THEN 0.0D WHEN 1 THEN 100.0D ELSE o_totalprice END AS string) AS TotalPaymentAmount",
            "CASE WHEN o_orderkey % 7 = 0 THEN '1.5' END AS TotalCreditAmount",
            "CAST(CASE o_orderkey % 4 WHEN 0 THEN o_totalprice WHEN 1 THEN 50.25D ELSE 0.0D END AS string) AS OutstandingAmount",
            "'0' AS CommitmentAmount",
            # 2 ** 70: far beyond any decimal or long of cents, and exact in sums of doubles.
            "CASE WHEN o_orderkey % 9 = 0 THEN '1180591620717411303424' ELSE '0' END AS PendingAmount",
            "'0' AS PayableAmount",
            "CASE WHEN o_orderkey % 4 > 0 THEN '1' END AS NumberOfPayments",
            "'x' AS NumberOfCredits",
            "CASE WHEN o_orderkey % 4 > 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') END AS LastPaymentDate",
            "'31/12/2024' AS LastCreditDate",
        )
    )


def write_debts(spark: SparkSession, sf_dir: str, folder: str, seasons: Sequence[int] = SEASONS) -> None:
    """Two exports of all debts; the 2024 files are UTF-8."""
    write_debt_export(
        with_snapshots(debt_rows(spark, sf_dir), {"TotalPaymentAmount": "'0'", "LastPaymentDate": "'1990-01-01'"}), folder, seasons
    )


def write_debt_export(exported: DataFrame, folder: str, seasons: Sequence[int] = SEASONS) -> None:
    utf_8 = [s for s in seasons if s == 2024]

    def write(kind: tuple[list[int], Dialect]) -> None:
        some, dialect = kind
        if some:
            write_drop(exported.filter(F.col("_season").isin(some)), folder, "PlayersDebts_{season}Season", ["_order"], dialect)

    side_by_side(write, [([s for s in seasons if s not in utf_8], K.WINDOWS_1252), (utf_8, K.UTF_8)])


def team_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams are nations."""
    return table(spark, sf_dir, "nation").withColumn("_season", F.lit(2026))


def write_team_details(spark: SparkSession, sf_dir: str, folder: str) -> None:
    details = team_rows(spark, sf_dir).selectExpr(
        "_season",
        "n_nationkey AS _order",
        "n_name AS TeamName",
        "CASE n_nationkey % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'y' WHEN 2 THEN 'N' END AS IsActive",
        "CASE WHEN n_nationkey % 5 > 0 THEN CAST(n_regionkey AS string) END AS NumberOfOfficials",
        "CAST(n_nationkey AS string) AS NumberOfPlayers",
    )
    write_drop(
        with_snapshots(details, {"IsActive": "'N'"}), folder, "TeamDetails_{season}Season-All(Competitions)", ["_order"]
    )


def write_team_lists(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Customers play for the teams and suppliers coach."""
    people = (
        table(spark, sf_dir, "customer")
        .selectExpr("c_custkey AS k", "c_name AS name", "c_nationkey AS n_nationkey", "'Player' AS Role")
        .unionByName(
            table(spark, sf_dir, "supplier").selectExpr(
                "s_suppkey AS k", "s_name AS name", "s_nationkey AS n_nationkey", "'Head Coach' AS Role"
            )
        )
    )
    lists = people.join(team_rows(spark, sf_dir), "n_nationkey").selectExpr(
        "_season",
        "k AS _order",
        "Role AS _role",
        "n_name AS TeamName",
        "Role",
        "'Zoë' AS FirstName",
        "name AS Surname",
        "CASE WHEN k % 3 > 0 THEN CAST(k AS string) END AS `FFA Number`",
        "'2010-02-30' AS DateOfBirth",
        "'2026-02-01' AS RegistrationDate",
        "concat('04', lpad(CAST(k AS string), 8, '0')) AS PrimaryContactMobileNumber",
        "CAST(NULL AS string) AS PrimaryContactPhoneNumber",
    )
    write_drop(
        with_snapshots(lists, {"RegistrationDate": "'2025-02-01'"}),
        folder,
        "TeamLists_{season}Season-All(Competitions)",
        ["_order", "_role"],
        K.UTF_8,
    )


@once_per_session
def club_folder(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the exports of all five entities."""
    folder = scratch_dir(spark, "exports")
    lines = stored_lines(spark, sf_dir)
    writes = [
        *[partial(write, lines, folder) for write in (write_registrations, write_invoices)],
        *[partial(write, spark, sf_dir, folder) for write in (write_debts, write_team_details, write_team_lists)],
    ]
    side_by_side(lambda write: write(), writes)
    emptied(spark, lines.folder)
    return folder


#: The ingest tables, and what writes the exports of those that have seasons.
SEASONAL = {
    "bronze_registrations": write_registrations,
    "bronze_registration_invoices": write_invoices,
    "bronze_players_debts": write_debts,
}
TEAMS = {"bronze_team_details": write_team_details, "bronze_team_lists": write_team_lists}


@once_per_session
def _lake(spark: SparkSession, sf_dir: str) -> Lake:
    return Lake(spark, scratch_dir(spark, "lake"))


#: Lines stored for the tables that are being filled, by application and folder.
_KEPT: dict[tuple[str, str], Lines] = {}


@contextmanager
def _keeping_lines(spark: SparkSession, sf_dir: str) -> Iterator[None]:
    """Inside, lines are ranked and stored once, by the first table that asks for them; freed at the end."""
    try:
        yield
    finally:
        if lines := _KEPT.pop((spark.sparkContext.applicationId, sf_dir), None):
            emptied(spark, lines.folder)


def _kept_lines(spark: SparkSession, sf_dir: str) -> Lines:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _KEPT:
        _KEPT[key] = stored_lines(spark, sf_dir)
    return _KEPT[key]


def _take_in(lake: Lake, folder: str, write, seasons: Sequence[int], tables: Sequence[str]) -> None:
    """Write exports, ingest them, and free them."""
    write(folder)
    ingest(lake, folder, seasons, tables=tables)
    emptied(lake.spark, folder)


@once_per_session
def _ingested(spark: SparkSession, sf_dir: str, name: str) -> None:
    """Fill one ingest table, the seasons one after the other, ``SEASONS_AT_ONCE`` together, and a season slice by slice."""
    lake = _lake(spark, sf_dir)
    if name in TEAMS:
        with shuffles_released(spark):
            write = partial(TEAMS[name], spark, sf_dir)
            _take_in(lake, scratch_dir(spark, "exports"), write, SEASONS[-1:], [name])
        return
    write, lines = SEASONAL[name], None
    if name != "bronze_players_debts":
        lines = _kept_lines(spark, sf_dir)
        write = partial(write, lines)
    else:
        write = partial(write, spark, sf_dir)
    for one in SEASONS:
        lake.show(name, FIRST_RUN, one)  # one by one, as the pointers share a folder

    def season(one: int) -> None:
        folder = scratch_dir(spark, "exports")
        if lines is None or lines.slices == 1:
            _take_in(lake, folder, partial(write, seasons=(one,)), (one,), [name])
            return
        # In one folder, so that the stream of the season finds each slice as files that have arrived since.
        for part in range(lines.slices):
            _take_in(lake, folder, partial(write, seasons=(one,), part=part), (one,), [name])

    with shuffles_released(spark):
        side_by_side(season, SEASONS, SEASONS_AT_ONCE)


def club_lake(spark: SparkSession, sf_dir: str, *tables: str) -> Lake:
    """Ingest tables filled from the exports of the club: those named, or all."""
    with _keeping_lines(spark, sf_dir):
        for name in tables or (*SEASONAL, *TEAMS):
            _ingested(spark, sf_dir, name)
    return _lake(spark, sf_dir)


#: The ingest tables that cleaned datasets are made of; players come from the cleaned registrations.
SOURCES = {**BRONZE_OF_SEASONS, "silver_team_details": "bronze_team_details", "silver_team_lists": "bronze_team_lists"}


@once_per_session
def _cleaned(spark: SparkSession, sf_dir: str, name: str) -> None:
    """Store one cleaned dataset, of many lines season by season: no key or file is of two seasons."""
    source = SOURCES.get(name)
    if name == "silver_players":
        lake = cleaned_lake(spark, sf_dir, "silver_registrations")
        rows, season = lake.scan("silver", "silver_registrations"), F.col("Season")
    else:
        lake = club_lake(spark, sf_dir, source)
        rows, season = lake.ingested(source), F.col("_season")
    noted = lake.ingested_columns(source) if name == "silver_registrations" else None
    filled = []

    def filled_lines(some: DataFrame) -> DataFrame:
        filled.append(scratch_dir(spark, "filled"))
        return invoice_lines(some, filled[-1]).lines

    clean = {
        "silver_players": players,
        "silver_registrations": lambda some: registrations(some, DENIED_NOTES, columns=noted),
        "silver_invoices": lambda some: invoices(filled_lines(some)),
        "silver_players_debts": debts,
        "silver_team_details": team_details,
        "silver_team_lists": team_lists,
    }[name]
    by_line = name in ("silver_players", "silver_registrations", "silver_invoices")
    apart = by_line and table(spark, sf_dir, "lineitem").count() > LINES_A_SLICE
    partition_by = ["Season"] if source in SEASONAL or by_line else ()
    with shuffles_released(spark):
        for k, some in enumerate([rows.where(season == one) for one in SEASONS] if apart else [rows]):
            lake.refresh(clean(some), "silver", name, partition_by, more=k > 0)
            for folder in filled:
                emptied(spark, folder)
            filled.clear()


def cleaned_lake(spark: SparkSession, sf_dir: str, *datasets: str) -> Lake:
    """``club_lake`` with cleaned datasets that the star schema reads: those named, or all."""
    names = datasets or tuple(SILVER_RULES)
    club_lake(spark, sf_dir, *dict.fromkeys(SOURCES.get(name, "bronze_registrations") for name in names))
    for name in names:
        _cleaned(spark, sf_dir, name)
    return _lake(spark, sf_dir)
