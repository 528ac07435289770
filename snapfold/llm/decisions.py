"""Quality rules: ordered decision lists learned by sequential covering, all in DataFrame expressions.

``document_stats`` measures every text inside its row (no shuffle: windows and
lines of one text are compared with array functions).  ``learn_rules`` reads a
bounded number of labelled rows and covers the bad ones rule by rule: a rule is
a conjunction of thresholds, grown on two thirds of the labelled rows and
pruned on the rest.  ``DecisionList.keep`` is one ordered CASE expression.

Defined edge cases: a null or blank text has zero words and zero counts; rows
with a null id, a null label or a label without a text do not teach; repeated
labels all count; without labelled rows of both kinds the list is empty and
keeps everything.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfold.llm.common import WORD, free_name, stage

#: Characters that count as symbols, words in a repeat window.
SYMBOLS = r"[#*$%&|<>]"
REPEAT_WINDOW = 5
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Ratios the rules may use, each a whole number per thousand of its base.
RATIOS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "repeats_per_word": ("n_repeat_words", "n_words"),
    "dup_lines_per_word": ("n_dup_lines", "n_words"),
}


def document_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five counts of ``STATS`` (long) appended.

    Columns of the input named like a count are replaced.
    """
    words, lines, hashes, windows, pairs, starts = (free_name(docs, n) for n in ("_words", "_lines", "_hashes", "_windows", "_pairs", "_starts"))
    whole = F.coalesce(F.col(text), F.lit(""))
    last = REPEAT_WINDOW - 1
    step1 = docs.withColumns(
        {
            words: F.regexp_extract_all(whole, F.lit(f"({WORD})")),
            lines: F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(WORD)),
            "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)).cast("long"),
        }
    )
    step2 = step1.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.aggregate(words, F.lit(0).cast("long"), lambda total, w: total + F.length(w)),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            hashes: F.transform(words, lambda w: F.xxhash64(w)),
        }
    )
    # Arrays that a lambda indexes are columns of their own step, so that they
    # are computed once a row and not once an element.
    step3 = step2.withColumn(
        windows,
        F.when(
            F.size(hashes) > last,
            F.transform(
                F.sequence(F.lit(0), F.size(hashes) - F.lit(REPEAT_WINDOW)),
                lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(REPEAT_WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<long>")),
    )
    step4 = step3.withColumn(
        pairs,
        F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    step5 = step4.withColumn(
        starts,
        F.sort_array(
            F.filter(
                F.transform(
                    pairs,
                    lambda p, j: F.when(
                        (p["h"] == F.get(pairs, j - 1)["h"]) | (p["h"] == F.get(pairs, j + 1)["h"]), p["i"]
                    ),
                ),
                lambda i: i.isNotNull(),
            )
        ),
    )
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda seen, i: F.struct(
            (seen["n"] + (i + REPEAT_WINDOW - F.greatest(i, seen["end"]))).cast("long").alias("n"),
            (i + REPEAT_WINDOW).cast("int").alias("end"),
        ),
        lambda seen: seen["n"],
    )
    step6 = step5.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return step6.drop(words, lines, hashes, windows, pairs, starts)


@dataclass(frozen=True)
class Test:
    """One threshold: ``feature <= bound`` or ``feature > bound``."""

    feature: str
    above: bool
    bound: float

    def holds(self, columns: dict[str, Column]) -> Column:
        value = columns[self.feature]
        return value > F.lit(self.bound) if self.above else value <= F.lit(self.bound)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.bound:g}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; the first that holds rejects, what none names is kept."""

    rules: tuple[tuple[Test, ...], ...] = field(default=())

    def matched(self) -> Column:
        """1-based number of the first rule that holds, 0 for none."""
        columns, case = features(), None
        for number, tests in enumerate(self.rules, 1):
            condition = _all(tests, columns)
            case = F.when(condition, number) if case is None else case.when(condition, number)
        return F.lit(0) if case is None else case.otherwise(0)

    def keep(self) -> Column:
        return self.matched() == 0

    def __str__(self) -> str:
        return "\n".join(f"reject if {' and '.join(map(str, tests))}" for tests in self.rules) + "\nkeep"


def features() -> dict[str, Column]:
    """What rules may test: the counts and their ratios, as doubles."""
    counts = {name: F.col(name).cast("double") for name in STATS}
    ratios = {
        name: F.when(F.col(base) > 0, F.col(part) / F.col(base)).otherwise(F.lit(0.0)) for name, (part, base) in RATIOS.items()
    }
    return counts | ratios


def _all(tests, columns) -> Column:
    condition = F.lit(True)
    for test in tests:
        condition = condition & test.holds(columns)
    return condition


def learn_rules(
    stats: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    label: str = "quality",
    max_labelled: int = 20_000,
    max_rules: int = 8,
    max_tests: int = 4,
    steps: int = 16,
    min_precision: float = 0.9,
    min_covered: int = 10,
) -> DecisionList:
    """Sequential covering of the rows labelled 0.

    ``max_labelled`` bounds the labelled rows used, taken in order of a hash of
    the id, so the bound costs one top-k; everything after runs on that small
    stored table.  ``steps`` quantiles of a feature are its candidate bounds.
    A rule stays if, on the rows held back for pruning, at least
    ``min_precision`` of what it rejects is labelled 0.
    """
    order = F.xxhash64(F.col(id_column))
    taught = (
        labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull())
        .select(F.col(id_column), (F.col(label) == 0).alias("_bad"))
        .orderBy(order, F.col(id_column), "_bad")
        .limit(max_labelled)
    )
    rows = taught.join(stats.select(id_column, *STATS), id_column)
    columns = features()
    table = stage(
        rows.select(*[c.alias(n) for n, c in columns.items()], "_bad", (F.pmod(F.xxhash64(F.lit("fold"), F.col(id_column)), F.lit(3)) > 0).alias("_grow")).coalesce(1),
        "labelled-stats",
    )
    named = {name: F.col(name) for name in columns}
    grid = [k / steps for k in range(steps + 1)]
    # Bounds among the bad and among the good rows: where either is rare, its quantiles still fall inside it.
    bounds: dict[str, list[float]] = {name: [] for name in named}
    for row in table.groupBy("_bad").agg(*[F.percentile_approx(c, grid, 10_000).alias(n) for n, c in named.items()]).collect():
        for name in named:
            bounds[name] = sorted({*bounds[name], *row[name]})
    candidates = [Test(n, above, b) for n, found in bounds.items() for b in found for above in (False, True)]

    rules: list[tuple[Test, ...]] = []
    left = F.lit(True)
    while len(rules) < max_rules:
        tests = _grow(table.where(left & F.col("_grow")), candidates, named, max_tests, min_covered)
        tests = _prune(table.where(left & ~F.col("_grow")), tests, named)
        if not tests:
            break
        held = table.where(left & ~F.col("_grow") & _all(tests, named)).agg(*_counts(F.lit(True), "")).first()
        if held["bad"] + held["good"] == 0 or held["bad"] < min_precision * (held["bad"] + held["good"]):
            break
        rules.append(tests)
        left = left & ~_all(tests, named)
    return DecisionList(tuple(rules))


def _counts(condition: Column, suffix) -> list[Column]:
    return [
        F.count(F.when(condition & F.col("_bad"), 1)).alias(f"bad{suffix}"),
        F.count(F.when(condition & ~F.col("_bad"), 1)).alias(f"good{suffix}"),
    ]


def _grow(rows: DataFrame, candidates, named, max_tests: int, min_covered: int) -> tuple[Test, ...]:
    """Add the test with the best information gain until no good row is covered."""
    import math

    tests: tuple[Test, ...] = ()
    base = rows.agg(*_counts(F.lit(True), "")).first()
    bad, good = base["bad"], base["good"]
    if bad < min_covered:
        return ()
    while good and len(tests) < max_tests:
        inside = rows.where(_all(tests, named))
        # One pass counts all candidates: long form, a row for each test that holds.
        held = F.filter(
            F.array(*[F.when(t.holds(named), F.lit(k)) for k, t in enumerate(candidates)]), lambda k: k.isNotNull()
        )
        counted = {
            r["k"]: (r["bad"], r["good"])
            for r in inside.select(F.explode(held).alias("k"), "_bad").groupBy("k").agg(*_counts(F.lit(True), "")).collect()
        }
        purity = math.log2(bad / (bad + good))

        def gain(k: int) -> float:
            p, n = counted.get(k, (0, 0))
            return p * (math.log2(p / (p + n)) - purity) if p >= min_covered else 0.0

        best = max(range(len(candidates)), key=lambda k: (gain(k), -k))
        if gain(best) <= 1e-9:
            break
        tests = (*tests, candidates[best])
        bad, good = counted[best]
    return tests


def _prune(rows: DataFrame, tests: tuple[Test, ...], named) -> tuple[Test, ...]:
    """The prefix of the tests with the best (bad - good) / (bad + good) on rows held back."""
    if not tests:
        return ()
    found = rows.agg(*[c for k in range(1, len(tests) + 1) for c in _counts(_all(tests[:k], named), k)]).first()

    def worth(k: int) -> float:
        p, n = found[f"bad{k}"], found[f"good{k}"]
        return (p - n) / (p + n) if p + n else -1.0

    return tests[: max(range(1, len(tests) + 1), key=lambda k: (worth(k), -k))]
