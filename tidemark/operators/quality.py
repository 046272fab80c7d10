"""Data-quality checks. Every check yields one row; nothing is collected to decide it.

Row-level checks of a table are fused into one aggregate, that is one scan. Uniqueness and
foreign-key checks first reduce to counts per key, so a hot key is combined on the map side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import columns as C

RESULT_DDL = (
    "suite STRING, check STRING, target STRING, critical BOOLEAN, success BOOLEAN, element_count BIGINT, "
    "missing_count BIGINT, unexpected_count BIGINT, unexpected_percent DOUBLE, error STRING"
)
SAMPLE_ROWS = 10  # fixed value: failing values shown per failed check


@dataclass(frozen=True)
class Check:
    """``kind`` names the rule, ``columns`` its target; ``fails`` is the row-level predicate, if it has one.

    A predicate that is NULL counts as passed, so NULL values pass every rule but ``not_null``.
    """

    kind: str
    columns: tuple[str, ...]
    fails: Column | None = None
    parent: str | None = None
    parent_column: str | None = None

    @property
    def target(self) -> str:
        return ",".join(self.columns)


def not_null(*columns: str) -> list[Check]:
    return [Check("not_null", (c,), F.col(c).isNull()) for c in columns]


def accepted_values(column: str, values: Sequence) -> Check:
    return Check("accepted_values", (column,), ~F.col(column).isin(list(values)))


def not_accepted_values(column: str, values: Sequence) -> Check:
    return Check("not_accepted_values", (column,), F.col(column).isin(list(values)))


def between(column: str, low=None, high=None, strict_low: bool = False) -> Check:
    c = F.col(column)
    sides = []
    if low is not None:
        sides.append(c <= low if strict_low else c < low)
    if high is not None:
        sides.append(c > high)
    return Check("between", (column,), reduce(lambda a, b: a | b, sides))


def expression(column: str, rest: str) -> Check:
    """``rest`` completes a predicate on the column, such as ``"> 0"`` or ``">= low"``."""
    return Check(f"expression {rest}", (column,), ~F.expr(f"{column} {rest}"))


def pair_at_least(larger: str, smaller: str) -> Check:
    return Check("pair_at_least", (larger, smaller), F.col(larger) < F.col(smaller))


def unique(*columns: str) -> Check:
    """No two rows share the key; a key with a NULL part is not compared."""
    return Check("unique", columns)


def relationship(column: str, parent: str, parent_column: str) -> Check:
    """Every non-NULL value exists in the parent table."""
    return Check("relationship", (column,), None, parent, parent_column)


def columns_present(*columns: str) -> Check:
    return Check("columns_present", columns)


@dataclass(frozen=True)
class Suite:
    table: str
    checks: tuple[Check, ...] = field(default_factory=tuple)
    critical: bool = False


def _rows_of(
    suite: str, check: Check, critical: bool, elements: Column, missing: Column, unexpected: Column
) -> list[Column]:
    return [
        F.lit(suite).alias("suite"),
        F.lit(check.kind).alias("check"),
        F.lit(check.target).alias("target"),
        F.lit(critical).alias("critical"),
        (unexpected == 0).alias("success"),
        elements.cast("bigint").alias("element_count"),
        missing.cast("bigint").alias("missing_count"),
        unexpected.cast("bigint").alias("unexpected_count"),
        F.coalesce(unexpected * 100.0 / F.nullif(elements, F.lit(0)), F.lit(0.0)).alias("unexpected_percent"),
        F.lit(None).cast("string").alias("error"),
    ]


def _fused(name: str, suite: Suite, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row-level checks of one table in one aggregate, then one row per check."""
    aggregates = [F.count(F.lit(1)).alias("elements")]
    for i, check in enumerate(checks):
        aggregates += [
            F.count_if(F.coalesce(check.fails, F.lit(False))).alias(f"bad{i}"),
            F.count_if(F.col(check.columns[0]).isNull()).alias(f"null{i}"),
        ]
    rows = [
        F.struct(*_rows_of(name, c, suite.critical, F.col("elements"), F.col(f"null{i}"), F.col(f"bad{i}")))
        for i, c in enumerate(checks)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def _unique(name: str, suite: Suite, df: DataFrame, check: Check) -> DataFrame:
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in check.columns])
    per_key = df.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("elements"),
        F.coalesce(F.sum(F.when(~complete, F.col("n"))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.when(complete & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias("bad"),
    )
    return totals.select(
        *_rows_of(name, check, suite.critical, F.col("elements"), F.col("missing"), F.col("bad"))
    )


def _relationship(name: str, suite: Suite, df: DataFrame, check: Check, parent: DataFrame) -> DataFrame:
    """Counts per value first: the join sees each value once, however many rows hold it."""
    (child,) = check.columns
    known = parent.select(F.col(check.parent_column).alias("_key")).where(F.col("_key").isNotNull()).distinct()
    per_value = df.groupBy(F.col(child).alias("_value")).agg(F.count(F.lit(1)).alias("n"))
    joined = per_value.join(known, F.col("_value") == F.col("_key"), "left")
    orphan = F.col("_value").isNotNull() & F.col("_key").isNull()
    totals = joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("elements"),
        F.coalesce(F.sum(F.when(F.col("_value").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("bad"),
    )
    return totals.select(
        *_rows_of(name, check, suite.critical, F.col("elements"), F.col("missing"), F.col("bad"))
    )


def _constant(spark: SparkSession, name: str, suite: Suite, check: Check, bad: int, error: str | None) -> DataFrame:
    row = (name, check.kind, check.target, suite.critical, bad == 0, 0, 0, bad, 0.0, error)
    return spark.createDataFrame([row], RESULT_DDL)


def run_suite(
    spark: SparkSession, name: str, suite: Suite, tables: Mapping[str, DataFrame | None]
) -> DataFrame:
    """One result row per check. A table that is not there fails the suite; an empty one passes it."""
    df = tables.get(suite.table)
    if df is None:
        missing = Check("table_exists", (suite.table,))
        return _constant(spark, name, suite, missing, 1, f"table {suite.table} not found")
    parts: list[DataFrame] = []
    row_level: list[Check] = []
    for check in suite.checks:
        absent = [c for c in check.columns if c not in df.columns]
        if check.kind == "columns_present" or absent:
            error = f"missing columns: {', '.join(absent)}" if absent else None
            parts.append(_constant(spark, name, suite, check, len(absent), error))
        elif check.kind == "unique":
            parts.append(_unique(name, suite, df, check))
        elif check.kind == "relationship":
            parent = tables.get(check.parent)
            if parent is None:
                parts.append(_constant(spark, name, suite, check, 1, f"table {check.parent} not found"))
            else:
                parts.append(_relationship(name, suite, df, check, parent))
        else:
            row_level.append(check)
    if row_level:
        parts.append(_fused(name, suite, df, row_level))
    return reduce(DataFrame.unionByName, parts)


def run_suites(
    spark: SparkSession, suites: Mapping[str, Suite], tables: Mapping[str, DataFrame | None]
) -> DataFrame:
    return reduce(DataFrame.unionByName, [run_suite(spark, n, s, tables) for n, s in suites.items()])


def failing_values(df: DataFrame, checks: Sequence[Check], rows: int = SAMPLE_ROWS) -> DataFrame:
    """(check, target, samples): for each row-level check up to ``rows`` different failing values as text, by hash.

    One aggregate for all checks: of every sixteenth of the hashes the smallest failing value is kept, so the
    buffer has a fixed size, however many rows fail.
    """
    lanes = [format(i, "x") for i in range(16)]
    row_level = [c for c in checks if c.fails is not None]
    aggregates, shown = [], []
    for i, check in enumerate(row_level):
        text = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in check.columns])
        keyed = F.when(F.coalesce(check.fails, F.lit(False)), F.concat(F.md5(text), text))
        aggregates += [F.min(F.when(keyed.startswith(lane), keyed)).alias(f"v{i}_{lane}") for lane in lanes]
        kept = F.slice(F.array_sort(F.array_compact(F.array(*[f"v{i}_{lane}" for lane in lanes]))), 1, rows)
        samples = F.transform(kept, lambda v: F.substr(v, F.lit(33)))
        shown.append(F.struct(F.lit(check.kind).alias("check"), F.lit(check.target).alias("target"), samples.alias("samples")))
    if not shown:
        return df.sparkSession.createDataFrame([], "check STRING, target STRING, samples ARRAY<STRING>")
    return df.agg(*aggregates).select(F.inline(F.array(*shown)))


def _with_samples(report: DataFrame, suites: Mapping[str, Suite], tables: Mapping[str, DataFrame | None], failed: set) -> DataFrame:
    """The report with samples for its failed row-level checks: one more scan of each table that has any."""
    parts = []
    for name, suite in suites.items():
        wanted = [c for c in suite.checks if (name, c.kind, c.target) in failed and c.fails is not None]
        if wanted:
            parts.append(failing_values(tables[suite.table], wanted).withColumn("suite", F.lit(name)))
    if not parts:
        return report.withColumn("samples", F.lit(None).cast("array<string>"))
    return report.join(reduce(DataFrame.unionByName, parts), ["suite", "check", "target"], "left").select(*report.columns, "samples")


class QualityFailure(RuntimeError):
    """A critical suite failed."""


def checkpoint(
    spark: SparkSession,
    suites: Mapping[str, Suite],
    tables: Mapping[str, DataFrame | None],
    run_id: str,
    results_path: str | None = None,
    only: str | None = None,
    fail_fast: bool = False,
) -> DataFrame:
    """Run suites, keep their results, with samples of failing values, as JSON under the run id and raise if a critical
    one failed.

    Suites run in order; with ``fail_fast`` the first failed critical suite ends the run.
    """
    chosen = {only: suites[only]} if only else dict(suites)
    groups = [{n: s} for n, s in chosen.items()] if fail_fast else [chosen]
    results: list[DataFrame] = []
    failed: set[str] = set()
    for group in groups:
        # One row per check: small by construction.
        rows = run_suites(spark, group, tables).collect()
        results.append(spark.createDataFrame(rows, RESULT_DDL))
        failed |= {r.suite for r in rows if r.critical and not r.success}
        if failed and fail_fast:
            break
    report = reduce(DataFrame.unionByName, results)
    bad = {(r.suite, r.check, r.target) for r in report.where("NOT success AND error IS NULL").collect()}
    report = _with_samples(report, chosen, tables, bad).withColumn("run_id", F.lit(run_id))
    if results_path:
        writer = report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("run_id").json(results_path)
    if failed:
        raise QualityFailure(f"critical suites failed: {', '.join(sorted(failed))}")
    return report


@dataclass(frozen=True)
class Freshness:
    """Age limits of a source in minutes, measured on ``column``."""

    column: str
    warn_minutes: int
    error_minutes: int


def freshness(sources: Mapping[str, DataFrame], rules: Mapping[str, Freshness], as_of: C.AsOf = None) -> DataFrame:
    """Verdict per source: pass, warn or error. A source without rows is an error."""

    def verdict(name: str, rule: Freshness) -> DataFrame:
        age = C.minutes_between(C.as_of_ts(as_of), F.col("newest"))
        status = (
            F.when(F.col("newest").isNull() | (age > rule.error_minutes), "error")
            .when(age > rule.warn_minutes, "warn")
            .otherwise("pass")
        )
        return (
            sources[name]
            .agg(F.max(rule.column).alias("newest"))
            .select(F.lit(name).alias("source"), "newest", age.alias("age_minutes"), status.alias("status"))
        )

    return reduce(DataFrame.unionByName, [verdict(n, r) for n, r in rules.items() if n in sources])
