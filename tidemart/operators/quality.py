"""Declarative data-quality checks: one aggregate pass per table plus one small plan per
uniqueness or foreign-key check."""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.joins import orphans

RESULT = "`table` STRING, name STRING, passed BOOLEAN, observed STRING"


@dataclass(frozen=True)
class Check:
    """``bad`` counts violations in the shared pass; ``plan`` gives them as a one-row frame.
    ``wording`` formats the observed text from the columns ``bad`` and ``total``."""
    name: str
    wording: str
    bad: Callable[[], Column] | None = None
    plan: Callable[[DataFrame, Mapping[str, DataFrame]], DataFrame] | None = None


def not_null(col: str, name: str | None = None, wording: str = "nulls") -> Check:
    return Check(name or f"{col} not null", wording, lambda: F.count_if(F.col(col).isNull()))


def in_range(col: str, lo=None, hi=None, strict_min: bool = False, name: str | None = None,
             wording: str = "range") -> Check:
    """Nulls pass."""
    def bad():
        tests = []
        if lo is not None:
            tests.append(F.col(col) <= lo if strict_min else F.col(col) < lo)
        if hi is not None:
            tests.append(F.col(col) > hi)
        return F.count_if(reduce(lambda a, b: a | b, tests, F.lit(False)))
    return Check(name or f"{col} in [{lo}, {hi}]", wording, bad)


def in_set(col: str, allowed: Sequence, name: str | None = None, wording: str = "set") -> Check:
    """Nulls pass."""
    return Check(name or f"{col} in set ({len(allowed)} values)", wording,
                 lambda: F.count_if(F.col(col).isNotNull() & ~F.col(col).isin(list(allowed))))


def min_rows(n: int) -> Check:
    return Check(f"row count >= {n:,}", "actual",
                 lambda: F.greatest(F.lit(n) - F.count(F.lit(1)), F.lit(0)))


def unique(col: str, name: str | None = None, wording: str = "rows") -> Check:
    """Nulls are ignored; every member of a duplicate group counts as a failure."""
    def plan(df, _):
        groups = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n")).where("n > 1")
        return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("bad"))
    return Check(name or f"{col} unique", wording, plan=plan)


def foreign_key(col: str, parent: str, parent_col: str) -> Check:
    """Null children pass. ``parent`` names a frame given to :func:`suite_results`."""
    def plan(df, parents):
        lost = orphans(df, col, parents[parent], parent_col)
        return lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("bad"))
    return Check(f"FK {col} -> {parent}.{parent_col}", "orphans", plan=plan)


def _commas(c: Column) -> Column:
    return F.format_number(c, 0)


def _observed(wording: Column) -> Column:
    bad, total = F.col("bad"), F.col("total")
    # The observed texts of each kind of check.
    return (F.when(wording == "nulls", F.concat(_commas(bad), F.lit(" nulls")))
            .when(wording == "range", F.concat(_commas(bad), F.lit(" rows outside range")))
            .when(wording == "set", F.concat(_commas(bad), F.lit(" rows with disallowed values")))
            .when(wording == "orphans", F.concat(_commas(bad), F.lit(" orphans")))
            .when(wording == "actual", F.concat(F.lit("actual: "), _commas(total)))
            .when(bad == 0, F.concat(_commas(total), F.lit(" rows OK")))
            .otherwise(F.concat(_commas(bad), F.lit(" / "), _commas(total), F.lit(" rows failed"))))


def suite_results(df: DataFrame, table: str, checks: Sequence[Check],
                  parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``(table, name, passed, observed)``, one row per check."""
    shared = [(i, c) for i, c in enumerate(checks) if c.bad is not None]
    apart = [(i, c) for i, c in enumerate(checks) if c.plan is not None]
    parts = [df.agg(F.count(F.lit(1)).alias("total"), *[c.bad().cast("bigint").alias(f"c{i}") for i, c in shared])]
    parts += [c.plan(df, parents or {}).select(F.col("bad").cast("bigint").alias(f"c{i}")) for i, c in apart]
    # one-row frames: stacked and folded into one row, which needs no join
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    counts = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    rows = counts.select("total", F.inline(F.array(*[
        F.struct(F.lit(c.name).alias("name"), F.lit(c.wording).alias("wording"), F.col(f"c{i}").alias("bad"))
        for i, c in enumerate(checks)])))
    return rows.select(F.lit(table).alias("table"), "name", (F.col("bad") == 0).alias("passed"),
                       _observed(F.col("wording")).alias("observed"))


def summary(results: DataFrame) -> DataFrame:
    """Checks, passed and failed per table."""
    return results.groupBy("table").agg(
        F.count("*").alias("checks"), F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"))


def run_suites(spark: SparkSession, suites: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """Run each suite by itself; one that fails becomes a failed row instead of ending the report.
    Only the finished check rows, a handful per suite, come to the driver."""
    rows = []
    for name, make in suites.items():
        try:
            rows += [tuple(r) for r in make().collect()]
        except Exception as exc:  # noqa: BLE001  any failure is reported as a row
            first = str(exc).splitlines()[0] if str(exc) else ""
            rows.append((name, "suite execution", False, f"error: {type(exc).__name__}: {first}"))
    return spark.createDataFrame(rows, RESULT)


def report_lines(results: DataFrame) -> DataFrame:
    """Ordered text lines: one per table with the share of its checks that hold, then one for each that does not."""
    tables = summary(results).select(
        "table", F.lit(0).alias("level"), F.lit("").alias("name"),
        F.concat(F.when(F.col("failed") == 0, "pass  ").otherwise("FAIL  "), "table", F.lit(": "), F.col("passed").cast("string"), F.lit(" of "), F.col("checks").cast("string")).alias("line"))
    failed = results.where(~F.col("passed")).select("table", F.lit(1).alias("level"), "name", F.concat(F.lit("      "), "name", F.lit(" <- "), "observed").alias("line"))
    return tables.unionByName(failed).orderBy("table", "level", "name").select("line")


def report(results: DataFrame, now: datetime | None = None) -> str:
    """The report as one text. ``results`` holds finished check rows (see :func:`run_suites`)."""
    t = summary(results).agg(F.count("*").alias("tables"), F.sum("checks").alias("checks"),
                             F.sum("passed").alias("passed"), F.sum("failed").alias("failed")).first()
    n = {k: v or 0 for k, v in t.asDict().items()}
    at = (now or datetime.now(timezone.utc)).isoformat(" ", "minutes")
    head = f"{n['passed']} of {n['checks']} checks hold in {n['tables']} tables, {n['failed']} fail ({at})"
    return "\n".join([head, *[r["line"] for r in report_lines(results).collect()]])
