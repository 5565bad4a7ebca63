"""Measures over a star model, and the comparisons built on them."""
from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.exact import exact_avg, exact_sum
from tidemart.functions.labels import yoy_label


@dataclass(frozen=True)
class Measure:
    """An aggregate over one table of the model."""
    name: str
    table: str
    expr: Callable[[], Column]


def additive(name: str, table: str, col: str, digits: int | None = None) -> Measure:
    """Sum; whole numbers when ``digits`` is None."""
    return Measure(name, table, lambda: F.sum(col) if digits is None else exact_sum(col, digits))


def mean_of_means(name: str, table: str, col: str) -> Measure:
    """Unweighted mean of a stored daily mean."""
    return Measure(name, table, lambda: exact_avg(col))


def filtered_mean(name: str, table: str, col: str, on: str, value: str) -> Measure:
    return Measure(name, table, lambda: exact_avg(col, f"{on} = '{value}'"))


def filtered_max(name: str, table: str, col: str, on: str, value: str) -> Measure:
    return Measure(name, table, lambda: F.expr(f"max({col}) FILTER (WHERE {on} = '{value}')"))


def ratio_percent(part: Column | str, whole: Column | str) -> Column:
    """``part / whole * 100``; null when the whole is zero or missing."""
    part, whole = (F.col(c) if isinstance(c, str) else c for c in (part, whole))
    return F.try_divide(part, whole) * 100


def join_on(frames: Sequence[DataFrame], keys: Sequence[str], how: str = "outer") -> DataFrame:
    """Aggregates of different tables side by side on their grouping columns."""
    if not keys:
        # one row each: stack them and keep the value that is there, which needs no join
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    if how != "outer":
        return reduce(lambda a, b: a.join(b, list(keys), how), frames)
    # one row a key and frame: regrouping pairs null keys too, which a join never does
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in stacked.columns if c not in keys])


def year_over_year(df: DataFrame, measures: Sequence[str], year: str = "year",
                   by: Sequence[str] = (), prior: DataFrame | None = None,
                   labels: bool = False) -> DataFrame:
    """Relative change to the year before for each measure, as ``<measure>_yoy`` (and
    ``<measure>_yoy_label``); null without a row for that year.

    Every yearly row is sent to its own year and, as "previous", to the next one; one small
    regrouping then pairs them. That needs neither a second evaluation of the input nor a window
    over all years. ``prior`` supplies the previous-year values from a differently filtered
    frame; by default like is compared with like."""
    keep = ", ".join(measures)
    now = f"struct(CAST({year} AS INT) AS {year}, TRUE AS __here, {keep})"
    before = f"struct(CAST({year} + 1 AS INT) AS {year}, FALSE AS __here, {keep})"
    if prior is None:
        rows = df.selectExpr(*by, f"inline(array({now}, {before}))")
    else:
        rows = df.selectExpr(*by, f"inline(array({now}))").unionByName(prior.selectExpr(*by, f"inline(array({before}))"))
    paired = rows.groupBy(*by, year).agg(
        F.expr("bool_or(__here)").alias("__here"),
        *[F.expr(f"max({m}) FILTER (WHERE __here)").alias(m) for m in measures],
        *[F.expr(f"max({m}) FILTER (WHERE NOT __here)").alias(f"{m}_prev") for m in measures]).where("__here")
    changes = paired.selectExpr(*by, year, *measures, *[
        f"try_divide(CAST({m} - {m}_prev AS DOUBLE), CAST({m}_prev AS DOUBLE)) AS {m}_yoy" for m in measures])
    if labels:
        changes = changes.withColumns({f"{m}_yoy_label": yoy_label(f"{m}_yoy", year) for m in measures})
    return changes


def pearson(x: str, y: str) -> Column:
    """Correlation of two columns over rows where both are present; null when either has no
    variance or there is no pair. From central moments, which keep their digits far from zero; the built-in
    correlation raises on zero variance."""
    both = f"FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
    moment = lambda f, args: f"{f}({args}) {both}"
    a, b = f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)"
    return F.expr(f"try_divide({moment('covar_pop', f'{a}, {b}')}, {moment('stddev_pop', a)} * {moment('stddev_pop', b)})")
