"""Row filters and deduplication."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _all(conds) -> Column:
    return reduce(lambda a, b: a & b, conds)


def require(df: DataFrame, *cols: str) -> DataFrame:
    """Drop rows with a null in any listed column."""
    return df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in cols))


def sane_range(c: str, upper: float) -> Column:
    """``0 < c <= upper``; null and NaN do not pass."""
    return F.expr(f"{c} > 0 AND {c} <= {upper}")


def strictly_positive(c: str) -> Column:
    """``c > 0``; NaN, which compares above every number, does not pass."""
    return (F.col(c) > 0) & ~F.isnan(c)


def within_box(lat: str, lon: str, box: tuple[float, float, float, float]) -> Column:
    """Inside ``(lat_min, lat_max, lon_min, lon_max)``, bounds included."""
    return F.col(lat).between(box[0], box[1]) & F.col(lon).between(box[2], box[3])


def active_between(df: DataFrame, lo, hi, first: str = "datetime_first",
                   last: str = "datetime_last") -> DataFrame:
    """Rows whose activity interval meets ``[lo, hi]``. A null bound is open; a frame without
    the two columns passes whole. Text bounds are parsed leniently."""
    if first not in df.columns or last not in df.columns:
        return df
    t = lambda c: F.col(c).try_cast("timestamp") if dict(df.dtypes)[c] == "string" else F.col(c)
    return df.where((F.col(first).isNull() | (t(first) <= F.lit(hi)))
                    & (F.col(last).isNull() | (t(last) >= F.lit(lo))))


def year_bounds(start: int, end: int) -> tuple[datetime, datetime]:
    return datetime(start, 1, 1), datetime(end, 12, 31, 23, 59, 59)


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Drop rows in which every field is null or empty text. Empty text itself becomes null."""
    text = {c for c, t in df.dtypes if t == "string"}
    df = df.select([F.nullif(F.col(c), F.lit("")).alias(c) if c in text else F.col(c) for c in df.columns])
    return df.na.drop(how="all")


def keep_outside(key: str, lo: int, hi: int | None = None) -> Column:
    """Keep-predicate of a slice replacement: keys before ``lo`` or after ``hi``. A null key
    satisfies neither and is dropped, as in SQL."""
    c = F.col(key) < lo
    return c if hi is None else c | (F.col(key) > hi)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first in ``order`` (SQL text such as ``"at DESC"``), then by every other
    column, nulls first, so the survivor is the same in every run.

    Spark evaluates the rank filter below the exchange too (a group limit in each map task), so
    at most one row per key and task is shuffled and a hot key does not pile up in one task."""
    cols = df.columns
    by = [*order, *[f"`{c}`" for c in cols if c not in keys]] or ["1"]
    part = ", ".join(f"`{k}`" for k in keys)
    ranked = df.selectExpr("*", f"row_number() OVER (PARTITION BY {part} ORDER BY {', '.join(by)}) AS __rank")
    return ranked.where("__rank = 1").drop("__rank")


def in_years(df: DataFrame, start: int, end: int, col: str = "year") -> DataFrame:
    return df.where(F.col(col).between(start, end))


def role_predicate(rules: Mapping[str, object]) -> Column:
    """Equality rules of a role as one condition; no rules means unrestricted."""
    return _all([F.col(c) == F.lit(v) for c, v in rules.items()]) if rules else F.lit(True)
