"""Date and time columns."""
from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_key(c: str) -> Column:
    """``yyyymmdd`` of a date expression as an int."""
    return F.expr(f"year({c}) * 10000 + month({c}) * 100 + day({c})")


def year_of_key(c: str) -> Column:
    """Year of a ``yyyymmdd`` key by integer division."""
    return F.expr(f"CAST({c} div 10000 AS INT)")


def key_to_date(key: int) -> date:
    return date(key // 10000, key // 100 % 100, key % 100)


def date_to_key(d: date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def lookback_key(max_key: int, days: int) -> int:
    """The ``yyyymmdd`` key ``days`` days before ``max_key``."""
    return date_to_key(key_to_date(max_key) - timedelta(days=days))


# day of week, 1 = Monday … 7 = Sunday (Spark's weekday counts Monday as 0)
MONDAY_FIRST = "weekday({}) + 1"


def period_keys(df: DataFrame, time_col: str) -> DataFrame:
    """Add the ``year`` and ``month`` partition columns taken from ``time_col``."""
    kept = [f"`{c}`" for c in df.columns if c not in ("year", "month")]
    return df.selectExpr(*kept, f"year({time_col}) AS year", f"month({time_col}) AS month")


def month_index(year: Column | int, month: Column | int):
    """Months since year 0: one comparable number for a (year, month) pair."""
    return year * 12 + month


def wall_clock(c: Column | str) -> Column:
    """Zone-less timestamp to instant; under the fixed UTC session the wall clock stays."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp")


def minutes_between(start: str, end: str) -> Column:
    return F.try_divide(F.unix_seconds(F.col(end).cast("timestamp"))
                        - F.unix_seconds(F.col(start).cast("timestamp")), F.lit(60))


def recent_months(today: date) -> list[tuple[int, int]]:
    """Previous and current month of ``today``, in that order."""
    last = today.replace(day=1) - timedelta(days=1)
    return [(last.year, last.month), (today.year, today.month)]
