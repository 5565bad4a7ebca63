"""Sums and means that do not depend on the order in which partitions arrive.

A sum of doubles changes in its last bits with the merge order, and a later ``round`` can turn
that into a visible difference between two runs (or after a lost executor). Values are therefore
added as two longs, whole units and billionths of a unit: exact to nine decimals, which makes amounts and stored
means decimals again, still a plain hash aggregate with map-side combine, and rounded once, at the end.

That holds for groups of values below LARGE. A group with a larger one, an infinity or a NaN gets the plain sum of doubles, which is infinite
or NaN accordingly, and so do means of values all below SMALL, which billionths would round away. For sums without error
whatever the values see :mod:`tidemart.operators.sums`."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: 2**40: a million of the largest values, or any number of usual ones, add up within a long.
LARGE = "1099511627776D"
SMALL = "0.0001D"


def _most(c: str, where: str) -> str:
    return f"max(abs(CAST({c} AS DOUBLE))) FILTER (WHERE {where})"


def total(c: str, where: str = "TRUE") -> str:
    """SQL text of the sum of ``c`` over the rows ``where`` holds and that are below LARGE, as a decimal of nine places; null for no values."""
    x = f"CAST({c} AS DOUBLE)"
    only = f"FILTER (WHERE ({where}) AND abs({x}) < {LARGE})"
    whole = f"sum(CAST(floor({x}) AS BIGINT)) {only}"
    rest = f"sum(CAST(round(({x} - floor({x})) * 1000000000D) AS BIGINT)) {only}"
    return f"(CAST({whole} AS DECIMAL(19,0)) + CAST({rest} AS DECIMAL(19,0)) * 0.000000001BD)"


def decimal_sum(c: str) -> Column:
    """The sum before it is rounded, a decimal of nine places, of values known to be below LARGE."""
    return F.expr(total(c))


def exact_sum(c: str, digits: int = 2) -> Column:
    """Sum of an expression, rounded half up to ``digits`` decimals; null for no values."""
    return F.expr(f"CASE WHEN {_most(c, 'TRUE')} >= {LARGE} THEN round(sum(CAST({c} AS DOUBLE)), {digits}) ELSE CAST(round({total(c)}, {digits}) AS DOUBLE) END")


def exact_avg(c: str, where: str = "TRUE") -> Column:
    """Mean of an expression over the rows ``where`` holds, not rounded; null for no values."""
    most = _most(c, where)
    return F.expr(f"""CASE WHEN {most} >= {LARGE} OR ({most} < {SMALL} AND {most} > 0D) THEN avg(CAST({c} AS DOUBLE)) FILTER (WHERE {where})
        ELSE try_divide(CAST(CAST({total(c, where)} * 1000000000BD AS DECIMAL(38,0)) AS DOUBLE) / 1000000000D, count({c}) FILTER (WHERE {where})) END""")


def rounded_avg(c: str, digits: int) -> Column:
    """Mean of an expression rounded half up to ``digits`` decimals; null for no values."""
    mean = f"CAST(round(try_divide({total(c)}, CAST(count({c}) AS DECIMAL(20,0))), {digits}) AS DOUBLE)"
    return F.expr(f"CASE WHEN {_most(c, 'TRUE')} >= {LARGE} THEN round(avg(CAST({c} AS DOUBLE)), {digits}) ELSE {mean} END")


def half_up_mean(num: str, den: str, digits: int) -> Column:
    """``num / den`` of a decimal sum and a count (SQL text) rounded half up; null when ``den`` is 0 or null."""
    return F.expr(f"CAST(round(try_divide({num}, CAST({den} AS DECIMAL(20,0))), {digits}) AS DOUBLE)")


def half_up_ratio(num: str, den: str, digits: int) -> Column:
    """``num / den`` of two long expressions (SQL text) rounded half away from zero to ``digits``
    decimals, computed in integers so that ties never depend on binary fractions. Null when
    ``den`` is 0 or null."""
    ten = 10 ** digits
    limit = (1 << 61) // ten
    return F.expr(f"""
        CASE WHEN {den} = 0 THEN NULL
             WHEN {num} BETWEEN 0 AND {limit} AND {den} < {limit}
               THEN (({num}) * {2 * ten}L + {den}) div (2 * ({den})) / {ten}D
             -- negative, or so large that the scaled numerator would pass the long range
             ELSE CAST(round(CAST({num} AS DECIMAL(20,0)) / CAST({den} AS DECIMAL(20,0)), {digits}) AS DOUBLE)
        END""")
