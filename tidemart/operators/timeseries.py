"""Time-window rollups, latest points, and the export form of wide rows."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.exact import exact_avg, exact_sum
from tidemart.operators.clean import first_per_key


def last_days(df: DataFrame, time_col: str, now, days: int) -> DataFrame:
    """``now - days <= time < now``; ``now`` is passed in so that a run can be repeated."""
    t = F.col(time_col)
    upper = F.lit(now)
    return df.where((t >= upper - F.expr(f"INTERVAL {int(days)} DAYS")) & (t < upper))


def long_form(df: DataFrame, ids: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row per non-null field value; booleans and integers become doubles."""
    wide = df.select(*ids, *[F.col(f).cast("double").alias(f) for f in fields])
    return wide.unpivot(list(ids), list(fields), "field", "value").where("value IS NOT NULL")


def window_rollup(df: DataFrame, time_col: str, every: str, fields: Sequence[str], fn: str,
                  start=None, stop=None, by: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Tumbling windows aligned to the epoch: ``(time, field, value)``, ``time`` being the window
    end, cut at ``stop``. Windows without a value do not appear. The range ``[start, stop)`` is
    filtered before windowing so it reaches the scan. Sums are rounded to ``digits``, means are not. Works on a stream as well."""
    if start is not None:
        df = df.where(F.col(time_col) >= F.lit(start))
    if stop is not None:
        df = df.where(F.col(time_col) < F.lit(stop))
    agg = {"mean": exact_avg, "sum": lambda f: exact_sum(f, digits)}[fn]
    # wide aggregation first (one pass, one exchange), then the few result rows are turned
    rolled = df.groupBy(F.window(time_col, every).alias("w"), *by).agg(
        *[agg(f).alias(f) for f in fields])
    end = F.col("w.end")
    if stop is not None:
        end = F.least(end, F.lit(stop).cast("timestamp"))
    return long_form(rolled.withColumn("time", end), ["time", *by], fields)


def latest_per_series(df: DataFrame, series: Sequence[str], time_col: str,
                      take: Sequence[str]) -> DataFrame:
    """The newest row of each series; equal instants are decided by the taken columns, the largest first, nulls last.

    The newest instant of a series is a maximum of fixed width, a hash aggregate that Spark combines in the map tasks; a second pass over the
    input picks the rows of these instants, and only they are ranked."""
    newest = df.groupBy(*series).agg(F.max(time_col).alias("__newest"))
    same = F.expr(" AND ".join([*(f"r.`{c}` <=> n.`{c}`" for c in series), f"r.`{time_col}` <=> n.__newest"]))
    rows = df.select(*dict.fromkeys([*series, time_col, *take])).alias("r").join(newest.alias("n"), same, "left_semi")
    order = [f"`{c}` DESC NULLS LAST" for c in take if c not in series]
    return first_per_key(rows, series, order).select(*series, *dict.fromkeys([time_col, *take]))


def latest_rows(df: DataFrame, order: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(order).desc(), *ties).limit(n)


def to_points(df: DataFrame, measurement: str, tags: Mapping[str, str], fields: Sequence[str],
              time_col: str, unique: bool = False) -> DataFrame:
    """Wide rows to ``(measurement, <tags>, time, field, value)`` at second precision; null fields
    give no point; a zone-less time is read as UTC. With ``unique`` a series has one point per
    second, the value of its latest row, as a time-series store would keep it."""
    at = F.col(time_col).cast("timestamp")
    base = df.select(F.lit(measurement).alias("measurement"), *[F.lit(v).alias(k) for k, v in tags.items()],
                     F.date_trunc("second", at).alias("time"), at.alias("__at"), *fields)
    ids = ["measurement", *tags, "time"]
    points = long_form(base, [*ids, "__at"], fields)
    if unique:
        # of rows at one instant the largest value; both steps are hash aggregates
        points = points.groupBy(*ids, "field", "__at").agg(F.max("value").alias("value"))
        return points.groupBy(*ids, "field").agg(F.max_by("value", "__at").alias("value"))
    return points.drop("__at")


def to_lines(df: DataFrame, measurement: str, tags: Mapping[str, str], fields: Sequence[str],
             time_col: str) -> DataFrame:
    """Wide rows to one text line each: ``measurement,tag=v f1=1.5,f2=3i,f3=true seconds``.
    Integers carry an ``i``, booleans are words; rows without any field are left out."""
    types = dict(df.dtypes)

    def item(f: str) -> Column:
        v = F.col(f).cast("string")
        v = F.concat(v, F.lit("i")) if types[f] in ("int", "bigint", "smallint", "tinyint") else v
        return F.concat(F.lit(f"{f}="), v)

    head = F.lit(",".join([measurement, *[f"{k}={v}" for k, v in tags.items()]]))
    body = F.concat_ws(",", *[item(f) for f in fields])
    secs = F.unix_seconds(F.col(time_col).cast("timestamp")).cast("string")
    return (df.select(head.alias("h"), body.alias("b"), secs.alias("s")).where("b <> ''")
            .select(F.concat_ws(" ", "h", "b", "s").alias("value")))
