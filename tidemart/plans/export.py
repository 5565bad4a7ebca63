"""Incremental export of weather rows as time-series points."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.dates import period_keys
from tidemart.operators import incremental as I
from tidemart.operators import timeseries as T
from tidemart.operators import write as W
from tidemart.sources.tables import exists, ordered_feed

# The measurement, its tag, the exported fields and the field that carries the watermark.
MEASUREMENT = "weather"
TAGS = {"location": "nyc"}
FIELDS = ("temperature_c", "feels_like_c", "precipitation_mm", "wind_speed_kmh", "humidity_pct", "weather_code", "is_rainy")
MARK_FIELD = "temperature_c"


def export_mark(spark: SparkSession, sink: str):
    """Newest exported instant, None for an empty or missing sink."""
    if not exists(spark, sink):
        return None
    done = spark.table(sink).where((F.col("measurement") == MEASUREMENT) & (F.col("field") == MARK_FIELD))
    return I.max_of(done, "time")


def export_points(weather: DataFrame, sink: str, time_col: str = "datetime", tags=None) -> int:
    """Write the points of rows newer than the sink; returns how many. A point is its series and
    second: one written again (times are cut to seconds, so the newest row can come back) replaces
    itself. Points are partitioned by month, so each run and every panel read few files."""
    spark, tags = weather.sparkSession, tags or TAGS
    rows = I.increment_since(weather, export_mark(spark, sink), time_col)
    points = T.to_points(rows, MEASUREMENT, tags, FIELDS, time_col, unique=True)
    points = period_keys(points, "time").persist()
    try:
        if not exists(spark, sink):
            return W.append(points, sink, ["year", "month"])
        n = points.count()
        if n:
            W.merge_upsert(points, sink, ["measurement", *tags, "time", "field"])
        return n
    finally:
        points.unpersist()


def feed(weather: DataFrame, since=None, time_col: str = "datetime") -> DataFrame:
    """The rows an outside reader would pull, oldest first."""
    return ordered_feed(weather, [time_col, *FIELDS], time_col, since)
