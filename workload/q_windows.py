"""Time windows, latest rows, feeds and export forms."""
import datetime as dt

from pyspark.sql import functions as F

from tidemart.operators import timeseries as T
from tidemart.sources.tables import ordered_feed
from workload import standins as S
from workload.registry import query

_NOW = "(SELECT max(ts) FROM events)"


def _now(spark, d):
    """The newest instant of the data stands for the clock, so that a run can be repeated."""
    return S.table(spark, d, "events").agg(F.max("ts")).first()[0]


def _seconds(c):
    return F.unix_seconds(F.col(c).cast("timestamp"))


@query("window_mean", f"""SELECT event_type, epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) // 1000000 + 3600 AS end_s, 'value' AS field,
{S.fixed_avg('value')} AS value FROM events GROUP BY 1, 2""")
def window_mean(spark, d):
    r = T.window_rollup(S.table(spark, d, "events"), "ts", "1 hour", ["value"], "mean", by=["event_type"])
    return r.select("event_type", _seconds("time").alias("end_s"), "field", "value")


@query("window_sum", f"""SELECT LEAST(epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) // 1000000 + 3600, epoch_us(TIMESTAMP '2024-01-20 06:30:00') // 1000000) AS end_s,
'value' AS field, {S.fixed_sum('value', 4)} AS value FROM events
WHERE ts >= TIMESTAMP '2024-01-05 03:15:00' AND ts < TIMESTAMP '2024-01-20 06:30:00' GROUP BY 1""")
def window_sum(spark, d):
    r = T.window_rollup(S.table(spark, d, "events"), "ts", "1 hour", ["value"], "sum",
                        dt.datetime(2024, 1, 5, 3, 15), dt.datetime(2024, 1, 20, 6, 30))
    return r.select(_seconds("time").alias("end_s"), "field", "value")


@query("last_7d", f"""SELECT event_id, user_id, event_type, value FROM events
WHERE ts >= {_NOW} - INTERVAL 7 DAY AND ts < {_NOW}""")
def last_7d(spark, d):
    return T.last_days(S.table(spark, d, "events"), "ts", _now(spark, d), 7).select("event_id", "user_id", "event_type", "value")


@query("latest_per_series", """SELECT user_id, event_type, epoch_us(ts) AS ts_us, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def latest_per_series(spark, d):
    r = T.latest_per_series(S.table(spark, d, "events"), ["user_id", "event_type"], "ts", ["event_id", "value"])
    return r.withColumn("ts_us", F.unix_micros(F.col("ts").cast("timestamp"))).drop("ts")


@query("latest_n", "SELECT event_id, epoch_us(ts) AS ts_us, value FROM events ORDER BY ts DESC, event_id LIMIT 10")
def latest_n(spark, d):
    return T.latest_rows(S.table(spark, d, "events"), "ts", 10, ["event_id"]).select(
        "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "value")


@query("ordered_feed", "SELECT epoch_us(ts) AS ts_us, event_id, value FROM events WHERE ts > TIMESTAMP '2024-01-15' ORDER BY ts, event_id")
def feed(spark, d):
    e = S.table(spark, d, "events")
    rows = ordered_feed(e, ["ts", "event_id", "value"], "ts", dt.datetime(2024, 1, 15), ties=["event_id"])
    return rows.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "event_id", "value")


_FIELDS = ["temperature_c", "feels_like_c", "precipitation_mm", "wind_speed_kmh", "humidity_pct", "weather_code", "is_rainy"]
_PT = lambda f: (f"SELECT 'weather' AS measurement, 'city' AS location, epoch_us(datetime) // 1000000 AS time_s, '{f}' AS field, "  # noqa: E731
                 f"CAST({f} AS DOUBLE) AS value FROM w WHERE {f} IS NOT NULL")


def _weather(spark, d):
    from tidemart.functions.casts import rename_map
    from tidemart.plans.silver import WEATHER_RENAMES
    w = rename_map(S.raw_weather(spark, d), WEATHER_RENAMES)
    return w.withColumn("is_rainy", F.col("precipitation_mm") > 0)


@query("points_long", f"WITH {S.V_WEATHER}, w AS (SELECT *, precipitation_mm > 0 AS is_rainy FROM v_weather) " + " UNION ALL ".join(_PT(f) for f in _FIELDS))
def points_long(spark, d):
    p = T.to_points(_weather(spark, d), "weather", {"location": "city"}, _FIELDS, "datetime")
    return p.select("measurement", "location", F.unix_seconds("time").alias("time_s"), "field", "value")


_INT = lambda f: f"CASE WHEN {f} IS NULL THEN NULL ELSE '{f}=' || CAST({f} AS BIGINT) || 'i' END"


@query("points_text", f"""WITH {S.V_WEATHER}, w AS (SELECT *, precipitation_mm > 0 AS is_rainy FROM v_weather)
SELECT 'weather,location=city ' || concat_ws(',', {_INT('weather_code')}, 'is_rainy=' || CAST(is_rainy AS VARCHAR)) || ' ' || (epoch_us(datetime) // 1000000) AS value FROM w""")
def points_text(spark, d):
    return T.to_lines(_weather(spark, d), "weather", {"location": "city"}, ["weather_code", "is_rainy"], "datetime")


_LAST = lambda f: (f"SELECT 'weather' AS measurement, 'city' AS location, epoch_us(datetime) // 1000000 AS time_s, '{f}' AS field, "  # noqa: E731
                   f"arg_max(CAST({f} AS DOUBLE), datetime) AS value FROM w WHERE {f} IS NOT NULL GROUP BY 3")


@query("weather_export", f"WITH {S.V_WEATHER}, w AS (SELECT *, precipitation_mm > 0 AS is_rainy FROM v_weather) " + " UNION ALL ".join(_LAST(f) for f in _FIELDS))
def weather_export(spark, d):
    """Points written in three runs, each from the sink's newest instant; one point per series and second."""
    from tidemart.plans.export import export_points
    from tidemart.session import work_database
    sink = f"{work_database(spark, 'points')}.points"
    w = _weather(spark, d)
    for part in (w.where(F.col("datetime") < F.lit(dt.datetime(2024, 1, 12))), w, w):
        export_points(part, sink, tags={"location": "city"})
    return spark.table(sink).select("measurement", "location", F.unix_seconds("time").alias("time_s"), "field", "value")
