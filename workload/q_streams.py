"""Streaming twins, run to the end of the landed files."""
import datetime as dt

from pyspark.sql import functions as F

from tidemart.functions.exact import exact_avg
from tidemart.functions.dates import period_keys
from tidemart.session import work_database, work_path
from tidemart.streaming import twins
from workload import standins as S
from workload.registry import query


def _landed(spark, d):
    """Events landed as one folder with one file per ten days, in time order."""
    base = work_path(spark, "landing")
    e = S.table(spark, d, "events")
    for lo, hi in ((1, 11), (11, 21), (21, 32)):
        e.where(F.dayofmonth("ts").between(lo, hi - 1)).coalesce(1).write.mode("append").parquet(base)
    return base, e.schema


def _stream(spark, d, batches=None):
    base, schema = _landed(spark, d)
    return twins.file_stream(spark, base, schema, files_per_batch=batches)


@query("stream_upsert", """SELECT event_id, user_id, event_type, value, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month FROM events""")
def stream_upsert(spark, d):
    """File stream, one file per batch, into a keyed table."""
    t = f"{work_database(spark, 'upserts')}.t"
    s = period_keys(_stream(spark, d, 1), "ts").select("event_id", "user_id", "event_type", "value", "year", "month")
    twins.start(s, work_path(spark, "ck"), twins.upsert_sink(t, ["event_id"], ["value DESC"], ["year", "month"])).awaitTermination()
    return spark.table(t)


@query("stream_insert", """SELECT user_id, event_type, CAST(dayofmonth(ts) AS INTEGER) AS day, count(*) AS n FROM events GROUP BY ALL""")
def stream_insert(spark, d):
    """Insert-only stream; the same files offered to a second query with another checkpoint add nothing."""
    t = f"{work_database(spark, 'inserts')}.t"
    base, schema = _landed(spark, d)
    for _ in range(2):
        s = twins.file_stream(spark, base, schema, files_per_batch=2).withColumn("day", F.to_date("ts"))
        twins.start(s, work_path(spark, "ck"), twins.insert_sink(t, ["event_id"], ["day"])).awaitTermination()
    return spark.table(t).groupBy("user_id", "event_type", F.dayofmonth("ts").alias("day")).agg(F.count("*").alias("n"))


@query("stream_window", f"""SELECT event_type, epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) // 1000000 AS start_s, {S.fixed_avg('value')} AS mean_value, count(*) AS n
FROM events GROUP BY 1, 2""")
def stream_window(spark, d):
    """Hourly means in update mode, upserted by window and type: the table ends as the batch result."""
    t = f"{work_database(spark, 'windows')}.t"
    s = twins.event_time(_stream(spark, d, 1), "ts", "7 days")
    w = s.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(exact_avg("value").alias("mean_value"), F.count("*").alias("n"))
    w = w.select("event_type", F.unix_seconds("w.start").alias("start_s"), "mean_value", "n", F.to_date("w.start").alias("day"))
    twins.start(w, work_path(spark, "ck"), twins.upsert_sink(t, ["event_type", "start_s"], ["n DESC"], ["day"]), mode="update").awaitTermination()
    return spark.table(t).drop("day")


@query("stream_tail", f"""SELECT CAST(ts AS DATE) AS day, user_id, event_type, count(*) AS n, {S.fixed_sum('value', 4)} AS total FROM events GROUP BY ALL""")
def stream_tail(spark, d):
    """Daily fact kept current by late rows: update mode, upsert by day and keys."""
    from tidemart.functions.exact import exact_sum
    t = f"{work_database(spark, 'tails')}.t"
    daily = twins.daily_tail(_stream(spark, d, 2), "ts", ["user_id", "event_type"], [F.count("*").alias("n"), exact_sum("value", 4).alias("total")])
    twins.start(daily, work_path(spark, "ck"), twins.upsert_sink(t, ["day", "user_id", "event_type"], ["n DESC"], ["day"]), mode="update").awaitTermination()
    return spark.table(t)


@query("stream_dedup", """SELECT event_id, value FROM events""")
def stream_dedup(spark, d):
    """Every file is landed twice; the stream keeps the first arrival of each key."""
    t = f"{work_database(spark, 'dedups')}.t"
    base, schema = _landed(spark, d)
    S.table(spark, d, "events").coalesce(1).write.mode("append").parquet(base)
    s = twins.deduplicated(twins.file_stream(spark, base, schema), ["event_id"], "ts", "7 days").select("event_id", "value")
    twins.start(s, work_path(spark, "ck"), twins.append_sink(t)).awaitTermination()
    return spark.table(t).drop("epoch")


@query("stream_resume", """SELECT event_id, value FROM events""")
def stream_resume(spark, d):
    """Two runs over one checkpoint: the second reads only the files landed since."""
    t, ck, base = f"{work_database(spark, 'resumes')}.t", work_path(spark, "ck"), work_path(spark, "landing")
    e = S.table(spark, d, "events")
    for cond in (F.col("ts") < F.lit(dt.datetime(2024, 1, 16)), F.col("ts") >= F.lit(dt.datetime(2024, 1, 16))):
        e.where(cond).write.mode("append").parquet(base)
        s = twins.file_stream(spark, base, e.schema).select("event_id", "value")
        twins.start(s, ck, twins.append_sink(t)).awaitTermination()
    return spark.table(t).drop("epoch")
