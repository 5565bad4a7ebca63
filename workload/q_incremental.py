"""Incremental runs: watermarks, ledgers, tails, modes."""
import datetime as dt

from pyspark.sql import functions as F

from tidemart.functions.dates import date_key
from tidemart.operators import incremental as I
from tidemart.operators import write as W
from tidemart.operators.clean import first_per_key
from tidemart.plans import contracts as C
from tidemart.plans import gold, silver
from tidemart.session import work_database, work_path
from tidemart.sources import parquet_drift as P
from workload import standins as S
from workload.registry import query

_DAY20 = dt.datetime(2024, 1, 20)


@query("watermark_state", """SELECT 'ts' AS of, CAST(epoch_us(max(ts)) AS BIGINT) AS high, CAST(epoch_us(min(ts)) AS BIGINT) AS low FROM events
UNION ALL SELECT 'missing', NULL, NULL UNION ALL SELECT 'years', CAST(max(year(o_orderdate)) AS BIGINT), CAST(min(year(o_orderdate)) AS BIGINT) FROM orders""")
def watermark_state(spark, d):
    """Stored maxima and spans; a missing table has none."""
    db = work_database(spark, "marks")
    e = S.table(spark, d, "events").select(F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    W.write_full(e, f"{db}.t")
    lo, hi = I.span_of(S.table(spark, d, "orders").select(F.year("o_orderdate").alias("y")), "y")
    rows = [("ts", I.watermark(spark, f"{db}.t", "us"), I.span_of(spark.table(f"{db}.t"), "us")[0]),
            ("missing", I.watermark(spark, f"{db}.gone", "us"), None), ("years", hi, lo)]
    return spark.createDataFrame(rows, "of STRING, high BIGINT, low BIGINT")


def _readings(spark, d, db, parts=3):
    """The silver readings loaded in increments; each run reads only rows after the stored maximum."""
    raw = S.raw_measurements(spark, d)
    t = f"{db}.{C.MEASUREMENTS.name}"
    for cut in (_DAY20, dt.datetime(2024, 1, 25, 12), None)[:parts]:
        landed = raw if cut is None else raw.where(F.col("datetime") < F.lit(cut))
        new = silver.measurements(I.increment_since(landed, I.watermark(spark, t, "datetime"), "datetime"), S.POLLUTANTS, S.FACTORS)
        if I.run_mode(spark, t, False) == "full":
            W.write_range(new, t, C.MEASUREMENTS.parts, *I.span_of(new, "year"), merge_schema=True)
        else:
            W.merge_insert(new, t, C.MEASUREMENTS.keys)
    return t


@query("incremental_equals_full", f"""WITH {S.V_MCLEAN}
SELECT location_id, parameter, epoch_us(ts) AS ts_us, round(value, 4) AS value, units FROM v_mclean""")
def incremental_equals_full(spark, d):
    """Three increments give what one full load gives."""
    t = _readings(spark, d, work_database(spark, "incr"))
    return spark.table(t).select("location_id", "parameter", F.unix_micros("datetime").alias("ts_us"), F.round("value", 4).alias("value"), "units")


@query("increment_lookback", """SELECT event_id, CAST(value AS DOUBLE) AS value FROM events WHERE ts >= TIMESTAMP '2024-01-20' - INTERVAL 2 DAY""")
def increment_lookback(spark, d):
    return I.increment_since(S.table(spark, d, "events"), _DAY20, "ts", lookback_days=2).select("event_id", "value")


@query("increment_from_text", """SELECT event_id, value FROM events WHERE ts > TIMESTAMP '2024-01-20' AND event_id % 10 <> 0""")
def increment_from_text(spark, d):
    """Instants kept as text, some unreadable: those are never newer than the watermark."""
    e = S.table(spark, d, "events").withColumn("ts", F.when(F.col("event_id") % 10 == 0, F.lit("??")).otherwise(F.col("ts").cast("string")))
    return I.increment_since(e, _DAY20, "ts").select("event_id", "value")


@query("reaggregate_tail", f"WITH {S.V_AIRFACT} SELECT {S.AIR_COLS} FROM air_fact")
def reaggregate_tail(spark, d):
    """The fact is built up to day 20; late rows of the days before then arrive together with the rest.
    Building the last seven days again brings the fact to the full result."""
    t = f"{work_database(spark, 'tail')}.fact"
    full, st = S.measurements(spark, d), S.stations(spark, d)
    day = F.to_date("datetime")
    late = (day >= dt.date(2024, 1, 14)) & (F.col("location_id") % 4 == 0)
    early = full.where((day <= dt.date(2024, 1, 20)) & ~late)
    W.write_full(gold.air_fact(early, st), t, C.AIR_FACT.parts)
    cut_key, cut = I.tail_cutoff(I.watermark(spark, t, "date_key"), 7)
    new = gold.air_fact(I.tail_of(full, cut, "datetime"), st)
    from tidemart.operators.clean import keep_outside
    W.replace_slice(new, t, keep_outside("date_key", cut_key), lambda s: int(s["year"]) >= cut.year)
    return spark.table(t)


@query("reaggregate_frames", f"WITH {S.V_TRIPFACT} SELECT {S.TRIP_COLS} FROM trip_fact")
def reaggregate_frames(spark, d):
    """Same on frames: a fact whose last days are wrong, repaired from the source. Trips and dimensions are evaluated once, and the fact
    is not built for its newest day, which the trips tell."""
    fx, zone, trips = (W.once(df).frame for df in (S.dim_fx(spark, d), S.dim_zone(spark, d), S.trips(spark, d)))
    build = lambda df: gold.trip_fact(df, fx, zone)
    fact = build(trips)
    newest = I.max_of(trips.select(date_key("pickup_datetime").alias("k")), "k")
    cut_key, _ = I.tail_cutoff(newest, 7)
    stale = fact.withColumn("trip_count", F.when(F.col("date_key") >= cut_key, F.lit(0).cast("bigint")).otherwise(F.col("trip_count")))
    return I.reaggregated(stale, trips, build, "pickup_datetime", newest=newest)


@query("unread_files", """SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 2000""")
def unread_files(spark, d):
    """Files are chosen by the period in their path and by the ledger of files read: the second run reads
    only new ones, a third reads none."""
    db, base = work_database(spark, "ledger"), work_path(spark, "drop")
    o = S.table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"),
                                           F.date_format("o_orderdate", "yyyy-01").alias("period"))
    t, ledger = f"{db}.orders", f"{db}.file_ledger"

    def run():
        files = P.files_for_years(P.list_files(spark, base), 1996, 2000, column="path")
        todo, n = I.new_files(spark, files, ledger, "orders")
        if n:
            W.append(P.read_drifting(spark, P.generations(spark, P.file_units(todo)), {}, {"o_orderkey": "bigint"}), t)
            I.record_run(todo, ledger, "orders", I.next_run(spark, ledger, "orders"))

    o.where("year <= 1998").write.partitionBy("period").parquet(base)
    run()
    o.where("year > 1998").write.mode("append").partitionBy("period").parquet(base)
    run()
    run()
    return spark.table(t)


@query("recent_months", """SELECT event_type, count(*) AS n FROM events, (SELECT max(ts) AS now FROM events)
WHERE date_trunc('month', ts) >= date_trunc('month', now) - INTERVAL 1 MONTH GROUP BY 1""")
def recent_months(spark, d):
    e = S.table(spark, d, "events").withColumns({"year": F.year("ts"), "month": F.month("ts")})
    today = I.max_of(e.select(F.to_date("ts").alias("day")), "day")
    return I.in_recent_months(e, today).groupBy("event_type").agg(F.count("*").alias("n"))


@query("skip_if_current", """SELECT 'first' AS run, 'loaded' AS outcome, count(*) AS rows FROM orders UNION ALL
SELECT 'same', 'skipped', count(*) FROM orders UNION ALL SELECT 'changed', 'loaded', count(*) FROM orders WHERE o_orderstatus <> 'P'""")
def skip_if_current(spark, d):
    t = f"{work_database(spark, 'skip')}.t"
    o = S.table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    rows = []
    for name, src in (("first", o), ("same", o), ("changed", o.where("o_orderstatus <> 'P'"))):
        have = spark.table(t).count() if spark.catalog.tableExists(t) else 0
        if I.is_current(src.count(), have):
            rows.append((name, "skipped", have))
        else:
            rows.append((name, "loaded", W.write_full(src, t)))
    return spark.createDataFrame(rows, "run STRING, outcome STRING, rows BIGINT")


@query("mode_switch", """SELECT 'missing' AS situation, 'full' AS mode, count(*) > 0 AS loads, count(*) AS rows, 0::BIGINT AS before FROM events
UNION ALL SELECT 'filled', 'incremental', count(*) FILTER (WHERE event_type = 'error') > 0, count(*) FILTER (WHERE event_type = 'error'), count(*) FROM events
UNION ALL SELECT 'forced', 'full', count(*) > 0, count(*), count(*) FROM events
UNION ALL SELECT 'no new rows', 'incremental', count(*) FILTER (WHERE value < -1e9) > 0, count(*) FILTER (WHERE value < -1e9), count(*) FROM events""")
def mode_switch(spark, d):
    """How each situation is run, whether there is something to load, rows of the source and rows stored before."""
    t = f"{work_database(spark, 'mode')}.t"
    e = S.table(spark, d, "events").select("event_id", "ts", "event_type", "value")
    out = []
    for name, force, src in (("missing", False, e), ("filled", False, e.where("event_type = 'error'")), ("forced", True, e), ("no new rows", False, e.where("value < -1e9"))):
        before = spark.table(t).count() if spark.catalog.tableExists(t) else 0
        mode = I.run_mode(spark, t, force)
        out.append((name, mode, I.guard_source(src, mode, "events"), src.count(), before))
        if name == "missing":
            W.write_full(src, t)
    return spark.createDataFrame(out, "situation STRING, mode STRING, loads BOOLEAN, rows BIGINT, before BIGINT")


@query("period_list", "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders")
def period_list(spark, d):
    return I.period_list(S.table(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")))


@query("resent_rows", """SELECT event_id, max(value) AS value FROM events GROUP BY 1""")
def resent_rows(spark, d):
    """Rows sent again by a later run are suppressed by key."""
    t = f"{work_database(spark, 'resent')}.t"
    e = S.table(spark, d, "events").select("event_id", "value")
    W.append(e.where("event_id % 3 = 0"), t)
    W.merge_insert(first_per_key(e.unionByName(e), ["event_id"]), t, ["event_id"])
    return spark.table(t)
