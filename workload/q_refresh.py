"""The refresh over landed driver tables: one full run, and increments that must end in the same tables."""
import datetime as dt

from pyspark.sql import functions as F

from tidemart.operators import incremental as I
from tidemart.operators import keys
from tidemart.operators import write as W
from tidemart.plans import contracts as C
from tidemart.plans import gold, silver
from tidemart.plans.refresh import Config, refresh
from tidemart.session import work_database, work_path
from workload import landing as L
from workload import standins as S
from workload.registry import query

_OUT = "part STRING, day INT, key BIGINT, label STRING, a DOUBLE, b DOUBLE, c DOUBLE, n BIGINT"
_SQL = f"""WITH {L.TRIP_FACT}, {L.STATION}, {L.READINGS}, {L.WEATHER}
SELECT 'trips' AS part, date_key AS day, CAST(zone_key AS BIGINT) AS key, CAST(d AS VARCHAR) AS label, total_fare_usd AS a, total_fare_eur AS b, avg_trip_duration_min AS c, trip_count AS n
FROM trip_fact LEFT JOIN v_dimfx USING (fx_key)
UNION ALL SELECT 'air', {S.date_key('day')}, location_id, parameter || ' ' || location_name || ' ' || country_name,
  {S.half_up('total', '(n::HUGEINT * 1000000000)', 4)}, max_value, min_value, n FROM v_air_day JOIN v_station USING (location_id)
UNION ALL SELECT 'weather', {S.date_key('hr')}, hour(hr), NULL, t, wind, NULL, NULL FROM v_hour"""


def _tables(spark, cfg):
    """The facts and the clean weather in one shape; rate keys, which depend on when a rate came, are shown as their day."""
    t = lambda c: spark.table(cfg.table(c.name))
    trips = t(C.TRIP_FACT).join(t(C.DIM_FX).select("fx_key", "date"), "fx_key", "left").select(
        F.lit("trips"), "date_key", F.col("zone_key").cast("bigint"), F.col("date").cast("string"), "total_fare_usd", "total_fare_eur", "avg_trip_duration_min", "trip_count")
    air = t(C.AIR_FACT).select(F.lit("air"), "date_key", "location_id", F.concat_ws(" ", "parameter", "city", "country"), "avg_value", "max_value", "min_value", "measurement_count")
    at = F.col("datetime")
    weather = t(C.WEATHER).select(F.lit("weather"), F.year(at) * 10000 + F.month(at) * 100 + F.day(at), F.hour(at).cast("bigint"), F.lit(None).cast("string"),
                                  "temperature_c", "wind_speed_kmh", F.lit(None).cast("double"), F.lit(None).cast("bigint"))
    names = [c.split()[0] for c in _OUT.split(", ")]
    return trips.toDF(*names).unionByName(air.toDF(*names)).unionByName(weather.toDF(*names))


def _config(spark, base, name, **more):
    return Config(work_database(spark, name), base, *L.YEARS, today=dt.date(2024, 1, 31), **more)


@query("refresh_full", _SQL)
def refresh_full(spark, d):
    base = work_path(spark, "landing")
    L.land(spark, d, base, (1, 2))
    cfg = _config(spark, base, "full", force_refresh=True)
    refresh(spark, cfg)
    return _tables(spark, cfg)


@query("refresh_increments", _SQL)
def refresh_increments(spark, d):
    """Two drops and a run without news: a future trip and reading come first, then an older file, late trips in a newer file, late readings,
    late rates and a corrected hour."""
    base = work_path(spark, "landing")
    cfg = _config(spark, base, "increments")
    for drops in ((1,), (2,), ()):
        if drops:
            L.land(spark, d, base, drops)
        refresh(spark, cfg)
    return _tables(spark, cfg)


@query("rebuild_one_day", f"""WITH {S.V_TRIPFACT}
SELECT {S.TRIP_COLS}, 1 AS days, (SELECT count(*) FROM trip_fact WHERE date_key = (SELECT min(date_key) FROM trip_fact WHERE year = 1997)) AS built,
(SELECT count(*) FROM trip_fact WHERE year = 1997) AS written FROM trip_fact""")
def rebuild_one_day(spark, d):
    """Trips of one day of 1997 arrive after the fact was built up to 2001: that day is built again, its year rewritten, no other touched.
    Trips and dimensions are evaluated once; of dimensions in files Spark knows the size before it shuffles the fact for them."""
    db = work_database(spark, "oneday")
    trips, fx, zone = (W.once(df).frame for df in (S.trips(spark, d), S.dim_fx(spark, d), S.dim_zone(spark, d)))
    source, fact = f"{db}.trips", f"{db}.fact"
    day = trips.where("year = 1997").agg(F.min(F.to_date("pickup_datetime"))).first()[0]
    late = F.to_date("pickup_datetime") == F.lit(day)
    build = lambda df: gold.trip_fact(df, fx, zone)
    W.append(trips.where(~late), source, C.TRIPS.parts)
    W.write_full(build(spark.table(source)), fact, C.TRIP_FACT.parts)
    _, days = W.merge_insert_touching(trips.where(late), source, C.TRIPS.keys, F.to_date("pickup_datetime"))
    done = I.rebuild_days(fact, spark.table(source), days, build, "pickup_datetime")
    return spark.table(fact).withColumns({"days": F.lit(done["days"]), "built": F.lit(done["built"]).cast("bigint"), "written": F.lit(done["written"]).cast("bigint")})


_KEYS = """keyed AS (SELECT CAST(row_number() OVER (ORDER BY day(d) % 7 = 3, d) AS INTEGER) AS fx_key, d, rate FROM v_fx)"""


@query("dim_rate_increment", f"""WITH {S.V_FX}, {_KEYS} SELECT fx_key, {S.date_key('d')} AS date_key, d AS date, rate AS usd_eur_rate FROM keyed""")
def dim_rate_increment(spark, d):
    """Rates of some days are published after the others: known days keep their keys, the late ones follow the largest; a third run changes nothing."""
    registry = f"{work_database(spark, 'keys')}.fx_keys"
    rates = silver.fx_rates(S.raw_fx(spark, d))
    for part in (rates.where("dayofmonth(date) % 7 <> 3"), rates, rates):
        dim = gold.dim_fx(part, registry)
    return dim


@query("gdp_keys_stay", f"""WITH {S.V_GDP}, k AS (SELECT row_number() OVER (ORDER BY year > 1997, country_code, year) AS n, * FROM v_gdp)
SELECT CAST(n AS INTEGER) AS gdp_key, country_code, year FROM k""")
def gdp_keys_stay(spark, d):
    """A two-part natural key: the years up to 1997 first, the others later, from a registry of their own run."""
    registry = f"{work_database(spark, 'keys')}.gdp_keys"
    gdp = silver.gdp(S.raw_gdp(spark, d)).select("country_code", "year")
    for part in (gdp.where("year <= 1997"), gdp):
        keyed = keys.registered_keys(part, registry, ["country_code", "year"], "gdp_key", "country_code")
    return keyed.select("gdp_key", "country_code", "year")


@query("late_rates", f"""WITH {S.V_TRIPFACT} SELECT date_key, zone_key, d AS rate_day, total_fare_usd, total_fare_eur, trip_count
FROM trip_fact LEFT JOIN v_dimfx USING (fx_key)""")
def late_rates(spark, d):
    """The fact was built without the rates of some days; when they come, exactly these days are built again and no key of a built day moves."""
    db = work_database(spark, "laterates")
    source, fact, registry = f"{db}.trips", f"{db}.fact", f"{db}.fx_keys"
    rates, zone = silver.fx_rates(S.raw_fx(spark, d)), S.dim_zone(spark, d)
    W.append(S.trips(spark, d), source, C.TRIPS.parts)
    known = W.once(gold.dim_fx(rates.where("dayofmonth(date) % 7 <> 3"), registry)).frame
    W.write_full(gold.trip_fact(spark.table(source), known, zone), fact, C.TRIP_FACT.parts)
    full = W.once(gold.dim_fx(rates, registry)).frame
    days = {r[0] for r in full.select("date").exceptAll(known.select("date")).collect()}
    I.rebuild_days(fact, spark.table(source), days, lambda df: gold.trip_fact(df, full, zone), "pickup_datetime")
    return (spark.table(fact).join(full.select("fx_key", F.col("date").alias("rate_day")), "fx_key", "left")
            .select("date_key", "zone_key", "rate_day", "total_fare_usd", "total_fare_eur", "trip_count"))


@query("run_mark_increment", f"""WITH {S.V_MCLEAN}
SELECT location_id, parameter, epoch_us(ts) AS ts_us, round(value, 4) AS value, units, 0 AS files_of_other_runs FROM v_mclean""")
def run_mark_increment(spark, d):
    """Raw rows carry the number of their run as a partition. Each increment opens the files of the runs not taken yet and no others; a future day
    comes first, late ones last."""
    db = work_database(spark, "marks")
    log, t, marks = f"{db}.raw", f"{db}.{C.MEASUREMENTS.name}", f"{db}.run_marks"
    raw = S.raw_measurements(spark, d)
    last = raw.agg(F.max("datetime")).first()[0].date()
    day = F.to_date("datetime")
    first = (day == F.lit(last)) | ((F.dayofmonth(day) <= 20) & (F.dayofmonth(day) != 14))
    others = 0
    for run, part in enumerate((raw.where(first), raw.where(~first & (F.dayofmonth(day) > 14)), raw.where(~first & (F.dayofmonth(day) <= 14))), 1):
        W.append(part.withColumns({"year": F.year("datetime"), "ingest_run": F.lit(run).cast("bigint")}), log, ["year", "ingest_run"])
        fresh = spark.table(log).where(F.col("ingest_run") > I.consumed(spark, marks, "clean"))
        others += sum(f"ingest_run={run}/" not in f for f in fresh.inputFiles())
        clean = silver.measurements(fresh, S.POLLUTANTS, S.FACTORS)
        if I.run_mode(spark, t, False) == "full":
            W.append(clean, t, C.MEASUREMENTS.parts)
        else:
            W.merge_insert(clean, t, C.MEASUREMENTS.keys)
        I.mark_consumed(spark, marks, "clean", run)
    return spark.table(t).select("location_id", "parameter", F.unix_micros("datetime").alias("ts_us"), F.round("value", 4).alias("value"), "units",
                                 F.lit(others).alias("files_of_other_runs"))
