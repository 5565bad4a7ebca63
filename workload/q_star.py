"""The stored star as a whole: its 57 checks, verification counts, roles; year ranges and streams by interval."""
from dataclasses import replace
from functools import reduce

from pyspark.sql import functions as F

from tidemart.functions.casts import rename_map
from tidemart.operators import write as W
from tidemart.operators.clean import in_years
from tidemart.operators.measures import pearson
from tidemart.plans import contracts as C
from tidemart.plans import gold, silver, suites
from tidemart.plans.model import ROLES
from tidemart.plans.refresh import Config, verify
from tidemart.session import work_database, work_path
from tidemart.streaming import twins
from workload import standins as S
from workload.q_quality import _DUP, _GE, _NULLS, _ORPH, _RANGE, _ROWS, _SET, _line
from workload.registry import query

_DAYS = f"""dim_date AS (SELECT {S.date_key('d')} AS date_key, d AS date, month(d) AS month, isodow(d) AS day_of_week FROM (
  SELECT CAST(unnest(generate_series(make_date(lo, 1, 1)::TIMESTAMP, make_date(hi, 12, 31)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT min(y)::INTEGER AS lo, max(y)::INTEGER AS hi FROM (SELECT year(o_orderdate) AS y FROM orders UNION ALL SELECT year(ts) FROM events))))"""


# ---- the 57 checks ---------------------------------------------------------------------------

_TABLES = f"""WITH {S.V_TRIPFACT}, {S.V_AIRFACT}, {S.V_GDP}, {S.V_WEATHER}, {_DAYS},
silver_trips AS (SELECT pickup AS pickup_datetime, pu_zone AS pu_location_id, do_zone AS do_location_id, fare_amount, trip_distance,
  CAST(passenger_count AS INTEGER) AS payment_type FROM v_clean),
silver_measurements AS (SELECT ts AS datetime, parameter, value FROM v_mclean),
silver_locations AS (SELECT *, country_name AS country_id FROM v_station), silver_gdp AS (SELECT * FROM v_gdp),
silver_fx_rates AS (SELECT d AS date, rate AS usd_eur_rate FROM v_fx), silver_weather AS (SELECT * FROM v_weather),
dim_zone AS (SELECT *, location_id AS zone_key FROM v_zone), dim_fx AS (SELECT fx_key, d AS date, rate AS usd_eur_rate FROM v_dimfx),
dim_gdp AS (SELECT *, row_number() OVER (ORDER BY country_code, year) AS gdp_key FROM v_gdp),
fact_trip_daily AS (SELECT * FROM trip_fact), fact_measure_daily AS (SELECT * FROM air_fact)
"""


def _bad(table, name, cond, text=_GE):
    return _line(table, name, f"count(*) FILTER (WHERE {cond})", text)


def _null(table, col, text=_NULLS):
    return _bad(table, f"{col} not null", f"{col} IS NULL", text)


def _within(table, col, lo, hi):
    return _bad(table, f"{col} in [{lo}, {hi}]", f"{col} < {lo} OR {col} > {hi}")


def _once(table, col):
    return _line(table, f"{col} unique", "dup", _GE, _DUP(table, col))


def _lost(table, col, parent):
    return _line(table, f"FK {col} -> {parent}.{col}", "count(*)", _ORPH, f"FROM {table} WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT {col} FROM {parent})")


def _least(table, n):
    return _line(table, f"row count >= {n:,}", f"greatest({n} - count(*), 0)", _ROWS)


def _listed(values):
    return ", ".join(f"'{v}'" for v in values)


_RATE = "usd_eur_rate <= 0 OR usd_eur_rate > 5"
_STAR = _TABLES + " UNION ALL ".join([
    *[_null("silver_trips", c) for c in ("pickup_datetime", "pu_location_id", "do_location_id", "fare_amount")],
    _bad("silver_trips", "trip_distance in [0.01, 100]", "trip_distance < CAST(0.01 AS DOUBLE) OR trip_distance > 100", _RANGE),
    _bad("silver_trips", "fare_amount in [0.01, 10000]", "fare_amount < CAST(0.01 AS DOUBLE) OR fare_amount > 10000", _RANGE),
    _bad("silver_trips", "payment_type in set (7 values)", "payment_type NOT BETWEEN 0 AND 6", _SET), _least("silver_trips", 1000),
    *[_null("silver_measurements", c) for c in ("datetime", "parameter", "value")],
    _bad("silver_measurements", "value in [0, None]", "value < 0", _RANGE),
    _bad("silver_measurements", f"parameter in set ({len(suites.POLLUTANTS)} values)", f"parameter NOT IN ({_listed(suites.POLLUTANTS)})", _SET), _least("silver_measurements", 1),
    _null("silver_locations", "location_id", _GE), _null("silver_locations", "country_id", _GE),
    _within("silver_locations", "latitude", -90, 90), _within("silver_locations", "longitude", -180, 180), _once("silver_locations", "location_id"),
    _null("silver_gdp", "country_code", _GE), _bad("silver_gdp", "gdp_usd > 0", "gdp_usd <= 0"), _within("silver_gdp", "year", 1960, 2030),
    _null("silver_fx_rates", "date", _GE), _once("silver_fx_rates", "date"), _bad("silver_fx_rates", "usd_eur_rate in (0, 5]", _RATE),
    _null("silver_weather", "datetime", _GE), _within("silver_weather", "temperature_c", -30, 50), _within("silver_weather", "precipitation_mm", 0, 200),
    _within("silver_weather", "wind_speed_kmh", 0, 200), _within("silver_weather", "humidity_pct", 0, 100), _within("silver_weather", "weather_code", 0, 99),
    _once("dim_date", "date_key"), _null("dim_date", "date", _GE), _within("dim_date", "month", 1, 12), _within("dim_date", "day_of_week", 1, 7),
    _once("dim_zone", "zone_key"), _null("dim_zone", "location_id", _GE),
    _bad("dim_zone", "borough in expected set", f"borough NOT IN ({_listed(suites.BOROUGHS)})"),
    _bad("dim_zone", "service_zone in expected set", f"service_zone NOT IN ({_listed(suites.SERVICE_ZONES)})"),
    _once("dim_fx", "fx_key"), _once("dim_fx", "date"), _bad("dim_fx", "usd_eur_rate in (0, 5]", _RATE),
    _once("dim_gdp", "gdp_key"), _bad("dim_gdp", "gdp_usd > 0", "gdp_usd <= 0"),
    _null("fact_trip_daily", "date_key"), _null("fact_trip_daily", "zone_key"),
    _bad("fact_trip_daily", "trip_count in [0, None]", "trip_count < 0", _RANGE), _bad("fact_trip_daily", "total_fare_usd in [0, None]", "total_fare_usd < 0", _RANGE),
    _lost("fact_trip_daily", "date_key", "dim_date"), _lost("fact_trip_daily", "zone_key", "dim_zone"), _least("fact_trip_daily", 1),
    *[_null("fact_measure_daily", c) for c in ("date_key", "location_id", "parameter")],
    _bad("fact_measure_daily", "avg_value in [0, None]", "avg_value < 0", _RANGE), _lost("fact_measure_daily", "date_key", "dim_date"), _least("fact_measure_daily", 1)])


def _star(spark, d):
    return {
        "silver_trips": lambda: S.trips(spark, d).withColumn("payment_type", F.col("passenger_count").cast("int")),
        "silver_measurements": lambda: S.measurements(spark, d),
        "silver_locations": lambda: S.stations(spark, d).withColumn("country_id", F.col("country_name")),
        "silver_gdp": lambda: silver.gdp(S.raw_gdp(spark, d)), "silver_fx_rates": lambda: silver.fx_rates(S.raw_fx(spark, d)),
        "silver_weather": lambda: rename_map(S.raw_weather(spark, d), silver.WEATHER_RENAMES),
        "dim_date": lambda: gold.dim_date(spark, *S.years_of(spark, d)), "dim_zone": lambda: S.dim_zone(spark, d), "dim_fx": lambda: S.dim_fx(spark, d),
        "dim_gdp": lambda: gold.dim_gdp(silver.gdp(S.raw_gdp(spark, d)), 1e6),
        "fact_trip_daily": lambda: S.trip_fact(spark, d), "fact_measure_daily": lambda: S.air_fact(spark, d)}


@query("suite_star", _STAR)
def suite_star(spark, d):
    """All checks of the library over the star of the stand-ins; minimum row counts at a hundred-thousandth."""
    parts = suites.table_suites(_star(spark, d), 1e-5)
    return reduce(lambda a, b: a.unionByName(b), [make() for make in parts.values()])


@query("verify_counts", f"""WITH {S.V_TRIPFACT}, {S.V_AIRFACT}, {_DAYS}
SELECT 'trip_nulls' AS what, 'rows' AS value, count(*) AS n FROM trip_fact
UNION ALL SELECT 'trip_nulls', 'no_zone', count(*) FILTER (WHERE zone_key IS NULL) FROM trip_fact
UNION ALL SELECT 'trip_nulls', 'no_rate', count(*) FILTER (WHERE fx_key IS NULL) FROM trip_fact
UNION ALL SELECT 'trip_years', CAST(date_key // 10000 AS VARCHAR), count(*) FROM trip_fact GROUP BY 2
UNION ALL SELECT 'air_parameters', parameter, count(*) FROM air_fact GROUP BY 2
UNION ALL SELECT 'weekend_days', CAST(day_of_week >= 6 AS VARCHAR), count(*) FROM dim_date GROUP BY 2
UNION ALL SELECT 'boroughs', borough, count(*) FROM v_zone GROUP BY 2""")
def verify_counts(spark, d):
    """The counts to look at after a load, over stored tables."""
    db, star = work_database(spark, "verify"), _star(spark, d)
    for c in (C.TRIP_FACT, C.AIR_FACT, C.DIM_DATE, C.DIM_ZONE):
        W.write_full(star[c.name](), f"{db}.{c.name}")
    v = verify(spark, Config(db, "", 0, 0))
    parts = [v["trip_nulls"].selectExpr("'trip_nulls' AS what", "stack(3, 'rows', `rows`, 'no_zone', no_zone, 'no_rate', no_rate) AS (value, n)")]
    parts += [v[k].selectExpr(f"'{k}' AS what", f"CAST({c} AS STRING) AS value", "`count` AS n")
              for k, c in (("trip_years", "year"), ("air_parameters", "parameter"), ("weekend_days", "is_weekend"), ("boroughs", "borough"))]
    return reduce(lambda a, b: a.unionByName(b), parts)


# ---- roles, ranges, moments ------------------------------------------------------------------

#: Regions in the role of service zones.
_SERVICE = {"AFRICA": "Airports", "AMERICA": "EWR", "ASIA": "Boro Zone", "EUROPE": "Yellow Zone"}


@query("roles_all", f"""WITH {S.V_TRIPFACT}, z AS (SELECT location_id, CASE service_zone {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in _SERVICE.items())} ELSE service_zone END AS service_zone FROM v_zone),
r(role, seen) AS (VALUES ('Admin', NULL), ('Airports Operator', 'Airports'), ('EWR Operator', 'EWR'), ('Green Cab Dispatcher', 'Boro Zone'), ('Yellow Cab Dispatcher', 'Yellow Zone'))
SELECT role, service_zone, sum(trip_count)::BIGINT AS total_trips FROM trip_fact LEFT JOIN z ON zone_key = location_id JOIN r ON seen IS NULL OR seen = service_zone GROUP BY ALL""")
def roles_all(spark, d):
    """What each of the five roles sees of one fact."""
    m = S.model(spark, d)
    model = replace(m, tables=m.tables.replaced(zone=m.tables["zone"].replace(_SERVICE, subset=["service_zone"])), roles=ROLES)
    return reduce(lambda a, b: a.unionByName(b), [
        model.as_role(r).evaluate(["total_trips"], [("zone", "service_zone")]).withColumn("role", F.lit(r)) for r in ROLES])


@query("year_range_filter", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) BETWEEN 1993 AND 1996")
def year_range_filter(spark, d):
    return in_years(S.table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year")), 1993, 1996)


@query("pearson_large_offset", "SELECT event_type, round(corr(value, value + event_id % 7), 6) AS r FROM events GROUP BY 1")
def pearson_large_offset(spark, d):
    """An offset of 10^9 does not change a correlation."""
    e = S.table(spark, d, "events").select("event_type", (F.col("value") + 1e9).alias("x"), (F.col("value") + F.col("event_id") % 7).alias("y"))
    return e.groupBy("event_type").agg(F.round(pearson("x", "y"), 6).alias("r"))


# ---- streams ---------------------------------------------------------------------------------

@query("stream_upsert_latest", "SELECT event_id, event_type, value + 5 AS value, 5 AS version FROM events")
def stream_upsert_latest(spark, d):
    """Six versions of each key, two in each of three runs over one checkpoint: the newest stays."""
    t, ck, base = f"{work_database(spark, 'latest')}.t", work_path(spark, "ck"), work_path(spark, "landing")
    e = S.table(spark, d, "events").select("event_id", "event_type", "value")
    for k in range(3):
        two = e.withColumn("version", F.explode(F.array(F.lit(2 * k + 1), F.lit(2 * k))))
        two.withColumn("value", F.col("value") + F.col("version")).write.mode("append").parquet(base)
        s = twins.file_stream(spark, base, two.schema)
        twins.start(s, ck, twins.upsert_sink(t, ["event_id"], ["version DESC"], ["event_type"])).awaitTermination()
        spark.catalog.refreshTable(t)
    return spark.table(t)


@query("stream_interval", "SELECT event_id, value FROM events")
def stream_interval(spark, d):
    """The same sink at a fixed interval, stopped once everything landed is stored."""
    t, base = f"{work_database(spark, 'interval')}.t", work_path(spark, "landing")
    e = S.table(spark, d, "events")
    e.write.parquet(base)
    s = twins.file_stream(spark, base, e.schema).select("event_id", "value")
    q = twins.start(s, work_path(spark, "ck"), twins.append_sink(t), interval="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.table(t).drop("epoch")
