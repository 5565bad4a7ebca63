"""The driver tables in the roles of trips, rates, zones, readings, stations and weather.

Each stand-in exists as a frame and as the SQL of the same rows."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.plans import gold, silver
from tidemart.plans.model import MEASURES, Model, Tables
from tidemart.operators.measures import filtered_max, filtered_mean

# limits that cut about a third of the line items
MAX_DISTANCE, MAX_FARE = 40, 90_000
# event types in the role of pollutants, two with a conversion factor
POLLUTANTS = ("click", "view", "error")
FACTORS = {"click": 1882.0, "view": 1962.0}
LIMITS = {"click": 7000.0, "view": 9500.0, "error": 8.0}


# stated schemas: no job is spent on reading footers before the plan is even built
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
                "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# ---- trips -----------------------------------------------------------------------------------

def raw_trips(spark, d) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("tpep_pickup_datetime"))
    li = table(spark, d, "lineitem")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        "tpep_pickup_datetime", F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("l_suppkey").alias("PULocationID"), (F.col("l_partkey") % 100).alias("DOLocationID"),
        F.col("l_quantity").alias("trip_distance"), F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_linenumber").cast("double").alias("passenger_count"))


def trips(spark, d) -> DataFrame:
    return silver.trips(raw_trips(spark, d), MAX_DISTANCE, MAX_FARE)


V_TRIPS = """v_trips AS (
  SELECT o_orderdate AS pickup, l_shipdate AS dropoff, l_suppkey AS pu_zone, l_partkey % 100 AS do_zone,
         l_quantity AS trip_distance, l_extendedprice AS fare_amount,
         CAST(l_linenumber AS DOUBLE) AS passenger_count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
V_CLEAN = V_TRIPS + f""", v_clean AS (
  SELECT * FROM v_trips
  WHERE trip_distance > 0 AND trip_distance <= {MAX_DISTANCE} AND fare_amount > 0 AND fare_amount <= {MAX_FARE}
  QUALIFY row_number() OVER (PARTITION BY pickup, dropoff, pu_zone, do_zone, fare_amount
                             ORDER BY trip_distance, passenger_count) = 1)"""


# ---- dimensions ------------------------------------------------------------------------------

def raw_fx(spark, d) -> DataFrame:
    day = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return day.where(F.weekday("date") < 5).withColumn(
        "usd_eur_rate", F.lit(0.80) + (F.dayofmonth("date") % 20) / F.lit(100.0))


def raw_zones(spark, d) -> DataFrame:
    s, n, r = (table(spark, d, t) for t in ("supplier", "nation", "region"))
    return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("s_suppkey").alias("location_id"), F.col("n_name").alias("borough"),
                    F.col("s_name").alias("zone"), F.col("r_name").alias("service_zone")))


def raw_gdp(spark, d) -> DataFrame:
    o, c, n = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    per = o.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    per = per.join(c, per.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return per.groupBy(F.col("n_name").alias("country_code"), "year").agg(
        (F.sum("cents") / F.lit(100.0)).alias("gdp_usd")).withColumn("country_name", F.upper("country_code"))


V_FX = """v_fx AS (
  SELECT d, CAST(0.80 AS DOUBLE) + (day(d) % 20) / CAST(100 AS DOUBLE) AS rate
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) WHERE isodow(d) <= 5)"""
V_DIMFX = V_FX + """, v_dimfx AS (
  SELECT CAST(row_number() OVER (ORDER BY d) AS INTEGER) AS fx_key, d, rate FROM v_fx)"""
V_ZONE = """v_zone AS (
  SELECT s_suppkey AS location_id, s_name AS zone_name, n_name AS borough, r_name AS service_zone
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
V_GDP = """v_gdp AS (
  SELECT n_name AS country_code, upper(n_name) AS country_name, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / CAST(100 AS DOUBLE) AS gdp_usd
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL)"""


# ---- readings --------------------------------------------------------------------------------

def k_of(df: DataFrame) -> DataFrame:
    return df.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def raw_measurements(spark, d) -> DataFrame:
    e = k_of(table(spark, d, "events"))
    return e.select(F.col("user_id").alias("location_id"), F.col("event_type").alias("parameter"),
                    F.col("ts").alias("datetime"), "value",
                    F.when(F.col("k") < 50, F.lit("ppm")).otherwise(F.lit("ugm3")).alias("units"))


def measurements(spark, d) -> DataFrame:
    return silver.measurements(raw_measurements(spark, d), POLLUTANTS, FACTORS)


def stations(spark, d) -> DataFrame:
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("location_id"), F.col("c_name").alias("location_name"),
        F.col("n_name").alias("country_name"), F.col("c_acctbal").alias("latitude"),
        (-F.col("c_acctbal")).alias("longitude")).where(F.col("location_id") % 5 != 0)


def raw_weather(spark, d, trunc: str | None = None) -> DataFrame:
    e = k_of(table(spark, d, "events"))
    t = F.date_trunc(trunc, F.col("ts")) if trunc else F.col("ts")
    return e.select(
        t.alias("datetime"), F.lit(40.5).alias("latitude"), F.lit(-74.0).alias("longitude"),
        F.col("value").alias("temperature_2m"), (F.col("value") - 2).alias("apparent_temperature"),
        F.when(F.col("event_type") == "view", F.lit(0.0)).when(F.col("k") == 7, F.lit(None))
        .otherwise(F.col("value")).alias("precipitation"),
        F.col("k").cast("double").alias("wind_speed_10m"), F.col("k").cast("double").alias("relative_humidity_2m"),
        F.col("k").cast("bigint").alias("weather_code"))


_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
V_MEAS = f"""v_meas AS (
  SELECT user_id AS location_id, event_type AS parameter, ts, value,
         CASE WHEN {_K} < 50 THEN 'ppm' ELSE 'ugm3' END AS units FROM events)"""
_LIST = ", ".join(f"'{p}'" for p in POLLUTANTS)
V_MCLEAN = V_MEAS + f""", v_mconv AS (
  SELECT location_id, parameter, ts,
         CASE WHEN units = 'ppm' AND parameter = 'click' THEN value * CAST(1882 AS DOUBLE)
              WHEN units = 'ppm' AND parameter = 'view' THEN value * CAST(1962 AS DOUBLE) ELSE value END AS value,
         CASE WHEN units = 'ppm' THEN 'µg/m³' ELSE units END AS units
  FROM v_meas WHERE parameter IN ({_LIST}) AND value > 0), v_mclean AS (
  SELECT * FROM v_mconv
  QUALIFY row_number() OVER (PARTITION BY location_id, parameter, ts ORDER BY value, units) = 1)"""
V_STATION = """v_station AS (
  SELECT c_custkey AS location_id, c_name AS location_name, n_name AS country_name, c_acctbal AS latitude,
         -c_acctbal AS longitude
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 5 <> 0)"""
V_WEATHER = f"""v_weather AS (
  SELECT ts AS datetime, value AS temperature_c, value - 2 AS feels_like_c,
         CASE WHEN event_type = 'view' THEN CAST(0 AS DOUBLE) WHEN {_K} = 7 THEN NULL ELSE value END AS precipitation_mm,
         CAST({_K} AS DOUBLE) AS wind_speed_kmh, CAST({_K} AS DOUBLE) AS humidity_pct,
         CAST({_K} AS BIGINT) AS weather_code FROM events)"""


# ---- exact arithmetic in SQL -----------------------------------------------------------------

def half_up(num: str, den: str, digits: int) -> str:
    """SQL for num / den of whole numbers, rounded half away from zero."""
    ten = 10 ** digits
    units = f"((abs({num}) * {2 * ten} + {den}) // (2 * {den}))"
    return (f"CASE WHEN {den} = 0 THEN NULL ELSE CAST(CASE WHEN {num} < 0 THEN -{units} ELSE {units} END "
            f"AS DOUBLE) / CAST({ten} AS DOUBLE) END")


def billionths(col: str, cond: str = "TRUE") -> str:
    """SQL for the sum in units of 10^-9, a HUGEINT."""
    x = f"CAST({col} AS DOUBLE)"
    return (f"(sum(CAST(floor({x}) AS BIGINT)) FILTER (WHERE {cond}) * 1000000000 + "
            f"sum(CAST(round(({x} - floor({x})) * 1000000000) AS BIGINT)) FILTER (WHERE {cond}))")


def fixed_sum(col: str, digits: int = 2) -> str:
    return half_up(billionths(col), "1000000000", digits)


def fixed_avg(col: str, cond: str = "TRUE") -> str:
    return (f"CAST({billionths(col, cond)} AS DOUBLE) / CAST(1000000000 AS DOUBLE) / "
            f"nullif(count({col}) FILTER (WHERE {cond}), 0)")


def date_key(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


V_TRIPFACT = ",\n".join([V_CLEAN, V_DIMFX, V_ZONE]) + f""", v_trip_day AS (
  SELECT CAST(pickup AS DATE) AS day, pu_zone, count(*) AS n, {billionths('fare_amount')} AS fare,
         sum(epoch_us(dropoff) // 1000000 - epoch_us(pickup) // 1000000) AS secs,
         {billionths('trip_distance')} AS dist, sum(passenger_count) AS pass
  FROM v_clean GROUP BY ALL), trip_fact AS (
  SELECT {date_key('day')} AS date_key, CAST(location_id AS INTEGER) AS zone_key, fx_key,
         n AS trip_count, {half_up('fare', '1000000000', 2)} AS total_fare_usd,
         CAST(((2 * ((fare * 2 + 10000000) // 20000000) * CAST(round(rate * 100) AS BIGINT) + 100) // 200) AS DOUBLE) / CAST(100 AS DOUBLE)
           AS total_fare_eur,
         {half_up('fare', '(n::HUGEINT * 1000000000)', 4)} AS avg_fare_usd,
         {half_up('secs', '(n * 60)', 4)} AS avg_trip_duration_min,
         {half_up('dist', '(n::HUGEINT * 1000000000)', 4)} AS avg_trip_distance_mi,
         CAST(floor(pass) AS BIGINT) AS total_passengers, CAST(year(day) AS INTEGER) AS year
  FROM v_trip_day LEFT JOIN v_dimfx ON day = d
  LEFT JOIN v_zone ON pu_zone = location_id)"""
V_AIRFACT = ",\n".join([V_MCLEAN, V_STATION]) + f""", v_air_day AS (
  SELECT CAST(ts AS DATE) AS day, location_id, parameter, count(*) AS n, {billionths('value')} AS total,
         round(max(value), 4) AS max_value, round(min(value), 4) AS min_value
  FROM v_mclean GROUP BY ALL), air_fact AS (
  SELECT {date_key('day')} AS date_key, location_id, location_name AS city, country_name AS country, latitude,
         longitude, parameter, {half_up('total', '(n::HUGEINT * 1000000000)', 4)} AS avg_value, max_value, min_value,
         n AS measurement_count, CAST(year(day) AS INTEGER) AS year
  FROM v_air_day LEFT JOIN v_station USING (location_id))"""
TRIP_COLS = ("date_key, zone_key, fx_key, trip_count, total_fare_usd, total_fare_eur, avg_fare_usd, "
             "avg_trip_duration_min, avg_trip_distance_mi, total_passengers, year")
AIR_COLS = ("date_key, location_id, city, country, latitude, longitude, parameter, avg_value, max_value, "
            "min_value, measurement_count, year")


# ---- the star --------------------------------------------------------------------------------

def dim_fx(spark, d) -> DataFrame:
    return gold.dim_fx(silver.fx_rates(raw_fx(spark, d)))


def dim_zone(spark, d) -> DataFrame:
    return gold.dim_zone(silver.zones(raw_zones(spark, d)))


def trip_fact(spark, d) -> DataFrame:
    return gold.trip_fact(trips(spark, d), dim_fx(spark, d), dim_zone(spark, d))


def air_fact(spark, d) -> DataFrame:
    return gold.air_fact(measurements(spark, d), stations(spark, d))


def years_of(spark, d) -> tuple[int, int]:
    """First and last year of orders and events; two numbers decide the length of the spine."""
    o = table(spark, d, "orders").select(F.year("o_orderdate").alias("y"))
    e = table(spark, d, "events").select(F.year("ts").alias("y"))
    row = o.unionByName(e).agg(F.min("y"), F.max("y")).first()
    return row[0], row[1]


# The two facts of the driver tables cover different years. Where a query joins them, readings are
# placed on the order calendar by a fixed shift of whole days.
SHIFT_DAYS = 9496


def shifted_measurements(spark, d) -> DataFrame:
    shift = F.expr(f"INTERVAL {SHIFT_DAYS} DAYS")
    raw = raw_measurements(spark, d).withColumn("datetime", F.col("datetime") - shift)
    return silver.measurements(raw, POLLUTANTS, FACTORS)


def model(spark, d) -> Model:
    """The star over the stand-ins; pollutant measures follow the event types, GDP one nation."""
    measures = {**MEASURES, **{m.name: m for m in (
        filtered_mean("avg_click", "air", "avg_value", "parameter", "click"),
        filtered_mean("avg_view", "air", "avg_value", "parameter", "view"),
        filtered_mean("avg_error", "air", "avg_value", "parameter", "error"),
        filtered_max("usa_gdp_usd", "gdp", "gdp_usd", "country_code", "NATION_3"))}}
    roles = {"Admin": {}, "Asia Operator": {"zone": {"service_zone": "ASIA"}}}
    return Model(Tables({
        "trips": lambda: trip_fact(spark, d),
        "air": lambda: gold.air_fact(shifted_measurements(spark, d), stations(spark, d)),
        "date": lambda: gold.dim_date(spark, *years_of(spark, d)), "zone": lambda: dim_zone(spark, d),
        "fx": lambda: dim_fx(spark, d), "gdp": lambda: gold.dim_gdp(silver.gdp(raw_gdp(spark, d)), 1e6)}),
        roles=roles, measures=measures)


V_SHIFTFACT = V_AIRFACT.replace("event_type AS parameter, ts,",
                                f"event_type AS parameter, ts - INTERVAL {SHIFT_DAYS} DAY AS ts,")
