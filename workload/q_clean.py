"""Row cleaning, casts, conversions, deduplication."""
from pyspark.sql import functions as F

from tidemart.functions.casts import cast_map, conform, rename_map
from tidemart.functions.dates import date_key, minutes_between, period_keys, wall_clock, year_of_key
from tidemart.functions.units import convert_value, relabel_units
from tidemart.operators import clean
from tidemart.plans import silver
from workload import standins as S
from workload.registry import query

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


@query("silver_trips", f"""WITH {S.V_CLEAN}
SELECT CAST(pickup AS DATE) AS pickup_date, CAST(dropoff AS DATE) AS dropoff_date, pu_zone AS pu_location_id,
       do_zone AS do_location_id, trip_distance, fare_amount, passenger_count,
       CAST(year(pickup) AS INTEGER) AS year, CAST(month(pickup) AS INTEGER) AS month FROM v_clean""")
def silver_trips(spark, d):
    t = S.trips(spark, d)
    return t.select(F.to_date("pickup_datetime").alias("pickup_date"), F.to_date("dropoff_datetime").alias("dropoff_date"),
                    "pu_location_id", "do_location_id", "trip_distance", "fare_amount", "passenger_count", "year", "month")


@query("silver_measurements", f"""WITH {S.V_MCLEAN}
SELECT location_id, parameter, epoch_us(ts) AS ts_us, round(value, 4) AS value, units,
       CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month FROM v_mclean""")
def silver_measurements(spark, d):
    return S.measurements(spark, d).select(
        "location_id", "parameter", F.unix_micros("datetime").alias("ts_us"), F.round("value", 4).alias("value"),
        "units", "year", "month")


@query("silver_weather", f"""WITH {S.V_WEATHER}, h AS (SELECT * REPLACE (date_trunc('hour', datetime) AS datetime) FROM v_weather)
SELECT epoch_us(datetime) // 1000000 AS hour_s, temperature_c, feels_like_c, precipitation_mm, wind_speed_kmh,
       humidity_pct, weather_code, precipitation_mm > 0 AS is_rainy,
       CAST(year(datetime) AS INTEGER) AS year, CAST(month(datetime) AS INTEGER) AS month
FROM h QUALIFY row_number() OVER (PARTITION BY datetime ORDER BY temperature_c, feels_like_c,
       precipitation_mm NULLS FIRST, wind_speed_kmh) = 1""")
def silver_weather(spark, d):
    w = silver.weather(S.raw_weather(spark, d, "hour"))
    return w.select(F.unix_seconds("datetime").alias("hour_s"), "temperature_c", "feels_like_c", "precipitation_mm",
                    "wind_speed_kmh", "humidity_pct", "weather_code", "is_rainy", "year", "month")


@query("unit_conversion", f"""WITH {S.V_MEAS}
SELECT location_id, parameter, epoch_us(ts) AS ts_us,
       round(CASE WHEN units = 'ppm' AND parameter = 'click' THEN value * 1882.0::DOUBLE
                  WHEN units = 'ppm' AND parameter = 'view' THEN value * 1962.0::DOUBLE ELSE value END, 4) AS value
FROM v_meas""")
def unit_conversion(spark, d):
    return S.raw_measurements(spark, d).select(
        "location_id", "parameter", F.unix_micros(F.col("datetime").cast("timestamp")).alias("ts_us"),
        F.round(convert_value(factors=S.FACTORS), 4).alias("value"))


@query("unit_relabel", f"""WITH {S.V_MEAS}
SELECT CASE WHEN units = 'ppm' THEN 'µg/m³' ELSE units END AS units, parameter, count(*) AS n
FROM v_meas GROUP BY ALL""")
def unit_relabel(spark, d):
    m = S.raw_measurements(spark, d).withColumn("units", relabel_units())
    return m.groupBy("units", "parameter").agg(F.count("*").alias("n"))


@query("positive_and_set_filter", """SELECT event_id, event_type, value FROM events
WHERE event_type IN ('click', 'view', 'error') AND CASE WHEN event_id % 3 = 0 THEN -value ELSE value END > 0""")
def positive_and_set_filter(spark, d):
    e = S.table(spark, d, "events")
    signed = e.withColumn("signed", F.when(F.col("event_id") % 3 == 0, -F.col("value")).otherwise(F.col("value")))
    kept = signed.where(F.col("event_type").isin(list(S.POLLUTANTS)) & clean.strictly_positive("signed"))
    return kept.select("event_id", "event_type", "value")


@query("null_reject", f"SELECT event_id, nullif({_K}, 0) AS k FROM events WHERE nullif({_K}, 0) IS NOT NULL")
def null_reject(spark, d):
    e = S.k_of(S.table(spark, d, "events")).withColumn("k", F.nullif("k", F.lit(0)))
    return clean.require(e, "event_id", "k").select("event_id", "k")


@query("range_filter", """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
WHERE l_quantity > 0 AND l_quantity <= 40 AND l_extendedprice > 0 AND l_extendedprice <= 90000""")
def range_filter(spark, d):
    li = S.table(spark, d, "lineitem")
    return li.where(clean.sane_range("l_quantity", S.MAX_DISTANCE) & clean.sane_range("l_extendedprice", S.MAX_FARE)) \
        .select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query("bbox_filter", """SELECT p_partkey, p_size, p_retailprice FROM part
WHERE p_size BETWEEN 10 AND 30 AND p_retailprice BETWEEN 950 AND 1500""")
def bbox_filter(spark, d):
    return S.table(spark, d, "part").where(clean.within_box("p_size", "p_retailprice", (10, 30, 950, 1500))) \
        .select("p_partkey", "p_size", "p_retailprice")


_STATION_SPAN = """SELECT c_custkey AS station, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(min(o_orderdate) AS DATE) END AS first_d,
       CAST(max(o_orderdate) AS DATE) AS last_d
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey"""


def _station_span(spark, d):
    c = S.table(spark, d, "customer").select(F.col("c_custkey").alias("station"))
    o = S.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("station")).agg(
        F.to_date(F.min("o_orderdate")).alias("first_d"), F.to_date(F.max("o_orderdate")).alias("last_d"))
    return c.join(o, "station", "left").withColumn(
        "first_d", F.when(F.col("station") % 7 != 0, F.col("first_d")))


@query("activity_overlap", f"""SELECT * FROM ({_STATION_SPAN})
WHERE (first_d IS NULL OR first_d <= DATE '1996-03-31') AND (last_d IS NULL OR last_d >= DATE '1996-01-01')""")
def activity_overlap(spark, d):
    import datetime as dt
    return clean.active_between(_station_span(spark, d), dt.date(1996, 1, 1), dt.date(1996, 3, 31), "first_d", "last_d")


@query("dedup_first", """SELECT user_id, event_type, epoch_us(date_trunc('hour', ts)) // 1000000 AS hour_s, event_id, value
FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type, date_trunc('hour', ts)
                                       ORDER BY ts, event_id) = 1""")
def dedup_first(spark, d):
    e = S.table(spark, d, "events").select("user_id", "event_type", F.unix_seconds(
        F.date_trunc("hour", F.col("ts").cast("timestamp"))).alias("hour_s"), "ts", "event_id", "value")
    return clean.first_per_key(e, ["user_id", "event_type", "hour_s"], ["ts", "event_id"]).drop("ts")


@query("dedup_lines", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
  SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""")
def dedup_lines(spark, d):
    li = S.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                              "l_extendedprice")
    return clean.first_per_key(li, ["l_orderkey", "l_linenumber"])


@query("ntz_cast", """SELECT o_orderkey, epoch_us(o_orderdate) // 1000000 AS at_s, CAST(o_orderdate AS DATE) AS day,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS clock FROM orders""")
def ntz_cast(spark, d):
    o = S.table(spark, d, "orders").withColumn("at", wall_clock("o_orderdate"))
    return o.select("o_orderkey", F.unix_seconds("at").alias("at_s"), F.to_date("at").alias("day"),
                    F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("clock"))


@query("year_from_key", f"""SELECT CAST({S.date_key('o_orderdate')} // 10000 AS INTEGER) AS year, count(*) AS n
FROM orders GROUP BY 1""")
def year_from_key(spark, d):
    o = S.table(spark, d, "orders").select(date_key("o_orderdate").alias("k"))
    return o.groupBy(year_of_key("k").alias("year")).agg(F.count("*").alias("n"))


@query("derived_flag", f"""WITH {S.V_WEATHER}
SELECT precipitation_mm > 0 AS is_rainy, count(*) AS n FROM v_weather GROUP BY 1""")
def derived_flag(spark, d):
    w = rename_map(S.raw_weather(spark, d), silver.WEATHER_RENAMES)
    return w.groupBy((F.col("precipitation_mm") > 0).alias("is_rainy")).agg(F.count("*").alias("n"))


_BLANKED = """SELECT CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id END AS id,
  CASE WHEN event_id % 4 = 0 THEN '' WHEN event_id % 6 = 0 THEN '' ELSE event_type END AS kind,
  CASE WHEN event_id % 8 = 0 THEN NULL WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value FROM events"""


@query("drop_blank_rows", f"""SELECT id, nullif(kind, '') AS kind, value FROM ({_BLANKED})
WHERE NOT (id IS NULL AND nullif(kind, '') IS NULL AND value IS NULL)""")
def drop_blank_rows(spark, d):
    n = F.col("event_id")
    e = S.table(spark, d, "events").select(
        F.when(n % 4 != 0, n).alias("id"),
        F.when((n % 4 == 0) | (n % 6 == 0), F.lit("")).otherwise(F.col("event_type")).alias("kind"),
        F.when((n % 8 != 0) & (n % 3 != 0), F.col("value")).alias("value"))
    return clean.drop_blank_rows(e)


@query("rename_and_cast", f"""SELECT event_id AS reading_id,
  TRY_CAST(CASE WHEN {_K} = 1 THEN 'bad' ELSE CAST({_K} AS VARCHAR) END AS INTEGER) AS k_level,
  TRY_CAST(CASE WHEN {_K} = 2 THEN 'not a date' ELSE strftime(ts, '%Y-%m-%d') END AS DATE) AS day,
  CAST(value AS DOUBLE) AS reading_value FROM events""")
def rename_and_cast(spark, d):
    e = S.k_of(S.table(spark, d, "events")).select(
        "event_id", F.when(F.col("k") == 1, "bad").otherwise(F.col("k").cast("string")).alias("k"),
        F.when(F.col("k") == 2, "not a date").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("day"),
        F.col("value").cast("string").alias("value"))
    e = rename_map(e, {"event_id": "reading_id", "k": "k_level", "value": "reading_value"})
    return cast_map(e, {"k_level": "int", "day": "date", "reading_value": "double"})


@query("period_keys", """SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, event_type,
count(*) AS n FROM events GROUP BY ALL""")
def period_key_counts(spark, d):
    return period_keys(S.table(spark, d, "events"), "ts").groupBy("year", "month", "event_type").agg(
        F.count("*").alias("n"))


@query("duration_minutes", f"""WITH {S.V_TRIPS}
SELECT pu_zone, min((epoch_us(dropoff) - epoch_us(pickup)) / 60000000.0::DOUBLE) AS shortest,
       max((epoch_us(dropoff) - epoch_us(pickup)) / 60000000.0::DOUBLE) AS longest FROM v_trips GROUP BY 1""")
def duration_minutes(spark, d):
    m = S.raw_trips(spark, d).select(F.col("PULocationID").alias("pu_zone"), minutes_between(
        "tpep_pickup_datetime", "tpep_dropoff_datetime").alias("m"))
    return m.groupBy("pu_zone").agg(F.min("m").alias("shortest"), F.max("m").alias("longest"))


@query("target_schema", """SELECT CAST(o_orderkey AS BIGINT) AS location_id, o_orderpriority AS location_name,
CAST(NULL AS VARCHAR) AS timezone, o_orderstatus AS country_id, CAST(o_totalprice AS DOUBLE) AS latitude FROM orders""")
def target_schema(spark, d):
    from pyspark.sql.types import StructType
    want = StructType.fromDDL("location_id BIGINT, location_name STRING, timezone STRING, country_id STRING, latitude DOUBLE")
    o = rename_map(S.table(spark, d, "orders"), {"o_orderkey": "location_id", "o_orderpriority": "location_name",
                                                 "o_orderstatus": "country_id", "o_totalprice": "latitude"})
    return conform(o, want)


@query("silver_locations", """SELECT o_custkey AS location_id, min(o_orderpriority) AS location_name, min(CASE WHEN o_custkey % 6 <> 0 THEN 'US' END) AS country_id
FROM orders WHERE o_custkey % 6 <> 0 AND o_custkey % 11 <> 0 GROUP BY 1""")
def silver_locations(spark, d):
    """Stations sent many times; a null id or country drops the record."""
    k = F.col("o_custkey")
    raw = S.table(spark, d, "orders").select(F.when(k % 11 != 0, k).alias("location_id"), F.col("o_orderpriority").alias("location_name"),
                                             F.when(k % 6 != 0, F.lit("US")).alias("country_id"))
    return silver.locations(raw)


_TEXT_GDP = """SELECT CASE WHEN c_custkey % 9 <> 0 THEN n_name END AS country_code, upper(n_name) AS country_name,
  CASE WHEN c_custkey % 8 = 0 THEN 'n/a' ELSE CAST(1990 + c_custkey % 20 AS VARCHAR) END AS year,
  CASE WHEN c_custkey % 5 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS gdp_usd FROM customer JOIN nation ON c_nationkey = n_nationkey"""


@query("silver_gdp", f"""WITH t AS (SELECT country_code, country_name, TRY_CAST(year AS INTEGER) AS year, TRY_CAST(gdp_usd AS DOUBLE) AS gdp_usd FROM ({_TEXT_GDP}))
SELECT country_code, country_name, year, gdp_usd FROM t WHERE country_code IS NOT NULL AND gdp_usd IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY country_code, year ORDER BY country_name, gdp_usd) = 1""")
def silver_gdp(spark, d):
    """Text years and amounts, some unreadable; one row per country and year."""
    c, n, k = S.table(spark, d, "customer"), S.table(spark, d, "nation"), F.col("c_custkey")
    raw = c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.when(k % 9 != 0, F.col("n_name")).alias("country_code"), F.upper("n_name").alias("country_name"),
        F.when(k % 8 == 0, "n/a").otherwise((1990 + k % 20).cast("string")).alias("year"),
        F.when(k % 5 == 0, "").otherwise(k.cast("string")).alias("gdp_usd"))
    return silver.gdp(raw)


@query("silver_fx_rates", """WITH t AS (SELECT TRY_CAST(CASE WHEN o_orderkey % 50 = 0 THEN 'bad' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE) AS date,
  TRY_CAST(CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE CAST(o_orderkey AS VARCHAR) END AS DOUBLE) AS usd_eur_rate FROM orders)
SELECT date, min(usd_eur_rate) AS usd_eur_rate FROM t WHERE usd_eur_rate IS NOT NULL GROUP BY 1""")
def silver_fx_rates(spark, d):
    k = F.col("o_orderkey")
    raw = S.table(spark, d, "orders").select(
        F.when(k % 50 == 0, "bad").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        F.when(k % 3 == 0, "x").otherwise(k.cast("string")).alias("usd_eur_rate"))
    return silver.fx_rates(raw)


@query("silver_zones", """WITH t AS (SELECT TRY_CAST(CASE WHEN p_partkey % 7 = 0 THEN 'zone' ELSE CAST(p_partkey // 2 AS VARCHAR) END AS INTEGER) AS location_id,
  p_brand AS borough, p_name AS zone, p_type AS service_zone FROM part)
SELECT * FROM t WHERE location_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY borough, zone, service_zone) = 1""")
def silver_zones(spark, d):
    k = F.col("p_partkey")
    raw = S.table(spark, d, "part").select(
        F.when(k % 7 == 0, "zone").otherwise(F.floor(k / 2).cast("string")).alias("location_id"),
        F.col("p_brand").alias("borough"), F.col("p_name").alias("zone"), F.col("p_type").alias("service_zone"))
    return silver.zones(raw)
