"""The driver tables as landed files of a city, in two drops: the second holds what arrives late, corrected or again.

First drop: trip files up to the middle of 1998, one of which already holds the trips of the very last day; rates without those of some days; readings
up to the 20th, but for some late ones, with those of the last day; weather up to the 20th with one wrong hour. Second drop: the rest,
an older trip file among it, late trips inside a newer file, the missing rates, the corrected hour."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from workload import standins as S

YEARS = (1992, 2024)
LATE_FILE, LATE_INTO, FUTURE_INTO = "1996-03", "2000-05", "1996-01"
PARAMETERS = {"click": "no2", "view": "o3", "error": "pm25", "purchase": "temperature"}

# the same rows in SQL; limits are those of the library
TRIPS = S.V_TRIPS.replace("l_extendedprice AS fare_amount", "l_extendedprice / 10 AS fare_amount")
CLEAN = S.V_CLEAN.replace(S.V_TRIPS, TRIPS).replace(f"<= {S.MAX_DISTANCE}", "<= 100").replace(f"<= {S.MAX_FARE}", "<= 10000")
TRIP_FACT = S.V_TRIPFACT.replace(S.V_CLEAN, CLEAN)
STATION = """v_station AS (
  SELECT c_custkey AS location_id, c_name AS location_name, n_name AS country_name,
         40.5::DOUBLE + (c_custkey % 40) / 100::DOUBLE AS latitude, (-74.2)::DOUBLE + (c_custkey % 50) / 100::DOUBLE AS longitude
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 5 <> 0)"""
_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
READINGS = f"""v_read AS (
  SELECT user_id % 60 + 1 AS location_id, event_id % 3 AS sid, date_trunc('minute', ts) AS ts,
         CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in PARAMETERS.items())} ELSE event_type END AS parameter, value,
         CASE WHEN {_K} < 50 THEN 'ppm' ELSE 'ugm3' END AS units FROM events), v_good AS (
  SELECT location_id, parameter, ts, CASE WHEN units = 'ppm' THEN 'µg/m³' ELSE units END AS units,
         CASE WHEN units = 'ppm' AND parameter = 'no2' THEN value * 1882::DOUBLE WHEN units = 'ppm' AND parameter = 'o3' THEN value * 1962::DOUBLE ELSE value END AS value
  FROM v_read JOIN v_station USING (location_id) WHERE parameter IN ('no2', 'o3', 'pm25') AND value > 0
  QUALIFY row_number() OVER (PARTITION BY location_id, parameter, ts ORDER BY sid, units, value) = 1), v_air_day AS (
  SELECT CAST(ts AS DATE) AS day, location_id, parameter, count(*) AS n, {S.billionths('value')} AS total,
         round(max(value), 4) AS max_value, round(min(value), 4) AS min_value FROM v_good GROUP BY ALL)"""
WEATHER = """v_hour AS (SELECT date_trunc('hour', ts) AS hr, max(value) AS t, min(value) AS wind FROM events GROUP BY 1)"""


def _trips(spark, d):
    t = S.raw_trips(spark, d).withColumn("fare_amount", F.col("fare_amount") / 10)
    last = t.agg(F.max("tpep_pickup_datetime")).first()[0].date()
    period = F.date_format("tpep_pickup_datetime", "yyyy-MM")
    late = (F.col("passenger_count") == 7) & (period == "1996-02")
    return t.withColumn("period", F.when(F.to_date("tpep_pickup_datetime") == F.lit(last), FUTURE_INTO).when(late, LATE_INTO).otherwise(period))


def _readings(spark, d):
    e = S.k_of(S.table(spark, d, "events"))
    names = F.create_map(*[F.lit(x) for kv in PARAMETERS.items() for x in kv])
    at = F.date_trunc("minute", "ts")
    df = e.select((F.col("user_id") % 60 + 1).alias("location_id"), (F.col("event_id") % 3).alias("sensors_id"), F.lit("S, 1").alias("location"),
                  F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("datetime"), F.lit(40.7).alias("lat"), F.lit(-74.0).alias("lon"),
                  F.coalesce(F.try_element_at(names, F.col("event_type")), F.col("event_type")).alias("parameter"),
                  F.when(F.col("k") < 50, "ppm").otherwise("ugm3").alias("units"), "value", F.to_date(at).alias("day"))
    # equal instants of a station and parameter land together, so that the same one of them counts in every run
    day = F.dayofmonth("day")
    last = S.table(spark, d, "events").agg(F.max("ts")).first()[0].date()
    stays = (day == 14) & (F.col("location_id") % 4 == 0)
    return df.withColumn("first", (F.col("day") == F.lit(last)) | ((day <= 20) & ~stays))


def land(spark, d, base: str, drops: tuple[int, ...]) -> None:
    """Write the given drops (1, 2) below ``base``."""
    first, second = 1 in drops, 2 in drops
    trips = _trips(spark, d)
    # two file generations: counts are doubles, later whole numbers
    early = (F.col("period") < "1998-07") & (F.col("period") != LATE_FILE)
    for k, (wanted, df) in enumerate(((first, trips.where(early)), (second, trips.where(~early)))):
        if wanted:
            if k:
                df = df.withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
            df.repartition("period").withColumn("f", F.concat(F.lit("trips_"), "period", F.lit(f"-{k}"))).drop("period").write.mode("append").partitionBy("f").parquet(f"{base}/trips")
    rates = S.raw_fx(spark, d).select(F.date_format("date", "yyyy-MM-dd").alias("TIME_PERIOD"), F.col("usd_eur_rate").alias("OBS_VALUE"), F.dayofmonth("date").alias("day"))
    missing = F.col("day") % 7 == 3
    for wanted, df in ((first, rates.where(~missing)), (second, rates.where(missing))):
        if wanted:
            df.drop("day").write.mode("append").option("header", True).csv(f"{base}/fx")
    readings = _readings(spark, d)
    for wanted, df in ((first, readings.where("first")), (second, readings.where("NOT first"))):
        if wanted:
            parts = {"locationid": F.col("location_id"), "year": F.substring("datetime", 1, 4), "month": F.substring("datetime", 6, 2)}
            (df.drop("day", "first").withColumns(parts).repartition(*parts)
             .write.mode("append").partitionBy(*parts).option("header", True).option("compression", "gzip").csv(f"{base}/measurements"))
    hours = S.table(spark, d, "events").groupBy(F.date_trunc("hour", "ts").alias("at")).agg(F.max("value").alias("t"), F.min("value").alias("wind"))
    wrong = F.col("at") == F.lit(dt.datetime(2024, 1, 5, 10))

    def weather(df):
        rows = F.array_sort(F.collect_list(F.struct(F.date_format("at", "yyyy-MM-dd'T'HH:mm").alias("time"), "t", "wind")))  # 24 a day
        docs = df.groupBy(F.to_date("at").alias("day")).agg(rows.alias("r")).select(F.lit(40.7).alias("latitude"), F.lit(-74.0).alias("longitude"), F.struct(
            F.transform("r", lambda x: x.time).alias("time"), F.transform("r", lambda x: x.t).alias("temperature_2m"),
            F.transform("r", lambda x: x.wind).alias("wind_speed_10m")).alias("hourly"))
        docs.write.mode("append").option("maxRecordsPerFile", 1).json(f"{base}/weather")
    early = F.to_date("at") <= F.lit(dt.date(2024, 1, 20))
    if first:
        weather(hours.where(early).withColumn("t", F.when(wrong, F.col("t") + 100).otherwise(F.col("t"))))
    if second:
        weather(hours.where(~early | wrong))
    if not first:
        return
    z = S.raw_zones(spark, d).select(F.col("location_id").alias("LocationID"), F.col("borough").alias("Borough"), F.col("zone").alias("Zone"), "service_zone")
    z.write.option("header", True).csv(f"{base}/zones")
    g = S.raw_gdp(spark, d).select(F.struct(F.struct(F.col("country_code").alias("id"), F.col("country_name").alias("value")).alias("country"),
                                            F.col("year").cast("string").alias("date"), F.col("gdp_usd").alias("value")).alias("r"))
    # nations times years: one short document
    g.agg(F.collect_list("r").alias("r")).select(F.concat(F.lit('[{"page":1},'), F.to_json("r"), F.lit("]")).alias("value")).coalesce(1).write.text(f"{base}/gdp")
    c, n = S.table(spark, d, "customer"), S.table(spark, d, "nation")
    k = F.col("c_custkey")
    rec = F.struct(k.alias("id"), F.col("c_name").alias("name"), F.struct(F.col("n_name").alias("code"), F.col("n_name").alias("name")).alias("country"),
                   F.struct(F.when(k % 5 != 0, F.lit(40.5) + (k % 40) / 100.0).otherwise(F.lit(10.0)).alias("latitude"), (F.lit(-74.2) + (k % 50) / 100.0).alias("longitude")).alias("coordinates"))
    pages = c.join(n, c.c_nationkey == n.n_nationkey).groupBy(F.floor(k / 100).alias("page")).agg(F.collect_list(rec).alias("results"))
    pages.write.option("maxRecordsPerFile", 1).json(f"{base}/locations")
