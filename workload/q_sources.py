"""Source readers on files that Spark writes from the driver tables."""
import datetime as dt

from pyspark.sql import functions as F

from tidemart.session import work_path
from tidemart.sources import nested, parquet_drift, text
from workload import standins as S
from workload.registry import query


@query("drift_union", """SELECT CAST(l_linenumber AS BIGINT) AS vendor, CAST(l_quantity AS DOUBLE) AS passengers, l_extendedprice AS fare,
CASE WHEN l_shipdate >= TIMESTAMP '1997-01-01' THEN l_tax END AS airport_fee, CASE WHEN l_shipdate >= TIMESTAMP '1999-01-01' THEN l_discount END AS new_fee
FROM lineitem""")
def drift_union(spark, d):
    """Three file generations: int and long ids, long and double counts, a renamed capital, new columns."""
    base = work_path(spark, "drift")
    li, ship = S.table(spark, d, "lineitem"), F.col("l_shipdate")
    a, b = F.lit(dt.datetime(1997, 1, 1)).cast("timestamp_ntz"), F.lit(dt.datetime(1999, 1, 1)).cast("timestamp_ntz")
    fare = F.col("l_extendedprice").alias("fare")
    gens = [
        li.where(ship < a).select(F.col("l_linenumber").cast("int").alias("vendor"), F.col("l_quantity").cast("double").alias("passengers"), fare),
        li.where((ship >= a) & (ship < b)).select(F.col("l_linenumber").cast("bigint").alias("vendor"),
                                                  F.col("l_quantity").cast("double").alias("passengers"), fare, F.col("l_tax").alias("airport_fee")),
        li.where(ship >= b).select(F.col("l_linenumber").cast("bigint").alias("vendor"), F.col("l_quantity").cast("bigint").alias("passengers"),
                                   fare, F.col("l_tax").alias("Airport_fee"), F.col("l_discount").alias("new_fee")),
    ]
    for i, g in enumerate(gens):
        g.write.parquet(f"{base}/gen{i}")
    groups = parquet_drift.generations(spark, parquet_drift.folder_units(parquet_drift.list_files(spark, base)))
    return parquet_drift.read_drifting(spark, groups, {"Airport_fee": "airport_fee"}, {"vendor": "bigint", "passengers": "double"})


@query("files_for_years", """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998 GROUP BY ALL""")
def files_for_years(spark, d):
    base = work_path(spark, "periods")
    o = S.table(spark, d, "orders").withColumn("period", F.date_format("o_orderdate", "yyyy-MM"))
    o.repartition("period").write.partitionBy("period").parquet(base)
    files = parquet_drift.files_for_years(parquet_drift.list_files(spark, base), 1996, 1998, column="path")
    return files.select("year", "month").distinct()


@query("json_flatten", """SELECT c_custkey AS location_id, c_name AS location_name, NULL::VARCHAR AS timezone,
CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS country_id, CASE WHEN c_custkey % 3 <> 0 THEN n_name END AS country_name,
CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS latitude, CASE WHEN c_custkey % 5 <> 0 THEN -c_acctbal END AS longitude
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def json_flatten(spark, d):
    """Paged records of 100; a third lack the country record, a fifth the coordinates."""
    path = work_path(spark, "pages")
    c, n = S.table(spark, d, "customer"), S.table(spark, d, "nation")
    k = F.col("c_custkey")
    rec = F.struct(k.alias("id"), F.col("c_name").alias("name"),
                   F.when(k % 3 != 0, F.struct(F.col("c_mktsegment").alias("code"), F.col("n_name").alias("name"))).alias("country"),
                   F.when(k % 5 != 0, F.struct(F.col("c_acctbal").alias("latitude"), (-F.col("c_acctbal")).alias("longitude"))).alias("coordinates"))
    pages = c.join(n, c.c_nationkey == n.n_nationkey).groupBy(F.floor(k / 100).alias("page")).agg(F.collect_list(rec).alias("results"))
    pages.write.json(path)
    return nested.read_station_pages(spark, path, whole_files=False).drop("datetime_first", "datetime_last")


@query("json_indexed", """SELECT 'C' || (o_orderkey % 9) AS country_code, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS country_name,
CAST(o_orderkey AS VARCHAR) AS year, CASE WHEN o_orderkey % 6 <> 0 THEN o_totalprice END AS gdp_usd FROM orders WHERE o_orderkey % 11 <> 0""")
def json_indexed(spark, d):
    """Documents [meta, [records…]] of 100 records; all-blank records are dropped."""
    path = work_path(spark, "indexed")
    k = F.col("o_orderkey")
    shown = k % 11 != 0
    rec = F.struct(
        F.struct(F.when(shown, F.concat(F.lit("C"), (k % 9).cast("string"))).otherwise(F.lit("")).alias("id"),
                 F.when(shown & (k % 4 != 0), F.col("o_orderpriority")).alias("value")).alias("country"),
        F.when(shown, k.cast("string")).alias("date"), F.when(shown & (k % 6 != 0), F.col("o_totalprice")).alias("value"))
    docs = S.table(spark, d, "orders").groupBy(F.floor(k / 100)).agg(F.collect_list(rec).alias("r"))
    docs.select(F.concat(F.lit('[{"page":1},'), F.to_json("r"), F.lit("]")).alias("value")).write.text(path)
    return nested.read_indexed_json(spark, path, 1, nested.GDP_RECORD, nested.GDP_FIELDS, whole_files=False)


@query("array_explode", """SELECT event_id // 24 AS chunk, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS time, value AS temperature_2m,
CASE WHEN (event_id // 24) % 3 <> 0 THEN event_id END AS weather_code FROM events""")
def array_explode(spark, d):
    """Parallel arrays of 24 entries; every third record lacks one array."""
    path = work_path(spark, "arrays")
    chunk = F.floor(F.col("event_id") / 24)
    rows = F.array_sort(F.collect_list(F.struct("event_id", "ts", "value")))
    e = S.table(spark, d, "events").groupBy(chunk.alias("chunk")).agg(rows.alias("r"))
    e.select("chunk", F.struct(
        F.transform("r", lambda x: F.date_format(x.ts, "yyyy-MM-dd'T'HH:mm:ss")).alias("time"),
        F.transform("r", lambda x: x.value).alias("temperature_2m"),
        F.when(F.col("chunk") % 3 != 0, F.transform("r", lambda x: x.event_id)).alias("weather_code")).alias("hourly")).write.json(path)
    docs = spark.read.schema("chunk BIGINT, hourly STRUCT<time: ARRAY<STRING>, temperature_2m: ARRAY<DOUBLE>, weather_code: ARRAY<BIGINT>>").json(path)
    return nested.explode_parallel(docs, "time", ["temperature_2m", "weather_code"], keep=["chunk"], struct="hourly")


@query("csv_table", """SELECT TRY_CAST(CASE WHEN s_suppkey % 10 = 0 THEN 'x' ELSE CAST(s_suppkey AS VARCHAR) END AS INTEGER) AS location_id, s_name || ', "' || n_name || '"' AS zone,
CASE WHEN s_suppkey % 3 = 0 THEN 'N/A' WHEN s_suppkey % 3 = 1 THEN NULL ELSE n_name END AS borough FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def csv_table(spark, d):
    """Quoted commas and quotes, literal N/A, empty fields, bad ids."""
    path = work_path(spark, "csv")
    s, n = S.table(spark, d, "supplier"), S.table(spark, d, "nation")
    k = F.col("s_suppkey")
    s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.when(k % 10 == 0, F.lit("x")).otherwise(k.cast("string")).alias("LocationID"),
        F.concat("s_name", F.lit(', "'), "n_name", F.lit('"')).alias("Zone"),
        F.when(k % 3 == 0, F.lit("N/A")).when(k % 3 == 1, F.lit(None)).otherwise(F.col("n_name")).alias("Borough"),
    ).write.option("header", True).option("escape", "\"").csv(path)
    spark_csv = text.read_csv_table(spark, path, {"LocationID": "location_id", "Borough": "borough", "Zone": "zone"}, {"location_id": "int"})
    return spark_csv


@query("csv_narrow", """SELECT CASE WHEN event_id % 5 <> 0 THEN CAST(ts AS DATE) END AS date, CASE WHEN event_id % 3 <> 0 THEN value END AS usd_eur_rate
FROM events WHERE event_id % 15 <> 0""")
def csv_narrow(spark, d):
    """Two of twelve columns, typed, rows blank in both dropped."""
    path = work_path(spark, "wide")
    k = F.col("event_id")
    e = S.table(spark, d, "events")
    e.select(*[F.lit(f"v{i}").alias(f"C{i}") for i in range(10)],
             F.when(k % 5 != 0, F.date_format("ts", "yyyy-MM-dd")).alias("TIME_PERIOD"), F.when(k % 3 != 0, F.col("value")).alias("OBS_VALUE"),
             ).write.option("header", True).csv(path)
    return text.read_narrow_csv(spark, path, {"TIME_PERIOD": "date", "OBS_VALUE": "usd_eur_rate"}, {"date": "date", "usd_eur_rate": "double"})


@query("archive_scan", """SELECT o_orderkey, o_totalprice AS value, o_custkey % 4 AS locationid, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS month
FROM orders WHERE o_custkey % 4 IN (1, 3) AND year(o_orderdate) * 12 + quarter(o_orderdate) BETWEEN 1996 * 12 + 3 AND 1997 * 12 + 2""")
def archive_scan(spark, d):
    """Gzipped CSV by station, year and month; stations come as a frame, periods as literals."""
    base = work_path(spark, "archive")
    o = S.table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("value"), (F.col("o_custkey") % 4).alias("locationid"),
                                           F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("month"))
    o.repartition("locationid", "year", "month").write.partitionBy("locationid", "year", "month").option("header", True).option("compression", "gzip").csv(base)
    ids = S.table(spark, d, "customer").select((F.col("c_custkey") % 4).alias("station")).where("station IN (1, 3)").distinct()
    return text.read_archive(spark, base, "o_orderkey BIGINT, value DOUBLE", ids,
                             [(1996, 3), (1996, 4), (1997, 1), (1997, 2)])
