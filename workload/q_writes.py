"""Table writes: the state of a stored table after full, range, append, merge and slice writes.

Tables go to a fresh database under the shared folder; the returned frame reads the table."""
from pyspark.sql import functions as F

from tidemart.functions.dates import date_key
from tidemart.operators import write as W
from tidemart.operators.clean import keep_outside
from tidemart.session import work_database
from tidemart.sources import tables
from workload import standins as S
from workload.registry import query

_ORD = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year"
_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "year"]


def _orders(spark, d):
    return S.table(spark, d, "orders").withColumn("year", F.year("o_orderdate")).select(*_COLS)


def _db(spark, name):
    return f"{work_database(spark, name)}.t"


@query("full_overwrite", "SELECT o_orderkey AS order_id, o_orderpriority AS priority, CAST(o_totalprice * 2 AS DOUBLE) AS twice FROM orders")
def full_overwrite(spark, d):
    """A second full write with another schema replaces the first, and reads the table it replaces."""
    t = _db(spark, "full")
    W.write_full(S.table(spark, d, "orders").drop("o_orderdate"), t)
    again = spark.table(t).select(F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("priority"),
                                  (F.col("o_totalprice") * 2).alias("twice"))
    W.write_full(again, t)
    return spark.table(t)


@query("write_range", f"""SELECT {_ORD}, CASE WHEN year(o_orderdate) IN (1996, 1997) THEN 'new' END AS tag FROM orders
WHERE year(o_orderdate) <> 1998""")
def write_range(spark, d):
    """Years 1996–1998 are replaced; the new data has no 1998, so that partition is cleared. The new
    column is added to the table and is null in older years."""
    t = _db(spark, "range")
    o = _orders(spark, d)
    W.write_range(o, t, ["year"], 0, 9999)
    W.write_range(o.where("year IN (1996, 1997)").withColumn("tag", F.lit("new")), t, ["year"], 1996, 1998, merge_schema=True)
    return spark.table(t)


@query("append_new", f"""SELECT {_ORD}, (SELECT count(*) FROM orders WHERE year(o_orderdate) > 1998) AS appended FROM orders""")
def append_new(spark, d):
    t = _db(spark, "append")
    o = _orders(spark, d)
    W.append(o.where("year <= 1998"), t, ["year"])
    added = W.append(o.where("year > 1998"), t)
    return spark.table(t).withColumn("appended", F.lit(added).cast("bigint"))


_SRC = """src AS (SELECT CASE WHEN o_orderkey % 50 = 1 THEN NULL ELSE o_orderkey END AS o_orderkey, o_custkey, 'S' AS o_orderstatus,
  -o_totalprice AS o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE o_orderkey % 5 < 2),
tgt AS (SELECT CASE WHEN o_orderkey % 60 = 1 THEN NULL ELSE o_orderkey END AS o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE o_orderkey % 3 <> 0)"""


def _target_source(spark, d):
    k = F.col("o_orderkey")
    o = _orders(spark, d)
    src = o.where(k % 5 < 2).withColumns({"o_orderstatus": F.lit("S"), "o_totalprice": -F.col("o_totalprice"),
                                          "o_orderkey": F.when(k % 50 != 1, k)})
    tgt = o.where(k % 3 != 0).withColumn("o_orderkey", F.when(k % 60 != 1, k))
    return tgt, src


@query("merge_insert", f"""WITH {_SRC} SELECT * FROM tgt UNION ALL
SELECT * FROM src WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.o_orderkey = src.o_orderkey AND tgt.o_custkey = src.o_custkey)""")
def merge_insert(spark, d):
    """Only unknown keys are added; a null key matches nothing and is added."""
    tgt, src = _target_source(spark, d)
    t = _db(spark, "insert")
    W.append(tgt, t, ["year"])
    W.merge_insert(src, t, ["o_orderkey", "o_custkey"])
    return spark.table(t)


@query("merge_upsert", f"""WITH {_SRC} SELECT * FROM src UNION ALL
SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src WHERE tgt.o_orderkey = src.o_orderkey)""")
def merge_upsert(spark, d):
    """Partitioned target: matched rows take the source values; touched years are rewritten."""
    tgt, src = _target_source(spark, d)
    t = _db(spark, "upsert")
    W.append(tgt, t, ["year"])
    W.merge_upsert(src, t, ["o_orderkey"])
    return spark.table(t)


@query("merge_upsert_flat", f"""WITH {_SRC} SELECT * FROM src UNION ALL
SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src WHERE tgt.o_orderkey = src.o_orderkey)""")
def merge_upsert_flat(spark, d):
    """Unpartitioned target."""
    tgt, src = _target_source(spark, d)
    t = _db(spark, "upsertflat")
    W.write_full(tgt, t)
    W.merge_upsert(src, t, ["o_orderkey"])
    return spark.table(t)


@query("replace_slice", f"""WITH k AS (SELECT {S.date_key('o_orderdate')} AS date_key, o_orderkey, o_totalprice AS amount, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)
SELECT date_key, o_orderkey, amount, year FROM k WHERE date_key < 19960315 OR date_key > 19990630
UNION ALL SELECT date_key, o_orderkey, amount * 10, year FROM k WHERE date_key BETWEEN 19960315 AND 19990630 AND year <> 1998""")
def replace_slice(spark, d):
    """Keys 1996-03-15 … 1999-06-30 are replaced, twice with the same result. Years outside the slice
    are not rewritten, the emptied year disappears, a null key inside the rewritten years is dropped."""
    t = _db(spark, "slice")
    o = S.table(spark, d, "orders").select(date_key("o_orderdate").alias("date_key"), "o_orderkey",
                                           F.col("o_totalprice").alias("amount"), F.year("o_orderdate").alias("year"))
    nulls = o.where("year = 1997").limit(3).withColumn("date_key", F.lit(None).cast("int"))
    W.append(o.unionByName(nulls), t, ["year"])
    new = o.where("date_key BETWEEN 19960315 AND 19990630 AND year <> 1998").withColumn("amount", F.col("amount") * 10)
    for _ in range(2):
        W.replace_slice(new, t, keep_outside("date_key", 19960315, 19990630), lambda s: 1996 <= int(s["year"]) <= 1999)
    return spark.table(t)


@query("replace_slice_flat", f"""SELECT o_orderkey, CASE WHEN year(o_orderdate) BETWEEN 1996 AND 1997 THEN o_totalprice * 10 ELSE o_totalprice END AS amount,
CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""")
def replace_slice_flat(spark, d):
    t = _db(spark, "sliceflat")
    o = _orders(spark, d).select("o_orderkey", F.col("o_totalprice").alias("amount"), "year")
    new = o.where("year BETWEEN 1996 AND 1997").withColumn("amount", F.col("amount") * 10)
    W.write_full(o, t)
    for _ in range(2):
        W.replace_slice(new, t, keep_outside("year", 1996, 1997))
    return spark.table(t)


@query("year_replace", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS at, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year,
CASE WHEN year(o_orderdate) >= 2000 THEN o_orderpriority END AS priority FROM orders""")
def year_replace(spark, d):
    """The stored raw table lacks the year column and one newer column; both appear."""
    t = _db(spark, "years")
    o = S.table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("at"), "o_totalprice",
                                           F.col("o_orderpriority").alias("priority"))
    W.write_full(o.drop("priority").withColumn("o_totalprice", F.when(F.col("at") < "2000", F.col("o_totalprice")).otherwise(F.lit(-1.0))), t)
    W.year_replace(o.where("at >= '2000'"), t, 2000, 2001, "at")
    return spark.table(t)


@query("year_replace_parts", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS at, CAST(year(o_orderdate) AS INTEGER) AS year,
CASE WHEN year(o_orderdate) >= 2000 THEN o_orderpriority END AS priority FROM orders WHERE year(o_orderdate) <> 1999""")
def year_replace_parts(spark, d):
    t = _db(spark, "yearparts")
    o = S.table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("at"),
                                           F.col("o_orderpriority").alias("priority"))
    W.year_replace(o.drop("priority"), t, 1995, 2001, "at")
    W.year_replace(o.where("at >= '2000'"), t, 1999, 2001, "at")
    return spark.table(t)


@query("scan_or_first_run", """SELECT o_orderkey, o_totalprice, 'stored' AS origin FROM orders WHERE o_orderstatus = 'F'""")
def scan_or_first_run(spark, d):
    """A missing table is an empty one of the same schema; an existing one is read."""
    t = _db(spark, "firstrun")
    o = S.table(spark, d, "orders").select("o_orderkey", "o_totalprice").where("o_orderstatus = 'F'")
    missing = tables.scan_or_empty(spark, t, o.schema)
    W.write_full(missing.unionByName(o), t)
    return tables.scan_or_empty(spark, t, o.schema).withColumn("origin", F.lit("stored"))


@query("ingest_stamp", "SELECT event_id, value, true AS not_before_start, true AS one_stamp FROM events")
def ingest_stamp(spark, d):
    """Every row has the stamp of its run: one instant, not before the start."""
    start = spark.range(1).select(F.current_timestamp().alias("t")).first().t
    stamped = W.stamped(S.table(spark, d, "events").select("event_id", "value"))
    stamp = F.col("ingestion_timestamp")
    return stamped.select("event_id", "value", F.coalesce(stamp >= F.lit(start), F.lit(False)).alias("not_before_start"),
                          stamp.eqNullSafe(F.current_timestamp()).alias("one_stamp"))


@query("dq_store", """WITH r AS (SELECT unnest(['F', 'O']) AS status), c AS (SELECT status, count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS n, count(DISTINCT o_orderkey) = count(*) AS once
  FROM r JOIN orders ON o_orderstatus = status GROUP BY 1)
SELECT 'orders ' || status AS "table", 'o_orderpriority not null' AS name, n = 0 AS passed, replace(format('{:,}', n), ',', ',') || ' nulls' AS observed FROM c
UNION ALL SELECT 'orders ' || status, 'o_totalprice in [0, 1000000000]', true, '0 rows outside range' FROM c""")
def dq_store(spark, d):
    """Check results of two runs, over different rows, appended to one table."""
    from tidemart.operators import quality as Q
    t = _db(spark, "dqstore")
    o = S.table(spark, d, "orders").withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    for status in ("F", "O"):
        W.append(Q.suite_results(o.where(F.col("o_orderstatus") == status), f"orders {status}", [
            Q.not_null("o_orderpriority"), Q.in_range("o_totalprice", 0, 10 ** 9)]), t)
    return spark.table(t)
