"""Dimensions, facts, lookups, keys."""
from datetime import date

from pyspark.sql import functions as F

from tidemart.operators import joins, keys
from tidemart.plans import gold, silver
from tidemart.plans.model import Model, Relationship
from workload import standins as S
from workload.registry import query


@query("fact_trip_daily", f"WITH {S.V_TRIPFACT} SELECT {S.TRIP_COLS} FROM trip_fact")
def fact_trip_daily(spark, d):
    return S.trip_fact(spark, d)


@query("fact_measure_daily", f"WITH {S.V_AIRFACT} SELECT {S.AIR_COLS} FROM air_fact")
def fact_measure_daily(spark, d):
    return S.air_fact(spark, d)


@query("dim_zone", f"""WITH {S.V_ZONE} SELECT CAST(location_id AS INTEGER) AS zone_key,
CAST(location_id AS INTEGER) AS location_id, zone_name, borough, service_zone FROM v_zone""")
def dim_zone(spark, d):
    return S.dim_zone(spark, d)


@query("dim_rate", f"""WITH {S.V_DIMFX}
SELECT fx_key, {S.date_key('d')} AS date_key, d AS date, rate AS usd_eur_rate FROM v_dimfx""")
def dim_rate(spark, d):
    return S.dim_fx(spark, d)


@query("dim_gdp", f"""WITH {S.V_GDP}
SELECT CAST(row_number() OVER (ORDER BY country_code, year) AS INTEGER) AS gdp_key, country_code, country_name, year,
       gdp_usd, floor(gdp_usd / 1e6 * 1e4 + 0.5) / 1e4 AS gdp_trillion_usd FROM v_gdp""")
def dim_gdp(spark, d):
    return gold.dim_gdp(silver.gdp(S.raw_gdp(spark, d)), unit=1e6)


_ISO = """SELECT {key} AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
  CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
  isodow(d) >= 6 AS is_weekend FROM days""".format(key=S.date_key("d"))
_SPAN = """b AS (SELECT min(y) AS lo, max(y) AS hi FROM (
    SELECT year(o_orderdate) AS y FROM orders UNION ALL SELECT year(ts) FROM events)),
  days AS (SELECT CAST(unnest(generate_series(make_date(lo, 1, 1), make_date(hi, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d FROM b)"""


@query("date_dim", f"WITH {_SPAN} {_ISO}")
def date_dim(spark, d):
    return gold.dim_date(spark, *S.years_of(spark, d))


@query("date_dim_usage", f"""WITH {_SPAN}, s AS ({_ISO})
SELECT year, day_of_week, day_name, is_weekend, count(*) AS days, count(o.d) AS days_with_orders, coalesce(sum(n), 0)::BIGINT AS orders
FROM s LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) o ON s.date = o.d
GROUP BY ALL""")
def date_dim_usage(spark, d):
    """Every order placed on its calendar row, weekdays and weekends apart."""
    spine = gold.dim_date(spark, *S.years_of(spark, d))
    per = S.table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count("*").alias("n"))
    return spine.join(per, "date", "left").groupBy("year", "day_of_week", "day_name", "is_weekend").agg(
        F.count("*").alias("days"), F.count("n").alias("days_with_orders"), F.coalesce(F.sum("n"), F.lit(0)).alias("orders"))


_MONTHS = "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders"
_GRID = """b AS (SELECT min(year(o_orderdate)) AS lo, max(year(o_orderdate)) AS hi FROM orders),
  grid AS (SELECT CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month FROM b, unnest(generate_series(lo, hi)) t(y), range(1, 13) r(m))"""


@query("month_grid", f"""WITH {_GRID}, m AS (SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n FROM orders GROUP BY ALL)
SELECT grid.year, grid.month, coalesce(m.n, 0) AS n FROM grid LEFT JOIN m USING (year, month)""")
def month_grid(spark, d):
    o = S.table(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    lo, hi = o.agg(F.min("year"), F.max("year")).first()
    n = o.groupBy("year", "month").agg(F.count("*").alias("n"))
    return keys.month_grid(spark, lo, hi).join(n, ["year", "month"], "left").na.fill(0, ["n"])


@query("missing_periods", f"""WITH {_GRID}
SELECT year, month FROM grid EXCEPT ({_MONTHS} WHERE month(o_orderdate) <> 5)""")
def missing_periods(spark, d):
    o = S.table(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    lo, hi = o.agg(F.min("year"), F.max("year")).first()
    return keys.missing_periods(keys.month_grid(spark, lo, hi), o.where("month <> 5"), ["year", "month"])


@query("surrogate_key_large", """SELECT o_orderkey, o_custkey,
row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_no FROM orders""")
def surrogate_key_large(spark, d):
    o = S.table(spark, d, "orders").select("o_orderdate", "o_orderkey", "o_custkey")
    return keys.surrogate_key_ranged(o, ["o_orderdate", "o_orderkey"], "order_no").drop("o_orderdate")


@query("left_join_null_rate", f"""WITH {S.V_TRIPS}, {S.V_FX}
SELECT CAST(pickup AS DATE) AS day, rate, count(*) AS trips FROM v_trips LEFT JOIN v_fx ON CAST(pickup AS DATE) = d GROUP BY ALL""")
def left_join_null_rate(spark, d):
    per = S.raw_trips(spark, d).groupBy(F.to_date("tpep_pickup_datetime").alias("day")).agg(F.count("*").alias("trips"))
    fx = S.raw_fx(spark, d).withColumnRenamed("usd_eur_rate", "rate")
    return joins.lookup(per, fx, "day", "date", ["rate"]).select("day", "rate", "trips")


@query("station_lookup", f"""WITH {S.V_MEAS}, {S.V_STATION}
SELECT location_id, parameter, location_name AS city, country_name AS country, count(*) AS n
FROM v_meas LEFT JOIN v_station USING (location_id) GROUP BY ALL""")
def station_lookup(spark, d):
    per = S.raw_measurements(spark, d).groupBy("location_id", "parameter").agg(F.count("*").alias("n"))
    st = S.stations(spark, d).select("location_id", F.col("location_name").alias("city"), F.col("country_name").alias("country"))
    return joins.lookup(per, st, "location_id", "location_id", ["city", "country"])


@query("fk_orphans", """SELECT l_orderkey, count(*) AS rows FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1""")
def fk_orphans(spark, d):
    parent = S.table(spark, d, "orders").where("o_orderstatus = 'F'")
    return joins.orphans(S.table(spark, d, "lineitem"), "l_orderkey", parent, "o_orderkey")


@query("orders_without_lines", """SELECT o_orderkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def orders_without_lines(spark, d):
    o = S.table(spark, d, "orders").select("o_orderkey")
    present = S.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return keys.missing_periods(o, present, ["o_orderkey"])


@query("star_flat", """SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderpriority, c_mktsegment, n_name, r_name
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def star_flat(spark, d):
    """The snowflake arms are folded into one customer dimension, then one model spec joins them."""
    c, n, r = (S.table(spark, d, t) for t in ("customer", "nation", "region"))
    n = joins.lookup(n, r, "n_regionkey", "r_regionkey", ["r_name"])
    c = joins.lookup(c, n, "c_nationkey", "n_nationkey", ["n_name", "r_name"])
    o = joins.lookup(S.table(spark, d, "orders"), c, "o_custkey", "c_custkey", ["c_mktsegment", "n_name", "r_name"])
    m = Model({"lines": S.table(spark, d, "lineitem"), "orders": o},
              relationships=(Relationship("lines", "l_orderkey", "orders", "o_orderkey"),))
    flat = m.flat("lines", {"orders": ["o_orderpriority", "c_mktsegment", "n_name", "r_name"]})
    return flat.select("l_orderkey", "l_linenumber", "l_extendedprice", "o_orderpriority", "c_mktsegment", "n_name", "r_name")


@query("role_semi_join", f"""WITH {S.V_ZONE}
SELECT l_suppkey, count(*) AS lines, {S.fixed_sum('l_extendedprice')} AS revenue FROM lineitem
WHERE l_suppkey IN (SELECT location_id FROM v_zone WHERE service_zone = 'ASIA') GROUP BY 1""")
def role_semi_join(spark, d):
    from tidemart.functions.exact import exact_sum
    m = Model({"lines": S.table(spark, d, "lineitem"), "zone": S.raw_zones(spark, d)},
              relationships=(Relationship("lines", "l_suppkey", "zone", "location_id"),),
              roles={"Asia": {"zone": {"service_zone": "ASIA"}}})
    seen = m.as_role("Asia").tables["lines"]
    return seen.groupBy("l_suppkey").agg(F.count("*").alias("lines"), exact_sum("l_extendedprice").alias("revenue"))


@query("sums_long_fractions", f"""SELECT event_type, {S.fixed_sum('value / 7')} AS total, {S.fixed_avg('value / 7')} AS mean,
{S.fixed_sum('value / 70000', 4)} AS tiny FROM events GROUP BY 1""")
def sums_long_fractions(spark, d):
    """Values with many decimals: rounded once, after they are added."""
    from tidemart.functions.exact import exact_avg, exact_sum
    return S.table(spark, d, "events").groupBy("event_type").agg(
        exact_sum("value / 7").alias("total"), exact_avg("value / 7").alias("mean"), exact_sum("value / 70000", 4).alias("tiny"))


@query("union_by_name", """SELECT o_orderkey AS id, o_custkey AS who, o_totalprice AS amount, NULL::VARCHAR AS kind FROM orders
UNION ALL SELECT event_id, user_id, NULL, event_type FROM events""")
def union_by_name(spark, d):
    o = S.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("who"),
                                           F.col("o_totalprice").alias("amount"))
    e = S.table(spark, d, "events").select(F.col("event_type").alias("kind"), F.col("user_id").alias("who"),
                                           F.col("event_id").alias("id"))
    return o.unionByName(e, allowMissingColumns=True)


@query("group_counts", """SELECT 'status' AS grouping, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2
UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY 2
UNION ALL SELECT 'null_priority', NULL, count(*) FROM orders WHERE nullif(o_orderpriority, '5-LOW') IS NULL
UNION ALL SELECT 'rows', NULL, count(*) FROM orders""")
def group_counts(spark, d):
    """Verification counts in one pass: each row is counted in four groupings at once."""
    o = S.table(spark, d, "orders")
    one = lambda name, v: F.struct(F.lit(name).alias("grouping"), v.cast("string").alias("value"))
    none = F.lit(None)
    low = F.when(F.col("o_orderpriority") == "5-LOW", one("null_priority", none))
    rows = o.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n")).select("n", F.inline(F.array_compact(F.array(
        one("status", F.col("o_orderstatus")), one("priority", F.col("o_orderpriority")), low, one("rows", none)))))
    return rows.groupBy("grouping", "value").agg(F.sum("n").alias("n"))


@query("duplicate_keys", """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(spark, d):
    return S.table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


@query("counts_by_size", """SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type""")
def counts_by_size(spark, d):
    return S.table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "event_type")
