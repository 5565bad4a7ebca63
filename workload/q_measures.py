"""Measures over the star, comparisons, marts."""
import datetime as dt

from pyspark.sql import functions as F

from tidemart.functions.labels import band, limit_of, yoy_label
from tidemart.operators.measures import pearson, ratio_percent, year_over_year
from tidemart.plans import marts
from workload import standins as S
from workload.registry import query

_T = f"WITH {S.V_TRIPFACT}"
_A = f"WITH {S.V_AIRFACT}"
# both facts on one calendar: readings moved by whole days
_B = f"WITH {S.V_TRIPFACT},\n{S.V_SHIFTFACT}"


def _label(change, year):
    pct = f"printf('%.1f%%', round({change} * 100, 1))"
    return (f"CASE WHEN {change} IS NULL THEN NULL WHEN {change} >= 0 THEN '▲ +' || {pct} || ' vs ' || ({year} - 1) "
            f"ELSE '▼ ' || {pct} || ' vs ' || ({year} - 1) END")


def _yoy_sql(source, measures, labels=True):
    cols = ["c.year"]
    for m in measures:
        change = f"CAST(c.{m} - p.{m} AS DOUBLE) / nullif(CAST(p.{m} AS DOUBLE), 0)"
        cols += [f"c.{m}", f"{change} AS {m}_yoy"]
        if labels:
            cols.append(f"{_label(f'({change})', 'c.year')} AS {m}_yoy_label")
    return f"SELECT {', '.join(cols)} FROM {source} c LEFT JOIN {source} p ON p.year = c.year - 1"


_KPI = f"""kpi AS (SELECT year, sum(trip_count)::BIGINT AS total_trips, {S.fixed_sum('total_fare_usd')} AS total_revenue_usd,
  {S.fixed_sum('total_fare_eur')} AS total_revenue_eur, {S.fixed_avg('avg_fare_usd')} AS avg_fare_usd FROM trip_fact GROUP BY year)"""


@query("measure_totals", f"""{_T} SELECT service_zone, year, sum(trip_count)::BIGINT AS total_trips,
{S.fixed_sum('total_fare_usd')} AS total_revenue_usd, {S.fixed_sum('total_fare_eur')} AS total_revenue_eur
FROM trip_fact LEFT JOIN v_zone ON zone_key = location_id GROUP BY ALL""")
def measure_totals(spark, d):
    m = S.model(spark, d)
    return m.evaluate(["total_trips", "total_revenue_usd", "total_revenue_eur"], [("zone", "service_zone"), ("date", "year")])


@query("avg_of_avg", f"""{_T} SELECT borough, {S.fixed_avg('avg_fare_usd')} AS avg_fare_usd
FROM trip_fact LEFT JOIN v_zone ON zone_key = location_id GROUP BY ALL""")
def avg_of_avg(spark, d):
    return S.model(spark, d).evaluate(["avg_fare_usd"], [("zone", "borough")])


@query("measure_means", f"""{_T} SELECT borough, {S.fixed_avg('avg_trip_distance_mi')} AS avg_trip_distance_mi, {S.fixed_avg('avg_trip_duration_min')} AS avg_trip_duration_min
FROM trip_fact LEFT JOIN v_zone ON zone_key = location_id GROUP BY ALL""")
def measure_means(spark, d):
    return S.model(spark, d).evaluate(["avg_trip_distance_mi", "avg_trip_duration_min"], [("zone", "borough")])


def _pol(p):
    return f"{S.fixed_avg('avg_value', chr(39).join(['parameter = ', p, '']))} AS avg_{p}"


_POL = ", ".join(_pol(p) for p in S.POLLUTANTS)
_POLS = ["avg_click", "avg_view", "avg_error"]


@query("filtered_avg", f"{_B} SELECT date_key, {_POL} FROM air_fact GROUP BY 1")
def filtered_avg(spark, d):
    return S.model(spark, d).evaluate(_POLS, [("date", "date_key")])


_ORD = f"""o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders, {S.fixed_sum('o_totalprice')} AS revenue
FROM orders GROUP BY 1)"""


def _orders_by_year(spark, d, keep=None):
    from tidemart.functions.exact import exact_sum
    o = S.table(spark, d, "orders")
    if keep is not None:
        o = o.where(keep)
    return o.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count("*").alias("orders"), exact_sum("o_totalprice").alias("revenue"))


@query("yoy", f"WITH {_ORD} {_yoy_sql('o', ['orders', 'revenue'], labels=False)}")
def yoy(spark, d):
    return year_over_year(_orders_by_year(spark, d), ["orders", "revenue"])


@query("yoy_gap", f"""WITH {_ORD}, g AS (SELECT * FROM o WHERE year <> 1998) {_yoy_sql('g', ['orders'], labels=False)}""")
def yoy_gap(spark, d):
    """A missing year gives no change for the year after it."""
    return year_over_year(_orders_by_year(spark, d, F.year("o_orderdate") != 1998), ["orders"]).select("year", "orders", "orders_yoy")


@query("yoy_label", f"WITH {_ORD}, y AS ({_yoy_sql('o', ['orders', 'revenue'])}) SELECT year, orders_yoy_label, revenue_yoy_label FROM y")
def yoy_labels(spark, d):
    return year_over_year(_orders_by_year(spark, d), ["orders", "revenue"], labels=True).select(
        "year", "orders_yoy_label", "revenue_yoy_label")


@query("yoy_by_group", f"""WITH g AS (SELECT o_orderpriority AS priority, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders FROM orders GROUP BY ALL)
SELECT c.priority, c.year, c.orders, CAST(c.orders - p.orders AS DOUBLE) / p.orders AS orders_yoy
FROM g c LEFT JOIN g p ON p.priority = c.priority AND p.year = c.year - 1""")
def yoy_by_group(spark, d):
    g = S.table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").alias("year")).agg(
        F.count("*").alias("orders"))
    return year_over_year(g, ["orders"], by=["priority"])


@query("ratio_to_gdp", f"""WITH {_ORD}, {S.V_GDP}
SELECT o.year, revenue, gdp_usd, revenue / nullif(gdp_usd, 0) * 100 AS revenue_pct_gdp
FROM o LEFT JOIN (SELECT year, max(gdp_usd) AS gdp_usd FROM v_gdp WHERE country_code = 'NATION_3' GROUP BY 1) g ON o.year = g.year""")
def ratio_to_gdp(spark, d):
    gdp = S.raw_gdp(spark, d).where("country_code = 'NATION_3'").groupBy("year").agg(F.max("gdp_usd").alias("gdp_usd"))
    o = _orders_by_year(spark, d).drop("orders").join(gdp, "year", "left")
    return o.withColumn("revenue_pct_gdp", ratio_percent("revenue", "gdp_usd"))


_PEARSON = """round((n * sxy - sx * sy) / nullif(sqrt((n * sxx - sx * sx) * (n * syy - sy * sy)), 0), 9)"""


@query("pearson_daily", f"""WITH x AS (SELECT CAST(ts AS DATE) AS d, CAST(count(*) AS DOUBLE) AS x,
  {S.fixed_avg('value', "event_type = 'click'")} AS y FROM events GROUP BY 1),
s AS (SELECT count(*)::DOUBLE AS n, sum(x) AS sx, sum(y) AS sy, sum(x*y) AS sxy, sum(x*x) AS sxx, sum(y*y) AS syy FROM x WHERE y IS NOT NULL)
SELECT CAST(n AS BIGINT) AS days, {_PEARSON} AS r FROM s""")
def pearson_daily(spark, d):
    from tidemart.functions.exact import exact_avg
    e = S.table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(
        F.count("*").alias("x"), exact_avg("value", "event_type = 'click'").alias("y"))
    return e.agg(F.count("y").alias("days"), F.round(pearson("x", "y"), 9).alias("r"))


@query("pearson_no_variance", """SELECT event_type, NULL::DOUBLE AS r, CASE WHEN max(value) > min(value) THEN -1.0::DOUBLE END AS falling, count(*) AS n FROM events GROUP BY 1""")
def pearson_no_variance(spark, d):
    """A constant series has no correlation: null, not an error; beside it a series that falls as the values rise."""
    e = S.table(spark, d, "events").withColumns({"flat": F.lit(3.0), "less": 5 - F.col("value") * 2})
    return e.groupBy("event_type").agg(pearson("value", "flat").alias("r"), F.round(pearson("value", "less"), 9).alias("falling"), F.count("*").alias("n"))


_BAND = """CASE WHEN mean_value > limit_value THEN 'red' WHEN mean_value > limit_value * CAST(0.8 AS DOUBLE) THEN 'yellow'
WHEN mean_value IS NOT NULL THEN 'green' END AS band"""


_LIMIT = "CASE parameter WHEN 'click' THEN 7000 WHEN 'view' THEN 9500 ELSE 8 END::DOUBLE"


@query("threshold_bands", f"""{_A} SELECT date_key, parameter, avg_value AS mean_value,
CASE WHEN avg_value > {_LIMIT} THEN 'red' WHEN avg_value > {_LIMIT} * CAST(0.8 AS DOUBLE) THEN 'yellow' ELSE 'green' END AS band FROM air_fact""")
def threshold_bands(spark, d):
    return S.air_fact(spark, d).select("date_key", "parameter", F.col("avg_value").alias("mean_value"), band("avg_value", limit_of("parameter", S.LIMITS)).alias("band"))


@query("top10_zones", f"""{_T} SELECT zone_name, sum(trip_count)::BIGINT AS total_trips FROM trip_fact JOIN v_zone ON zone_key = location_id
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def top10_zones(spark, d):
    return marts.top_zones(S.model(spark, d))


@query("top10_stations", f"""{_B} SELECT location_id, max(city) AS city, max(latitude) AS latitude, max(longitude) AS longitude,
{S.fixed_avg('avg_value')} AS mean_value FROM air_fact WHERE parameter = 'click' GROUP BY 1 ORDER BY mean_value DESC, 1 LIMIT 10""")
def top10_stations(spark, d):
    return marts.top_stations(S.model(spark, d), "click")


@query("monthly_combo", f"""WITH m AS (SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
CAST(day(ts) AS INTEGER) AS day, count(*) AS events, {', '.join(f"{S.fixed_avg('value', chr(39).join(['event_type = ', p, '']))} AS avg_{p}" for p in S.POLLUTANTS)}
FROM events GROUP BY ALL) SELECT * FROM m""")
def monthly_combo(spark, d):
    from tidemart.functions.exact import exact_avg
    e = S.table(spark, d, "events")
    return e.groupBy(F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day")).agg(
        F.count("*").alias("events"),
        *[exact_avg("value", f"event_type = '{p}'").alias(f"avg_{p}") for p in S.POLLUTANTS])


# ---- marts -----------------------------------------------------------------------------------

_M1 = ["total_trips", "total_revenue_usd", "avg_fare_usd"]


@query("mart_m1", f"{_T}, {_KPI} {_yoy_sql('kpi', _M1)}")
def mart_m1(spark, d):
    return marts.mobility_by_year(S.model(spark, d))


_ALL_KPI = ["total_trips", "total_revenue_usd", "total_revenue_eur", "avg_fare_usd"]


@query("yoy_all_measures", f"{_T}, {_KPI} {_yoy_sql('kpi', _ALL_KPI)}")
def yoy_all_measures(spark, d):
    """All four measures with change and label."""
    return marts.mobility_by_year(S.model(spark, d), marts.KPIS)


@query("measure_grand_total", f"""{_B} SELECT (SELECT sum(trip_count)::BIGINT FROM trip_fact) AS total_trips, (SELECT {S.fixed_avg('avg_fare_usd')} FROM trip_fact) AS avg_fare_usd,
{_POL} FROM air_fact""")
def measure_grand_total(spark, d):
    """No grouping: one row over two facts, without a join."""
    return S.model(spark, d).evaluate(["total_trips", "avg_fare_usd", *_POLS])


@query("mart_m1_month_slice", f"""{_T}, kpi AS (SELECT year, sum(trip_count)::BIGINT AS total_trips FROM trip_fact WHERE date_key // 100 % 100 = 3 GROUP BY 1)
{_yoy_sql('kpi', ['total_trips'])}""")
def mart_m1_month_slice(spark, d):
    return marts.mobility_by_year(S.model(spark, d), ["total_trips"], slicer=F.col("month") == 3)


@query("mart_m1_all_dates_before", f"""{_T}, kpi AS (SELECT year, sum(trip_count)::BIGINT AS total_trips FROM trip_fact WHERE date_key // 100 % 100 = 3 GROUP BY 1),
whole AS (SELECT year, sum(trip_count)::BIGINT AS total_trips FROM trip_fact GROUP BY 1)
{_yoy_sql('kpi', ['total_trips']).replace('LEFT JOIN kpi p', 'LEFT JOIN whole p')}""")
def mart_m1_all_dates_before(spark, d):
    return marts.mobility_by_year(S.model(spark, d), ["total_trips"], slicer=F.col("month") == 3, all_dates_before=True)


@query("mart_m2", f"{_T} SELECT make_date(date_key // 10000, date_key // 100 % 100, date_key % 100) AS date, sum(trip_count)::BIGINT AS total_trips FROM trip_fact GROUP BY 1")
def mart_m2(spark, d):
    return marts.trips_per_day(S.model(spark, d))


@query("mart_m3", f"""{_T} SELECT zone_name, sum(trip_count)::BIGINT AS total_trips FROM trip_fact JOIN v_zone ON zone_key = location_id
WHERE year = 1998 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def mart_m3(spark, d):
    return marts.top_zones(S.model(spark, d).where("date", F.col("year") == 1998))


@query("mart_m4", f"""{_B}, c AS (SELECT parameter, {S.fixed_avg('avg_value')} AS mean_value,
CASE parameter WHEN 'click' THEN 7000 WHEN 'view' THEN 9500 ELSE 8 END::DOUBLE AS limit_value FROM air_fact GROUP BY 1)
SELECT parameter, mean_value, limit_value, {_BAND} FROM c""")
def mart_m4(spark, d):
    return marts.pollutant_cards(S.model(spark, d), S.LIMITS)


@query("mart_m5", f"""{_B} SELECT make_date(date_key // 10000, date_key // 100 % 100, date_key % 100) AS date, {_POL},
7000::DOUBLE AS limit_click, 9500::DOUBLE AS limit_view, 8::DOUBLE AS limit_error FROM air_fact GROUP BY 1""")
def mart_m5(spark, d):
    return marts.pollutant_trend(S.model(spark, d), _POLS, S.LIMITS)


@query("mart_m6", f"""{_B} SELECT location_id, max(city) AS city, max(latitude) AS latitude, max(longitude) AS longitude,
{S.fixed_avg('avg_value')} AS mean_value FROM air_fact WHERE parameter = 'click' GROUP BY 1""")
def mart_m6(spark, d):
    return marts.station_map(S.model(spark, d), "click")


@query("mart_m7", f"""{_B}, t AS (SELECT year, CAST(date_key // 100 % 100 AS INTEGER) AS month, sum(trip_count)::BIGINT AS total_trips FROM trip_fact GROUP BY ALL),
a AS (SELECT year, CAST(date_key // 100 % 100 AS INTEGER) AS month, {_POL} FROM air_fact GROUP BY ALL)
SELECT * FROM t JOIN a USING (year, month)""")
def mart_m7(spark, d):
    return marts.monthly_combo(S.model(spark, d), _POLS)


_DAYS = f"""days AS (SELECT * FROM (SELECT date_key, CAST(sum(trip_count) AS DOUBLE) AS x FROM trip_fact GROUP BY 1)
JOIN (SELECT date_key, {_POL} FROM air_fact GROUP BY 1) USING (date_key))"""
_R = " UNION ALL ".join(f"""SELECT 'avg_{p}' AS measure, {_PEARSON} AS r FROM (SELECT count(*)::DOUBLE AS n, sum(x) AS sx, sum(y) AS sy,
sum(x*y) AS sxy, sum(x*x) AS sxx, sum(y*y) AS syy FROM (SELECT x, avg_{p} AS y FROM days WHERE avg_{p} IS NOT NULL))""" for p in S.POLLUTANTS)


@query("mart_m8", f"{_B}, {_DAYS} {_R}")
def mart_m8(spark, d):
    return marts.correlations(S.model(spark, d), _POLS).withColumn("r", F.round("r", 9))


@query("mart_m8_year", f"{_B}, {_DAYS.replace('FROM air_fact', 'FROM air_fact WHERE year = 1998')} {_R}")
def mart_m8_year(spark, d):
    return marts.correlations(S.model(spark, d), _POLS, year=1998).withColumn("r", F.round("r", 9))


@query("mart_m9", f"{_T}, {_KPI} SELECT year, total_revenue_usd, total_revenue_eur FROM kpi")
def mart_m9(spark, d):
    return marts.revenue_by_year(S.model(spark, d))


@query("mart_m10", f"""{_T}, {_KPI}, {S.V_GDP} SELECT kpi.year, total_revenue_usd, gdp_usd, total_revenue_usd / nullif(gdp_usd, 0) * 100 AS revenue_pct_gdp
FROM kpi LEFT JOIN (SELECT year, gdp_usd FROM v_gdp WHERE country_code = 'NATION_3') g ON kpi.year = g.year""")
def mart_m10(spark, d):
    return marts.revenue_share_of_gdp(S.model(spark, d), "NATION_3")


@query("mart_m10_gdp", f"WITH {S.V_GDP} SELECT year, gdp_usd FROM v_gdp WHERE country_code = 'NATION_3'")
def mart_m10_gdp(spark, d):
    return marts.gdp_of(S.model(spark, d), "NATION_3")


@query("selected_gdp", f"""WITH {S.V_GDP} SELECT 'both' AS chosen, max(gdp_usd) AS gdp_usd FROM v_gdp WHERE country_code = 'NATION_3' AND year = 1996
UNION ALL SELECT 'date', max(gdp_usd) FROM v_gdp WHERE country_code = 'NATION_3' AND year = 1997
UNION ALL SELECT 'none', max(gdp_usd) FROM v_gdp WHERE country_code = 'NATION_3'""")
def selected_gdp(spark, d):
    gdp = S.raw_gdp(spark, d)
    pick = lambda name, **kw: marts.selected_gdp(gdp, "NATION_3", **kw).select(F.lit(name).alias("chosen"), "gdp_usd")
    return pick("both", gdp_year=1996, date_year=1997).unionByName(pick("date", date_year=1997)).unionByName(pick("none"))


@query("mart_m11", f"WITH {S.V_FX} SELECT CAST(year(d) AS INTEGER) AS year, {S.fixed_avg('rate')} AS avg_fx_rate FROM v_fx GROUP BY 1")
def mart_m11(spark, d):
    return marts.fx_by_year(S.model(spark, d))


@query("mart_m11_trend", f"WITH {S.V_FX} SELECT d AS date, rate AS usd_eur_rate FROM v_fx")
def mart_m11_trend(spark, d):
    return marts.fx_trend(S.model(spark, d))


_ROLE = f"{_T}, seen AS (SELECT * FROM trip_fact WHERE zone_key IN (SELECT location_id FROM v_zone WHERE service_zone = 'ASIA'))"


@query("mart_m12", f"{_ROLE}, {_KPI.replace('FROM trip_fact', 'FROM seen')} {_yoy_sql('kpi', _M1)}")
def mart_m12(spark, d):
    return marts.mobility_by_year(S.model(spark, d).as_role("Asia Operator"))


@query("mart_m12_days", f"{_ROLE} SELECT make_date(date_key // 10000, date_key // 100 % 100, date_key % 100) AS date, sum(trip_count)::BIGINT AS total_trips FROM seen GROUP BY 1")
def mart_m12_days(spark, d):
    return marts.trips_per_day(S.model(spark, d).as_role("Asia Operator"))


@query("mart_m12_zones", f"{_ROLE} SELECT zone_name, sum(trip_count)::BIGINT AS total_trips FROM seen JOIN v_zone ON zone_key = location_id GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def mart_m12_zones(spark, d):
    return marts.top_zones(S.model(spark, d).as_role("Asia Operator"))


@query("mart_m12_air", f"{_B} SELECT parameter, count(*) AS rows FROM air_fact GROUP BY 1")
def mart_m12_air(spark, d):
    """A zone role leaves the other fact whole."""
    air = S.model(spark, d).as_role("Asia Operator").tables["air"]
    return air.groupBy("parameter").agg(F.count("*").alias("rows"))


_PANEL = lambda name, f, agg: (f"SELECT '{name}' AS panel, epoch_us(time_bucket(INTERVAL 1 HOUR, datetime)) // 1000000 + 3600 AS end_s, "  # noqa: E731
                               f"'{f}' AS field, {agg} AS value FROM v_weather GROUP BY 2")


@query("mart_m13", f"WITH {S.V_WEATHER}, p AS (" + " UNION ALL ".join([
    _PANEL("temperature", "temperature_c", S.fixed_avg("temperature_c")), _PANEL("temperature", "feels_like_c", S.fixed_avg("feels_like_c")),
    _PANEL("precipitation", "precipitation_mm", S.fixed_sum("precipitation_mm", 4)),
    _PANEL("wind", "wind_speed_kmh", S.fixed_avg("wind_speed_kmh")), _PANEL("humidity", "humidity_pct", S.fixed_avg("humidity_pct"))])
    + ") SELECT * FROM p WHERE value IS NOT NULL")
def mart_m13(spark, d):
    from tidemart.functions.casts import rename_map
    from tidemart.plans.silver import WEATHER_RENAMES
    w = rename_map(S.raw_weather(spark, d), WEATHER_RENAMES)
    return marts.weather_panels(w).select("panel", F.unix_seconds(F.col("time").cast("timestamp")).alias("end_s"), "field", "value")


# ---- the year slicer of the report pages ----------------------------------------------------

def _year():
    return F.col("year") == 1998


_IN = "(SELECT * FROM air_fact WHERE year = 1998)"


@query("mart_m4_year", f"""{_B}, c AS (SELECT parameter, {S.fixed_avg('avg_value')} AS mean_value, {_LIMIT} AS limit_value FROM {_IN} GROUP BY 1)
SELECT parameter, mean_value, limit_value, {_BAND} FROM c""")
def mart_m4_year(spark, d):
    return marts.pollutant_cards(S.model(spark, d), S.LIMITS, slicer=_year())


@query("mart_m5_year", f"""{_B} SELECT make_date(date_key // 10000, date_key // 100 % 100, date_key % 100) AS date, {_POL},
7000::DOUBLE AS limit_click, 9500::DOUBLE AS limit_view, 8::DOUBLE AS limit_error FROM {_IN} GROUP BY 1""")
def mart_m5_year(spark, d):
    return marts.pollutant_trend(S.model(spark, d), _POLS, S.LIMITS, slicer=_year())


@query("mart_m6_year", f"""{_B} SELECT location_id, max(city) AS city, max(latitude) AS latitude, max(longitude) AS longitude,
{S.fixed_avg('avg_value')} AS mean_value FROM {_IN} WHERE parameter = 'view' GROUP BY 1""")
def mart_m6_year(spark, d):
    return marts.station_map(S.model(spark, d), "view", slicer=_year())


@query("mart_m7_year", f"""{_B}, t AS (SELECT year, CAST(date_key // 100 % 100 AS INTEGER) AS month, sum(trip_count)::BIGINT AS total_trips FROM trip_fact GROUP BY ALL),
a AS (SELECT year, CAST(date_key // 100 % 100 AS INTEGER) AS month, {_POL} FROM {_IN} GROUP BY ALL)
SELECT * FROM t JOIN a USING (year, month)""")
def mart_m7_year(spark, d):
    return marts.monthly_combo(S.model(spark, d), _POLS, slicer=_year())


@query("mart_m9_year", f"{_T}, {_KPI} SELECT year, total_revenue_usd, total_revenue_eur FROM kpi WHERE year = 1998")
def mart_m9_year(spark, d):
    return marts.revenue_by_year(S.model(spark, d), slicer=_year())


@query("sums_any_double", """WITH t AS (SELECT event_type, sum((event_id % 1000)::BIGINT) AS k, count(*) AS n FROM events GROUP BY 1)
SELECT event_type, k::DOUBLE * pow(2.0, -1000) AS tiny_beside_huge, CASE event_type WHEN 'error' THEN 'NaN' WHEN 'view' THEN 'Infinity' ELSE 'finite' END AS odd,
       2 * n::DOUBLE * pow(2.0, 900) + 0.0 AS huge, 3 * n AS tiny_beside_huge_count FROM t""")
def sums_any_double(spark, d):
    """Each event gives a number near 1e-300 and two near 1e300 of opposite signs, which must leave the small ones whole; NaN and infinities in some groups."""
    from tidemart.operators.sums import error_free_sums
    e = S.table(spark, d, "events").select("event_id", "event_type")
    big = "power(2D, 900) * (event_id % 97 + 1)"
    rows = e.selectExpr("event_type", "event_id", f"explode(array((event_id % 1000) * power(2D, -1000), {big}, -{big})) AS x")
    odd = "CASE WHEN event_type = 'error' AND event_id % 7 = 0 THEN double('NaN') WHEN event_type = 'view' AND event_id % 3 = 0 THEN double('infinity') ELSE x END"
    got = error_free_sums(rows, ["event_type"], {"tiny_beside_huge": "x", "odd": odd, "huge": "CASE WHEN abs(x) > 1 THEN power(2D, 900) END"})
    state = F.when(F.isnan("odd"), "NaN").when(F.col("odd") == float("inf"), "Infinity").otherwise("finite")
    return got.select("event_type", "tiny_beside_huge", state.alias("odd"), "huge", "tiny_beside_huge_count")


@query("month_label", f"""SELECT month, month_name, sum(n)::BIGINT AS orders FROM (SELECT CAST(month(o_orderdate) AS INTEGER) AS month,
monthname(o_orderdate) AS month_name, count(*) AS n FROM orders GROUP BY ALL) GROUP BY ALL ORDER BY month""")
def month_label(spark, d):
    """A label carried with the number it is sorted by."""
    o = S.table(spark, d, "orders")
    return o.groupBy(F.month("o_orderdate").alias("month"), F.date_format("o_orderdate", "MMMM").alias("month_name")).agg(
        F.count("*").alias("orders")).orderBy("month")
