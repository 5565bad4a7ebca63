"""Quality suites over the driver tables."""
from pyspark.sql import functions as F

from tidemart.operators import quality as Q
from workload import standins as S
from workload.registry import query


def _suites(spark, d):
    t = lambda n: S.table(spark, d, n)
    orders = t("orders").withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return {
        "lineitem": lambda: Q.suite_results(t("lineitem"), "lineitem", [
            Q.not_null("l_orderkey"), Q.in_range("l_quantity", 1, 40), Q.in_range("l_discount", 0, 0.1),
            Q.in_set("l_returnflag", ["A", "N"]), Q.min_rows(1000), Q.unique("l_orderkey"),
            Q.foreign_key("l_orderkey", "orders", "o_orderkey"), Q.foreign_key("l_orderkey", "final_orders", "o_orderkey")],
            {"orders": t("orders"), "final_orders": t("orders").where("o_orderstatus = 'F'")}),
        "orders": lambda: Q.suite_results(orders, "orders", [
            Q.not_null("o_orderkey"), Q.not_null("o_orderpriority"), Q.unique("o_orderkey"), Q.unique("o_orderpriority"),
            Q.in_set("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]),
            Q.in_range("o_totalprice", 0, strict_min=True, name="o_totalprice > 0", wording="rows"), Q.min_rows(10 ** 9)]),
        "events": lambda: Q.suite_results(t("events"), "events", [
            Q.not_null("ts", wording="rows"), Q.unique("event_id"), Q.in_range("value", 0, 200, name="value in [0, 200]", wording="rows"),
            Q.in_set("event_type", ["click", "view", "error"])]),
        "broken": lambda: Q.suite_results(t("events"), "broken", [Q.not_null("no_such_column")]),
    }


_C = "replace(format('{:,}', n), ',', ',')"
_GE = "CASE WHEN n = 0 THEN format('{:,}', total) || ' rows OK' ELSE format('{:,}', n) || ' / ' || format('{:,}', total) || ' rows failed' END"


def _line(table, name, count, text, frm=None):
    total = f"(SELECT count(*) FROM {table})"
    return f"SELECT '{table}' AS \"table\", '{name}' AS name, n = 0 AS passed, {text} AS observed FROM (SELECT {count} AS n, {total} AS total {frm or 'FROM ' + table})"


_NULLS, _RANGE, _SET, _ORPH = ("format('{:,}', n) || ' " + w + "'" for w in ("nulls", "rows outside range", "rows with disallowed values", "orphans"))
_ROWS = "'actual: ' || format('{:,}', total)"
_DUP = lambda t, c: f"FROM (SELECT coalesce(sum(k), 0)::BIGINT AS dup FROM (SELECT count(*) AS k FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))"
_PRI = "nullif(o_orderpriority, '5-LOW')"
_ALL = " UNION ALL ".join([
    _line("lineitem", "l_orderkey not null", "count(*) FILTER (WHERE l_orderkey IS NULL)", _NULLS),
    _line("lineitem", "l_quantity in [1, 40]", "count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 40)", _RANGE),
    _line("lineitem", "l_discount in [0, 0.1]", "count(*) FILTER (WHERE l_discount < 0 OR l_discount > CAST(0.1 AS DOUBLE))", _RANGE),
    _line("lineitem", "l_returnflag in set (2 values)", "count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N'))", _SET),
    _line("lineitem", "row count >= 1,000", "greatest(1000 - count(*), 0)", _ROWS),
    _line("lineitem", "l_orderkey unique", "dup", _GE, _DUP("lineitem", "l_orderkey")),
    _line("lineitem", "FK l_orderkey -> orders.o_orderkey", "count(*)", _ORPH, "FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"),
    _line("lineitem", "FK l_orderkey -> final_orders.o_orderkey", "count(*)", _ORPH, "FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"),
    _line("orders", "o_orderkey not null", "count(*) FILTER (WHERE o_orderkey IS NULL)", _NULLS),
    _line("orders", "o_orderpriority not null", f"count(*) FILTER (WHERE {_PRI} IS NULL)", _NULLS),
    _line("orders", "o_orderkey unique", "dup", _GE, _DUP("orders", "o_orderkey")),
    _line("orders", "o_orderpriority unique", "dup", _GE, _DUP("orders", _PRI)),
    _line("orders", "o_orderpriority in set (4 values)", f"count(*) FILTER (WHERE {_PRI} NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED'))", _SET),
    _line("orders", "o_totalprice > 0", "count(*) FILTER (WHERE o_totalprice <= 0)", _GE),
    _line("orders", "row count >= 1,000,000,000", "greatest(1000000000 - count(*), 0)", _ROWS),
    _line("events", "ts not null", "count(*) FILTER (WHERE ts IS NULL)", _GE),
    _line("events", "event_id unique", "dup", _GE, _DUP("events", "event_id")),
    _line("events", "value in [0, 200]", "count(*) FILTER (WHERE value < 0 OR value > 200)", _GE),
    _line("events", "event_type in set (3 values)", "count(*) FILTER (WHERE event_type NOT IN ('click', 'view', 'error'))", _SET),
])


def _results(spark, d, names=("lineitem", "orders", "events")):
    from functools import reduce
    suites = _suites(spark, d)
    return reduce(lambda a, b: a.unionByName(b), [suites[n]() for n in names])


@query("dq_results", _ALL)
def dq_results(spark, d):
    return _results(spark, d)


@query("dq_summary", f"""WITH r AS ({_ALL}) SELECT "table", count(*) AS checks, count(*) FILTER (WHERE passed) AS passed,
count(*) FILTER (WHERE NOT passed) AS failed FROM r GROUP BY 1""")
def dq_summary(spark, d):
    return Q.summary(_results(spark, d))


@query("dq_report_lines", f"""WITH r AS ({_ALL}) SELECT CASE WHEN bool_and(passed) THEN 'pass  ' ELSE 'FAIL  ' END || "table" || ': ' ||
count(*) FILTER (WHERE passed) || ' of ' || count(*) AS line FROM r GROUP BY "table" UNION ALL SELECT '      ' || name || ' <- ' || observed FROM r WHERE NOT passed""")
def dq_report_lines(spark, d):
    return Q.report_lines(_results(spark, d))


@query("dq_isolation", f"""SELECT "table", name, passed FROM ({_ALL}) WHERE "table" = 'events' UNION ALL SELECT 'broken', 'suite execution', false""")
def dq_isolation(spark, d):
    """A suite that cannot run becomes one failed row; the other suites still report."""
    s = _suites(spark, d)
    return Q.run_suites(spark, {n: s[n] for n in ("broken", "events")}).drop("observed")


@query("range_violations", """SELECT count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 40) AS quantity,
count(*) FILTER (WHERE l_extendedprice > 90000) AS price, count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) AS flag, count(*) AS rows FROM lineitem""")
def range_violations(spark, d):
    li = S.table(spark, d, "lineitem")
    return li.agg(Q.in_range("l_quantity", 1, 40).bad().alias("quantity"), Q.in_range("l_extendedprice", None, 90000).bad().alias("price"),
                  Q.in_set("l_returnflag", ["A", "N"]).bad().alias("flag"), F.count("*").alias("rows"))
