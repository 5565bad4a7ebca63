import datetime as dt

from conftest import rows

from tidemart.operators import quality as Q
from tidemart.plans import suites


def test_check_semantics(spark):
    df = spark.createDataFrame([(1, 0.0, "a"), (1, 5.0, "b"), (2, 5.1, None), (None, None, "z"), (None, -1.0, "a")], "k INT, x DOUBLE, s STRING")
    parent = spark.createDataFrame([(1,)], "id INT")
    got = Q.suite_results(df, "t", [
        Q.not_null("k"), Q.in_range("x", 0, 5), Q.in_range("x", 0, 5, strict_min=True, name="x in (0, 5]", wording="rows"),
        Q.in_set("s", ["a", "b"]), Q.unique("k"), Q.unique("s"), Q.foreign_key("k", "parent", "id"), Q.min_rows(5), Q.min_rows(6),
        Q.not_null("s", wording="rows"), Q.in_range("x", name="anything")], {"parent": parent})
    assert rows(got) == sorted([
        ("t", "k not null", False, "2 nulls"), ("t", "x in [0, 5]", False, "2 rows outside range"),
        ("t", "x in (0, 5]", False, "3 / 5 rows failed"), ("t", "s in set (2 values)", False, "1 rows with disallowed values"),
        ("t", "k unique", False, "2 / 5 rows failed"), ("t", "s unique", False, "2 / 5 rows failed"),
        ("t", "FK k -> parent.id", False, "1 orphans"), ("t", "row count >= 5", True, "actual: 5"),
        ("t", "row count >= 6", False, "actual: 5"), ("t", "s not null", False, "1 / 5 rows failed"),
        ("t", "anything", True, "0 rows outside range")], key=lambda r: tuple((True, str(v)) for v in r))


def test_empty_table(spark):
    got = Q.suite_results(spark.createDataFrame([], "k INT"), "t", [Q.not_null("k"), Q.unique("k"), Q.min_rows(1)])
    assert rows(got) == [("t", "k not null", True, "0 nulls"), ("t", "k unique", True, "0 rows OK"), ("t", "row count >= 1", False, "actual: 0")]


def test_suite_with_separate_checks_only(spark):
    got = Q.suite_results(spark.range(1200), "t", [Q.unique("id")])
    assert rows(got) == [("t", "id unique", True, "1,200 rows OK")]


def test_failing_suite_is_one_row_and_report_is_grouped(spark):
    def broken():
        raise RuntimeError("no connection")
    ok = lambda: Q.suite_results(spark.range(3), "b_table", [Q.not_null("id"), Q.min_rows(9)])
    res = Q.run_suites(spark, {"a_table": broken, "b_table": ok})
    text = Q.report(res, dt.datetime(2024, 5, 1, 12, 30))
    assert text.splitlines() == [
        "1 of 3 checks hold in 2 tables, 2 fail (2024-05-01 12:30)",
        "FAIL  a_table: 0 of 1", "      suite execution <- error: RuntimeError: no connection",
        "FAIL  b_table: 1 of 2", "      row count >= 9 <- actual: 3"]


def test_suites_cover_twelve_tables():
    c = suites.checks()
    assert len(c) == 12 and sum(len(v) for v in c.values()) == 57
