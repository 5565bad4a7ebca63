import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemart.operators import incremental as I
from tidemart.operators import keys
from tidemart.operators import write as W


def test_watermark_of_missing_and_empty_tables(spark, db):
    t = f"{db}.t"
    assert I.watermark(spark, t, "k") is None
    W.write_full(spark.createDataFrame([], "k INT"), t)
    assert I.watermark(spark, t, "k") is None and I.run_mode(spark, t, False) == "full"
    W.write_full(spark.createDataFrame([(3,), (5,)], "k INT"), t)
    assert I.watermark(spark, t, "k") == 5
    assert I.run_mode(spark, t, False) == "incremental" and I.run_mode(spark, t, True) == "full"


def test_watermark_is_strict_and_lookback_is_inclusive(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in (1, 2, 3, 4)], "t TIMESTAMP")
    mark = dt.datetime(2024, 1, 3)
    assert I.increment_since(df, mark, "t").count() == 1
    assert I.increment_since(df, mark, "t", lookback_days=1).count() == 3
    assert I.increment_since(df, None, "t").count() == 4


def test_empty_source(spark):
    empty = spark.createDataFrame([], "k INT")
    with pytest.raises(ValueError):
        I.guard_source(empty, "full", "readings")
    assert I.guard_source(empty, "incremental", "readings") is False
    assert I.guard_source(spark.range(1), "full", "readings") is True


def test_tail_filter_prunes_partitions(spark, db):
    t = f"{db}.t"
    df = spark.range(0, 400).select(F.timestamp_seconds(F.lit(1672531200) + F.col("id") * 86400).alias("at"))
    W.append(df.withColumns({"year": F.year("at"), "month": F.month("at")}), t, ["year", "month"])
    tail = I.tail_of(spark.table(t), dt.date(2024, 1, 10), "at")
    plan = tail._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "> 2024" in filters and "= 2024" in filters and ">= 1" in filters
    assert tail.count() == len([r for r in df.collect() if r["at"] >= dt.datetime(2024, 1, 10)])
    assert len(tail.inputFiles()) == len(spark.table(t).where("year = 2024").inputFiles())


def test_reaggregation_repairs_late_days_only(spark):
    build = lambda d: d.groupBy(F.col("k").alias("date_key")).agg(F.count("*").alias("n"))
    old = spark.createDataFrame([(20240101, 5), (20240108, 5), (20240110, 5)], "date_key INT, n BIGINT")
    src = spark.createDataFrame([(20240101, dt.datetime(2024, 1, 1)), (20240108, dt.datetime(2024, 1, 8)), (20240108, dt.datetime(2024, 1, 8)),
                                 (20240111, dt.datetime(2024, 1, 11))], "k INT, at TIMESTAMP")
    got = I.reaggregated(old, src, build, "at", days=7, partitioned=False)
    # the 10th has no source rows any more, the 1st is older than the window
    assert rows(got) == [(20240101, 5), (20240108, 2), (20240111, 1)]
    assert rows(I.reaggregated(old.where("n > 9"), src, build, "at", partitioned=False)) == [(20240101, 1), (20240108, 2), (20240111, 1)]


def test_the_ledger_knows_files_by_place_length_and_time(spark, db):
    ledger, at = f"{db}.ledger", dt.datetime(2024, 1, 1)
    ddl = "path STRING, length BIGINT, modified TIMESTAMP"
    files = spark.createDataFrame([("trips_2024-01", 5, at), ("trips_2024-02", 5, at)], ddl)
    assert I.next_run(spark, ledger, "trips") == 1
    todo, n = I.new_files(spark, files, ledger, "trips")
    assert n == 2 and I.record_run(todo.where("path LIKE '%01'"), ledger, "trips", 1) == 1
    assert I.new_files(spark, files, ledger, "trips")[1] == 1
    assert I.new_files(spark, files, ledger, "other")[1] == 2
    again = spark.createDataFrame([("trips_2024-01", 6, at), ("trips_2024-01", 5, at + dt.timedelta(1)), ("trips_2024-01", 5, at)], ddl)
    assert I.new_files(spark, again, ledger, "trips")[1] == 2
    assert I.next_run(spark, ledger, "trips") == 2 and I.next_run(spark, ledger, "other") == 1


def test_marks_of_consumers(spark, db):
    marks = f"{db}.marks"
    assert I.consumed(spark, marks, "a") == 0
    for consumer, run in (("a", 1), ("b", 5), ("a", 2)):
        I.mark_consumed(spark, marks, consumer, run)
    assert (I.consumed(spark, marks, "a"), I.consumed(spark, marks, "b"), I.consumed(spark, marks, "c")) == (2, 5, 0)


def test_exactly_the_touched_days_are_built_again(spark, db):
    t, s = f"{db}.fact", f"{db}.source"
    at = F.timestamp_seconds(F.lit(1609459200) + F.col("id") * 43200)  # two rows a day from 2021 on
    src = spark.range(1600).select(at.alias("at"), "id")
    W.append(src.withColumns({"year": F.year("at"), "month": F.month("at")}), s, ["year", "month"])
    build = lambda df: df.groupBy(F.to_date("at").alias("day")).agg(F.count("*").alias("n"), F.max("id").alias("top")).select(
        F.expr("year(day) * 10000 + month(day) * 100 + day(day)").alias("date_key"), "n", "top", F.year("day").alias("year"))
    W.write_full(build(spark.table(s)), t, ["year"])
    before = {r["date_key"]: r for r in spark.table(t).collect()}
    late = spark.createDataFrame([(dt.datetime(2021, 3, 5, 7), 99999), (dt.datetime(2022, 7, 1, 7), 88888)], "at TIMESTAMP, id BIGINT")
    W.append(late.withColumns({"year": F.year("at"), "month": F.month("at")}), s)
    untouched = {r[0] for r in spark.table(t).where("year = 2023").select(F.input_file_name()).collect()}
    got = I.rebuild_days(t, spark.table(s), {dt.date(2021, 3, 5), dt.date(2022, 7, 1), dt.date(2022, 7, 1)}, build, "at")
    assert got == {"days": 2, "built": 2, "written": 365 + 365}
    after = {r["date_key"]: r for r in spark.table(t).collect()}
    assert {k for k in after if after[k] != before.get(k)} == {20210305, 20220701} and len(after) == len(before)
    assert after[20210305]["n"] == 3 and after[20220701]["top"] == 88888
    assert untouched and untouched == {r[0] for r in spark.table(t).where("year = 2023").select(F.input_file_name()).collect()}
    # a day whose rows are gone goes too; no day, no write
    assert I.rebuild_days(t, spark.table(s).where("id > 5"), [dt.date(2021, 1, 1)], build, "at")["built"] == 0
    assert spark.table(t).where("date_key = 20210101").count() == 0
    assert I.rebuild_days(t, spark.table(s), [], build, "at") == {"days": 0, "built": 0, "written": 0}


def test_registered_keys_stay(spark, db):
    reg = f"{db}.keys"
    frame = lambda *ds: spark.createDataFrame([(d and dt.date(2024, 1, d), i) for i, d in enumerate(ds)], "date DATE, v INT")
    number = lambda df: {r["date"] and r["date"].day: r["k"] for r in keys.registered_keys(df, reg, ["date"], "k", "year(date)").collect()}
    assert number(frame(5, 9, 7)) == {5: 1, 7: 2, 9: 3}
    assert number(frame(9, 3, 8, None)) == {9: 3, None: 4, 3: 5, 8: 6}
    assert number(frame(5, None, 3)) == {5: 1, None: 4, 3: 5}
    assert spark.table(reg).count() == 6 and number(frame()) == {}


def test_month_grid_and_missing(spark):
    grid = keys.month_grid(spark, 2023, 2024)
    assert grid.count() == 24
    have = spark.createDataFrame([(2023, m) for m in range(1, 13)] + [(2024, 2)], "year INT, month INT")
    got = keys.missing_periods(grid, have, ["year", "month"])
    assert rows(got) == sorted([(2024, m) for m in range(1, 13) if m != 2], key=str)


def test_skip_if_current():
    assert I.is_current(5, 5) and not I.is_current(0, 0) and not I.is_current(5, 4)
