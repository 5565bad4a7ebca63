import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemart.operators import write as W


def frame(spark, data, ddl="k INT, v STRING, year INT"):
    return spark.createDataFrame(data, ddl)


def test_full_write_may_read_its_own_table_and_change_the_schema(spark, db):
    t = f"{db}.t"
    assert W.write_full(frame(spark, [(1, "a", 2020), (2, "b", 2021)]), t) == 2
    assert W.write_full(spark.table(t).where("k = 2").select("k", F.lit(1.5).alias("x")), t) == 1
    assert rows(spark.table(t)) == [(2, 1.5)]


def test_failed_full_write_leaves_the_old_table(spark, db):
    t = f"{db}.t"
    W.write_full(frame(spark, [(1, "a", 2020)]), t)
    with pytest.raises(Exception):
        W.write_full(frame(spark, [(1, "a", 2020)]).withColumn("k", F.raise_error(F.lit("boom")).cast("int")), t)
    assert rows(spark.table(t)) == [(1, "a", 2020)]


def test_range_write_clears_emptied_partitions_and_keeps_others(spark, db):
    t = f"{db}.t"
    W.write_range(frame(spark, [(1, "a", 2019), (2, "b", 2020), (3, "c", 2021), (4, "d", 2022)]), t, ["year"], 2019, 2022)
    for year in (2025, None):
        with pytest.raises(Exception, match="outside 2020 to 2021"):
            W.write_range(frame(spark, [(9, "z", 2020), (8, "outside", year)]), t, ["year"], 2020, 2021)
    assert len(rows(spark.table(t))) == 4
    assert W.write_range(frame(spark, [(9, "z", 2020)]), t, ["year"], 2020, 2021) == 1
    assert rows(spark.table(t)) == [(1, "a", 2019), (4, "d", 2022), (9, "z", 2020)]


def test_range_write_adds_columns_only_when_asked(spark, db):
    t = f"{db}.t"
    W.write_range(frame(spark, [(1, "a", 2019), (2, "b", 2020)]), t, ["year"], 2019, 2022)
    new = frame(spark, [(3, 2.5, 2020)], "k INT, fee DOUBLE, year INT")
    with pytest.raises(ValueError):
        W.write_range(new, t, ["year"], 2020, 2020)
    W.write_range(new, t, ["year"], 2020, 2020, merge_schema=True)
    assert rows(spark.table(t), "k", "v", "fee", "year") == [(1, "a", None, 2019), (3, None, 2.5, 2020)]


def test_range_write_may_read_its_own_table(spark, db):
    t = f"{db}.t"
    W.write_range(frame(spark, [(1, "a", 2019), (2, "b", 2020)]), t, ["year"], 2019, 2022)
    W.write_range(spark.table(t).where("year = 2020").withColumn("v", F.upper("v")), t, ["year"], 2020, 2020)
    assert rows(spark.table(t)) == [(1, "a", 2019), (2, "B", 2020)]


def test_session_overwrite_mode_is_restored(spark, db):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    test_range_write_may_read_its_own_table(spark, db)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_append_counts_and_orders_columns_by_name(spark, db):
    t = f"{db}.t"
    W.append(frame(spark, [(1, "a", 2019)]), t, ["year"])
    assert W.append(frame(spark, [(2019, "b", 2), (2020, "c", 3)], "year INT, v STRING, k INT"), t) == 2
    assert rows(spark.table(t)) == [(1, "a", 2019), (2, "b", 2019), (3, "c", 2020)]


@pytest.mark.parametrize("parts", [[], ["year"]])
def test_insert_merge(spark, db, parts):
    t = f"{db}.t"
    W.append(frame(spark, [(1, "a", 2019), (None, "n", 2019)]), t, parts)
    src = frame(spark, [(1, "changed", 2019), (2, "new", 2019), (None, "n2", 2020)])
    assert W.merge_insert(src, t, ["k"]) == 2
    want = [(None, "n", 2019), (None, "n2", 2020), (1, "a", 2019), (2, "new", 2019)]
    assert rows(spark.table(t)) == want
    W.merge_insert(src.where("k IS NOT NULL"), t, ["k"])
    assert rows(spark.table(t)) == want


@pytest.mark.parametrize("parts", [[], ["year"]])
def test_upsert_merge(spark, db, parts):
    t = f"{db}.t"
    W.append(frame(spark, [(1, "a", 2019), (2, "b", 2019), (3, "c", 2020), (None, "n", 2019)]), t, parts)
    src = frame(spark, [(1, "A", 2019), (4, "D", 2021)])
    for _ in range(2):
        W.merge_upsert(src, t, ["k"])
        assert rows(spark.table(t)) == [(None, "n", 2019), (1, "A", 2019), (2, "b", 2019), (3, "c", 2020), (4, "D", 2021)]
    W.merge_upsert(src.where("k > 99"), t, ["k"])
    assert spark.table(t).count() == 5


def test_upsert_leaves_untouched_partitions_alone(spark, db):
    t = f"{db}.t"
    W.append(frame(spark, [(1, "a", 2019), (3, "c", 2020)]), t, ["year"])
    before = {r[0] for r in spark.table(t).where("year = 2020").select(F.input_file_name()).collect()}
    W.merge_upsert(frame(spark, [(1, "A", 2019)]), t, ["k"])
    assert {r[0] for r in spark.table(t).where("year = 2020").select(F.input_file_name()).collect()} == before


def test_slice_replacement_drops_null_keys_and_is_repeatable(spark, db):
    t = f"{db}.t"
    W.write_full(frame(spark, [(1, "a", 2019), (5, "b", 2019), (9, "c", 2020), (None, "n", 2020)]), t)
    for _ in range(2):
        W.replace_slice(frame(spark, [(6, "new", 2019)]), t, (F.col("k") < 4) | (F.col("k") > 7))
        assert rows(spark.table(t)) == [(1, "a", 2019), (6, "new", 2019), (9, "c", 2020)]


def test_first_slice_write_creates_the_table(spark, db):
    t = f"{db}.t"
    W.replace_slice(frame(spark, [(6, "new", 2019)]), t, F.col("k") < 4)
    assert rows(spark.table(t)) == [(6, "new", 2019)]


def test_year_replacement_of_a_table_without_year(spark, db):
    t = f"{db}.t"
    W.write_full(spark.createDataFrame([(1, "2019-05-05"), (2, "2020-01-01"), (3, "bad")], "k INT, at STRING"), t)
    W.year_replace(spark.createDataFrame([(9, "2020-07-01", "x")], "k INT, at STRING, extra STRING"), t, 2020, 2020, "at")
    assert rows(spark.table(t), "k", "at", "year", "extra") == [(1, "2019-05-05", 2019, None), (3, "bad", None, None), (9, "2020-07-01", 2020, "x")]


def test_stamp(spark):
    r = W.stamped(spark.range(1)).first()
    assert abs((r["ingestion_timestamp"] - dt.datetime.now()).total_seconds()) < 86400 * 2


def test_null_and_text_partitions_survive_replacement(spark, db):
    t = f"{db}.t"
    data = [(1, "a b", 1), (2, None, 1), (3, "x:y", 1)]
    W.write_full(frame(spark, data, "k INT, p STRING, n INT"), t, ["p"])
    W.write_full(spark.table(t).withColumn("n", F.col("n") + 1), t, ["p"])
    assert rows(spark.table(t), "k", "p", "n") == [(1, "a b", 2), (2, None, 2), (3, "x:y", 2)]
    W.replace_slice(spark.table(t).where("k = 2").withColumn("n", F.lit(9)), t, F.col("k") != 2)
    assert rows(spark.table(t), "k", "n") == [(1, 2), (2, 9), (3, 2)]


def counting(df, seen):
    """The frame with every evaluated row counted."""
    def run(it):
        for batch in it:
            seen.add(batch.num_rows)
            yield batch
    return df.mapInArrow(run, df.schema)


@pytest.mark.parametrize("parts", [[], ["year"]])
@pytest.mark.parametrize("merge", ["merge_insert", "merge_upsert"])
def test_a_merge_evaluates_its_source_once(spark, db, parts, merge):
    t = f"{db}.t"
    W.append(frame(spark, [(k, "old", 2019 + k % 3) for k in range(50)]), t, parts)
    seen = spark.sparkContext.accumulator(0)
    source = counting(frame(spark, [(k, "new", 2019 + k % 3) for k in range(40, 60)]), seen)
    getattr(W, merge)(source, t, ["k"])
    assert seen.value == 20
    assert spark.table(t).count() == 60


def test_a_merge_reports_what_it_added(spark, db):
    t = f"{db}.t"
    W.append(frame(spark, [(1, "a", 2019), (2, "b", 2020)]), t, ["year"])
    src = frame(spark, [(1, "x", 2019), (3, "c", 2020), (4, "d", 2021), (5, "d", 2021)])
    assert W.merge_insert_touching(src, t, ["k"], F.col("v")) == (3, {"c", "d"})
    assert W.merge_insert_touching(src, t, ["k"], F.col("v")) == (0, set())
    assert W.merge_insert_touching(src.where("k > 99"), t, ["k"], F.col("v")) == (0, set())


def test_an_untyped_column_may_be_merged(spark, db):
    t = f"{db}.t"
    W.append(frame(spark, [(1, "a", 2019)]), t, ["year"])
    assert W.merge_insert(spark.range(2, 3).selectExpr("CAST(id AS INT) AS k", "NULL AS v", "2019 AS year"), t, ["k"]) == 1
    assert W.merge_upsert(spark.range(2, 3).selectExpr("CAST(id AS INT) AS k", "NULL AS v", "2019 AS year"), t, ["k"]) == 2
