import json
from urllib.parse import unquote, urlparse

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemart.sources import nested, parquet_drift, tables, text
from tidemart.sources.files import landed, only


def test_parallel_arrays_fill_absent_ones(spark, tmp_path):
    docs = [{"lat": 1.0, "hourly": {"time": ["t0", "t1"], "a": [1.0, None]}}, {"lat": 2.0, "hourly": {"time": [], "a": [], "b": []}},
            {"lat": 3.0}, {"lat": 4.0, "hourly": {"time": ["t2"], "a": [5.0], "b": [7]}}]
    (tmp_path / "d.json").write_text("\n".join(json.dumps(d) for d in docs))
    df = spark.read.schema("lat DOUBLE, hourly STRUCT<time: ARRAY<STRING>, a: ARRAY<DOUBLE>, b: ARRAY<BIGINT>>").json(str(tmp_path))
    got = nested.explode_parallel(df, "time", ["a", "b"], keep=["lat"], struct="hourly")
    assert rows(got) == [(1.0, "t0", 1.0, None), (1.0, "t1", None, None), (4.0, "t2", 5.0, 7)]


def test_indexed_json_in_one_file(spark, tmp_path):
    (tmp_path / "g.json").write_text(json.dumps([{"page": 1}, [
        {"country": {"id": "US", "value": "U"}, "date": "2024", "value": 1.5}, {"country": None, "date": "", "value": None},
        {"date": "2023"}]], indent=1))
    got = nested.read_indexed_json(spark, str(tmp_path), 1, nested.GDP_RECORD, nested.GDP_FIELDS)
    assert rows(got) == [(None, None, "2023", None), ("US", "U", "2024", 1.5)]


def test_station_without_nested_records(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"results": [{"id": 1}, {"id": 2, "country": {"code": "US"}}]}))
    got = nested.read_station_pages(spark, str(tmp_path))
    assert rows(got, "location_id", "country_id", "latitude") == [(1, None, None), (2, "US", None)]


def test_csv_quotes_and_not_available(spark, tmp_path):
    (tmp_path / "z.csv").write_text('LocationID,Zone\n1,"A, ""B"""\nx,N/A\n3,\n')
    got = text.read_csv_table(spark, str(tmp_path), {"LocationID": "location_id", "Zone": "zone"}, {"location_id": "int"})
    assert rows(got) == [(None, "N/A"), (1, 'A, "B"'), (3, None)]


def test_archive_reads_only_wanted_directories(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "a")
    df = spark.range(60).select("id", (F.col("id") % 3).alias("locationid"), F.lit(2024).alias("year"), (F.col("id") % 4 + 1).alias("month"))
    df.write.partitionBy("locationid", "year", "month").option("header", True).option("compression", "gzip").csv(base)
    ids = spark.createDataFrame([(1,)], "station INT")
    got = text.read_archive(spark, base, "id BIGINT", ids, [(2024, 2), (2023, 4)])
    assert rows(got, "id") == [(i,) for i in sorted((i for i in range(60) if i % 3 == 1 and i % 4 == 1), key=str)]
    want = sorted(f for f in (str(p) for p in (tmp_path / "a").rglob("*.csv.gz")) if "locationid=1/year=2024/month=2/" in f)
    assert sorted(unquote(urlparse(f).path) for f in got.inputFiles()) == want and want
    # stations too many to name are pruned by the join instead
    monkeypatch.setattr(text, "NAMED_STATIONS", 0)
    many = text.read_archive(spark, base, "id BIGINT", ids, [(2024, 2), (2023, 4)])
    assert rows(many, "id") == rows(got, "id") and len(many.inputFiles()) == 3 * len(want)
    assert text.read_archive(spark, base, "id BIGINT", ids, [(2023, 4)]).count() == 0


def test_archive_months_with_and_without_a_zero(spark, tmp_path):
    for month in ("02", "2", "12"):
        folder = tmp_path / "locationid=7" / "year=2024" / f"month={month}"
        folder.mkdir(parents=True)
        (folder / "x.csv").write_text(f"id\n{int(month)}\n")
    assert rows(text.read_archive(spark, str(tmp_path), "id BIGINT", None, [(2024, 2)]), "id", "month") == [(2, 2), (2, 2)]
    assert text.read_archive(spark, str(tmp_path), "id BIGINT").count() == 3


def scanned(df):
    """Files that the scans of a frame open, after it has run."""
    df.collect()

    def walk(node):
        name = node.nodeName()
        if "AdaptiveSparkPlan" in name:
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        m = node.metrics()
        own = m.apply("numFiles").value() if "Scan" in name and m.contains("numFiles") else 0
        return own + sum(walk(node.children().apply(k)) for k in range(node.children().size()))
    return walk(df._jdf.queryExecution().executedPlan())


def test_only_the_chosen_files_are_opened(spark, tmp_path):
    base = str(tmp_path / "a b [x]")
    for k in range(4):
        spark.range(k, k + 1).coalesce(1).write.mode("append").json(base)
    files = landed(spark, base.replace("[", "\\[").replace("]", "\\]"), glob="*.json")
    assert files.count() == 4 and files.select("length").distinct().count() == 1
    read = spark.read.schema("id BIGINT").json(base.replace("[", "\\[").replace("]", "\\]"))
    two = files.orderBy("path").limit(2)
    assert scanned(only(read, two)) == 2 and only(read, two).count() == 2
    assert rows(only(read, two, limit=1)) == rows(only(read, two))
    assert only(read, files.limit(0)).count() == 0


def test_a_folder_that_disagrees_within_itself_is_split_into_files(spark, tmp_path):
    base = str(tmp_path / "m")
    for k, kind in enumerate(("int", "bigint", "int", "double")):
        spark.range(3).select(F.col("id").cast(kind).alias("k"), F.lit(k).alias(f"c{k}")).coalesce(1).write.mode("append").parquet(base)
    groups = parquet_drift.generations(spark, parquet_drift.folder_units(parquet_drift.list_files(spark, base)))
    assert sorted(len(g.units) for g in groups) == [1, 1, 2]
    got = parquet_drift.read_drifting(spark, groups, {}, {"k": "double"})
    assert got.count() == 12 and set(got.columns) == {"k", "c0", "c1", "c2", "c3"}


def test_drift_without_files(spark):
    with pytest.raises(ValueError):
        parquet_drift.read_drifting(spark, [], {}, {})


def test_plain_multi_file_read_would_fail_on_this_drift(spark, tmp_path):
    a, b = str(tmp_path / "x" / "trips_2024-01.parquet"), str(tmp_path / "x" / "trips_2024-02.parquet")
    spark.range(3).select(F.col("id").cast("int").alias("k"), F.lit(1.0).alias("Airport_fee")).write.parquet(a)
    spark.range(3).select("id", F.col("id").alias("k")).write.parquet(b)
    files = parquet_drift.list_files(spark, str(tmp_path / "x"))
    groups = parquet_drift.generations(spark, parquet_drift.folder_units(files))
    assert len(groups) == 2 and parquet_drift.generations(spark, []) == []
    got = parquet_drift.read_drifting(spark, groups, {"Airport_fee": "airport_fee"}, {"k": "bigint"})
    assert got.count() == 6 and dict(got.dtypes)["k"] == "bigint"
    assert got.where("airport_fee IS NULL").count() == 3


def test_missing_table_is_empty(spark, db):
    got = tables.scan_or_empty(spark, f"{db}.none", spark.range(1).schema)
    assert got.columns == ["id"] and got.count() == 0


def test_stream_at_an_interval_and_replay(spark, db, tmp_path):
    from tidemart.streaming import twins
    t, base = f"{db}.t", str(tmp_path / "in")
    rows_in = spark.range(30).select("id", (F.col("id") % 3).alias("part"))
    rows_in.where("id < 20").write.parquet(base)
    s = twins.file_stream(spark, base, rows_in.schema)
    q = twins.start(s, str(tmp_path / "ck"), twins.insert_sink(t, ["id"], ["part"]), interval="1 second")
    q.processAllAvailable()
    assert spark.table(t).count() == 20
    rows_in.where("id >= 15").write.mode("append").parquet(base)
    q.processAllAvailable()
    q.stop()
    spark.catalog.refreshTable(t)
    assert spark.table(t).count() == 30
    sink = twins.upsert_sink(t, ["id"], ["id"], ["part"])
    sink(rows_in.where("id < 5"), 7)
    sink(rows_in.where("id < 0"), 8)
    spark.catalog.refreshTable(t)
    assert spark.table(t).count() == 30
    a = twins.append_sink(f"{db}.a")
    for epoch in (0, 1, 1):
        a(rows_in.where("id < 3"), epoch)
    a(rows_in.where("id < 0"), 2)
    assert spark.table(f"{db}.a").count() == 6
