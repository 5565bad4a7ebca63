"""Plan properties that matter at scale."""
from pyspark.sql import functions as F

from tidemart.operators import joins
from tidemart.operators import write as W
from tidemart.plans import silver
from workload import q_incremental, q_refresh
from workload import standins as S

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_trip_filters_and_columns_reach_the_scan(spark):
    text = S.trips(spark, SF)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in text.splitlines() if "FileScan" in line and "l_quantity" in line)
    assert "l_returnflag" not in scan and "l_tax" not in scan
    pushed = spark._jvm.PythonSQLUtils.explainString(S.trips(spark, SF)._jdf.queryExecution(), "formatted")
    assert "LessThanOrEqual(l_quantity,40.0)" in pushed and "GreaterThan(l_extendedprice,0.0)" in pushed


def test_fact_is_reduced_before_its_lookups(spark):
    text = plan(S.trip_fact(spark, SF))
    # the joins stand above the aggregate of the trips (earlier in the printed tree)
    assert text.index("LeftOuter") < text.index("partial_count(1)")


def test_merge_reads_only_touched_partitions(spark, db):
    t = f"{db}.t"
    W.append(spark.range(100).select("id", (F.col("id") % 10).cast("int").alias("part")), t, ["part"])
    src = spark.createDataFrame([(3, 3), (103, 3), (14, 4)], "id BIGINT, part INT")
    met = W.once(src, ["part"]).parts
    assert len({f.split("part=")[1][0] for f in W._touched(spark.table(t), ["part"], met).inputFiles()}) == 2
    assert W._touched(spark.table(t), ["part"], W.once(src.where("id < 0"), ["part"]).parts).count() == 0


def test_hot_join_key_is_split(spark):
    """A third of the rows on one key: the sort-merge join splits that partition."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        i = F.col("id")
        facts = spark.range(300000, numPartitions=8).select(F.when(i % 3 == 0, F.lit(7)).otherwise(i % 5000).alias("k"), F.xxhash64("id").alias("v"))
        dim = spark.range(5000).select(i.alias("d"), F.concat(F.lit("n"), i.cast("string")).alias("name"))
        got = joins.lookup(facts, dim, "k", "d", ["name"])
        seen = got.groupBy("name").agg(F.count("*").alias("n"), F.max("v"))
        assert {r["name"]: r["n"] for r in seen.collect()}["n7"] > 100000
        assert "skew=true" in seen._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_orphan_join_sees_one_row_per_key(spark):
    """Spark moves the anti join below the count only where it broadcasts the parent; a shuffled join,
    where a hot key would hurt, stays above the map-side count."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        child = spark.range(1000).select((F.col("id") % 3).alias("fk"))
        text = plan(joins.orphans(child, "fk", spark.range(1), "id"))
        assert text.index("LeftAnti") < text.index("partial_count(1)")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_builders_do_not_leave_codegen_for_python(spark):
    for df in (S.trip_fact(spark, SF), S.air_fact(spark, SF), silver.weather(S.raw_weather(spark, SF))):
        assert "Python" not in plan(df) and "ArrowEval" not in plan(df)


def test_latest_rows_and_station_map_need_no_sort_aggregate(spark):
    from tidemart.operators import timeseries as T
    from tidemart.plans import marts
    latest = T.latest_per_series(S.table(spark, SF, "events"), ["user_id", "event_type"], "ts", ["event_id", "value", "props"])
    points = T.to_points(S.raw_weather(spark, SF), "w", {"l": "x"}, ["temperature_2m"], "datetime", unique=True)
    for df in (latest, points, marts.station_map(S.model(spark, SF), "click")):
        assert "SortAggregate" not in plan(df)


def test_an_increment_opens_only_its_own_run(spark, db):
    """Raw rows are found by the partition of their run: the files opened stay the same however many runs there are."""
    t, opened = f"{db}.raw", []
    for run in range(1, 6):
        W.append(spark.range(100).select("id", F.lit(2024).alias("year"), F.lit(run).cast("bigint").alias("ingest_run")).coalesce(1), t, ["year", "ingest_run"])
        opened.append(len(spark.table(t).where(F.col("ingest_run") > run - 1).inputFiles()))
    assert len(set(opened)) == 1 and len(spark.table(t).inputFiles()) == 5 * opened[0]


def test_rebuild_of_a_day_evaluates_the_trips_once(spark, monkeypatch):
    """Of all that it writes only one frame comes from the line items; the rest comes from files of the clean trips."""
    counted, from_lines = W._counted, []

    def spy(df, *args, **kwargs):
        from_lines.append(any("lineitem" in f for f in df.inputFiles()))
        return counted(df, *args, **kwargs)
    monkeypatch.setattr(W, "_counted", spy)
    q_refresh.rebuild_one_day(spark, SF)
    assert sum(from_lines) == 1 and len(from_lines) > 3


def test_reaggregated_frames_read_clean_trips_from_files(spark, monkeypatch):
    """The result reads no line items again, and no fact is evaluated for its newest day."""
    most, asked = q_incremental.I.max_of, []
    monkeypatch.setattr(q_incremental.I, "max_of", lambda df, col: asked.append(df.columns) or most(df, col))
    got = q_incremental.reaggregate_frames(spark, SF)
    assert got.inputFiles() and not any("lineitem" in f or "orders" in f for f in got.inputFiles())
    assert asked == [["k"]]
