import datetime as dt
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

import landing as L
from tidemart.operators.quality import report
from tidemart.plans import contracts as C
from tidemart.plans import suites
from tidemart.plans.refresh import Config, refresh, verify
from tidemart.session import work_database
from tidemart.sources import parquet_drift

D = dt.date


def first_drop(base):
    L.write_reference(base)
    L.write_trips(base, "trips_2024-01.parquet", [
        L.trip(D(2024, 1, 2)), L.trip(D(2024, 1, 2)), L.trip(D(2024, 1, 2), fare=20.005), L.trip(D(2024, 1, 2), dist=0.0), L.trip(D(2024, 1, 3), pu=2, minutes=-5),
        L.trip(D(2024, 2, 1), pu=264, count=2)])
    L.write_trips(base, "trips_2019-12.parquet", [L.trip(D(2019, 12, 1))])
    (base / "trips" / "readme.txt").write_text("not a table")
    L.write_readings(base, 7, D(2024, 1, 2), [(5, 1, "pm25", "µg/m³", 10.0), (6, 1, "no2", "ppm", 0.02), (6, 2, "no2", "ppm", 0.02), (7, 1, "temperature", "c", 4), (8, 1, "pm25", "µg/m³", -1)])
    L.write_readings(base, 9, D(2024, 1, 2), [(5, 1, "pm25", "µg/m³", 99.0)])
    L.write_weather(base, "w1.json", D(2024, 1, 2), [1.0, None, 3.0])


def second_drop(base):
    # a late row of January arrives with the February file; new file generation
    L.write_trips(base, "trips_2024-02.parquet", [L.trip(D(2024, 1, 31), pu=2), L.trip(D(2024, 2, 1), pu=1), L.trip(D(2024, 2, 3), pu=1, fare=10000.0),
                                                  L.trip(D(2024, 2, 3), pu=1, fare=187000.0)], new=True)
    L.write_readings(base, 7, D(2024, 2, 3), [(5, 1, "pm25", "µg/m³", 20.0), (6, 1, "o3", "ppm", 0.05)])
    L.write_weather(base, "w2.json", D(2024, 2, 3), [5.0, 6.0], [0.0, 0.4])


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    """Two incremental runs in one database; a full run over the same drops in another."""
    base = tmp_path_factory.mktemp("landing")
    first_drop(base)
    inc = Config(work_database(spark, "inc"), str(base), 2024, 2024, today=D(2024, 2, 4))
    one = refresh(spark, inc)
    second_drop(base)
    two = refresh(spark, inc)
    three = refresh(spark, inc)
    full = Config(work_database(spark, "full"), str(base), 2024, 2024, force_refresh=True, today=D(2024, 2, 4))
    refresh(spark, full)
    return inc, full, (one, two, three)


ALL = [C.TRIPS, C.MEASUREMENTS, C.WEATHER, C.LOCATIONS, C.GDP, C.FX, C.ZONES, C.DIM_DATE, C.DIM_ZONE, C.DIM_FX, C.DIM_GDP, C.TRIP_FACT, C.AIR_FACT]


@pytest.mark.parametrize("contract", ALL, ids=lambda c: c.name)
def test_increments_end_as_one_full_run(spark, runs, contract):
    inc, full, _ = runs
    a, b = spark.table(inc.table(contract.name)), spark.table(full.table(contract.name))
    cols = sorted(set(a.columns) & set(b.columns))
    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a, *cols) == rows(b, *cols) and a.count() > 0


@pytest.mark.parametrize("contract", ALL, ids=lambda c: c.name)
def test_stored_types_follow_the_contract(spark, runs, contract):
    have = {f.name: f.dataType for f in spark.table(runs[0].table(contract.name)).schema}
    for f in contract.schema:
        if f.name in have:
            assert have[f.name] == f.dataType, f.name
    missing = {f.name for f in contract.schema} - set(have)
    assert contract is C.TRIPS or not missing, missing


def test_a_run_without_news_adds_nothing(runs):
    _, _, (one, two, three) = runs
    assert one[C.TRIPS.name] == 4 and two[C.TRIPS.name] == 3 and three[C.TRIPS.name] == 0
    assert three.get(C.MEASUREMENTS.name) == 0
    assert "raw_zones" in one and "raw_zones" not in two and "raw_locations" not in two


def test_trip_fact_values(spark, runs):
    fact = spark.table(runs[0].table(C.TRIP_FACT.name)).drop("year")
    got = {(r["date_key"], r["zone_key"]): r for r in fact.collect()}
    day = got[(20240102, 1)]
    # the exact repetition is gone, the zero-distance trip too
    assert (day["trip_count"], day["total_fare_usd"], day["avg_trip_duration_min"], day["total_passengers"]) == (2, 30.01, 10.0, 2)
    assert day["total_fare_eur"] == 27.01 and day["fx_key"] == 1
    assert got[(20240103, 2)]["fx_key"] is None and got[(20240103, 2)]["avg_trip_duration_min"] == -5.0
    assert got[(20240131, 2)]["trip_count"] == 1
    assert (20240203, 1) in got and got[(20240203, 1)]["total_fare_usd"] == 10000.0


def test_air_fact_values(spark, runs):
    fact = spark.table(runs[0].table(C.AIR_FACT.name))
    got = rows(fact, "date_key", "parameter", "city", "avg_value", "measurement_count")
    # two sensors of one instant count once; the station outside the box and the closed one are absent
    assert got == [(20240102, "no2", "In town", 37.64, 1), (20240102, "pm25", "In town", 10.0, 1),
                   (20240203, "o3", "In town", 98.1, 1), (20240203, "pm25", "In town", 20.0, 1)]


def test_weather_rows(spark, runs):
    got = rows(spark.table(runs[0].table(C.WEATHER.name)), F.unix_seconds("datetime"), "temperature_c", "is_rainy")
    assert [r[1:] for r in got] == [(1.0, None), (3.0, None), (5.0, False), (6.0, True)]


def test_quality_report_over_the_tables(spark, runs):
    res = suites.run_all(spark, runs[0].database, scale=1e-9)
    bad = rows(res.where("NOT passed"))
    assert res.count() == 57 and bad == []
    assert report(res).startswith("57 of 57 checks hold in 12 tables, 0 fail")
    strict = suites.run_all(spark, runs[0].database)
    assert {r["name"] for r in strict.where("NOT passed").collect()} == {
        "row count >= 100,000,000", "row count >= 100,000", "row count >= 1,000"}


def test_missing_table_is_a_failed_suite(spark):
    res = suites.run_all(spark, work_database(spark, "nothing"))
    assert res.count() == 12 and res.where("passed").count() == 0


def test_verification_counts(spark, runs):
    v = verify(spark, runs[0])
    assert v["trip_nulls"].first()["no_rate"] == 3
    assert rows(v["air_parameters"]) == [("no2", 1), ("o3", 1), ("pm25", 2)]


def test_a_future_reading_hides_no_later_ones(spark, tmp_path):
    first_drop(tmp_path)
    # the archive of January holds one reading of December and one of another year
    folder = tmp_path / "measurements" / "locationid=7" / "year=2024" / "month=01"
    for day in (D(2024, 12, 30), D(2031, 5, 1)):
        L.write_readings(tmp_path, 7, day, [(1, 1, "pm25", "µg/m³", 5.0)])
        name = f"location-7-{day:%Y%m%d}.csv.gz"
        (tmp_path / "measurements" / "locationid=7" / f"year={day.year}" / f"month={day.month:02d}" / name).rename(folder / name)
    inc = Config(work_database(spark, "stray"), str(tmp_path), 2024, 2024, today=D(2024, 2, 4))
    refresh(spark, inc)
    second_drop(tmp_path)
    assert refresh(spark, inc)[C.MEASUREMENTS.name] == 2 and refresh(spark, inc)[C.MEASUREMENTS.name] == 0
    full = replace(inc, database=work_database(spark, "strayfull"), force_refresh=True)
    refresh(spark, full)
    for c in (C.MEASUREMENTS, C.AIR_FACT):
        a, b = spark.table(inc.table(c.name)), spark.table(full.table(c.name))
        assert rows(a, *sorted(a.columns)) == rows(b, *sorted(a.columns)) and a.count() == 5


def test_no_trip_files_is_an_error(spark, runs, tmp_path):
    first_drop(tmp_path)
    cfg = replace(runs[0], database=work_database(spark, "none"), landing=str(tmp_path), year_start=2030, year_end=2031)
    from tidemart.plans.refresh import _load_trips
    with pytest.raises(ValueError):
        _load_trips(spark, cfg)


def test_generations_follow_the_schema(spark, tmp_path):
    first_drop(tmp_path)
    second_drop(tmp_path)
    files = parquet_drift.files_for_years(parquet_drift.list_files(spark, str(tmp_path / "trips")), 2019, 2024)
    for units in (parquet_drift.period_units(files), parquet_drift.file_units(files), parquet_drift.folder_units(files)):
        groups = parquet_drift.generations(spark, units)
        assert len(groups) == 2
        assert parquet_drift.read_drifting(spark, groups, {"Airport_fee": "airport_fee"}, {}).count() == 11
    only = parquet_drift.read_drifting(spark, groups, {}, {}, files.where("month = 12"))
    assert only.count() == 1
    assert parquet_drift.files_for_years(files, 2024, 2024).count() == 2


def test_command_line(spark, runs, tmp_path):
    from tidemart.__main__ import parser, run
    first_drop(tmp_path)
    db = work_database(spark, "cli")
    args = parser().parse_args(["refresh", "--landing", str(tmp_path), "--years", "2024", "--database", db, "--force-refresh"])
    assert "silver_trips: 4 rows" in run(args, spark)
    assert ", 0 fail (" in run(parser().parse_args(["report", "--database", db, "--scale", "1e-9"]), spark)
    export = parser().parse_args(["export", "--database", db])
    # two hours with five fields each: rain and its flag are null
    assert run(export, spark) == "10 points" and run(export, spark) == "0 points"
    L.write_weather(tmp_path, "w2.json", D(2024, 1, 3), [5.0], [0.4])
    run(args, spark)
    assert run(export, spark) == "7 points"


#: Two readings of one sensor and instant: the first by its landed unit (ppm) is the last by the converted one.
TIED = [(6, 1, "no2", "ugm3", 0.5), (6, 1, "no2", "ppm", 0.02)]


@pytest.mark.parametrize("forced", [True, False], ids=["full", "increment"])
def test_tied_readings_are_ranked_as_they_landed(spark, tmp_path, forced):
    first_drop(tmp_path)
    cfg = Config(work_database(spark, "tied"), str(tmp_path), 2024, 2024, force_refresh=forced, today=D(2024, 2, 4))
    if not forced:
        refresh(spark, cfg)
    L.write_readings(tmp_path, 7, D(2024, 1, 5), TIED)
    refresh(spark, cfg)
    got = spark.table(cfg.table(C.MEASUREMENTS.name)).where("to_date(datetime) = DATE'2024-01-05'")
    assert rows(got, "units", F.round("value", 4).alias("value")) == [("µg/m³", 37.64)]
