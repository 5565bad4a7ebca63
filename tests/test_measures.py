import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemart.operators import timeseries as T
from tidemart.operators.measures import pearson, ratio_percent, year_over_year
from tidemart.plans import gold, marts
from tidemart.plans.model import ROLES, Model


def test_pearson_cases(spark):
    df = spark.createDataFrame([("up", 1.0, 2.0), ("up", 2.0, 4.0), ("up", 3.0, 6.5), ("flat", 1.0, 1.0), ("flat", 1.0, 3.0),
                                ("one", 1.0, 1.0), ("gap", 1.0, None), ("gap", 2.0, 3.0), ("gap", 3.0, 2.0), ("none", None, 1.0)],
                               "g STRING, x DOUBLE, y DOUBLE")
    got = {r["g"]: r["r"] for r in df.groupBy("g").agg(F.round(pearson("x", "y"), 6).alias("r")).collect()}
    assert got == {"up": 0.997949, "flat": None, "one": None, "gap": -1.0, "none": None}


def test_yoy_gap_zero_and_groups(spark):
    df = spark.createDataFrame([(2020, "a", 100), (2021, "a", 150), (2023, "a", 10), (2020, "b", 0), (2021, "b", 5)], "year INT, g STRING, v BIGINT")
    got = year_over_year(df, ["v"], by=["g"], labels=True)
    assert rows(got, "g", "year", "v_yoy", "v_yoy_label") == [
        ("a", 2020, None, None), ("a", 2021, 0.5, "▲ +50.0% vs 2020"), ("a", 2023, None, None), ("b", 2020, None, None), ("b", 2021, None, None)]


def test_ratio_is_null_on_zero(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, None), (5.0, 50.0)], "a DOUBLE, b DOUBLE")
    assert [r[0] for r in df.select(ratio_percent("a", "b")).collect()] == [None, None, 10.0]


@pytest.fixture(scope="module")
def model(spark):
    d = gold.dim_date(spark, 2023, 2024)
    zone = spark.createDataFrame([(1, 1, "A", "Queens", "Airports"), (2, 2, "B", "Bronx", "Boro Zone"), (3, 3, "C", "EWR", "EWR")],
                                 "zone_key INT, location_id INT, zone_name STRING, borough STRING, service_zone STRING")
    fx = spark.createDataFrame([(1, 20230102, dt.date(2023, 1, 2), 0.9), (2, 20240102, dt.date(2024, 1, 2), 0.8)],
                               "fx_key INT, date_key INT, date DATE, usd_eur_rate DOUBLE")
    gdp = spark.createDataFrame([(1, "US", "United States", 2023, 1000.0, 0.0), (2, "PL", "Poland", 2024, 5.0, 0.0)],
                                "gdp_key INT, country_code STRING, country_name STRING, year INT, gdp_usd DOUBLE, gdp_trillion_usd DOUBLE")
    trips = spark.createDataFrame(
        [(20230102, 1, 1, 10, 100.0, 90.0, 10.0), (20230103, 2, None, 20, 50.0, None, 2.5), (20240102, 1, 2, 30, 200.0, 160.0, 6.0), (20240104, None, None, 1, 1.0, None, 1.0)],
        "date_key INT, zone_key INT, fx_key INT, trip_count BIGINT, total_fare_usd DOUBLE, total_fare_eur DOUBLE, avg_fare_usd DOUBLE")
    air = spark.createDataFrame([(20230102, 7, "s", "pm25", 10.0), (20230102, 8, "t", "pm25", 20.0), (20230103, 7, "s", "no2", 30.0), (20240102, 7, "s", "pm25", 16.0)],
                                "date_key INT, location_id BIGINT, city STRING, parameter STRING, avg_value DOUBLE")
    air = air.withColumns({"latitude": F.lit(1.0), "longitude": F.lit(2.0)})
    return Model({"trips": trips, "air": air, "date": d, "zone": zone, "fx": fx, "gdp": gdp})


def test_totals_without_grouping(model):
    r = model.evaluate(["total_trips", "total_revenue_eur", "avg_fare_usd", "avg_pm25", "avg_o3", "avg_fx_rate", "usa_gdp_usd"]).first()
    assert tuple(r) == (61, 250.0, 4.875, (10 + 20 + 16) / 3, None, 0.85, 1000.0)


def test_grouping_by_dimensions_keeps_unmatched_facts(model):
    assert rows(model.evaluate(["total_trips"], [("zone", "borough")])) == [(None, 1), ("Bronx", 20), ("Queens", 40)]
    assert rows(model.evaluate(["total_trips", "avg_pm25"], [("date", "year")])) == [(2023, 30, 15.0), (2024, 31, 16.0)]


def test_roles_restrict_one_fact_only(model):
    seen = model.as_role("Airports Operator")
    assert seen.evaluate(["total_trips"]).first()[0] == 40
    assert seen.tables["air"].count() == 4
    assert model.as_role("Admin").evaluate(["total_trips"]).first()[0] == 61
    assert set(ROLES) == {"Admin", "Airports Operator", "EWR Operator", "Green Cab Dispatcher", "Yellow Cab Dispatcher"}
    assert model.as_role("EWR Operator").evaluate(["total_trips"]).first()[0] is None


def test_date_filter_reaches_both_facts(model):
    m = model.where("date", F.col("year") == 2023)
    assert tuple(m.evaluate(["total_trips", "avg_pm25"]).first()) == (30, 15.0)


def test_marts(model):
    kpi = {r["year"]: r for r in marts.mobility_by_year(model).collect()}
    assert kpi[2024]["total_trips_yoy_label"] == "▲ +3.3% vs 2023" and kpi[2023]["total_trips_yoy"] is None
    march = marts.mobility_by_year(model, ["total_trips"], slicer=F.col("day_of_month") == 2)
    assert {r["year"]: r["total_trips_yoy"] for r in march.collect()} == {2023: None, 2024: 2.0}
    whole = marts.mobility_by_year(model, ["total_trips"], slicer=F.col("day_of_month") == 2, all_dates_before=True)
    assert {r["year"]: r["total_trips_yoy"] for r in whole.collect()} == {2023: None, 2024: 0.0}
    share = {r["year"]: r["revenue_pct_gdp"] for r in marts.revenue_share_of_gdp(model).collect()}
    assert share == {2023: 15.0, 2024: None}
    cards = {r["parameter"]: r["band"] for r in marts.pollutant_cards(model).collect()}
    assert cards == {"pm25": "red", "no2": "red"}
    assert [r["zone_name"] for r in marts.top_zones(model, 1).collect()] == ["A"]
    assert rows(marts.correlations(model, ["avg_pm25"]).withColumn("r", F.round("r", 9))) == [("avg_pm25", 1.0)]
    assert rows(marts.monthly_combo(model, ["avg_pm25"])) == [(2023, 1, 30, 15.0), (2024, 1, 31, 16.0)]
    assert marts.selected_gdp(model.tables["gdp"], "US", date_year=2024).first()[0] is None


def test_windows(spark):
    t = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    df = spark.createDataFrame([(t(0, 10), 1.0, None), (t(0, 50), 3.0, None), (t(2), None, 4.0), (t(3, 5), 5.0, 6.0)], "at TIMESTAMP, a DOUBLE, b DOUBLE")
    got = rows(T.window_rollup(df, "at", "1 hour", ["a", "b"], "mean", t(0), t(3, 20)))
    # empty windows are left out, the last one is cut at the range end
    assert got == sorted([(t(1), "a", 2.0), (t(3), "b", 4.0), (t(3, 20), "a", 5.0), (t(3, 20), "b", 6.0)], key=str)
    assert rows(T.last_days(df, "at", t(3, 5), 1), "at") == [(t(0, 10),), (t(0, 50),), (t(2),)]


def test_points_and_lines(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 1, 900000), 1.5, 3, True), (dt.datetime(2024, 1, 1), None, None, None)],
                               "at TIMESTAMP_NTZ, temp DOUBLE, code INT, rain BOOLEAN")
    p = T.to_points(df, "weather", {"location": "city"}, ["temp", "code", "rain"], "at")
    assert rows(p, "field", "value", F.unix_seconds("time")) == [("code", 3.0, 1704067201), ("rain", 1.0, 1704067201), ("temp", 1.5, 1704067201)]
    lines = [r[0] for r in T.to_lines(df, "weather", {"location": "city"}, ["temp", "code", "rain"], "at").collect()]
    assert lines == ["weather,location=city temp=1.5,code=3i,rain=true 1704067201"]


def test_latest_per_series_breaks_ties(spark):
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("s", at, 1), ("s", at, 2), ("t", at, 0)], "s STRING, at TIMESTAMP, v INT")
    assert rows(T.latest_per_series(df, ["s"], "at", ["v"]), "s", "v") == [("s", 2), ("t", 0)]


def test_pearson_keeps_its_digits_far_from_zero(spark):
    line = spark.range(10).selectExpr("id + 1e9 AS x", "2 * id + 1e9 AS y", "0.1 AS flat")
    r = line.agg(pearson("x", "y").alias("r"), pearson("x", "flat").alias("none")).first()
    assert abs(r["r"] - 1) < 1e-9 and r["none"] is None


def test_null_groups_meet(spark):
    a = spark.createDataFrame([(None, 1), (2020, 2)], "year INT, a INT")
    b = spark.createDataFrame([(None, 5)], "year INT, b INT")
    from tidemart.operators.measures import join_on
    assert sorted(map(tuple, join_on([a, b], ["year"]).collect()), key=str) == sorted([(None, 1, 5), (2020, 2, None)], key=str)
