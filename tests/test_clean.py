import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from tidemart.functions import casts, dates, labels, units
from tidemart.operators import clean
from tidemart.plans import silver

NAN = float("nan")


def test_soft_casts_give_null_for_bad_text(spark):
    df = spark.createDataFrame([("7", "2024-02-30", "1.5"), ("x", "2024-02-29", "")], "a STRING, d STRING, v STRING")
    got = casts.cast_map(df, {"a": "int", "d": "date", "v": "double", "absent": "int"})
    assert got.dtypes == [("a", "int"), ("d", "date"), ("v", "double")]
    assert rows(got) == [(None, dt.date(2024, 2, 29), None), (7, None, 1.5)]


def test_sane_range_is_half_open_and_rejects_null_and_nan(spark):
    df = spark.createDataFrame([(0.0,), (0.01,), (100.0,), (100.1,), (None,), (NAN,), (-1.0,)], "x DOUBLE")
    assert rows(df.where(clean.sane_range("x", 100))) == [(0.01,), (100.0,)]
    assert len(rows(df.where(clean.strictly_positive("x")))) == 3


def test_dedup_keeps_the_same_row_in_any_input_order(spark):
    data = [(1, "b", 2.0), (1, "a", 9.0), (1, None, 1.0), (2, "z", 0.0)]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k INT, s STRING, v DOUBLE").repartition(3)
        assert rows(clean.first_per_key(df, ["k"])) == [(1, None, 1.0), (2, "z", 0.0)]
        newest = clean.first_per_key(df, ["k"], ["v DESC"])
        assert rows(newest) == [(1, "a", 9.0), (2, "z", 0.0)]


def test_dedup_limits_each_map_task_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = clean.first_per_key(df, ["k"])._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_filter_runs_before_dedup(spark):
    """The bad twin of a key must not hide the good one."""
    t = dt.datetime(2024, 1, 1, 10)
    raw = spark.createDataFrame(
        [(t, t, 1, 2, 5.0, 0.0), (t, t, 1, 2, 5.0, 3.0)],
        "tpep_pickup_datetime TIMESTAMP_NTZ, tpep_dropoff_datetime TIMESTAMP_NTZ, PULocationID INT, DOLocationID INT, "
        "fare_amount DOUBLE, trip_distance DOUBLE")
    assert rows(silver.trips(raw), "trip_distance", "year", "month") == [(3.0, 2024, 1)]


def test_trip_limits(spark):
    t = dt.datetime(2024, 1, 1)
    schema = ("tpep_pickup_datetime TIMESTAMP_NTZ, tpep_dropoff_datetime TIMESTAMP_NTZ, PULocationID BIGINT, DOLocationID BIGINT, "
              "trip_distance DOUBLE, fare_amount DOUBLE, Airport_fee DOUBLE")
    data = [(t, t, i, 1, d, f, 1.0) for i, (d, f) in enumerate(
        [(0.0, 5.0), (100.0, 5.0), (100.1, 5.0), (1.0, 0.0), (1.0, 10000.0), (1.0, 187000.0), (1.0, None)])]
    data += [(t, t, None, 1, 1.0, 5.0, 1.0), (t, t - dt.timedelta(hours=1), 99, 1, 1.0, 5.0, 1.0)]
    got = silver.trips(spark.createDataFrame(data, schema))
    assert "airport_fee" in got.columns and "Airport_fee" not in got.columns
    # a trip that ends before it starts stays: durations are not filtered
    assert rows(got, "pu_location_id") == [(1,), (4,), (99,)]


def test_unit_conversion_and_relabel(spark):
    df = spark.createDataFrame([("no2", "ppm", 0.5), ("no2", "µg/m³", 0.5), ("pm25", "ppm", 2.0)], "parameter STRING, units STRING, value DOUBLE")
    got = df.select("parameter", units.convert_value().alias("v"), units.relabel_units().alias("u"))
    # a ppm row without a factor keeps its value but is relabelled
    assert rows(got) == [("no2", 0.5, "µg/m³"), ("no2", 941.0, "µg/m³"), ("pm25", 2.0, "µg/m³")]


def test_measurement_offsets_become_instants(spark):
    raw = spark.createDataFrame(
        [(1, "2024-01-01T05:00:00-05:00", "pm25", "µg/m³", 3.0), (1, "2024-01-01T10:00:00+00:00", "pm25", "µg/m³", 4.0),
         (1, "nonsense", "pm25", "µg/m³", 4.0), (1, "2024-01-01T10:00:00Z", "humidity", "%", 4.0), (1, "2024-01-01T11:00:00Z", "pm25", "µg/m³", 0.0)],
        "location_id BIGINT, datetime STRING, parameter STRING, units STRING, value DOUBLE")
    assert rows(silver.measurements(raw), "datetime", "value") == [(dt.datetime(2024, 1, 1, 10), 3.0)]


def test_weather_keeps_newest_and_null_rain(spark):
    raw = spark.createDataFrame(
        [("2024-01-01T00:00", 1.0, None, dt.datetime(2024, 1, 2)), ("2024-01-01T00:00", 2.0, 0.3, dt.datetime(2024, 1, 3)),
         ("2024-01-01T01:00", 3.0, None, dt.datetime(2024, 1, 2)), ("2024-01-01T02:00", None, 0.0, dt.datetime(2024, 1, 2))],
        "datetime STRING, temperature_2m DOUBLE, precipitation DOUBLE, ingestion_timestamp TIMESTAMP")
    raw = raw.withColumns({"latitude": F.lit(40.7), "longitude": F.lit(-74.0), "apparent_temperature": F.lit(0.0),
                           "wind_speed_10m": F.lit(0.0), "relative_humidity_2m": F.lit(1.0), "weather_code": F.lit(1)})
    assert rows(silver.weather(raw), "temperature_c", "is_rainy") == [(2.0, True), (3.0, None)]


def test_activity_overlap_open_bounds_and_missing_columns(spark):
    df = spark.createDataFrame([(1, None, None), (2, "2024-06-01T00:00:00Z", None), (3, None, "2019-01-01T00:00:00Z"),
                                (4, "2018-01-01T00:00:00Z", "2021-01-01T00:00:00Z")], "id INT, datetime_first STRING, datetime_last STRING")
    lo, hi = clean.year_bounds(2020, 2023)
    assert rows(clean.active_between(df, lo, hi), "id") == [(1,), (4,)]
    assert clean.active_between(df.select("id"), lo, hi).count() == 4


def test_blank_rows(spark):
    df = spark.createDataFrame([("", None), ("a", None), (None, 1), (None, None)], "s STRING, n INT")
    assert rows(clean.drop_blank_rows(df)) == [(None, 1), ("a", None)]


def test_slice_predicate_drops_null_keys(spark):
    df = spark.createDataFrame([(1,), (5,), (9,), (None,)], "k INT")
    assert rows(df.where(clean.keep_outside("k", 3, 7))) == [(1,), (9,)]
    assert rows(df.where(clean.keep_outside("k", 3))) == [(1,)]


def test_calendar_columns(spark):
    from tidemart.plans.gold import dim_date
    d = {r["date"]: r for r in dim_date(spark, 2021, 2026).collect()}
    assert len(d) == 2191
    first = d[dt.date(2021, 1, 1)]
    assert (first["week_of_year"], first["day_of_week"], first["day_name"], first["is_weekend"]) == (53, 5, "Friday", False)
    assert d[dt.date(2021, 1, 3)]["day_of_week"] == 7 and d[dt.date(2021, 1, 3)]["is_weekend"]
    # a stored wider range is kept
    assert dim_date(spark, 2021, 2021, (2020, 2023)).count() == 366 + 365 * 3
    assert dim_date(spark, 2021, 2021, (None, None)).count() == 365


def test_key_helpers():
    assert dates.lookback_key(20240303, 7) == 20240225
    assert dates.recent_months(dt.date(2024, 1, 15)) == [(2023, 12), (2024, 1)]
    assert dates.recent_months(dt.date(2024, 3, 31)) == [(2024, 2), (2024, 3)]


def test_currency_rounds_exact_halves_up_and_keeps_null(spark):
    df = spark.createDataFrame([(100.50, 0.85), (1.0, None), (2.0, 0.0)], "a DOUBLE, r DOUBLE")
    assert rows(df.select(units.convert_currency("a", "r"))) == [(None,), (0.0,), (85.43,)]
    assert rows(df.select(units.convert_currency("a", "r", "usd_per_eur"))) == [(None,), (None,), (118.24,)]


def test_labels_and_bands(spark):
    df = spark.createDataFrame([(0.1234, 2024), (-0.5, 2024), (0.0, 2024), (None, 2024)], "c DOUBLE, y INT")
    got = [r[0] for r in df.select(labels.yoy_label("c", "y")).collect()]
    assert got == ["▲ +12.3% vs 2023", "▼ -50.0% vs 2023", "▲ +0.0% vs 2023", None]
    df = spark.createDataFrame([(10.0,), (12.5,), (15.0,), (15.1,), (None,)], "v DOUBLE")
    assert [r[0] for r in df.select(labels.band("v", 15)).collect()] == ["green", "yellow", "yellow", "red", None]
