"""Sums without error against the standard library's, which rounds the exact total once."""
import math
import random
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemart.functions.exact import exact_avg, exact_sum, rounded_avg
from tidemart.operators.sums import error_free_sums


def total(spark, groups, partitions=3):
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE").repartition(partitions)
    return {r["g"]: (r["s"], r["s_count"]) for r in error_free_sums(df, ["g"], {"s": "v"}).collect()}


def any_double(rnd):
    while True:
        v = struct.unpack("<d", rnd.randbytes(8))[0]
        if math.isfinite(v) and abs(v) < 1e300:
            return v


def test_doubles_of_every_size(spark):
    rnd = random.Random(5)
    groups = {"any": [any_double(rnd) for _ in range(300)], "near": [rnd.uniform(-1, 1) * 10 ** rnd.randint(-20, 20) for _ in range(300)],
              "money": [rnd.randint(-10 ** 7, 10 ** 7) / 100 for _ in range(300)], "ones": [2.0 ** k for k in range(-60, 60)],
              "edges": [2.0 ** (23 * k) * s for k in range(-40, 40) for s in (1, -1, 1 + 2 ** -52, 1 - 2 ** -53)],
              "cancel": [1e300, 1e-300, -1e300, 1.0, -1.0], "half": [1.0, 2.0 ** -53], "more": [1.0, 2.0 ** -53, 2.0 ** -1070], "less": [1.0, 2.0 ** -53, -2.0 ** -1070],
              "minus": [-0.1] * 10, "zero": [0.0, -0.0, 5.5, -5.5], "one": [1.7976931348623157e308]}
    got = total(spark, groups)
    for g, vs in groups.items():
        assert got[g] == (math.fsum(vs), len(vs)), g


@settings(max_examples=6, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e290, max_value=1e290, allow_subnormal=False), min_size=1, max_size=40))
def test_any_values_in_any_order(spark, values):
    a, b = total(spark, {"g": values}, 1), total(spark, {"g": values[::-1]}, 4)
    assert a == b
    want = math.fsum(values)
    assert a["g"][0] == want or abs(want) < 1e-300


def test_no_values_nan_and_infinities(spark):
    inf, nan = math.inf, math.nan
    got = total(spark, {"null": [None, None], "some": [None, 2.5], "up": [inf, 1e308, 1e308], "down": [-inf, 5.0], "both": [inf, -inf], "nan": [nan, inf, 1.0],
                        "over": [1.7e308, 1.7e308], "back": [1.7e308, 1.7e308, -1.7e308]})
    assert got["null"] == (None, 0) and got["some"] == (2.5, 1) and got["up"] == (inf, 3) and got["down"] == (-inf, 2)
    assert math.isnan(got["both"][0]) and math.isnan(got["nan"][0]) and got["over"][0] == inf and got["back"][0] == 1.7e308


def test_several_sums_nulls_in_groups_and_empty_frames(spark):
    df = spark.createDataFrame([(None, 1.5, 2.0), (None, 2.5, None), ("a", None, 1.0)], "g STRING, x DOUBLE, y DOUBLE")
    got = {r["g"]: (r["x"], r["x_count"], r["z"]) for r in error_free_sums(df, ["g"], {"x": "x", "z": "x * y"}).collect()}
    assert got == {None: (4.0, 2, 3.0), "a": (None, 0, None)}
    assert error_free_sums(df.limit(0), ["g"], {"x": "x"}).count() == 0


@pytest.mark.parametrize(("values", "want"), [([math.nan, 1.0], math.nan), ([math.inf, 1.0], math.inf), ([1e19, 1e19], 2e19), ([-math.inf, math.inf], math.nan)])
def test_plain_sums_of_odd_values_do_not_fail(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    s, m, r = df.agg(exact_sum("v"), exact_avg("v"), rounded_avg("v", 4)).first()
    same = lambda a, b: math.isnan(a) if math.isnan(b) else a == b
    assert same(s, want) and same(m, want / 2) and same(r, want / 2)


def test_means_of_tiny_values_are_kept(spark):
    df = spark.createDataFrame([(3e-10,), (3e-10,), (None,)], "v DOUBLE")
    assert df.agg(exact_avg("v")).first()[0] == 3e-10
    assert df.agg(exact_avg("v", "v > 1")).first()[0] is None
    assert spark.createDataFrame([(0.0,)], "v DOUBLE").agg(exact_avg("v"), rounded_avg("v", 2)).first()[:] == (0.0, 0.0)


def test_an_infinite_reading_does_not_end_the_fact(spark):
    import datetime as dt

    from tidemart.plans import gold, silver
    at = dt.datetime(2024, 1, 2)
    raw = spark.createDataFrame([(1, "pm25", at, math.inf, "ugm3"), (1, "pm25", at.replace(hour=1), 5.0, "ugm3"), (2, "pm25", at, 7.00005, "ugm3")],
                                "location_id BIGINT, parameter STRING, datetime TIMESTAMP, value DOUBLE, units STRING")
    about = spark.createDataFrame([(1, "a", "X", 1.0, 2.0)], "location_id BIGINT, location_name STRING, country_name STRING, latitude DOUBLE, longitude DOUBLE")
    got = {r["location_id"]: (r["avg_value"], r["measurement_count"]) for r in gold.air_fact(silver.measurements(raw), about).collect()}
    assert got == {1: (math.inf, 2), 2: (7.0001, 1)}
