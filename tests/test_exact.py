from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemart.functions.exact import decimal_sum, exact_avg, exact_sum, half_up_mean, half_up_ratio
from tidemart.operators.keys import surrogate_key, surrogate_key_ranged


def test_half_up_ratio_against_decimals(spark):
    cases = [(0, 1), (1, 3), (100125, 100), (-100125, 100), (5, 0), (7, 8), (-1, 30000), (10 ** 17, 3), (9 * 10 ** 17, 10 ** 15 + 7),
             (123456789012345678, 1000), (1, 2 * 10 ** 17)]
    df = spark.createDataFrame(cases, "n BIGINT, d BIGINT")
    got = [r[0] for r in df.select(half_up_ratio("n", "d", 4)).collect()]
    for (n, d), v in zip(cases, got):
        want = None if d == 0 else float((Decimal(n) / Decimal(d)).quantize(Decimal("0.0001"), ROUND_HALF_UP))
        assert v == want, (n, d, v, want)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-10 ** 6, 10 ** 6), min_size=1, max_size=50))
def test_sums_do_not_depend_on_order(spark, cents):
    values = [(c / 100,) for c in cents]
    a = spark.createDataFrame(values, "v DOUBLE").agg(exact_sum("v"), exact_avg("v")).first()
    b = spark.createDataFrame(values[::-1], "v DOUBLE").repartition(4).agg(exact_sum("v"), exact_avg("v")).first()
    assert tuple(a) == tuple(b)
    assert a[0] == sum(cents) / 100


def test_small_parts_are_not_rounded_away(spark):
    df = spark.createDataFrame([(0.004,), (0.004,), (0.004,), (None,)], "v DOUBLE")
    assert tuple(df.agg(exact_sum("v"), exact_avg("v")).first()) == (0.01, 0.004)
    tiny = spark.createDataFrame([(0.00004,), (-0.00002,)], "v DOUBLE")
    assert tuple(tiny.agg(exact_sum("v", 5), exact_avg("v"), exact_avg("v", "v < 0")).first()) == (0.00002, 0.00001, -0.00002)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.decimals(-10 ** 6, 10 ** 6, places=9), min_size=1, max_size=40))
def test_sum_and_mean_against_decimals(spark, values):
    values = [float(v) for v in values]
    exact = sum(Decimal(v).quantize(Decimal("1e-9"), ROUND_HALF_UP) for v in values)
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    sums = df.agg(exact_sum("v", 2).alias("s"), F.count("v").alias("n"), decimal_sum("v").alias("t"))
    total, mean = sums.select("s", half_up_mean("t", "n", 4)).first()
    assert total == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))
    assert mean == float((exact / len(values)).quantize(Decimal("0.0001"), ROUND_HALF_UP))


def test_empty_sum_and_mean_are_null(spark):
    r = spark.createDataFrame([], "v DOUBLE").agg(exact_sum("v"), exact_avg("v")).first()
    assert tuple(r) == (None, None)


def test_surrogate_keys_agree_and_are_dense(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("g"), F.xxhash64("id").alias("h"), "id")
    a = surrogate_key(df, ["g", "h"], "key", bucket="g").select("id", "key")
    b = surrogate_key_ranged(df, ["g", "h"], "key", partitions=5).select("id", "key")
    x, y = dict(a.collect()), dict(b.collect())
    assert x == y and sorted(x.values()) == list(range(1, 501))


def test_surrogate_key_of_nothing(spark):
    assert surrogate_key_ranged(spark.range(0), ["id"], "key").count() == 0
