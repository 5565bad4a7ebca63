"""Surrogate keys, date spines and period grids."""
from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.functions.dates import MONDAY_FIRST, date_key
from tidemart.operators.write import append, once
from tidemart.session import shared_dir
from tidemart.sources.tables import scan_or_empty


def surrogate_key(df: DataFrame, order: Sequence[str], name: str, bucket: str) -> DataFrame:
    """1, 2, 3 … in ``order`` without sorting the whole frame in one task.

    ``bucket`` (SQL text) must be non-decreasing along ``order``: the year of a date, the leading
    order column. Rows are numbered inside each bucket and shifted by the number of rows in earlier
    buckets; only the per-bucket counts meet in one task. For keys without such a bucket, or
    with one bucket that dominates, use :func:`surrogate_key_ranged`."""
    df = df.selectExpr("*", f"{bucket} AS __bucket")
    counts = df.groupBy("__bucket").agg(F.count("*").alias("__n"))
    offsets = counts.selectExpr("__bucket AS __of", "coalesce(sum(__n) OVER (ORDER BY __bucket ROWS BETWEEN "
                                "UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS __before")
    numbered = df.selectExpr("*", f"row_number() OVER (PARTITION BY __bucket ORDER BY {', '.join(order)}) AS __rn")
    return (numbered.join(offsets, F.expr("__bucket <=> __of"))
            .selectExpr(*[f"`{c}`" for c in df.columns if c != "__bucket"], f"CAST(__rn + __before AS INT) AS {name}"))


def surrogate_key_ranged(df: DataFrame, order: Sequence[str], name: str,
                         partitions: int | None = None) -> DataFrame:
    """1, 2, 3 … in ``order`` for frames of any size.

    Range-partitioned and sorted once, cut by a checkpoint so that both later passes see the same
    partitions even after executors are lost; then a count per partition (one small row each) and
    ``offset + position``. Ranges follow the data, so skew is split as long as ``order`` ends in a
    column that breaks ties. The result type is long."""
    spark = df.sparkSession
    shared_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint()
    part, pos = "__part", "__pos"
    # position inside the partition: the low 33 bits of the built-in per-partition id
    ranged = ranged.select("*", F.spark_partition_id().alias(part),
                           F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias(pos))
    sizes = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))  # one row a partition
    offsets = sizes.selectExpr(f"{part} AS __of", f"coalesce(sum(__n) OVER (ORDER BY {part} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS __before")
    numbered = ranged.join(F.broadcast(offsets), F.col(part) == F.col("__of"))  # n rows at most
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__before") + F.col(pos) + 1).cast("long").alias(name))


def registered_keys(df: DataFrame, registry: str, natural: Sequence[str], name: str, bucket: str) -> DataFrame:
    """Surrogate keys that never change: those of natural keys in the registry table stay, new natural keys are numbered after its
    largest key, in the order of ``natural`` (``bucket`` as for :func:`surrogate_key`), and entered. A run that ends after the entry finds its keys
    again. Null parts of a natural key are values like others."""
    spark = df.sparkSession
    kind = dict(df.dtypes)
    empty = StructType.fromDDL(", ".join([*(f"`{c}` {kind[c]}" for c in natural), f"`{name}` INT"]))
    known = scan_or_empty(spark, registry, empty)
    same = lambda a, b: F.expr(" AND ".join(f"{a}.`{c}` <=> {b}.`{c}`" for c in natural))
    fresh, n, _ = once(df.select(*natural).distinct().alias("d").join(known.alias("k"), same("d", "k"), "left_anti"))
    if n:
        top = known.agg(F.max(name)).first()[0] or 0
        numbered = surrogate_key(fresh, list(natural), name, bucket)
        append(numbered.withColumn(name, F.col(name) + F.lit(top)), registry)
    keys = scan_or_empty(spark, registry, empty)
    return df.alias("d").join(keys.alias("k"), same("d", "k")).select("d.*", f"k.{name}")


def date_spine(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day, both ends included."""
    days = (last - first).days + 1
    return spark.range(days).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"))


def date_attributes(days: DataFrame) -> DataFrame:
    """The calendar columns of a ``date`` column."""
    return days.select(date_key("date").alias("date_key"), "date", *[F.expr(e) for e in (
        "year(date) AS year", "quarter(date) AS quarter", "month(date) AS month",
        "date_format(date, 'MMMM') AS month_name", "weekofyear(date) AS week_of_year", "day(date) AS day_of_month",
        f"{MONDAY_FIRST.format('date')} AS day_of_week", "date_format(date, 'EEEE') AS day_name",
        "weekday(date) >= 5 AS is_weekend")])


def month_grid(spark: SparkSession, start: int, end: int) -> DataFrame:
    """``(year, month)`` for every month of the year range."""
    i = F.col("id").cast("int")
    return spark.range(12 * (end - start + 1)).select(
        (F.lit(start) + F.floor(i / 12)).cast("int").alias("year"), (i % 12 + 1).alias("month"))


def missing_periods(expected: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected periods that are not present."""
    return expected.join(present.select(*keys).distinct(), list(keys), "left_anti")
