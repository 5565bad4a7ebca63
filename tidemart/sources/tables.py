"""Stored tables: scan, first-run handling, narrow ordered reads."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def scan(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def scan_or_empty(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """The table, or no rows of ``schema`` when it does not exist yet (first run)."""
    return spark.table(table) if exists(spark, table) else spark.createDataFrame([], schema)


def ordered_feed(df: DataFrame, cols: Sequence[str], order: str, since=None,
                 ties: Sequence[str] = ()) -> DataFrame:
    """Column list, optional strict lower bound, ascending order. The bound and the columns reach
    the scan; ``ties`` keeps a hot instant from landing whole in one sort range."""
    if since is not None:
        df = df.where(F.col(order) > F.lit(since))
    return df.orderBy(order, *ties).select(*cols)
