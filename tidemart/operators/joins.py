"""Lookups and orphan checks.

No join carries a broadcast hint: Spark broadcasts a side when its measured size is below the
threshold and sort-merges otherwise, splitting hot partitions at run time (see ``session``)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(facts: DataFrame, dim: DataFrame, fact_col: str, dim_col: str,
           take: Sequence[str]) -> DataFrame:
    """Left join on one key; integer keys of different width meet as longs. Facts without a partner
    keep nulls in the taken columns."""
    key = "__key"
    small = dim.select(F.col(dim_col).alias(key), *take)
    return facts.join(small, facts[fact_col] == small[key], "left").drop(key)


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """``(fk, rows)`` of child keys without a parent; null children pass.

    Child rows are counted per key first, so a hot key costs one row in the join."""
    keys = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("rows"))
    return keys.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def restrict(facts: DataFrame, fact_key: str, dim_rows: DataFrame, dim_key: str) -> DataFrame:
    """Facts whose key is among the given dimension rows."""
    return facts.join(dim_rows.select(F.col(dim_key).alias(fact_key)), fact_key, "left_semi")
