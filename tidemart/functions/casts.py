"""Renames and casts that never raise: text that does not parse becomes null."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def soft_cast(c: Column | str, to: str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast(to)


def cast_map(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Cast the listed columns that the frame has; the column order is kept."""
    return df.withColumns({c: soft_cast(F.col(c), t) for c, t in casts.items() if c in df.columns})


def rename_map(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in renames.items() if a in df.columns})


def conform(df: DataFrame, schema) -> DataFrame:
    """Exact projection to a target schema; absent columns become typed nulls."""
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])
