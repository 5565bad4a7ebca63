"""Writes to catalog tables: full, by range, append, insert-only merge, upsert, slice replacement.

Parquet tables have no transaction log. Every write here is safe to run again, executors lost
mid-write are covered by Spark's staged commit, and a whole-table replacement is written aside
before the old table is touched; but a multi-partition change is not atomic for readers."""
from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from typing import NamedTuple
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemart.session import work_path
from tidemart.sources.tables import exists

_MODE = "spark.sql.sources.partitionOverwriteMode"
# Fixed value: the catalog's name of the partition of null keys.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@contextmanager
def _dynamic(spark: SparkSession):
    before = spark.conf.get(_MODE)
    spark.conf.set(_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_MODE, before)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def stored_partitions(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """Partition specs from the catalog; no data is read."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return [{k: unquote(v) for k, v in (p.split("=", 1) for p in r[0].split("/"))} for r in rows]


def _spec_value(v) -> str:
    """A partition value as the catalog spells it."""
    if v is None:
        return NULL_PARTITION
    return str(v).lower() if isinstance(v, bool) else str(v)


def _spread(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Before a partitioned write: bring rows of a partition together so that it gets few files,
    and let the adaptive plan split partitions that are too big for one task."""
    return df.hint("rebalance", *[F.col(p) for p in parts]) if parts else df


def _counted(df: DataFrame, parts: Sequence[str] = (), values: Column | None = None) -> tuple[DataFrame, Observation]:
    """Count rows, and collect the partition values met, while the write runs; with ``values`` also the different values of that
    expression. The sets are bounded by the number of partitions and, for ``values``, by what the caller asks for (days, say)."""
    seen = Observation()
    extra = [F.collect_set(F.struct(*parts)).alias("parts")] if parts else []
    if values is not None:
        extra.append(F.collect_set(values).alias("values"))
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *extra), seen


def observed(seen: Observation) -> dict:
    """The observed values after a write. An input that proves empty while running is cut out of
    the plan together with its counters; nothing was written then."""
    try:
        return seen.get
    except Py4JJavaError as e:
        if "toPyRow" not in str(e):
            raise
        return {"rows": 0, "parts": [], "values": []}


def align(spark: SparkSession, df: DataFrame, table: str, merge_schema: bool = False) -> DataFrame:
    """The frame in the table's column order. With ``merge_schema`` new columns are first added to
    the table (older rows read as null); columns the frame lacks are null. Without it, extra or
    missing columns are an error."""
    have = spark.table(table)
    new = [f for f in df.schema.fields if f.name not in have.columns]
    if merge_schema:
        if new:
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")
            have = spark.table(table)
    elif new or set(have.columns) - set(df.columns):
        raise ValueError(f"columns differ from {table}: {sorted(set(have.columns) ^ set(df.columns))}")
    return df.select([(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                      for f in have.schema.fields])


def write_full(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> int:
    """Replace the whole table, schema included; returns the rows written.

    An unpartitioned table is written aside and renamed into place, so the frame may read the
    table it replaces and a failed write leaves the old table untouched."""
    spark = df.sparkSession
    if partition_by:
        same = lambda a, b: {(f.name, f.dataType) for f in a.schema} == {(f.name, f.dataType) for f in b.schema}
        if exists(spark, table) and same(spark.table(table), df) and partition_columns(spark, table) == list(partition_by):
            return replace_partitions(df, table, lambda spec: True)
        out, seen = _counted(df)
        _spread(out, partition_by).write.mode("overwrite").partitionBy(*partition_by).saveAsTable(table)
        return observed(seen)["rows"]
    out, seen = _counted(df)
    aside, old = (f"{table}_{tag}_{uuid.uuid4().hex[:8]}" for tag in ("new", "old"))
    out.write.saveAsTable(aside)
    if exists(spark, table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    return observed(seen)["rows"]


def replace_partitions(df: DataFrame, table: str, in_scope) -> int:
    """Overwrite the partitions that occur in ``df`` and drop stored ones that ``in_scope(spec)``
    accepts but ``df`` no longer holds. ``df`` may read the table itself."""
    spark = df.sparkSession
    parts = partition_columns(spark, table)
    out, seen = _counted(align(spark, df, table), parts)
    with _dynamic(spark):
        _spread(out, parts).write.mode("overwrite").insertInto(table)
    done = observed(seen)
    written = {tuple(_spec_value(v) for v in p) for p in (done["parts"] or [])}
    gone = [s for s in stored_partitions(spark, table)
            if in_scope(s) and tuple(s[p] for p in parts) not in written]
    if gone:
        specs = ", ".join("PARTITION (" + ", ".join(f"`{k}`='{v}'" for k, v in s.items()) + ")" for s in gone)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    return done["rows"]


def write_range(df: DataFrame, table: str, partition_by: Sequence[str], lo: int, hi: int,
                merge_schema: bool = False) -> int:
    """Replace the partitions whose first partition column lies in ``[lo, hi]``; stored partitions in range
    without new rows are cleared. A row outside the range (or without a value) fails the write before
    anything is replaced: it would neither be stored nor replace what it belongs to."""
    spark = df.sparkSession
    lead = partition_by[0]
    df = df.withColumn(lead, F.expr(f"""CASE WHEN `{lead}` BETWEEN {lo} AND {hi} THEN `{lead}`
        ELSE raise_error(concat('a row has {lead} ', coalesce(CAST(`{lead}` AS STRING), 'null'), ', outside {lo} to {hi}')) END"""))
    if not exists(spark, table):
        return write_full(df, table, partition_by)
    df = align(spark, df, table, merge_schema)
    return replace_partitions(df, table, lambda s: s[lead].isdigit() and lo <= int(s[lead]) <= hi)


def append(df: DataFrame, table: str, partition_by: Sequence[str] = (), merge_schema: bool = False) -> int:
    """Add rows and return how many, counted while writing."""
    return _append(df, table, partition_by, merge_schema)["rows"]


def append_touching(df: DataFrame, table: str, values: Column, partition_by: Sequence[str] = (), merge_schema: bool = False) -> tuple[int, set]:
    """As :func:`append`; also the different values of an expression over the rows added, such as their days."""
    done = _append(df, table, partition_by, merge_schema, values)
    return done["rows"], set(done["values"] or [])


def _append(df: DataFrame, table: str, partition_by: Sequence[str], merge_schema: bool, values: Column | None = None) -> dict:
    spark = df.sparkSession
    if not exists(spark, table):
        out, seen = _counted(df, values=values)
        w = _spread(out, partition_by).write
        (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(table)
        return observed(seen)
    out, seen = _counted(align(spark, df, table, merge_schema), values=values)
    _spread(out, partition_columns(spark, table)).write.mode("append").insertInto(table)
    return observed(seen)


def not_matched(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not in the target; a null in a key never matches. Only the key
    columns of the target are read."""
    return source.join(target.select(*keys), list(keys), "left_anti").select(*source.columns)


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after an upsert: matched rows take all source values, the rest stays, new keys
    are added. The source must be unique on the keys."""
    return not_matched(target, source, keys).unionByName(source)


def _within(parts: Sequence[str], specs: Sequence[Sequence[str]]) -> Column:
    """Rows of the given partitions, as literals on the partition columns: the scan lists only those."""
    if not specs:
        return F.lit(False)
    named = [F.coalesce(F.col(p).cast("string"), F.lit(NULL_PARTITION)) for p in parts]
    if len(parts) == 1:
        return named[0].isin([s[0] for s in specs])
    return F.struct(*named).isin([F.struct(*[F.lit(v) for v in s]) for s in specs])


class Increment(NamedTuple):
    """Rows of a merge that lie in files, how many they are, and the values of the partition columns among them."""
    frame: DataFrame
    rows: int
    parts: list[tuple]


def once(source: DataFrame, by: Sequence[str] = ()) -> Increment:
    """The increment of a merge, evaluated once: written below the shared folder and read back, with its number of rows and the
    values of the columns ``by`` counted on the way. Files outlive executors, so nothing upstream runs again."""
    spark = source.sparkSession
    path = work_path(spark, "increment")
    out, seen = _counted(source, by)
    out.write.parquet(path)
    done = observed(seen)
    return Increment(spark.read.schema(source.schema).parquet(path), done["rows"], [tuple(p) for p in (done.get("parts") or [])])


def _typed(df: DataFrame) -> DataFrame:
    """Columns of nulls without a type become text, which files can hold."""
    return df.withColumns({c: F.col(c).cast("string") for c, t in df.dtypes if t == "void"})


def _touched(target: DataFrame, by: Sequence[str], met: Sequence[tuple]) -> DataFrame:
    """Target rows in the partitions met. The values come to the driver (never more than the table has partitions, plus new ones), because only
    literals prune the target for certain: run-time pruning needs a broadcast, which a large increment rules out."""
    return target.where(_within(by, [[_spec_value(v) for v in m] for m in met])) if by else target


def merge_insert(source: DataFrame, table: str, keys: Sequence[str], merge_schema: bool = False) -> int:
    """Append source rows with unknown keys. In a partitioned table the partition columns must
    follow from the key (a period taken from a key time), so that only touched partitions are read. The source is evaluated once."""
    return merge_insert_touching(source, table, keys, None, merge_schema)[0]


def merge_insert_touching(source: DataFrame | Increment, table: str, keys: Sequence[str], values: Column | None, merge_schema: bool = False) -> tuple[int, set]:
    """As :func:`merge_insert`; also the different values of an expression over the rows that were added. The source may have been
    written already, with the table's partition columns."""
    spark = (source.frame if isinstance(source, Increment) else source).sparkSession
    parts = partition_columns(spark, table)
    increment, n, met = source if isinstance(source, Increment) else once(_typed(source), parts)
    if not n:
        return 0, set()
    fresh = not_matched(increment, _touched(spark.table(table), parts, met), keys)
    done = _append(fresh, table, (), merge_schema, values)
    return done["rows"], set(done.get("values") or [])


def merge_upsert(source: DataFrame, table: str, keys: Sequence[str]) -> int:
    """Update matched rows, insert the others; rewrites touched partitions only (the whole table
    when it is unpartitioned). Same condition on partition columns as :func:`merge_insert`. The source is evaluated once."""
    spark = source.sparkSession
    parts = partition_columns(spark, table)
    increment, n, met = once(align(spark, source, table), parts)
    target = spark.table(table)
    if not n:
        return 0 if parts else target.count()
    result = merged(_touched(target, parts, met), increment, keys)
    return replace_partitions(result, table, lambda s: False) if parts else write_full(result, table)


def replace_slice(new: DataFrame, table: str, keep: Column, in_scope=None) -> int:
    """Stored rows satisfying ``keep`` plus the new rows. Running it twice gives the same table.

    ``in_scope(spec)`` names the partitions that may hold rows to be replaced; others are neither
    read nor rewritten. Without it, or on an unpartitioned table, the whole table is rewritten."""
    spark = new.sparkSession
    if not exists(spark, table):
        return write_full(new, table)
    parts = partition_columns(spark, table)
    kept = spark.table(table).where(keep)
    if not parts:
        return write_full(kept.unionByName(new), table)
    scope = in_scope or (lambda s: True)
    specs = [s for s in stored_partitions(spark, table) if scope(s)]
    here = _within(parts, [[s[p] for p in parts] for s in specs])
    return replace_partitions(kept.where(here).unionByName(align(spark, new, table)), table, scope)


def year_replace(new: DataFrame, table: str, start: int, end: int, time_col: str) -> int:
    """Replace the years ``start..end`` of a raw table. A new row of another year fails the write; rows without a
    readable time are stored, and stored ones stay unless new ones take their partition. A stored table without a ``year`` column gets
    one first; columns may differ on either side and are filled with nulls."""
    spark = new.sparkSession
    year = F.year(F.col(time_col).try_cast("timestamp"))
    if "year" not in new.columns:
        new = new.withColumn("year", year)
    new = new.withColumn("year", F.expr(f"""CASE WHEN year IS NULL OR year BETWEEN {start} AND {end} THEN year
        ELSE raise_error(concat('a row has year ', CAST(year AS STRING), ', outside {start} to {end}')) END"""))
    if not exists(spark, table):
        return write_full(new, table, ["year"])
    old = spark.table(table)
    if partition_columns(spark, table) == ["year"]:
        missing = [c for c in old.columns if c not in new.columns]
        new = new.withColumns({c: F.lit(None) for c in missing})
        new = align(spark, new, table, True)
        return replace_partitions(new, table, lambda s: s["year"].isdigit() and start <= int(s["year"]) <= end)
    if "year" not in old.columns:
        old = old.withColumn("year", year)
    # a row without a readable time belongs to no year; a raw table is its last copy
    kept = old.where((F.col("year") < start) | (F.col("year") > end) | F.col("year").isNull())
    return write_full(kept.unionByName(new, allowMissingColumns=True), table)


def stamped(df: DataFrame, name: str = "ingestion_timestamp") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())
