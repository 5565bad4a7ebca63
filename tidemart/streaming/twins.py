"""Structured Streaming forms of the incremental batch operators.

Each stream is a file source with a checkpoint (the checkpoint takes the place of watermark
queries and file ledgers) and runs either until the landed files are read (``available_now``) or
at a fixed interval. Sinks accept an empty micro-batch and may be given the same batch twice.

A stream writes from its own session: a session that has read the table before must call
``spark.catalog.refreshTable`` to see later batches."""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemart.operators import write as W
from tidemart.operators.clean import first_per_key
from tidemart.sources.tables import exists


def file_stream(spark: SparkSession, folder: str, schema: StructType, glob: str | None = None,
                files_per_batch: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(folder)


def event_time(df: DataFrame, time_col: str, lateness: str) -> DataFrame:
    """Watermarks need an instant, so a zone-less column is cast first."""
    return df.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, lateness)


def start(df: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append",
          interval: str | None = None) -> StreamingQuery:
    """Start with ``foreachBatch``: everything landed so far, or every ``interval``."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    w = w.trigger(processingTime=interval) if interval else w.trigger(availableNow=True)
    return w.start()


def append_sink(table: str) -> Callable[[DataFrame, int], None]:
    """Each batch goes to its own partition, so a replayed batch replaces itself. For streams that run
    without end, prefer :func:`insert_sink` on a period: here partitions grow with the batches."""
    def sink(batch: DataFrame, epoch: int) -> None:
        tagged = batch.withColumn("epoch", F.lit(epoch))
        if not exists(batch.sparkSession, table):
            W.write_full(tagged, table, ["epoch"])
        else:
            W.replace_partitions(tagged, table, lambda s: False)
    return sink


def _merge_sink(table: str, keys: Sequence[str], partition_by: Sequence[str], merge, order: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    def sink(batch: DataFrame, _: int) -> None:
        rows = first_per_key(batch, keys, order)
        if exists(batch.sparkSession, table):
            merge(rows, table, keys)  # evaluates the batch once, an empty one included
        else:
            W.append(rows, table, partition_by)
    return sink


def insert_sink(table: str, keys: Sequence[str], partition_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """Insert-only merge by key; replay adds nothing. ``partition_by`` must follow from the keys; with it
    a batch reads only the partitions it touches."""
    return _merge_sink(table, keys, partition_by, W.merge_insert)


def upsert_sink(table: str, keys: Sequence[str], order: Sequence[str], partition_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """Upsert by key; replay writes the same values again. Of several versions of a key in a batch the first in ``order``
    (such as ``["ts DESC"]``) counts. With ``partition_by`` (following from the
    keys) a batch rewrites only the partitions it touches, without it the whole table."""
    return _merge_sink(table, keys, partition_by, W.merge_upsert, order)


def deduplicated(df: DataFrame, keys: Sequence[str], time_col: str, lateness: str) -> DataFrame:
    """First arrival per key; state is dropped once the watermark has passed."""
    return event_time(df, time_col, lateness).dropDuplicatesWithinWatermark(list(keys))


def daily_tail(df: DataFrame, time_col: str, keys: Sequence[str], aggs, lateness: str = "7 days") -> DataFrame:
    """Daily aggregates that late rows may still change for ``lateness``; to be run in ``update`` mode
    into an :func:`upsert_sink` on ``day`` and ``keys``."""
    rows = event_time(df, time_col, lateness)
    out = rows.groupBy(F.window(time_col, "1 day").alias("w"), *keys).agg(*aggs)
    return out.select(F.to_date("w.start").alias("day"), *[c for c in out.columns if c != "w"])
