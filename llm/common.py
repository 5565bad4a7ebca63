"""What the operators share: work tables in the cluster's shared folder, and size-checked broadcasts."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import work_path

#: A side is broadcast only after its rows were measured to hold at most so many bytes.
BROADCAST_BYTES = 16 << 20

#: A-Z, the only letters that the contracts lower-case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below spark.checkpoint.dir and read it back: cuts lineage with files that outlive executors."""
    spark = df.sparkSession
    path = work_path(spark, f"llm-{purpose}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, size: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a stored side for broadcast if the sum of the SQL expression ``size`` (bytes a row) is within
    ``limit``; otherwise leave the choice of join to Spark. Either way the rows of the join are the same."""
    total = df.agg(F.sum(F.expr(size))).first()[0] or 0
    return F.broadcast(df) if total <= limit else df


def parts_for(total: int, each: int) -> int:
    """Partitions so that each holds about ``each`` of ``total``."""
    return max(1, -(-int(total or 0) // each))


def vocabulary(name: str) -> str:
    """Where a public vocabulary lies; the operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)
