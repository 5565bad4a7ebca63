"""Session settings and the shared work folder."""
from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results or the survival of a plan; all are runtime SQL settings,
# so they can be applied to a session somebody else started.
_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even where that costs one more exchange above the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # what a Python worker and its task hold of a table at once: long texts come in small batches
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
}


def build(app: str = "tidemart", master: str | None = None, **conf: str) -> SparkSession:
    """Start a session. Shuffle partitions follow the local cores; on a cluster pass
    ``spark_sql_shuffle_partitions`` (underscores stand for dots) or set it at submit time."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            n = master.strip("local[]") or "1"
            n = str(os.cpu_count()) if n == "*" else n
            b = b.config("spark.sql.shuffle.partitions", n)
            b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in {**_RUNTIME, **{k.replace("_", "."): v for k, v in conf.items()}}.items():
        b = b.config(key, value)
    return b.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the result-relevant runtime settings to an existing session."""
    for key, value in _RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; a cluster without the setting
    is refused, because a machine-local folder would be lost with its machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster has machines of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="tidemart-")
    spark.sparkContext.setCheckpointDir(made)
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def work_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path for one run under the shared folder; never reused, never cleared."""
    return f"{shared_dir(spark).rstrip('/')}/tidemart/{purpose}-{uuid.uuid4().hex}"


def work_database(spark: SparkSession, purpose: str) -> str:
    """A fresh catalog database located under the shared folder."""
    name = f"{purpose}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{work_path(spark, purpose)}'")
    return name
