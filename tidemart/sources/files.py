"""Landed files as rows: where they lie, how long they are, when they were written; and reads of chosen files only."""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Up to so many files are named one by one; more are read by folder and sorted out by row.
NAMED_FILES = 5_000


def landed(spark: SparkSession, *folders: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """``(path, file, parent, length, modified)`` of the files below folders (or globs of folders). Only metadata is read: the content column of the file
    source is never selected. ``path`` is spelled as ``_metadata.file_path`` spells it, ``parent`` as a reader takes it."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).load(list(folders)))
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"),
                        F.regexp_replace("path", "/[^/]*$", "").alias("parent"), "length", F.col("modificationTime").alias("modified"))


def only(df: DataFrame, files: DataFrame, limit: int = NAMED_FILES) -> DataFrame:
    """Rows of a file source that come from ``files`` (``path``). Up to ``limit`` paths become a literal filter on the file's name, which Spark
    applies to the listing, so that no other file is opened; beyond that the rows are sorted out by a semi-join."""
    at = F.col("_metadata.file_path")
    named = [r[0] for r in files.select("path").limit(limit + 1).collect()]
    if len(named) <= limit:
        return df.where(at.isin(named))
    return df.select("*", at.alias("__file")).join(files.select(F.col("path").alias("__file")).distinct(), "__file", "left_semi").drop("__file")


def escaped(path: str) -> str:
    """A path as a glob that matches nothing else."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def matches(spark: SparkSession, glob: str) -> bool:
    """Whether anything lies at a glob; folders are listed, no file is opened."""
    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path)
    return found is not None and len(found) > 0
