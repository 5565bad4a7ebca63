"""Parquet files whose footers disagree: column case, number types, new columns."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.functions.casts import cast_map
from tidemart.sources import files as L


def list_files(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """``(path, file, parent, length, modified)`` of the files below a folder."""
    return L.landed(spark, folder, glob=glob)


PERIOD = r"(\d{4})-(\d{2})"


def with_period(files: DataFrame, pattern: str = PERIOD, column: str = "file") -> DataFrame:
    """Add ``year, month`` taken from the file name (or the path); names without a period are
    dropped."""
    part = lambda i: F.regexp_extract(column, pattern, i).try_cast("int")
    return files.withColumns({"year": part(1), "month": part(2)}).where("year IS NOT NULL")


def files_for_years(files: DataFrame, start: int, end: int, pattern: str = PERIOD,
                    column: str = "file") -> DataFrame:
    return with_period(files, pattern, column).where(F.col("year").between(start, end))


class Generation(NamedTuple):
    """Paths or globs whose files can be read with one schema."""
    units: list[str]
    schema: StructType


def period_units(files: DataFrame) -> list[str]:
    """One glob for each folder and period of ``files`` (with ``year, month``), however many files that are. Where the period stands in the folder's
    name, the glob is the whole folder."""
    period = F.format_string("%04d-%02d", "year", "month")
    rows = files.select("parent", F.when(F.contains("file", period), period).alias("period")).distinct().orderBy("parent", "period").collect()
    return [f"{L.escaped(r['parent'])}/*{r['period'] + '*' if r['period'] else ''}.parquet" for r in rows]


def folder_units(files: DataFrame) -> list[str]:
    """One glob for each folder that holds some of ``files``."""
    return [f"{L.escaped(r[0])}/*.parquet" for r in files.select("parent").distinct().orderBy("parent").collect()]


def file_units(files: DataFrame) -> list[str]:
    rows = files.select(F.concat_ws("/", "parent", "file").alias("path")).orderBy("path").collect()
    return [L.escaped(r[0]) for r in rows]


def _fits(a: StructType, b: StructType) -> bool:
    types = {f.name.lower(): f.dataType for f in a}
    return all(types.get(f.name.lower(), f.dataType) == f.dataType for f in b)


def _both(a: StructType, b: StructType) -> StructType:
    have = {f.name.lower() for f in a}
    return StructType([*a, *(f for f in b if f.name.lower() not in have)])


def _schema(spark: SparkSession, units: Sequence[str]) -> StructType | None:
    """The schema of all files of the units, from their footers, which Spark's reader opens in tasks; None if they disagree."""
    try:
        return spark.read.option("mergeSchema", True).parquet(*units).schema
    except (Py4JJavaError, PySparkException) as e:
        if "CANNOT_MERGE_SCHEMAS" not in str(e):
            raise
        return None


def generations(spark: SparkSession, units: Sequence[str]) -> list[Generation]:
    """Units (globs in the order of their periods, such as :func:`period_units` gives) grouped by schema. A stretch of periods whose first and last
    units agree by one footer each is taken for one generation, others are halved; then Spark's reader merges all footers of a stretch in
    tasks, and only where they disagree is it looked at unit by unit, and a unit that disagrees within itself file by file. So the driver
    gets one schema a generation and no list of files, but for such a unit."""
    footers: dict[str, StructType] = {}

    def footer(unit: str) -> StructType:
        if unit not in footers:
            footers[unit] = spark.read.parquet(unit).schema
        return footers[unit]

    def stretches(units: list[str]) -> list[list[str]]:
        if len(units) < 2 or _fits(footer(units[0]), footer(units[-1])):
            return [units]
        half = len(units) // 2
        return stretches(units[:half]) + stretches(units[half:])

    def alike(found: Sequence[Generation]) -> list[Generation]:
        out: list[Generation] = []
        for g in found:
            k = next((k for k, o in enumerate(out) if _fits(o.schema, g.schema)), None)
            if k is None:
                out.append(g)
            else:
                out[k] = Generation(out[k].units + g.units, _both(out[k].schema, g.schema))
        return out

    def settled(units: list[str]) -> list[Generation]:
        schema = _schema(spark, units)
        if schema is not None:
            return [Generation(units, schema)]
        if len(units) == 1:
            units = file_units(L.landed(spark, *units, recursive=False))
            return [Generation([u], footer(u)) for u in units]
        parts = alike([Generation([u], footer(u)) for u in units])
        return [g for p in parts for g in settled(p.units)] if len(parts) > 1 else [g for u in units for g in settled([u])]
    return alike([g for s in stretches(list(units)) for g in settled(s)]) if units else []


def read_drifting(spark: SparkSession, groups: Sequence[Generation],
                  renames: Mapping[str, str], casts: Mapping[str, str], files: DataFrame | None = None) -> DataFrame:
    """One branch per schema generation (not per file): read, fix case drift, cast, union by name.

    Columns that a generation lacks come back as nulls. ``renames`` is matched exactly, so
    ``{"Airport_fee": "airport_fee"}`` repairs a changed capital letter. With ``files`` only those are read of what the units match."""
    def one(group: Generation) -> DataFrame:
        df = spark.read.schema(group.schema).parquet(*group.units)
        if files is not None:
            df = L.only(df, files)
        fix = {a: b for a, b in renames.items() if a in df.columns}
        return cast_map(df.withColumnsRenamed(fix), casts)

    frames = [one(g) for g in groups]
    if not frames:
        raise ValueError("no source files to read")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
