"""CSV sources."""
from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.casts import cast_map
from tidemart.operators.clean import drop_blank_rows
from tidemart.sources.files import escaped, matches, only


def read_csv_table(spark: SparkSession, path: str, renames: Mapping[str, str],
                   casts: Mapping[str, str]) -> DataFrame:
    """CSV with a header. Everything is text first (no inference pass over the data); quoted
    commas, doubled quotes and a literal ``N/A`` stay text, an empty field is null, a bad cast is null."""
    df = spark.read.option("header", True).option("escape", '"').csv(path)
    return cast_map(df.withColumnsRenamed(dict(renames)), casts)


def read_narrow_csv(spark: SparkSession, path: str, keep: Mapping[str, str],
                    casts: Mapping[str, str]) -> DataFrame:
    """A wide CSV cut to the ``keep`` columns (old name → new name) before parsing the others,
    typed, without rows in which every kept field is blank."""
    df = spark.read.option("header", True).csv(path)
    df = df.select([F.col(f"`{a}`").alias(b) for a, b in keep.items()])
    return cast_map(drop_blank_rows(df), casts)


#: Up to so many stations are named in the globs of the archive's folders.
NAMED_STATIONS = 2_000


def archive_folders(spark: SparkSession, base: str, months: Iterable[tuple[int, int]] | None = None, ids: DataFrame | None = None) -> list[str]:
    """Globs of the wanted ``locationid=/year=/month=`` folders, one a year, that exist. They are built before anything is listed, so files of other
    months (and, for up to NAMED_STATIONS stations, of other stations) are never seen. Months may be written with or without a zero."""
    stations = "*"
    if ids is not None:
        named = [r[0] for r in ids.select(F.col(ids.columns[0]).cast("bigint")).distinct().limit(NAMED_STATIONS + 1).collect() if r[0] is not None]
        if len(named) <= NAMED_STATIONS:
            stations = "{" + ",".join(str(k) for k in sorted(named)) + "}"
            if not named:
                return []
    root = f"{escaped(base.rstrip('/'))}/locationid={stations}"
    if months is None:
        globs = [f"{root}/year=*/month=*"]
    else:
        by_year: dict[int, list[int]] = {}
        for y, m in months:
            by_year.setdefault(y, []).append(m)
        globs = [f"{root}/year={y}/month={{{','.join(sorted({str(m) for m in ms} | {f'{m:02d}' for m in ms}))}}}" for y, ms in sorted(by_year.items())]
    return [g for g in globs if matches(spark, g)]


def read_archive(spark: SparkSession, base: str, schema: str, ids: DataFrame | None = None,
                 months: Iterable[tuple[int, int]] | None = None, files: DataFrame | None = None) -> DataFrame:
    """Gzipped CSV laid out as ``locationid=/year=/month=``.

    Months, and stations while they are few, choose the folders that are listed at all; ``ids`` is a one-column frame and also
    restricts by semi-join, which prunes folders at run time where the stations were too many to name. With ``files`` only those are opened."""
    full = f"{schema}, locationid BIGINT, year INT, month INT"
    folders = archive_folders(spark, base, months, ids)
    if not folders:
        return spark.createDataFrame([], full)
    df = spark.read.option("header", True).option("basePath", base).schema(full).csv(folders)
    if files is not None:
        df = only(df, files)
    if ids is not None:
        key = ids.columns[0]
        df = df.join(ids.select(F.col(key).cast("bigint").alias("locationid")), "locationid", "left_semi")
    return df
