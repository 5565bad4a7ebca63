"""Nested JSON sources."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.clean import drop_blank_rows

# The flat column names of a station and where each sits in the record.
STATION_FIELDS = {
    "location_id": "id", "location_name": "name", "timezone": "timezone",
    "country_id": "country.code", "country_name": "country.name",
    "latitude": "coordinates.latitude", "longitude": "coordinates.longitude",
    "datetime_first": "datetimeFirst.utc", "datetime_last": "datetimeLast.utc",
}
STATION_PAGE = ("results ARRAY<STRUCT<id: BIGINT, name: STRING, timezone: STRING, "
                "country: STRUCT<code: STRING, name: STRING>, "
                "coordinates: STRUCT<latitude: DOUBLE, longitude: DOUBLE>, "
                "datetimeFirst: STRUCT<utc: STRING>, datetimeLast: STRUCT<utc: STRING>>>")
GDP_RECORD = "ARRAY<STRUCT<country: STRUCT<id: STRING, value: STRING>, date: STRING, value: DOUBLE>>"
GDP_FIELDS = {"country_code": "country.id", "country_name": "country.value",
              "year": "date", "gdp_usd": "value"}


def read_indexed_json(spark: SparkSession, path: str, index: int, schema: str,
                      fields: Mapping[str, str], whole_files: bool = True) -> DataFrame:
    """Documents whose top level is an array: take element ``index`` (itself an array of
    records), one row per record, nested fields lifted, all-blank rows dropped. A document is a
    file, or a line with ``whole_files=False`` (which lets a large file be split)."""
    docs = spark.read.text(path, wholetext=whole_files)
    rows = docs.select(F.inline(F.from_json(F.get_json_object("value", f"$[{index}]"), schema)))
    return drop_blank_rows(rows.select([F.col(src).alias(dst) for dst, src in fields.items()]))


def flatten_pages(pages: DataFrame, fields: Mapping[str, str] = STATION_FIELDS,
                  array: str = "results") -> DataFrame:
    """Paged results to flat rows; a missing nested record gives nulls."""
    rows = pages.select(F.inline(array))
    return rows.select([F.col(src).alias(dst) for dst, src in fields.items()])


def read_station_pages(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    return flatten_pages(spark.read.schema(STATION_PAGE).option("multiLine", whole_files).json(path))


def explode_parallel(df: DataFrame, time_col: str, cols: Sequence[str], keep: Sequence[str] = (),
                     struct: str | None = None) -> DataFrame:
    """Parallel arrays to one row per time entry; an absent array gives nulls for every entry.
    Records without any time entry give no row."""
    src = (lambda c: F.col(f"{struct}.{c}")) if struct else F.col
    size = F.size(src(time_col))
    filled = [F.coalesce(src(c), F.array_repeat(F.lit(None), size)).alias(c) for c in cols]
    zipped = df.select(*keep, src(time_col).alias(time_col), *filled)
    return zipped.select(*keep, F.inline(F.arrays_zip(time_col, *cols)))
