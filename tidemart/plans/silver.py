"""Cleaned tables from raw frames. Every builder is a pure frame-to-frame function.

Filters run before deduplication, so a key is never lost because its kept row was the bad one."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.casts import cast_map, rename_map, soft_cast
from tidemart.functions.dates import period_keys
from tidemart.functions.units import PPM_TO_UGM3, POLLUTANTS, convert_value, relabel_units
from tidemart.operators.clean import first_per_key, require, sane_range, strictly_positive
from tidemart.plans import contracts as C

# Raw column names, their clean names, the raw types aligned across file
# generations, and the sanity limits of a trip.
TRIP_CASE = {"Airport_fee": "airport_fee"}
TRIP_CASTS = {"VendorID": "bigint", "RatecodeID": "double", "PULocationID": "bigint",
              "DOLocationID": "bigint", "payment_type": "bigint", "passenger_count": "double"}
TRIP_RENAMES = {"VendorID": "vendor_id", "tpep_pickup_datetime": "pickup_datetime",
                "tpep_dropoff_datetime": "dropoff_datetime", "RatecodeID": "ratecode_id",
                "PULocationID": "pu_location_id", "DOLocationID": "do_location_id"}
WEATHER_RENAMES = {"temperature_2m": "temperature_c", "apparent_temperature": "feels_like_c",
                   "precipitation": "precipitation_mm", "wind_speed_10m": "wind_speed_kmh",
                   "relative_humidity_2m": "humidity_pct"}
MAX_DISTANCE = 100
MAX_FARE = 10_000


def trips(raw: DataFrame, max_distance: float = MAX_DISTANCE, max_fare: float = MAX_FARE) -> DataFrame:
    """Trips with clean names, instants, period columns; sane rows only; one row per trip key."""
    shape = []
    for c in raw.columns:
        name = TRIP_RENAMES.get(TRIP_CASE.get(c, c), TRIP_CASE.get(c, c))
        to = "TIMESTAMP" if name in ("pickup_datetime", "dropoff_datetime") else TRIP_CASTS.get(c)
        shape.append(f"TRY_CAST(`{c}` AS {to}) AS `{name}`" if to else f"`{c}` AS `{name}`")
    df = require(raw.selectExpr(*shape), "pickup_datetime", "pu_location_id", "do_location_id")
    df = df.where(sane_range("trip_distance", max_distance) & sane_range("fare_amount", max_fare))
    return period_keys(first_per_key(df, C.TRIPS.keys), "pickup_datetime")


def measurements(raw: DataFrame, pollutants=POLLUTANTS,
                 factors: Mapping[str, float] = PPM_TO_UGM3, as_landed: bool = False) -> DataFrame:
    """Positive pollutant readings in common units; one row per station, parameter and instant: the first by
    its other columns, with ``as_landed`` by those of the landed row, before its value and units are converted."""
    df = raw.where(F.col("parameter").isin(list(pollutants)) & strictly_positive("value"))
    df = df.withColumn("datetime", soft_cast("datetime", "timestamp"))
    df = require(df.drop("year", "month", "ingest_run"), *C.MEASUREMENTS.keys)
    if as_landed:
        df = first_per_key(df, C.MEASUREMENTS.keys)
    # value before units: the conversion still looks at the raw unit
    df = df.withColumns({"value": convert_value(factors=factors), "units": relabel_units()})
    return period_keys(df if as_landed else first_per_key(df, C.MEASUREMENTS.keys), "datetime")


def weather(raw: DataFrame) -> DataFrame:
    """Hourly weather with unit names and a rain flag (null rain stays null). Of repeated hours the row of the
    newest file wins, then of the newest ingestion, where the raw rows tell."""
    df = rename_map(raw, WEATHER_RENAMES)
    df = df.withColumn("datetime", soft_cast("datetime", "timestamp"))
    df = df.withColumn("is_rainy", F.col("precipitation_mm") > 0)
    df = require(df, "datetime", "temperature_c")
    newest = [f"{c} DESC" for c in ("file_modified", "file", "ingestion_timestamp") if c in df.columns]
    df = period_keys(first_per_key(df, C.WEATHER.keys, newest), "datetime")
    return df.select(C.WEATHER.schema.names)


def locations(raw: DataFrame) -> DataFrame:
    return first_per_key(require(raw, "location_id", "country_id"), C.LOCATIONS.keys)


def gdp(raw: DataFrame) -> DataFrame:
    df = cast_map(raw, {"year": "int", "gdp_usd": "double"})
    return first_per_key(require(df, "country_code", "gdp_usd"), C.GDP.keys)


def fx_rates(raw: DataFrame) -> DataFrame:
    df = cast_map(raw, {"date": "date", "usd_eur_rate": "double"})
    return first_per_key(require(df, "usd_eur_rate"), C.FX.keys)


def zones(raw: DataFrame) -> DataFrame:
    df = require(cast_map(raw, {"location_id": "int"}), "location_id")
    return first_per_key(df, C.ZONES.keys).orderBy("location_id")
