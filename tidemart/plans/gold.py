"""Star schema: four dimensions and two daily facts."""
from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.dates import date_key
from tidemart.functions.exact import decimal_sum, half_up_mean, half_up_ratio, rounded_avg
from tidemart.functions.units import convert_currency, in_units
from tidemart.operators.joins import lookup
from tidemart.operators.keys import date_attributes, date_spine, registered_keys, surrogate_key
from tidemart.plans import contracts as C


def dim_date(spark: SparkSession, start: int, end: int,
             stored: tuple[int | None, int | None] = (None, None)) -> DataFrame:
    """Every day of the years ``start..end``, widened by the stored year range so that a partial
    run never loses earlier years."""
    lo = min(y for y in (start, stored[0]) if y is not None)
    hi = max(y for y in (end, stored[1]) if y is not None)
    return date_attributes(date_spine(spark, date(lo, 1, 1), date(hi, 12, 31)))


def dim_zone(zones: DataFrame) -> DataFrame:
    return (zones.where("location_id IS NOT NULL")
            .select(F.col("location_id").cast("int").alias("zone_key"), F.col("location_id").cast("int"),
                    F.col("zone").alias("zone_name"), "borough", "service_zone")
            .orderBy("zone_key"))


def _keyed(df: DataFrame, natural: list[str], name: str, bucket: str, registry: str | None) -> DataFrame:
    if registry is None:
        return surrogate_key(df, natural, name, bucket)
    return registered_keys(df, registry, natural, name, bucket)


def dim_fx(rates: DataFrame, registry: str | None = None) -> DataFrame:
    """One row per trading day, numbered by date; with a ``registry`` table a day keeps its number for good and a
    day published late takes the next one."""
    df = rates.select("date", date_key("date").alias("date_key"), "usd_eur_rate")
    return _keyed(df, ["date"], "fx_key", "year(date)", registry).select(C.DIM_FX.schema.names)


def dim_gdp(gdp: DataFrame, unit: float = 1e12, registry: str | None = None) -> DataFrame:
    """One row per country and year, numbered in that order; ``registry`` as for :func:`dim_fx`."""
    df = gdp.withColumn("gdp_trillion_usd", in_units("gdp_usd", unit))
    return _keyed(df, ["country_code", "year"], "gdp_key", "country_code", registry).select(C.DIM_GDP.schema.names)


def trip_fact(trips: DataFrame, fx: DataFrame, zone: DataFrame, quote: str = "eur_per_usd") -> DataFrame:
    """Day × pickup zone. Rows are reduced to that grain first; the rate and zone lookups then see
    one row per group, so neither a hot zone nor a hot day weighs on a join. Days without a rate
    keep null ``fx_key`` and EUR total."""
    seconds = "unix_seconds(dropoff_datetime) - unix_seconds(pickup_datetime)"
    daily = trips.groupBy(F.expr("to_date(pickup_datetime) AS day"), "pu_location_id").agg(
        F.expr("count(*) AS trip_count"), decimal_sum("fare_amount").alias("fare"), F.expr("count(fare_amount) AS fares"),
        F.expr(f"sum({seconds}) AS seconds"), F.expr(f"count({seconds}) AS timed"),
        decimal_sum("trip_distance").alias("distance"), F.expr("count(trip_distance) AS measured"),
        F.expr("CAST(sum(passenger_count) AS BIGINT) AS total_passengers"))
    daily = daily.select(
        "day", "pu_location_id", "trip_count", "total_passengers", date_key("day").alias("date_key"),
        F.expr("year(day) AS year"), F.expr("CAST(round(fare, 2) AS DOUBLE) AS total_fare_usd"),
        half_up_mean("fare", "fares", 4).alias("avg_fare_usd"),
        half_up_ratio("seconds", "timed * 60", 4).alias("avg_trip_duration_min"),
        half_up_mean("distance", "measured", 4).alias("avg_trip_distance_mi"))
    daily = lookup(daily, fx, "day", "date", ["fx_key", "usd_eur_rate"])
    daily = lookup(daily, zone, "pu_location_id", "location_id", ["zone_key"])
    return (daily.withColumn("total_fare_eur", convert_currency("total_fare_usd", "usd_eur_rate", quote))
            .select(C.TRIP_FACT.schema.names))


def air_fact(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """Day × station × parameter, with the station's name, country and position."""
    daily = readings.groupBy(F.expr("to_date(datetime) AS day"), "location_id", "parameter").agg(
        rounded_avg("value", 4).alias("avg_value"), F.expr("round(max(value), 4) AS max_value"),
        F.expr("round(min(value), 4) AS min_value"), F.expr("count(*) AS measurement_count"))
    daily = daily.select("*", date_key("day").alias("date_key"), F.expr("year(day) AS year"))
    about = stations.selectExpr("location_id", "location_name AS city", "country_name AS country", "latitude", "longitude")
    daily = lookup(daily, about, "location_id", "location_id", ["city", "country", "latitude", "longitude"])
    return daily.select(C.AIR_FACT.schema.names)
