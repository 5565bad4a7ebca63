"""Target schemas, keys and partitioning of the stored tables."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Contract:
    """A stored table. ``keys`` identify a row, ``parts`` are the partition columns."""
    name: str
    ddl: str
    keys: tuple[str, ...]
    parts: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


# Names and types of the stored columns.
TRIPS = Contract("silver_trips", """
    vendor_id BIGINT, pickup_datetime TIMESTAMP, dropoff_datetime TIMESTAMP, passenger_count DOUBLE,
    trip_distance DOUBLE, ratecode_id DOUBLE, store_and_fwd_flag STRING, pu_location_id BIGINT,
    do_location_id BIGINT, payment_type BIGINT, fare_amount DOUBLE, extra DOUBLE, mta_tax DOUBLE,
    tip_amount DOUBLE, tolls_amount DOUBLE, improvement_surcharge DOUBLE, total_amount DOUBLE,
    congestion_surcharge DOUBLE, airport_fee DOUBLE, cbd_congestion_fee DOUBLE, year INT, month INT""",
    ("pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id", "fare_amount"),
    ("year", "month"))
MEASUREMENTS = Contract("silver_measurements", """
    location_id BIGINT, sensors_id BIGINT, location STRING, datetime TIMESTAMP, lat DOUBLE, lon DOUBLE,
    parameter STRING, units STRING, value DOUBLE, year INT, month INT""",
    ("location_id", "parameter", "datetime"), ("year", "month"))
WEATHER = Contract("silver_weather", """
    datetime TIMESTAMP, latitude DOUBLE, longitude DOUBLE, temperature_c DOUBLE, feels_like_c DOUBLE,
    precipitation_mm DOUBLE, wind_speed_kmh DOUBLE, humidity_pct DOUBLE, weather_code BIGINT,
    is_rainy BOOLEAN, year INT, month INT""",
    ("latitude", "longitude", "datetime"), ("year", "month"))
LOCATIONS = Contract("silver_locations", """
    location_id BIGINT, location_name STRING, timezone STRING, country_id STRING, country_name STRING,
    latitude DOUBLE, longitude DOUBLE, datetime_first STRING, datetime_last STRING""", ("location_id",))
GDP = Contract("silver_gdp", "country_code STRING, country_name STRING, year INT, gdp_usd DOUBLE",
               ("country_code", "year"))
FX = Contract("silver_fx_rates", "date DATE, usd_eur_rate DOUBLE", ("date",))
ZONES = Contract("silver_zones", "location_id INT, borough STRING, zone STRING, service_zone STRING",
                 ("location_id",))

DIM_DATE = Contract("dim_date", """
    date_key INT, date DATE, year INT, quarter INT, month INT, month_name STRING, week_of_year INT,
    day_of_month INT, day_of_week INT, day_name STRING, is_weekend BOOLEAN""", ("date_key",))
DIM_ZONE = Contract("dim_zone", """
    zone_key INT, location_id INT, zone_name STRING, borough STRING, service_zone STRING""", ("zone_key",))
DIM_FX = Contract("dim_fx", "fx_key INT, date_key INT, date DATE, usd_eur_rate DOUBLE", ("fx_key",))
DIM_GDP = Contract("dim_gdp", """
    gdp_key INT, country_code STRING, country_name STRING, year INT, gdp_usd DOUBLE,
    gdp_trillion_usd DOUBLE""", ("gdp_key",))
# passengers are counted as a long: an int would overflow in a large day x zone group
TRIP_FACT = Contract("fact_trip_daily", """
    date_key INT, zone_key INT, fx_key INT, trip_count BIGINT, total_fare_usd DOUBLE,
    total_fare_eur DOUBLE, avg_fare_usd DOUBLE, avg_trip_duration_min DOUBLE,
    avg_trip_distance_mi DOUBLE, total_passengers BIGINT, year INT""", ("date_key", "zone_key"), ("year",))
AIR_FACT = Contract("fact_measure_daily", """
    date_key INT, location_id BIGINT, city STRING, country STRING, latitude DOUBLE, longitude DOUBLE,
    parameter STRING, avg_value DOUBLE, max_value DOUBLE, min_value DOUBLE, measurement_count BIGINT,
    year INT""", ("date_key", "location_id", "parameter"), ("year",))
