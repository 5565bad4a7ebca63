"""Quality suites of the stored tables.

Fixed values: the checks, their limits, sets and minimum row counts. ``scale`` shrinks the row
counts for smaller data."""
from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemart.functions.units import POLLUTANTS
from tidemart.operators.quality import (Check, foreign_key, in_range, in_set, min_rows, not_null,
                                        run_suites, suite_results, unique)

BOROUGHS = ["Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island", "EWR", "Unknown", "N/A"]
SERVICE_ZONES = ["Yellow Zone", "Boro Zone", "Airports", "EWR", "N/A"]


def checks(scale: float = 1.0) -> dict[str, list[Check]]:
    rows = lambda n: min_rows(max(1, int(n * scale)))
    small = {"wording": "rows"}
    between = lambda c, lo, hi: in_range(c, lo, hi, name=f"{c} in [{lo}, {hi}]", **small)
    rate = in_range("usd_eur_rate", 0, 5, strict_min=True, name="usd_eur_rate in (0, 5]", **small)
    gdp = in_range("gdp_usd", 0, strict_min=True, name="gdp_usd > 0", **small)
    return {
        "silver_trips": [
            not_null("pickup_datetime"), not_null("pu_location_id"), not_null("do_location_id"),
            not_null("fare_amount"), in_range("trip_distance", 0.01, 100), in_range("fare_amount", 0.01, 10000),
            in_set("payment_type", [0, 1, 2, 3, 4, 5, 6]), rows(100_000_000)],
        "silver_measurements": [
            not_null("datetime"), not_null("parameter"), not_null("value"), in_range("value", 0),
            in_set("parameter", POLLUTANTS), rows(100_000)],
        "silver_locations": [
            not_null("location_id", **small), not_null("country_id", **small),
            between("latitude", -90, 90), between("longitude", -180, 180), unique("location_id")],
        "silver_gdp": [not_null("country_code", **small), gdp, between("year", 1960, 2030)],
        "silver_fx_rates": [not_null("date", **small), unique("date"), rate],
        "silver_weather": [
            not_null("datetime", **small), between("temperature_c", -30, 50),
            between("precipitation_mm", 0, 200), between("wind_speed_kmh", 0, 200),
            between("humidity_pct", 0, 100), between("weather_code", 0, 99)],
        "dim_date": [unique("date_key"), not_null("date", **small), between("month", 1, 12),
                     between("day_of_week", 1, 7)],
        "dim_zone": [unique("zone_key"), not_null("location_id", **small),
                     in_set("borough", BOROUGHS, name="borough in expected set", **small),
                     in_set("service_zone", SERVICE_ZONES, name="service_zone in expected set", **small)],
        "dim_fx": [unique("fx_key"), unique("date"), rate],
        "dim_gdp": [unique("gdp_key"), gdp],
        "fact_trip_daily": [
            not_null("date_key"), not_null("zone_key"), in_range("trip_count", 0),
            in_range("total_fare_usd", 0), foreign_key("date_key", "dim_date", "date_key"),
            foreign_key("zone_key", "dim_zone", "zone_key"), rows(100_000)],
        "fact_measure_daily": [
            not_null("date_key"), not_null("location_id"), not_null("parameter"), in_range("avg_value", 0),
            foreign_key("date_key", "dim_date", "date_key"), rows(1_000)],
    }


def table_suites(tables: Mapping[str, Callable[[], DataFrame]],
                 scale: float = 1.0) -> dict[str, Callable[[], DataFrame]]:
    """One deferred results frame per suite; opening a missing table fails inside the suite."""
    parents = ("dim_date", "dim_zone")

    def make(name: str, suite: list[Check]) -> Callable[[], DataFrame]:
        def results() -> DataFrame:
            needs = [p for p in parents if any(f"-> {p}." in c.name for c in suite)]
            return suite_results(tables[name](), name, suite, {p: tables[p]() for p in needs})
        return results

    return {name: make(name, suite) for name, suite in checks(scale).items()}


def run_all(spark: SparkSession, database: str, scale: float = 1.0) -> DataFrame:
    names = checks(scale)
    return run_suites(spark, table_suites(
        {n: (lambda n=n: spark.table(f"{database}.{n}")) for n in names}, scale))
