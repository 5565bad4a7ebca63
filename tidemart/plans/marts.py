"""Report pages as named frames over the star model."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.dates import year_of_key
from tidemart.functions.exact import exact_avg
from tidemart.functions.labels import LIMITS, band, limit_of
from tidemart.operators.clean import first_per_key
from tidemart.operators.measures import pearson, ratio_percent, year_over_year
from tidemart.operators.timeseries import window_rollup
from tidemart.plans.model import Model

YEAR = ("date", "year")
KPIS = ("total_trips", "total_revenue_usd", "total_revenue_eur", "avg_fare_usd")
POLLUTANT_MEANS = {"avg_pm25": "pm25", "avg_no2": "no2", "avg_o3": "o3"}


def mobility_by_year(model: Model, measures: Sequence[str] = ("total_trips", "total_revenue_usd", "avg_fare_usd"),
                     slicer: Column | None = None, all_dates_before: bool = False) -> DataFrame:
    """Yearly measures with change and label. ``slicer`` filters the date dimension. By default the
    previous year is sliced the same way; ``all_dates_before=True`` compares with the whole previous
    year, as the report model does when a month is selected."""
    shown = model.where("date", slicer) if slicer is not None else model
    current = shown.evaluate(list(measures), [YEAR]).where("year IS NOT NULL")
    prior = None
    if all_dates_before and slicer is not None:
        prior = model.evaluate(list(measures), [YEAR]).where("year IS NOT NULL")
    return year_over_year(current, measures, prior=prior, labels=True)


def trips_per_day(model: Model) -> DataFrame:
    return model.evaluate(["total_trips"], [("date", "date")]).where("date IS NOT NULL")


def top_zones(model: Model, n: int = 10) -> DataFrame:
    """The ``n`` busiest pickup zones; equal counts are ordered by name."""
    df = model.evaluate(["total_trips"], [("zone", "zone_name")]).where("zone_name IS NOT NULL")
    return df.orderBy(F.col("total_trips").desc(), "zone_name").limit(n)


def sliced(model: Model, slicer: Column | None) -> Model:
    """The model under a filter on the date dimension, such as one year of a page's slicer."""
    return model if slicer is None else model.where("date", slicer)


def pollutant_cards(model: Model, limits: dict[str, float] = LIMITS, warn_share: float = 0.8, slicer: Column | None = None) -> DataFrame:
    """Mean per pollutant with its limit and band."""
    air = sliced(model, slicer).tables["air"].where(F.col("parameter").isin(list(limits)))
    df = air.groupBy("parameter").agg(exact_avg("avg_value").alias("mean_value"))
    df = df.withColumn("limit_value", limit_of("parameter", limits))
    return df.withColumn("band", band("mean_value", F.col("limit_value"), warn_share))


def pollutant_trend(model: Model, names: Sequence[str] = tuple(POLLUTANT_MEANS),
                    limits: dict[str, float] = LIMITS, slicer: Column | None = None) -> DataFrame:
    """Daily means side by side, with the limits as constant columns."""
    df = sliced(model, slicer).evaluate(list(names), [("date", "date")]).where("date IS NOT NULL")
    return df.withColumns({f"limit_{p}": F.lit(float(v)) for p, v in limits.items()})


def station_map(model: Model, parameter: str = "pm25", slicer: Column | None = None) -> DataFrame:
    """Mean of one pollutant per station with its position. Of several names of a station the last in the alphabet is shown; the
    mean and the names are hash aggregates, and only the names, a few a station, are ranked."""
    air = sliced(model, slicer).tables["air"].where(F.col("parameter") == parameter)
    means = air.groupBy("location_id").agg(F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude"), exact_avg("avg_value").alias("mean_value"))
    names = first_per_key(air.select("location_id", "city").distinct(), ["location_id"], ["city DESC NULLS LAST"])
    named = means.alias("m").join(names.alias("n"), F.expr("m.location_id <=> n.location_id"))
    return named.select("m.location_id", "n.city", "latitude", "longitude", "mean_value")


def top_stations(model: Model, parameter: str = "pm25", n: int = 10, slicer: Column | None = None) -> DataFrame:
    return station_map(model, parameter, slicer).orderBy(F.col("mean_value").desc(), "location_id").limit(n)


def monthly_combo(model: Model, names: Sequence[str] = tuple(POLLUTANT_MEANS), slicer: Column | None = None) -> DataFrame:
    """Monthly trips beside the pollutant means; months present in both facts."""
    return (sliced(model, slicer).evaluate(["total_trips", *names], [YEAR, ("date", "month")], how="inner")
            .where("year IS NOT NULL"))


def daily_pairs(model: Model, x: str, ys: Sequence[str]) -> DataFrame:
    """Both facts reduced to days, then joined on the day."""
    return model.evaluate([x, *ys], [("date", "date_key")], how="inner").where("date_key IS NOT NULL")


def correlations(model: Model, ys: Sequence[str] = tuple(POLLUTANT_MEANS), x: str = "total_trips",
                 year: int | None = None) -> DataFrame:
    """Pearson r of daily trips with each pollutant mean, for all days or one year."""
    if year is not None:
        model = model.where("date", F.col("year") == year)
    days = daily_pairs(model, x, ys)
    wide = days.agg(*[pearson(x, y).alias(y) for y in ys])
    return wide.unpivot([], list(ys), "measure", "r")


def revenue_by_year(model: Model, slicer: Column | None = None) -> DataFrame:
    return sliced(model, slicer).evaluate(["total_revenue_usd", "total_revenue_eur"], [YEAR]).where("year IS NOT NULL")


def gdp_of(model: Model, country: str, year: int | None = None) -> DataFrame:
    """Yearly GDP of one country; with ``year`` only that year, otherwise every stored year."""
    gdp = model.tables["gdp"].where(F.col("country_code") == country)
    if year is not None:
        gdp = gdp.where(F.col("year") == year)
    return gdp.groupBy("year").agg(F.max("gdp_usd").alias("gdp_usd"))


def selected_gdp(gdp: DataFrame, country: str, gdp_year: int | None = None,
                 date_year: int | None = None) -> DataFrame:
    """GDP card: the year chosen on GDP, else the year chosen on dates, else the best year."""
    chosen = gdp_year if gdp_year is not None else date_year
    rows = gdp.where(F.col("country_code") == country)
    if chosen is not None:
        rows = rows.where(F.col("year") == chosen)
    return rows.agg(F.max("gdp_usd").alias("gdp_usd"))


def revenue_share_of_gdp(model: Model, country: str = "US") -> DataFrame:
    """Revenue as percent of one country's GDP of the same year; null without GDP."""
    revenue = model.evaluate(["total_revenue_usd"], [YEAR]).where("year IS NOT NULL")
    df = revenue.join(gdp_of(model, country), "year", "left")
    return df.withColumn("revenue_pct_gdp", ratio_percent("total_revenue_usd", "gdp_usd"))


def fx_trend(model: Model) -> DataFrame:
    return model.tables["fx"].select("date", "usd_eur_rate")


def fx_by_year(model: Model) -> DataFrame:
    fx = model.tables["fx"].withColumn("year", year_of_key("date_key"))
    return fx.groupBy("year").agg(exact_avg("usd_eur_rate").alias("avg_fx_rate"))


# The weather panels and how each field is rolled up.
PANELS = (("temperature", ("temperature_c", "feels_like_c"), "mean"), ("precipitation", ("precipitation_mm",), "sum"),
          ("wind", ("wind_speed_kmh",), "mean"), ("humidity", ("humidity_pct",), "mean"))


def weather_panels(weather: DataFrame, every: str = "1 hour", start=None, stop=None,
                   time_col: str = "datetime") -> DataFrame:
    """All panels as ``(panel, time, field, value)``; one scan per rollup function."""
    out = None
    for fn in ("mean", "sum"):
        fields = [f for _, fs, how in PANELS if how == fn for f in fs]
        part = window_rollup(weather, time_col, every, fields, fn, start, stop)
        out = part if out is None else out.unionByName(part)
    pairs = [F.lit(v) for panel, fs, _ in PANELS for f in fs for v in (f, panel)]
    return out.select(F.element_at(F.create_map(*pairs), F.col("field")).alias("panel"), "time", "field", "value")
