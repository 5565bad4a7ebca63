"""Unit conversion of gas readings and display scaling."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Gas factors from ppm to µg/m³, the pollutant names kept, the unit names.
PPM_TO_UGM3 = {"no2": 1882, "o3": 1962, "co": 1145, "no": 1227, "nox": 1882, "so2": 2619}
POLLUTANTS = ("pm25", "pm10", "pm1", "no2", "o3", "co", "so2", "no", "nox")
PPM = "ppm"
UGM3 = "µg/m³"


def _factor(parameter: Column, factors: Mapping[str, float]) -> Column:
    pairs = [F.lit(x) for k, v in factors.items() for x in (k, float(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), parameter), F.lit(1.0))


def convert_value(value: Column | str = "value", units: Column | str = "units",
                  parameter: Column | str = "parameter",
                  factors: Mapping[str, float] = PPM_TO_UGM3, from_unit: str = PPM) -> Column:
    """Readings in ``from_unit`` times their gas factor; others, and gases without a factor, as is."""
    value, units, parameter = (F.col(c) if isinstance(c, str) else c for c in (value, units, parameter))
    return F.when(units == from_unit, value * _factor(parameter, factors)).otherwise(value)


def relabel_units(units: Column | str = "units", from_unit: str = PPM, to_unit: str = UGM3) -> Column:
    """Every ``from_unit`` row gets the new label, also where no factor applies."""
    units = F.col(units) if isinstance(units, str) else units
    return F.when(units == from_unit, F.lit(to_unit)).otherwise(units)


def in_units(c: Column | str, unit: float = 1e12, digits: int = 4) -> Column:
    """Large amounts for display, by default in trillions with four decimals."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c / unit, digits)


def convert_currency(amount: Column | str, rate: Column | str, quote: str = "eur_per_usd") -> Column:
    """Rounded amount in the other currency; a missing rate gives null.

    ``quote`` says how the rate is read: ``eur_per_usd`` multiplies (default), ``usd_per_eur`` divides.
    Cents times a rate of a few decimals often ends in an exact half cent, so the product is formed
    in decimals and rounded half up there."""
    amount, rate = (F.col(c) if isinstance(c, str) else c for c in (amount, rate))
    a, r = amount.cast("decimal(22,2)"), rate.cast("decimal(12,6)")
    if quote == "eur_per_usd":
        return F.round(a * r, 2).cast("double")
    if quote == "usd_per_eur":
        return F.round(F.try_divide(a, r), 2).cast("double")
    raise ValueError(f"unknown quote {quote!r}")
