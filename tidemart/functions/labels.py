"""Text and band columns for report cards."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper limits used for banding pollutant means, and the label formats.
LIMITS = {"pm25": 15.0, "no2": 25.0, "o3": 100.0}
UP, DOWN = "▲ +", "▼ "


def yoy_label(change: Column | str, year: Column | str) -> Column:
    """``▲ +x.x% vs y-1`` or ``▼ -x.x% vs y-1``; null when either input is null."""
    change, year = (F.col(c) if isinstance(c, str) else c for c in (change, year))
    mark = F.when(change >= 0, F.lit(UP)).otherwise(F.lit(DOWN))
    pct = F.format_string("%.1f%%", change * 100)
    text = F.concat(mark, pct, F.lit(" vs "), (year - 1).cast("string"))
    return F.when(change.isNotNull() & year.isNotNull(), text)


def band(value: Column | str, limit: Column | float, warn_share: float = 0.8) -> Column:
    """green below ``warn_share`` of the limit, yellow up to the limit, red above it."""
    value = F.col(value) if isinstance(value, str) else value
    limit = limit if isinstance(limit, Column) else F.lit(float(limit))
    return (F.when(value > limit, F.lit("red"))
            .when(value > limit * warn_share, F.lit("yellow"))
            .when(value.isNotNull(), F.lit("green")))


def limit_of(parameter: Column | str, limits: dict[str, float] = LIMITS) -> Column:
    parameter = F.col(parameter) if isinstance(parameter, str) else parameter
    pairs = [F.lit(x) for k, v in limits.items() for x in (k, float(v))]
    return F.try_element_at(F.create_map(*pairs), parameter)
