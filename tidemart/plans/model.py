"""The star model as data: tables, N:1 relationships, role rules, and what a filter does to facts."""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.operators.clean import role_predicate
from tidemart.operators.joins import lookup, restrict
from tidemart.operators.measures import (Measure, additive, filtered_max, filtered_mean, join_on,
                                         mean_of_means)


@dataclass(frozen=True)
class Relationship:
    fact: str
    fact_key: str
    dim: str
    dim_key: str


# Relationships, role rules and measures of the report model. GDP has no relationship.
RELATIONSHIPS = (
    Relationship("trips", "date_key", "date", "date_key"),
    Relationship("trips", "fx_key", "fx", "fx_key"),
    Relationship("trips", "zone_key", "zone", "zone_key"),
    Relationship("air", "date_key", "date", "date_key"),
)
ROLES: Mapping[str, Mapping[str, Mapping[str, str]]] = {
    "Admin": {},
    "Airports Operator": {"zone": {"service_zone": "Airports"}},
    "EWR Operator": {"zone": {"service_zone": "EWR"}},
    "Green Cab Dispatcher": {"zone": {"service_zone": "Boro Zone"}},
    "Yellow Cab Dispatcher": {"zone": {"service_zone": "Yellow Zone"}},
}
MEASURES = {m.name: m for m in (
    additive("total_trips", "trips", "trip_count"),
    additive("total_revenue_usd", "trips", "total_fare_usd", 2),
    additive("total_revenue_eur", "trips", "total_fare_eur", 2),
    mean_of_means("avg_fare_usd", "trips", "avg_fare_usd"),
    mean_of_means("avg_trip_distance_mi", "trips", "avg_trip_distance_mi"),
    mean_of_means("avg_trip_duration_min", "trips", "avg_trip_duration_min"),
    filtered_mean("avg_pm25", "air", "avg_value", "parameter", "pm25"),
    filtered_mean("avg_no2", "air", "avg_value", "parameter", "no2"),
    filtered_mean("avg_o3", "air", "avg_value", "parameter", "o3"),
    mean_of_means("avg_fx_rate", "fx", "usd_eur_rate"),
    filtered_max("usa_gdp_usd", "gdp", "gdp_usd", "country_code", "US"),
)}


class Tables(Mapping):
    """Named frames, each opened on first use: a measure over one fact does not plan the other."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame] | DataFrame]):
        self._makers, self._open = dict(makers), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            made = self._makers[name]
            self._open[name] = made if isinstance(made, DataFrame) else made()
        return self._open[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)

    def replaced(self, **others: Callable[[], DataFrame] | DataFrame) -> "Tables":
        kept = {n: (lambda n=n: self[n]) for n in self._makers if n not in others}
        return Tables({**kept, **others})


@dataclass(frozen=True)
class Model:
    tables: Mapping[str, DataFrame]
    relationships: Sequence[Relationship] = RELATIONSHIPS
    roles: Mapping[str, Mapping[str, Mapping[str, str]]] = field(default_factory=lambda: ROLES)
    measures: Mapping[str, Measure] = field(default_factory=lambda: MEASURES)

    def __post_init__(self):
        if not isinstance(self.tables, Tables):
            object.__setattr__(self, "tables", Tables(self.tables))

    def flat(self, fact: str, take: Mapping[str, Sequence[str]]) -> DataFrame:
        """The fact with columns of related dimensions: ``{"zone": ["borough"]}``. Unmatched facts
        keep nulls. Columns are renamed ``<dim>_<column>`` only when the fact already has the name."""
        df = self.tables[fact]
        for rel in self.relationships:
            cols = take.get(rel.dim) if rel.fact == fact else None
            if cols:
                dim = self.tables[rel.dim]
                clash = {c: f"{rel.dim}_{c}" for c in cols if c in df.columns}
                key = rel.dim_key
                dim = dim.select(F.col(key).alias("__dim"), *[F.col(c).alias(clash.get(c, c)) for c in cols])
                df = lookup(df, dim, rel.fact_key, "__dim", [clash.get(c, c) for c in cols])
        return df

    def where(self, dim: str, cond: Column) -> "Model":
        """Filter a dimension; facts related to it follow by semi-join, others stay untouched."""
        kept = self.tables[dim].where(cond)
        seen = {dim: kept}
        for rel in self.relationships:
            if rel.dim == dim:
                seen[rel.fact] = lambda rel=rel: restrict(self.tables[rel.fact], rel.fact_key, kept, rel.dim_key)
        return replace(self, tables=self.tables.replaced(**seen))


    def as_role(self, role: str) -> "Model":
        """What a member of the role sees."""
        model = self
        for dim, rules in self.roles[role].items():
            model = model.where(dim, role_predicate(rules))
        return model

    def evaluate(self, names: Sequence[str], by: Sequence[tuple[str, str]] = (), how: str = "outer") -> DataFrame:
        """Measures grouped by dimension columns given as ``(dim, column)``.

        Each fact is aggregated by itself and only the aggregates meet, so two facts are never
        joined row by row. ``how="inner"`` keeps groups present in every fact."""
        wanted = [self.measures[n] for n in names]
        cols = [c for _, c in by]
        frames = []
        for table in dict.fromkeys(m.table for m in wanted):
            dims: dict[str, list[str]] = {}
            for dim, col in by:
                dims.setdefault(dim, []).append(col)
            own = dims.pop(table, [])
            have = set(self.tables[table].columns)
            df = self.flat(table, dims)
            keys = [F.col(f"{d}_{c}" if c in have else c).alias(c) for d, c in by if c not in own]
            keys = [F.col(c) for c in own] + keys
            frames.append(df.groupBy(*keys).agg(*[m.expr().alias(m.name) for m in wanted if m.table == table]))
        return join_on(frames, cols, how).select(*cols, *names)
