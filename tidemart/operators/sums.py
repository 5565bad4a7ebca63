"""Sums of doubles of any size without error."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a limb; a value reaches into four of them.
BITS = 23
_BASE = 1 << BITS
_GROUP = 99_999  # limb number of values that are no finite numbers


def _scaled(x: str, bits: str) -> str:
    """``x * 2**bits`` in two steps, each within the range of a double."""
    return f"({x} * power(2D, ({bits}) div 2) * power(2D, ({bits}) - ({bits}) div 2))"


def error_free_sums(df: DataFrame, by: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """For each group the sums of SQL expressions, named by the keys of ``sums``, and the number of values of each as ``<name>_count``.

    Every finite double is a whole number of units of some power of two; it is cut, without rounding, into four limbs of 23 bits at fixed
    places, and equal places are added as longs: a hash aggregate whose buffers merge in any order, by group and place. A group's few places
    (92 at most, usually two) meet in one row, where carries are settled and the total is rounded once, to the nearest double. Up to 2**40 rows of a group and
    place fit. The result depends on the values alone, whatever their order, size or signs, and 1e300 - 1e300 + 1e-300 is 1e-300.

    No value gives null; a NaN, or both infinities, give NaN; one infinity gives itself; a total beyond the range gives infinity."""
    pairs = ", ".join(f"named_struct('__f', '{name}', '__x', CAST({expr} AS DOUBLE))" for name, expr in sums.items())
    keys = [f"`{c}`" for c in by]
    rows = df.selectExpr(*keys, f"inline(array({pairs}))")
    odd = "(isnan(__x) OR abs(__x) = double('infinity'))"
    rows = rows.selectExpr(*keys, "__f", "__x", f"CASE WHEN {odd} THEN {_GROUP} WHEN __x IS NULL OR __x = 0 THEN 0 ELSE CAST(floor(log2(abs(__x)) / {BITS}) AS INT) END AS __w")
    rows = rows.selectExpr("*", f"CASE WHEN __x IS NULL OR __w = {_GROUP} THEN 0D ELSE {_scaled('__x', f'-{BITS} * __w')} END AS __3")
    for k in (2, 1, 0):
        rows = rows.selectExpr("*", f"(__{k + 1} - floor(__{k + 1})) * {_BASE}D AS __{k}")
    placed = rows.groupBy(*by, "__f", "__w").agg(
        *[F.expr(f"sum(CAST(floor(__{k}) AS BIGINT))").alias(f"l{k}") for k in (3, 2, 1, 0)], F.count("__x").alias("n"),
        F.count_if(F.isnan("__x")).alias("nan"), F.expr("count_if(__x = double('infinity'))").alias("up"), F.expr("count_if(__x = double('-infinity'))").alias("down"))
    limbs = F.array(*[F.struct((F.col("__w") - (3 - k)).alias("j"), F.col(f"l{k}").alias("v")) for k in (3, 2, 1, 0)])
    groups = placed.groupBy(*by, "__f").agg(F.flatten(F.collect_list(F.when(F.col("__w") != _GROUP, limbs))).alias("ts"),
                                            *[F.sum(c).alias(c) for c in ("n", "nan", "up", "down")])
    # settle carries from the lowest place up; three more places hold what longs can carry over
    carried = ("aggregate({raw}, named_struct('c', 0L, 'd', array(0L)), (a, v) -> named_struct('c', shiftright(a.c + v, 23), 'd', array_append(a.d, (a.c + v) & 8388607L)))")
    groups = (groups.selectExpr("*", "array_min(transform(ts, t -> t.j)) AS lo", "array_max(transform(ts, t -> t.j)) + 3 AS hi")
              .selectExpr("*", "transform(sequence(lo, hi), p -> aggregate(filter(ts, t -> t.j = p), 0L, (a, t) -> a + t.v)) AS raw")
              .selectExpr("*", carried.format(raw="raw") + ".c < 0 AS minus")
              .selectExpr("*", f"{carried.format(raw='if(minus, transform(raw, v -> -v), raw)')}.d AS d")  # d[0] is a stand-in below the lowest place
              .selectExpr("*", "coalesce(array_max(transform(d, (v, k) -> if(v <> 0, k, NULL))), 0) AS top"))
    at = lambda k: f"if(top >= {k}, d[top - {k}], 0L)"
    rest = "CAST(exists(slice(d, 1, greatest(top - 3, 0)), v -> v <> 0) AS BIGINT)"
    whole = (f"CAST(({at(0)} * {_BASE}L + {at(1)}) AS DECIMAL(38,0)) * 140737488355328 + CAST({at(2)} * {2 * _BASE}L + {at(3)} * 2 + {rest} AS DECIMAL(38,0))")
    value = _scaled(f"CAST({whole} AS DOUBLE)", f"{BITS} * (lo - 1 + top - 3) - 1")
    total = f"""CASE WHEN n = 0 THEN NULL WHEN nan > 0 OR (up > 0 AND down > 0) THEN double('NaN') WHEN up > 0 THEN double('infinity')
                     WHEN down > 0 THEN double('-infinity') WHEN top = 0 THEN 0D WHEN minus THEN -{value} ELSE {value} END"""
    done = groups.selectExpr(*keys, "__f", "n", f"{total} AS v")
    out = []
    for name in sums:
        out += [F.expr(f"max(v) FILTER (WHERE __f = '{name}')").alias(name), F.expr(f"max(n) FILTER (WHERE __f = '{name}')").alias(f"{name}_count")]
    return done.groupBy(*by).agg(*out)
