"""Sharding by a minimax contiguous partition of ordered atomic groups.

Rows with equal texts form one group and stay together. The groups stand in the order of their digests;
the smallest capacity for which a greedy left-to-right cut needs no more than the wanted shards is found by
binary search, and the groups are cut under that capacity, near even shares. A group above an even share takes a shard of its own (it sets
the largest size in any case), so the others stay near equal among themselves.

The greedy check never walks over the groups. It looks up where the running size passes a target, in a grid
of running sizes that the driver holds: per cell the first and the last group end. A target inside a cell leaves an
interval; only if the intervals of a whole walk leave the answer open, one Spark job splits the touched cells again.
The driver thus holds a few thousand numbers for each split, however many groups there are.

Defined cases: a null text counts as empty and is grouped with empty texts; null or repeated ids are kept as rows of
their own; an empty table gives no rows; fewer groups than shards leave shards empty; other columns are ignored.
"""
from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import stored

#: Rows in which a shard's slots are numbered apart, and digest ranges in which sizes are summed apart.
SALTS, RANGES = 64, 4096
#: Cells into which a range of running sizes is split at a time.
CELLS = 4096


class Grid:
    """Group ends as running sizes, at the resolution that was asked for so far."""

    def __init__(self, ends: DataFrame, total: int):
        self.ends, self.total = ends, total
        self.cells = self._read([(0, total)])

    def _read(self, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """(first end, last end) of each non-empty cell of the spans ``(low, high]``."""
        cell = F.lit(None).cast("long")
        for k, (low, high) in enumerate(spans):
            width = max(1, -(-(high - low) // CELLS))
            cell = F.when((F.col("end") > low) & (F.col("end") <= high),
                          F.lit(k * CELLS) + F.expr(f"(end - {low} - 1) div {width}")).otherwise(cell)
        rows = (self.ends.select("end", cell.alias("cell")).filter("cell IS NOT NULL").groupBy("cell")
                .agg(F.min("end").alias("a"), F.max("end").alias("b")).select("a", "b").collect())
        return sorted((r.a, r.b) for r in rows)

    def split(self, touched: set[tuple[int, int]]) -> None:
        fresh = self._read([(a - 1, b) for a, b in sorted(touched)])
        self.cells = sorted([c for c in self.cells if c not in touched] + fresh)

    def reach(self, target: int) -> tuple[int, int, tuple[int, int] | None]:
        """Bounds of the last group end at or below ``target``, and the cell to split if they differ."""
        k = bisect_right(self.cells, (target, float("inf"))) - 1
        if k < 0:
            return 0, 0, None
        a, b = self.cells[k]
        return (b, b, None) if b <= target else (a, target, (a, b))

    def walk(self, capacity: int, shards: int) -> tuple[bool | None, list[int], set[tuple[int, int]]]:
        """Greedy cuts under ``capacity``: whether they suffice (None: open), the cuts, the cells left open."""
        low = high = 0
        cuts, touched = [], set()
        for _ in range(shards):
            low, _, cell = self.reach(low + capacity)
            _, high, other = self.reach(high + capacity)
            touched |= {c for c in (cell, other) if c}
            cuts.append(low)
        if not touched:
            return low >= self.total, cuts, touched
        return (True if low >= self.total else False if high < self.total else None), cuts, touched

    def decide(self, capacity: int, shards: int) -> bool:
        while (said := self.walk(capacity, shards))[0] is None:
            self.split(said[2])
        return said[0]

    def reach_up(self, target: int) -> tuple[int, tuple[int, int] | None]:
        """The first group end at or above ``target``, and the cell to split if it isn't known yet."""
        a, b = self.cells[bisect_right(self.cells, target - 1, key=lambda c: c[1])]
        return (a, None) if a >= target else (b, (a, b))

    def cuts(self, capacity: int, shards: int) -> list[int]:
        """Cuts that keep to ``capacity``, each as near below its even share as that allows.

        A walk from the right gives the leftmost cuts from which the capacity still suffices; the walk from the
        left then takes the even share where it may."""
        while True:
            touched, least = set(), [self.total]
            for _ in range(shards - 1):
                up, cell = self.reach_up(max(1, least[-1] - capacity)) if least[-1] > capacity else (0, None)
                least.append(up)
                touched |= {cell} if cell else set()
            cuts, at = [], 0
            for k, floor in enumerate(reversed(least), 1):
                at, _, cell = self.reach(min(at + capacity, max(floor, self.total * k // shards)))
                cuts.append(at)
                touched |= {cell} if cell else set()
            if not touched:
                return cuts
            self.split(touched)


def smallest_capacity(grid: Grid, shards: int, largest: int) -> int:
    low = max(-(-grid.total // shards), largest)
    high = low + largest
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if grid.decide(mid, shards) else (mid + 1, high)
    return low


def oversized(groups: DataFrame, shards: int) -> list:
    """Groups above an even share of what is left, each to get a shard of its own; fewer than ``shards`` rows."""
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    top = groups.filter(F.col("bytes") > total / shards).orderBy(F.desc("bytes"), "key").collect()
    alone: list = []
    while len(alone) < shards - 1:
        left, rest = total - sum(r.bytes for r in alone), shards - len(alone)
        after = groups.filter((F.col("bytes") > left / rest)).orderBy(F.desc("bytes"), "key").limit(shards).collect() if alone else top
        fresh = [r for r in after if r.key not in {x.key for x in alone}][: shards - 1 - len(alone)]
        if not fresh:
            break
        alone += fresh
    return alone


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", per_row: int = 16) -> DataFrame:
    """Columns: the id, size, text_crc32, shard, slot. ``size`` is the text's UTF-8 bytes plus ``per_row``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + per_row).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("key")), "shard-rows")
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("bytes"))
                    .withColumn("range", F.pmod(F.xxhash64("key"), F.lit(RANGES))), "shard-groups")
    alone = oversized(groups, shards)
    keys = [bytes(r.key) for r in alone]
    rest = groups.filter(~F.col("key").isin(keys)) if keys else groups
    by_range = rest.groupBy("range").agg(F.sum("bytes").alias("sum"))
    before = by_range.select("range", (F.sum("sum").over(Window.orderBy("range")) - F.col("sum")).alias("before"))
    running = F.sum("bytes").over(Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    ends = stored(rest.withColumn("end", running).join(F.broadcast(before), "range")  # RANGES rows
                  .select("key", (F.col("end") + F.col("before")).alias("end")), "shard-ends")
    total, largest = rest.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.max("bytes"), F.lit(0))).first()
    cuts: list[int] = []
    left = shards - len(alone)
    if total:
        grid = Grid(ends, total)
        cuts = grid.cuts(smallest_capacity(grid, left, largest), left)
    cut_list = F.array(*[F.lit(c).cast("long") for c in cuts])
    placed = ends.select("key", (F.size(F.filter(cut_list, lambda c: c < F.col("end"))) + len(alone)).cast("int").alias("shard"))
    if alone:
        spark = docs.sparkSession
        placed = placed.unionByName(spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key binary, shard int"))
    out = stored(rows.join(placed, "key").select("id", "size", "text_crc32", "shard",
                 F.floor(F.rand(11) * SALTS).alias("salt")), "shard-placed")  # drawn once, as it is stored; rows that repeat id and text are dealt too
    cells = out.groupBy("shard", "salt").agg(F.count(F.lit(1)).alias("n"))
    first = cells.select("shard", "salt", (F.sum("n").over(Window.partitionBy("shard").orderBy("salt")) - F.col("n")).alias("first"))
    number = F.row_number().over(Window.partitionBy("shard", "salt").orderBy("id", "text_crc32")) - 1
    return (out.withColumn("at", number).join(F.broadcast(first), ["shard", "salt"])  # shards x SALTS rows
            .select(F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("at") + F.col("first")).cast("long").alias("slot")))
