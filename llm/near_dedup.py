"""Near-duplicates by MinHash with tensored tables, confirmed on full shingle sets.

Two collections of COLLECTION half keys, each of HALF minhashes, are computed for a document; a table's key is a pair of one
half from each. COLLECTION**2 tables of 2 * HALF minhashes thus cost 2 * COLLECTION * HALF minhashes instead of COLLECTION times as
many. At a similarity of 0.85 a pair shares no table with a probability of 2e-5. Halves that no second document has can't make a shared
key, so only pairs of shared halves are formed.

Equal shingle sets are one class with one representative. In each table key all members are compared with the one that shares most keys with others (a star,
no pairs among members). What those links leave in several components is settled exactly by a prefix filter over these documents
alone: two linked sets share one of their rarest shingles, at a position that still allows the overlap; pairs within
a component are skipped. Every link is confirmed by the exact overlap of the two full sets.

Defined cases: a null or empty text and one of white space has an empty set and is its own class; fewer words than a shingle
make one shingle of all; rows that repeat an id are compared each with its own text; null ids are compared too, count as the
largest id and come back as null; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import stored
from llm.encoding import batches, release

WORDS, COLLECTION, HALF = 5, 12, 3
HASHES = 2 * COLLECTION * HALF
#: Minhashes of HASHES that must agree before full sets are compared: at a similarity of 0.8 fewer do with a probability below 1e-5, at 0.85 1e-8.
AGREE = 43
#: Stands for a null document id, so that it compares as the largest.
NO_ID = 2**63 - 1

_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_P = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    have, step = 1, np.uint64(base)
    while have < n:
        m = min(have, n - have)
        out[have:have + m] = out[:m] * step
        have += m
        step = np.uint64(int(step) ** 2 % 2**64)
    return out


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    raw = [(t or "").encode("utf-8", "surrogatepass") + b" " for t in texts]
    b = _LOW[np.frombuffer(b"".join(raw), np.uint8)]
    space = _SPACE[b]
    start = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    end = np.flatnonzero(space & np.concatenate([[False], ~space[:-1]]))
    # polynomial hash of each word, anchored at its first byte: each byte is mixed first, and the length goes in
    length = (end - start).astype(np.int64)
    if not len(start):
        return [np.empty(0, np.uint64) for _ in texts]
    mark = np.zeros(len(b), np.int64)
    mark[start] = 1
    inside = np.maximum(np.arange(len(b)) - start[np.maximum(np.cumsum(mark) - 1, 0)], 0)
    values = _mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _P)[b]
    values[space] = 0
    most = int(length.max())
    values *= _powers(most + 1, 0xD6E8FEB86659FD93)[np.minimum(inside, most)]
    word = _mix(np.add.reduceat(values, start) + length.astype(np.uint64) * _P)
    ends = np.cumsum([len(r) for r in raw])
    first = np.searchsorted(start, np.concatenate([[0], ends]))
    out = []
    if len(word) >= words:
        roll = np.zeros(len(word) - words + 1, np.uint64)
        for k in range(words):
            roll = _mix(roll * _P + word[k:len(word) - words + 1 + k] + np.uint64(k + 1))
    for a, z in zip(first[:-1], first[1:]):
        if z - a >= words:
            out.append(np.unique(roll[a:z - words + 1]))
        elif z > a:
            h = np.zeros(1, np.uint64)
            for w in word[a:z]:
                h = _mix(h * _P + w)
            out.append(h + np.uint64(z - a))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _multipliers() -> np.ndarray:
    return _mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minhashes (32 bits) of non-empty sets: sets x HASHES."""
    flat = np.concatenate(sets)
    begin = np.concatenate([[0], np.cumsum([len(s) for s in sets])])[:-1]
    out = np.empty((len(sets), HASHES), np.uint32)
    for k, m in enumerate(_multipliers()):
        x = flat * m
        x ^= x >> np.uint64(32)
        out[:, k] = np.minimum.reduceat((x * m >> np.uint64(32)).astype(np.uint32), begin)
    return out


def digest(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.col(text_col).alias("text"))


def describe(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, text_key, n, id (the digest of the set), low (the low byte of each minhash), a and b (the half keys)."""
    def run(it):
        release()
        for batch in it:
            for part in batches([batch], "text"):
                sets = shingle_sets(part.column("text").to_pylist())
                full = [k for k, s in enumerate(sets) if len(s)]
                sig = signatures([sets[k] for k in full]) if full else np.empty((0, HASHES), np.uint32)
                halves = np.zeros((len(full), 2 * COLLECTION), np.uint64)
                for h in range(HALF):
                    halves = _mix(halves * _P + sig[:, h::HALF] + np.uint64(1))
                halves = halves.view(np.int64)
                low, place = (sig & 255).astype(np.uint8), {k: i for i, k in enumerate(full)}
                yield pa.RecordBatch.from_arrays([
                    part.column("doc"), part.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(map(digest, sets), pa.binary()),
                    pa.array([low[place[k]].tobytes() if k in place else None for k in range(len(sets))], pa.binary()),
                    pa.array([halves[place[k], :COLLECTION] if k in place else None for k in range(len(sets))], pa.list_(pa.int64())),
                    pa.array([halves[place[k], COLLECTION:] if k in place else None for k in range(len(sets))], pa.list_(pa.int64()))],
                    ["doc", "text_key", "n", "id", "low", "a", "b"])
    rows = named(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    return stored(rows.mapInArrow(run, "doc long, text_key long, n long, id binary, low binary, a array<long>, b array<long>"), "dedup-signatures")


def table_keys(reps: DataFrame) -> DataFrame:
    """(key, id, c: members) of all tables that at least two representatives share a key of."""
    def shared(col: str) -> DataFrame:
        halves = stored(reps.select("id", F.posexplode(col).alias("t", "h")), f"dedup-{col}")
        several = halves.groupBy("t", "h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("t", "h")
        return halves.join(several, ["t", "h"]).groupBy("id").agg(F.collect_list(F.struct("t", "h")).alias(col))
    pairs = shared("a").join(shared("b"), "id").select("id", F.explode("a").alias("x"), "b").select("id", "x", F.explode("b").alias("y"))
    keys = stored(pairs.select(F.xxhash64("x.t", "x.h", "y.t", "y.h").alias("key"), "id"), "dedup-keys")
    several = keys.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    return stored(keys.join(several, "key"), "dedup-tables")


def stars(tables: DataFrame) -> DataFrame:
    """(center, id): in each key the member that meets most others over all tables is the center of all."""
    weight = tables.groupBy("id").agg(F.sum("c").alias("w"))
    ranked = stored(tables.select("key", "id").join(weight, "id"), "dedup-weights")
    center = ranked.groupBy("key").agg(F.max_by("id", F.struct("w", "id")).alias("center"))
    return ranked.join(center, "key").filter("id <> center").select("center", "id").distinct()


@F.pandas_udf(T.IntegerType())
def agreeing(x, y):
    import pandas as pd

    if not len(x):
        return pd.Series([], dtype="int32")
    a, b = (np.frombuffer(b"".join(s), np.uint8).reshape(-1, HASHES) for s in (x, y))
    return pd.Series((a == b).sum(1).astype("int32"))


@F.pandas_udf(T.LongType())
def overlap(x, y):
    import pandas as pd

    return pd.Series([len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True)) for a, b in zip(x, y)], dtype="int64")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (x, y) whose full sets reach the similarity in hundredths."""
    both = (pairs.join(sets.select(F.col("id").alias("x"), F.col("s").alias("sx")), "x")
            .join(sets.select(F.col("id").alias("y"), F.col("s").alias("sy")), "y"))
    n = lambda c: F.octet_length(c) / 8
    return (both.filter((F.least(n("sx"), n("sy")) * 100) >= F.greatest(n("sx"), n("sy")) * similarity)
            .withColumn("o", overlap("sx", "sy")).filter(F.col("o") * 100 >= (n("sx") + n("sy") - F.col("o")) * similarity).select("x", "y"))


def components(links: DataFrame) -> DataFrame:
    """(id, component) of all linked ids, the component named by its smallest: labels pass along links and along labels until none changes."""
    edges = stored(links.select(F.col("x").alias("u"), F.col("y").alias("v")).union(links.select("y", "x")).distinct(), "dedup-links")
    labels = stored(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label")).withColumnRenamed("u", "id"), "dedup-labels")
    while True:
        near = edges.join(labels, edges.v == labels.id).groupBy("u").agg(F.min("label").alias("best"))
        step = labels.join(near, labels.id == near.u).select("id", "label", F.least("label", "best").alias("best"))
        hop = labels.select(F.col("id").alias("best"), F.col("label").alias("far"))
        new = stored(step.join(hop, "best", "left").select("id", F.least("best", F.coalesce("far", "best")).alias("next"), "label"), "dedup-labels")
        changed = new.filter("next <> label").limit(1).count()
        labels = new.select("id", F.col("next").alias("label"))
        if not changed:
            return labels.withColumnRenamed("label", "component")


def leftover_pairs(tables: DataFrame, comps: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Pairs (x, y) that may be linked, share a table key and lie in different components, by the prefix filter."""
    member = stored(tables.select("key", "id").join(comps, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component")), "dedup-members")
    mixed = member.groupBy("key").agg(F.min("component").alias("p"), F.max("component").alias("q")).filter("p <> q").select("key")
    left = member.join(mixed, "key").select("id", "component").distinct()
    values = F.explode(F.expr("transform(sequence(0, octet_length(s) div 8 - 1), k -> substring(s, k * 8 + 1, 8))"))
    shingles = stored(left.join(sets, "id").select("id", "component", (F.octet_length("s") / 8).cast("long").alias("n"), values.alias("v")), "dedup-shingles")
    common = shingles.groupBy("v").agg(F.count(F.lit(1)).alias("df"))
    t = similarity
    # a shingle of one document alone matches none, but takes its position
    ordered = (shingles.join(common, "v").groupBy("id", "component", "n").agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("r"))
               .select("id", "component", "n", F.posexplode(F.slice("r", 1, F.expr(f"cast(n - ceil(n * {t} / 100) + 1 as int)"))).alias("at", "e"))
               .select("id", "component", "n", "at", "e.v", "e.df").filter("df > 1"))
    ordered = stored(ordered, "dedup-prefixes")
    y = ordered.select("v", *[F.col(c).alias(f"y_{c}") for c in ("id", "component", "n", "at")])
    # sizes n <= y_n; the overlap must reach t / (100 + t) of their sum, and positions bound it
    need = F.col("n") + F.col("y_n")
    room = F.least(F.col("n") - F.col("at"), F.col("y_n") - F.col("y_at"))
    return (ordered.join(y, "v").filter((F.col("component") != F.col("y_component")) & ((F.col("n") < F.col("y_n")) | ((F.col("n") == F.col("y_n")) & (F.col("id") < F.col("y_id"))))
                                        & (F.col("n") * 100 >= F.col("y_n") * t) & (room * (100 + t) >= need * t))
            .select(F.col("id").alias("x"), F.col("y_id").alias("y")).distinct())


def near_duplicates(docs: DataFrame, similarity: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: the id, n_shingles, component_id, kept, text_key (xxhash64 of the text), component (a label of the group, null for an empty set). ``similarity`` in hundredths.
    Rows that share the smallest id of their group are all ``kept``."""
    rows = describe(docs, id_col, text_col)
    reps = stored(rows.filter("n > 0").groupBy("id").agg(F.min("doc").alias("doc"), F.min("low").alias("low"), F.min("a").alias("a"), F.min("b").alias("b")), "dedup-classes")
    tables = table_keys(reps)
    low = reps.select("id", "low")
    near = stars(tables).select(F.col("center").alias("x"), F.col("id").alias("y"))

    def alike(pairs: DataFrame) -> DataFrame:
        both = pairs.join(low.select(F.col("id").alias("x"), F.col("low").alias("lx")), "x").join(low.select(F.col("id").alias("y"), F.col("low").alias("ly")), "y")
        return both.withColumn("g", agreeing("lx", "ly")).filter(F.col("g") >= AGREE).select("x", "y")
    near = stored(alike(near), "dedup-stars")
    wanted = stored(reps.join(tables.select("id").distinct(), "id").select("id", "doc"), "dedup-wanted")

    def as_sets(it):
        release()
        for batch in it:
            for part in batches([batch], "text"):
                sets = shingle_sets(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(map(digest, sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "s"])
    # rows that share an id with a wanted one but hold another text fall away by their digests
    texts = named(docs, id_col, text_col).join(wanted.select("doc").distinct(), "doc", "left_semi").select("text")
    sets = texts.mapInArrow(as_sets, "id binary, s binary").join(wanted, "id", "left_semi").groupBy("id").agg(F.first("s").alias("s"))
    sets = stored(sets, "dedup-sets")
    links = stored(confirmed(near, sets, similarity), "dedup-star-links")
    comps = components(links)
    more = stored(alike(leftover_pairs(tables, comps, sets, similarity)), "dedup-left")
    comps = components(links.union(confirmed(more, sets, similarity)))
    of_class = stored(reps.join(comps, "id", "left").select("id", "doc", F.coalesce("component", "id").alias("component")), "dedup-components")
    smallest = of_class.groupBy("component").agg(F.min("doc").alias("first"))
    first = of_class.join(smallest, "component").select("id", "first", "component")
    out = rows.select("id", "doc", "n", "text_key").join(first, "id", "left").withColumn("first", F.coalesce("first", "doc"))
    name = lambda c: F.when(F.col(c) < NO_ID, F.col(c))
    return out.select(name("doc").alias(id_col), F.col("n").alias("n_shingles"), name("first").alias("component_id"), (F.col("first") == F.col("doc")).alias("kept"), "text_key", "component")
