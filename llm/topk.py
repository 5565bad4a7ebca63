"""Exact top-k inner products by a three-phase uniform threshold.

The dimensions are split into SEGMENTS; the scores that one segment gives a query form one local list.
1. Each segment sends the head of its list, and the exact totals of those vectors give a k-th best score that no answer falls below.
2. That cutoff goes to all segments. A total of at least the cutoff needs a segment that gives at least its even share, so each sends all entries
   from that share on (but those that even the largest possible rest, by the norms, can't lift to the cutoff).
3. Totals that aren't complete yet are resolved exactly, and the best k stay; ties go to smaller ids.

The queries go to the tasks in chunks of at most QUERY_BYTES each (broadcast: bounded), the vectors are read where they lie, block by block, so that nothing
is stored or shuffled for each pair of blocks. Of equal vectors only the k + 1 smallest ids can be in any answer (one may be the query
itself); the others are left out of the search by a ranking that Spark also applies before the shuffle.

Defined cases: vectors that are null or hold a null or non-finite component take no part, nor do null ids; of rows that repeat an
id, the smallest vector counts; vectors of other lengths than the query's are no candidates; fewer than k candidates
are all returned; vectors so long that a score might pass 2**61 are an error, as are components beyond 2**62 (scores are exact or not at all); an empty table gives no rows;
other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import parts_for, stored
from llm.encoding import release

SEGMENTS, QUERY_BLOCK, ROW_BLOCK, QUERY_BYTES = 2, 1024, 8192, 16 << 20
#: Entries in a batch that a task sends.
SENT = 100_000


def integers(vectors: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    v, most = F.col("v"), float(2**62)
    whole = F.transform(v, lambda x: F.when(F.abs(x.cast("double") * scale) < most, F.floor(x.cast("double") * scale)).otherwise(
        F.raise_error(F.concat(F.lit("a component does not fit a long: "), x.cast("string"))).cast("long")))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).filter(F.col("id").isNotNull() & v.isNotNull() & fine)
            .select("id", whole.alias("v")).groupBy("id").agg(F.min("v").alias("v")))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)


def partial_scores(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Exact integer inner products; by floats while every sum is below 2**53."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(r).max(initial=0)) * q.shape[1]
    if most < 2.0 ** 53:
        return (q.astype(np.float64) @ r.astype(np.float64).T).astype(np.int64)
    return q @ r.T


def matrices(ids: pa.Array, vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The vectors by their length: ids and rows."""
    size = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    out = {}
    for n in np.unique(size):
        pick = pa.array(size == n)
        out[int(n)] = (ids.filter(pick).to_numpy(zero_copy_only=False).astype(np.int64),
                       vectors.filter(pick).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, int(n)))
    return out


def row_blocks(it):
    """(ids, rows) of vectors of one length, ROW_BLOCK at a time."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in it:
        for n, part in matrices(batch.column("id"), batch.column("v")).items():
            held.setdefault(n, []).append(part)
            if sum(len(ids) for ids, _ in held[n]) >= ROW_BLOCK:
                yield tuple(map(np.concatenate, zip(*held.pop(n))))
    for parts in held.values():
        yield tuple(map(np.concatenate, zip(*parts)))


def spans(n: int) -> list[tuple[int, int, int]]:
    """(segment, first, end) of the dimensions."""
    width = -(-n // SEGMENTS)
    return [(s, s * width, min(n, (s + 1) * width)) for s in range(SEGMENTS) if s * width < n]


def cells(it, asked):
    """Each block of rows with each block of queries of the same length: (query ids, their rows and cutoffs, row ids, rows)."""
    for ids, rows in row_blocks(it):
        if (found := asked.get(rows.shape[1])) is not None:
            q_ids, queries, cuts = found
            for at in range(0, len(q_ids), QUERY_BLOCK):
                to = at + QUERY_BLOCK
                yield q_ids[at:to], queries[at:to], cuts[at:to], ids, rows


def heads(asked, k: int):
    """Phase 1: the k best entries of each query in the block's lists."""
    def run(it):
        release()
        for q_ids, queries, _, ids, rows in cells(it, asked.value):
            for seg, a, z in spans(rows.shape[1]):
                s = partial_scores(queries[:, a:z], rows[:, a:z])
                n = min(k + 1, s.shape[1])
                top = np.argpartition(-s, n - 1, axis=1)[:, :n]
                found, part, qs = ids[top].ravel(), np.take_along_axis(s, top, 1).ravel(), np.repeat(q_ids, n)
                keep = found != qs
                yield pa.RecordBatch.from_arrays([pa.array(qs[keep]), pa.array(np.full(keep.sum(), seg, np.int32)), pa.array(found[keep]), pa.array(part[keep])], ["q", "seg", "id", "part"])
    return run


def entries(asked):
    """Phase 2: all entries from the query's share of the cutoff on."""
    def run(it):
        release()
        for q_ids, queries, cuts, ids, rows in cells(it, asked.value):
            q_norm, r_norm = ((x.astype(np.float64) ** 2).sum(1) for x in (queries, rows))
            cut = cuts.astype(np.float64)[:, None]
            for _, a, z in spans(rows.shape[1]):
                q_rest, r_rest = (np.maximum(norm - (x[:, a:z].astype(np.float64) ** 2).sum(1), 0) for norm, x in ((q_norm, queries), (r_norm, rows)))
                s = partial_scores(queries[:, a:z], rows[:, a:z])
                # bounds in floating point, with room for its errors
                slack = 1 + 1e-9 * (np.abs(cut) + np.sqrt(np.outer(q_norm, r_norm)))
                rest = np.sqrt(np.outer(q_rest, r_rest)) + slack
                at, to = np.nonzero((s.astype(np.float64) * SEGMENTS >= cut - slack) & (s + rest >= cut) & (q_ids[:, None] != ids[None, :]))
                part = s[at, to]
                for k in range(0, len(at), SENT):
                    yield pa.RecordBatch.from_arrays([pa.array(q_ids[at[k:k + SENT]]), pa.array(ids[to[k:k + SENT]]), pa.array(part[k:k + SENT])], ["q", "id", "part"])
    return run


def search(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``is_query``: a condition on the column ``id``. Columns: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    every = stored(integers(vectors, scale, id_col, vec_col), "topk-vectors")
    queries = every.filter(is_query)
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    lengths = every.groupBy(F.size("v")).agg(F.max(norm).alias("any"), F.max(F.when(is_query, norm)).alias("asking"), F.sum(F.when(is_query, 24 + 8 * F.size("v"))).alias("size"))
    most, size = lengths.agg(F.max(F.sqrt("any") * F.sqrt("asking")), F.sum("size")).first()
    if most and most >= 2.0**61:
        raise ValueError(f"scores up to {most:.3g} may not fit a long")
    ranked = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    rows = stored(every.withColumn("n", ranked).filter(F.col("n") <= k + 1).drop("n"), "topk-rows")
    chunks = parts_for(size, QUERY_BYTES)

    def against(asked: DataFrame, fn, schema: str) -> DataFrame:
        """``fn(chunk)`` over all rows, for each chunk of the queries (id, v, cut)."""
        out = None
        for c in range(chunks):
            table = asked.filter(F.pmod(F.xxhash64("id"), F.lit(chunks)) == c).select("id", "v", "cut").toArrow().combine_chunks()
            cuts = dict(zip(table["id"].to_pylist(), table["cut"].to_pylist()))
            by = {n: (ids, m, np.array([cuts[i] for i in ids.tolist()], np.int64)) for n, (ids, m) in matrices(*(table[c].combine_chunks() for c in ("id", "v"))).items()}
            part = rows.mapInArrow(fn(spark.sparkContext.broadcast(by)), schema)
            out = part if out is None else out.unionByName(part)
        return out
    head = against(queries.withColumn("cut", F.lit(0).cast("long")), lambda q: heads(q, k), "q long, seg int, id long, part long")
    best = F.row_number().over(Window.partitionBy("q", "seg").orderBy(F.desc("part"), "id"))
    listed = head.withColumn("n", best).filter(F.col("n") <= k).select("q", "id").distinct()

    def totals(pairs: DataFrame) -> DataFrame:
        with_q = pairs.join(queries.select(F.col("id").alias("q"), F.col("v").alias("qv")), "q")
        return with_q.join(every, "id").select("q", "id", dot(F.col("qv"), F.col("v")).alias("score"))
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    cutoff = stored(totals(listed).withColumn("n", place).filter(F.col("n") == k).select("q", "score"), "topk-cutoffs")
    asked = queries.join(cutoff, queries.id == cutoff.q, "left").select("id", "v", F.coalesce("score", F.lit(-2**62)).cast("long").alias("cut"))
    sent = against(asked, entries, "q long, id long, part long")
    seen = stored(sent.groupBy("q", "id").agg(F.sum("part").alias("score"), F.count(F.lit(1)).alias("n")), "topk-entries")
    full = seen.filter(F.col("n") == SEGMENTS).select("q", "id", "score").unionByName(totals(seen.filter(F.col("n") < SEGMENTS).select("q", "id")))
    return (full.withColumn("rank", place).filter(F.col("rank") <= k)
            .select(F.col("q").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"))
