"""Order-preserving packing by dynamic programming.

The documents stand in ascending order of ids, each followed by an end id. Cuts between sequences may fall
at document ends (free), sentence ends or, inside very long sentences, at fixed distances (both at a price in tokens).
The cheapest cuts minimise padding plus prices; since the padding of a window is its capacity minus its length, the best
predecessor of each boundary is the front of a queue that is kept monotone, and the whole takes linear time.

Spark deals ranges of documents to tasks by their bytes; a task solves runs of RUN_TOKENS tokens, so only the last
sequence of a run is short for want of documents.

Defined cases: a null text is empty (its end id alone); repeated and null document ids are documents of their own;
an empty table gives no rows; a document of any length is cut into as many pieces as it needs; other columns are ignored.
"""
from __future__ import annotations

import zlib
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import parts_for, stored
from llm.encoding import KEPT_PIECES, batches, encoder, give_back

CAPACITY, PART_BYTES, RUN_TOKENS = 4096, 8 << 20, 2 << 20
#: Parts at most; beyond that they grow, which costs no memory, as a task solves run after run.
MOST_PARTS = 50_000
#: Tokens that a cut at a sentence end, and one inside a sentence, is worth.
SENTENCE_PRICE, INNER_PRICE = 16, 64
#: Distance of possible cuts inside a sentence that is longer.
INNER_STEP = 512


def best_cuts(ends: np.ndarray, prices: np.ndarray, capacity: int = CAPACITY) -> list[int]:
    """Indices into the ascending boundaries ``ends`` where windows of at most ``capacity`` end, the last included."""
    ends, prices = ends.tolist(), prices.tolist()
    cost, back = [0] * (len(ends) + 1), [0] * (len(ends) + 1)
    queue = deque([(0, 0, 0)])  # (cost + position, position, index), ascending in the first
    for j, end in enumerate(ends, 1):
        while end - queue[0][1] > capacity:
            queue.popleft()
        least, _, back[j] = queue[0]
        cost[j] = c = least + capacity - end + prices[j - 1]
        value = c + end
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, end, j))
    cuts, j = [], len(ends)
    while j:
        cuts.append(j - 1)
        j = back[j]
    return cuts[::-1]


def boundaries(ids: np.ndarray, doc_ends: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Possible cuts and their prices: document ends, sentence ends (an id of ``stops``), and steps inside long gaps."""
    sentence = np.flatnonzero(stops[ids]) + 1
    at = np.concatenate([doc_ends, sentence])
    price = np.concatenate([np.zeros(len(doc_ends), np.int64), np.full(len(sentence), SENTENCE_PRICE)])
    order = np.lexsort((price, at))
    at, price = at[order], price[order]
    first = np.diff(at, prepend=-1) > 0
    at, price = at[first], price[first]
    gaps = np.diff(at, prepend=0)
    extra = [np.arange(e - g + INNER_STEP, e, INNER_STEP) for e, g in zip(at[gaps > 2 * INNER_STEP], gaps[gaps > 2 * INNER_STEP])]
    if extra:
        more = np.concatenate(extra)
        order = np.argsort(all_at := np.concatenate([at, more]), kind="stable")
        at, price = all_at[order], np.concatenate([price, np.full(len(more), INNER_PRICE)])[order]
    return at, price


@lru_cache
def sentence_stops(path: str, keeps_space: bool, end_id: int) -> np.ndarray:
    """Which ids end a sentence: their piece ends in a full stop, question or exclamation mark or a line break."""
    tokenizer = encoder(path, keeps_space).tokenizer
    stops = np.zeros(max(tokenizer.get_vocab_size(), end_id + 1), bool)
    for piece, k in tokenizer.get_vocab().items():
        if piece.removesuffix("</w>").endswith((".", "!", "?", "Ċ")):
            stops[k] = True
    return stops


def pack(docs: DataFrame, path: str, end_id: int, keeps_space: bool = False, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         kept: int = KEPT_PIECES) -> DataFrame:
    """``kept``: pieces of text that a worker remembers. Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (binary, unsigned 32-bit little-endian)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    tie = F.xxhash64("text")
    # a random number parts rows that repeat both: a range holds its share of them whatever their number
    rows = rows.withColumn("spread", F.rand(7)).repartitionByRange(min(parts_for(total, PART_BYTES), MOST_PARTS), "doc_id", tie, "spread").sortWithinPartitions("doc_id", tie, "spread").drop("spread")

    def solve(part: int, sequence: int, ids: np.ndarray, doc_ids: list, sizes: np.ndarray, stops: np.ndarray):
        doc_ends = np.cumsum(sizes)
        ends, prices = boundaries(ids, doc_ends, stops)
        cuts = ends[best_cuts(ends, prices, capacity)]
        at = np.union1d(cuts, doc_ends)
        begin = np.concatenate([[0], at[:-1]])
        doc, seq = np.searchsorted(doc_ends, begin, side="right"), np.searchsorted(cuts, begin, side="right")
        raw = [ids[a:b].tobytes() for a, b in zip(begin, at)]
        return len(cuts), pa.RecordBatch.from_arrays([
            pa.array([doc_ids[d] for d in doc], pa.int64()), pa.array(begin - (doc_ends - sizes)[doc]), pa.array(at - begin),
            pa.array([zlib.crc32(r) for r in raw], pa.int64()), pa.array(sizes[doc]), pa.array(np.full(len(doc), part, np.int32)), pa.array(seq + sequence),
            pa.array(begin - np.concatenate([[0], cuts])[seq]), pa.array(raw, pa.binary())],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "sequence", "offset", "ids"])

    def run(it):
        give_back()
        enc, stops, part = encoder(path, keeps_space, kept), sentence_stops(path, keeps_space, end_id), TaskContext.get().partitionId()
        sequence, held, flats, doc_ids, sizes = 0, 0, [], [], []
        for batch in batches(it, "text", 2 << 20):
            flat, n = enc.encode(batch.column("text"))
            flats.append(np.insert(flat, np.cumsum(n), end_id).astype("<u4"))
            doc_ids += batch.column("doc_id").to_pylist()
            sizes.append(n + 1)
            held += len(flats[-1])
            if held >= RUN_TOKENS:
                used, out = solve(part, sequence, np.concatenate(flats), doc_ids, np.concatenate(sizes), stops)
                yield out
                sequence, held, flats, doc_ids, sizes = sequence + used, 0, [], [], []
        if doc_ids:
            yield solve(part, sequence, np.concatenate(flats), doc_ids, np.concatenate(sizes), stops)[1]
    pieces = stored(rows.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, sequence long, offset long, ids binary"), "packed")
    count = pieces.groupBy("part").agg((F.max("sequence") + 1).alias("n"))
    before = count.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row a part, MOST_PARTS at most
    return pieces.join(F.broadcast(before), "part").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("sequence") + F.col("before")).alias("sequence_id"), "offset", "ids")
