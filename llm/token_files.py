"""Token ids in files of canonical, length-limited Huffman code.

Format: a Parquet directory in which each row is a block of whole documents in ascending order of ids.

| column | holds |
| --- | --- |
| part, block | the order of blocks: by part, then block |
| first | ids of the part before the block |
| doc_ids, sizes | the documents and how many ids each has (null document ids are kept) |
| checkpoints | the bit offset of every STEP-th id, unsigned 32-bit little-endian |
| bits | the codes, most significant bit first |

Beside it a second directory holds the code: one row (id, bits) for each id in use; canonical codes follow from the lengths.
Spark writes both, so a lost executor's blocks are written again and only committed ones are seen. A block needs
nothing but the code to be decoded; within it all checkpoints are decoded side by side through one table.

Defined cases: a null text is empty; every document ends with the end id; repeated and null document ids are documents of
their own, nulls first, equal ids in the order of their texts' hashes; an empty table gives an empty file; other columns are ignored.
"""
from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import parts_for, stored
from llm.encoding import batches, encoder

#: Text bytes in a part; ids in a block; ids between checkpoints; longest code in bits.
PART_BYTES, BLOCK_IDS, STEP, LONGEST = 16 << 20, 1 << 18, 128, 20
#: Parts at most; beyond that they grow, which costs no memory, as a task writes block after block.
MOST_PARTS = 50_000


def tokens(docs: DataFrame, path: str, keeps_space: bool, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Blocks of plain ids (unsigned 32-bit) in ascending order of document ids."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    # the hash spreads an id that fills many rows over several ranges, a random number rows that repeat the text too
    tie = F.xxhash64("text")
    rows = (rows.withColumn("spread", F.rand(7)).repartitionByRange(min(parts_for(total, PART_BYTES), MOST_PARTS), "doc_id", tie, "spread")
            .sortWithinPartitions("doc_id", tie, "spread").drop("spread"))

    def encode(it):
        enc, part = encoder(path, keeps_space), TaskContext.get().partitionId()
        block = first = 0
        ids, docs_, sizes, held = [], [], [], 0

        def row():
            return pa.RecordBatch.from_pylist([{"part": part, "block": block, "first": first, "doc_ids": docs_, "sizes": sizes,
                                                "ids": np.concatenate(ids).astype("<u4").tobytes()}], schema)
        for batch in batches(it, "text", 2 << 20):
            flat, n = enc.encode(batch.column("text"))
            at = 0
            for doc, k in zip(batch.column("doc_id").to_pylist(), n.tolist()):
                ids += [flat[at:at + k], np.array([end_id], np.uint32)]
                docs_.append(doc)
                sizes.append(k + 1)
                at, held = at + k, held + k + 1
                if held >= BLOCK_IDS:
                    yield row()
                    block, first = block + 1, first + held
                    ids, docs_, sizes, held = [], [], [], 0
        if docs_:
            yield row()
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("ids", pa.binary())])
    return stored(rows.mapInArrow(encode, "part int, block int, first long, doc_ids array<long>, sizes array<long>, ids binary"), "token-ids")


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Optimal code lengths of at most ``longest`` bits by package-merge; ``counts`` are positive."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    if n > 1 << longest:
        raise ValueError(f"{n} ids don't fit codes of {longest} bits")
    order = np.argsort(counts, kind="stable")
    coins = counts[order].astype(np.float64)
    level, levels = coins, [np.ones(n, bool)]
    for _ in range(longest - 1):
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([coins, pairs])
        rank = np.argsort(both, kind="stable")
        level = both[rank]
        levels.append(rank < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_coin in reversed(levels):
        chosen = int(is_coin[:take].sum())
        lengths[:chosen] += 1
        take = 2 * (take - chosen)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """Canonical codes of the ids in use, for both directions."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        ids, lengths = ids[order], lengths[order]
        self.longest = int(lengths.max(initial=1))
        spans = np.left_shift(1, self.longest - lengths)
        starts = np.concatenate([[0], np.cumsum(spans)])[:-1]
        self.code, self.bits = (np.zeros(int(ids.max(initial=0)) + 1, t) for t in (np.uint64, np.int64))
        self.code[ids], self.bits[ids] = starts >> (self.longest - lengths), lengths
        room = 1 << self.longest
        self.symbol, self.width = np.zeros(room, np.uint32), np.zeros(room, np.uint8)
        self.symbol[:spans.sum()], self.width[:spans.sum()] = np.repeat(ids, spans), np.repeat(lengths, spans)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        bits = self.bits[ids]
        ends = np.cumsum(bits)
        starts = ends - bits
        word, shift = starts >> 6, 64 - (starts & 63) - bits
        code = self.code[ids]
        high = np.where(shift >= 0, code << np.maximum(shift, 0).astype(np.uint64), code >> np.maximum(-shift, 0).astype(np.uint64))
        out = np.zeros((int(ends[-1]) >> 6) + 2, np.uint64)
        begin = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[begin]] = np.bitwise_or.reduceat(high, begin)
        over = np.flatnonzero(shift < 0)  # one a word at most
        out[word[over] + 1] |= code[over] << (64 + shift[over]).astype(np.uint64)
        return out.astype(">u8").tobytes()[:(int(ends[-1]) + 7) // 8], starts[::STEP].astype("<u4").tobytes()

    def decode(self, data: bytes, checkpoints: bytes, n: int) -> np.ndarray:
        raw = np.frombuffer(data + b"\0" * 8, np.uint8).astype(np.uint64)
        at = np.frombuffer(checkpoints, "<u4").astype(np.int64)
        out = np.empty((len(at), STEP), np.uint32)
        last, mask = n - (len(at) - 1) * STEP, np.uint64((1 << self.longest) - 1)
        for k in range(min(STEP, n)):
            if k == last:  # only the last run is shorter
                at = at[:-1]
            b = at >> 3
            four = raw[b] << np.uint64(24) | raw[b + 1] << np.uint64(16) | raw[b + 2] << np.uint64(8) | raw[b + 3]
            window = four >> (32 - (at & 7) - self.longest).astype(np.uint64) & mask
            out[:len(at), k] = self.symbol[window]
            at = at + self.width[window]
        return out.reshape(-1)[:n]


def learn_code(blocks: DataFrame) -> Code:
    """The code from the counts of all ids. The driver gets one count for each id of the vocabulary in use."""
    def count(it):
        total = np.zeros(0, np.int64)
        for batch in it:
            for ids in batch.column("ids"):
                c = np.bincount(np.frombuffer(ids.as_buffer(), "<u4"))
                total = np.pad(total, (0, max(0, len(c) - len(total))))
                total[:len(c)] += c
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])
    rows = blocks.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    rows.sort()
    ids = np.array([r.id for r in rows], np.int64)
    return Code(ids, code_lengths(np.array([r.n for r in rows], np.int64)))


def write(blocks: DataFrame, code: Code, purpose: str = "token-file") -> tuple[DataFrame, DataFrame]:
    """Write the file and its code table; returns both as read back."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast(code)  # bounded by the vocabulary

    def encode(it):
        for batch in it:
            coded = [shared.value.encode(np.frombuffer(x.as_buffer(), "<u4")) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("part", "block", "first", "doc_ids", "sizes")),
                                              pa.array([c for _, c in coded], pa.binary()), pa.array([b for b, _ in coded], pa.binary())],
                                             ["part", "block", "first", "doc_ids", "sizes", "checkpoints", "bits"])
    file = stored(blocks.mapInArrow(encode, "part int, block int, first long, doc_ids array<long>, sizes array<long>, checkpoints binary, bits binary"), purpose)
    used = np.flatnonzero(code.bits)
    lengths = spark.createDataFrame(list(zip(used.tolist(), code.bits[used].tolist())), "id long, bits long")
    return file, stored(lengths, f"{purpose}-code")


def read(file: DataFrame, lengths: DataFrame) -> DataFrame:
    """Decode blocks; columns part, doc_id, start (ids of the part before it), ids (binary, unsigned 32-bit)."""
    rows = lengths.collect()  # bounded by the vocabulary
    shared = file.sparkSession.sparkContext.broadcast(Code(np.array([r.id for r in rows], np.int64), np.array([r.bits for r in rows], np.int64)))

    def decode(it):
        for batch in it:
            for r in range(batch.num_rows):
                get = lambda c: batch.column(c)[r].as_py()  # noqa: B023, E731
                sizes = np.array(get("sizes"), np.int64)
                ends = np.cumsum(sizes)
                ids = shared.value.decode(get("bits"), get("checkpoints"), int(ends[-1])).astype("<u4")
                starts = ends - sizes
                yield pa.RecordBatch.from_arrays([pa.array([get("part")] * len(sizes), pa.int32()), pa.array(get("doc_ids"), pa.int64()), pa.array(starts + get("first")),
                                                  pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())], ["part", "doc_id", "start", "ids"])
    return file.mapInArrow(decode, "part int, doc_id long, start long, ids binary")


def digests(read_back: DataFrame, file: DataFrame) -> DataFrame:
    """Per document: doc_id, start over all parts, n_tokens, ids_crc32."""
    parts = file.select("part", F.expr("aggregate(sizes, 0L, (a, b) -> a + b)").alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row a part, MOST_PARTS at most
    return (read_back.select("part", "doc_id", "start", F.octet_length("ids").alias("bytes"), F.crc32("ids").alias("ids_crc32"))
            .join(F.broadcast(before), "part")
            .select("doc_id", (F.col("start") + F.col("before")).alias("start"), F.expr("bytes div 4").cast("long").alias("n_tokens"), "ids_crc32"))
