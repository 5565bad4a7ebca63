"""Alignment of two tokenizers over anchors of white space.

Both tokenizers encode whole texts. Their tokens are laid over the same bytes, which are compared with the text, so that
the places where tokens of both end are known. Those before a token that begins with a space are anchors: they cut a text into windows of token ids.
A window's alignment depends on its ids alone, and most windows are words that come again and again; so each different window is aligned once
and remembered by its ids. Windows of any length are aligned all together by numpy, a text without anchors being one window.

Alignment of a window: ends that both have cut it into groups; two tokens are linked if their byte ranges overlap.

Over the corpus each linked pair of ids has a count, the number of texts that hold it linked. Spark adds up counts from the pairs of each
row (combined in the map tasks, so that a pair that all texts hold moves once a task) and joins them back: by broadcast if their measured size is within the bound,
otherwise by a shuffle in which adaptive execution splits pairs with many rows.

Defined cases: a text that is null or empty, or whose tokens don't spell it after a space, has no tokens: zeros, empty groups, no pairs;
special tokens' strings are plain text; repeated rows and repeated or null ids are rows of their own; an empty table gives no
rows; other columns are ignored.
"""
from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import small
from llm.encoding import Encoder, Known, batches, byte_letters

#: Windows, and bytes of their keys and groups, that a worker remembers before it starts anew; the same bounds hold for the tokenizers' stretches of text.
KEPT_WINDOWS, KEPT_BYTES = 250_000, 32 << 20
#: Counts are broadcast if they take at most so many bytes.
COUNT_BYTES = 64 << 20
_SPACE = 32


class Spelling:
    """The bytes of each id of a vocabulary."""

    def __init__(self, pieces: list[bytes]):
        self.width = np.array([len(p) for p in pieces], np.int64)
        self.start = np.cumsum(self.width) - self.width
        self.data = np.frombuffer(b"".join(pieces), np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        n = self.width[ids]
        ends = np.cumsum(n)
        return self.data[np.repeat(self.start[ids] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]


class ByteLevel:
    """Tokens of a byte-level vocabulary. Texts come with the space before them."""

    def __init__(self, path: str):
        self.encoder = Encoder(path, keeps_space=True)
        self.encoder.kept = KEPT_WINDOWS
        self.encoder.tokenizer.encode_special_tokens = True
        letters = {c: b for b, c in byte_letters().items()}
        tokenizer = self.encoder.tokenizer
        special = tokenizer.get_added_tokens_decoder()
        size = tokenizer.get_vocab_size()
        self.spelling = Spelling([special[k].content.encode() if k in special else bytes(letters[c] for c in tokenizer.id_to_token(k)) for k in range(size)])

    def encode(self, spaced: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = self.encoder.encode(spaced)
        return ids.astype(np.int64), counts


class Pieces:
    """Tokens of a sentence-piece vocabulary, which puts a space before a text itself. No piece has a space after another character (checked), so
    that merges never pass from one character to a following space: each stretch of spaces and what follows it is encoded once and remembered."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)

        def spelled(k: int) -> bytes:
            piece = self.model.id_to_piece(k)
            return bytes.fromhex(re.fullmatch("<0x(..)>", piece)[1]) if self.model.is_byte(k) else piece.replace("▁", " ").encode()
        pieces = [spelled(k) for k in range(self.model.get_piece_size())]
        if any(b" " in p.lstrip(b" ") for p in pieces):
            raise ValueError(f"{path} has pieces with a space inside")
        self.spelling = Spelling(pieces)
        self.forget()

    def forget(self) -> None:
        self.known, self.chars = Known(), 0
        self.ids, self.counts = [np.empty(0, np.int32)], [np.empty(0, np.int32)]

    def encode(self, spaced: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > KEPT_WINDOWS or self.chars > KEPT_BYTES:
            self.forget()
        bounds = np.frombuffer(spaced.buffers()[1], np.int64)[spaced.offset:spaced.offset + len(spaced) + 1]
        data, bounds = np.frombuffer(spaced.buffers()[2], np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]
        begin = data == _SPACE
        begin[1:] &= ~begin[:-1]
        begin[bounds[:-1]] = True
        at = np.flatnonzero(begin)
        stretches = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(data)).astype(np.int64)), pa.py_buffer(data))
        coded = stretches.dictionary_encode()
        row = np.fromiter(map(self.known.__getitem__, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))[coded.indices.to_numpy()]
        if fresh := self.known.fresh:
            # the model adds one space itself, but none to an empty text
            got = [ids or [self.model.piece_to_id("▁")] for ids in self.model.encode([x[1:] for x in fresh], num_threads=1)]
            self.counts = [np.concatenate([*self.counts, np.fromiter(map(len, got), np.int32, len(got))])]
            self.ids = [np.concatenate([*self.ids, np.fromiter(chain.from_iterable(got), np.int32)])]
            self.chars += sum(map(len, fresh))
            fresh.clear()
        counts = self.counts[0].astype(np.int64)
        ends, n = np.cumsum(counts), counts[row]
        total = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(at, bounds)]
        return self.ids[0][_within(ends[row] - n, n)].astype(np.int64), np.diff(total)


def joined(parts: pa.Array, ends: np.ndarray, by: str) -> pa.Array:
    """Stretches of ``parts``, ending at ``ends``, each as one string."""
    lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int64()), parts)
    return pc.binary_join(lists, pa.scalar(by, parts.type))


def _within(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places starts[k], starts[k] + 1, ... of all k, counts[k] each."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places of tokens whose byte ranges overlap; both sides cover the same bytes."""
    first = np.searchsorted(b_ends, np.concatenate([[0], a_ends[:-1]]), side="right")
    last = np.searchsorted(b_ends, a_ends, side="left")
    n = last - first + 1
    return np.repeat(np.arange(len(a_ends)), n), _within(first, n)


class Aligner:
    """Remembers the alignment of each window by its ids."""

    def __init__(self, a, b):
        self.a, self.b = a, b
        self.pairs_of = np.int64(len(b.spelling.width))
        self.forget()

    def forget(self) -> None:
        self.known, self.size = Known(), 0
        self.text = pa.array([], pa.large_string())
        self.groups, self.start, self.length = [], [], []
        self.codes, self.used = [], 0

    def learn(self) -> None:
        """Align the windows met for the first time. A key is the number of ids of the first tokenizer, these, and those of the second."""
        fresh = self.known.fresh
        if not fresh:
            return
        data = np.frombuffer(b"".join(fresh), np.uint32).astype(np.int64)
        n = np.array([len(k) // 4 for k in fresh])
        at = np.cumsum(n) - n
        n_a = data[at]
        a, b = data[_within(at + 1, n_a)], data[_within(at + 1 + n_a, n - 1 - n_a)]
        a_ends, b_ends = np.cumsum(self.a.spelling.width[a]), np.cumsum(self.b.spelling.width[b])
        last_a, last_b = np.cumsum(n_a), np.cumsum(n - 1 - n_a)
        x, y = overlaps(a_ends, b_ends)
        links = np.diff(np.searchsorted(x, last_a, side="left"), prepend=0)
        codes = (a[x] * self.pairs_of + b[y])
        shared = np.intersect1d(a_ends, b_ends, assume_unique=True)
        cut_a, cut_b = np.searchsorted(a_ends, shared) + 1, np.searchsorted(b_ends, shared) + 1
        groups = np.diff(np.searchsorted(cut_a, last_a, side="right"), prepend=0)
        sides = [joined(pa.array(x).cast(pa.large_string()), cut, ",") for x, cut in ((a, cut_a), (b, cut_b))]
        texts = joined(pc.binary_join_element_wise(*sides, pa.scalar("|", pa.large_string())), np.cumsum(groups), ";")
        self.text = pa.concat_arrays([self.text, texts])
        self.groups.append(groups)
        self.start.append(self.used + np.cumsum(links) - links)
        self.length.append(links)
        self.codes.append(codes)
        self.used += len(codes)
        self.size += 4 * len(data) + 8 * len(codes) + texts.nbytes
        fresh.clear()

    def align(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """Of texts that aren't empty: whether the tokens spell it, then for those that do n_a, n_b, n_groups, n_links, and lists: the groups' texts,
        and the distinct pairs as (text, a, b, how often)."""
        if len(self.known) > KEPT_WINDOWS or self.size > KEPT_BYTES:
            self.forget()
        spaced = pa.array([" " + t for t in texts], pa.large_string())
        sides = [t.encode(spaced) for t in (self.a, self.b)]
        raw = [b" " + t.encode() for t in texts]
        ends = np.cumsum([len(r) for r in raw])
        fits = np.ones(len(texts), bool)
        for tokenizer, (ids, counts) in zip((self.a, self.b), sides):
            spelled = tokenizer.spelling.bytes_of(ids)
            to = np.concatenate([[0], np.cumsum(tokenizer.spelling.width[ids])])[np.cumsum(counts)]
            if len(spelled) != ends[-1] or (to != ends).any() or spelled.tobytes() != b"".join(raw):
                for k, (p, q) in enumerate(zip(np.concatenate([[0], to[:-1]]), to)):
                    fits[k] &= spelled[p:q].tobytes() == raw[k]
        (a, n_a), (b, n_b) = ((ids[np.repeat(fits, counts)], counts[fits]) for ids, counts in sides)
        data = np.frombuffer(b"".join(r for r, ok in zip(raw, fits) if ok) + b" ", np.uint8)
        a_ends, b_ends = np.cumsum(self.a.spelling.width[a]), np.cumsum(self.b.spelling.width[b])
        shared = np.intersect1d(a_ends, b_ends, assume_unique=True)
        anchors = shared[data[shared] == _SPACE]
        to_a, to_b = np.searchsorted(a_ends, anchors) + 1, np.searchsorted(b_ends, anchors) + 1
        in_a, in_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        number = np.arange(len(anchors))
        keys = np.empty(len(anchors) + len(a) + len(b), np.uint32)
        keys[number + to_a - in_a + to_b - in_b] = in_a
        keys[np.repeat(number + 1 + to_b - in_b, in_a) + np.arange(len(a))] = a
        keys[np.repeat(number + 1 + to_a, in_b) + np.arange(len(b))] = b
        bounds = np.concatenate([[0], 4 * (number + 1 + to_a + to_b)]).astype(np.int64)
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(anchors), [None, pa.py_buffer(bounds), pa.py_buffer(keys)]).dictionary_encode()
        row = np.fromiter(map(self.known.__getitem__, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))[coded.indices.to_numpy()]
        self.learn()
        for name in ("groups", "start", "length", "codes"):
            if len(parts := getattr(self, name)) > 1:
                setattr(self, name, [np.concatenate(parts)])
        windows = np.searchsorted(to_a, np.cumsum(n_a)) + 1
        total = lambda values: np.diff(np.concatenate([[0], np.cumsum(values)])[windows], prepend=0)
        n = self.length[0][row] if len(row) else np.empty(0, np.int64)
        n_links = total(n)
        text = np.repeat(np.arange(len(n_a)), n_links)
        if len(row):
            pairs = self.codes[0][_within(self.start[0][row], n)]
            both, often = np.unique(text * (self.pairs_of << 24) + pairs, return_counts=True)
            n_groups = total(self.groups[0][row])
        else:
            both, often, n_groups = np.empty(0, np.int64), np.empty(0, np.int64), n_links
        which, pair = np.divmod(both, self.pairs_of << 24)
        groups = joined(self.text.take(pa.array(row)), windows, ";")
        return fits, n_a, n_b, n_groups, n_links, groups, (which, *np.divmod(pair, self.pairs_of), often)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One for each Python worker."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(ByteLevel(a_path), Pieces(b_path))
    return _ALIGNERS[a_path, b_path]


PAIR = "struct<a: int, b: int, n: int>"


def alignments(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, row (tells rows apart), n_a, n_b, n_groups, n_links, groups (`a1,a2|b1;a3|b2,b3`, ids in order), pairs (different linked ids a, b and how often n).
    ``row`` follows from the place in the input, so store the result before using it twice."""
    def run(it):
        align, row = aligner(a_path, b_path), TaskContext.get().partitionId() << 40
        for batch in it:
            for part in batches([batch], "text"):
                texts = part.column("text").to_pylist()
                some = [k for k, t in enumerate(texts) if t]
                size = len(texts)
                columns = [np.zeros(size, np.int64) for _ in range(4)]
                groups, counts, pairs = [""] * size, np.zeros(size, np.int64), (np.empty(0, np.int64),) * 4
                if some:
                    fits, *found, said, pairs = align.align([texts[k] for k in some])
                    at = np.array(some)[fits]
                    for column, values in zip(columns, found):
                        column[at] = values
                    for k, text in zip(at.tolist(), said.to_pylist()):
                        groups[k] = text
                    counts[at] = np.bincount(pairs[0], minlength=len(at))
                items = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in pairs[1:]], ["a", "b", "n"])
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(row + np.arange(size)), *map(pa.array, columns), pa.array(groups, pa.string()),
                                                  pa.ListArray.from_arrays(pa.array(offsets), items)], ["id", "row", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs"])
                row += size
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"id {kind}, row long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<{PAIR}>").withColumnRenamed("id", id_col)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, held: rows that hold the pair, best: whether no pair of a is held by more)."""
    held = aligned.select(F.explode("pairs").alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("held"))
    most = held.groupBy("a").agg(F.max("held").alias("most"))
    return held.join(most, "a").select("a", "b", "held", (F.col("held") == F.col("most")).alias("best"))


def link_scores(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Per stored row of ``aligned`` with links: row, n_best (links whose pair is best), count_sum (over links); ``counts`` is stored too."""
    links = aligned.select("row", F.inline("pairs"))
    return (links.join(small(counts, "24", COUNT_BYTES), ["a", "b"]).groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("held")).alias("count_sum")))
