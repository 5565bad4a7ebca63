"""Periodic runs of words by string synchronising sets.

A run is a stretch of words with smallest period q, at least 2 * q long, that neither neighbouring word extends. Periods below SMALL are
found position by position. For each dyadic scale t (2, 4, 8, ...) and periods in [4t, 8t):

* A position is synchronising if, of the hashes of the t-word windows that begin within the next t words, the least belongs to the first or
  the last window. Windows that lie in a highly periodic region (a run found before, of a period up to t / 3) have no hash here. Whether a position is
  chosen depends on its 2t words alone, so a repeated context brings the choice with it, and each stretch of 3t words holds a choice or is highly periodic.
* Two chosen positions with equal 2t-word contexts propose their distance as a period. Such a context isn't highly periodic, so it
  recurs only a bounded number of times within 8t words.
* A run without a proposal is one whose first period is highly periodic: it spans two such regions of one small period d that meet out of
  phase. Their phases give its possible periods, all alike modulo d.

Proposals are extended both ways by prefix hashes and confirmed word by word; of two periods of one stretch the smaller counts. Each step costs linear time
a scale, but for sorting the chosen positions, of which there are about 2 / t a word. The texts of a batch stand one after another, parted by
words that occur once, so that numpy works on all of them together; longer scales see only the texts long enough for them.

Spark deals rows as it reads them: no shuffle, memory bounded by a slice of texts (one text, if it is longer).

Defined cases: a null or empty text, or one of white space, has no words, no runs and an empty collapsed text; repeated rows and
repeated or null ids are rows of their own; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.encoding import batches, release

#: Periods below are looked for position by position; words in the shortest run reported.
SMALL, LEAST = 8, 12
_NONE = np.uint64(2**64 - 1)
#: Moduli of the prefix hashes; products of two residues fit 64 bits.
_PRIMES, _BASE = (2147483647, 2147483629), 1000003


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each maximal stretch of true values at least ``least`` long."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], equal.view(np.int8), [0]])))
    a, z = edge[::2], edge[1::2]
    long = z - a >= least
    return a[long], z[long]


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Of rows (start, end, period) with the same start and end, the one with the smallest period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    return runs[np.concatenate([[True], (np.diff(runs[:, :2], axis=0) != 0).any(1)])] if len(runs) else runs


def _at_period(words: np.ndarray, q: int) -> np.ndarray:
    a, z = _stretches(words[:-q] == words[q:], q)
    return np.stack([a, z + q, np.full(len(a), q)], 1)


class _Prefixes:
    """Prefix hashes: equal stretches of words have equal hashes; others with a probability below 1e-18 a comparison."""

    def __init__(self, values: np.ndarray):
        self.n, self.each = len(values), []
        for p in _PRIMES:
            p = np.uint64(p)
            power = np.ones(self.n + 1, np.uint64)
            have, step = 1, _BASE
            while have <= self.n:
                m = min(have, self.n + 1 - have)
                power[have:have + m] = power[:m] * np.uint64(step) % p
                have, step = have + m, step * step % int(p)
            total = np.zeros(self.n + 1, np.uint64)
            np.cumsum(values % p * power[:-1] % p, out=total[1:])
            self.each.append((p, power, total % p))

    def same(self, a: np.ndarray, q: np.ndarray, length: int) -> np.ndarray:
        """Whether the ``length`` words from ``a`` equal those from ``a + q``; all within bounds."""
        out = np.ones(len(a), bool)
        for p, power, total in self.each:
            here = (total[a + length] + p - total[a]) % p * power[q] % p
            out &= here == (total[a + q + length] + p - total[a + q]) % p
        return out

    def stretch(self, at: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The maximal [begin, end) around ``at`` in which each word equals the one ``q`` later."""
        right, left = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        step = 1 << max(self.n.bit_length() - 1, 0)
        while step:
            fits = np.flatnonzero(at + q + right + step <= self.n)
            right[fits[self.same(at[fits] + right[fits], q[fits], step)]] += step
            fits = np.flatnonzero(at - left - step >= 0)
            left[fits[self.same(at[fits] - left[fits] - step, q[fits], step)]] += step
            step >>= 1
        return at - left, at + right


def _chosen(names: np.ndarray, runs: np.ndarray, t: int) -> np.ndarray:
    """The synchronising positions of scale ``t``; ``names`` are the hashes of all t-word windows."""
    flat = runs[(3 * runs[:, 2] <= t) & (runs[:, 1] - runs[:, 0] >= t)]
    mark = np.zeros(len(names) + 1, np.int32)
    np.add.at(mark, flat[:, 0], 1)
    np.add.at(mark, flat[:, 1] - t + 1, -1)
    names = np.where(np.cumsum(mark[:-1]) > 0, _NONE, names)
    low, have = names, 1
    while have < t:
        low, have = np.minimum(low[:-have], low[have:]), 2 * have
    first, last = names[:-t], names[t:]
    low = np.minimum(low[:len(last)], last)
    return np.flatnonzero((low != _NONE) & ((low == first) | (low == last)))


def _from_contexts(chosen: np.ndarray, names: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances in [4t, 8t) of chosen positions with equal 2t-word contexts."""
    names = names[chosen]
    order = np.argsort(names, kind="stable")
    at, names, found, k = chosen[order], names[order], [], 1
    while k < len(at):
        far = at[k:] - at[:-k]
        near = (names[k:] == names[:-k]) & (far < 8 * t)
        if not near.any():
            break
        fits = np.flatnonzero(near & (far >= 4 * t))
        found.append(np.stack([at[fits], far[fits]]))
        k += 1
    both = np.concatenate(found, 1) if found else np.empty((2, 0), np.int64)
    return both[0], both[1]


def _from_regions(words: np.ndarray, runs: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and periods in [4t, 8t) of stretches over two highly periodic regions that meet out of phase."""
    runs = runs[(3 * runs[:, 2] <= t) & (runs[:, 1] - runs[:, 0] >= np.maximum(11 * runs[:, 2], 3 * t))]
    runs = runs[np.lexsort((runs[:, 0], runs[:, 2]))]
    s1, f, d = runs[:-1].T if len(runs) else (np.empty(0, np.int64),) * 3
    g, e2 = (runs[1:, 0], runs[1:, 1]) if len(runs) else (s1, s1)
    meet = np.flatnonzero((runs[1:, 2] == d) & (g <= f) & (g > f - d)) if len(runs) else []
    at, periods = [], []
    for k in meet:
        size, begin = int(d[k]), int(s1[k])
        here, root = words[begin:begin + 2 * size - 1], words[g[k]:g[k] + size]
        phase = np.flatnonzero((np.lib.stride_tricks.sliding_window_view(here, size) == root).all(1))
        if len(phase):
            q = np.arange((int(g[k]) - begin - int(phase[0])) % size, 8 * t, size)
            q = q[(q >= 4 * t) & (q <= min(f[k] - begin, e2[k] - f[k] + size))]
            at.append(f[k] - q)
            periods.append(q)
    return (np.concatenate(at), np.concatenate(periods)) if at else (np.empty(0, np.int64),) * 2


def find_runs(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All runs as rows (start, end, smallest period), by start, of texts that stand one after another in descending order of
    ``sizes`` (words, with one that occurs nowhere else at the end of each text)."""
    if not len(words):
        return np.empty((0, 3), np.int64)
    ends = np.cumsum(sizes)
    runs = _smallest(np.concatenate([_at_period(words, q) for q in range(1, SMALL)]))
    names = _mix(words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    prefixes, t, level = None, SMALL // 4, 1
    while True:
        long = int(np.count_nonzero(sizes > 8 * t))
        if not long:
            return runs
        n = int(ends[long - 1])
        if prefixes is None:
            prefixes = _Prefixes(names[:n])
        names = names[:n - level + 1]
        while level < t:
            names, level = _mix(names[:-level] * np.uint64(0xD1342543DE82EF95) + names[level:]), 2 * level
        twice = _mix(names[:-t] * np.uint64(0xD1342543DE82EF95) + names[t:])
        own = runs[runs[:, 1] <= n]
        proposals = (_from_contexts(_chosen(names, own, t), twice, t), _from_regions(words, own, t))
        at, q = (np.concatenate(x) for x in zip(*proposals))
        begin, end = prefixes.stretch(at, q)
        fits = end - begin >= q
        found = _smallest(np.stack([begin, end + q, q], 1)[fits])
        if not _confirmed(words, found):  # two different stretches with equal hashes
            return _smallest(np.concatenate([_at_period(words, q) for q in range(1, int(sizes[0]) // 2 + 1)]))
        runs = _smallest(np.concatenate([runs, found]))
        t *= 2


def _confirmed(words: np.ndarray, runs: np.ndarray, at_once: int = 1 << 22) -> bool:
    n = runs[:, 1] - runs[:, 0] - runs[:, 2]
    part = np.cumsum(n) // at_once
    for some in np.split(np.arange(len(n)), np.flatnonzero(np.diff(part)) + 1) if len(n) else ():
        size = n[some]
        at = np.repeat(runs[some, 0] - np.cumsum(size) + size, size) + np.arange(size.sum())
        if not (words[at] == words[at + np.repeat(runs[some, 2], size)]).all():
            return False
    return True


def runs_of_texts(texts: list[bytes | None], least: int = LEAST) -> tuple[list[np.ndarray], list[bytes], np.ndarray]:
    """For each text its runs of at least ``least`` words as rows (start, length, period), the text without what the runs repeat, and its number of words."""
    split = [(t or b"").split() for t in texts]  # bytes split at exactly the six ASCII white spaces
    counts = np.array([len(w) for w in split], np.int64)
    order = np.argsort(-counts, kind="stable")
    known: dict[bytes, int] = {}
    flat = np.empty(int(counts.sum()) + len(texts), np.int64)
    first, at = np.empty(len(texts), np.int64), 0
    for rank, k in enumerate(order.tolist()):
        first[k] = at
        flat[at:at + counts[k]] = [known.setdefault(w, len(known)) for w in split[k]]
        at += int(counts[k])
        flat[at] = -1 - rank
        at += 1
    runs = find_runs(flat, counts[order] + 1)
    runs = runs[runs[:, 1] - runs[:, 0] >= np.maximum(least, 2 * runs[:, 2])]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    drop = np.zeros(len(flat) + 1, np.int32)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 1], -1)
    kept = np.cumsum(drop) <= 0
    out, collapsed = [], []
    for k, words in enumerate(split):
        a, z = first[k], first[k] + counts[k]
        lo, hi = np.searchsorted(runs[:, 0], [a, z])
        own = runs[lo:hi]
        out.append(np.stack([own[:, 0] - a, own[:, 1] - own[:, 0], own[:, 2]], 1))
        collapsed.append(b" ".join([words[i] for i in np.flatnonzero(kept[a:z]).tolist()] if hi > lo else words))
    return out, collapsed, counts


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """Per row: the id, n_words, runs (by start, then period: start, length, period in words), collapsed (the words that no run holds beyond its first period,
    joined by one space). Runs shorter than ``least`` words are left out."""
    def find(it):
        release()
        for part in batches(it, "text"):
            found, collapsed, counts = runs_of_texts(part.column("text").cast(pa.binary()).to_pylist(), least)
            rows = np.concatenate(found).astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            items = pa.StructArray.from_arrays([pa.array(rows[:, j]) for j in range(3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), items),
                                              pa.array(collapsed, pa.binary()).cast(pa.string())], ["id", "n_words", "runs", "collapsed"])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]
    out = rows.mapInArrow(find, f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return out.withColumnRenamed("id", id_col)
