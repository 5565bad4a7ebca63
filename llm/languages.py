"""Languages of a document as a mixture, by expectation-maximisation over n-gram likelihoods.

A text is read as letters with one space between words and cut into units of UNIT words. Trigram counts of
labelled documents give each language's likelihood of a unit. For a document, EM estimates the shares of the
languages; sets of growing size (by share) are compared by log-likelihood minus half a log of the
number of units for each language more, and the best set's shares are the result.

The model is fitted on at most SAMPLE labelled documents for each of at most LANGUAGES languages, those with the smallest hashes of their ids; every document is scored whole.

Defined cases: a text that is null or without a letter is ``und`` with score 0, as is every text if nothing was learned; ties go to the
language first in order of names; repeated ids are rows of their own; a null id counts as held out and isn't learned from; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.encoding import batches, release

#: Labelled documents a language; hash buckets of trigrams; words in a unit; EM rounds.
SAMPLE, BUCKETS, UNIT, ROUNDS = 4000, 1 << 16, 4, 12
#: Languages learned at most: with BUCKETS this bounds what the driver gathers and what is broadcast (64 MB).
LANGUAGES = 256
#: A text is rejected if even chance is e**EVIDENCE times as likely as the learned languages; a few odd words are no such evidence.
EVIDENCE = 10.0


def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


_LETTERS: list[np.ndarray] = []


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram buckets of all texts, the unit each lies in, and the document of each unit.
    Units are numbered through; documents without a letter have none."""
    if not _LETTERS:
        _LETTERS.append(letters())
    low = [" " + t.lower() + " " if t else " " for t in texts]
    doc = np.repeat(np.arange(len(low)), [len(t) for t in low])
    c = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    c[~_LETTERS[0][c]] = 0
    keep = (c > 0) | (np.diff(c, prepend=np.uint32(1)) != 0)
    keep[1:] |= doc[1:] != doc[:-1]
    c, doc = c[keep], doc[keep]
    starts = (c > 0) & (np.concatenate([[0], c[:-1]]) == 0)  # of words
    word = np.cumsum(starts) - 1
    first_doc = np.concatenate([[True], doc[starts][1:] != doc[starts][:-1]]) if starts.any() else np.zeros(0, bool)
    before = np.maximum.accumulate(np.where(first_doc, np.arange(len(first_doc)), 0)) if len(first_doc) else first_doc
    fresh = (np.arange(len(first_doc)) - before) % UNIT == 0 if len(first_doc) else first_doc
    unit_of_word = np.cumsum(fresh) - 1
    x = c.astype(np.uint64)
    h = (x[:-2] * np.uint64(0x9E3779B97F4A7C15) + x[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + x[2:] * np.uint64(0x165667B19E3779F9))
    h ^= h >> np.uint64(29)
    bucket = (h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - 16)).astype(np.int64)
    mid = (c[1:-1] > 0) & (doc[:-2] == doc[2:])
    return bucket[mid], unit_of_word[word[1:-1][mid]], doc[starts][fresh] if len(fresh) else np.zeros(0, np.int64)


def em(like: np.ndarray, begin: np.ndarray, of: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares and log-likelihood of each document; ``allowed``: its languages. ``like``: units x languages."""
    share = allowed / allowed.sum(1, keepdims=True)
    for _ in range(ROUNDS):
        r = like * share[of]
        r /= np.maximum(r.sum(1, keepdims=True), 1e-300)
        share = np.add.reduceat(r, begin, axis=0)
        share /= np.maximum(share.sum(1, keepdims=True), 1e-300)
    return share, np.add.reduceat(np.log(np.maximum((like * share[of]).sum(1), 1e-300)), begin)


def mixtures(texts: list[str | None], logs: np.ndarray) -> np.ndarray:
    """Shares of the languages, documents x languages; all zero without a letter. ``logs``: buckets x languages."""
    return solved(texts, logs)[0]


def solved(texts: list[str | None], logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares as :func:`mixtures`; and by how much the chosen languages explain a document's trigrams better than even chance, in
    log-likelihood: 0 without a letter, infinite where nothing was learned."""
    out, gain = np.zeros((len(texts), logs.shape[1])), np.zeros(len(texts))
    bucket, unit, unit_doc = grams(texts)
    if not len(unit_doc) or not logs.shape[1]:
        gain[unit_doc] = np.inf
        return out, gain
    begin_unit = np.flatnonzero(np.diff(unit, prepend=-1))
    ll = np.add.reduceat(logs[bucket], begin_unit, axis=0).astype(np.float64)
    like = np.exp(ll - ll.max(1, keepdims=True))
    begin = np.flatnonzero(np.diff(unit_doc, prepend=-1))
    docs = unit_doc[begin]
    n = np.diff(np.append(begin, len(unit_doc)))
    of = np.repeat(np.arange(len(docs)), n)
    share, _ = em(like, begin, of, np.ones((len(docs), like.shape[1])))
    order = np.argsort(-share, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    single = np.add.reduceat(np.log(np.maximum(like, 1e-300)), begin, axis=0)
    lead = single.argmax(1)
    best, value = np.eye(like.shape[1])[lead], single[np.arange(len(docs)), lead]
    left = np.arange(len(docs))  # documents for which the last larger set was better
    for size in range(2, like.shape[1] + 1):
        pick = np.isin(of, left)
        b = np.concatenate([[0], np.cumsum(n[left])])[:-1]
        s, v = em(like[pick], b, np.repeat(np.arange(len(left)), n[left]), (rank[left] < size).astype(float))
        v = v - 0.5 * (size - 1) * np.log(np.maximum(n[left], 2))
        won = v > value[left]
        best[left[won]], value[left[won]] = s[won], v[won]
        left = left[won]
        if not len(left):
            break
    out[docs] = best
    trigrams = np.diff(np.append(begin_unit, len(unit)))
    gain[docs] = value + np.add.reduceat(ll.max(1) + trigrams * np.log(BUCKETS), begin)
    return out, gain


def rejected(texts: list[str | None], logs: np.ndarray) -> np.ndarray:
    """Whether a text has no letter, or even chance explains its trigrams so much better than any mixture that EVIDENCE is passed."""
    share, gain = solved(texts, logs)
    return (gain < -EVIDENCE) | (gain == 0) & ~share.any(1)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE,
        languages: int = LANGUAGES) -> tuple[list[str], np.ndarray]:
    """Languages in order and log-probabilities, buckets x languages. The driver gets at most BUCKETS counts for each of at most ``languages`` languages,
    those with most labelled rows (ties: first by name)."""
    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(~held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    common = [r[0] for r in labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()]
    labelled = labelled.filter(F.col("lang").isin(common))
    first = Window.orderBy(F.xxhash64("id"), "id")
    ids = labelled.select("id", "lang")
    for by in (["lang", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(64))], ["lang"]):  # a common language is ranked in 64 tasks first
        ids = ids.withColumn("n", F.row_number().over(first.partitionBy(*by))).filter(F.col("n") <= sample).drop("n")
    ids = ids.select("id").distinct()
    chosen = labelled.join(F.broadcast(ids), "id")  # at most ``sample`` ids for each of ``languages``

    def count(it):
        release()
        total: dict[str, np.ndarray] = {}
        for batch in it:
            for part in batches([batch], "text"):
                langs, texts = part.column("lang").to_pylist(), part.column("text").to_pylist()
                for lang in set(langs):
                    c = np.bincount(grams([t for t, x in zip(texts, langs) if x == lang])[0], minlength=BUCKETS)
                    total[lang] = total.get(lang, 0) + c
        for lang, c in total.items():
            seen = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(seen.astype(np.int32)), pa.array(c[seen])], ["lang", "bucket", "n"])
    rows = chosen.select("text", "lang").mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(rows["lang"].to_pylist()))
    counts = np.zeros((BUCKETS, len(langs)))
    at = np.array([langs.index(x) for x in rows["lang"].to_pylist()], np.int64)
    counts[rows["bucket"].to_numpy(), at] = rows["n"].to_numpy()
    return langs, np.log((counts + 0.5) / (counts.sum(0) + 0.5 * BUCKETS)).astype(np.float32)


def predict(docs: DataFrame, langs: list[str], logs: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: the id, lang_pred, score (share of that language), shares (language to share)."""
    shared = docs.sparkSession.sparkContext.broadcast((langs, logs))  # BUCKETS x LANGUAGES floats at most

    def run(it):
        release()
        names, table = shared.value
        for batch in batches(it, "text"):
            share = mixtures(batch.column("text").to_pylist(), table)
            top = share.argmax(1) if names else np.zeros(len(share), np.int64)
            score = share.max(1) if names else np.zeros(len(share))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array([names[t] if s > 0 else "und" for t, s in zip(top, score)], pa.string()), pa.array(score, pa.float64()),
                pa.array([[(names[j], float(row[j])) for j in np.flatnonzero(row)] for row in share], pa.map_(pa.string(), pa.float64()))], [id_col, "lang_pred", "score", "shares"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double, shares map<string, double>")


def accepted(docs: DataFrame, langs: list[str], logs: np.ndarray, text_col: str = "text") -> DataFrame:
    """The rows that aren't :func:`rejected`, with all their columns and without a shuffle; every row with a letter where nothing was learned."""
    shared = docs.sparkSession.sparkContext.broadcast(logs)  # BUCKETS x LANGUAGES floats at most

    def run(it):
        release()
        for batch in batches(it, text_col):
            yield batch.filter(pa.array(~rejected(batch.column(text_col).to_pylist(), shared.value)))
    return docs.mapInArrow(run, docs.schema)
