"""Language mixtures against a slow version, and the pipeline's stages on empty, unlabelled and oddly named tables."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm import decontaminate, languages, packing, token_files
from llm.common import vocabulary

TEXTS = ["the cat sat on the mat and the dog ran off", "der hund und die katze sitzen auf der matte", "the dog runs und die katze schläft the cat sits der hund läuft on the road",
         "x", "Ünïcode wörds 12 and 34 more", "a  b\n\nc", "the " * 50, "der die das " * 20 + "the cat sat on it " * 9]


def model(samples):
    counts = np.zeros((languages.BUCKETS, len(samples)))
    for k, s in enumerate(samples):
        counts[:, k] = np.bincount(languages.grams([s])[0], minlength=languages.BUCKETS)
    return np.log((counts + 0.5) / (counts.sum(0) + 0.5 * languages.BUCKETS)).astype(np.float32)


LOGS = model(["the cat and the dog sat on the mat while it ran off the road to the sea", "der hund und die katze sitzen auf der matte und die kinder laufen auf der strasse", "el perro y el gato"])


def bucket(a, b, c):
    """The bucket of three code points (0: a space)."""
    m = 2**64
    h = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + c * 0x165667B19E3779F9) % m
    h ^= h >> 29
    return (h * 0xBF58476D1CE4E5B9 % m) >> 48


def slow(text, logs):
    """Shares and gain, one unit, language and round after another."""
    words = "".join(ch if ch.isalpha() else " " for ch in (text or "").lower()).split()
    k = logs.shape[1]
    if not words:
        return [0.0] * k, 0.0
    units, grams = [], 0
    for at in range(0, len(words), languages.UNIT):
        total = [0.0] * k
        for w in words[at:at + languages.UNIT]:
            cs = [0, *map(ord, w), 0]
            for x in zip(cs, cs[1:], cs[2:]):
                grams += 1
                for j in range(k):
                    total[j] += float(logs[bucket(*x), j])
        units.append(total)
    tops = [max(u) for u in units]
    like = [[math.exp(v - t) for v in u] for u, t in zip(units, tops)]

    def em(allowed):
        share = [1 / len(allowed) if j in allowed else 0.0 for j in range(k)]
        for _ in range(languages.ROUNDS):
            new = [0.0] * k
            for u in like:
                z = sum(u[j] * share[j] for j in range(k))
                for j in range(k):
                    new[j] += u[j] * share[j] / z
            share = [x / sum(new) for x in new]
        return share, sum(math.log(sum(u[j] * share[j] for j in range(k))) for u in like)
    share, _ = em(range(k))
    order = sorted(range(k), key=lambda j: -share[j])
    single = [sum(math.log(max(u[j], 1e-300)) for u in like) for j in range(k)]
    lead = max(range(k), key=lambda j: (single[j], -j))
    best, value = [float(j == lead) for j in range(k)], single[lead]
    for size in range(2, k + 1):
        s, v = em(order[:size])
        v -= 0.5 * (size - 1) * math.log(max(len(units), 2))
        if v <= value:
            break
        best, value = s, v
    return best, value + sum(tops) + grams * math.log(languages.BUCKETS)


def test_mixtures_equal_the_slow_version():
    share, gain = languages.solved([*TEXTS, None, "", "12 !"], LOGS)
    for k, text in enumerate([*TEXTS, None, "", "12 !"]):
        s, g = slow(text, LOGS)
        assert np.allclose(share[k], s, atol=1e-4), text
        assert math.isclose(gain[k], g, rel_tol=1e-4, abs_tol=1e-3), text
    assert (share[2] > 0.2).sum() == 2  # two languages


def test_gain_tells_prose_from_gibberish():
    _, gain = languages.solved(["the cat sat on the road", "qxzjk vwqpx zzkqj xqvwz kjqzx"], LOGS)
    assert gain[0] > 0 > gain[1]
    many = model(["the cat and the dog sat on the mat while it ran off the road to the sea " * 20000])
    texts = ["the cat sat", "qxzjk vwqpx zzkqj xqvwz kjqzx", "é", "12", None, "the cat qxzjk"]
    assert languages.rejected(texts, many).tolist() == [False, True, False, True, True, False]
    assert languages.rejected(texts, np.zeros((languages.BUCKETS, 0), np.float32)).tolist() == [False, False, False, True, True, False]


DDL = "doc_id long, text string, lang string, source string, n_chars long"


def test_unlabelled_tables_keep_every_letter(spark):
    docs = spark.createDataFrame([(1, "plain words", None, "s", 1), (2, None, None, "s", 1), (3, "12 !", None, "s", 1), (None, "é", None, None, None)], DDL)
    assert sorted(str(r.doc_id) for r in corpus_pipeline.language(spark, docs, "").collect()) == ["1", "None"]


def test_labels_are_bounded(spark):
    rows = [(k, "the cat and the dog " * 3 if k % 3 else "der hund und die katze " * 3, ("en" if k % 3 else "de") if k < 90 else f"l{k:03d}", "s", 1) for k in range(120)]
    docs = spark.createDataFrame(rows, DDL)
    langs, logs = languages.fit(docs, languages=2)
    assert langs == ["de", "en"] and logs.shape == (languages.BUCKETS, 2)
    assert len(languages.fit(docs)[0]) > 2


@pytest.mark.parametrize("stage", ["language", "near_dedup", "decontamination", "packing"])
def test_empty_and_oddly_named_tables(spark, tmp_path, stage):
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve thirteen")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    run = dict(corpus_pipeline.STAGES)[stage]
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(1, long), (2, long), (3, "other words than those"), (None, "null id"), (3, "one two three four five six seven eight nine ten eleven twelve thirteen")]
    names = ["key", "pipeline_key", "Pipeline_Id", "_id", "id", "component", "term", "hits", "part", "ids", "spread"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit(None).cast("string")} | {c: F.lit(f"<{c}>") for c in names})
    assert run(spark, docs.limit(0), str(tmp_path)).count() == 0
    out = run(spark, docs, str(tmp_path))
    if stage == "packing":
        assert {r.doc_id for r in out.collect()} == {1, 2, 3, None}
        return
    got = out.collect()
    assert all(r[c] == f"<{c}>" for r in got for c in names)
    texts = sorted((str(r.doc_id), r.text[:9]) for r in got)
    every = sorted((str(i), t[:9]) for i, t in rows)
    gone = {"language": [], "near_dedup": [("2", "w0 w1 w2 ")], "decontamination": [("3", "one two t")]}[stage]
    assert texts == [t for t in every if t not in gone]


def test_an_index_of_all_words_serves_a_second_benchmark(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "x y z c d e"), (None, None), (3, "")], "doc_id long, text string")
    index = decontaminate.build_index(docs, None, "doc_id", "text")
    for words in ("c d e", "x y", "nothing here"):
        bench = spark.createDataFrame([("i", words)], "item_id string, text string")
        fresh, old = (sorted(map(str, decontaminate.contamination(docs, bench, size=3, index=x).drop("key").collect())) for x in (None, index))
        assert fresh == old and len(old) == 5


def test_rows_that_repeat_id_and_text_are_dealt_over_parts(spark, monkeypatch):
    docs = spark.range(400).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same words again and again. " * 20).alias("text"))
    monkeypatch.setattr(packing, "PART_BYTES", 1 << 14)
    monkeypatch.setattr(token_files, "PART_BYTES", 1 << 14)
    pieces = packing.pack(docs, vocabulary("word_bpe_49k.json"), end_id=2)
    by = {}
    for r in pieces.collect():
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by) == list(range(len(by)))
    for rows in by.values():
        rows.sort()
        assert [o for o, _ in rows] == [sum(n for _, n in rows[:k]) for k in range(len(rows))] and sum(n for _, n in rows) <= packing.CAPACITY
    blocks = token_files.tokens(docs, vocabulary("byte_bpe_50k.json"), keeps_space=True, end_id=0)
    sizes = [r[0] for r in blocks.groupBy("part").agg(F.sum(F.size("doc_ids")).alias("n")).select("n").collect()]
    assert sum(sizes) == 400 and max(sizes) < 200 and len(sizes) > 4
