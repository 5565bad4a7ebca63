"""Periodic runs against a search over every period."""
import hashlib
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import queries, runs
from llm.common import table

SF = Path("/root/testdata/sf0.001")


def all_runs(words, least=2):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items() if e - s >= max(least, 2 * q)), key=lambda r: (r[0], r[2]))


def same(texts):
    found, _, _ = runs.runs_of_texts([" ".join(t).encode() for t in texts], least=2)
    assert [[tuple(map(int, r)) for r in f] for f in found] == [all_runs(list(t)) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=120), max_size=4))
def test_two_words(texts):
    same(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=30), st.integers(1, 12), st.text("abcd", max_size=3)), max_size=4))
def test_powers_with_breaks(parts):
    same(["".join(root * times + tail for root, times, tail in parts)[:700]])


@pytest.mark.parametrize("seed", range(40))
def test_regions_that_meet_out_of_phase(seed):
    """Runs whose first period is itself highly periodic have no pair of equal contexts."""
    rnd = random.Random(seed)
    root = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 5)))
    piece = lambda: root * rnd.randint(12, 60) + root[:rnd.randint(0, len(root))]
    same([piece() + piece(), piece() + piece() + piece(), "xy" + piece() + piece() + "z"])


def test_fibonacci_words():
    a, b = "a", "ab"
    while len(b) < 1500:
        a, b = b, b + a
    same([b[:1200], b[77:700]])


def test_hash_collisions_are_noticed(monkeypatch):
    monkeypatch.setattr(runs._Prefixes, "same", lambda self, a, q, length: np.ones(len(a), bool))
    same(["abcdefghijklmnop" * 5 + "q" * 20, "ab" * 40])


ROWS = [(1, "a b " * 30, "x"), (1, "a b " * 30, "x"), (None, "a " * 14 + "end", "y"), (2, None, None), (3, "", None), (4, " \n\t", None), (5, "one two three", "z"),
        (6, " ".join(f"w{i}" for i in range(5000)) + " ", "long"), (7, ("p q r s t\n" * 9).strip(), None)]


def test_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, runs string")
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(docs).collect())
    want = []
    for i, text, _ in ROWS:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        found = all_runs(words, 12)
        out = {k for s, n, q in found for k in range(s + q, s + n)}
        want.append((str(i), len(words), found, " ".join(w for k, w in enumerate(words) if k not in out)))
    assert got == sorted(want)
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op13_periodic_runs"](spark, str(SF)).collect()}
    docs = table(spark, str(SF), "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    seen = 0
    for doc_id, text in docs:
        words = planted(doc_id, text)
        if len(words) > 4000:  # the search over every period is quadratic
            continue
        found = all_runs(words, 12)
        out = {k for s, n, q in found for k in range(s + q, s + n)}
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        r = got[doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *(best or (None,) * 3))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in found))
        assert r.collapsed_sha256 == sha(" ".join(w for k, w in enumerate(words) if k not in out))
        seen += bool(found)
    assert seen > 5
