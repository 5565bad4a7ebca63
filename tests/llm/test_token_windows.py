"""Alignment of two tokenizers against the library's tokens and their byte ranges one by one."""
import hashlib
import random
from collections import Counter, defaultdict
from functools import cache
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import queries, token_windows
from llm.common import table, vocabulary
from llm.encoding import byte_letters

SF = Path("/root/testdata/sf0.001")
A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


@cache
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B), {c: b for b, c in byte_letters().items()}


def tokens(text):
    """(id, bytes) of both tokenizers, or none."""
    a, b, letters = libraries()
    if not text:
        return [], []
    one = [(k, bytes(letters[c] for c in a.id_to_token(k))) for k in a.encode(" " + text, add_special_tokens=False).ids]
    two = []
    for k in b.encode(text):
        p = b.id_to_piece(k)
        two.append((k, bytes.fromhex(p[3:5]) if b.is_byte(k) else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (one, two) if b"".join(x for _, x in one) == whole == b"".join(x for _, x in two) else ([], [])


def aligned(text):
    one, two = tokens(text)
    spans = []
    for side in (one, two):
        at = 0
        spans.append([])
        for k, x in side:
            spans[-1].append((k, at, at + len(x)))
            at += len(x)
    links = [(a, b) for a, s, e in spans[0] for b, s2, e2 in spans[1] if s < e2 and s2 < e]
    both = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
    groups, lo = [], 0
    for hi in both:
        groups.append("|".join(",".join(str(k) for k, s, e in side if lo <= s and e <= hi) for side in spans))
        lo = hi
    return len(one), len(two), groups, links


def expected(texts):
    each = [aligned(t) for t in texts]
    held = Counter(p for *_, links in each for p in set(links))
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    return [(n_a, n_b, len(groups), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "") for n_a, n_b, groups, links in each]


TEXTS = [None, "", " ", "  two  spaces ", "plain words, and more.", "plain words, and more.", "▁marked ▁", "<|endoftext|> <s> </s> <unk> <0x41>", "naïve 日本語 text\n\n\tnext 👩‍👩‍👧 line",
         "x" * 3000, "ab " * 2000, "nospace" * 300, "tab\tand\x00null", "end ", " sep space", "a▁b c"]


def test_rows(spark):
    rows = [(k, t, "x", 1) for k, t in enumerate(TEXTS)] + [(4, "plain words, and more.", "y", None), (None, "words again", None, None), (None, None, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, groups string, row int")
    got = token_windows.alignments(docs, A, B)
    seen = sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, sorted((p.a, p.b, p.n) for p in r.pairs)) for r in got.collect())
    want = []
    for k, t, *_ in rows:
        n_a, n_b, groups, links = aligned(t)
        want.append((str(k), n_a, n_b, len(groups), len(links), ";".join(groups), sorted((a, b, n) for (a, b), n in Counter(links).items())))
    assert seen == sorted(want)
    assert token_windows.alignments(docs.limit(0), A, B).count() == 0
    assert token_windows.pair_counts(got.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(list("ab c.é日\n\t▁'1<|>") + [" the", " of", "ing "]), min_size=1, max_size=60).map("".join), min_size=1, max_size=5))
def test_any_text(texts):
    token = token_windows.aligner(A, B)
    fits, n_a, n_b, n_groups, n_links, groups, (which, a, b, n) = token.align(texts)
    want = [aligned(t) for t in texts]
    assert fits.tolist() == [bool(w[0]) for w in want]
    want = [w for w in want if w[0]]
    assert [(x, y, g, k, s) for x, y, g, k, s in zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), n_links.tolist(), groups.to_pylist())] == [(w[0], w[1], len(w[2]), len(w[3]), ";".join(w[2])) for w in want]
    assert sorted(zip(which.tolist(), a.tolist(), b.tolist(), n.tolist())) == sorted((k, x, y, c) for k, w in enumerate(want) for (x, y), c in Counter(w[3]).items())


def test_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(token_windows, "KEPT_WINDOWS", 5)
    token, rnd = token_windows.Aligner(token_windows.ByteLevel(A), token_windows.Pieces(B)), random.Random(3)
    for _ in range(6):
        text = " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 9))) for _ in range(40))
        *_, groups, _ = token.align([text])
        assert groups.to_pylist() == [";".join(aligned(text)[2])]


@pytest.mark.parametrize("broadcast", [True, False])
def test_query_equals_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(token_windows, "COUNT_BYTES", 0)
    rows = {r.doc_id: r for r in queries.QUERIES["op12_token_alignment"](spark, str(SF)).collect()}
    docs = [(r.doc_id, r.text) for r in table(spark, str(SF), "documents").select("doc_id", "text").collect()]
    assert len(rows) == len(docs)
    small = {k: t for k, t in docs}
    want = fast_expected(list(small.values()))
    for (k, _), w in zip(small.items(), want):
        assert tuple(rows[k][1:]) == w, k


def fast_expected(texts):
    """As ``expected``, with ranges met by a merge: whole documents are too long for all pairs of tokens."""
    each = []
    for t in texts:
        one, two = tokens(t)
        links, groups, i, j, ga, gb = [], [], 0, 0, [], []
        at, ea = 0, []
        for _, x in one:
            at += len(x)
            ea.append(at)
        at, eb = 0, []
        for _, x in two:
            at += len(x)
            eb.append(at)
        while i < len(one) and j < len(two):
            links.append((one[i][0], two[j][0]))
            if not ga or ga[-1][0] != i:
                ga.append((i, str(one[i][0])))
            if not gb or gb[-1][0] != j:
                gb.append((j, str(two[j][0])))
            if ea[i] == eb[j]:
                groups.append(",".join(s for _, s in ga) + "|" + ",".join(s for _, s in gb))
                i, j, ga, gb = i + 1, j + 1, [], []
            elif ea[i] < eb[j]:
                i += 1
            else:
                j += 1
        each.append((len(one), len(two), groups, links))
    held = Counter(p for *_, links in each for p in set(links))
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    return [(n_a, n_b, len(groups), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "") for n_a, n_b, groups, links in each]


def test_merge_agrees_with_all_pairs():
    assert fast_expected(TEXTS) == expected(TEXTS)
