"""Token ids, packing, counts and files against the library and brute force."""
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm import packing, token_counts, token_files
from llm.encoding import Encoder
from llm.common import vocabulary

ODD = ["", " ", "a", "Hello  world\n\nX", "l'été d'Été. It's  fine\t\tyes", "a b c", "x\x1cy .\x1c z", "end  ", "\n\n a\r\nb",
       "<|endoftext|> x<|startoftext|>y", "日本語 テキスト　です", "naïve é    q", "…“quoted”…", "1234 56,7%", "A" * 3000, None, "ΑΣ ΑΣ. 'll", "a   b  \n c"]
DOCS = [(i, t, "clash") for i, t in enumerate(ODD)] + [(3, "again", "x"), (3, "again", "x"), (None, "no id", None)]


def word_ids(t):
    return WORD.tokenizer.encode(t or "", add_special_tokens=False).ids


def byte_ids(t):
    return BYTE.tokenizer.encode(t or "", add_special_tokens=False).ids


WORD, BYTE = Encoder(vocabulary("word_bpe_49k.json"), False), Encoder(vocabulary("byte_bpe_50k.json"), True)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(), st.text(alphabet=" \n\t ab.'1é")), max_size=4))
def test_pieces_give_the_ids_of_the_whole_text(texts):
    for enc, want in ((WORD, word_ids), (BYTE, byte_ids)):
        ids, n = enc.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])][:len(texts)] == [want(t) for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, part string")


def test_pack(spark, docs):
    out = packing.pack(docs, vocabulary("word_bpe_49k.json"), end_id=2).collect()
    joined = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.length and crc(np.frombuffer(r.ids, "<u4")) == r.ids_crc32
        joined.setdefault(r.sequence_id, []).append(r)
    for rows in joined.values():
        at = 0
        for r in rows:
            assert r.offset == at
            at += r.length
        assert at <= 4096
    assert sorted(joined) == list(range(len(joined)))
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.doc_tokens) for r in out if r.start == 0)
    assert got == sorted((i is not None, i or 0, len(word_ids(t)) + 1) for i, t, _ in DOCS)
    assert packing.pack(docs.limit(0), vocabulary("word_bpe_49k.json"), end_id=2).count() == 0


def slow_cost(ends, prices, capacity):
    cost = {0: 0}
    for j, (e, p) in enumerate(zip(ends, prices)):
        cost[e] = min(c + capacity - (e - b) + p for b, c in cost.items() if e - b <= capacity and b < e)
    return cost[ends[-1]]


def test_cuts_are_the_cheapest():
    rng = random.Random(1)
    for _ in range(200):
        gaps = [rng.randint(1, 9) for _ in range(rng.randint(1, 40))]
        ends, prices = np.cumsum(gaps), np.array([rng.randint(0, 6) for _ in gaps])
        cuts = packing.best_cuts(ends, prices, 12)
        begin, got = 0, 0
        for k in cuts:
            assert ends[k] - begin <= 12
            got += 12 - (ends[k] - begin) + prices[k]
            begin = ends[k]
        assert begin == ends[-1] and got == slow_cost(ends.tolist(), prices.tolist(), 12)


def test_long_sentence_can_be_cut(spark):
    one = spark.createDataFrame([(1, "word " * 9000)], "doc_id long, text string")
    out = packing.pack(one, vocabulary("word_bpe_49k.json"), end_id=2).collect()
    assert sum(r.length for r in out) == 9001 and max(r.length for r in out) <= 4096 and len(out) == 3


def greedy(word, vocab):
    n = at = 0
    while at < len(word):
        k = next((k for k in range(len(word), at, -1) if word[at:k] in vocab), None)
        if k is None:
            return 1
        n, at = n + 1, k
    return n


def test_longest_match_counts():
    rng = random.Random(2)
    for _ in range(300):
        pieces = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))]
        a = token_counts.Automaton(pieces)
        for _ in range(20):
            w = bytes(rng.choice(b"abcd" if rng.random() < 0.1 else b"abc") for _ in range(rng.randint(1, 14)))
            assert a.count(w) == greedy(w, set(pieces)), (pieces, w)


def test_counts(spark, docs):
    path = vocabulary("byte_bpe_50k.tiktoken")
    vocab = set(token_counts.read_vocabulary(path))
    got = sorted(map(tuple, token_counts.counts(docs, path).collect()), key=str)
    words = [(i, [w for w in __import__("re").split("[ \t\n\r\x0b\x0c]+", t or "") if w]) for i, t, _ in DOCS]
    assert got == sorted(((i, len(w), sum(greedy(b" " + x.encode(), vocab) for x in w)) for i, w in words), key=str)


def test_code_lengths():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 5, 40, 300):
        c = rng.integers(1, 10**6, n) if n % 2 else 1 + np.cumsum(np.cumsum(np.ones(n, np.int64)))
        lengths = token_files.code_lengths(c, 12)
        assert lengths.max() <= 12 and (n == 1 or np.sum(2.0 ** -lengths) == 1)
        import heapq
        heap, cost = sorted(c.tolist()), 0
        while len(heap) > 1:
            s = heapq.heappop(heap) + heapq.heappop(heap)
            cost += s
            heapq.heappush(heap, s)
        if n in (2, 3, 5):  # the limit doesn't bind
            assert (lengths * c).sum() == cost
    fib = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55])
    best = min((sum(a * b for a, b in zip(sorted(ls, reverse=True), fib)) for ls in kraft(len(fib), 5)))
    assert (token_files.code_lengths(fib, 5) * fib).sum() == best


def kraft(n, limit):
    def go(k, least, room):
        if k == 0:
            if room == 0:
                yield ()
            return
        for x in range(least, limit + 1):
            if k * 2 ** (limit - x) >= room >= 2 ** (limit - x):
                for rest in go(k - 1, x, room - 2 ** (limit - x)):
                    yield (x, *rest)
    return go(n, 1, 2 ** limit)


def test_code_round_trip():
    rng = np.random.default_rng(4)
    for n in (1, 2, 255, 256, 257, 5000):
        ids = np.minimum(rng.geometric(0.01, n), 2000).astype(np.uint32)
        code = token_files.Code(u := np.unique(ids).astype(np.int64), token_files.code_lengths(np.bincount(ids)[u]))
        bits, marks = code.encode(ids)
        assert (code.decode(bits, marks, n) == ids).all()


def test_file(spark, docs):
    blocks = token_files.tokens(docs, vocabulary("byte_bpe_50k.json"), True, 0)
    file, lengths = token_files.write(blocks, token_files.learn_code(blocks))
    got = sorted(map(tuple, token_files.digests(token_files.read(file, lengths), file).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted([i for i, _, _ in DOCS], key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        assert r[1] == at
        at += r[2]
    assert sorted((r[0] is not None, r[0] or 0, r[2], r[3]) for r in got) == sorted((i is not None, i or 0, len(byte_ids(t)) + 1, crc([*byte_ids(t), 0])) for i, t, _ in DOCS)
    empty = token_files.tokens(docs.limit(0), vocabulary("byte_bpe_50k.json"), True, 0)
    file, lengths = token_files.write(empty, token_files.learn_code(empty))
    assert token_files.read(file, lengths).count() == 0


def test_odd_pieces_side_by_side():
    """Marks, wide and doubled white space, special tokens and foreign letters in any order."""
    rng, some = random.Random(5), ["a", "B", "é", "É", "×", "ß", "İ", " ", "  ", "\n", "\t", "\xa0", " ", "　", "\x85", "\x1c", "\r", ".", ",", "!", ";", "'s", "'", "中", "़",
                                   "<|", "<|endoftext|>", "<PAD>", "1", "23", "-", "…", "the", "Word", "ÅÖ", "\U0001f600", "​", "ﬁ", "_"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    for enc in (WORD, BYTE):
        ids, n = enc.encode(texts)
        want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert n.tolist() == [len(w) for w in want] and ids.tolist() == [k for w in want for k in w]


def test_counts_of_an_empty_table(spark, docs):
    assert token_counts.counts(docs.limit(0), vocabulary("byte_bpe_50k.tiktoken")).count() == 0
