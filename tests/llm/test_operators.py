"""Operators on small tables with nulls, ties, repeats and clashing names, against brute force."""
import hashlib
import re
import time
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm import decontaminate, languages, near_dedup, queries, sharding, topk, urls, wrappers

SF = Path("/root/testdata/sf0.001")
LONG = " ".join(f"w{i}" for i in range(3000))
TEXTS = [None, "", " \n", "one two", "One TWO", "É a b c d e f", LONG, LONG + " tail", LONG, "x " * 40, "123 !", "the same text", "the same text"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "key", 7) for i, t in enumerate(TEXTS)] + [(3, "one two", "again", None), (None, LONG, None, None), (None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, shard int")


def all_rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_shards(docs, shards):
    out = sharding.shard(docs, shards).collect()
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in all_rows(docs))
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in out) == want
    by, of_text = {}, {}
    for r in out:
        by.setdefault(r.shard, []).append(r)
        of_text.setdefault((r["size"], r.text_crc32), set()).add(r.shard)
    assert all(len(s) == 1 for s in of_text.values()) and set(by) <= set(range(shards))
    assert all(sorted(r.slot for r in rows) == list(range(len(rows))) for rows in by.values())
    assert sharding.shard(docs.limit(0), shards).count() == 0


def test_capacity_is_the_smallest(spark):
    rng = np.random.default_rng(5)
    for n, k in ((1, 3), (30, 4), (500, 7), (3000, 11)):
        sizes = rng.integers(1, 1000, n)
        ends = np.cumsum(sizes)
        grid = sharding.Grid(spark.createDataFrame([(int(e),) for e in ends], "end long"), int(ends[-1]))

        def feasible(c):
            used, held = 1, 0
            for s in sizes:
                used, held = (used + 1, s) if held + s > c else (used, held + s)
            return used <= k
        cap = sharding.smallest_capacity(grid, k, int(sizes.max()))
        assert feasible(cap) and (cap == sizes.max() or not feasible(cap - 1))
        cuts = [0, *grid.cuts(cap, k)]
        assert cuts[-1] == ends[-1] and set(cuts[1:]) <= {0, *ends.tolist()} and max(np.diff(cuts)) <= cap


def test_urls(spark):
    rules = spark.createDataFrame([*queries.RULES, ("com", "/", "allow"), (None, "/", "block")], "host string, path string, verdict string")
    cases = {"http://EXAMPLE.com/en/x?y": ("example.com/en/", "block"), "https://www.example.com/en/": ("www.example.com/en/", "allow"), "http://a.www.example.com/en/1#x": ("www.example.com/en/", "allow"),
             "http://example.com": (None, "allow"), "http://notexample.com/en/": ("com/", "allow"), "http://a.net/fr/": ("net/fr/", "block"), "http://net/es/": ("net/es/", "block"),
             "no scheme": (None, "allow"), "": (None, "allow"), None: (None, "allow"), "http://x.org/" + "a/" * 5000: (None, "allow")}
    pages = spark.createDataFrame([(1, u, "h") for u in cases], "page_id long, url string, host string")
    out = urls.verdicts(pages.union(pages), rules).collect()
    assert len(out) == 2 * len(cases)
    want = sorted(str(v) for v in cases.values() for _ in range(2))
    assert sorted(str((r.rule, r.verdict)) for r in out) == want
    assert {(r.rule, r.verdict) for r in urls.verdicts(pages, rules.limit(0)).collect()} == {(None, "allow")}
    assert urls.verdicts(pages.limit(0), rules).count() == 0


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows, similarity):
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                a, b = comp[i], comp[j]
                comp = [b if c == a else c for c in comp]
    first = {}
    for (d, _), c in zip(rows, comp):
        first[c] = min(first.get(c, 2**63), 2**63 - 1 if d is None else d)
    return sorted(str((d, len(s), None if first[c] == 2**63 - 1 else first[c])) for (d, _), s, c in zip(rows, sets, comp))


def test_near_duplicates(spark, docs):
    rng = np.random.default_rng(6)
    base = [f"b{i}" for i in range(150)]
    rows = all_rows(docs)
    for k in range(60):  # one large group of near copies with more and more changes
        w = list(base)
        for at in rng.choice(150, k // 6, replace=False):
            w[at] = f"n{k}_{at}"
        rows.append((100 + k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("id", F.lit(2))
    out = near_dedup.near_duplicates(df, 85).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in out) == brute_components(rows, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_contamination_matches_sql(spark, docs, tmp_path):
    items = [(1, " ".join(f"W{i}" for i in range(10, 40))), (2, "one two"), (30, "ONE"), (4, None), (5, "..."), (6, "x " * 14), (7, "x x x"), (8, "w10 w12")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs.select("doc_id", "text").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    bench.coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    cur = con.execute(queries.ORACLE["op3_decontamination"])
    names = [c[0] for c in cur.description]
    got = decontaminate.contamination(docs, bench)
    assert sorted(map(str, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(str, cur.fetchall()))
    assert got.filter("contaminated").count() > 0
    none = decontaminate.contamination(docs, bench.limit(0)).collect()
    assert {(r.n_hit, r.items_sha256, r.contaminated) for r in none} == {(0, hashlib.sha256(b"").hexdigest(), False)}
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


def test_near_terms(spark):
    docs = spark.createDataFrame([(1, "a x x b c"), (2, "c a b"), (3, "a x x x x x b c"), (4, "a b")], "doc_id long, text string")
    asked = spark.createDataFrame([(9, ["a", "b", "c"])], "query long, words array<string>")
    index = decontaminate.build_index(docs, decontaminate.vocabulary(asked), "doc_id", "text")
    found = decontaminate.near(index, asked, 2).join(index.filter("id IS NOT NULL").select("key", "id"), "key")
    assert {r.id for r in found.collect()} == {1, 2}


def test_languages(spark):
    rng = np.random.default_rng(7)
    vocab = {"aa": ["alpha", "beta", "gamma", "delta"], "bb": ["zorko", "vilni", "quazt", "wyxum"]}
    rows = [(i, " ".join(rng.choice(vocab[lang], 30)), lang) for i, lang in enumerate(["aa", "bb"] * 60)]
    odd = [(1000, None, "aa"), (1001, "123 ... ", "bb"), (1002, "", None), (None, "alpha beta", "bb"), (1003, "alpha beta gamma delta " * 60 + "zorko vilni quazt wyxum " * 30, None), (1003, "É", None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    out = languages.predict(docs, *languages.fit(docs)).collect()
    got = [(r.doc_id, r.lang_pred) for r in out]
    assert all((i, lang) in got for i, _, lang in rows) and {(1000, "und"), (1001, "und"), (1002, "und"), (None, "aa")} <= set(got)
    mixed = next(r for r in out if r.doc_id == 1003 and len(r.shares) > 1)
    assert mixed.lang_pred == "aa" and abs(mixed.score - 2 / 3) < 0.05
    assert languages.accepted(docs, *languages.fit(docs)).count() == len(rows) + 3
    assert {r.lang_pred for r in languages.predict(docs, *languages.fit(docs.limit(0))).collect()} == {"und"}
    assert languages.predict(docs.limit(0), *languages.fit(docs)).count() == 0


@pytest.mark.parametrize("n", [3, 400])
def test_topk(spark, n):
    rng = np.random.default_rng(8)
    v = np.round(rng.normal(size=(n, 6)), 2)
    v[n // 2:n // 2 + n // 3] = v[0]  # ties
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(v)]
    bad = [(5000, None), (5050, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (5100, [float("nan")] * 6), (5150, [float("inf")] * 6), (None, rows[0][1]), (0, rows[0][1])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = sorted(map(tuple, topk.search(df, F.col("id") % 50 == 0).select("query_id", "rank", "vec_id", "score").collect()))
    q = np.floor(v * 256).astype(np.int64)
    want = []
    for i in range(0, n, 50):
        s = q @ q[i]
        want += [(i, k + 1, int(j), int(s[j])) for k, j in enumerate([j for j in np.lexsort((np.arange(n), -s)) if j != i][:5])]
    assert got == sorted(want)
    assert topk.search(df.limit(0), F.col("id") % 50 == 0).count() == 0


def test_topk_of_large_components(spark, monkeypatch):
    """Scores are exact up to 2**61, also where several chunks of queries and blocks of rows meet; beyond that there is an error, not a wrong order."""
    monkeypatch.setattr(topk, "QUERY_BYTES", 200)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    rng = np.random.default_rng(9)
    v = rng.integers(-1_500_000, 1_500_000, (200, 5)).astype(float)
    v[:20] = rng.integers(-1_000, 1_000, (20, 5))
    v[50] = [1.9e6, -1.9e6, 1, 0, 2]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(300, [1.0, 0.0]), (301, [1e8, 0.0]), (302, [2e8, 0.0]), (303, [-1e9, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.search(df, F.col("id") % 50 == 0).collect()))
    want = []
    for i, q in rows:
        if i % 50 == 0:
            scores = sorted((-sum(int(a * 256) * int(b * 256) for a, b in zip(q, r)), j) for j, r in rows if j != i and len(r) == len(q))
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scores[:5])]
    assert got == sorted(want)
    assert [(r[2], r[3]) for r in got if r[0] == 300][:2] == [(302, 13107200000000), (301, 6553600000000)]
    with pytest.raises(ValueError, match="may not fit"):
        topk.search(spark.createDataFrame([(0, [1e9]), (1, [1e9])], "vec_id long, embedding array<double>"), F.col("id") % 50 == 0)
    with pytest.raises(Exception, match="does not fit a long"):
        topk.search(spark.createDataFrame([(0, [1.0]), (1, [1e30])], "vec_id long, embedding array<double>"), F.col("id") % 50 == 0)


def test_urls_of_very_many_labels(spark):
    """64 KB of labels end in no time: only suffixes as long as rules' hosts are formed."""
    rules = spark.createDataFrame(queries.RULES, "host string, path string, verdict string")
    hosts = ["a." * 32_000 + "example.com", "a." * 32_000 + "net", "b" * 60_000, ".".join(["example.com"] * 5000)]
    pages = spark.createDataFrame([(k, f"http://{h}/en/") for k, h in enumerate(hosts)], "page_id long, url string")
    start = time.monotonic()
    got = {r.page_id: (r.rule, r.verdict) for r in urls.verdicts(pages, rules).collect()}
    assert got == {0: ("example.com/en/", "block"), 1: (None, "allow"), 2: (None, "allow"), 3: ("example.com/en/", "block")}
    assert time.monotonic() - start < 30


PAGE = """<html><head><title>t</title><style>p{}</style><script>var t="<p>no</p>";</script></head><body><header>Site</header><nav><ul><li><a href=x>One</a><li>Two</ul></nav>
<aside class="sidebar"><p>side</p></aside><div id="cookie-notice">We use cookies</div><article><h1>Head %d</h1><p>First <b>bold</b>&amp;  more<br>line<p>Second&nbsp;%d%s
<div class="ad">Buy</div><form>mail <input></form><!-- c --><section class="comments"><p>nice</p></section></article><footer>&copy;</footer>"""


def test_pages(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 2}.org/{i}", PAGE % (i, i, "<ul><li>a</li><li>b</li></ul>" if i % 3 == 0 else ""), "k") for i in range(12)]
                                  + [(50, None, None, "k"), (51, "http://h0.org/", "", "k"), (51, "x", "<p>plain" + " y" * 50000, None)], "page_id long, url string, html string, keep string")
    out = {(r.page_id, r.url): r for r in wrappers.main_text(pages).collect()}
    assert len(out) == 15
    for i in range(12):
        text = out[i, f"http://h{i % 2}.org/{i}"].text
        assert text == f"Head {i} First bold& more line Second {i}" + (" a b" if i % 3 == 0 else "")
    assert out[50, None].text == "" and out[51, "http://h0.org/"].n_chars == 0 and out[51, "x"].n_chars == 100005
    assert wrappers.main_text(pages.limit(0)).count() == 0


def texts_of(spark, rows):
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in wrappers.main_text(pages).collect()}


def test_pages_of_two_templates(spark):
    old = [("http://h.org/", f"<div class=body><p>old {i} text</p></div>") for i in range(3)]
    new = [("http://h.org/", f"<article><p>new {i} text</p></article>") for i in range(3)]
    assert texts_of(spark, old + new) == {**{i: f"old {i} text" for i in range(3)}, **{3 + i: f"new {i} text" for i in range(3)}}
    assert texts_of(spark, [(None, "<main><p>a</p></main>"), ("no scheme", "<p>b</p>"), (None, "<div>c</div>")]) == {0: "a", 1: "b", 2: "c"}


def test_copied_pages_keep_their_text(spark):
    """The same pages once or many times, on hosts of 1 and 3 different pages; text that all pages share goes at every size."""
    body = lambda h, i: f"<div class=top>Site {h}</div><div class=body><p>text {h} {i}</p></div>"
    rows = [(f"http://h{n}.org/", body(n, 0)) for n in (1, 4, 20) for _ in range(n)] + [("http://k.org/", body("k", i)) for i in range(3) for _ in range(15)] + [("http://l.org/", body("l", i)) for i in range(2)]
    got = texts_of(spark, rows)
    assert {got[k] for k in range(25)} == {f"Site {n} text {n} 0" for n in (1, 4, 20)}
    assert [got[25 + k] for k in range(45)] == [f"text k {k // 15}" for k in range(45)] and [got[70], got[71]] == ["text l 0", "text l 1"]


def test_fixed_text_in_a_slot_of_many(spark):
    """A notice with the tag path of the body goes, the body paragraphs stay; slots are places of the wrapper."""
    rows = [("http://h.org/", f"<div><p>All pages say this</p><p>one {i}</p><p>two {i}</p></div>") for i in range(6)]
    assert texts_of(spark, rows) == {i: f"one {i} two {i}" for i in range(6)}


def test_trees_find_their_places():
    def tree(html):
        return wrappers.bare(wrappers.fold(wrappers.Page(html).tree[2]))
    trees = [tree(h) for h in ("<h1>a</h1><p>b</p>", "<div>n</div><h1>a</h1><p>b<p>c<p>d", "<h1>a</h1><ul><li>x</ul><div>e</div>", "text<p>x</p>")]
    wrapper = trees[0]
    for t in trees[1:]:
        wrapper = wrappers.align(wrapper, t)
    slots = len(wrappers.slots_of(wrapper))
    for t in trees:
        at = wrappers.place(t, wrapper)
        assert len(at) == len(wrappers.slots_of(t)) and at == sorted(set(at)) and at[-1] < slots
    assert wrappers.place(tree("<h3>z</h3>"), wrapper) is None


def test_fold_and_align():
    leaf = lambda *names: [[n, "1", []] for n in names]
    assert wrappers.expression(["", "1", wrappers.fold(leaf("a", "b", "a", "b", "c", "c"))]) == "(<a></> <b></>)+ (<c></>)+"
    assert wrappers.expression(["", "1", wrappers.align(leaf("a", "b"), leaf("a", "x", "b"))]) == "<a></> (<x></>)? <b></>"


def test_one_row_of_each_group_stays(spark):
    """Groups of near-copies whose smallest id is null or repeated."""
    text = lambda g, k: " ".join([f"{g}{i}" for i in range(100)] + [f"end{k}"])
    rows = [(None, text("a", k), "x") for k in range(4)] + [(7, text("b", k % 3), "x") for k in range(6)] + [(7, text("c", 0), "x"), (8, text("c", 1), "x"), (None, text("c", 2), "x"), (None, text("d", 0), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = corpus_pipeline.dedup(spark, docs, "")
    assert sorted((str(r.doc_id), r.text[0]) for r in out.collect()) == [("7", "b"), ("7", "c"), ("None", "a"), ("None", "d")] and out.columns == docs.columns


@pytest.mark.skipif(not SF.exists(), reason="driver tables are not here")
def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    kept = corpus_pipeline.language(spark, docs, str(SF))
    assert {r.doc_id for r in kept.collect()} == {i for i, t in rows.items() if t and any(c.isalpha() for c in t)} and kept.columns == docs.columns
    one = corpus_pipeline.dedup(spark, kept, str(SF))
    left = [(i, t) for i, t in sorted(rows.items()) if t and any(c.isalpha() for c in t)]
    want = [eval(s) for s in brute_components(left, 80)]
    ids = {i for i, _, c in want if i == c}
    assert {r.doc_id for r in one.collect()} == ids and one.columns == docs.columns
    clean = corpus_pipeline.decontamination(spark, one, str(SF))
    con = duckdb.connect()
    bad = con.execute(f"WITH documents AS (SELECT * FROM '{SF}/documents.parquet'), benchmark AS (SELECT * FROM '{SF}/benchmark.parquet'), o AS ({queries.ORACLE['op3_decontamination'].replace('WITH', 'WITH', 1)}) SELECT doc_id FROM o WHERE contaminated").fetchall()
    assert {r.doc_id for r in clean.collect()} == ids - {b[0] for b in bad} and clean.columns == docs.columns
    packed = corpus_pipeline.pack(spark, clean, str(SF))
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids - {b[0] for b in bad}
