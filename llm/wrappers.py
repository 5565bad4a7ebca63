"""Main text of web pages through wrappers inferred for each host.

A page is read into a tree of block elements and text slots. Repeated neighbours, single or in groups, are folded into repeated groups; the
trees of a host are then aligned one after another, children against children, and what only one side has becomes optional.
The result is a union-free expression: elements, text slots, optional and repeated groups, no alternatives. Each page's tree is then placed in
its host's wrapper, which gives every block of text the slot it fills. On a page with blocks inside an article or main, these are the text. On any other page the text is
what varies: slots of links go, and in each slot the texts that a share of the different pages have in common (fixed text of the template) go, be it one of several
paragraphs of a repeated slot. Element names (OUTSIDE) are a prior: blocks below them are no candidates. So are the words of classes, ids and roles (OUTSIDE_WORDS), but only of
elements below the article, or on pages without one, never of what holds an article or is one, and never where they would leave a page without candidates.

Pages of a host are first reduced to different folded trees, so a host with a third of all pages costs few alignments; trees of one host are aligned in groups of bounded
size and the results again. Slot statistics are exact counts over the different pages of a host, so copies of a page count once.

Defined cases: a null html is empty; a null url has the empty host; a page without kept slots has an empty text; repeated and null ids are rows of their
own; unclosed and misplaced tags end where the next fitting element ends, and quotes that would swallow the rest of the page mean nothing; elements deeper than DEEPEST count
as children of the one at that depth; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import html as entities
import json
import re
from bisect import bisect_left
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import small, stored
from llm.encoding import batches
from llm.urls import host_of

#: Trees that are aligned in a task at a time.
TOGETHER = 48
#: A text is fixed in a slot if at least one in FIXED of the other different pages that fill the slot have it too.
FIXED = 4

_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_PLAIN = re.compile(r"[^\"'>]*")
#: Elements skipped with all they hold; of CODE also what follows an unclosed one is no text.
SKIPPED = frozenset("script style template noscript svg math iframe object canvas select textarea button".split())
CODE = frozenset({"script", "style"})
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in SKIPPED}
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening element ends an open one of these kinds among its nearest ancestors.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements, and words in classes, ids and roles, that hold no article text.
OUTSIDE = frozenset("head nav header footer aside form dialog menu fieldset".split())
OUTSIDE_WORDS = frozenset("""ad ads adv advert adverts advertisement promo promotion promoted sponsor sponsored banner cookie cookies consent gdpr notice notices popup modal overlay newsletter
 subscribe signup login share sharing social related recommended recommendations sidebar side menu nav navigation navbar breadcrumb breadcrumbs footer header masthead comment comments
 reply replies respond disqus discussion search widget copyright legal pagination pager toolbar skip complementary contentinfo alert""".split())
WITHIN = frozenset({"article", "main"})


#: Elements below this depth are read as children of the one there; neighbours in a repeated group; cells of an exact alignment.
DEEPEST, GROUP, CELLS = 128, 64, 250_000


def scan(source: str):
    """The texts, as (None, text, False), and the tags, as (name, attributes, whether it closes), of a page in one pass that never goes back."""
    at, size, loose = 0, len(source), False
    without: set[str] = set()  # elements, and quotes, that nothing closes from here on
    while at < size:
        here = source.find("<", at)
        if here != at:
            yield None, source[at:here if here >= 0 else size], False
            if here < 0:
                return
        if source.startswith("<!--", here):
            end = source.find("-->", here + 4)
            at = end + 3 if end >= 0 else size
            continue
        if source.startswith(("<!", "<?"), here):
            end = source.find(">", here)
            at = end + 1 if end >= 0 else size
            continue
        tag = _OPEN.match(source, here)
        if tag is None:
            yield None, "<", False
            at = here + 1
            continue
        end = tag.end() if not loose else source.find(">", tag.end())
        while not loose and (end := _PLAIN.match(source, end).end()) < size and source[end] != ">":
            quote = source[end]
            closed = -1 if quote in without else source.find(quote, end + 1)
            if closed < 0:
                without.add(quote)
            end = closed + 1 if closed >= 0 else end + 1
        if not loose and end >= size:  # quotes swallow the rest: from here on they mean nothing
            loose, end = True, source.find(">", tag.end())
        if end < 0:
            yield None, source[here:], False
            return
        name, attributes, at = tag[2].lower(), source[tag.end():end], end + 1
        if tag[1] or name not in SKIPPED:
            yield name, attributes, bool(tag[1])
            continue
        if name in ("svg", "math") and attributes.endswith("/"):
            continue
        close = None if name in without else _CLOSE[name].search(source, at)
        if close:
            at = close.end()
        else:
            without.add(name)
            at = size if name in CODE else at


class Page:
    """Blocks (path, text, characters in links) and the tree of a page."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, str, int]] = []  # in the tree, a slot's fourth entry has the numbers of its blocks
        root = ["", "1", []]
        stack, names = [root], [""]  # names goes on below DEEPEST, where the tree does not
        is_open: Counter = Counter()
        self.tree, self._text, self._links = root, [], 0
        links = 0

        def leave(depth: int) -> None:
            is_open.subtract(names[depth:])
            del names[depth:], stack[depth:]
        for name, said, closes in scan(source):
            if name is None:
                self._text.append(said)
                if links:
                    self._links += len(said)
                continue
            if name == "a":
                links = 0 if closes else 1
            if name in INLINE:
                continue
            if name == "br":
                self._text.append(" ")
                continue
            self._flush(stack)
            if name in VOID or name in ("html", "body"):
                continue
            if closes:
                if is_open[name] > 0:  # else nothing to close, however deep the page is
                    leave(next(k for k in range(len(names) - 1, 0, -1) if names[k] == name))
                continue
            ended = ENDS.get(name, set()) | {"p"}
            while names[-1] in ended:
                leave(len(names) - 1)
            names.append(name)
            is_open[name] += 1
            if len(stack) <= DEEPEST:
                node = [label(name, said), "1", []]
                stack[-1][2].append(node)
                stack.append(node)
        self._flush(stack)

    def _flush(self, stack: list) -> None:
        text = " ".join(entities.unescape("".join(self._text)).split()) if self._text else ""
        if text:
            self.blocks.append(("/".join(n[0] for n in stack[1:]), text, self._links))
            stack[-1][2].append(["#", "1", [], [len(self.blocks) - 1]])
        self._text, self._links = [], 0


def label(name: str, attributes: str) -> str:
    """The element with the words of its class, id and role, without digits."""
    return _label(name, attributes) if len(attributes) < 500 else _label.__wrapped__(name, attributes)


@lru_cache(1 << 14)
def _label(name: str, attributes: str) -> str:
    said = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes or ""))
    words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", said).lower())
    return ".".join([name, *dict.fromkeys(words)])


def fold(children: list) -> list:
    """Neighbours that repeat become one repeated node; groups of up to GROUP become a node labelled by its members."""
    for c in children:
        c[2] = fold(c[2])
    size = 1
    while size * 2 <= len(children) and size <= GROUP:
        if not repeats(children, size):
            size += 1
            continue
        out, k = [], 0
        while k < len(children):
            unit, j = children[k:k + size], k + size
            names = [c[0] for c in unit]
            while len(unit) == size and [c[0] for c in children[j:j + size]] == names:
                unit = [merge(a, b) for a, b in zip(unit, children[j:j + size])]
                j += size
            if j > k + size:
                out.append([unit[0][0], _many(unit[0][1]), *unit[0][2:]] if size == 1 else ["(" + ",".join(names) + ")", "+", unit])
                k = j
            else:
                out.append(children[k])
                k += 1
        children, size = out, 1
    return children


def repeats(children: list, size: int) -> bool:
    """Whether ``size`` neighbours somewhere equal the next ``size`` by their labels."""
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(c[0], len(numbers)) for c in children), np.int64, len(children))
    same = np.concatenate([[0], np.cumsum(ids[:-size] == ids[size:])])
    return bool((same[size:] - same[:-size] == size).any())


def _many(mult: str) -> str:
    return "*" if mult in "?*" else "+"


def _maybe(mult: str) -> str:
    return {"1": "?", "+": "*"}.get(mult, mult)


def merge(a: list, b: list) -> list:
    """The narrowest node that covers both; they have one label."""
    mult = "*" if {a[1], b[1]} & {"*"} or {a[1], b[1]} == {"+", "?"} else "+" if "+" in (a[1], b[1]) else "?" if "?" in (a[1], b[1]) else "1"
    for more in a[3:]:
        more.extend(b[3])
    return [a[0], mult, align(a[2], b[2]), *a[3:]]


def align(xs: list, ys: list) -> list:
    """Longest common run of labels; the rest becomes optional."""
    out: list = []
    i = j = 0
    for a, b in [*matches([x[0] for x in xs], [y[0] for y in ys]), (len(xs), len(ys))]:
        out += [[x[0], _maybe(x[1]), *x[2:]] for x in xs[i:a]] + [[y[0], _maybe(y[1]), *y[2:]] for y in ys[j:b]]
        if a < len(xs):
            out.append(merge(xs[a], ys[b]))
        i, j = a + 1, b + 1
    return out


def matches(xs: list[str], ys: list[str]) -> list[tuple[int, int]]:
    """Pairs of places with equal labels, ascending on both sides: as many as can be while the table of a full comparison has up to CELLS cells; beyond
    that what the labels that occur once on either side allow, and between them again."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(xs), 0, len(ys))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and xs[a] == ys[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and xs[b - 1] == ys[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        if (b - a) * (d - c) <= CELLS:
            out += [(a + i, c + j) for i, j in common(xs[a:b], ys[c:d])]
            continue
        n_x, n_y = Counter(xs[a:b]), Counter(ys[c:d])
        at = {y: j for j, y in enumerate(ys[c:d], c) if n_y[y] == 1}
        anchors = ascending([(i, at[x]) for i, x in enumerate(xs[a:b], a) if n_x[x] == 1 and x in at])
        out += anchors
        for (i, j), (k, m) in zip([(a - 1, c - 1), *anchors], [*anchors, (b, d)]) if anchors else ():
            todo.append((i + 1, k, j + 1, m))
    return sorted(out)


def common(xs: list[str], ys: list[str]) -> list[tuple[int, int]]:
    best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i in range(len(xs) - 1, -1, -1):
        row, below, x = best[i], best[i + 1], xs[i]
        for j in range(len(ys) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if x == ys[j] else max(below[j], row[j + 1])
    out, i, j = [], 0, 0
    while i < len(xs) and j < len(ys):
        if xs[i] == ys[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def ascending(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of pairs, ascending in the first place, that ascends in the second too."""
    tops: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        before.append(ends[at - 1] if at else -1)
        tops[at:at + 1], ends[at:at + 1] = [j], [k]
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def expression(node: list) -> str:
    """The wrapper as text: #, elements in angle brackets, ? optional, + repeated."""
    inner = " ".join(expression(c) for c in node[2])
    mult = node[1].replace("1", "")
    if node[0] == "#":
        return "#" + mult
    if node[0].startswith("("):
        return f"({inner}){mult}"
    body = f"<{node[0]}>{inner}</>" if node[0] else inner
    return f"({body}){mult}" if mult else body


def slots_of(children: list) -> list[list]:
    """The text slots in the order of the tree."""
    return [x for c in children for x in ([c] if c[0] == "#" else slots_of(c[2]))]


def bare(children: list) -> list:
    """The tree without the numbers of blocks."""
    return [[c[0], c[1], bare(c[2])] for c in children]


def n_slots(node: list) -> int:
    return 1 if node[0] == "#" else sum(map(n_slots, node[2]))


def place(xs: list, ys: list, at: int = 0) -> list[int] | None:
    """For each slot of ``xs`` the number of the wrapper's slot that it fills, ``ys`` starting with slot ``at``; None if xs do not fit. Each node takes the first
    node after the one before that has its label and room for its children; whatever was merged into a wrapper fits."""
    out: list[int] = []
    j = 0
    for x in xs:
        while True:
            if j == len(ys):
                return None
            y, here = ys[j], at
            j, at = j + 1, at + n_slots(ys[j])
            if x[0] != y[0]:
                continue
            got = [here] if x[0] == "#" else place(x[2], y[2], here)
            if got is not None:
                out += got
                break
    return out


def outside(path: str) -> int:
    """0: may be text; 1: some class, id or role below the innermost article or main, or anywhere where there is none, speaks against it; 2: an element
    there does. What holds the article, and the article itself, is never judged."""
    parts = path.split("/")
    first = max((k + 1 for k, p in enumerate(parts) if p.split(".")[0] in WITHIN), default=0)
    worst = 0
    for part in parts[first:]:
        name, *words = part.split(".")
        if name in OUTSIDE and not (name == "header" and first):
            return 2
        if OUTSIDE_WORDS.intersection(words):
            worst = 1
    return worst


def within(path: str) -> bool:
    return bool(WITHIN & {p.split(".")[0] for p in path.split("/")})


BLOCK = pa.struct([("slot", pa.int32()), ("inside", pa.bool_()), ("links", pa.int64()), ("text", pa.string())])


def survey(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """For each page: id, url, host, tree (folded, as JSON), shape (its digest), blocks (not below a name outside; slot: its number in the page's tree), page (a digest of their texts)."""
    kind = pages.schema[id_col].dataType.simpleString()

    def run(it):
        for batch in it:
            for part in batches([batch], "html"):
                trees, blocks = [], []
                for source in part.column("html").to_pylist():
                    page = Page(source or "")
                    tree = fold(page.tree[2])
                    slot = {k: n for n, x in enumerate(slots_of(tree)) for k in x[3]}
                    against = {path: outside(path) for path in {b[0] for b in page.blocks}}
                    # names speak only where some text is left without them
                    limit = 1 if 0 in against.values() else 2
                    trees.append(json.dumps(bare(tree), separators=(",", ":"), ensure_ascii=False))
                    blocks.append([{"slot": slot[k], "inside": within(path), "links": links, "text": text} for k, (path, text, links) in enumerate(page.blocks) if against[path] < limit])
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("url"), part.column("host"), pa.array(trees, pa.string()), pa.array(blocks, pa.list_(BLOCK))], ["id", "url", "host", "tree", "blocks"])
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    read = rows.mapInArrow(run, f"id {kind}, url string, host string, tree string, blocks array<struct<slot: int, inside: boolean, links: long, text: string>>")
    return stored(read.select("*", F.md5("tree").alias("shape"), F.md5(F.array_join("blocks.text", "\0")).alias("page")), "pages-read")


def infer(seen: DataFrame) -> DataFrame:
    """(host, wrapper): the wrapper's tree as JSON. The different trees of a host are aligned in groups of about TOGETHER, the results again, until one is left: no
    task gets more than a group, however many trees a host has."""
    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tree: list | None = None
        for t in sorted(pdf["tree"]):
            tree = json.loads(t) if tree is None else align(tree, json.loads(t))
        return pd.DataFrame({"host": [key[0]], "tree": [json.dumps(tree, separators=(",", ":"), ensure_ascii=False)]})
    trees = stored(seen.select("host", "tree").distinct(), "wrapper-trees")
    while True:
        counts = stored(trees.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "wrapper-counts")
        most = counts.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return trees.withColumnRenamed("tree", "wrapper")
        # enough groups that even uneven ones stay small, and fewer than there are trees
        groups = F.ceil(F.col("n") / TOGETHER)
        dealt = trees.join(small(counts, "octet_length(host) + 8"), "host").withColumn("part", F.pmod(F.xxhash64("tree"), groups))
        trees = stored(dealt.groupBy("host", "part").applyInPandas(one, "host string, tree string"), "wrapper-trees")


def placed(seen: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, shape, at): for each different tree of a host, the wrapper's slots that its slots fill."""
    def run(it):
        for batch in it:
            last, wrapper, at = None, [], []
            for tree, w in zip(batch.column("tree"), batch.column("wrapper")):
                w = w.as_py()
                if w != last:
                    last, wrapper = w, json.loads(w)
                found = place(json.loads(tree.as_py()), wrapper)
                if found is None:
                    raise ValueError("a page does not fit its host's wrapper")
                at.append(found)
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("shape"), pa.array(at, pa.list_(pa.int32()))], ["host", "shape", "at"])
    trees = seen.select("host", "shape", "tree").distinct()
    return stored(trees.join(small(wrappers, "octet_length(host) + octet_length(wrapper)"), "host").select("host", "shape", "tree", "wrapper").mapInArrow(run, "host string, shape string, at array<int>"), "wrapper-places")


def judge(filled: DataFrame) -> DataFrame:
    """(host, drop, fixed): slots of links, and (slot, hash of the text) of fixed texts. ``filled``: host, page, blocks with wrapper slots."""
    blocks = filled.select("host", "page", F.explode("blocks").alias("b")).filter("NOT b.inside").select(
        "host", "page", "b.slot", F.xxhash64("b.text").alias("text"), F.length("b.text").cast("long").alias("chars"), "b.links")
    # a page that was copied, or that repeats a text in a slot, counts once
    each = stored(blocks.groupBy("host", "slot", "text", "page").agg(F.max("chars").alias("chars"), F.min("links").alias("links")), "slot-texts")
    slots = each.groupBy("host", "slot", "page").agg(F.sum("chars").alias("chars"), F.sum("links").alias("links")).groupBy("host", "slot").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    slots = stored(slots, "slots")
    texts = each.groupBy("host", "slot", "text").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    fixed = texts.join(slots, ["host", "slot"]).filter((F.col("n") - 1) * FIXED >= F.col("pages") - 1)
    rows = slots.filter(F.col("links") * 2 > F.col("chars")).select("host", F.col("slot").alias("drop"), F.lit(None).alias("fixed")).unionByName(
        fixed.select("host", F.lit(None).cast("int").alias("drop"), F.struct("slot", "text").alias("fixed")))
    return stored(rows.groupBy("host").agg(F.collect_list("drop").alias("drop"), F.collect_list("fixed").alias("fixed")), "slots-judged")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Columns: the id, url, text, n_chars."""
    seen = survey(pages, id_col, url_col, html_col)
    places = placed(seen, infer(seen))
    filled = seen.drop("tree").join(small(places, "octet_length(host) + 48 + 4 * size(at)"), ["host", "shape"]).select("id", "url", "host", "page", F.transform(
        "blocks", lambda b: F.struct(F.col("at")[b["slot"]].alias("slot"), b["inside"].alias("inside"), b["links"].alias("links"), b["text"].alias("text"))).alias("blocks"))
    judged = judge(filled)
    both = filled.join(small(judged, "octet_length(host) + 8 * size(drop) + 24 * size(fixed)"), "host", "left")
    inside = F.filter("blocks", lambda b: b["inside"])
    varies = F.filter("blocks", lambda b: ~F.coalesce(F.array_contains("drop", b["slot"]), F.lit(False))
                      & ~F.coalesce(F.array_contains("fixed", F.struct(b["slot"].alias("slot"), F.xxhash64(b["text"]).alias("text"))), F.lit(False)))
    text = F.array_join(F.transform(F.when(F.size(inside) > 0, inside).otherwise(varies), lambda b: b["text"]), " ")
    return both.select(F.col("id").alias(id_col), F.col("url").alias("url"), text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
