"""Word-piece counts by a longest-match automaton.

The vocabulary is a trie over bytes. Each node has a failure link and the number of pieces that a greedy
longest match has certainly taken when it leaves the node that way, so one pass over a word gives its number of pieces
and none is ever built. A word is a maximal stretch without ASCII white space, taken with a space before it (which is
how the vocabulary marks starts of words).

Defined cases: a null text and one of white space alone have 0 words and tokens; a word with a byte that no piece covers counts as
one unknown token; repeated and null ids are rows of their own; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import base64
import re
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.encoding import batches

_WORDS, _ODD = re.compile("[^ \t\n\r\x0b\x0c]+"), re.compile("[\x1c-\x1f]")
#: Words whose counts a task remembers before it starts anew.
KEPT_WORDS = 500_000


class Automaton:
    """Failure links and popped-piece counts after Song et al., Fast WordPiece Tokenization (2021)."""

    def __init__(self, pieces: list[bytes]):
        self.next: dict[int, int] = {}
        final, children = [False], [[]]
        for piece in pieces:
            u = 0
            for c in piece:
                v = self.next.get(u << 8 | c)
                if v is None:
                    v = self.next[u << 8 | c] = len(final)
                    final.append(False)
                    children.append([])
                    children[u].append((c, v))
                u = v
            final[u] = u > 0
        # -1: no way on, the word holds an unknown byte
        self.fail, self.popped = [-1] * len(final), [0] * len(final)
        todo = deque([0])
        while todo:
            u = todo.popleft()
            for c, v in children[u]:
                todo.append(v)
                if final[v]:
                    self.fail[v], self.popped[v] = 0, 1
                    continue
                z, n = self.fail[u], self.popped[u]
                while z >= 0 and (z << 8 | c) not in self.next:
                    n += self.popped[z]
                    z = self.fail[z]
                if z >= 0:
                    self.fail[v], self.popped[v] = self.next[z << 8 | c], n

    def count(self, word: bytes) -> int:
        u = n = 0
        step, fail, popped = self.next, self.fail, self.popped
        for c in word:
            while (v := step.get(u << 8 | c)) is None:
                n += popped[u]
                u = fail[u]
                if u < 0:
                    return 1
            u = v
        while u:
            n += popped[u]
            u = fail[u]
            if u < 0:
                return 1
        return n


def read_vocabulary(path: str) -> list[bytes]:
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


_BUILT: dict[str, Automaton] = {}


def automaton(path: str) -> Automaton:
    if path not in _BUILT:
        _BUILT[path] = Automaton(read_vocabulary(path))
    return _BUILT[path]


def counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: the id, n_words, n_tokens."""
    def run(it):
        built, known = automaton(path), {}
        for batch in batches(it, "text"):
            n_words, n_tokens = [], []
            for text in batch.column("text").to_pylist():
                words = [] if not text else text.split() if text.isascii() and not _ODD.search(text) else _WORDS.findall(text)
                for w in {w for w in words if w not in known}:
                    known[w] = built.count(b" " + w.encode())
                n_words.append(len(words))
                n_tokens.append(sum(map(known.__getitem__, words)))
                if len(known) > KEPT_WORDS:
                    known = {}
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())], [id_col, "n_words", "n_tokens"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_tokens long")
