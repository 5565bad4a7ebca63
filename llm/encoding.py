"""Token ids of whole texts, with each different stretch of characters encoded once a task.

A text is cut only where the tokenizer's own pre-tokenizer always cuts: before runs of white space (byte-level
vocabularies) or between white space (word vocabularies, which drop it), and before a stop that ends a word. Numpy finds the cuts in
the bytes of a batch and Arrow its different pieces; the library encodes each of them once a task, and numpy puts the ids of the
batch together; they equal those of the whole texts."""
from __future__ import annotations

import ctypes
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_WS = r" \t\n\r\x0b\x0c\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Bytes that are white space, stops that end a word, and letters.
_BLANK, _STOP, _LETTER = (np.isin(np.arange(256), list(x)) for x in (b" \t\n\r\x0b\x0c", b".,;:!?", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
#: A word of letters that every step before the merges leaves as it is and in one.
_LETTERS = {True: re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+"), False: re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")}
_CLOSED = re.compile("(.*[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff])([.,;:!?]+)", re.DOTALL)
#: Distinct pieces, and their characters, that a task remembers before it starts anew.
KEPT_PIECES, KEPT_CHARS = 690_000, 24 << 20
#: Pieces given to the library at once; few enough to stay in the processor's cache.
AT_ONCE = 512


def byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write for bytes: printable ones stand for themselves, the others follow 255."""
    itself = [b for b in range(256) if 33 <= b <= 126 or b >= 161 and b != 173]
    return {b: chr(b) for b in itself} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(itself)))}


class Encoder:
    """``keeps_space``: the vocabulary encodes white space (byte-level); otherwise it drops it."""

    def __init__(self, path: str, keeps_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer, self.keeps_space, self.kept = Tokenizer.from_file(path), keeps_space, KEPT_PIECES
        # the same merges without the steps before them, for lines of words that those steps would not change
        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer, self.merges.pre_tokenizer = None, CharDelimiterSplit("\n")
        self.letters = byte_letters() | {10: "\n"}
        special = {k: t.content for k, t in self.tokenizer.get_added_tokens_decoder().items()}
        if keeps_space:  # a byte-level piece has one character for each byte
            self.width = np.array([len(special.get(k) or self.tokenizer.id_to_token(k)) for k in range(self.tokenizer.get_vocab_size())], np.int64)
        else:
            self.mark_id, self.mark = min(special.items())
            self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.closes[[k for piece, k in self.tokenizer.get_vocab().items() if piece.endswith("</w>")]] = True
        self.blank = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{_WS}]", c))
        self.forget()

    def forget(self) -> None:
        self.known = Known()
        self.ids, self.used, self.chars = np.empty(1 << 20, np.uint32), 0, 0
        self.start, self.length = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int64)

    def cut(self, texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
        """All pieces one after another, and how many each text has."""
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        if bounds[0] == bounds[-1]:
            return pa.array([], pa.large_string()), np.zeros(len(texts), np.int64)
        data, bounds = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]
        some = np.diff(bounds) > 0
        blank = _BLANK[data]
        # a text starts and ends as if white space stood beside it
        before, after = np.empty_like(blank), np.empty_like(blank)
        before[1:], after[:-1] = blank[:-1], blank[1:]
        before[bounds[:-1][some]] = after[bounds[1:][some] - 1] = True
        stop = np.flatnonzero(_STOP[data] & after & ~before)
        last = data[stop - 1]
        latin = (last >= 0x80) & (data[stop - 2] == 0xC3) & (last != 0x97) & (last != 0xB7)  # A0-FF but for the two signs
        if self.keeps_space:
            begin = blank & ~before
            wide = np.flatnonzero(begin)
            wide = wide[data[wide - 1] >= 0x80]  # a run goes on after white space of more than one byte
            begin[wide[self.ends_blank(data, wide)]] = False
            begin[bounds[:-1][some]] = True
            line = np.flatnonzero((data == 10) & begin & ~after)  # one line break is not drawn to the word after it
            begin[line[data[line + 1] < 0x80] + 1] = True
        else:
            begin = before & ~blank
        begin[stop[_LETTER[last] | latin]] = True
        at = np.flatnonzero(begin)
        counts = np.diff(np.searchsorted(at, bounds))
        if not self.keeps_space:
            at, data = np.cumsum(~blank)[at] - 1, data[~blank]
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))), counts

    def ends_blank(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether the character before each place is white space of two or three bytes."""
        two = np.where(at > 1, data[at - 2], 0).astype(np.int64) << 8 | data[at - 1]
        three = np.where(at > 2, data[at - 3], 0).astype(np.int64) << 16 | two
        wide = [c.encode() for c in self.blank if ord(c) > 127]
        return np.isin(two, [int.from_bytes(c) for c in wide if len(c) == 2]) | np.isin(three, [int.from_bytes(c) for c in wide if len(c) == 3])

    def together(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of pieces, encoded as one text. Byte-level ids spell their text, so lengths in bytes tell the
        pieces apart; otherwise a special token stands between them."""
        if self.keeps_space:
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(pieces)], add_special_tokens=False)[0].ids, np.int64)
            ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum([len(p.encode()) for p in pieces])) + 1
        else:
            ids = np.array(self.tokenizer.encode_batch_fast([self.mark.join(pieces)], add_special_tokens=False)[0].ids, np.int64)
            between = ids == self.mark_id
            ends = np.append(np.flatnonzero(between) - np.arange(between.sum()), len(ids) - between.sum())
            ids = ids[~between]
        return ids, np.diff(ends, prepend=0)

    def words(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of pieces that are words of letters: only the merges are left to do for them."""
        lines = "\n".join(pieces).encode().decode("latin1").translate(self.letters)
        ids = np.array(self.merges.encode_batch_fast([lines], add_special_tokens=False)[0].ids, np.int64)
        if self.keeps_space:
            ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum([len(w) for w in lines.split("\n")])) + 1
        else:
            ends = np.flatnonzero(self.closes[ids]) + 1
        return ids, np.diff(ends, prepend=0)

    def alone(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(got), np.int64), np.fromiter(map(len, got), np.int64, len(got))

    def parts(self, piece: str) -> tuple[str, ...]:
        """What the piece is made of: a final stop or comma after a letter always stands apart, and a word vocabulary folds case."""
        m = _CLOSED.fullmatch(piece) if piece[-1] in ".,;:!?" else None
        return (self.folded(m[1]), m[2]) if m else (self.folded(piece),)

    def folded(self, piece: str) -> str:
        folds = not self.keeps_space and (piece.isascii() and "<|" not in piece or _LETTERS[True].fullmatch(piece))
        return piece.lower() if folds else piece

    def learn(self) -> None:
        """Encode what was met for the first time."""
        fresh, made, parts_of, words, joined, alone = self.known.fresh, [], [], [], [], []
        first, is_word = len(self.known) - len(fresh), _LETTERS[self.keeps_space].fullmatch
        for k, piece in enumerate(fresh, first):  # grows as parts are met that are new themselves
            if is_word(piece):
                words.append(k)
                continue
            parts = self.parts(piece)
            if parts != (piece,):
                made.append(k)
                parts_of.append([self.known[p] for p in parts])
            # a piece can stand in a joined text if it is cut off there as it would be in its own
            elif piece[0] in " \n\t" and piece[-1] not in self.blank if self.keeps_space else "<|" not in piece:
                joined.append(k)
            else:
                alone.append(k)
        n = len(self.known)
        while n > len(self.start):
            self.start, self.length = (np.concatenate([x, np.empty_like(x)]) for x in (self.start, self.length))
        for how, rows in ((self.words, words), (self.together, joined), (self.alone, alone)):
            for at in range(0, len(rows), AT_ONCE):
                some = rows[at:at + AT_ONCE]
                self.keep(np.array(some), *how([fresh[k - first] for k in some]))
        if made:
            sizes = np.array([len(parts) for parts in parts_of])
            ids, n = self.gather(np.array([p for parts in parts_of for p in parts]))
            self.keep(np.array(made), ids, np.add.reduceat(n, np.cumsum(sizes) - sizes))
        self.chars += sum(map(len, fresh))
        fresh.clear()

    def keep(self, rows: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.used:self.used + len(ids)] = ids
        self.start[rows], self.length[rows] = self.used + np.cumsum(counts) - counts, counts
        self.used += len(ids)

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known pieces one after another, and how many each has."""
        n = self.length[rows]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.start[rows] - ends + n, n) + np.arange(total)], n

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has. A null text has none."""
        if len(self.known) > self.kept or self.chars > KEPT_CHARS:
            self.forget()
        texts = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        pieces, sizes = self.cut(texts.fill_null(""))
        coded = pieces.dictionary_encode()
        different = coded.dictionary.to_pylist()
        rows = np.fromiter(map(self.known.__getitem__, different), np.int64, len(different))[coded.indices.to_numpy()]
        self.learn()
        ids, n = self.gather(rows)
        ends = np.concatenate([[0], np.cumsum(n)])
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(sizes)])])


class Known(dict):
    """Pieces numbered as they are met; ``fresh`` lists those not encoded yet."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        self.fresh.append(piece)
        return n


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, keeps_space: bool, kept: int = KEPT_PIECES) -> Encoder:
    """One encoder for each Python worker; it remembers ``kept`` pieces."""
    if (path, keeps_space) not in _ENCODERS:
        _ENCODERS[path, keeps_space] = Encoder(path, keeps_space)
    _ENCODERS[path, keeps_space].kept = kept
    return _ENCODERS[path, keeps_space]


def release() -> None:
    """Drop the encoders that a worker keeps from task to task, and give freed memory back. Workers serve every stage of a session, so tasks of
    other operators call this before they fill memory of their own; the next encoding task begins anew."""
    _ENCODERS.clear()
    give_back()


def give_back() -> None:
    """Return freed memory to the system, where the C library can (others keep it for themselves)."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def batches(it, text_col: str, limit: int = 1 << 20):
    """Record batches cut into slices of about ``limit`` bytes of text, one row at least."""
    for batch in it:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_pylist()
        at, total = 0, 0
        for k, size in enumerate(sizes):
            if k > at and total + size > limit:
                yield batch.slice(at, k - at)
                at, total = k, 0
            total += size
        if len(sizes) > at:
            yield batch.slice(at)
