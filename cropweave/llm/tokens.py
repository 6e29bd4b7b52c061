"""Token ids of whole text columns by a public tokenizer, each distinct piece of text encoded once a worker.

A BPE tokenizer cuts a text into pieces (words, numbers, runs of signs, white space) and encodes each piece on its own.
Here the cut is made on arrays of character classes for all texts of a slice at once, and a worker keeps the ids of the
pieces it has met, so repeated words cost a look-up. New pieces are cut, lower-cased and written as byte letters here, so
they go to a tokenizer with the same model and no other step than to part them at a mark. Two forms of cut are known,
those of the two tokenizers with ``ByteLevel`` pieces and with word ends. Texts with characters whose class may differ
between Unicode versions, or that need more than a plain lower-casing, go to the whole tokenizer.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from cropweave.llm import words as W

#: Pieces a worker remembers; beyond it starts anew. Bounds its memory to some 100 MB.
MEMORY = 1_500_000
#: New pieces are kept in a small table, which is merged into the large one when it has so many.
RECENT = 1 << 16
#: Bytes of text that arrays are made for at once.
SLICE = 1 << 20
_LETTER, _NUMBER, _SPACE, _SIGN, _UNSURE = range(5)
_TABLES: dict[bool, tuple[np.ndarray, np.ndarray]] = {}
_ENCODERS: dict[int, Encoder] = {}


def _tables(lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Class and lower-cased form of each code point."""
    if lower not in _TABLES:
        old = unicodedata.ucd_3_2_0
        kinds = np.full(0x110000, _UNSURE, np.uint8)
        forms = np.arange(0x110000, dtype=np.uint32)
        for code in [*range(0x3400), *range(0x4E00, 0x9FA6), *range(0xAC00, 0xD7A4), *range(0xFE30, 0xFFEF)]:
            char = chr(code)
            kind = unicodedata.category(char)
            if kind[0] != old.category(char)[0] or kind in ("Cn", "Cs", "Co"):
                continue
            if char.isspace() != (kind[0] == "Z" or char in "\t\n\x0b\x0c\r\x85"):
                continue  # \x1c-\x1f are white space to Python only
            if lower:
                small = char.lower()
                if len(small) != 1 or char == "Σ" or kind[0] == "M" or unicodedata.normalize("NFC", char) != char \
                        or 0x1100 <= code < 0x1200:
                    continue
                forms[code] = ord(small)
            kinds[code] = {"L": _LETTER, "N": _NUMBER}.get(kind[0], _SPACE if char.isspace() else _SIGN)
        _TABLES[lower] = kinds, forms
    return _TABLES[lower]


def _byte_letters() -> np.ndarray:
    """The letter that stands for each byte in the vocabulary of a byte-level tokenizer."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = np.zeros(256, np.uint32)
    letters[shown] = shown
    letters[np.setdiff1d(np.arange(256), shown)] = np.arange(256, 512 - len(shown))
    return letters


_LETTERS = _byte_letters()
#: The letter of a line break parts the pieces.
_MARK = chr(_LETTERS[10])


def _lettered(codes: np.ndarray) -> str:
    return _LETTERS[np.frombuffer(codes.tobytes().decode("utf-32-le").encode(), np.uint8)].tobytes().decode("utf-32-le")


class Encoder:
    """Encodes slices of texts; ``spec`` is the content of the tokenizer's file."""

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks use the cores
        self.spec = spec
        parts = json.loads(spec)
        # the tokenizer with word ends lower-cases, drops white space and cuts numbers into digits
        suffix = parts["model"].get("end_of_word_suffix")
        self.words = bool(suffix)
        mark = {"type": "Split", "pattern": {"String": _MARK}, "behavior": "Removed" if self.words else "Isolated", "invert": False}
        self.pieces = Tokenizer.from_str(json.dumps({
            **parts, "added_tokens": [], "normalizer": None, "pre_tokenizer": mark, "post_processor": None, "decoder": None}))
        vocabulary = parts["model"]["vocab"]
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends_word[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.forget()

    @cached_property
    def tokenizer(self) -> Tokenizer:
        """The whole tokenizer, for texts that are not cut here."""
        tokenizer = Tokenizer.from_str(self.spec)
        tokenizer.encode_special_tokens = True
        return tokenizer

    def forget(self) -> None:
        self.size = self.used = 0
        self.starts, self.flat = np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32)
        self.tables = [(W.SortedHashes(np.zeros(0, np.uint64)), np.zeros(0, np.int64))] * 2

    def _pieces(self, kinds: np.ndarray, codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each piece, in code points."""
        n = len(codes)
        first = np.zeros(n + 1, bool)
        first[bounds] = True
        cut = first.copy()
        cut[1:n] |= kinds[1:] != kinds[:-1]
        if self.words:
            digits = np.flatnonzero(kinds == _NUMBER)
            cut[digits] = cut[digits + 1] = True
        space = kinds == _SPACE
        starts = np.flatnonzero(cut[:n])
        if not self.words:
            # the last of the white space before a piece stands alone, and joins the piece where it is a blank
            begin = starts[~space[starts]]
            before = begin[(begin > 0) & ~first[begin]]
            before = before[space[before - 1]]
            blank = before[codes[before - 1] == 32]
            cut[before - 1] = True
            cut[blank] = False
        # 's 't 're 've 'm 'll 'd at an apostrophe that begins a piece and is the whole run of signs
        marks = np.flatnonzero((codes == 39) & cut[:n])
        marks = marks[(marks + 1 < n)]
        marks = marks[cut[marks + 1] & ~first[marks + 1] & (kinds[marks + 1] == _LETTER)]
        if len(marks):
            padded = np.append(codes, [0, 0, 0])
            kind3 = np.append(kinds, [_SPACE] * 3)
            inside = ~np.append(first, [True] * 3)
            one, two = padded[marks + 1], padded[marks + 2]
            second = inside[marks + 2] & (kind3[marks + 2] == _LETTER)
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = second & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e")))
                             | ((one == ord("l")) & (two == ord("l"))))
            for chosen, size in ((short, 1), (long & ~short, 2)):
                at = marks[chosen]
                cut[at + 1] = False
                cut[np.minimum(at + 1 + size, n)] = True
        starts = np.flatnonzero(cut[:n])
        ends = np.append(starts[1:], n)
        if self.words:
            kept = ~space[starts]
            starts, ends = starts[kept], ends[kept]
        return starts, ends

    def _ids(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after the other, and how many each has, by one text in which a mark parts the pieces.

        The mark is a line break, whose id no piece has that does not end in white space. Words have their ends in their
        tokens, so there the mark has no token.
        """
        bounds = np.concatenate(([0], np.cumsum(sizes + 1)))
        text = np.full(int(bounds[-1]), 10, np.uint32)
        inside = np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)
        text[inside] = codes[np.arange(int(sizes.sum())) + np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)]
        # the same ids without the places of tokens in the text
        joined = self.pieces.encode_batch_fast([_lettered(text)], add_special_tokens=False)[0]
        ids = np.array(joined.ids, np.uint32)
        if self.words:
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            counts = np.diff(ends, prepend=0)
        else:
            mark = ids[-1:]
            ends = np.flatnonzero(ids == mark)
            counts = np.diff(ends, prepend=-1) - 1
            ids = ids[ids != mark]
        if len(counts) != len(sizes) or int(counts.sum()) != len(ids):  # not as expected: one by one
            lists = [self.tokenizer.encode(codes[a:a + n].tobytes().decode("utf-32-le"), add_special_tokens=False).ids
                     for a, n in zip(starts.tolist(), sizes.tolist())]
            counts = np.array([len(x) for x in lists], np.int64)
            ids = np.array([i for x in lists for i in x], np.uint32)
        return ids, counts

    def _learn(self, keys: np.ndarray, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, blank: np.ndarray) -> None:
        """Encode new pieces, given by ascending keys, and keep their ids. ``blank`` tells white space."""
        order = np.argsort(blank, kind="stable") if not self.words else np.arange(len(keys))
        plain = len(order) - int(blank.sum()) if not self.words else len(order)
        keys, starts, sizes = keys[order], starts[order], (ends - starts)[order]
        parts = [self._ids(codes, starts[:plain], sizes[:plain])] if plain else []
        model = self.pieces.model
        for a, n in zip(starts[plain:].tolist(), sizes[plain:].tolist()):
            ids = np.array([token.id for token in model.tokenize(_lettered(codes[a:a + n]))], np.uint32)
            parts.append((ids, np.array([len(ids)])))
        ids, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        while self.size + len(keys) + 1 > len(self.starts):
            self.starts = np.append(self.starts, np.zeros_like(self.starts))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.append(self.flat, np.zeros_like(self.flat))
        self.flat[self.used:self.used + len(ids)] = ids
        self.starts[self.size:self.size + len(keys) + 1] = self.used + np.concatenate(([0], np.cumsum(counts)))
        slots = np.arange(self.size, self.size + len(keys))
        self.size, self.used = self.size + len(keys), self.used + len(ids)
        by = np.argsort(keys)
        large, small = self.tables
        small = self._merged(small, keys[by], slots[by])
        if len(small[1]) > max(RECENT, len(large[1]) // 8):
            large, small = self._merged(large, small[0].keys, small[1]), self._merged(None, keys[:0], slots[:0])
        self.tables = [large, small]

    @staticmethod
    def _merged(table: tuple | None, keys: np.ndarray, slots: np.ndarray) -> tuple[W.SortedHashes, np.ndarray]:
        if table is None:
            return W.SortedHashes(keys), slots
        where = np.searchsorted(table[0].keys, keys)
        return W.SortedHashes(np.insert(table[0].keys, where, keys)), np.insert(table[1], where, slots)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """Where the ids of each piece are kept, -1 for new ones."""
        (large, slots), (small, more) = self.tables
        at = large.find(keys)
        out = slots[at] if len(slots) else at
        out[at < 0] = -1
        missing = np.flatnonzero(at < 0)
        if len(missing) and len(more):
            at = small.find(keys[missing])
            out[missing[at >= 0]] = more[at[at >= 0]]
        return out

    def encode(self, piece: W.Slice) -> Iterator[np.ndarray]:
        """Ids of each text of a slice."""
        kinds_of, forms = _tables(self.words)
        codes = np.frombuffer(piece.data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
        heads = np.zeros(len(piece.data) + 1, np.int64)
        np.cumsum((piece.data & 0xC0) != 0x80, out=heads[1:])
        bounds = heads[piece.bounds]
        kinds = kinds_of[codes]
        unsure = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(kinds == _UNSURE, out=unsure[1:])
        whole = np.diff(unsure[bounds]) > 0
        codes = forms[codes] if self.words else codes
        starts, ends = self._pieces(kinds, codes, bounds)
        up, down = W._power_tables(len(codes) + 1)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(W.mix(codes.astype(np.uint64) + np.uint64(1)) * up[:len(codes)], out=sums[1:])
        keys = W.mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        text = np.searchsorted(bounds, starts, "right") - 1
        if whole.any():
            kept = ~whole[text]
            starts, ends, keys, text = starts[kept], ends[kept], keys[kept], text[kept]
        if self.size > MEMORY:
            self.forget()
        slot = self._slots(keys)
        missing = np.flatnonzero(slot < 0)
        if len(missing):
            new, at = np.unique(keys[missing], return_index=True)
            at = missing[at]
            self._learn(new, codes, starts[at], ends[at], kinds[ends[at] - 1] == _SPACE)
            slot = self._slots(keys)
        first, sizes = self.starts[slot], self.starts[slot + 1] - self.starts[slot]
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        ids = self.flat[np.arange(int(offsets[-1])) + np.repeat(first - offsets[:-1], sizes)]
        cuts = offsets[np.searchsorted(text, np.arange(len(bounds)))]
        for i in range(len(bounds) - 1):
            if whole[i]:
                yield np.array(self.tokenizer.encode(piece.text(i), add_special_tokens=False).ids, np.uint32)
            else:
                yield ids[cuts[i]:cuts[i + 1]]


def encoder(spec: str) -> Encoder:
    """The encoder of this worker; it stays with its memory from task to task."""
    key = hash(spec)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(spec)
    return _ENCODERS[key]


def encoded(column: pa.Array, spec: str) -> Iterator[np.ndarray]:
    """Ids of every text of a column, in order; null texts have none."""
    worker = encoder(spec)
    for piece in W.slices(column, SLICE):
        yield from worker.encode(piece)
