"""Words, word hashes and n-gram hashes of whole text columns, computed on the bytes of an Arrow batch.

The functions here run inside Spark tasks (``mapInArrow``). A column is cut into slices of whole texts, so memory
follows the slice and the longest text, not the batch. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_table(excluded: str) -> np.ndarray:
    """True for the bytes that belong to a word: all but those of ``excluded`` (ASCII)."""
    table = np.ones(256, dtype=bool)
    table[np.frombuffer(excluded.encode("ascii"), np.uint8)] = False
    return table


#: Words are runs of anything but ASCII white space.
NOT_SPACE = byte_table(" \t\n\x0b\x0c\r")
#: Words are runs of lower-case letters, digits and everything beyond ASCII (for text whose A-Z are lower-cased).
ALNUM = byte_table("".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CODES = mix(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)

_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        base = MULTIPLIER
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        for name, factor in (("up", base), ("down", inverse)):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


class Slice:
    """Consecutive texts of a batch as one byte array.

    ``first``/``last`` are the rows in the batch, ``data`` the bytes, ``bounds`` the byte offset of each text.
    """

    def __init__(self, first: int, last: int, data: np.ndarray, bounds: np.ndarray):
        self.first, self.last, self.data, self.bounds = first, last, data, bounds

    def words(self, table: np.ndarray, lower: bool) -> Words:
        return Words(LOWER[self.data] if lower else self.data, self.bounds, table)

    def text(self, row: int) -> str:
        return self.data[self.bounds[row]:self.bounds[row + 1]].tobytes().decode("utf-8", "replace")


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[Slice]:
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1)
        yield Slice(first, last, data[bounds[first]:bounds[last]], bounds[first:last + 1] - bounds[first])
        first = last


class Words:
    """The words of a slice: byte spans, and the range of words of each text (``of_text``)."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, table: np.ndarray):
        inside = table[data]
        self.data, self.bounds = data, bounds
        if not len(data):
            self.starts = self.ends = np.zeros(0, np.int64)
        else:
            begins = np.empty(len(data), bool)
            begins[0] = True
            np.logical_not(inside[:-1], out=begins[1:])
            edges = bounds[bounds < len(data)]
            begins[edges] = True
            stops = np.empty(len(data), bool)
            stops[-1] = True
            np.logical_not(inside[1:], out=stops[:-1])
            stops[edges[edges > 0] - 1] = True
            self.starts = np.flatnonzero(begins & inside)
            self.ends = np.flatnonzero(stops & inside) + 1
        self.of_text = np.searchsorted(self.starts, bounds)
        self.counts = np.diff(self.of_text)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash a word, the same wherever the word stands."""
        up, down = _power_tables(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(CODES[self.data] * up[:len(self.data)], out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def end_of_word(self) -> np.ndarray:
        """For each word, the first word after its text."""
        return np.repeat(self.of_text[1:], self.counts)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of ``k`` consecutive words from every position, across texts too; empty when there are fewer words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        total *= MULTIPLIER
        total += words[j:j + n]
    return mix(total)


def inside(words: Words, k: int) -> np.ndarray:
    """Positions from which ``k`` words stand within one text."""
    ends = words.end_of_word()
    return np.flatnonzero(np.arange(len(ends)) + k <= ends)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


class SortedHashes:
    """A sorted array of hashes with an index of their beginnings, for look-ups of many hashes at once."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = min(22, max(8, int(len(keys)).bit_length()))
        self.shift = np.uint64(64 - bits)
        sizes = np.bincount((keys >> self.shift).astype(np.int64), minlength=1 << bits)
        self.heads = np.zeros(1 << bits, np.int32)
        np.cumsum(sizes[:-1], out=self.heads[1:])

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 where it is missing."""
        n = len(self.keys)
        if not n:
            return np.full(len(wanted), -1, np.int64)
        at = self.heads[(wanted >> self.shift).astype(np.int64)].astype(np.int64)
        behind = np.flatnonzero(at < n)
        behind = behind[self.keys[at[behind]] < wanted[behind]]
        while len(behind):  # hashes spread evenly, so few share a beginning
            at[behind] += 1
            behind = behind[at[behind] < n]
            behind = behind[self.keys[at[behind]] < wanted[behind]]
        at = np.minimum(at, n - 1)
        return np.where(self.keys[at] == wanted, at, -1)
