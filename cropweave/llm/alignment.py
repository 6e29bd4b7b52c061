"""Alignment of the tokens that two tokenizers make of the same text, and which ids they link throughout the corpus.

1. Both tokenizers cut the same bytes, so the ends of their tokens are two rising arrays with the same last value. Where
   both end, a group closes. ``shared_ends`` walks along a diagonal: while tokens are one to one, probes of doubling
   length compare both arrays at the current index shift; an irregular group is resolved step by step, and gives the
   next shift.
2. The last tokens of a group end together; they are linked. A task cuts its documents into chunks of bounded size and
   writes, for each chunk, its distinct links with their counts, and, for each document, its links as places in the list
   of its chunk. This table is stored, as two steps read it.
3. Spark adds up the counts of the chunks, finds the most frequent partner of every id, and brings to each chunk the
   totals of its own links, where they are summed up document by document. No task gets the whole table of links.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from cropweave.llm import words as W
from cropweave.llm.tokens import encoded, encoder
from cropweave.session import stage_table

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")
#: Bytes of text whose links share one list.
CHUNK = 2 << 20
#: Segments whose ids a worker remembers for the second tokenizer, some 30 bytes each; beyond it starts anew.
MEMORY = 1_000_000
#: Tokens that are written out at once.
WRITTEN = 1 << 18
SPACE = "▁"


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(others)}}


def byte_level_tokens(vocabulary: dict[str, int]) -> list[bytes]:
    """The bytes of each id; an entry with other letters, such as a special token, stands for its own text."""
    letters = byte_letters()
    out = [b""] * (max(vocabulary.values()) + 1)
    for entry, i in vocabulary.items():
        out[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
    return out


def piece_tokens(pieces: SentencePieceProcessor) -> list[bytes]:
    def as_bytes(i: int) -> bytes:
        piece = pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace(SPACE, " ").encode()

    return [as_bytes(i) for i in range(pieces.get_piece_size())]


class Table:
    """Byte strings by number, in one array, for many look-ups at once."""

    def __init__(self, entries: list[bytes]):
        self.flat = np.frombuffer(b"".join(entries), np.uint8)
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        return self.flat[_places(self.starts[numbers], self.sizes[numbers])]


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the ranges that begin at ``starts``, one after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class Keys:
    """Slots by 64-bit key. New keys go to a small table, which is merged into the large one when it has grown."""

    def __init__(self) -> None:
        self.large = self.small = (W.SortedHashes(np.zeros(0, np.uint64)), np.zeros(0, np.int64))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where it is missing."""
        out = np.full(len(keys), -1, np.int64)
        for table, slots in (self.large, self.small):
            open_ones = np.flatnonzero(out < 0)
            if len(slots) and len(open_ones):
                at = table.find(keys[open_ones])
                out[open_ones] = np.where(at < 0, -1, slots[at])
        return out

    def add(self, keys: np.ndarray, slots: np.ndarray) -> None:
        """Add keys in ascending order that no table has."""
        self.small = self._merged(self.small, keys, slots)
        if len(self.small[1]) > max(1 << 16, len(self.large[1]) // 8):
            self.large = self._merged(self.large, self.small[0].keys, self.small[1])
            self.small = (W.SortedHashes(np.zeros(0, np.uint64)), np.zeros(0, np.int64))

    @staticmethod
    def _merged(table: tuple, keys: np.ndarray, slots: np.ndarray) -> tuple[W.SortedHashes, np.ndarray]:
        where = np.searchsorted(table[0].keys, keys)
        return W.SortedHashes(np.insert(table[0].keys, where, keys)), np.insert(table[1], where, slots)


class Pieces:
    """Ids of texts by a piece tokenizer that adds a blank in front.

    Where no piece goes on with a blank after another character, runs of blanks with what follows them are encoded on
    their own: the new ones of a chunk at once, and a worker remembers them by 64-bit hashes.
    """

    def __init__(self, path: str):
        self.model = SentencePieceProcessor(model_file=path)
        names = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        self.apart = not any(re.search(f"[^{SPACE}]{SPACE}", name) for name in names)
        self.table = Table(piece_tokens(self.model))
        self.blank = self.model.piece_to_id(SPACE)
        self.forget()

    def forget(self) -> None:
        self.known = Keys()
        self.starts, self.flat, self.true = np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0, bool)

    def _learn(self, segments: list[str]) -> None:
        """Encode new segments, and note which of them their ids give back."""
        lists = self.model.encode([s[1:] for s in segments], num_threads=1)
        lists = [[self.blank] if s == " " else ids for s, ids in zip(segments, lists)]
        ids = np.fromiter(chain.from_iterable(lists), np.int32)
        ends = np.cumsum([len(x) for x in lists])
        letters, cuts = self.table.joined(ids).tobytes(), np.append(0, np.cumsum(self.table.sizes[ids]))[np.append(0, ends)].tolist()
        true = [letters[a:b] == s.encode() for s, a, b in zip(segments, cuts, cuts[1:])]
        self.starts = np.append(self.starts, self.starts[-1] + ends)
        self.flat, self.true = np.append(self.flat, ids), np.append(self.true, true)

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, how many each has, and whether they give back the text; ``data`` has the texts with their blanks."""
        if not self.apart:
            texts = [data[a:b].tobytes().decode() for a, b in zip(bounds, bounds[1:])]
            lists = [np.array(ids, np.int64) for ids in self.model.encode([t[1:] for t in texts], num_threads=1)]
            true = [self.table.joined(ids).tobytes() == t.encode() for t, ids in zip(texts, lists)]
            return np.concatenate([*lists, np.zeros(0, np.int64)]), np.array([len(x) for x in lists], np.int64), np.array(true, bool)
        if len(self.true) > MEMORY:
            self.forget()
        blank = data == 32
        begins = blank.copy()
        begins[1:] &= ~blank[:-1]
        begins[bounds[:-1]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        up, down = W._power_tables(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(W.CODES[data] * up[:len(data)], out=sums[1:])
        keys = W.mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        slots = self.known.find(keys)
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            new, at = np.unique(keys[missing], return_index=True)
            at = missing[at]
            first = len(self.true)
            self._learn([data[a:b].tobytes().decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            self.known.add(new, np.arange(first, first + len(new)))
            slots[missing] = self.known.find(keys[missing])
        sizes = self.starts[slots + 1] - self.starts[slots]
        ids = self.flat[_places(self.starts[slots], sizes)].astype(np.int64)
        cuts = np.searchsorted(starts, bounds)
        wrong = np.diff(np.append(0, np.cumsum(~self.true[slots]))[cuts])
        return ids, np.diff(np.append(0, np.cumsum(sizes))[cuts]), wrong == 0


def shared_ends(a: list[int], b: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Runs ``(i, j, n)``, as three lists: for k under n, ``a[i + k] == b[j + k]``. They hold all values of both lists.

    Both lists rise and have the same last value.
    """
    size = len(a)
    a, b = [*a, -1], [*b, -2]  # unequal ends, so no probe passes them
    at_a, at_b, lengths = [], [], []
    i = j = 0
    while i < size:
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        n = 1
        while n < 8 and a[i + n] == b[j + n]:
            n += 1
        if n == 8:
            step = 8
            while a[i + n:i + n + step] == b[j + n:j + n + step]:
                n += step
                step *= 2
            while step > 1:
                step //= 2
                if a[i + n:i + n + step] == b[j + n:j + n + step]:
                    n += step
        at_a.append(i)
        at_b.append(j)
        lengths.append(n)
        i += n
        j += n
    return at_a, at_b, lengths


def last_tokens(runs: tuple[list[int], list[int], list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Place of the last token of every group, in either list."""
    i, j, n = (np.array(x, np.int64) for x in runs)
    return _places(i, n), _places(j, n)


class Aligner:
    """Token ids of both sides to groups and links."""

    def __init__(self, a_table: Table, b_table: Table):
        self.a_table, self.b_table = a_table, b_table
        # decimal ids with what follows them: another id of the side, the end of a side, the end of a group
        self.many = max(len(a_table.sizes), len(b_table.sizes))
        self.written = Table([f"{i}{mark}".encode() for mark in ",|;" for i in range(self.many)])

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the last token of each group on either side."""
        return last_tokens(shared_ends(np.cumsum(self.a_table.sizes[a]).tolist(), np.cumsum(self.b_table.sizes[b]).tolist()))

    def digests(self, a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray, ends: np.ndarray) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3``, the ids of each group, of every text; ``ends`` counts tokens up to each."""
        codes = np.empty(len(a) + len(b), np.int64)
        # tokens stand group by group, those of the first side in front
        a_place = np.arange(len(a)) + np.repeat(np.append(0, b_last[:-1] + 1), np.diff(a_last, prepend=-1))
        b_place = np.arange(len(b)) + np.repeat(a_last + 1, np.diff(b_last, prepend=-1))
        codes[a_place], codes[b_place] = a, b
        codes[a_place[a_last]] += self.many
        codes[b_place[b_last]] += 2 * self.many
        found, current, ends = [], hashlib.sha256(), ends.tolist()
        for at in range(0, len(codes), WRITTEN):
            block = codes[at:at + WRITTEN]
            letters = memoryview(self.written.joined(block))
            cuts = np.append(0, np.cumsum(self.written.sizes[block]))
            start = 0
            while len(found) < len(ends) and ends[len(found)] <= at + len(block):
                stop = int(cuts[ends[len(found)] - at])
                current.update(letters[start:stop - 1])  # without the mark behind the last group
                found.append(current.hexdigest())
                current, start = hashlib.sha256(), stop
            current.update(letters[start:])
        return found


_WORKER: dict[tuple[int, str], tuple[Pieces, Aligner]] = {}


def _worker(spec: str, b_path: str) -> tuple[Pieces, Aligner]:
    """The second tokenizer and the tables of this worker; they stay from task to task."""
    key = hash(spec), b_path
    if key not in _WORKER:
        _WORKER.clear()
        pieces = Pieces(b_path)
        vocabulary = encoder(spec).tokenizer.get_vocab(with_added_tokens=True)
        _WORKER[key] = pieces, Aligner(Table(byte_level_tokens(vocabulary)), pieces.table)
    return _WORKER[key]


_ALIGNED = pa.schema([
    ("chunk", pa.string()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("groups_sha256", pa.string()), ("links", pa.binary()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
_ALIGNED_SQL = ("chunk string, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary, "
                "pairs array<long>, counts array<long>")


def _aligned_chunk(texts: pa.Array, spec: str, b_path: str) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """``(n_a, n_b, n_groups, hash, links)`` of each text, and the distinct links of all with their counts.

    A link is ``a << 32 | b``; the links of a text are places in the list of distinct ones.
    """
    pieces, aligner = _worker(spec, b_path)
    blank = pc.binary_join_element_wise(pa.scalar("", texts.type), texts, pa.scalar(" ", texts.type))
    lists = list(encoded(blank, spec))
    a, n_a = np.concatenate([*lists, np.zeros(0, np.uint32)]).astype(np.int64), np.array([len(x) for x in lists], np.int64)
    # bytes of each text with its blank, as the text and as the first side's ids have it
    sizes = pc.binary_length(blank).to_numpy(zero_copy_only=False)
    bounds = np.append(0, np.cumsum(sizes)).astype(np.int64)
    data = np.frombuffer(b"".join(x.as_buffer() for x in blank), np.uint8)
    b, n_b, true = pieces.encode(data, bounds)
    true &= sizes > 1
    of_a = np.diff(np.append(0, np.cumsum(aligner.a_table.sizes[a]))[np.append(0, np.cumsum(n_a))])
    true &= of_a == sizes
    for i in np.flatnonzero(true):  # what ids give back has the right length; now letter by letter
        true[i] = np.array_equal(aligner.a_table.joined(lists[i]), data[bounds[i]:bounds[i + 1]])
    a, b = a[np.repeat(true, n_a)], b[np.repeat(true, n_b)]
    n_a, n_b, n_groups = n_a * true, n_b * true, np.zeros(len(true), np.int64)
    digests = iter([])
    if true.any():
        # texts that stand one after the other end together, so they are aligned in one walk
        a_last, b_last = aligner.align(a, b)
        token_ends = np.cumsum((n_a + n_b)[true])
        n_groups[true] = np.diff(np.searchsorted(a_last, np.cumsum(n_a[true])), prepend=0)
        digests = iter(aligner.digests(a, b, a_last, b_last, token_ends))
        a, b = a[a_last], b[b_last]
    pairs, places, counts = np.unique(a << 32 | b, return_inverse=True, return_counts=True)
    places = places.astype(np.uint16 if len(pairs) <= 1 << 16 else np.uint32)
    cuts = np.append(0, np.cumsum(n_groups))
    rows = [(x, y, g, next(digests), places[lo:hi].tobytes()) if good else (0, 0, 0, "", None)
            for good, x, y, g, lo, hi in zip(true.tolist(), n_a.tolist(), n_b.tolist(), n_groups.tolist(), cuts.tolist(), cuts[1:].tolist())]
    return rows, pairs, counts


def _aligned(batches: Iterator[pa.RecordBatch], spec: str, b_path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
        for piece in W.slices(column, CHUNK):
            rows, pairs, counts = _aligned_chunk(column.slice(piece.first, piece.last - piece.first), spec, b_path)
            # names of chunks only have to differ; those of a lost attempt are never read
            chunk = uuid.uuid4().hex
            n = len(rows)
            ids = batch.column("doc_id").slice(piece.first, n)
            columns = [pa.array([chunk] * n), ids, *[pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))],
                pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, schema=_ALIGNED)
            if len(pairs):
                yield pa.RecordBatch.from_pylist([{"chunk": chunk, "pairs": pairs, "counts": counts}], schema=_ALIGNED)


def aligned(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH) -> DataFrame:
    """Stored alignment: a row per document, and for each chunk a row with ``pairs`` and their ``counts``."""
    with open(a_path, encoding="utf-8") as file:
        spec = file.read()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stage_table(rows.mapInArrow(lambda batches: _aligned(batches, spec, b_path), _ALIGNED_SQL))


def link_counts(chunks: DataFrame) -> DataFrame:
    """``(pair, n, best)``: how often each link stands in the corpus, and whether no other one of its second id does more."""
    counts = chunks.groupBy("pair").agg(F.sum("n").alias("n"))
    second = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = counts.groupBy(second.alias("second")).agg(F.max("n").alias("most"))
    return counts.withColumn("second", second).join(most, "second").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best"))


_SCORED_SQL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _scored(documents: pa.Table, totals: pa.Table) -> pa.Table:
    """Links of a chunk's documents against the totals of its list."""
    totals = totals.sort_by("pair")
    n = totals.column("n").to_numpy()
    best = totals.column("best").to_numpy().astype(np.int64)
    kind = np.uint16 if len(n) <= 1 << 16 else np.uint32
    places = [np.frombuffer(raw or b"", kind) for raw in documents.column("links").to_pylist()]
    return documents.select(["doc_id", "n_a", "n_b", "n_groups"]).append_column(
        "n_links", pa.array([len(p) for p in places], pa.int64())).append_column(
        "n_best", pa.array([int(best[p].sum()) for p in places], pa.int64())).append_column(
        "count_sum", pa.array([int(n[p].sum()) for p in places], pa.int64())).append_column(
        "groups_sha256", documents.column("groups_sha256"))


def alignment(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every row of ``docs``.

    Texts that are null or empty, or whose tokens do not give back their bytes with a blank in front on both sides, have
    zeros and an empty ``groups_sha256``. Every row counts, also repeated ones and those without ``doc_id``. Further
    columns are ignored; an empty table gives an empty table. A task holds about a hundred bytes a byte of one chunk,
    which is 2 MB or one longer text.
    """
    table = aligned(docs, a_path, b_path)
    chunks = table.where("pairs IS NOT NULL").select("chunk", F.inline(F.arrays_zip("pairs", "counts")).alias("pair", "n"))
    totals = chunks.select(F.col("chunk").alias("of_chunk"), "pair").join(link_counts(chunks).hint("merge"), "pair")
    rows = table.where("pairs IS NULL").drop("pairs", "counts")
    return rows.groupBy("chunk").cogroup(totals.groupBy("of_chunk")).applyInArrow(_scored, _SCORED_SQL)
