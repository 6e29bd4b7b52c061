"""Token ids as wavelet matrices, one compressed file a shard, with access, counting and look-up of occurrences.

File format (little-endian): ``WVM1``, then a header of 8-byte numbers (tokens n, bit-planes b, documents d, words of
the directory, length of the document section), the document section (compressed: number of tokens of each document),
the directory (for each plane: number of zeros, then for each block of ``BLOCK`` bits the ones before it and the place
of its compressed bytes), and the blocks. Plane i holds bit b - 1 - i of each token, in the order that all planes before
it left: zeros first, ones after, both in their old order. So rank and select on single blocks lead from a position to
its token and from a token to its positions, and a reader fetches only the blocks it needs.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cropweave.llm import storage, tokens
from cropweave.session import stage_table

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SHARD_TOKENS = 1 << 22
BLOCK = 1 << 16

_MAGIC = b"WVM1"


def image(ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """The file of one shard: all ids, and the number of ids of each document."""
    n = len(ids)
    planes = max(1, int(ids.max(initial=0)).bit_length())
    blocks = -(-n // BLOCK)
    directory = np.zeros((planes, 1 + 2 * blocks), np.int64)
    body: list[bytes] = []
    place = 0
    order = ids.astype(np.uint16) if planes <= 16 else ids.astype(np.uint32)
    for plane in range(planes):
        ones = (order >> (planes - 1 - plane)) & 1 != 0
        packed = np.packbits(ones)
        before = 0
        directory[plane, 0] = n - int(np.count_nonzero(ones))
        for block in range(blocks):
            raw = packed[block * (BLOCK // 8):(block + 1) * (BLOCK // 8)]
            data = pa.compress(raw.tobytes(), codec="zstd", asbytes=True)
            directory[plane, 1 + 2 * block:3 + 2 * block] = before, place
            before += int(np.count_nonzero(ones[block * BLOCK:(block + 1) * BLOCK]))
            place += len(data)
            body.append(data)
        if plane < planes - 1:
            order = np.concatenate([order[~ones], order[ones]])
    raw = lengths.astype("<i8").tobytes()
    documents = pa.compress(raw, codec="zstd", asbytes=True)
    head = struct.pack("<5q", n, planes, len(lengths), directory.size, len(documents))
    return b"".join([_MAGIC, head, documents, directory.astype("<i8").tobytes(), *body])


class Shard:
    """Reader of one file; ``stream`` is any seekable stream."""

    def __init__(self, stream):
        self.stream = stream
        if self._bytes(0, 4) != _MAGIC:
            raise ValueError("not a shard file")
        self.n, self.planes, documents, size, length = struct.unpack("<5q", self._bytes(4, 40))
        raw = pa.decompress(self._bytes(44, length), documents * 8, codec="zstd", asbytes=True) if documents else b""
        self.lengths = np.frombuffer(raw, "<i8")
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))
        at = 44 + length
        self.directory = np.frombuffer(self._bytes(at, size * 8), "<i8").reshape(self.planes, -1)
        self.body = at + size * 8
        self.zeros, self.ones, self.places = self.directory[:, 0], self.directory[:, 1::2], self.directory[:, 2::2]
        self._kept: dict[tuple[int, int], np.ndarray] = {}

    def _bytes(self, at: int, size: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(size)

    def _sizes(self, block: int) -> int:
        return min(BLOCK, self.n - block * BLOCK)

    def _plane(self, plane: int) -> np.ndarray:
        """All bits of a plane, by one read."""
        flat = np.append(self.places.ravel(), self._end())
        first = plane * self.places.shape[1]
        raw = self._bytes(self.body + int(flat[first]), int(flat[first + self.places.shape[1]] - flat[first]))
        bits = []
        for block in range(self.places.shape[1]):
            a, b = flat[first + block] - flat[first], flat[first + block + 1] - flat[first]
            size = self._sizes(block)
            bits.append(np.frombuffer(pa.decompress(raw[a:b], -(-size // 8), codec="zstd", asbytes=True), np.uint8))
        return np.unpackbits(np.concatenate(bits), count=self.n) if bits else np.zeros(0, np.uint8)

    def _end(self) -> int:
        self.stream.seek(0, 2)
        return self.stream.tell() - self.body

    def _block(self, plane: int, block: int) -> np.ndarray:
        """Bits of one block, by a read of its range."""
        if (plane, block) not in self._kept:
            if len(self._kept) > 256:
                self._kept.clear()
            flat = self.places.ravel()
            i = plane * self.places.shape[1] + block
            stop = int(flat[i + 1]) if i + 1 < len(flat) else self._end()
            size = self._sizes(block)
            raw = pa.decompress(self._bytes(self.body + int(flat[i]), stop - int(flat[i])), -(-size // 8),
                                codec="zstd", asbytes=True)
            self._kept[plane, block] = np.unpackbits(np.frombuffer(raw, np.uint8), count=size)
        return self._kept[plane, block]

    def rank(self, plane: int, position: int) -> int:
        """Ones of a plane before a position."""
        block = min(position // BLOCK, self.places.shape[1] - 1)
        if block < 0:
            return 0
        return int(self.ones[plane, block]) + int(np.count_nonzero(self._block(plane, block)[:position - block * BLOCK]))

    def select(self, plane: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) one or zero of a plane."""
        counts = self.ones[plane] if bit else np.arange(self.places.shape[1]) * BLOCK - self.ones[plane]
        block = int(np.searchsorted(counts, k, "right")) - 1
        return block * BLOCK + int(np.flatnonzero(self._block(plane, block) == bit)[k - int(counts[block])])

    def access(self, position: int) -> int:
        """The token at a position."""
        token = 0
        for plane in range(self.planes):
            block, inside = divmod(position, BLOCK)
            bit, ones = int(self._block(plane, block)[inside]), self.rank(plane, position)
            position = int(self.zeros[plane]) + ones if bit else position - ones
            token = 2 * token + bit
        return token

    def _span(self, token: int, first: int, last: int) -> tuple[int, int]:
        """Where the occurrences of a token within [first, last) stand after the last plane."""
        for plane in range(self.planes):
            a, b = self.rank(plane, first), self.rank(plane, last)
            if token >> (self.planes - 1 - plane) & 1:
                first, last = int(self.zeros[plane]) + a, int(self.zeros[plane]) + b
            else:
                first, last = first - a, last - b
        return first, last

    def count(self, token: int, first: int = 0, last: int | None = None) -> int:
        """Occurrences of a token within [first, last)."""
        if token >> self.planes or not self.n:
            return 0
        first, last = self._span(token, first, self.n if last is None else last)
        return last - first

    def occurrences(self, token: int) -> list[int]:
        """Positions of a token, ascending."""
        if token >> self.planes or not self.n:
            return []
        found = []
        for position in range(*self._span(token, 0, self.n)):
            for plane in reversed(range(self.planes)):
                bit = token >> (self.planes - 1 - plane) & 1
                position = self.select(plane, bit, position - int(self.zeros[plane]) * bit)
            found.append(position)
        return sorted(found)

    def decode(self) -> np.ndarray:
        """All tokens: the planes undone from the last to the first."""
        ids = np.zeros(self.n, np.uint32 if self.planes > 16 else np.uint16)
        for plane in reversed(range(self.planes)):
            ones = self._plane(plane).view(bool)
            before = np.empty_like(ids)
            before[~ones] = ids[:int(self.zeros[plane])]
            before[ones] = ids[int(self.zeros[plane]):] | ids.dtype.type(1 << (self.planes - 1 - plane))
            ids = before
        return ids.astype(np.uint32)


def _write(batches: Iterator[pa.RecordBatch], spec: str, folder: str, end_id: int,
           shard_tokens: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    held: list[np.ndarray] = []
    ids: list[int | None] = []
    size = number = 0

    def close() -> pa.RecordBatch:
        path = f"{folder}/shard-{part:07d}-{number:05d}.wvm"
        lengths = np.array([len(x) for x in held], np.int64)
        with storage.committed(path) as stream:
            stream.write(image(np.concatenate(held), lengths))
        return pa.RecordBatch.from_arrays(
            [pa.array([path]), pa.array([part], pa.int64()), pa.array([number], pa.int64()),
             pa.array([size], pa.int64()), pa.array([ids], pa.list_(pa.int64()))],
            ["path", "part", "number", "n_tokens", "doc_ids"])

    end = np.array([end_id], np.uint32)
    for batch in batches:
        for doc_id, own in zip(batch.column("doc_id").to_pylist(), tokens.encoded(batch.column("text"), spec)):
            if held and size + len(own) + 1 > shard_tokens:
                yield close()
                held, ids, size, number = [], [], 0, number + 1
            held.append(np.append(own, end))
            ids.append(doc_id)
            size += len(own) + 1
    if held:
        yield close()


def write_shards(docs: DataFrame, folder: str, tokenizer: str = "", end_id: int = END_ID,
                 shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order into shard files under ``folder``.

    Returns the catalogue of the files: path, part, number, n_tokens, doc_ids; (part, number) is their order. A null
    text has only the end id. Null ids come first, equal ids are ordered by their texts. Shards hold about
    ``shard_tokens`` ids, one document always stands in one shard. An empty table makes no file. Extra columns are
    ignored. ``tokenizer`` is the file of the tokenizer.
    """
    with open(tokenizer or public_tokenizers.path(TOKENIZER), encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())  # a file of fixed size
    ordered = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tie")).repartitionByRange(
        "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    return stage_table(ordered.mapInArrow(
        lambda batches: _write(batches, shared.value, folder, end_id, shard_tokens),
        "path string, part long, number long, n_tokens long, doc_ids array<long>"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, before, ids in zip(*(batch.column(c).to_pylist() for c in ("path", "before", "doc_ids"))):
            store, place = storage.located(path)
            with store.open_input_file(place) as stream:
                shard = Shard(stream)
                flat = shard.decode().astype("<u4")
            raw = memoryview(flat.tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(shard.starts[:-1].tolist(), shard.starts[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(shard.starts[:-1] + before), pa.array(shard.lengths),
                 pa.array(crc, pa.int64()), pa.array([path] * len(ids))],
                ["doc_id", "start", "n_tokens", "ids_crc32", "shard"])


def read_documents(catalogue: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32, shard)`` of every document, from the files of a catalogue."""
    files = catalogue.count()
    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # a row a shard
    placed = catalogue.select("path", "doc_ids", "part", "number", "n_tokens")
    starts = placed.select("path", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("before"))
    return (placed.select("path", "doc_ids").join(starts, "path").repartition(max(1, files))
            .mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard string"))
