"""Elements of JSON array files of any size, read in byte ranges by many tasks.

Whether a comma in the middle of a file parts two elements depends on all that stands before it: an open string, the depth
of the brackets. A first scan (``JsonRanges``) reads the ranges of the files that have several, each for itself, and notes
how it changes that state: whether it holds an odd number of quotes, by how much it changes the depth, and how many commas
stand at each depth, both for a range that begins outside of a string and for one that begins inside. From these notes,
one small row a range, the second scan (``JsonElements``) knows the state at the beginning of every range, and the place
of its first element in the file. The task in whose range an element begins reads on to its end. Short ranges are dealt
to tasks by many.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cropweave.session import stage_table

SPLIT = 32 << 20
#: Bytes of ranges that a task takes, what opening a range counts as, and the tasks of a core, if that makes them smaller.
TASK, OPENING, WAVES = 32 << 20, 256 << 10, 4
#: Bytes that arrays are made for at once.
CHUNK = 8 << 20
_BLANK = b" \t\n\r"
_QUOTE, _BACKSLASH, _COMMA, _OPEN = ord('"'), ord("\\"), ord(","), ord("[")
_STEP = np.zeros(256, np.int8)
_STEP[[ord("["), ord("{")]] = 1
_STEP[[ord("]"), ord("}")]] = -1
_MARK = _STEP != 0
_MARK[_COMMA] = True


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1) if "://" in path or path.startswith("/")
                                  else path.replace(":", "://", 1))


def real_quotes(data: np.ndarray, escaped: bool) -> tuple[np.ndarray, bool]:
    """Places of the quotes that no backslash takes out, and whether the byte behind ``data`` is escaped."""
    quotes = np.flatnonzero(data == _QUOTE)
    slashes = np.flatnonzero(data == _BACKSLASH)
    first = slashes[np.diff(slashes, prepend=-2) != 1]
    behind = slashes[np.diff(slashes, append=len(data) + 1) != 1] + 1
    odd = (behind - first) % 2 == 1
    if escaped:
        if len(first) and first[0] == 0:  # the run of backslashes goes on from before
            odd[0] = not odd[0]
        else:
            behind, odd = np.append(0, behind), np.append(True, odd)
    taken = behind[odd]
    after = bool(len(taken) and taken[-1] == len(data)) if len(data) else escaped
    return quotes[~np.isin(quotes, taken, assume_unique=True)], after


def marks(data: np.ndarray, quotes: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of brackets and commas outside of strings, and the depth change up to and with each."""
    places = np.flatnonzero(_MARK[data])
    places = places[np.searchsorted(quotes, places) % 2 == inside]
    return places, np.cumsum(_STEP[data[places]], dtype=np.int64)


def _escaped_at(file: pa.NativeFile, at: int) -> bool:
    """Whether an odd run of backslashes ends just before ``at``."""
    run, low = 0, at
    while low > 0:
        high, low = low, max(0, low - 64)
        file.seek(low)
        data = file.read(high - low)
        kept = len(data) - len(data.rstrip(b"\\"))
        run += kept
        if kept < len(data):
            break
    return run % 2 == 1


def _first_byte(file: pa.NativeFile) -> tuple[str, int]:
    """The first byte that is no blank, and its place; empty where there is none."""
    file.seek(0)
    at = 0
    while data := file.read(1 << 16):
        if rest := data.lstrip(_BLANK):
            return chr(rest[0]), at + len(data) - len(rest)
        at += len(data)
    return "", at


def _chunks(file: pa.NativeFile, at: int, end: int) -> Iterator[np.ndarray]:
    file.seek(at)
    while at < end and (data := file.read(min(CHUNK, end - at))):
        at += len(data)
        yield np.frombuffer(data, np.uint8)


@dataclass
class Span(InputPartition):
    """A byte range of a file, and the state of the text at its beginning."""

    path: str
    at: int
    end: int
    kind: str | None = None  # first byte of the file and its place, where known
    begin: int = 0
    inside: bool = False
    depth: int = 0
    place: int = 0


@dataclass
class Spans(InputPartition):
    """Ranges that one task reads one after the other."""

    spans: list[Span]


def dealt(spans: list[Span], tasks: int) -> list[Spans]:
    """Neighbouring ranges together, up to ``TASK`` bytes and to an equal part for each of ``tasks``."""
    costs = [s.end - s.at + OPENING for s in spans]
    most = min(TASK, -(-sum(costs) // tasks))
    parts: list[Spans] = []
    held = 0
    for span, cost in zip(spans, costs):
        if not parts or held + cost > most:
            parts.append(Spans([]))
            held = 0
        parts[-1].spans.append(span)
        held += cost
    return parts


def summary(span: Span) -> tuple:
    """``(path, at, kind, begin, odd, depths, commas)``; the last two for a beginning outside and inside of a string.

    ``commas`` has the number of commas at each depth, counted from that of the beginning of the range.
    """
    store, name = _store(span.path)
    with store.open_input_file(name) as file:
        kind, begin = _first_byte(file) if span.at == 0 else (None, None)
        escaped = _escaped_at(file, span.at)
        odd, depths, commas = False, [0, 0], [{}, {}]
        for data in _chunks(file, span.at, span.end):
            quotes, escaped = real_quotes(data, escaped)
            for inside in (False, True):
                places, depth = marks(data, quotes, inside ^ odd)
                at_comma = depth[data[places] == _COMMA] + depths[inside]
                for value, n in zip(*(x.tolist() for x in np.unique(at_comma, return_counts=True))):
                    commas[inside][value] = commas[inside].get(value, 0) + n
                depths[inside] += int(depth[-1]) if len(depth) else 0
            odd ^= len(quotes) % 2 == 1
    return span.path, span.at, kind, begin, odd, json.dumps(depths), json.dumps([list(c.items()) for c in commas])


def elements(span: Span) -> Iterator[tuple[int | None, str, str]]:
    """``(place, text, kind)`` of all that begins in a range; places count from the range's first one.

    Kinds: ``element``; ``cut``, the last element of an array without end; ``file``, a whole file that is no array;
    ``behind``, text after the end of the array.
    """
    text = lambda parts: b"".join(parts).strip(_BLANK).decode("utf-8", "replace")
    store, name = _store(span.path)
    with store.open_input_file(name) as file:
        kind = span.kind if span.kind is not None else _first_byte(file)[0]
        if kind != "[":
            if span.at == 0:
                file.seek(0)
                yield None, text([file.read()]), "file"
            return
        escaped, inside, depth = _escaped_at(file, span.at), span.inside, span.depth
        over = span.at > span.begin and depth <= 0
        place, parts, first, rest = span.place, None, False, []
        size = file.size()
        at = span.at
        while at < size:
            mine = at < span.end
            if not mine and parts is None:
                break
            data = next(_chunks(file, at, min(size, span.end) if mine else size))
            at += len(data)
            if over:
                rest.append(data.tobytes())
                continue
            quotes, escaped = real_quotes(data, escaped)
            places, depths = marks(data, quotes, inside)
            depths += depth
            inside ^= len(quotes) % 2 == 1
            depth = int(depths[-1]) if len(depths) else depth
            chars = data[places]
            parting = ((chars == _COMMA) & (depths == 1)) | ((chars == _OPEN) & (depths == 1)) | ((_STEP[chars] < 0) & (depths <= 0))
            raw, done = data.tobytes(), 0
            for cut, char in zip(places[parting].tolist(), chars[parting].tolist()):
                if parts is not None:
                    parts.append(raw[done:cut])
                    found = text(parts)
                    if found or not first or char == _COMMA:  # nothing between both brackets is no element
                        yield place, found, "element"
                        place += 1
                    parts = None
                    if not mine:
                        return
                done = cut + 1
                if char in (_COMMA, _OPEN):
                    parts, first = [], char == _OPEN
                else:
                    over = True
                    rest.append(raw[done:])
                    break
            if parts is not None:
                parts.append(raw[done:])
        if parts is not None:
            yield place, text(parts), "cut"
        if found := text(rest):
            yield None, found, "behind"


def _listed(path: str) -> list[dict]:
    store, name = _store(path)
    return pq.read_table(name, filesystem=store).to_pylist()


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.files, self.summaries, self.split = options["files"], options.get("summaries"), int(options["split"])

    def _spans(self, long: bool) -> list[Span]:
        return [Span(f["source_path"], at, min(at + self.split, f["length"])) for f in _listed(self.files)
                if (f["length"] > self.split) >= long for at in range(0, f["length"], self.split)]


class _RangeReader(_Reader):
    def partitions(self) -> list[Span]:
        return self._spans(long=True)

    def read(self, partition: Span) -> Iterator[tuple]:
        yield summary(partition)


class _ElementReader(_Reader):
    def partitions(self) -> list[Span]:
        """One entry a range: its state follows from the notes on the ranges before it."""
        notes = {(s["path"], s["at"]): s for s in _listed(self.summaries)} if self.summaries else {}
        spans = self._spans(long=False)
        kind, begin, inside, depth, place = None, 0, False, 0, 0
        for span in spans:
            if span.at == 0:
                kind, begin, inside, depth, place = None, 0, False, 0, 0
            note = notes.get((span.path, span.at))
            if note is None:
                continue
            if span.at == 0:
                kind, begin = note["kind"], note["begin"]
            span.kind, span.begin, span.inside, span.depth, span.place = kind, begin, inside, depth, place
            commas = dict(json.loads(note["commas"])[inside])
            # the first bracket begins an element too
            place += commas.get(1 - depth, 0) + (1 if span.at <= begin < span.end else 0)
            depth += json.loads(note["depths"])[inside]
            inside ^= note["odd"]
        return [s for s in spans if s.kind in (None, "[") or s.at == 0]

    def read(self, partition: Span) -> Iterator[tuple]:
        for place, text, kind in elements(partition):
            yield partition.path, place, text, kind


class _Dealt(DataSourceReader):
    """Reads the ranges that another reader plans, many in one task."""

    def __init__(self, ranges: _Reader, options: dict):
        self.ranges, self.tasks = ranges, int(options["tasks"])

    def partitions(self) -> list[Spans]:
        return dealt(self.ranges.partitions(), self.tasks)

    def read(self, partition: Spans) -> Iterator[tuple]:
        for span in partition.spans:
            yield from self.ranges.read(span)


class JsonRanges(DataSource):
    """Notes on the byte ranges of files longer than ``split``; ``files`` is a stored table (source_path, length)."""

    @classmethod
    def name(cls) -> str:
        return "json_ranges"

    def schema(self) -> str:
        return "path string, at long, kind string, begin long, odd boolean, depths string, commas string"

    def reader(self, schema) -> _Dealt:
        return _Dealt(_RangeReader(self.options), self.options)


class JsonElements(DataSource):
    """Elements of the files of the stored table ``files``; ``summaries`` is the stored result of ``JsonRanges``."""

    @classmethod
    def name(cls) -> str:
        return "json_elements"

    def schema(self) -> str:
        return "source_path string, source_pos long, content string, kind string"

    def reader(self, schema) -> _Dealt:
        return _Dealt(_ElementReader(self.options), self.options)


def read_elements(spark: SparkSession, paths: list[str], split: int = SPLIT) -> DataFrame:
    """``(source_path, source_pos, content, kind)`` of all elements, in ranges of ``split`` bytes.

    The file list is stored, and so are the notes where a file has several ranges; the driver holds one entry a range, as
    for any scan. Files must lie in a store that Arrow knows. Empty files have no rows.
    """
    for source in (JsonRanges, JsonElements):
        spark.dataSource.register(source)
    found = stage_table(spark.read.format("binaryFile").load(paths).where("length > 0").select(
        F.col("_metadata.file_path").alias("source_path"), "length").coalesce(1).sortWithinPartitions("source_path"))
    options = {"files": found.inputFiles()[0].rsplit("/", 1)[0] if found.inputFiles() else "", "split": str(split),
               "tasks": str(WAVES * spark.sparkContext.defaultParallelism)}
    if not options["files"]:
        return spark.createDataFrame([], JsonElements(options).schema())
    if not found.where(F.col("length") > split).isEmpty():
        notes = stage_table(spark.read.format("json_ranges").options(**options).load())
        options["summaries"] = notes.inputFiles()[0].rsplit("/", 1)[0]
    return spark.read.format("json_elements").options(**options).load()
