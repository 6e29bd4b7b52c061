"""WARC records in ZIP packages, and a reader that fetches single records by their ranges.

A package holds ``archive/data.warc.gz`` (each record a gzip member of its own), ``indexes/index.cdxj`` (a line a record
with its place inside the member) and ``datapackage.json``, all stored without further compression. The reader finds the
end-of-directory record from the back of the file, follows the ZIP64 records where there are any, walks the central
directory, works out where each stored member begins from its local header, reads the index, and then the ranges of the
records. Nothing is extracted.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave.llm import storage
from cropweave.session import stage_table

ARCHIVE, INDEX, ABOUT = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
#: A package is closed once its archive has so many bytes.
PACKAGE_BYTES = 64 << 20
#: Ranges closer than this are read together, up to so many bytes at once.
GAP, CHUNK = 64 << 10, 4 << 20
_DATE = "2000-01-01T00:00:00Z"

_END, _END64, _LOCATOR64, _ENTRY, _LOCAL = 0x06054B50, 0x06064B50, 0x07064B50, 0x02014B50, 0x04034B50


@dataclass
class Member:
    """A member of a package: where its bytes begin and how many there are."""

    name: str
    method: int
    start: int
    size: int


def members(stream, total: int) -> dict[str, Member]:
    """The directory of a ZIP file, 32-bit or ZIP64, from a seekable stream of ``total`` bytes."""

    def read(at: int, size: int) -> bytes:
        stream.seek(at)
        data = stream.read(size)
        if len(data) != size:
            raise ValueError("the file ends early")
        return data

    tail_at = max(0, total - (22 + 0xFFFF))
    tail = read(tail_at, total - tail_at)
    at = len(tail) - 22
    while at >= 0 and not (tail[at:at + 4] == b"PK\x05\x06"
                           and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail)):
        at -= 1
    if at < 0:
        raise ValueError("no end of the central directory")
    _, _, _, _, count, size, start, _ = struct.unpack_from("<I4H2IH", tail, at)
    if count == 0xFFFF or size == 0xFFFFFFFF or start == 0xFFFFFFFF:
        place = tail_at + at - 20
        signature, _, end64, _ = struct.unpack("<IIQI", read(place, 20))
        if signature == _LOCATOR64:
            signature, _, _, _, _, _, _, count, size, start = struct.unpack("<IQHHIIQQQQ", read(end64, 56))
            if signature != _END64:
                raise ValueError("no ZIP64 end of the central directory")
    directory = read(start, size)
    found: dict[str, Member] = {}
    at = 0
    for _ in range(count):
        fields = struct.unpack_from("<I6H3I5H2I", directory, at)
        if fields[0] != _ENTRY:
            raise ValueError("no entry of the central directory")
        method, packed, plain, name_size, extra_size, note_size = *fields[4:5], *fields[8:13]
        local = fields[16]
        name = directory[at + 46:at + 46 + name_size].decode("utf-8")
        extra = directory[at + 46 + name_size:at + 46 + name_size + extra_size]
        while len(extra) >= 4:
            kind, length = struct.unpack_from("<HH", extra)
            if kind == 1:  # the wide values of those fields that are full, in this order
                wide = list(struct.unpack(f"<{length // 8}Q", extra[4:4 + length // 8 * 8]))
                plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                local = wide.pop(0) if local == 0xFFFFFFFF else local
            extra = extra[4 + length:]
        head = struct.unpack("<I5H3I2H", read(local, 30))
        if head[0] != _LOCAL:
            raise ValueError("no local header")
        found[name] = Member(name, method, local + 30 + head[9] + head[10], packed)
        at += 46 + name_size + extra_size + note_size
    return found


def stored(stream, member: Member, at: int = 0, size: int | None = None) -> bytes:
    """A range of the bytes of a stored member."""
    if member.method != 0:
        raise ValueError(f"{member.name} is not stored")
    size = member.size - at if size is None else size
    if at < 0 or at + size > member.size:
        raise ValueError("the range leaves the member")
    stream.seek(member.start + at)
    return stream.read(size)


def sha1_name(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    """A WARC record as one gzip member."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields.items()),
             f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, wbits=31)
    return packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + packer.flush()


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Fields (by lower-case name) and block of a gzipped record."""
    data = zlib.decompress(raw, wbits=31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, rest[:int(fields["content-length"])]


def _one_line(text: str | None) -> str:
    return " ".join((text or "").split())


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _page_record(page_id: int | None, url: str, payload: bytes, original: int | None) -> tuple[bytes, dict]:
    digest = sha1_name(payload)
    kind = "response" if original is None else "revisit"
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = {"WARC-Record-ID": _record_id(page_id, digest), "WARC-Date": _DATE, "WARC-Target-URI": url,
              "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http; msgtype=response",
              "X-Page-ID": "" if page_id is None else str(page_id), "X-Payload-Length": str(len(payload))}
    if original is not None:
        fields |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                   "WARC-Refers-To": _record_id(original, digest), "X-Refers-To-Page-ID": str(original)}
    return (record(kind, fields, head + payload if original is None else head),
            {"url": url, "mime": "text/html" if original is None else "warc/revisit", "status": "200",
             "digest": f"sha1:{digest}"})


def _write(batches: Iterator[pa.RecordBatch], folder: str, package_bytes: int) -> Iterator[pa.RecordBatch]:
    """Packages of a task; each archive member is written record by record, the index is kept until its end."""
    part = TaskContext.get().partitionId()

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for i in range(len(batch)):  # one page at a time
                yield tuple(batch.column(c)[i].as_py() for c in ("page_id", "url", "html", "original"))

    pending = rows()
    row = next(pending, None)
    number = 0
    while row is not None:
        path = f"{folder}/pages-{part:07d}-{number:05d}.wacz"
        index: list[str] = []
        with storage.committed(path) as stream, zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED) as package:

            def member(name: str) -> zipfile.ZipInfo:
                return zipfile.ZipInfo(name, (2000, 1, 1, 0, 0, 0))

            with package.open(member(ARCHIVE), "w", force_zip64=True) as archive:
                at = 0
                while row is not None and at < package_bytes:
                    page_id, url, html, original = row
                    url = _one_line(url)
                    data, about = _page_record(page_id, url, (html or "").encode("utf-8"), original)
                    archive.write(data)
                    about |= {"offset": str(at), "length": str(len(data)), "filename": "data.warc.gz"}
                    index.append(f"{url.replace(' ', '%20') or '-'} {_DATE.translate({ord(c): None for c in '-T:Z'})} {json.dumps(about)}\n")
                    at += len(data)
                    row = next(pending, None)
            text = "".join(index).encode()
            package.writestr(member(INDEX), text)
            about = {"profile": "data-package", "resources": [
                {"path": INDEX, "hash": f"sha256:{hashlib.sha256(text).hexdigest()}", "bytes": len(text)}]}
            package.writestr(member(ABOUT), json.dumps(about))
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(index)], pa.int64())], ["path", "records"])
        number += 1


def write_packages(pages: DataFrame, folder: str, min_bytes: int = 0, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html) under ``folder``; the catalogue (path, records).

    Of records with equal payloads of at least ``min_bytes`` bytes, that of the largest page_id is a response and the
    others are revisits of it; smaller payloads are always responses. A null html is an empty payload. Rows with the
    same page_id and payload are the same capture: all of them are responses where that id is the largest. Rows without
    a page_id revisit one that has it, and are responses where none has. Extra columns are ignored.
    """
    rows = pages.select(F.col("page_id").cast("long"), "url", "html").withColumn(
        "payload", F.coalesce("html", F.lit("")).cast("binary"))
    keyed = rows.withColumn("digest", F.when(F.octet_length("payload") >= min_bytes, F.sha1("payload")))
    # only payloads that repeat need their first capture; the join moves each page once
    first = keyed.filter("digest IS NOT NULL").groupBy("digest").agg(F.max("page_id").alias("largest"))
    marked = keyed.join(first.hint("merge"), "digest", "left").select(
        "page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest")).alias("original"))
    return stage_table(marked.mapInArrow(lambda batches: _write(batches, folder, package_bytes),
                                         "path string, records long"))


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            store, place = storage.located(path)
            with store.open_input_file(place) as stream:
                found = members(stream, store.get_file_info(place).size)
                archive = found[ARCHIVE]
                lines = stored(stream, found[INDEX]).decode("utf-8").split("\n")[:-1]
            about = [json.loads(line.split(" ", 2)[2]) for line in lines]
            offsets, lengths = [int(a["offset"]) for a in about], [int(a["length"]) for a in about]
            if archive.method != 0 or any(a + b > archive.size for a, b in zip(offsets, lengths)):
                raise ValueError(f"{path}: the index does not fit its archive")
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * len(about)), pa.array([archive.start + a for a in offsets], pa.int64()),
                 pa.array(lengths, pa.int64()), pa.array([a["digest"] for a in about], pa.string())],
                ["path", "at", "size", "digest"])


def read_index(catalogue: DataFrame) -> DataFrame:
    """``(path, at, size, digest)``: for each record of the packages of a catalogue its range of bytes in the file."""
    return catalogue.select("path").repartition(max(1, catalogue.count())).mapInArrow(
        _entries, "path string, at long, size long, digest string")


def _ranges(stream, wanted: list[tuple[int, int]]) -> Iterator[bytes]:
    """The bytes of each range; ranges that follow one another closely are read together."""
    i = 0
    while i < len(wanted):
        j, first, last = i, wanted[i][0], sum(wanted[i])
        while j + 1 < len(wanted) and 0 <= wanted[j + 1][0] - last <= GAP and sum(wanted[j + 1]) - first <= CHUNK:
            j += 1
            last = max(last, sum(wanted[j]))
        stream.seek(first)
        data = stream.read(last - first)
        for at, size in wanted[i:j + 1]:
            yield data[at - first:at - first + size]
        i = j + 1


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, spans, digests = (batch.column("path").to_pylist(), list(
            zip(batch.column("at").to_pylist(), batch.column("size").to_pylist())), batch.column("digest").to_pylist())
        rows: list[tuple] = []
        first = 0
        while first < len(paths):
            last = first
            while last < len(paths) and paths[last] == paths[first]:
                last += 1
            store, place = storage.located(paths[first])
            with store.open_input_file(place) as stream:
                for raw, indexed in zip(_ranges(stream, spans[first:last]), digests[first:last]):
                    fields, block = parse_record(raw)
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    size = int(fields["x-payload-length"])
                    payload = None
                    if fields["warc-type"] == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        size = len(payload)
                        if sha1_name(payload) != digest or f"sha1:{digest}" != indexed:
                            raise ValueError(f"{paths[first]}: a payload does not have its digest")
                    number = lambda name: int(fields[name]) if fields.get(name) else None
                    rows.append((number("x-page-id"), size, digest, fields["warc-type"], number("x-refers-to-page-id"),
                                 fields["warc-target-uri"], payload))
            first = last
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
            ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"])


def read_records(index: DataFrame) -> DataFrame:
    """Records of an index: page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload.

    Response payloads are checked against their digests; revisits have no payload of their own.
    """
    return index.mapInArrow(_records, "page_id long, payload_bytes long, payload_digest string, record_type string, "
                                      "refers_to long, url string, payload binary")


SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, max(page_id) AS largest FROM p GROUP BY h)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (5 * g + 1)::INT, 5))::INT >> s) & 31) + 1, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM p JOIN f USING (h)
"""
