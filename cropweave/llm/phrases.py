"""Fingerprints of documents from Lempel-Ziv phrases, and how alike two documents are by them.

A text is parsed into the phrases of an LZ78 dictionary: the longest phrase known so far and one byte more is the next
phrase. Two texts that compress well together share many phrases. The fingerprint is the ``SIZE`` smallest hashes of the
phrase set, and the likeness of two fingerprints estimates the share of phrases that both sets have.

``edited_pairs`` compares each document with its edited text and with its neighbour in descending ``doc_id``: documents
are dealt by ranges of ids, and the first document of each range is sent to the range before it too, so one shuffle of
the texts brings every document together with its neighbour.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropweave.llm.words import mix

#: Hashes of a fingerprint; the standard error of a likeness is at most 0.045.
SIZE = 128
_MASK = (1 << 64) - 1
_STEP = 0x9E3779B97F4A7C15


class Parse:
    """The LZ78 dictionary of a text that can still go on: phrases are numbered, each extends an earlier one by a byte."""

    def __init__(self, other: Parse | None = None):
        self.next = dict(other.next) if other else {}
        self.hashes = list(other.hashes) if other else [_STEP]
        self.at = other.at if other else 0

    def feed(self, data: bytes) -> Parse:
        known, hashes, at = self.next, self.hashes, self.at
        get = known.get
        for byte in data:
            key = at << 8 | byte
            found = get(key)
            if found is None:
                known[key] = len(hashes)
                hashes.append(((hashes[at] ^ (byte + 1)) * _STEP + (hashes[at] >> 29)) & _MASK)
                at = 0
            else:
                at = found
        self.at = at
        return self

    def phrases(self) -> np.ndarray:
        """A hash of each phrase, the same in every text. A rest that is a known phrase adds none."""
        return mix(np.array(self.hashes[1:], np.uint64))

    def fingerprint(self) -> np.ndarray:
        found = np.unique(self.phrases())
        return found[:SIZE]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common hashes among the ``SIZE`` smallest of both; 1 for two empty texts, 0 if only one is empty."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate((a, b)))
    again = both[1:] == both[:-1]
    united = both[np.append(True, ~again)][:SIZE]
    return float((both[1:][again] <= united[-1]).sum() / len(united))


def written(fingerprint: np.ndarray) -> str:
    """The hashes in ascending order, eight bytes each, in base64."""
    return base64.b64encode(fingerprint.astype(">u8").tobytes()).decode("ascii")


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), ">u8").astype(np.uint64)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint)`` of every row; a null text is empty and has the empty fingerprint."""
    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [written(Parse().feed((t or "").encode()).fingerprint()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(parsed, "doc_id long, fingerprint string")


class _Document:
    def __init__(self, doc_id: int | None, text: str):
        self.doc_id, self.text = doc_id, text
        self.half = len(text) // 2
        # the edited text begins like the text, so both go on from one dictionary
        self.begun = Parse().feed(text[:len(text) - self.half].encode())
        self.fingerprint = Parse(self.begun).feed(text[len(text) - self.half:].encode()).fingerprint()

    def compared(self, following: _Document | None) -> tuple:
        put = following.text[:self.half] if following else ""
        edited = self.text[:len(self.text) - self.half] + put
        other = self.begun.feed(put.encode()).fingerprint()
        return (self.doc_id, len(self.text), hashlib.sha256(edited.encode()).hexdigest(), written(self.fingerprint),
                written(other), likeness(self.fingerprint, other),
                likeness(self.fingerprint, following.fingerprint) if following else None)


_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_LOOSE, _OWN, _GUEST = 0, 1, 2


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range stand together: those without an id, its own by descending id, then the first of the next range."""
    names = [c.split()[0] for c in _RESULT.split(", ")]
    held: _Document | None = None
    for batch in batches:
        out = []
        for role, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("role", "doc_id", "text"))):
            if role == _LOOSE:
                out.append(_Document(None, text or "").compared(None))
            elif role == _OWN or held:
                here = _Document(doc_id, text or "")
                if held:
                    out.append(held.compared(here))
                # of rows that share the first id of the next range the first one ends this range
                held = here if role == _OWN else None
        columns = list(zip(*out)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names)


def _range_of(value: Column, bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` are smaller than ``value``, by halving."""
    if not bounds:
        return F.lit(0)
    steps = F.lit([1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)])
    table = F.lit(bounds)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(bounds)) & (F.get(table, at + step - 1) < value), at + step).otherwise(at))


def edited_pairs(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` of every row.

    The next document is the one with the next smaller ``doc_id``, after the smallest comes the largest. In the edited
    text the last ``floor(n_chars / 2)`` code points are replaced by as many first ones of the next document, or all it
    has. Rows that share a ``doc_id`` follow each other by text; a single row is its own next. Rows without a
    ``doc_id`` have no next document: nothing replaces their end, and ``near_next`` is null. A null text is empty. A
    task holds the dictionaries of two texts, some 30 bytes a byte of text. Further columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    numbered = rows.where("doc_id IS NOT NULL").select("doc_id")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # at most as many bounds and heads as shuffle partitions reach the driver
    cuts = numbered.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)] or [0.5], 100 * ranges)).first()[0]
    bounds = sorted(set(cuts or []))
    at = _range_of(F.col("doc_id"), bounds)
    heads = sorted((r["range"], r["head"]) for r in numbered.groupBy(at.alias("range")).agg(
        F.max("doc_id").alias("head")).collect())
    # the largest id of a range follows the smallest of the range above; that of the highest follows the lowest range
    guests = spark.createDataFrame([(head, heads[(k + 1) % len(heads)][0]) for k, (_, head) in enumerate(heads)],
                                   "doc_id long, above int")
    own = F.struct(F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text"), F.lit(ranges))).otherwise(at).cast("int").alias("range"),
                   F.when(F.col("doc_id").isNull(), _LOOSE).otherwise(_OWN).alias("role"))
    guest = F.when(F.col("above").isNotNull(), F.struct(F.col("above").alias("range"), F.lit(_GUEST).alias("role")))
    dealt = (rows.join(F.broadcast(guests), "doc_id", "left")
             .select("doc_id", "text", F.inline(F.array_compact(F.array(own, guest))))
             .repartitionById(ranges, F.col("range"))
             .sortWithinPartitions("range", "role", F.desc("doc_id"), "text"))
    return dealt.select("role", "doc_id", "text").mapInArrow(_compared, _RESULT)
