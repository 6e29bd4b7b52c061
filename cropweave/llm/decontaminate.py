"""Benchmark decontamination by winnowing.

A window is ``window`` consecutive words of a benchmark item; an item of fewer words is one window. Of every
``window - k + 1`` consecutive k-gram hashes the smallest is kept as a fingerprint, in items and documents alike, so
every shared span of ``window`` words shares at least one kept fingerprint at the same place. Fingerprints of documents
are tested against a bitmap of fixed size, the survivors are joined with those of the items, and each meeting is
extended to both sides word by word. Items shorter than a window have one fingerprint, their whole word sequence, and
documents are tested for it at every position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave.llm import words as W
from cropweave.session import stage_table

WINDOW = 10
GRAM = 5
#: The bitmap has 2 ** BITMAP_BITS bits (1 MB), whatever the number of items; it only saves rows of the join.
BITMAP_BITS = 23

_CANDIDATES = "array<struct<pos:int,fp:long,at:int,around:array<long>>>"
_CANDIDATE_TYPE = pa.list_(pa.struct([("pos", pa.int32()), ("fp", pa.int64()), ("at", pa.int32()),
                                      ("around", pa.list_(pa.int64()))]))


def fingerprints(hashes: np.ndarray, found: W.Words, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the winnowed k-grams of all texts of a slice."""
    grams = W.gram_hashes(hashes, k)
    starts = W.inside(found, window)
    if not len(starts):
        return starts, grams[:0]
    span = np.lib.stride_tricks.sliding_window_view(grams, window - k + 1)
    chosen = np.unique(starts + span[starts].argmin(axis=1))
    return chosen, grams[chosen]


def _item_rows(batches: Iterator[pa.RecordBatch], k: int, window: int) -> Iterator[pa.RecordBatch]:
    reach = window - k
    for batch in batches:
        rows = []
        ids = batch.column("item_id").to_pylist()
        for piece in W.slices(batch.column("text")):
            found = piece.words(W.ALNUM, lower=True)
            hashes = found.hashes()
            where, values = fingerprints(hashes, found, k, window)
            owner = np.searchsorted(found.of_text, where, "right") - 1
            for position, value, text in zip(where.tolist(), W.signed(values).tolist(), owner.tolist()):
                first, last = found.of_text[text], found.of_text[text + 1]
                left = max(first, position - reach)
                rows.append((ids[piece.first + text], value, k, int(position - left),
                             W.signed(hashes[left:min(last, position + k + reach)]).tolist()))
            for text, n in enumerate(found.counts.tolist()):
                if 0 < n < window:
                    own = hashes[found.of_text[text]:found.of_text[text + 1]]
                    rows.append((ids[piece.first + text], int(W.signed(W.gram_hashes(own, n))[0]), n, 0,
                                 W.signed(own).tolist()))
        yield pa.RecordBatch.from_pydict({
            "item_id": pa.array([r[0] for r in rows], batch.schema.field("item_id").type),
            "fp": pa.array([r[1] for r in rows], pa.int64()), "n": pa.array([r[2] for r in rows], pa.int32()),
            "item_at": pa.array([r[3] for r in rows], pa.int32()),
            "item_around": pa.array([r[4] for r in rows], pa.list_(pa.int64()))})


def _document_rows(batches: Iterator[pa.RecordBatch], k: int, window: int, bits: int,
                   shared: Broadcast) -> Iterator[pa.RecordBatch]:
    bitmap, short = shared.value
    reach = window - k

    def possible(values: np.ndarray) -> np.ndarray:
        slot = values >> np.uint64(64 - bits)
        return (bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) != 0

    for batch in batches:
        counts: list[int] = []
        held: list[list[dict]] = []
        for piece in W.slices(batch.column("text")):
            found = piece.words(W.ALNUM, lower=True)
            hashes = found.hashes()
            base = len(held)
            counts.extend(found.counts.tolist())
            held.extend([] for _ in range(len(found.counts)))
            where, values = fingerprints(hashes, found, k, window)
            tests = [(k, reach, where, values)]
            for n in short:
                starts = W.inside(found, n)
                tests.append((n, 0, starts, W.gram_hashes(hashes, n)[starts]))
            for n, more, positions, fps in tests:
                good = possible(fps)
                positions, fps = positions[good], fps[good]
                owner = np.searchsorted(found.of_text, positions, "right") - 1
                for position, fp, text in zip(positions.tolist(), W.signed(fps).tolist(), owner.tolist()):
                    first, last = int(found.of_text[text]), int(found.of_text[text + 1])
                    left = max(first, position - more)
                    held[base + text].append({
                        "pos": position - first, "fp": fp, "at": position - left,
                        "around": W.signed(hashes[left:min(last, position + n + more)]).tolist()})
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row"), pa.array(counts, pa.int64()), pa.array(held, _CANDIDATE_TYPE)],
            ["doc_id", "row", "n_words", "candidates"])


def _extended(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Meetings of fingerprints, extended both ways; those that make up a whole window are hits."""
    names = ("pos", "at", "around", "n", "item_at", "item_around")
    for batch in batches:
        keep, starts, ends = [], [], []
        for i, (pos, at, own, n, item_at, item) in enumerate(zip(*(batch.column(c).to_pylist() for c in names))):
            if own[at:at + n] != item[item_at:item_at + n]:
                continue
            left = right = 0
            if len(item) >= window:
                while left < min(at, item_at) and own[at - left - 1] == item[item_at - left - 1]:
                    left += 1
                after, item_after = at + n, item_at + n
                while (after + right < len(own) and item_after + right < len(item)
                       and own[after + right] == item[item_after + right]):
                    right += 1
                if left + n + right < window:
                    continue
            keep.append(i)
            starts.append(pos - left)
            ends.append(pos + n + right)
        rows = batch.select(["row", "item_id"]).take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
                                         ["row", "item_id", "first", "last"])


def item_fingerprints(items: DataFrame, k: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``(item_id, fp, n, item_at, item_around)``: kept fingerprints with the words around them."""
    kind = dict(items.dtypes)["item_id"]
    return items.select("item_id", "text").mapInArrow(
        lambda batches: _item_rows(batches, k, window),
        f"item_id {kind}, fp long, n int, item_at int, item_around array<long>")


def contaminated_spans(docs: DataFrame, items: DataFrame, k: int = GRAM,
                       window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, row, n_words)`` of all documents, and the hits ``(row, item_id, first, last)`` in word positions.

    ``row`` is a hash of doc_id and text: rows equal in both are one document and share their hits.
    """
    spark = docs.sparkSession
    prints = stage_table(item_fingerprints(items, k, window))
    slot = F.shiftrightunsigned("fp", 64 - BITMAP_BITS)
    cells = (prints.groupBy(F.shiftrightunsigned(slot, 6).alias("cell"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(fp, {64 - BITMAP_BITS}) & 63 as int))")
                           ).alias("bits")).collect())  # at most 2 ** (BITMAP_BITS - 6) rows
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for cell, bits in cells:
        bitmap[cell] = bits
    short = [r[0] for r in prints.filter(F.size("item_around") < window).select("n").distinct().collect()]  # < window
    shared = spark.sparkContext.broadcast((bitmap.view(np.uint64), sorted(short)))
    scanned = stage_table(docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text").mapInArrow(
        lambda batches: _document_rows(batches, k, window, BITMAP_BITS, shared),
        f"doc_id {dict(docs.dtypes)['doc_id']}, row long, n_words long, candidates {_CANDIDATES}"))
    met = (scanned.filter(F.size("candidates") > 0).select("row", F.explode("candidates").alias("c"))
           .select("row", "c.*").join(prints, "fp"))
    kind = dict(items.dtypes)["item_id"]
    hits = met.select("row", "pos", "at", "around", "n", "item_id", "item_at", "item_around").mapInArrow(
        lambda batches: _extended(batches, window), f"row long, item_id {kind}, first int, last int")
    return scanned.select("doc_id", "row", "n_words"), stage_table(hits.distinct())


def decontaminate(docs: DataFrame, items: DataFrame, k: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``(doc_id, row, n_words, n_hit, n_items, items_sha256, contaminated)`` for every row of ``docs``.

    ``docs`` needs doc_id and text, ``items`` needs item_id and text; further columns are ignored. A word inside any
    occurrence of an item's window is hit. ``n_items`` counts the distinct item_ids with an occurrence,
    ``items_sha256`` is the hash of these, sorted as strings and joined by commas. Null and wordless texts have no words
    and no windows. Items without an id still hit words but are not counted. Empty tables give no hits or no rows.
    """
    if not 0 < k <= window:
        raise ValueError("k must lie between 1 and window")
    every, hits = contaminated_spans(docs, items, k, window)
    words = (hits.select("row", "first", "last").distinct()
             .select("row", F.explode(F.sequence("first", F.col("last") - 1)).alias("word")).distinct()
             .groupBy("row").agg(F.count("*").alias("n_hit")))
    ids = (hits.filter("item_id IS NOT NULL").select("row", F.col("item_id").cast("string").alias("item")).distinct()
           .groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items")))
    n_hit, ids_of = F.coalesce("n_hit", F.lit(0)), F.coalesce("items", F.array().cast("array<string>"))
    return every.join(words.join(ids, "row", "left"), "row", "left").select(
        "doc_id", "row", "n_words", n_hit.cast("long").alias("n_hit"), F.size(ids_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids_of, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, items: DataFrame, k: int = GRAM, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any hit, with all their columns."""
    _, hits = contaminated_spans(docs, items, k, window)
    row = F.xxhash64(docs["doc_id"], docs["text"])
    gone = hits.select(F.col("row").alias("_row")).distinct()
    return docs.join(gone, row == F.col("_row"), "left_anti")


#: Rows of ``decontaminate`` without its row key, over the tables documents and benchmark.
SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT item_id, w, least(len(w), 10) AS n FROM bw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
        FROM bi, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)),
sizes AS (SELECT DISTINCT n FROM win),
dg AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM dw, sizes, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)),
hit AS (SELECT DISTINCT doc_id, item_id, i, n FROM dg JOIN win USING (n, s)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM hit, LATERAL (SELECT unnest(range(i, i + n)) AS p) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
