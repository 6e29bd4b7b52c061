"""Near-duplicate documents: one-permutation MinHash with optimal densification, star edges, exact confirmation.

1. Every document becomes its set of hashed word shingles; documents with equal sets are one class.
2. One permutation hashes the set of a class into bins of minima; an empty bin copies a full one that a fixed
   hash sequence of (bin, attempt) picks, the same for all sets. A band has some of the bins (``banding``).
3. Classes that share a band get a star-shaped edge to the smallest of the bucket, so a bucket of m classes makes m - 1
   edges. The components of these edges are the clusters of candidates; no candidate pair lies outside a cluster.
4. Inside a cluster, all links are found on full sets with an inverted index, one pair of cells of bounded size at a
   time, and only a spanning forest of the links of each pair of cells leaves the task.
5. The components of these links are the groups.

Bands follow the least similarity: 36 bands of 7 bins at 0.85, 46 of 6 at 0.8. Two sets that similar miss each other with
a chance of about 1e-6.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave.llm import words as W
from cropweave.llm.components import components
from cropweave.session import stage_table

SHINGLE = 5
PERCENT = 85
#: Chance that no band holds a pair of the least similarity, and the bins that bands may take together.
MISS, MOST_BINS = 1e-6, 288
BINS = 252
#: Cells of a large cluster: at least so many members, a cluster in about so many cells, and at most so many shingles.
CELL_MEMBERS, CELLS, CELL_SHINGLES = 64, 48, 1 << 21



def banding(percent: int) -> tuple[int, int]:
    """Bands, and bins of each, for pairs of at least ``percent``: the longest bands that ``MOST_BINS`` have room for."""
    if not 1 <= percent <= 100:
        raise ValueError("percent must be from 1 to 100")

    def bands(rows: int) -> int:
        meet = (percent / 100) ** rows
        return 1 if meet == 1 else math.ceil(math.log(MISS) / math.log1p(-meet))

    rows = 1
    while rows < 8 and (rows + 1) * bands(rows + 1) <= MOST_BINS:
        rows += 1
    return bands(rows), rows


_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(piece: W.Slice, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text of a slice; with fewer words than ``size``, the whole sequence."""
    found = piece.words(W.NOT_SPACE, lower=True)
    hashes = found.hashes()
    grams = W.gram_hashes(hashes, size)
    for first, last in zip(found.of_text[:-1].tolist(), found.of_text[1:].tolist()):
        n = last - first
        if n >= size:
            yield np.unique(grams[first:last - size + 1])
        elif n:
            yield W.gram_hashes(hashes[first:last], n)
        else:
            yield grams[:0]


_donors: dict[int, list[np.ndarray]] = {}


def donors(attempt: int, n_bins: int = BINS) -> np.ndarray:
    """For each bin, the bin that the given attempt of an empty bin looks at; the same for all sets."""
    known = _donors.setdefault(n_bins, [])
    while len(known) <= attempt:
        keys = np.arange(n_bins, dtype=np.uint64) + np.uint64(1 + len(known)) * np.uint64(1_000_003)
        known.append((W.mix(keys * W.MULTIPLIER) % np.uint64(n_bins)).astype(np.int64))
    return known[attempt]


def signature(shingles: np.ndarray, n_bins: int = BINS) -> np.ndarray:
    """Minimum of each bin of one permutation; empty bins are filled by optimal densification."""
    bins = ((shingles >> np.uint64(32)) * np.uint64(n_bins)) >> np.uint64(32)
    # sorted values fall into ascending bins, so the first of each bin is its minimum
    values = np.full(n_bins, _EMPTY)
    heads = np.flatnonzero(np.diff(bins, prepend=np.uint64(n_bins + 1)))
    values[bins[heads].astype(np.int64)] = shingles[heads]
    full = values != _EMPTY
    empty = np.flatnonzero(~full)
    out, attempt = values.copy(), 0
    while len(empty):
        source = donors(attempt, n_bins)[empty]
        good = full[source]
        out[empty[good]] = values[source[good]]
        empty = empty[~good]
        attempt += 1
    return out


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    keys = np.arange(len(values) // rows, dtype=np.uint64)
    for j in range(rows):
        keys = W.mix(keys * W.MULTIPLIER + values[j::rows])
    return keys


def _sketches(batches: Iterator[pa.RecordBatch], size: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, keys = [], [], []
        for piece in W.slices(batch.column("text")):
            for shingles in shingle_sets(piece, size):
                counts.append(len(shingles))
                if len(shingles):
                    digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                    keys.append(W.signed(band_keys(signature(shingles, bands * rows), rows)))
                else:
                    digests.append(None)
                    keys.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
             pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "class", "bands"])


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The full set of each class, from the text of one of its documents."""
    for batch in batches:
        at = 0
        wanted = batch.column("class").to_pylist()
        kept, sets = [], []
        for piece in W.slices(batch.column("text")):
            for shingles in shingle_sets(piece, size):
                # rows that share a doc_id have other texts; only the one of this class goes on
                if len(shingles) and hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() == wanted[at]:
                    kept.append(at)
                    sets.append(shingles.tobytes())
                at += 1
        rows = batch.select(["cluster", "node", "cells", "cell"]).take(pa.array(kept, pa.int64()))
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(sets, pa.binary())],
                                         ["cluster", "node", "cells", "cell", "shingles"])


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def links_of(nodes: list[int], sides: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between members of one pair of cells.

    Links inside a cell are looked for where only that cell is given; ``sides`` tells the cells apart.
    """
    n = len(nodes)
    if n < 2:
        return []
    two = len(set(sides)) > 1
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    side = np.array(sides)
    forest, found = _Forest(n), []
    first_side = sides[0]
    for x in range(n):
        if two and sides[x] != first_side:
            continue
        lo, hi = np.searchsorted(values, sets[x]), np.searchsorted(values, sets[x], "right")
        lengths = hi - lo
        shift = np.repeat(lo - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
        common = np.bincount(owner[np.arange(int(lengths.sum())) + shift], minlength=n)
        near = 100 * common >= percent * (sizes + sizes[x] - common)
        near[x] = False
        if two:
            near &= side != first_side
        for y in np.flatnonzero(near).tolist():
            if forest.join(x, y):
                found.append((nodes[x], nodes[y]))
    return found


def _links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links of each unit; rows of a unit stand together, as the partition is sorted by it."""
    unit, nodes, sides, sets = None, [], [], []

    def done() -> pa.RecordBatch:
        found = links_of(nodes, sides, sets, percent)
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()),
                                           pa.array([b for _, b in found], pa.int64())], ["a", "b"])

    for batch in batches:
        for key, node, cell, raw in zip(zip(*(batch.column(c).to_pylist() for c in ("cluster", "low", "high"))),
                                        *(batch.column(c).to_pylist() for c in ("node", "cell", "shingles"))):
            if key != unit:
                if len(nodes) > 1:
                    yield done()
                unit, nodes, sides, sets = key, [], [], []
            nodes.append(node)
            sides.append(cell)
            sets.append(np.frombuffer(raw, np.uint64))
    if len(nodes) > 1:
        yield done()


def clusters(sketches: DataFrame) -> DataFrame:
    """``(node, class, cluster, cells, cell)`` of the classes that share a band with another one."""
    classes = stage_table(sketches.filter("class IS NOT NULL AND doc_id IS NOT NULL").groupBy("class")
                          .agg(F.min(F.struct("doc_id", "n_shingles", "bands")).alias("r"))
                          .select("class", F.col("r.doc_id").alias("node"), "r.n_shingles", "r.bands"))
    banded = classes.select("node", F.explode("bands").alias("band"))
    centers = banded.groupBy("band").agg(F.min("node").alias("center"), F.max("node").alias("other"))
    edges = (banded.join(centers.filter("center <> other").select("band", "center").hint("merge"), "band")
             .filter("node <> center").select(F.col("node").alias("a"), F.col("center").alias("b")))
    found = components(edges)
    members = (classes.select("node", "class", "n_shingles").join(found, "node")
               .withColumnRenamed("root", "cluster"))
    sizes = members.groupBy("cluster").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("n"))
    cells = F.when(F.col("m") <= 2 * CELL_MEMBERS, F.lit(1)).otherwise(
        F.least(F.ceil(F.col("m") / CELL_MEMBERS), F.lit(CELLS)))
    sizes = sizes.select("cluster", F.greatest(cells, F.ceil(F.col("n") / CELL_SHINGLES)).cast("int").alias("cells"))
    return (members.join(sizes, "cluster")
            .withColumn("cell", F.pmod(F.xxhash64("node", "class"), F.col("cells")).cast("int")))


def confirmed_links(docs: DataFrame, members: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` on full sets that join all similar members of each cluster."""
    # the candidates grow with the documents, so they are never broadcast
    texts = docs.select(F.col("doc_id").alias("node"), "text").join(members.drop("n_shingles").hint("merge"), "node")
    sets = texts.select("text", "class", "cluster", "node", "cells", "cell").mapInArrow(
        lambda batches: _sets(batches, shingle), "cluster long, node long, cells int, cell int, shingles binary")
    # a cell meets itself and every other cell: the unit (low, high) is made once on each side
    units = sets.select("*", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("peer")).select(
        "cluster", F.least("cell", "peer").alias("low"), F.greatest("cell", "peer").alias("high"), "node", "cell",
        "shingles")
    dealt = units.repartition("cluster", "low", "high").sortWithinPartitions("cluster", "low", "high", "cell", "node")
    return dealt.mapInArrow(lambda batches: _links(batches, percent), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``; needs ``doc_id`` and ``text``.

    Two documents are linked when ``100 * intersection >= percent * union`` of their shingle sets. ``component_id`` is
    the smallest ``doc_id`` reachable, ``kept`` marks the document that has it. Texts that are null or have no words
    have no shingles and no links. ``percent`` is from 1 to 100. Rows that share a ``doc_id`` are one document with several texts. Rows without a
    ``doc_id`` have no component and are kept. Further columns are ignored. An empty table gives an empty table.
    """
    bands, rows = banding(percent)
    sketches = stage_table(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda batches: _sketches(batches, shingle, bands, rows),
        "doc_id long, n_shingles long, class binary, bands array<long>"))
    members = stage_table(clusters(sketches))
    links = confirmed_links(docs.select(F.col("doc_id").cast("long"), "text"), members, shingle, percent)
    # documents of a class hang on its node
    classes = sketches.filter("class IS NOT NULL AND doc_id IS NOT NULL").groupBy("class").agg(
        F.min("doc_id").alias("node"))
    held = stage_table(sketches.select("doc_id", "n_shingles", "class").join(classes, "class", "left")
                       .select("doc_id", "n_shingles", "node"))
    groups = components(links.unionByName(held.filter("doc_id <> node").select(
        F.col("doc_id").alias("a"), F.col("node").alias("b"))))
    own = F.coalesce("root", "doc_id")
    return (held.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", own.alias("component_id"),
                    F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept")))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM w, LATERAL (SELECT unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached),
m AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id)
SELECT m.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, m.doc_id = component_id AS kept
FROM m LEFT JOIN n USING (doc_id)
"""
