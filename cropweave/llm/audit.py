"""What document filters remove in every order: contingency tensors of their failures, contracted by ``einsum``.

1. Every document gets one bit a filter: whether it fails it on its own, whatever the others do.
2. Spark counts documents by part, pattern of the bits and label, so a part is at most 2^5 cells of three counts.
3. The cells of a part are a 2x2x2x2x2 tensor. A step of an order is one selector a axis: filters before it pass, its own
   filter fails or passes, the later ones take all. All steps of all orders are contracted at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
CELLS = 1 << len(FILTERS)
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_PASS, _FAIL, _ALL = (1, 0), (0, 1), (1, 1)


def failures(text: Column) -> dict[str, Column]:
    """Whether a text fails each of the filters that need nothing but the text."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def patterns(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, pattern, n, good, toxic)``: documents by their bits (filter A is bit 0), and those with either label."""
    text = F.coalesce("text", F.lit(""))
    bits = sum((F.when(v, 1 << FILTERS.index(k)).otherwise(0) for k, v in failures(F.col("body")).items()), F.lit(0))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), text.alias("body"))
            .select("doc_id", "part", F.sha2("body", 256).alias("digest"), bits.alias("bits")))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    # the join leaves rows dealt by doc_id, which the first aggregate needs too
    key = ("digest", "part", "good", "toxic")
    marked = rows.join(marks, "doc_id", "left").select(
        "doc_id", "digest", "part", "bits", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    by_id = marked.groupBy("doc_id", *key).agg(F.count("*").alias("n"), F.first("bits").alias("bits"))
    # equal texts have equal bits; of each text and label only the smallest doc_id and the counts go on
    numbered = F.col("doc_id").isNotNull()
    of_text = by_id.groupBy(*key).agg(
        F.first("bits").alias("bits"), F.sum("n").alias("n"),
        F.min(F.when(numbered, F.struct("doc_id", "n"))).alias("first"),
        F.coalesce(F.sum(F.when(~numbered, F.col("n"))), F.lit(0)).alias("unnumbered"))
    smallest = of_text.groupBy("digest").agg(F.min("first.doc_id").alias("smallest"))
    split = of_text.join(smallest, "digest").select(
        "part", "bits", "good", "toxic", "n",
        (F.col("unnumbered") + F.when(F.col("first.doc_id") == F.col("smallest"), F.col("first.n")).otherwise(0)).alias("unique"))
    e = 1 << FILTERS.index("E")
    cells = split.select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("bits").alias("pattern"), F.col("unique").alias("n")),
        F.struct((F.col("bits") + e).alias("pattern"), (F.col("n") - F.col("unique")).alias("n")))))
    return cells.groupBy("part", "pattern").agg(F.sum("n").alias("n"), *[
        F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")])


def steps() -> list[tuple[str, int]]:
    return [("".join(order), step) for order in permutations(FILTERS) for step in range(1, len(FILTERS) + 1)]


def _selected(tensors: np.ndarray, choose) -> np.ndarray:
    """One count a part and step; ``choose(order, step, filter)`` is the selector of that filter's axis."""
    axes = [np.array([choose(order, step, f) for order, step in steps()], np.int64) for f in FILTERS]
    return np.einsum("pabcde,sa,sb,sc,sd,se->ps", tensors, *axes, optimize=True)


def contract(counts: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """All measures of all steps for tensors of the shape (parts, 2, 2, 2, 2, 2), each of the shape (parts, steps)."""
    def walk(own, later=_ALL, before=_PASS):
        return lambda order, step, f: own if f == order[step - 1] else before if f in order[:step - 1] else later

    removed = _selected(counts, walk(_FAIL))
    own = np.array([FILTERS.index(order[step - 1]) for order, step in steps()])
    by_filter = np.stack([removed[:, own == k].sum(axis=1) for k in range(len(FILTERS))], axis=1)
    return {
        "kept": _selected(counts, walk(_PASS)),
        "removed": removed,
        "redundant": _selected(counts, walk(_FAIL, before=_ALL)) - removed,
        "unique_fails": _selected(counts, walk(_FAIL, later=_PASS)),
        "good_lost": _selected(good, walk(_FAIL)),
        "toxic_lost": _selected(toxic, walk(_FAIL)),
        "shapley": by_filter[:, own],
    }


def _reports(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    orders, numbers = zip(*steps())
    for frame in frames:
        # A is bit 0 of a pattern and the first axis, so the axes of the cells in order stand the other way round
        tensors = [np.stack(frame[c].to_numpy()).astype(np.int64).reshape(-1, *(2,) * len(FILTERS))
                   .transpose(0, *range(len(FILTERS), 0, -1)) for c in ("n", "good", "toxic")]
        measures = contract(*tensors)
        yield pd.DataFrame({
            "part": np.repeat(frame["part"].to_numpy(), len(orders)), "filter_order": list(orders) * len(frame),
            "step": np.tile(np.array(numbers, np.int32), len(frame)), **{m: measures[m].ravel() for m in MEASURES}})


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``.

    One row per part (value of ``lang``, null counts as the empty string), order of the five filters and step. ``docs``
    needs ``doc_id``, ``text`` and ``lang``, ``labels`` needs ``doc_id``, ``quality`` and ``toxic``; further columns are
    ignored. A null text is empty; an empty text fails A only, and E if a smaller ``doc_id`` has one. Rows that share
    the smallest ``doc_id`` of a text are all first; rows without a ``doc_id`` neither repeat a text nor make others
    repeat it, and have no labels. A document is good or toxic when any of its label rows says so. No documents: no rows.
    """
    cells = patterns(docs, labels)
    tensor = lambda c: F.array(*[
        F.coalesce(F.sum(F.when(F.col("pattern") == i, F.col(c))), F.lit(0)) for i in range(CELLS)]).alias(c)
    parts = cells.groupBy("part").agg(*[tensor(c) for c in ("n", "good", "toxic")])
    counts = ", ".join(f"{m} long" for m in MEASURES)
    return parts.mapInPandas(_reports, f"part string, filter_order string, step int, {counts}")


SQL = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY text) AS lowest FROM t),
f AS (SELECT doc_id, part, list_filter([
  CASE WHEN len(w) < 100 THEN 'A' END,
  CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' END,
  CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) THEN 'C' END,
  CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
  CASE WHEN doc_id > lowest THEN 'E' END], lambda x: x IS NOT NULL) AS failed FROM w),
m AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT part, failed, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic
      FROM f LEFT JOIN m USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step::INTEGER AS step, substr(filter_order, step, 1) AS own,
             string_split(left(filter_order, step - 1), '') AS before
      FROM o, range(1, 6) r(step)),
h AS (SELECT *, list_contains(failed, own) AS fails, len(list_intersect(failed, before)) > 0 AS gone FROM d, s),
r AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (fails AND len(failed) = 1), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost
      FROM h GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""
