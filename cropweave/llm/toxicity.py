"""Toxic passages: maximal scoring segments over word log-odds, with extreme-value calibration.

1. The training texts of each class that hold a word or word beginning are counted. With a Dirichlet prior in proportion to
   their overall frequency they get a log-odds of the toxic class and its standard deviation; those that are
   significant make up the model, at the lower end of their interval. A word scores as its strongest known form.
2. Other words score a little below zero: the log-ratio of their share in toxic and in clean text. So the mean score of
   clean text is negative, and a linear-time scan finds every maximal scoring segment of a text.
3. A segment of score S in a text of n words has the normalised score ``lam * S - ln(K * n)``, with ``lam`` and ``K`` of
   the extreme-value distribution of the best segment of clean text. The significant ones are summed.
4. A logistic curve over that sum, fitted on the training texts, gives the score from 0 to 1.

Only text is an input of a score. The training sample has a documented bound (``TRAIN_DOCS`` labelled documents, taken
by a hash of doc_id); all documents are scored whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropweave.llm import words as W
from cropweave.session import stage_table

#: Bound of the training sample, in documents.
TRAIN_DOCS = 20_000
#: Lengths in bytes of the beginnings of words that are counted beside whole words.
PREFIXES = (4, 5, 6, 8)
PRIOR_WORDS = 200.0
MIN_COUNT = 3
SIGNIFICANT = math.log(20.0)
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1


def held_out(doc_id: Column) -> Column:
    """True for the rows that training never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def _forms(found: W.Words) -> Iterator[np.ndarray]:
    """Hashes of each word and of its beginnings, one array a length; shorter words have no such beginning."""
    yield found.hashes()
    full = found.ends
    for length in PREFIXES:
        found.ends = np.minimum(full, found.starts + length)
        hashes = found.hashes()
        yield np.where(full - found.starts > length, W.mix(hashes + np.uint64(length)), np.uint64(0))
    found.ends = full


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and clean texts of a task each form stands; form 0 adds these up over the whole words."""
    for batch in batches:
        toxic = np.array(batch.column("toxic").to_pylist(), dtype=bool)
        for piece in W.slices(batch.column("text")):
            found = piece.words(W.ALNUM, lower=True)
            text = found.text_of_word()
            bad = toxic[piece.first:piece.last][text]
            forms = []
            for hashes in _forms(found):
                _, once = np.unique(W.mix(hashes + text.astype(np.uint64) * W.MULTIPLIER), return_index=True)
                once = once[hashes[once] != 0]
                values, inverse = np.unique(hashes[once], return_inverse=True)
                hit = np.bincount(inverse, weights=bad[once], minlength=len(values)).astype(np.int64)
                if not forms:
                    forms.append((np.zeros(1, np.uint64), np.array([hit.sum()]), np.array([len(once) - hit.sum()])))
                forms.append((values, hit, np.bincount(inverse, minlength=len(values)) - hit))
            yield pa.RecordBatch.from_arrays(
                [pa.array(W.signed(np.concatenate([f[0] for f in forms]))),
                 pa.array(np.concatenate([f[1] for f in forms]).astype(np.int64)),
                 pa.array(np.concatenate([f[2] for f in forms]).astype(np.int64))], ["form", "bad", "good"])


def log_odds(bad: np.ndarray, good: np.ndarray, n_bad: int, n_good: int) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of the toxic class and its standard deviation, with a Dirichlet prior of PRIOR_WORDS words."""
    prior = PRIOR_WORDS * (bad + good) / max(1, n_bad + n_good) + 1e-9
    rate_bad = (bad + prior) / (n_bad + PRIOR_WORDS - bad - prior).clip(1)
    rate_good = (good + prior) / (n_good + PRIOR_WORDS - good - prior).clip(1)
    return np.log(rate_bad) - np.log(rate_good), np.sqrt(1 / (bad + prior) + 1 / (good + prior + 0.5))


def significance(bad: np.ndarray, good: np.ndarray, n_bad: int, n_good: int) -> np.ndarray:
    """Signed root of the likelihood ratio against an equal rate in both classes."""
    share = n_bad / (n_bad + n_good)
    expected, rest = (bad + good) * share, (bad + good) * (1 - share)
    ratio = 2 * (bad * np.log(np.maximum(bad, 1e-12) / expected) + good * np.log(np.maximum(good, 1e-12) / rest))
    return np.sign(bad - expected) * np.sqrt(np.maximum(ratio, 0))


def segments(places: list[int], values: list[float], length: int, drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, last + 1, score)`` of a text, in one pass (Ruzzo and Tompa).

    ``places`` are the words with a positive value, every other of the ``length`` words scores ``-drift``.
    """
    kept: list[tuple[float, float, int, int]] = []  # sum before it, sum with it, first, last + 1
    total, at = 0.0, 0
    for place, value in zip(places, values):
        total -= drift * (place - at)
        left, total, at = total, total + value, place + 1
        segment = (left, total, place, place + 1)
        while True:
            j = len(kept) - 1
            skipped = []
            while j >= 0 and kept[j][0] >= segment[0]:
                skipped.append(j)
                j -= 1
            if j < 0 or kept[j][1] >= segment[1]:
                kept.append(segment)
                break
            segment = (kept[j][0], segment[1], kept[j][2], segment[3])
            del kept[j:]
    return [(first, last, high - low) for low, high, first, last in kept]


@dataclass
class Model:
    """Forms with their scores, and the constants of the calibration."""

    forms: np.ndarray
    values: np.ndarray
    drift: float = 0.05
    lam: float = 1.0
    k: float = 1.0
    slope: float = 1.0
    shift: float = 0.0

    def __post_init__(self) -> None:
        self.known = np.zeros(1 << 16, bool)
        self.known[(self.forms >> np.uint64(48)).astype(np.int64)] = True

    def positive_words(self, found: W.Words) -> tuple[np.ndarray, np.ndarray]:
        """Words with a positive score, and the scores."""
        best = np.zeros(len(found.starts))
        if len(self.forms):
            for hashes in _forms(found):
                maybe = np.flatnonzero(self.known[(hashes >> np.uint64(48)).astype(np.int64)])
                at = np.searchsorted(self.forms, hashes[maybe]).clip(max=len(self.forms) - 1)
                hit = self.forms[at] == hashes[maybe]
                best[maybe[hit]] = np.maximum(best[maybe[hit]], self.values[at[hit]])
        where = np.flatnonzero(best > 0)
        return where, best[where]

    def passages(self, piece: W.Slice) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
        """For each text of a slice its number of words and its maximal segments."""
        found = piece.words(W.ALNUM, lower=True)
        where, scores = self.positive_words(found)
        bounds = np.searchsorted(where, found.of_text)
        for text, n in enumerate(found.counts.tolist()):
            a, b = bounds[text], bounds[text + 1]
            if a == b:
                yield n, []
            else:
                yield n, segments((where[a:b] - found.of_text[text]).tolist(), scores[a:b].tolist(), n, self.drift)

    def normalised(self, score: float, n: int) -> float:
        return self.lam * score - math.log(max(self.k * n, 1e-12))

    def evidence(self, n: int, found: list[tuple[int, int, float]]) -> float:
        return math.log1p(sum(x for _, _, s in found if (x := self.normalised(s, n)) > SIGNIFICANT))

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * evidence + self.shift))))


def _extreme_values(model: Model, texts: list[tuple[int, list]], lam_words: tuple[np.ndarray, int]) -> None:
    """``lam`` solves sum p(s) exp(lam s) = 1 over the words of clean text; ``K`` is its likeliest value given lam."""
    positive, n_words = lam_words
    rest = max(1, n_words - len(positive))
    # a clean text without any positive word still says that they are rarer than one in its number of words
    scores = np.append(positive, model.values.max() if len(model.values) else 1.0)

    def excess(lam: float) -> float:
        return (np.exp(np.minimum(lam * scores, 700)).sum() + rest * math.exp(-lam * model.drift)) / (rest + len(scores)) - 1

    low, high = 1e-3, 4.0
    if excess(low) < 0:
        while excess(high) < 0 and high < 64:
            high *= 2
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    model.lam = low
    weights = sum(n * math.exp(-model.lam * max((s for _, _, s in found), default=0.0)) for n, found in texts)
    model.k = max(1, len(texts)) / max(weights, 1.0)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, with a small ridge on the slope."""
    w = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], axis=1)
    ridge = np.diag([1e-2, 1e-4])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + ridge @ w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> Model:
    """A model from at most about ``limit`` labelled documents outside the held-out rows.

    Without labelled rows of both classes the model knows no forms and every text gets the same score.
    """
    spark = docs.sparkSession
    usable = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id"))).groupBy(
        "doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    n = usable.count()
    share = min(1.0, limit / max(1, n))
    sample = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    texts = stage_table(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic"))
    counted = texts.mapInArrow(_counts, "form long, bad long, good long").groupBy("form").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")).filter(f"bad >= {MIN_COUNT} OR form = 0")
    rows = counted.toPandas()  # forms of the bounded sample
    total = rows[rows.form == 0]
    if not len(total) or not total.bad.iloc[0] or not total.good.iloc[0]:
        return Model(np.zeros(0, np.uint64), np.zeros(0), shift=-3.0)
    n_bad, n_good = int(total.bad.iloc[0]), int(total.good.iloc[0])
    rows = rows[rows.form != 0]
    delta, sigma = log_odds(rows.bad.to_numpy(float), rows.good.to_numpy(float), n_bad, n_good)
    # as many tests as forms: the largest of them would reach about this by chance alone
    least = math.sqrt(2 * math.log(max(2, len(rows))))
    tests = significance(rows.bad.to_numpy(float), rows.good.to_numpy(float), n_bad, n_good)
    strong = (delta > math.log(4)) & (tests > least)
    forms, values = rows.form.to_numpy(np.int64).view(np.uint64)[strong], (delta - sigma)[strong]
    order = np.argsort(forms)
    model = Model(forms[order], values[order])
    shared = spark.sparkContext.broadcast(model)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for piece in W.slices(batch.column("text")):
                found = piece.words(W.ALNUM, lower=True)
                where, scores = shared.value.positive_words(found)
                bounds = np.searchsorted(where, found.of_text)
                for text, n_words in enumerate(found.counts.tolist()):
                    a, b = bounds[text], bounds[text + 1]
                    out.append((n_words, (where[a:b] - found.of_text[text]).tolist(), scores[a:b].tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.list_(pa.int64())),
                 pa.array([o[2] for o in out], pa.list_(pa.float64())), batch.column("toxic")],
                ["n", "places", "scores", "toxic"])

    found = texts.mapInArrow(seen, "n long, places array<long>, scores array<double>, toxic boolean").toPandas()
    hits = np.array([len(p) for p in found.places])
    toxic = found.toxic.to_numpy(bool)
    n_words = found.n.to_numpy()
    density_bad = hits[toxic].sum() / max(1, n_words[toxic].sum())
    density_good = (hits[~toxic].sum() + 1) / max(1, n_words[~toxic].sum() + 1)
    model.drift = max(0.005, math.log((1 - density_good) / max(1e-6, 1 - min(0.5, max(density_bad, density_good)))))
    texts_found = [(int(n), segments(list(p), list(s), int(n), model.drift)) for n, p, s in
                   zip(found.n, found.places, found.scores)]
    clean = [t for t, bad in zip(texts_found, toxic) if not bad]
    positive = np.concatenate([np.zeros(0), *(s for s, bad in zip(found.scores, toxic) if not bad)])
    _extreme_values(model, clean, (positive, int(n_words[~toxic].sum())))
    evidence = np.array([model.evidence(n, s) for n, s in texts_found])
    model.slope, model.shift = _logistic(evidence, toxic.astype(float))
    return model


def score_documents(docs: DataFrame, model: Model, extra: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, *extra, score, n_passages, passages)`` for every row of ``docs``.

    ``passages`` lists the significant passages as ``first`` and ``last`` word (end exclusive) and normalised score.
    Null, empty and wordless texts get the score of a text without toxic passages. Needs doc_id and text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = dict(docs.dtypes)
    kept = ("doc_id", *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            scores, passages = [], []
            for piece in W.slices(batch.column("text")):
                for n, found in m.passages(piece):
                    good = [{"first": a, "last": b, "score": x} for a, b, s in found
                            if (x := m.normalised(s, n)) > SIGNIFICANT]
                    passages.append(good)
                    scores.append(m.score(math.log1p(sum(p["score"] for p in good))))
            kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(scores, pa.float64()),
                 pa.array([len(p) for p in passages], pa.int32()), pa.array(passages, kind)],
                [*kept, "score", "n_passages", "passages"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept)
    return docs.select(*kept, "text").mapInArrow(
        run, f"{schema}, score double, n_passages int, passages array<struct<first:int,last:int,score:double>>")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted, n_passages, passages)`` for every row of ``docs``."""
    scored = score_documents(docs, train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_passages", "passages")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score stays under the threshold, with all their columns."""
    model = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [shared.value.score(shared.value.evidence(n, found)) < THRESHOLD
                    for piece in W.slices(batch.column("text")) for n, found in shared.value.passages(piece)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
