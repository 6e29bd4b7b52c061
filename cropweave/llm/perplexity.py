"""Quality rules: basic text measures, and perplexity bands under a modified Kneser-Ney model of characters.

The model has one set of n-grams of ``ORDER`` characters per language. Spark counts them over all texts, and the tables
of lower orders, discounts and back-off weights follow by joins and aggregates. As every n-gram of the corpus is in the
highest table, its interpolated probability is worked out once there, and scoring is a single look-up. The probabilities
are kept as sorted arrays of 64-bit hashes with 32-bit floats, in parts of bounded size in the shared folder. Texts are
scored against one part after the other and the sums of the parts are added, so the memory of a task does not grow with
the model.

A document is rejected where the basic rules fail, or where its mean log-probability per character lies outside the
lower or upper band of its language: the quartiles, moved out by ``BAND`` times their distance, with a further margin
for short texts, whose means vary more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropweave.llm import storage
from cropweave.llm import words as W
from cropweave.session import stage_table

ORDER = 4
#: n-grams in one part of the model (12 bytes each).
PART_GRAMS = 8 << 20
#: Bytes of text that n-gram arrays are made for at once; each byte takes some 100 bytes of arrays.
SLICE = 1 << 20
BAND = 4.0
MIN_WORDS, REPEAT_WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30
SYMBOLS = "#*$%&|<>"

_MODELS: dict[tuple[str, int], tuple[W.SortedHashes, np.ndarray]] = {}


def _codes(piece: W.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a slice and the offset of each text among them; white space is one kind, NUL is replaced."""
    chars = np.frombuffer(piece.data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    heads = np.zeros(len(piece.data) + 1, np.int64)
    np.cumsum((piece.data & 0xC0) != 0x80, out=heads[1:])
    chars = np.where((chars <= 13) & (chars >= 9), np.uint32(32), chars)
    return np.where(chars == 0, np.uint32(0xFFFD), chars), heads[piece.bounds]


def _grams(codes: np.ndarray, bounds: np.ndarray, langs: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every n-gram that lies within one text; ``langs`` are language hashes of the texts."""
    n = len(codes) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sizes = np.diff(bounds)
    ends = np.repeat(bounds[1:], sizes)[:n]
    starts = np.flatnonzero(np.arange(n) + order <= ends)
    wide = codes.astype(np.uint64)
    total = np.repeat(langs, sizes)[:n].copy()
    for j in range(order):
        total *= W.MULTIPLIER
        total += wide[j:j + n]
    return starts, W.mix(total[starts])


def _language(values: list) -> np.ndarray:
    known: dict = {}
    for v in values:
        if v not in known:
            data = np.frombuffer(f"{v is None}{v or ''}".encode(), np.uint8)
            known[v] = int(W.mix(np.array([np.bitwise_xor.reduce(W.mix(
                W.CODES[data] + np.arange(len(data), dtype=np.uint64)))]))[0])
    return np.array([known[v] for v in values], np.uint64)


def _count_grams(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """Distinct n-grams of each batch with their counts."""
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        hashed = _language(langs)
        parts = []
        for piece in W.slices(batch.column("text"), SLICE):
            codes, bounds = _codes(piece)
            starts, grams = _grams(codes, bounds, hashed[piece.first:piece.last], order)
            if not len(starts):
                continue
            by = np.argsort(grams)
            ordered = grams[by]
            heads = np.flatnonzero(np.diff(ordered, prepend=~ordered[:1]))
            counts = np.diff(np.append(heads, len(ordered)))
            at = starts[by[heads]]
            text = np.searchsorted(bounds, at, "right") - 1 + piece.first
            parts.append((ordered[heads], counts, codes[at[:, None] + np.arange(order)], text))
        if not parts:
            continue
        keys, counts, chars, text = (np.concatenate(x) for x in zip(*parts))
        values, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        total = np.bincount(inverse, weights=counts).astype(np.int64)
        strings = np.ascontiguousarray(chars[first]).view(f"<U{order}").ravel().tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([langs[t] for t in text[first].tolist()], pa.string()), pa.array(strings, pa.string()),
             pa.array(total)], ["lang", "gram", "c"])


def _levels(top: DataFrame, order: int) -> dict[int, DataFrame]:
    """Counts of the highest order; below it, how many characters precede each n-gram."""
    levels = {order: top}
    for n in range(order - 1, 0, -1):
        levels[n] = levels[n + 1].groupBy("lang", F.substring("gram", 2, n).alias("gram")).agg(F.count("*").alias("c"))
    return levels


def _discounts(level: DataFrame) -> DataFrame:
    """Modified Kneser-Ney discounts of each language from its counts of counts, with plain values where one is 0."""
    n = level.groupBy("lang").agg(*(F.sum((F.col("c") == i).cast("double")).alias(f"n{i}") for i in (1, 2, 3, 4)))
    y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))

    def discount(i: int) -> Column:
        value = i - (i + 1) * y * F.try_divide(f"n{i + 1}", f"n{i}")
        whole = (F.col("n1") > 0) & (F.col(f"n{i}") > 0)
        return F.when(whole, F.greatest(F.lit(0.1), F.least(F.lit(float(i)) - 0.1, value))).otherwise(F.lit(i - 0.5))

    return n.select("lang", *(discount(i).alias(f"d{i}") for i in (1, 2, 3)))


def probabilities(top: DataFrame, order: int = ORDER) -> DataFrame:
    """``(lang, gram, p)``: interpolated modified Kneser-Ney probability of the last character after the others.

    ``top`` holds ``(lang, gram, c)`` of all n-grams of the corpus.
    """
    levels = _levels(top, order)
    size = levels[1].groupBy("lang").agg(F.count("*").alias("size"))
    lower = None
    for n in range(1, order + 1):
        level = levels[n].withColumns({"context": F.substring("gram", 1, n - 1)})
        # languages are few and their row is small: Spark broadcasts these by their size
        level = level.join(_discounts(levels[n]).withColumnRenamed("lang", "_l"), F.expr("lang <=> _l")).drop("_l")
        discount = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        level = level.withColumn("taken", discount)
        context = level.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.sum("taken").alias("freed"))
        level = level.join(context.select(F.col("lang").alias("_l"), F.col("context").alias("_c"), "total", "freed"),
                           F.expr("lang <=> _l AND context = _c")).drop("_l", "_c")
        if lower is None:
            below = level.join(size.withColumnRenamed("lang", "_l"), F.expr("lang <=> _l")).drop("_l").withColumn(
                "q", 1 / F.col("size"))
        else:
            below = level.withColumn("tail", F.substring("gram", 2, n - 1)).join(
                lower.select(F.col("lang").alias("_l"), F.col("gram").alias("_g"), F.col("p").alias("q")),
                F.expr("lang <=> _l AND tail = _g")).drop("_l", "_g")
        lower = below.select("lang", "gram", (F.greatest(F.col("c") - F.col("taken"), F.lit(0.0)) / F.col("total")
                                              + F.col("freed") / F.col("total") * F.col("q")).alias("p"))
    return lower


def _hashed(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = _language(batch.column("lang").to_pylist())
        total = langs.copy()
        grams = batch.column("gram").to_pylist()
        codes = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).astype(np.uint64).reshape(-1, order)
        for j in range(order):
            total *= W.MULTIPLIER
            total += codes[:, j]
        yield pa.RecordBatch.from_arrays(
            [pa.array(W.signed(W.mix(total))), pa.array(np.log(np.array(batch.column("p"))).astype(np.float32))],
            ["h", "logp"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted partition as two arrays in one row."""
    tables = [b for b in batches if len(b)]
    if tables:
        whole = pa.Table.from_batches(tables)
        keys = whole.column("h").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        yield pa.RecordBatch.from_arrays(
            [pa.array([whole.column("part")[0].as_py()], pa.int32()), pa.array([keys[order].tobytes()], pa.binary()),
             pa.array([whole.column("logp").to_numpy()[order].astype("<f4").tobytes()], pa.binary())],
            ["part", "hashes", "logps"])


def build_model(docs: DataFrame, order: int = ORDER, part_grams: int = PART_GRAMS) -> tuple[str, int]:
    """Count, estimate and store the model; its folder and number of parts."""
    spark = docs.sparkSession
    top = stage_table(docs.select("lang", "text").mapInArrow(
        lambda batches: _count_grams(batches, order), "lang string, gram string, c long")
        .groupBy("lang", "gram").agg(F.sum("c").alias("c")))
    parts = max(1, -(-top.count() // part_grams))
    hashed = probabilities(top, order).mapInArrow(lambda batches: _hashed(batches, order), "h long, logp float")
    part = F.pmod(F.shiftrightunsigned("h", 20), F.lit(parts)).cast("int")
    folder = storage.new_folder(spark, "model")
    (hashed.withColumn("part", part).repartition(parts, "part").sortWithinPartitions("part", "h")
     .mapInArrow(_by_part, "part int, hashes binary, logps binary").write.partitionBy("part").parquet(folder))
    return folder, parts


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        parts = batch.column("part").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                if held and held[0].column("part")[0].as_py() != int(parts[a]):
                    yield from _packed(iter(held))
                    held = []
                held.append(batch.slice(a, b - a))
    yield from _packed(iter(held))


def _load(folder: str, part: int) -> tuple[W.SortedHashes, np.ndarray]:
    """Sorted hashes of a part and their log-probabilities; kept by the worker."""
    if (folder, part) not in _MODELS:
        _MODELS.clear()
        store, place = storage.located(f"{folder}/part={part}")
        hashes, logps = [], []
        for info in store.get_file_info(storage.fs.FileSelector(place, allow_not_found=True)):
            if info.path.endswith(".parquet"):
                rows = pq.read_table(info.path, filesystem=store, columns=["hashes", "logps"], partitioning=None)
                hashes += [np.frombuffer(x, np.uint64) for x in rows.column("hashes").to_pylist()]
                logps += [np.frombuffer(x, "<f4") for x in rows.column("logps").to_pylist()]
        keys = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        values = np.concatenate(logps) if logps else np.zeros(0, np.float32)
        order = np.argsort(keys)
        _MODELS[folder, part] = W.SortedHashes(keys[order]), values[order]
    return _MODELS[folder, part]


def _look_up(wanted: np.ndarray, model: tuple[W.SortedHashes, np.ndarray]) -> np.ndarray:
    """Log-probability of each hash; 0 where this part does not hold it."""
    table, values = model
    at = table.find(wanted)
    return np.where(at < 0, 0.0, values[at].astype(np.float64)) if len(values) else np.zeros(len(wanted))


def _measures(piece: W.Slice) -> Iterator[tuple[int, int, int, int, int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    data, found = piece.data, piece.words(W.NOT_SPACE, lower=False)
    head = np.zeros(len(data) + 1, np.int64)
    np.cumsum(((data & 0xC0) != 0x80) & W.NOT_SPACE[data], out=head[1:])
    marks = np.zeros(256, bool)
    marks[np.frombuffer(SYMBOLS.encode(), np.uint8)] = True
    sign = np.zeros(len(data) + 1, np.int64)
    np.cumsum(marks[data], out=sign[1:])
    chars, symbols = np.diff(head[piece.bounds]), np.diff(sign[piece.bounds])
    hashes = found.hashes()
    starts = W.inside(found, REPEAT_WINDOW)
    windows = W.gram_hashes(hashes, REPEAT_WINDOW)[starts]
    text = np.searchsorted(found.of_text, starts, "right") - 1
    _, inverse, counts = np.unique(W.mix(windows + text.astype(np.uint64) * W.MULTIPLIER), return_inverse=True,
                                   return_counts=True)
    again = starts[counts[inverse] > 1]
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + REPEAT_WINDOW, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(edge)[:-1] > 0)))
    repeats = np.diff(covered[found.of_text])
    raw = data.tobytes()
    for i, n in enumerate(found.counts.tolist()):
        seen: set[bytes] = set()
        dup = 0
        for line in raw[piece.bounds[i]:piece.bounds[i + 1]].split(b"\n"):
            if line in seen:
                dup += 1
            elif line.strip(b" \t\x0b\x0c\r"):
                seen.add(line)
        yield n, int(chars[i]), int(symbols[i]), dup, int(repeats[i])


_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _scores(batches: Iterator[pa.RecordBatch], order: int, folder: str, part: int,
            measures: bool) -> Iterator[pa.RecordBatch]:
    model = _load(folder, part)
    for batch in batches:
        hashed = _language(batch.column("lang").to_pylist())
        sums, counts, rows = [], [], []
        for piece in W.slices(batch.column("text"), SLICE):
            codes, bounds = _codes(piece)
            starts, grams = _grams(codes, bounds, hashed[piece.first:piece.last], order)
            total = np.concatenate(([0.0], np.cumsum(_look_up(grams, model))))
            cut = np.searchsorted(starts, bounds)
            sums.append(np.diff(total[cut]))
            counts.append(np.diff(cut))
            if measures:
                rows.extend(_measures(piece))
        columns = [batch.column("row"), pa.array(np.concatenate([*sums, np.zeros(0)])),
                   pa.array(np.concatenate([*counts, np.zeros(0, np.int64)]).astype(np.int64))]
        names = ["row", "logp", "n_grams"]
        if measures:
            columns += [batch.column("doc_id"), batch.column("lang"),
                        *(pa.array([r[i] for r in rows], pa.int64()) for i in range(len(_MEASURES)))]
            names += ["doc_id", "lang", *_MEASURES]
        yield pa.RecordBatch.from_arrays(columns, names)


def quality(docs: DataFrame, order: int = ORDER, band: float = BAND, part_grams: int = PART_GRAMS) -> DataFrame:
    """One row for every row of ``docs`` (doc_id, text, lang): the measures, perplexity, its bands and the verdict.

    Null and empty texts have no words and fail the basic rules; texts of fewer characters than the order have no
    perplexity and no verdict of the model. A null lang is a language of its own. Further columns are ignored, an empty
    table gives an empty table.
    """
    folder, parts = build_model(docs, order, part_grams)
    kind = dict(docs.dtypes)["doc_id"]
    source = docs.select("doc_id", "lang", "text", F.xxhash64("doc_id", "lang", "text").alias("row"))
    base = f"row long, logp double, n_grams long, doc_id {kind}, lang string, " + ", ".join(f"{m} long" for m in _MEASURES)
    scored = source.mapInArrow(lambda b: _scores(b, order, folder, 0, True), base)
    for part in range(1, parts):
        more = source.mapInArrow(lambda b, p=part: _scores(b, order, folder, p, False),
                                 "row long, logp double, n_grams long").select(F.col("row").alias("_row"), F.col("logp").alias("_more"))
        more = more.groupBy("_row").agg(F.first("_more").alias("_more"))
        scored = scored.join(more, F.col("row") == F.col("_row")).withColumn(
            "logp", F.col("logp") + F.col("_more")).drop("_row", "_more")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    scored = stage_table(scored.withColumns({
        "surprise": -F.try_divide("logp", "n_grams"), "base_failed": failed}))
    quartiles = (scored.filter("NOT base_failed AND surprise IS NOT NULL").groupBy(F.col("lang").alias("_lang"))
                 .agg(F.percentile_approx("surprise", [0.25, 0.5, 0.75], 10_000).alias("q")))
    spread = F.greatest(F.element_at("q", 3) - F.element_at("q", 1), F.lit(0.02))
    margin = band * spread + F.try_divide(F.lit(2.0), F.sqrt("n_grams"))
    low, high = F.element_at("q", 1) - margin, F.element_at("q", 3) + margin
    out = scored.join(quartiles, F.expr("lang <=> _lang"), "left")
    fits = F.coalesce(F.col("surprise").between(low, high), F.lit(True))
    return out.select("doc_id", *_MEASURES, "base_failed", (~F.col("base_failed") & fits).alias("kept"),
                      F.exp("surprise").alias("perplexity"), F.exp(low).alias("lower_band"),
                      F.exp(high).alias("upper_band"))
