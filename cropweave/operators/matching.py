"""Best-match fuzzy join of two name registries.

Every left row is compared with the right rows of its own block (crop), or with all right rows when its block
has none, and keeps the best one at or above the threshold. The plan never pairs up a whole block:

1. work on distinct (block, key) pairs, so repeated names cost one comparison;
2. equal keys are found by an equi-join and are done;
3. the others are looked up in rounds of falling bounds. A round finds all pairs at or above its bound, so a key that has
   one is done: its best match cannot lie lower. Only the rest goes on to the next bound;
4. with t = (T - 0.5) / 200 a score of T needs an LCS of at least t*S letters for S = len a + len b. Two keys have a common
   subsequence of that length just when leaving out letters makes them equal, so short pairs meet by an equi-join on
   what is left of each key when the letters that their two lengths allow are left out: no other pair meets;
5. pairs too long for that meet through the rarest letter pairs of their keys (a prefix filter): each deleted letter
   breaks at most two letter pairs and each inserted one at most one, so at least 3*LCS - S + 1 pairs survive in both keys,
   and two keys that share that many share one among the first (pairs - that + 1) of any common order. Native
   ``levenshtein`` with a per-pair limit drops most of these candidates;
6. a signature that very many keys of one block share is split into a grid of cells, left keys by row and right keys
   by column, so no task gets all its pairs. Each side has as many parts as its own keys fill, so a key is written once
   for each part of the other side: once where few left keys meet many right ones;
7. the exact score decides, and an aggregate keeps the best right row per left key.

Steps 4 and 5 are lossless: every pair at or above the bound reaches the exact score.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropweave.functions.labels import match_confidence, needs_review, review_priority
from cropweave.functions.similarity import indel_score, tokens_agree
from cropweave.functions.text import compare_key
from cropweave.operators.counts import first_per_group
from cropweave.session import collected_stages, remove_stages, stage_table

GRAM_BUCKETS = 8_192
# Keys of either side that meet in one cell of a common signature.
CELL_KEYS = 4_096
# Hash buckets of signatures that are counted before the signatures themselves.
COUNT_BUCKETS = 1 << 18
# Hash buckets of the left signatures, by which right ones without a partner leave before they are stored.
PARTNER_BUCKETS = 1 << 20
# Texts that may be left of one key of a short pair: at most, at least, and for how many left keys of a block one more.
VARIANTS, LEAST_VARIANTS, KEYS_A_VARIANT = 1_024, 16, 16
# The distance of the bounds of two rounds, and from how many left keys of a block on more than one round pays.
ROUND, ROUND_KEYS = 10, 1_024
# Below this length an unequal pair scores at most 99, so an equal key cannot be tied.
EXACT_IS_BEST = 99


def _uses_pairs(t: float) -> bool:
    """Letter pairs only guarantee a shared gram when 3t > 1; below that single letters do."""
    return 3 * t > 1.02


def _grams(key: Column, t: float) -> Column:
    """Gram bucket of every letter pair (of the key with a border mark on both ends) or of every letter."""
    if _uses_pairs(t):
        border = F.lit("\u0001")
        text, count, width = F.concat(border, key, border), F.length(key) + 1, 2
    else:
        text, count, width = key, F.length(key), 1
    return F.transform(F.sequence(F.lit(1), count),
                       lambda i: F.pmod(F.xxhash64(F.substring(text, i, F.lit(width))), F.lit(GRAM_BUCKETS)))


def _least_lcs(total: int, t: float) -> int:
    return ceil(total * t - 1e-9)


def _short_total(t: float, variants: int) -> int:
    """The largest sum of two lengths up to which no key of a pair has more than ``variants`` texts left of it."""
    total = 1
    while True:
        kept = _least_lcs(total + 1, t)
        # the longest key of such a pair has a partner of just the letters that must stay
        if comb(total + 1 - kept, kept) > variants:
            return total
        total += 1


def _left_out(t: float, short: int) -> list[tuple[int, int]]:
    """For each length of a key, the fewest and the most letters that partners of short pairs let it leave out."""
    out = []
    for size in range(short + 1):
        fits = [size - kept for other in range(1, short - size + 1)
                if (kept := _least_lcs(size + other, t)) <= min(size, other)]
        out.append((min(fits, default=0), max(fits, default=-1)))
    return out


def _variants(key: Column, t: float, short: int) -> Column:
    """All that is left of a key when as many letters are left out as its partners in short pairs allow."""
    fewest, most = zip(*_left_out(t, short))
    at = lambda table, other: F.coalesce(F.get(F.lit(list(table)), F.length(key)), F.lit(other))
    rounds = F.slice(F.lit(list(range(1, max(*most, 1) + 1))), F.lit(1), F.greatest(at(most, -1), F.lit(0)))

    def without_one(text: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.concat(
            F.left(text, i - 1), F.substring(text, i + 1, F.length(text))))

    levels = F.aggregate(rounds, F.array(F.array(key)), lambda levels, _: F.concat(
        levels, F.array(F.array_distinct(F.flatten(F.transform(F.element_at(levels, -1), without_one))))))
    wanted = F.slice(levels, at(fewest, 0) + 1, F.greatest(at(most, -1) - at(fewest, 0) + 1, F.lit(0)))
    return F.flatten(wanted)


def _prefix_signatures(key: Column, frequency: Column, t: float, short: int) -> Column:
    """Codes of the rarest grams of a key: enough of them that any qualifying partner of a long pair shares one.

    Empty where no partner is long enough for a pair of more than ``short`` letters.
    """
    codes = F.array_sort(F.transform(_grams(key, t), lambda b: F.get(frequency, b.cast("int")) * GRAM_BUCKETS + b))
    # The shortest partner needs the fewest surviving grams, so its bound holds for every partner.
    size = F.length(key)
    partner = F.greatest(F.ceil(size * F.lit(t / (1 - t)) - F.lit(1e-9)), F.lit(short + 1) - size)
    total = size + partner
    # grams that survive: 3 * LCS - total + 1 letter pairs, or LCS letters; both grow with the total
    kept = total * F.lit(3 * t - 1) + 1 if _uses_pairs(t) else total * F.lit(t)
    needed = F.greatest(F.lit(1), F.ceil(kept - F.lit(1e-6)).cast("int"))
    codes = F.array_distinct(F.slice(codes, F.lit(1), F.greatest(F.size(codes) - needed + 1, F.lit(0))))
    fits = F.least(size, partner) >= F.ceil(total * F.lit(t) - F.lit(1e-9))
    return F.when(fits, codes).otherwise(F.array().cast("array<bigint>"))


def _gram_frequency(keys: DataFrame, t: float) -> DataFrame:
    """One row: how many keys hold each gram bucket, as an array of GRAM_BUCKETS counts."""
    counts = (keys.select(F.explode(F.array_distinct(_grams(F.col("key"), t))).alias("bucket"))
              .groupBy("bucket").agg(F.count("*").alias("n")))
    buckets = keys.sparkSession.range(GRAM_BUCKETS).select(F.col("id").alias("bucket"))
    dense = buckets.join(counts, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct("bucket", "n")))  # always GRAM_BUCKETS entries
    return dense.agg(F.transform(ordered, lambda x: x["n"]).alias("frequency"))


def _largest(keys: DataFrame) -> int:
    """Keys of the largest block."""
    return keys.groupBy("scope", "block").agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]


def _frequent(df: DataFrame, group: Sequence[str], least: int) -> DataFrame:
    """The groups of more than ``least`` rows, with their number ``n``.

    Nearly all signatures are rare, and to count them all a task would hold most of its rows. So rows are counted by hash
    buckets first, of which no task holds more than ``COUNT_BUCKETS``, and only those of buckets with so many rows by group.
    """
    marked = df.withColumn("_bucket", F.pmod(F.xxhash64(*group), F.lit(COUNT_BUCKETS)))
    full = marked.groupBy("_bucket").agg(F.count("*").alias("n")).where(F.col("n") > least).select("_bucket")
    return (marked.join(F.broadcast(full), "_bucket", "left_semi")
            .groupBy(*group).agg(F.count("*").alias("n")).where(F.col("n") > least))


def _crowded(left: DataFrame, right: DataFrame, group: Sequence[str]) -> DataFrame:
    """Signatures that many keys of one block share, counted within the block, with the number of parts of either side.

    There are few of them, often none.
    """
    parts = []
    for df, own, other in ((left, "left_split", "right_split"), (right, "right_split", "left_split")):
        splits = (F.floor(F.col("n") / F.lit(CELL_KEYS)) + 1).cast("int")
        parts.append(_frequent(df, group, CELL_KEYS).select(*group, splits.alias(own), F.lit(1).alias(other)))
    return stage_table(parts[0].unionByName(parts[1]).groupBy(*group).agg(
        F.max("left_split").alias("left_split"), F.max("right_split").alias("right_split")))


def _celled(df: DataFrame, crowded: DataFrame, group: Sequence[str], key: str, own: str, other: str) -> DataFrame:
    """A grid of (left, right) cells for a crowded signature, one cell for the others."""
    known = df.alias("a").join(crowded.alias("b"), _same(*group), "left")
    splits = {c: F.coalesce(f"b.{c}", F.lit(1)) for c in (own, other)}
    return known.select("a.*", F.pmod(F.xxhash64(key), splits[own]).cast("int").alias(own),
                        F.explode(F.sequence(F.lit(0), splits[other] - 1)).alias(other))


def _with_partner(df: DataFrame, others: DataFrame, group: Sequence[str]) -> DataFrame:
    """The rows whose group falls into a hash bucket of a group of ``others``: all that can meet one, and few more."""
    bucket = F.pmod(F.xxhash64(*group), F.lit(PARTNER_BUCKETS)).alias("_bucket")
    wanted = others.select(bucket).distinct()  # at most PARTNER_BUCKETS rows
    return df.select("*", bucket).join(F.broadcast(wanted), "_bucket", "left_semi").drop("_bucket")


def joined_pairs(left: DataFrame, right: DataFrame, threshold: int, frequency: DataFrame | None = None) -> DataFrame:
    """Pairs that meet, once for each signature they share, from two frames of distinct (scope, block, key).

    ``kept`` is the number of letters left of both keys of a short pair, -1 for a long pair. Up to which length a pair is
    short is a matter of cost: what is left of a right key is written once for all left keys of its block, while the pairs
    that meet by letter pairs grow with these, so more left keys allow more. The scored pairs are the same.
    ``frequency`` is a stored ``_gram_frequency``; it orders letter pairs, and any order finds the same.
    """
    t = (threshold - 0.5) / 200
    short = _short_total(t, min(VARIANTS, max(LEAST_VARIANTS, _largest(left) // KEYS_A_VARIANT)))
    if frequency is None:
        frequency = stage_table(_gram_frequency(left.unionByName(right), t))

    def signed(df: DataFrame, key_name: str) -> DataFrame:
        own = df.select("scope", "block", F.col("key").alias(key_name))
        brief = own.select("*", F.explode(_variants(F.col(key_name), t, short)).alias("rest")).select(
            "scope", "block", key_name, F.xxhash64("rest").alias("signature"), F.length("rest").alias("kept"))
        long = own.withColumn("frequency", frequency.scalar()).select(
            "scope", "block", key_name, F.explode(_prefix_signatures(F.col(key_name), F.col("frequency"), t, short)).alias("signature"),
            F.lit(-1).alias("kept"))
        return brief.unionByName(long)

    group = ("scope", "block", "signature", "kept")
    a = stage_table(signed(left, "left_key"))
    b = stage_table(_with_partner(signed(right, "right_key"), a, group))
    crowded = _crowded(a, b, group)
    if not crowded.isEmpty():
        # stored, so that its size is known and a small left side spares the shuffle of the right one
        a = stage_table(_celled(a, crowded, group, "left_key", "left_split", "right_split"))
        b = _celled(b, crowded, group, "right_key", "right_split", "left_split")
        group = (*group, "left_split", "right_split")
    a, b = a.alias("a"), b.alias("b")
    total = F.length("left_key") + F.length("right_key")
    least_lcs = F.ceil(total * F.lit(t) - F.lit(1e-9))
    lengths_fit = F.least(F.length("left_key"), F.length("right_key")) >= least_lcs
    own_kind = F.when(total <= short, F.col("a.kept") == least_lcs).otherwise(F.col("a.kept") < 0)
    return a.join(b, _same(*group) & own_kind & lengths_fit).select(
        "a.scope", "a.block", "left_key", "right_key", "a.kept", (total - 2 * least_lcs).cast("int").alias("_limit"))


def similar_pairs(left: DataFrame, right: DataFrame, threshold: int = 80, frequency: DataFrame | None = None) -> DataFrame:
    """Scored pairs at or above the threshold from two frames of distinct (scope, block, key)."""
    near = F.call_function("levenshtein", F.col("left_key"), F.col("right_key"), F.greatest("_limit", F.lit(0))) >= 0
    candidates = (joined_pairs(left, right, threshold, frequency).where(F.when(F.col("kept") < 0, near).otherwise(F.lit(True)))
                  .select("scope", "block", "left_key", "right_key").distinct())
    return (candidates.withColumn("score", indel_score("left_key", "right_key"))
            .where(F.col("score") >= threshold))


def falling_bounds(threshold: int) -> list[int]:
    """Bounds of the rounds, ``ROUND`` apart, down to the threshold."""
    return [*range(100 - ROUND, threshold, -ROUND), threshold]


def best_pairs(left: DataFrame, right: DataFrame, threshold: int) -> DataFrame:
    """For each left key all pairs of the first round that finds any; the best ones are among them.

    A round signs all right keys anew, so few left keys have one round only; the best pairs are the same.
    """
    found, orders = [], {}
    for bound in falling_bounds(threshold) if _largest(left) >= ROUND_KEYS else [threshold]:
        if found and left.isEmpty():
            break
        t = (bound - 0.5) / 200
        if _uses_pairs(t) not in orders:
            orders[_uses_pairs(t)] = stage_table(_gram_frequency(left.unionByName(right), t))
        with collected_stages() as signed:
            pairs = similar_pairs(left, right, bound, orders[_uses_pairs(t)])
        pairs = stage_table(pairs)
        remove_stages(signed)  # the signatures of this round are not read again
        found.append(pairs)
        if bound > threshold:
            done = pairs.select("scope", "block", F.col("left_key").alias("key")).distinct()
            left = stage_table(left.alias("a").join(done.alias("b"), _same("scope", "block", "key"), "left_anti"))
    return reduce(DataFrame.unionByName, found)


def _same(*columns: str) -> Column:
    """Null-safe equality of the named columns of the frames aliased ``a`` and ``b`` (still a hash join key)."""
    return reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in columns])


def best_matches(left: DataFrame, right: DataFrame, *, left_name: str, left_block: str, right_name: str,
                 right_block: str, right_order: Sequence[str], threshold: int = 80) -> DataFrame:
    """All left rows with ``score`` and ``match`` (struct of the winning right row, null when there is none).

    Ties go to the first right row by ``right_order``, which must be a total order. Both sides' key columns are
    already cleaned; they are compared in their word-characters-only form. The key tables are staged in the shared
    folder, as several steps read them; the returned frame is lazy from there on.
    """
    same_key = ("scope", "block", "key")
    # Right registry: the first row of every distinct key, per block and, where asked for, over all blocks.
    rows = right.select(F.col(right_block).alias("block"), compare_key(right_name).alias("key"),
                        F.struct(F.struct(*right_order).alias("order"), F.struct(*right.columns).alias("row"))
                        .alias("best")).where(F.col("key") != "")
    first_row = F.min_by("best", "best.order").alias("best")
    by_block = stage_table(rows.groupBy("block", "key").agg(first_row)
                           .select(F.lit("block").alias("scope"), "block", "key", "best"))

    # Left registry: distinct keys; a block without right rows sends its keys to the scope "all".
    keyed = stage_table(left.withColumn("_key", compare_key(left_name)).withColumn("_block", F.col(left_block)))
    known = by_block.select("block").distinct().withColumn("known", F.lit(True))
    own_blocks = keyed.where(F.col("_key") != "").select(F.col("_block").alias("block")).distinct()
    rights = by_block
    if not own_blocks.alias("a").join(known.alias("b"), _same("block"), "left_anti").isEmpty():
        nothing = F.lit(None).cast(right.schema[right_block].dataType)
        rights = by_block.unionByName(by_block.groupBy("key").agg(first_row)
                                      .select(F.lit("all").alias("scope"), nothing.alias("block"), "key", "best"))
    keys = keyed.where(F.col("_key") != "").select(F.col("_block").alias("block"), F.col("_key").alias("key")).distinct()
    scoped = (keys.alias("a").join(known.alias("b"), _same("block"), "left")
              .select(F.when(F.col("known"), F.lit("block")).otherwise(F.lit("all")).alias("scope"),
                      F.when(F.col("known"), F.col("a.block")).alias("block"), "key",
                      F.col("a.block").alias("own_block")))

    # Equal keys first; what they settle needs no similar partner.
    equal = stage_table(scoped.alias("a").join(rights.alias("b"), _same(*same_key), "left")
                        .select(*[f"a.{c}" for c in same_key], "own_block", "best"))
    exact = equal.where(F.col("best").isNotNull()).select(*same_key, F.lit(100).alias("score"), "best")
    unsettled = (equal.where(F.col("best").isNull() | (F.length("key") > EXACT_IS_BEST))
                 .select(*same_key).distinct())
    pairs = best_pairs(unsettled, rights.select(*same_key), threshold)
    scored = (pairs.withColumnRenamed("right_key", "key").alias("a").join(rights.alias("b"), _same(*same_key))
              .select("a.scope", "a.block", F.col("left_key").alias("key"), "score", "best"))
    winners = (exact.unionByName(scored).groupBy(*same_key)
               .agg(F.min_by(F.struct("score", "best"), F.struct(-F.col("score"), "best.order")).alias("won")))

    by_key = (equal.alias("a").join(winners.alias("b"), _same(*same_key))
              .select(F.col("own_block").alias("_block"), F.col("a.key").alias("_key"), "won"))
    joined = keyed.alias("a").join(by_key.alias("b"), _same("_block", "_key"), "left")
    return joined.select(*[F.col(f"a.{c}") for c in left.columns],
                         F.coalesce("won.score", F.lit(0)).alias("score"), F.col("won.best.row").alias("match"))


def match_records(matched: DataFrame, left_institution: str | None = None, right_institution: str | None = None) -> DataFrame:
    """Fixed 14-column match record from ``best_matches`` over two keyed registries.

    Where both sides name an institution column, ``institution_agrees`` is added, null for unmatched rows.
    """
    status = F.when(F.col("match").isNotNull(), F.lit("MATCHED")).otherwise(F.lit("UNMATCHED"))
    base = matched.withColumn("match_status", status)
    theirs = [F.col(f"match.{c}").alias(f"seednet_{c}")
              for c in ("variety_original", "variety_clean", "crop_original", "crop_clean")]
    return base.select(
        "csc_raw_id",
        *[F.col(c).alias(f"csc_{c}") for c in ("variety_original", "variety_clean", "crop_original", "crop_clean")],
        F.col("year_extracted").alias("csc_year"), "match_status", F.col("score").alias("similarity_score"),
        match_confidence("score").alias("match_confidence"), *theirs,
        needs_review("match_status", "score").alias("manual_review_needed"),
        *([F.when(F.col("match").isNotNull(), tokens_agree(left_institution, f"match.{right_institution}"))
           .alias("institution_agrees")] if left_institution and right_institution else []))


def final_records(records: DataFrame, run_ts: str) -> DataFrame:
    """Match records with review priority and audit columns."""
    return records.select("*", review_priority("match_status", "similarity_score").alias("review_priority"),
                          F.lit("CSC").alias("data_source"), F.lit(run_ts).cast("timestamp").alias("processing_timestamp"))


def match_report(records: DataFrame) -> DataFrame:
    """One row: totals, match rate in percent, and the confidence and priority distributions as maps."""
    n = lambda c, v: F.count_if(F.col(c) == v)
    levels, priorities = ("HIGH", "MEDIUM", "LOW", "VERY_LOW"), ("HIGH", "MEDIUM", "LOW")
    totals = records.agg(
        F.count("*").alias("total_csc_varieties"),
        n("match_status", "MATCHED").alias("matched_varieties"),
        n("match_status", "UNMATCHED").alias("unmatched_varieties"),
        *[n("match_confidence", v).alias(f"confidence_{v.lower()}") for v in levels],
        *[n("review_priority", v).alias(f"priority_{v.lower()}") for v in priorities])
    return totals.withColumn(
        "match_rate", F.try_divide(F.col("matched_varieties") * 100.0, F.col("total_csc_varieties")))


def review_sample(records: DataFrame, id_column: str, status: str = "match_status", n: int = 100,
                  seed: str = "0") -> DataFrame:
    """Up to ``n`` rows per status, chosen by a hash of the id, so a rerun gives the same sample."""
    drawn = F.md5(F.concat_ws("|", F.lit(seed), F.col(id_column).cast("string")).cast("binary"))
    return first_per_group(records.withColumn("_draw", drawn), [status], ["_draw", id_column], n).drop("_draw")
