"""Name similarity measures.

The indel ratio is ``200 * LCS(a, b) / (len a + len b)`` rounded half-even. Only LCS and Jaro-Winkler lack a
built-in expression; both run as Arrow-batched UDFs over pairs that cheaper native filters let through.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropweave.functions.text import as_col


def _lcs(a: str, b: str) -> int:
    """LCS length, one machine-word-like integer operation per character of ``b``."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & where.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@F.pandas_udf(T.IntegerType())
def lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else _lcs(x, y) for x, y in zip(a, b)], dtype="Int32")


def indel_score(a: Column | str, b: Column | str) -> Column:
    """0-100 similarity of two compare keys; an empty key scores 0."""
    a, b = as_col(a), as_col(b)
    total = F.length(a) + F.length(b)
    ratio = F.bround(lcs_length(a, b) * F.lit(200.0) / F.nullif(total, F.lit(0)), 0).cast("int")
    return F.when((a == "") | (b == ""), F.lit(0)).otherwise(ratio)


def _jaro_winkler(a: str, b: str, scale: float = 0.1) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken = [False] * len(b)
    left = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == ch:
                taken[j] = True
                left.append(ch)
                break
    m = len(left)
    if m == 0:
        return 0.0
    right = [ch for ch, hit in zip(b, taken) if hit]
    swaps = sum(x != y for x, y in zip(left, right)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    shared = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        shared += 1
    return jaro + shared * scale * (1 - jaro) if jaro > 0.7 else jaro


@F.pandas_udf(T.DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else _jaro_winkler(x, y) for x, y in zip(a, b)], dtype="float64")


def tokens(c: Column | str) -> Column:
    """Words of a compare key."""
    return F.filter(F.split(as_col(c), " "), lambda t: t != "")


def token_jaccard(a: Column, b: Column) -> Column:
    """Shared distinct tokens over all distinct tokens of two arrays."""
    return F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b)))


def token_cosine(a: Column, b: Column) -> Column:
    """Cosine of the token-count vectors of two arrays."""
    count = lambda words, w: F.size(F.filter(words, lambda x: x == w)).cast("double")
    add = lambda acc, x: acc + x
    norm = lambda words: F.sqrt(F.aggregate(
        F.transform(F.array_distinct(words), lambda w: F.pow(count(words, w), F.lit(2.0))), F.lit(0.0), add))
    dot = F.aggregate(F.transform(F.array_intersect(a, b), lambda w: count(a, w) * count(b, w)), F.lit(0.0), add)
    return F.try_divide(dot, norm(a) * norm(b))


def tokens_agree(a: Column | str, b: Column | str, at_least: float = 0.5) -> Column:
    """Whether two institution names are equal once normalised, or share enough of their tokens."""
    from cropweave.functions.text import compare_key

    ka, kb = compare_key(a), compare_key(b)
    overlap = F.coalesce(token_jaccard(tokens(ka), tokens(kb)) >= at_least, F.lit(False))
    return F.coalesce((ka == kb) | overlap, F.lit(False))
