"""Catalogue search through an inverted table, so a search reads the rows of its terms and not the catalogue.

The table has a row per record and term: each element of the indexed arrays and each value of the indexed scalars, with the
record's id and the scalar columns that searches filter on. It is stored by kind of term and shelf (a hash of the term),
in ranges sorted by term and id: a search for a term opens one shelf of one kind, and there only the row groups of the
term. The ranges are cut by row count, so a term that a third of all records carry is spread over many files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHELVES = 64
#: Kind of term -> column of a published catalogue.
TERMS = {"state": "recommended_states", "stressor": "stressors_tolerated", "crop": "crop_type", "institution": "breeding_institution"}
#: Scalar columns that searches filter on.
KEPT = {"crop": "crop_type", "institution": "breeding_institution", "score": "data_completeness_score", "flag": "quality_flag"}


def _shelf(kind: Column, term: Column) -> Column:
    return F.pmod(F.xxhash64(kind, term), F.lit(SHELVES)).cast("int")


def postings(catalogue: DataFrame, id_column: str, terms: Mapping[str, str] = TERMS, kept: Mapping[str, str] = KEPT) -> DataFrame:
    """``(kind, shelf, term, id, <kept>)``: one row per record and distinct term; null terms have none."""
    def listed(kind: str, column: str) -> Column:
        array = isinstance(catalogue.schema[column].dataType, T.ArrayType)
        values = F.coalesce(F.col(column), F.array().cast("array<string>")) if array else F.array(F.col(column).cast("string"))
        return F.transform(F.array_distinct(F.array_compact(values)), lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("term")))

    own = [F.col(c).alias(f"kept_{name}") for name, c in kept.items()]
    each = catalogue.select(F.col(id_column).alias("id"), *own, F.explode(F.concat(*[listed(k, c) for k, c in terms.items()])).alias("t"))
    return each.select("t.kind", _shelf(F.col("t.kind"), F.col("t.term")).alias("shelf"), "t.term", "id",
                       *[F.col(f"kept_{name}").alias(name) for name in kept])


def write_index(catalogue: DataFrame, path: str, id_column: str, terms: Mapping[str, str] = TERMS, kept: Mapping[str, str] = KEPT) -> None:
    """Store the inverted table of a catalogue."""
    order = ("kind", "shelf", "term", "id")
    dealt = postings(catalogue, id_column, terms, kept).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.write.mode("overwrite").partitionBy("kind", "shelf").parquet(path)


def shelf_of(spark: SparkSession, kind: str, term: str) -> int:
    return spark.range(1).select(_shelf(F.lit(kind), F.lit(term))).first()[0]


def search_index(spark: SparkSession, path: str, *, crop: str | None = None, state: str | None = None,
                 stressors: Sequence[str] = (), institution: str | None = None, min_score: float | None = None,
                 flags: Sequence[str] = ()) -> DataFrame:
    """``(id, <kept>)`` of the records for which every given condition holds, as ``quality.search_catalogue`` finds them.

    At least one of crop, state, stressors and institution must be given. The shelves of the terms are the only files read.
    """
    index = spark.read.parquet(path)

    def with_term(kind: str, wanted: Sequence[str]) -> DataFrame:
        places = [(F.col("shelf") == shelf_of(spark, kind, t)) & (F.col("term") == t) for t in wanted]
        found = index.where((F.col("kind") == kind) & reduce(lambda a, b: a | b, places)).drop("kind", "shelf", "term")
        return found if len(wanted) == 1 else found.dropDuplicates(["id"])

    # rare kinds of terms first; a scalar that is filtered on anyway needs no look-up of its own
    asked = [(k, list(w)) for k, w in (("state", [state] if state is not None else []), ("stressor", stressors)) if w]
    if not asked:
        asked = [(k, [w]) for k, w in (("institution", institution), ("crop", crop)) if w is not None][:1]
    if not asked:
        raise ValueError("give a crop, a state, a stressor or an institution")
    found = with_term(*asked[0])
    for kind, value in (("crop", crop), ("institution", institution)):
        if value is not None:
            found = found.where(F.col(kind) == value)
    if min_score is not None:
        found = found.where(F.col("score") >= min_score)
    if flags:
        found = found.where(F.upper("flag").isin(*[f.upper() for f in flags]))
    for other in asked[1:]:
        found = found.join(with_term(*other).select("id"), "id", "left_semi")
    return found
