"""Search queries, search results and the research context attached to varieties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cropweave.functions.text import as_col

# The 30 search queries of a variety. {v} is its name, {c} its crop.
STRESSES = ("drought tolerance", "heat tolerance", "salinity tolerance", "flood tolerance", "submergence tolerance",
            "cold tolerance", "disease resistance", "pest resistance")
STATE_DISEASES = (
    ("gujarat", "blast OR blight OR rust OR bollworm"),
    ("maharashtra", "leaf spot OR stem borer OR thrips OR aphids"),
    ("punjab", "yellow rust OR brown rust OR pink bollworm OR whitefly"),
    ("haryana", "karnal bunt OR loose smut OR shoot fly OR stem borer"),
)
GENETIC_SITES = ("ncbi.nlm.nih.gov", "gramene.org", "plantgdb.org", "ipk-gatersleben.de")
EVIDENCE = ("farmer field trials participatory evaluation", "agronomic trials yield performance",
            "comparative studies field evaluation", "stress performance assessment")
COMMERCIAL = ('KVK "Krishi Vigyan Kendra" seed availability', 'NSC "National Seeds Corporation" commercial',
              '"State Seed Corporation" seed dealers availability')
GOVERNMENT = ('site:seednet.gov.in "{v}" breeder allocation', 'site:icar.org.in "{v}" {c} notification',
              '"gazette notification" "{v}" {c} after:2008')
BACKUP = ('"{v}" {c} research development breeding after:2008', '"{v}" genetics genomics molecular breeding after:2008',
          '"{v}" {c} performance traits characteristics after:2008')
QUERY_TEMPLATES: tuple[tuple[str, str, str], ...] = (
    ("google_scholar", "high", "{v}"),
    *(("google_search", "high", f'"{{v}}" {{c}} {s} after:2008') for s in STRESSES),
    *(("google_search", "medium", f'"{{v}}" {{c}} {s} ({d}) after:2008') for s, d in STATE_DISEASES),
    *(("google_search", "medium", f'site:{s} "{{v}}" {{c}} QTL molecular markers') for s in GENETIC_SITES),
    *(("google_search", "medium", f'"{{v}}" {{c}} {e} after:2008') for e in EVIDENCE),
    *(("google_search", "low", f'"{{v}}" {{c}} {c}') for c in COMMERCIAL),
    *(("google_search", "medium", g) for g in GOVERNMENT),
    *(("google_search", "low", b) for b in BACKUP),
)


def search_queries(varieties: DataFrame, variety: str = "variety_name", crop: str = "crop_name") -> DataFrame:
    """Thirty query rows per variety: query_pos, type, query, post_2008, priority. A plain explode, no join."""
    v, c = (F.coalesce(F.col(x), F.lit("")) for x in (variety, crop))

    def filled(template: str) -> Column:
        """The template with names put in place, piece by piece, so a name holding '{c}' stays as it is."""
        pieces: list[Column] = []
        for i, part in enumerate(template.split("{v}")):
            if i:
                pieces.append(v)
            for j, text in enumerate(part.split("{c}")):
                if j:
                    pieces.append(c)
                pieces.append(F.lit(text))
        return F.concat(*pieces)

    rows = F.array(*[F.struct(F.lit(kind).alias("type"), filled(t).alias("query"), F.lit(True).alias("post_2008"),
                              F.lit(priority).alias("priority")) for kind, priority, t in QUERY_TEMPLATES])
    return varieties.select("*", F.posexplode(rows).alias("query_pos", "_q")).select(
        *varieties.columns, "query_pos", "_q.*")


def ranked_results(results: DataFrame, query_key: Sequence[str], order: Sequence[str], type_column: str = "type",
                   scholar: int = 5, web: int = 10) -> DataFrame:
    """Add ``rank`` and keep the first results of every query: 5 publications or 10 web pages."""
    ranked = results.withColumn("rank", F.row_number().over(Window.partitionBy(*query_key).orderBy(*order)))
    limit = F.when(F.col(type_column) == "google_scholar", F.lit(scholar)).otherwise(F.lit(web))
    # The outer bound lets Spark cut every group before the shuffle.
    return ranked.where(F.col("rank") <= max(scholar, web)).where(F.col("rank") <= limit)


def is_recent(year: Column | str, since: int = 2008) -> Column:
    """Whether a year text is all digits and at least ``since``."""
    text = as_col(year).cast("string")
    return F.coalesce(text.rlike("^[0-9]+$") & (text.try_cast("int") >= since), F.lit(False))


def keep_recent(ranked: DataFrame, year: str = "year", type_column: str = "type", since: int = 2008) -> DataFrame:
    """Drop older publications; web results carry no year and stay. Apply after ``ranked_results``."""
    return ranked.where((F.col(type_column) != "google_scholar") | is_recent(year, since))


def query_results(executed: DataFrame, kept: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row per executed query with its kept results (at most 10) nested in rank order, and their count."""
    nested = kept.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("rank", *fields))).alias("results"))
    joined = executed.alias("a").join(nested.alias("b"), on=list(key), how="left")
    return joined.withColumn("count", F.coalesce(F.size("results"), F.lit(0)))


def compile_context(queries: DataFrame, variety: Sequence[str], run_ts: str) -> DataFrame:
    """One document per variety: its queries nested in order, plus the metadata counts.

    ``queries`` has at most one row per query template and variety, so the nested list is bounded.
    """
    ok = F.coalesce(F.col("success"), F.lit(False))
    entry = F.struct("query_pos", "query", "type", "results", "count", "success", "error")
    return (queries.groupBy(*variety)
            .agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e.dropFields("query_pos")).alias("search_results"),
                 F.count("*").cast("int").alias("total_queries"), F.count_if(ok).cast("int").alias("successful_queries"),
                 F.count_if(~ok).cast("int").alias("failed_queries"), F.sum("count").cast("int").alias("total_results"))
            .select(F.struct(*variety).alias("variety_info"), "search_results",
                    F.struct("total_queries", "successful_queries", "failed_queries", "total_results",
                             F.lit(run_ts).alias("processing_timestamp")).alias("search_metadata")))


def run_counters(queries: DataFrame, variety: Sequence[str]) -> DataFrame:
    """One row of run totals."""
    ok = F.coalesce(F.col("success"), F.lit(False))
    kind = lambda t: F.count_if(F.col("type") == t)
    per_variety = queries.groupBy(*variety).agg(
        F.count("*").alias("q"), F.count_if(ok).alias("ok"), kind("google_scholar").alias("scholar"),
        kind("google_search").alias("web"), F.sum("count").alias("n"))
    return per_variety.agg(
        F.count("*").alias("varieties_processed"), F.count_if(F.col("ok") > 0).alias("successful_enrichments"),
        F.count_if(F.col("ok") == 0).alias("failed_enrichments"), F.sum("q").alias("total_search_queries"),
        F.sum("ok").alias("successful_queries"), F.sum(F.col("q") - F.col("ok")).alias("failed_queries"),
        F.sum("scholar").alias("google_scholar_queries"), F.sum("web").alias("google_search_queries"),
        F.sum("n").alias("total_results"))


def split_by_type(context: DataFrame, array: str = "search_results") -> DataFrame:
    """Add the scholar and the web entries of a context as arrays of their own."""
    of = lambda t: F.filter(F.col(array), lambda r: r["type"] == t)
    return context.select("*", of("google_scholar").alias("google_scholar_results"),
                          of("google_search").alias("google_search_results"))


def first_per_name(contexts: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """The first context of every name (compared without case), as (context_key, context)."""
    row = F.struct(*contexts.columns)
    return (contexts.where(F.col(name).isNotNull()).groupBy(F.lower(name).alias("context_key"))
            .agg(F.min_by(row, F.struct(*order)).alias("context")))


def attach_context(varieties: DataFrame, contexts: DataFrame, variety: str, name: str, order: Sequence[str]) -> DataFrame:
    """Varieties that have a context, with the first one whose name matches in any case."""
    first = first_per_name(contexts, name, order)
    return varieties.join(first, F.lower(F.col(variety)) == F.col("context_key")).drop("context_key")


def without_context(varieties: DataFrame, contexts: DataFrame, variety: str, name: str) -> DataFrame:
    names = contexts.select(F.lower(name).alias("context_key")).distinct()
    return varieties.join(names, F.lower(F.col(variety)) == F.col("context_key"), "left_anti")


def not_yet_done(candidates: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates whose keys the manifest of finished work lacks."""
    return candidates.join(done.select(*keys), on=list(keys), how="left_anti")


def analysis_payload(context: Column, variety: Column) -> Column:
    """JSON text handed to the analysis step: the variety, its results, their split by type and counts."""
    results = context["search_results"]
    of = lambda t: F.filter(results, lambda r: r["type"] == t)
    return F.to_json(F.struct(
        variety.alias("variety_information"), results.alias("search_results"),
        F.size(results).alias("total_queries"),
        F.size(F.filter(results, lambda r: r["error"].isNull())).alias("successful_queries"),
        of("google_scholar").alias("google_scholar_results"), of("google_search").alias("google_search_results")))
