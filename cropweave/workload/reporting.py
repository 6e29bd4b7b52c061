"""Every report of ``profile_catalogue`` over a catalogue that is derived from all parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropweave.plans import reports
from cropweave.sources.readers import read_table
from cropweave.workload.registry import query


def parts_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """A catalogue with a row per part, with nulls, empty arrays and null arrays."""
    size, key = F.col("p_size"), F.col("p_partkey")

    def some(**names: Column) -> Column:
        return F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in names.items()]))

    return read_table(spark, d, "part").select(
        F.concat_ws(" ", "p_name", "p_brand").alias("variety_name"), F.nullif("p_type", F.lit("SMALL")).alias("crop_type"),
        F.when(size % 11 != 0, F.col("p_brand")).alias("breeding_institution"),
        F.when(size % 13 != 0, size + 1975).cast("int").alias("year_of_release"), (key % 101 * 3 + key % 7 + 60).cast("int").alias("maturity_days"),
        F.when(size % 7 != 0, key % 101 / 100).alias("data_completeness_score"),
        F.when(size % 4 == 0, F.lit("GOOD")).when(size % 4 == 1, F.lit("Good")).when(size % 4 == 2, F.lit("POOR")).alias("quality_flag"),
        F.when(key % 3 == 0, F.lit("High")).when(key % 3 == 1, F.lit("LOW")).alias("confidence_level"),
        F.when(size != 50, some(Drought=size % 2 == 0, Heat=size % 3 == 0, Rust=size % 5 == 0, Salt=key % 4 == 0)).alias("stressors_tolerated"),
        some(Protein=key % 2 == 0, Colour=size % 7 == 1).alias("quality_traits"),
        some(Punjab=key % 3 == 0, Goa=key % 5 == 0, Bihar=size > 20).alias("recommended_states"),
        some(CSC=F.lit(True), SeedNet=key % 2 == 1).alias("data_sources"))


def _some(**names: str) -> str:
    cases = ", ".join(f"CASE WHEN {condition} THEN '{name}' END" for name, condition in names.items())
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


CATALOGUE_SQL = f"""
c AS (SELECT p_partkey, p_name || ' ' || p_brand AS variety_name, nullif(p_type, 'SMALL') AS crop_type,
  CASE WHEN p_size % 11 <> 0 THEN p_brand END AS breeding_institution,
  CASE WHEN p_size % 13 <> 0 THEN CAST(p_size + 1975 AS INTEGER) END AS year_of_release, CAST(p_partkey % 101 * 3 + p_partkey % 7 + 60 AS INTEGER) AS maturity_days,
  CASE WHEN p_size % 7 <> 0 THEN CAST(p_partkey % 101 AS DOUBLE) / 100 END AS data_completeness_score,
  CASE p_size % 4 WHEN 0 THEN 'GOOD' WHEN 1 THEN 'Good' WHEN 2 THEN 'POOR' END AS quality_flag,
  CASE p_partkey % 3 WHEN 0 THEN 'High' WHEN 1 THEN 'LOW' END AS confidence_level,
  CASE WHEN p_size <> 50 THEN {_some(Drought="p_size % 2 = 0", Heat="p_size % 3 = 0", Rust="p_size % 5 = 0", Salt="p_partkey % 4 = 0")} END AS stressors_tolerated,
  {_some(Protein="p_partkey % 2 = 0", Colour="p_size % 7 = 1")} AS quality_traits,
  {_some(Punjab="p_partkey % 3 = 0", Goa="p_partkey % 5 = 0", Bihar="p_size > 20")} AS recommended_states,
  {_some(CSC="true", SeedNet="p_partkey % 2 = 1")} AS data_sources FROM part)"""

_COLUMNS = ("variety_name", "crop_type", "breeding_institution", "year_of_release", "maturity_days", "data_completeness_score",
            "quality_flag", "confidence_level", "stressors_tolerated", "quality_traits", "recommended_states", "data_sources")
_NUMBERS = ("year_of_release", "maturity_days", "data_completeness_score")
_NEVER_MISSING = ("variety_name", "maturity_days", "quality_traits", "recommended_states", "data_sources")


def _counts(column: str) -> str:
    return f"SELECT {column}, count(*) AS count FROM c WHERE {column} IS NOT NULL GROUP BY 1"


def _elements(column: str, alias: str) -> str:
    return f"SELECT x AS {alias}, count(*) AS count FROM (SELECT unnest({column}) AS x FROM c) GROUP BY 1 ORDER BY count DESC, x LIMIT 15"


def _bars(column: str, bins: int) -> str:
    return f"""SELECT CAST(i AS INTEGER) AS bin, round(lo + i * (hi - lo) / {bins}, 6) AS bin_start, round(lo + (i + 1) * (hi - lo) / {bins}, 6) AS bin_end,
  coalesce(n, 0) AS count FROM range({bins}) t(i), (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM c)
  LEFT JOIN (SELECT CAST(least({bins - 1}, floor(({column} - lo) / (hi - lo) * {bins})) AS INTEGER) AS bin, count(*) AS n
             FROM c, (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM c) WHERE {column} IS NOT NULL GROUP BY 1) ON bin = i"""


def _sizes(column: str) -> str:
    return f"SELECT CAST(coalesce(len({column}), 0) AS INTEGER) AS size, count(*) AS count FROM c GROUP BY 1"


def _matrix(strong: bool) -> str:
    pairs = [(a, b) for i, a in enumerate(_NUMBERS) for b in _NUMBERS[i:] if not strong or a != b]
    rows = " UNION ALL ".join(f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM c" for a, b in pairs)
    return f"SELECT * FROM ({rows}) WHERE abs(correlation) > 0.5" if strong else rows


_CROSS = "SELECT x AS stress, crop_type, count(*) AS count FROM (SELECT unnest(stressors_tolerated) AS x, crop_type FROM c) WHERE crop_type IS NOT NULL GROUP BY ALL"
_TOP = "(SELECT {v} AS name, {n} AS n FROM {t} GROUP BY 1 ORDER BY n DESC, name LIMIT 1)"


def _leader(name: str, value: str, table: str, number: str = "count(*)") -> str:
    inner = _TOP.format(v=value, n=number, t=table)
    return f"(SELECT name FROM {inner}) AS top_{name}, (SELECT n FROM {inner}) AS top_{name}_count"


REPORT_SQL = {
    "missing": " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, "
        f"round(100.0 * (count(*) - count({c})) / count(*), 2) AS missing_percentage FROM c) WHERE missing_count > 0" for c in _COLUMNS),
    "describe": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, "
        f"round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, "
        f"CAST(max({c}) AS DOUBLE) AS max FROM c" for c in _NUMBERS),
    "quality_flags": _counts("quality_flag"), "confidence_levels": _counts("confidence_level"), "crops": _counts("crop_type"), "years": _counts("year_of_release"),
    "unique": " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS unique_values FROM c"
                                 for c in ("variety_name", "crop_type", "breeding_institution")),
    "completeness_histogram": _bars("data_completeness_score", 20), "year_histogram": _bars("year_of_release", 20),
    "maturity_histogram": _bars("maturity_days", 15),
    "missing_correlations": " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
        + ("any_value(CAST(NULL AS DOUBLE))" if a in _NEVER_MISSING or b in _NEVER_MISSING else
           f"round(corr(CAST({a} IS NULL AS INTEGER), CAST({b} IS NULL AS INTEGER)), 6)") + " AS correlation FROM c"
        for i, a in enumerate(_COLUMNS) for b in _COLUMNS[i:]),
    "stressors": _elements("stressors_tolerated", "stress"), "states": _elements("recommended_states", "state"),
    "quality_traits": _elements("quality_traits", "trait"),
    "stressor_totals": """SELECT count_if(len(stressors_tolerated) > 0) AS rows_with_values, count_if(coalesce(len(stressors_tolerated), 0) = 0) AS rows_without_values,
  CAST(sum(len(stressors_tolerated)) AS BIGINT) AS total_values, count_if(len(stressors_tolerated) >= 3) AS rows_with_many FROM c""",
    "stressor_sizes": _sizes("stressors_tolerated"), "quality_trait_sizes": _sizes("quality_traits"),
    "stress_by_crop": _CROSS,
    "stress_by_crop_top": f"""SELECT r.stress, k.crop_type, coalesce(x.count, 0) AS count
  FROM (SELECT stress FROM ({_CROSS}) GROUP BY 1 ORDER BY sum(count) DESC, stress LIMIT 10) r
  CROSS JOIN (SELECT crop_type FROM ({_CROSS}) GROUP BY 1 ORDER BY sum(count) DESC, crop_type LIMIT 8) k
  LEFT JOIN ({_CROSS}) x ON x.stress = r.stress AND x.crop_type = k.crop_type""",
    "decades": "SELECT CAST(year_of_release // 10 * 10 AS VARCHAR) || 's' AS decade, count(*) AS count FROM c WHERE year_of_release IS NOT NULL GROUP BY 1",
    "recent_crops": "SELECT crop_type, count(*) AS count FROM c WHERE year_of_release >= 2010 AND crop_type IS NOT NULL GROUP BY 1 ORDER BY count DESC, crop_type LIMIT 10",
    "institutions": f"SELECT * FROM ({_counts('breeding_institution')}) ORDER BY count DESC, breeding_institution LIMIT 15",
    "institution_diversity": """SELECT breeding_institution, count(DISTINCT crop_type) AS count FROM c WHERE breeding_institution IS NOT NULL AND crop_type IS NOT NULL
  GROUP BY 1 ORDER BY count DESC, breeding_institution LIMIT 10""",
    "specialists": """SELECT crop_type, breeding_institution, count, CAST(row_number() OVER (PARTITION BY crop_type ORDER BY count DESC, breeding_institution) AS INTEGER) AS rank
  FROM (SELECT crop_type, breeding_institution, count(*) AS count FROM c WHERE breeding_institution IS NOT NULL GROUP BY ALL)
  WHERE crop_type IN (SELECT crop_type FROM c WHERE crop_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, crop_type LIMIT 5) QUALIFY rank <= 3""",
    "multi_trait": "SELECT variety_name, crop_type, array_to_string(stressors_tolerated, ', ') AS traits FROM c WHERE len(stressors_tolerated) >= 3",
    "correlations": _matrix(False), "strong_pairs": _matrix(True),
    "completeness_by_source": """SELECT source, round(avg(data_completeness_score), 6) AS mean FROM (SELECT unnest(data_sources) AS source, data_completeness_score FROM c)
  WHERE data_completeness_score IS NOT NULL GROUP BY 1 ORDER BY mean DESC, source LIMIT 10""",
    "completeness_by_crop": "SELECT crop_type, round(avg(data_completeness_score), 6) AS mean FROM c WHERE data_completeness_score IS NOT NULL GROUP BY 1",
    "usual_range": "SELECT variety_name, maturity_days, year_of_release FROM c WHERE maturity_days < 300 AND year_of_release > 1990",
    "summary": f"""SELECT count(*) AS total_varieties, count(DISTINCT crop_type) AS unique_crops, count(DISTINCT breeding_institution) AS unique_institutions,
  round(avg(data_completeness_score), 6) AS mean_completeness, round(count(DISTINCT crop_type) / count(*), 6) AS crop_diversity_index,
  count_if(len(stressors_tolerated) > 0) AS with_traits, round(100.0 * count_if(len(stressors_tolerated) > 0) / count(*), 6) AS with_traits_percent,
  count_if(len(stressors_tolerated) >= 3) AS multi_trait_count, count_if(year_of_release >= 2010) AS recent_count,
  round(avg(CASE WHEN year_of_release >= 1990 THEN year_of_release END), 6) AS mean_year_since_1990,
  round(100.0 * count_if(upper(quality_flag) = 'GOOD') / count(*), 6) AS good_quality_percent,
  round(100.0 * count_if(upper(confidence_level) = 'HIGH') / count(*), 6) AS high_confidence_percent,
  count_if(data_completeness_score < 0.5) AS low_completeness_count,
  {_leader("crop", "crop_type", "c WHERE crop_type IS NOT NULL")},
  {_leader("institution", "breeding_institution", "c WHERE breeding_institution IS NOT NULL")},
  {_leader("diverse_institution", "breeding_institution", "c WHERE breeding_institution IS NOT NULL AND crop_type IS NOT NULL", "count(DISTINCT crop_type)")},
  {_leader("trait", "x", "(SELECT unnest(stressors_tolerated) AS x FROM c)")}, {_leader("state", "x", "(SELECT unnest(recommended_states) AS x FROM c)")},
  (SELECT count(DISTINCT x) FROM (SELECT unnest(recommended_states) AS x FROM c)) AS unique_states FROM c""",
}


def _register(name: str, sql: str) -> None:
    @query(f"report_{name}", f"WITH {CATALOGUE_SQL} {sql}")
    def report(spark: SparkSession, d: str) -> DataFrame:
        frame = reports.profile_catalogue(parts_catalogue(spark, d), only=[name])[name]
        if name == "usual_range":
            frame = frame.select("variety_name", "maturity_days", "year_of_release")
        doubles = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.DoubleType)]
        return frame.withColumns({c: F.round(c, 6) for c in doubles})


for _name, _sql in REPORT_SQL.items():
    _register(_name, _sql)
