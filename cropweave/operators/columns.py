"""Column selection, conforming and filling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropweave.functions.jsonio import path_column
from cropweave.functions.text import UNKNOWN, clean_key, strip, title_case

NOT_SPECIFIED = "Not Specified"


def pick_column(df: DataFrame, candidates: Sequence[str], what: str = "matching") -> str:
    """First candidate the frame has."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"no {what} column among {list(candidates)}; columns are {df.columns}")


def registry_keys(df: DataFrame, name: str, crop: str) -> DataFrame:
    """Add clean and original name/crop columns and drop rows without a name."""
    return (df.withColumn("variety_clean", clean_key(name)).withColumn("crop_clean", clean_key(crop))
            .withColumn("variety_original", F.col(name)).withColumn("crop_original", F.col(crop))
            .where(F.col("variety_clean").isNotNull()))


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column and leave the others."""
    return df.select(*[strip(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, T.StringType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def title_named(df: DataFrame, words: Sequence[str] = ("name", "crop")) -> DataFrame:
    """Title-case the string columns whose own name contains one of ``words``."""
    hit = lambda f: isinstance(f.dataType, T.StringType) and any(w in f.name.lower() for w in words)
    return df.select(*[title_case(f"`{f.name}`").alias(f.name) if hit(f) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def fill_marker(df: DataFrame, columns: Sequence[str], marker: str = UNKNOWN) -> DataFrame:
    """Fill nulls of the listed columns the frame has."""
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit(marker)).alias(c) if c in columns else F.col(f"`{c}`")
                       for c in df.columns])


def conform(values: Column, schema: Sequence[str]) -> list[Column]:
    """Fixed string columns from a struct of values; missing, null and empty ones get the marker."""
    return [F.coalesce(strip(F.nullif(values[c], F.lit(""))), F.lit(NOT_SPECIFIED)).alias(c) for c in schema]


def resolves(df: DataFrame, path: str) -> bool:
    """Whether a dotted struct path exists in the schema."""
    here: T.DataType = df.schema
    for step in path.split("."):
        if not isinstance(here, T.StructType) or step not in here.fieldNames():
            return False
        here = here[step].dataType
    return True


def project_paths(df: DataFrame, mapping: Mapping[str, str | Sequence[str]], keep: Sequence[str] = ()) -> DataFrame:
    """Select ``published name <- source path`` pairs; a name none of whose paths exists becomes 'Unknown'."""
    columns = [F.col(k) for k in keep]
    for published, paths in mapping.items():
        options = [paths] if isinstance(paths, str) else list(paths)
        present = [path_column(p.split(".")) for p in options if resolves(df, p)]
        columns.append((F.coalesce(*present) if present else F.lit(UNKNOWN)).alias(published))
    flat = df.select(*columns)
    untyped = [f.name for f in flat.schema.fields if isinstance(f.dataType, T.NullType)]
    return flat.withColumns({c: F.col(c).cast("string") for c in untyped}) if untyped else flat


def missing_paths(df: DataFrame, essential: Sequence[str]) -> list[str]:
    """Essential paths the schema lacks (a plan-time check)."""
    return [p for p in essential if not resolves(df, p)]


def stamp(df: DataFrame, **values: Column | str) -> DataFrame:
    """Add audit columns (source file, run time, source URL)."""
    return df.select("*", *[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in values.items()])


