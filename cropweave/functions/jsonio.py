"""JSON held in text columns: array cells, fenced replies, truncated replies, nested records."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropweave.functions.text import as_col, strip


def parse_string_array(c: Column | str) -> Column:
    """JSON array cell -> array<string>; null, empty, malformed and non-array cells -> empty array."""
    text = strip(c)
    parsed = F.when(text.startswith("["), F.from_json(text, "array<string>"))
    return F.coalesce(parsed, F.array().cast("array<string>"))


def array_size(c: Column | str) -> Column:
    return F.coalesce(F.size(as_col(c)), F.lit(0))


def strip_fences(c: Column | str) -> Column:
    """Drop a leading ```` ```json ```` or ```` ``` ```` and a trailing ```` ``` ````."""
    return strip(F.regexp_replace(strip(c), r"^```(?:json)?|```$", ""))


_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|"|[{}\[\]]', re.S)


def _cut_to_complete(text: str) -> str | None:
    """Keep a truncated array up to its last complete element and close it."""
    if not text.startswith("["):
        return None
    depth, end = 0, 0
    for token in _TOKEN.finditer(text):
        mark = token.group()
        if mark == '"':  # an unterminated string: nothing complete follows
            break
        if mark in "{[":
            depth += 1
        elif mark in "}]":
            depth -= 1
            if depth == 1:
                end = token.end()
    return text[:end] + "]" if end else None


@F.pandas_udf(T.StringType())
def repair_array(text: pd.Series) -> pd.Series:
    """Repaired text of a truncated JSON array; null in, null out."""
    return pd.Series([None if t is None else _cut_to_complete(t) for t in text], dtype="object")


def is_json_object(variant: Column) -> Column:
    return F.coalesce(F.schema_of_variant(variant).startswith("OBJECT"), F.lit(False))


def parse_object(c: Column | str, schema: T.StructType) -> Column:
    """Struct (value, error): a JSON object reply as ``schema``, or the reason it was refused."""
    text = strip_fences(c)
    ok = is_json_object(F.try_parse_json(text))
    return F.struct(
        F.when(ok, F.from_json(text, schema)).alias("value"),
        F.when(~ok, F.when(F.coalesce(text, F.lit("")) == "", F.lit("empty reply"))
               .otherwise(F.lit("reply is not a JSON object"))).alias("error"),
    )


def flat_paths(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Leaf paths of nested structs; arrays and maps count as leaves."""
    paths: list[tuple[str, ...]] = []
    for field in schema.fields:
        here = (*prefix, field.name)
        if isinstance(field.dataType, T.StructType):
            paths.extend(flat_paths(field.dataType, here))
        else:
            paths.append(here)
    return paths


def path_column(path: tuple[str, ...] | list[str]) -> Column:
    """Column at a struct path; every step is quoted, so names may hold dots."""
    return F.col(".".join(f"`{step}`" for step in path))


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs -> one column per leaf, named with dots (read them back with back-ticks)."""
    return df.select(*[path_column(p).alias(".".join(p)) for p in flat_paths(df.schema)])
