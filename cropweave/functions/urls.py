"""Link extraction and resolution."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropweave.functions.text import as_col, strip


# The rest of a tag after its name; quoted values may hold a '>'.
TAG_REST = r"""(?:[^>"']++|"[^"]*"|'[^']*')*+>"""


@F.pandas_udf(T.StringType())
def unescape_html(text: pd.Series) -> pd.Series:
    """Character references -> characters."""
    return text.map(html.unescape, na_action="ignore")


def visible_html(c: Column | str) -> Column:
    """HTML without comments, scripts and styles, where tag-like text is no tag."""
    return F.regexp_replace(as_col(c), r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", "")


def attribute(tag: Column, name: str) -> Column:
    """Raw value of a tag attribute, null when the tag has none."""
    pattern = rf"""(?is)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    groups = [F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)]
    return F.when(tag.rlike(pattern), F.concat(*groups))


def inner_text(fragment: Column) -> Column:
    """Text of an element: tags dropped, every text piece trimmed before they are joined."""
    pieces = F.split(fragment, r"(?s)<[^>]*>")
    return F.array_join(F.transform(pieces, strip), "")


def _normal_path(path: Column) -> Column:
    """Resolve ``.`` and ``..`` steps of an absolute path."""
    steps = F.split(path, "/")
    resolved = F.aggregate(
        steps, F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.array_append(acc, s)))
    ends_in_dots = F.element_at(steps, -1).isin(".", "..")
    joined = F.array_join(resolved, "/")
    return F.when(ends_in_dots, F.concat(joined, F.lit("/"))).otherwise(joined)


def resolve_url(base: Column | str, ref: Column | str) -> Column:
    """Absolute URL of a link found on the page ``base`` (RFC 3986 resolution of http(s) bases)."""
    base, ref = as_col(base), as_col(ref)
    origin = F.regexp_extract(base, r"^([A-Za-z][\w+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][\w+.-]*):", 1)
    base_path = F.regexp_extract(base, r"^[A-Za-z][\w+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_extract(F.when(base_path == "", F.lit("/")).otherwise(base_path), r"^(.*/)", 1)
    no_fragment = F.regexp_replace(base, "#.*$", "")
    no_query = F.regexp_replace(base, r"[?#].*$", "")
    ref_path = F.regexp_extract(ref, r"^([^?#]*)", 1)
    ref_rest = F.substr(ref, F.length(ref_path) + 1)
    return (
        F.when(ref == "", base)
        .when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), ref)
        .when(ref.startswith("//"), F.concat(scheme, F.lit(":"), ref))
        .when(ref.startswith("#"), F.concat(no_fragment, ref))
        .when(ref.startswith("?"), F.concat(no_query, ref))
        .when(ref.startswith("/"), F.concat(origin, _normal_path(ref_path), ref_rest))
        .otherwise(F.concat(origin, _normal_path(F.concat(folder, ref_path)), ref_rest))
    )
