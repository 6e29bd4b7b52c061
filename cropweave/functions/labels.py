"""Rule-based categories and flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cropweave.functions.text import as_col


def banded(c: Column, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first band whose lower bound the value reaches (bands in descending order)."""
    first, *rest = bands
    label = F.when(c >= first[0], F.lit(first[1]))
    return reduce(lambda acc, band: acc.when(c >= band[0], F.lit(band[1])), rest, label).otherwise(F.lit(otherwise))


def match_confidence(score: Column | str) -> Column:
    return banded(as_col(score), [(95, "HIGH"), (80, "MEDIUM"), (60, "LOW")], "VERY_LOW")


def review_priority(status: Column | str, score: Column | str) -> Column:
    return (F.when(as_col(status) == "UNMATCHED", F.lit("HIGH"))
            .when(as_col(score) < 90, F.lit("MEDIUM")).otherwise(F.lit("LOW")))


def needs_review(status: Column | str, score: Column | str) -> Column:
    return (as_col(status) == "UNMATCHED") | (as_col(score) < 95)


# The portal's crop groups.
CROP_GROUPS = {
    "GARLIC": "BULB VEGETABLES", "ONION": "BULB VEGETABLES",
    "MAIZE": "CEREALS", "WHEAT": "CEREALS", "RICE": "CEREALS",
    "CAULIFLOWER": "COLE CROPS", "CABBAGE": "COLE CROPS", "BROCOLLI": "COLE CROPS",
    "CUCUMBER": "CUCURBITS", "PUMPKIN": "CUCURBITS", "BOTTLE GOURD": "CUCURBITS", "BITTER GOURD": "CUCURBITS",
}


def lookup(c: Column | str, table: Mapping[str, str], default: Column | str | None = None) -> Column:
    """Value of a small fixed table kept inside the expression, so no join is planned."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = F.element_at(entries, as_col(c))
    return found if default is None else F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def crop_group(crop: Column | str, table: Mapping[str, str] = CROP_GROUPS, default: str = "CEREALS") -> Column:
    return lookup(F.upper(as_col(crop)), table, default)


def standard_state(c: Column | str, aliases: Mapping[str, str]) -> Column:
    """Lower-case trimmed state name with its aliases replaced."""
    from cropweave.functions.text import clean_key

    key = clean_key(c)
    return lookup(key, aliases, key) if aliases else key


def maturity_group(days: Column | str, early_below: int = 100, late_from: int = 130) -> Column:
    d = as_col(days)
    return F.when(d < early_below, F.lit("Early")).when(d < late_from, F.lit("Medium")).when(d >= late_from, F.lit("Late"))


def variety_type(is_hybrid: Column | str, breeding_method: Column | str) -> Column:
    """Hybrid when flagged so, Selection when the method says so, else Improved."""
    return (F.when(as_col(is_hybrid), F.lit("Hybrid"))
            .when(F.lower(as_col(breeding_method)).contains("selection"), F.lit("Selection"))
            .otherwise(F.lit("Improved")))


def keyword_class(c: Column | str, keywords: Sequence[tuple[str, str]], default: str) -> Column:
    """Class of the first keyword the text contains, in the given order (institution types and the like)."""
    text = F.lower(as_col(c))
    hits = [F.when(text.contains(word.lower()), F.lit(label)) for word, label in keywords]
    return F.coalesce(*hits, F.lit(default))
