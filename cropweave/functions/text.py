"""Text cleaning and text-derived columns. All of it stays in JVM expressions.

``(?U)`` makes Java's ``\\w \\s \\b`` Unicode-aware.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every white-space character.
WHITE_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
               "\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip(c: Column | str) -> Column:
    """Trim every kind of white space (plain ``trim`` only removes blanks)."""
    return F.btrim(as_col(c), F.lit(WHITE_SPACE))


def clean_key(c: Column | str) -> Column:
    """Trimmed lower-case key; null when nothing is left."""
    return F.nullif(F.lower(strip(as_col(c).cast("string"))), F.lit(""))


def compare_key(c: Column | str) -> Column:
    """The form two names are compared in: word characters only, lower case, trimmed."""
    return F.trim(F.lower(F.regexp_replace(as_col(c), r"(?U)\W", " ")))


def title_case(c: Column | str) -> Column:
    """Upper-case the first letter of every letter run: ``dbgs-54a`` -> ``Dbgs-54A``."""
    runs = F.regexp_extract_all(as_col(c), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def year_in_text(c: Column | str) -> Column:
    """First stand-alone year 1900-2099 in the text, as int."""
    found = F.regexp_extract(as_col(c).cast("string"), r"(?U)\b((?:19|20)\d{2})\b", 1)
    return F.nullif(found, F.lit("")).try_cast("int")


def first_year(columns: Sequence[Column | str]) -> Column:
    """First year found in the columns, taken from left to right."""
    return F.coalesce(*[year_in_text(c) for c in columns])


def to_number(c: Column | str) -> Column:
    """Numeric coercion; null where the text is no number, the text NaN included."""
    number = strip(as_col(c).cast("string")).try_cast("double")
    return F.when(~F.isnan(number), number)


def name_features(c: Column | str) -> Column:
    """Struct (crop_name, prefix, numeric_id, abbreviation) read from a name; 'Unknown' where absent."""
    name = as_col(c)
    known = lambda found: F.coalesce(F.nullif(found, F.lit("")), F.lit(UNKNOWN))
    # The four patterns a name is read with.
    return F.struct(
        known(strip(F.regexp_extract(name, r"^([A-Za-z\s]+)", 1))).alias("crop_name"),
        known(F.regexp_extract(name, r"([A-Z]+)-", 1)).alias("prefix"),
        known(F.regexp_extract(name, r"(\d+)", 1)).alias("numeric_id"),
        known(F.regexp_extract(name, r"(?i)([cv]\.?[v]?\.?)", 1)).alias("abbreviation"),
    )


def split_values(c: Column | str, delimiters: str = r"[,;\n]", min_length: int = 3) -> Column:
    """Values of a multi-value cell: split, trim, drop those shorter than ``min_length``."""
    parts = F.transform(F.split(as_col(c), delimiters), strip)
    return F.filter(parts, lambda v: F.length(v) >= min_length)


def year_cell(c: Column | str) -> Column:
    """Struct (year, variety_count) of a cell such as ``2015\\n(3)``; empty strings where absent."""
    lines = F.split(as_col(c), "\n")
    second = F.get(lines, F.lit(1))
    return F.struct(
        F.coalesce(strip(F.get(lines, F.lit(0))), F.lit("")).alias("year"),
        F.coalesce(F.regexp_extract(second, r"\((\d+)\)", 1), F.lit("")).alias("variety_count"),
    )


def date_in_text(c: Column | str, default: Column | str) -> Column:
    """``2015_3-6`` anywhere in the text -> ``2015-03-06``; ``default`` where there is none."""
    pattern = r"(\d{4})[-_](\d{1,2})[-_](\d{1,2})"
    part = lambda i: F.regexp_extract(as_col(c), pattern, i)
    found = F.concat_ws("-", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0"))
    return F.when(part(1) != "", found).otherwise(as_col(default))


def slug(c: Column | str, length: int = 50) -> Column:
    """Words joined by ``-``, cut to ``length``; 'Document' when no word is left."""
    words = F.regexp_replace(as_col(c), r"(?U)[^\w\s-]", "")
    dashed = F.regexp_replace(F.regexp_replace(words, r"(?U)[-\s]+", "-"), "^-+|-+$", "")
    return F.when(F.coalesce(dashed, F.lit("")) == "", F.lit("Document")).otherwise(F.left(dashed, F.lit(length)))


def link_file_name(text: Column | str, title: Column | str, run_date: Column | str) -> Column:
    """File name of a linked document: date found in its text or title, then the slug of its text."""
    both = F.concat(F.coalesce(as_col(text), F.lit("")), F.coalesce(as_col(title), F.lit("")))
    return F.concat(F.lit("CSC-Meeting_"), date_in_text(both, run_date), F.lit("_"), slug(text), F.lit(".pdf"))


def document_key(meeting_number: Column | str, file_name: Column | str, document_date: Column | str) -> Column:
    """Output key of a document: its meeting number when given, else the file stem, then the date."""
    keep = lambda v: F.regexp_replace(v, r"[^\p{L}\p{N}_-]", "")
    number = as_col(meeting_number)
    stem = F.regexp_replace(as_col(file_name), r"(?<=[^/])\.[^./]*$", "")
    missing = number.isNull() | number.isin("", UNKNOWN, "Not Specified")
    return F.concat_ws("_", F.lit("AgriRegulatory"), F.when(missing, keep(stem)).otherwise(keep(number)),
                       as_col(document_date), F.lit("ExtractedData"))


def truncate_label(c: Column | str, n: int) -> Column:
    """First ``n`` characters and ``...`` when the text is longer."""
    text = as_col(c)
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit("..."))).otherwise(text)


def decade(c: Column | str) -> Column:
    """2015 -> '2010s'."""
    return F.concat((F.floor(as_col(c) / 10) * 10).cast("int").cast("string"), F.lit("s"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` rounded; null when ``whole`` is 0."""
    return F.round(F.try_divide(part * 100.0, whole), digits)
