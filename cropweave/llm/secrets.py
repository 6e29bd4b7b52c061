"""Secret scans: three fixed patterns, and sliding-window entropy over candidate strings. DataFrame functions only.

Matches are wrapped in control characters by one pass of a regular expression; splitting at these and adding up lengths
gives their places in code points. Candidate strings are runs of characters of tokens. The Shannon entropy of each
window of ``WINDOW`` characters follows from that of the window before it by the counts of the one character that leaves
and the one that enters. Windows over the threshold of the character class of their string make up a span, unless an
allow-list names the string or a fixed pattern covers it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 20

#: The patterns of the three kinds, and the fewest characters of what counts.
ASSIGN = r"((?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?)([A-Za-z0-9+/_.=-]+)"
ACCESS = r"()(AKIA[A-Z0-9]+)"
HEX = r"()([0-9a-f]{16,})"
KINDS = (("assign", ASSIGN, 12), ("access", ACCESS, 18), ("hex", HEX, 16))

CANDIDATE = r"()([A-Za-z0-9+/_=-]{20,})"
#: Character classes from narrow to wide: name, pattern of the whole string, least entropy of a window in bits.
CLASSES = (("entropy_hex", r"^[0-9A-Fa-f]+$", 3.0), ("entropy_alnum", r"^[0-9A-Za-z]+$", 3.6),
           ("entropy_base64", r"^[0-9A-Za-z+/_=-]+$", 3.8))
#: Strings that are no secrets: without a digit or without a letter, identifiers of the 8-4-4-4-12 form, paths of plain
#: words, and stated placeholders.
ALLOWED = (r"^[^0-9]*$", r"^[^A-Za-z]*$", r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
           r"^[a-z/_-]+(/?v?[0-9]{1,4})?$", r"(?i)example|placeholder|changeme|your[_-]|xxxx|0123456789|abcdefgh")

_EDGE, _VALUE, _OTHER = "\x01", "\x02", "\x03"
_SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string>"


def _matches(text: Column, pattern: str, least: int, kind: str, rank: int) -> Column:
    """Array of spans of the leftmost, non-overlapping matches whose second group has ``least`` characters or more."""
    pieces = F.split(F.regexp_replace(text, F.lit(pattern), F.lit(f"{_EDGE}$1{_VALUE}$2{_EDGE}")), _EDGE)
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))

    def step(state: Column, piece: Column) -> Column:
        hit = F.instr(piece, _VALUE)
        end = state["at"] + F.length(piece) - F.when(hit > 0, 1).otherwise(0)
        value = F.substring(piece, hit + 1, F.length(piece))
        span = F.struct(state["at"].alias("start"), F.lit(rank).alias("rank"), end.alias("end"),
                        F.lit(kind).alias("kind"), value.alias("value"))
        good = (hit > 0) & (F.length(value) >= least)
        return F.struct(end.alias("at"), F.when(good, F.concat(state["spans"], F.array(span)))
                        .otherwise(state["spans"]).alias("spans"))

    return F.aggregate(pieces, empty, step, lambda state: state["spans"])


def _count(char: Column, window: Column) -> Column:
    return F.size(F.filter(window, lambda c: c == char))


def _weight(n: Column) -> Column:
    """n * log2(n), 0 for 0."""
    return F.when(n > 1, n * F.log2(n)).otherwise(F.lit(0.0))


def entropy_bounds(value: Column, least: Column, window: int = WINDOW) -> Column:
    """``(first, last)``: start of the first and end of the last window of ``value`` with ``least`` bits or more.

    The characters are an array, made once, so a step looks at one window and its time does not depend on the length.
    """
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))

    def walk(chars: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            leaving = F.get(chars, i - window)
            n = _count(leaving, F.slice(chars, F.greatest(i - window + 1, F.lit(1)), F.lit(window)))
            total = state["sum"] - F.when(i >= window, _weight(n) - _weight(n - 1)).otherwise(F.lit(0.0))
            inside = F.slice(chars, F.greatest(i - window + 2, F.lit(1)), F.least(i, F.lit(window - 1)))
            m = _count(F.get(chars, i), inside)
            total = total + _weight(m + 1) - _weight(m)
            # sums of logarithms in another order may differ in the last bits
            over = (i >= window - 1) & (F.lit(math.log2(window)) - total / window >= least - 1e-9)
            return F.struct(total.alias("sum"),
                            F.when(over & (state["first"] < 0), i - window + 1).otherwise(state["first"]).alias("first"),
                            F.when(over, i + 1).otherwise(state["last"]).alias("last"))

        return F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), start, step)

    # a lambda variable is evaluated once, an expression inside the lambda at every step
    return F.get(F.transform(F.array(F.split(value, "")), walk), 0)


def _entropy_spans(candidates: Column, base: Column) -> Column:
    def allowed(value: Column) -> Column:
        found = F.lit(False)
        for pattern in ALLOWED:
            found = found | value.rlike(pattern)
        return found

    def spans(c: Column) -> Column:
        least, kind, rank = F.lit(None).cast("double"), F.lit(None).cast("string"), F.lit(None).cast("int")
        for i, (name, pattern, bits) in reversed(list(enumerate(CLASSES))):
            own = c["value"].rlike(pattern)
            least, kind = F.when(own, bits).otherwise(least), F.when(own, F.lit(name)).otherwise(kind)
            rank = F.when(own, len(KINDS) + i).otherwise(rank)
        bounds = entropy_bounds(c["value"], least)
        return F.struct((c["start"] + bounds["first"]).alias("start"), rank.alias("rank"),
                        (c["start"] + bounds["last"]).alias("end"), kind.alias("kind"), c["value"].alias("value"))

    open_ones = F.filter(candidates, lambda c: ~allowed(c["value"]) & ~F.exists(
        base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return F.filter(F.transform(open_ones, spans), lambda s: s["end"] > s["start"])


def _listing(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``found`` (array of start, rank, end, kind, value) added: the spans of all kinds in order of start.

    A null text counts as empty and has none. Other columns pass through; one named ``found`` is replaced. Equal starts
    are ordered by kind. Rows are treated one by one, so repeated rows come out alike. Places are code points, ends are
    exclusive.
    """
    text = F.translate(F.coalesce("text", F.lit("")), _EDGE + _VALUE, _OTHER * 2)
    marked = docs.withColumn("_text", text)
    base = F.concat(*(_matches(F.col("_text"), p, n, k, i) for i, (k, p, n) in enumerate(KINDS)))
    marked = marked.withColumns({"_base": F.array_sort(base),
                                 "_more": _matches(F.col("_text"), CANDIDATE, WINDOW, "", 0)})
    return marked.withColumn("found", F.array_sort(F.concat("_base", _entropy_spans(F.col("_more"), F.col("_base"))))
                             ).drop("_text", "_base", "_more")


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` for every row of ``docs``."""
    base = F.filter("found", lambda s: s["rank"] < len(KINDS))

    def count(rank: int) -> Column:
        return F.size(F.filter("found", lambda s: s["rank"] == rank)).cast("long")

    counts = [count(i).alias(f"n_{kind}") for i, (kind, _, _) in enumerate(KINDS)]
    return secret_spans(docs.select("doc_id", "text")).select(
        "doc_id", *counts, F.sha2(_listing(base).cast("binary"), 256).alias("base_sha256"),
        _listing(F.col("found")).alias("spans"))


SQL = r"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), chr(1) || chr(2), chr(3) || chr(3)) AS s FROM documents),
k(kind, rank, pattern, least) AS (VALUES
  ('assign', 0, '((?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?)([A-Za-z0-9+/_.=-]+)', 12),
  ('access', 1, '()(AKIA[A-Z0-9]+)', 18), ('hex', 2, '()([0-9a-f]+)', 16), ('more', 3, '()([A-Za-z0-9+/_=-]{20,})', 20)),
p AS (SELECT doc_id, kind, rank, least, string_split(regexp_replace(s, pattern, chr(1) || '\1' || chr(2) || '\2' || chr(1), 'g'), chr(1)) AS a
      FROM t, k),
u AS (SELECT doc_id, kind, rank, least, unnest(a) AS piece, unnest(range(1, len(a) + 1)) AS i FROM p),
c AS (SELECT *, contains(piece, chr(2)) AS hit, len(piece) - contains(piece, chr(2))::INT AS n FROM u),
o AS (SELECT *, sum(n) OVER (PARTITION BY doc_id, rank ORDER BY i) AS last FROM c),
m AS (SELECT doc_id, kind, rank, (last - n)::BIGINT AS first, last::BIGINT AS last, split_part(piece, chr(2), 2) AS value
      FROM o WHERE hit AND len(split_part(piece, chr(2), 2)) >= least),
b AS (SELECT * FROM m WHERE rank < 3),
e AS (SELECT *, CASE WHEN regexp_matches(value, '^[0-9A-Fa-f]+$') THEN 0 WHEN regexp_matches(value, '^[0-9A-Za-z]+$') THEN 1 ELSE 2 END AS class
      FROM m WHERE rank = 3 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
      AND NOT regexp_matches(value, '^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$')
      AND NOT regexp_matches(value, '^[a-z/_-]+(/?v?[0-9]{1,4})?$')
      AND NOT regexp_matches(value, '(?i)example|placeholder|changeme|your[_-]|xxxx|0123456789|abcdefgh')
      AND NOT EXISTS (SELECT 1 FROM b WHERE b.doc_id = m.doc_id AND b.first < m.last AND m.first < b.last)),
w AS (SELECT doc_id, class, first, j,
        list_aggregate(string_split(substr(value, j + 1, 20), ''), 'entropy') >= [3.0, 3.6, 3.8][class + 1] - 1e-9 AS over
      FROM e, LATERAL (SELECT unnest(range(0, len(value) - 19)) AS j)),
x AS (SELECT doc_id, ['entropy_hex', 'entropy_alnum', 'entropy_base64'][class + 1] AS kind, 3 + class AS rank,
        first + min(j) AS first, first + max(j) + 20 AS last FROM w WHERE over GROUP BY doc_id, class, w.first),
a AS (SELECT doc_id, kind, rank, first, last FROM b UNION ALL SELECT * FROM x),
g AS (SELECT doc_id, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access,
        count(*) FILTER (WHERE rank = 2) AS n_hex,
        string_agg(kind || ':' || first || ':' || last, ',' ORDER BY first, rank) FILTER (WHERE rank < 3) AS base,
        string_agg(kind || ':' || first || ':' || last, ',' ORDER BY first, rank) AS spans FROM a GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN g USING (doc_id)
"""
