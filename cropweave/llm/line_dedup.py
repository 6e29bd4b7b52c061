"""Removal of repeated runs of lines, by winnowing over line hashes. DataFrame functions only.

Lines with a word make up the line sequence of a document. A window is the shortest run of lines from a given line that
has ``min_lines`` lines or ``min_words`` words; which lines it covers follows from their content alone, so equal runs
have equal windows. The smallest line hash of a window is kept as its fingerprint: a repeated run of at least a window
shares a kept fingerprint with its earlier copy. Fingerprints that occur once leave at once. The others carry the
windows on both sides of them; a window whose lines stood earlier in the corpus is deleted, and as windows overlap, the
deletions join up to the longest repeated run around each fingerprint. The first occurrence, in order of
(doc_id, hash of the text, line), stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropweave.session import stage_table

MIN_LINES = 3
MIN_WORDS = 50

_WORD = r"[^\x20\x09-\x0D]+"


def _line_windows(min_lines: int, min_words: int) -> Column:
    """For the line at ``i`` of the array ``seq``: (fingerprint offset, fingerprint, last line, hash of the lines)."""

    def at(j: int) -> Column:
        return F.get(F.col("seq"), F.col("i") + j)

    words, cases = F.lit(0), None
    for j in range(min_lines):
        words = words + at(j)["n"]
        hashes = [at(x)["h"] for x in range(j + 1)]
        low = F.least(*hashes) if j else hashes[0]
        offset = F.lit(j)
        for x in reversed(range(j)):
            offset = F.when(hashes[x] == low, F.lit(x)).otherwise(offset)
        window = F.struct((F.col("i") + offset).alias("at"), low.alias("fp"), F.col("i").alias("first"),
                          (F.col("i") + j).alias("last"), F.xxhash64(F.lit(j), *hashes).alias("content"))
        long_enough = at(j).isNotNull() & ((words >= min_words) if j + 1 < min_lines else F.lit(True))
        cases = F.when(long_enough, window) if cases is None else cases.when(long_enough, window)
    return cases


def line_windows(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, row, fp, window, at)``: every window with the fingerprint kept for it and the place of that line.

    Window ends are numbers of lines with a word, from 0.
    """
    hashed = F.transform(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda line: line.rlike(_WORD)),
                         lambda line: F.struct(F.xxhash64(line).alias("h"),
                                               F.regexp_count(line, F.lit(_WORD)).alias("n")))
    lines = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), hashed.alias("seq"))
    each = lines.select("doc_id", "row", "seq", F.explode(F.sequence(F.lit(0), F.size("seq") - 1)).alias("i")).filter(
        "i >= 0 AND i < size(seq)")
    windows = each.select("doc_id", "row", _line_windows(min_lines, min_words).alias("w")).filter("w IS NOT NULL")
    return windows.select("doc_id", "row", "w.fp", F.struct("w.first", "w.last", "w.content").alias("window"),
                          F.col("w.at").alias("at"))


def repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``(row, line)``: the lines (numbers among those with a word) to delete from each document."""
    windows = stage_table(line_windows(docs, min_lines, min_words))
    # a fingerprint that stands at one place only has no copy
    places = windows.groupBy("fp").agg(F.min(F.struct("doc_id", "row", "at")).alias("low"),
                                       F.max(F.struct("doc_id", "row", "at")).alias("high"))
    met = windows.join(places.filter("low <> high").select("fp"), "fp").select(
        F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", F.col("window.first").alias("first"))
        .alias("place"), F.col("window.last").alias("last"), F.col("window.content").alias("content"))
    origin = met.groupBy("content").agg(F.min("place").alias("origin"))
    later = met.join(origin, "content").filter("place > origin")
    return later.select("place.row", F.explode(F.sequence("place.first", "last")).alias("line")).distinct()


def deduplicate_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the repeated runs cut out of ``text``, and ``n_lines`` and ``n_deleted`` added.

    Needs doc_id and text; other columns pass through, columns named ``n_lines`` or ``n_deleted`` are replaced. Lines
    without a word are never part of a run and stay. A null text stays null. Rows equal in doc_id and text count as one
    document and come out alike. A null doc_id comes after all others. A text whose lines all go becomes empty.
    An empty table gives an empty table. A repeated run may overlap its own copy (the same line many times in a row):
    all but its first lines go.
    """
    if min_lines < 1 or min_words < 1:
        raise ValueError("min_lines and min_words must be at least 1")
    gone = (repeated_lines(docs, min_lines, min_words).groupBy(F.col("row").alias("_row"))
            .agg(F.collect_list("line").alias("_lines")))
    split = F.split(F.col("text"), "\n")
    joined = docs.join(gone, F.xxhash64(docs["doc_id"], docs["text"]) == F.col("_row"), "left")
    worded = F.filter(F.transform(split, lambda line, i: F.when(line.rlike(_WORD), i)), lambda i: i.isNotNull())
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1),
                          F.transform("_lines", lambda i: F.element_at(worded, i + 1)))
    text = F.when(F.col("_lines").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.element_at(split, i + 1)), "\n"))
    n_lines = F.coalesce(F.size(worded), F.lit(0))
    return (joined.withColumns({"text": text, "n_lines": F.when(F.col("text").isNull(), 0).otherwise(n_lines),
                                "n_deleted": F.coalesce(F.size("_lines"), F.lit(0))})
            .drop("_row", "_lines"))


SQL = r"""
WITH l AS (
  SELECT doc_id, pos, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos FROM documents)),
s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM l WHERE n > 0),
w AS (SELECT doc_id, i,
        CASE WHEN n >= 50 THEN i
             WHEN n + lead(n) OVER d >= 50 THEN i + 1
             WHEN lead(n, 2) OVER d IS NOT NULL THEN i + 2 END AS e,
        line AS a, lead(line) OVER d AS b, lead(line, 2) OVER d AS c
      FROM s WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
k AS (SELECT doc_id, i, e, concat_ws(chr(10), a, CASE WHEN e > i THEN b END, CASE WHEN e > i + 1 THEN c END) AS content
      FROM w WHERE e IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, i) AS nth FROM k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, e + 1)) AS i FROM r WHERE nth > 1),
kept AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.i IS NULL) AS text,
                count(s.i) AS n_lines, count(g.i) AS n_deleted
         FROM l LEFT JOIN s USING (doc_id, pos) LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.i = s.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(kept.text, '') AS text, d.lang, d.source, d.n_chars,
       coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted
FROM documents d LEFT JOIN kept USING (doc_id)
"""
