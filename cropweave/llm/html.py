"""Main text of web pages: page structure, and the runs of tokens that repeat within each host.

Every page becomes blocks of text in page order, each with a place: in the article, outside it, in a part that is marked
as a menu, footer, notice and the like, or in a part of the article whose name leaves open whether it is one (such as
``share-box-text``). The tokens outside the article are the stream of a page, those of the open parts a stream of its
article. Each task sorts the suffixes of the streams it holds by their first ``RUN`` tokens; suffixes that begin alike
stand together in this array, and the smallest and the largest owner among them go to Spark, which merges the arrays of
all tasks of a host by these beginnings. Where the two differ the run repeats. Blocks outside an article, and open parts
of one, that such runs cover are boilerplate. Pages with the same stream, and articles with the same first block, count as
one owner, so copies and versions do not erase each other. Each host is taken as a whole, so rows do not depend on how
the pages are dealt; ``main_texts`` does the same for the pages of one host in memory.

What structure alone puts into an article asks too, by the suffixes that begin at its blocks: each task sorts those of its
articles, and Spark counts the differing articles of a host in which a block stands, followed by the same text if it is
shorter than a run. A block that stands in more than half of them, and in ``LEAST_ARTICLES`` at least, is one of the house's
notices or menus that no name marks. Articles that would lose half of their text so are versions of one text and stay whole,
as does text that fewer articles share, such as quotes.

Kept are the blocks of the article without its marked parts, repeated open parts and such notices; on a page without an
article, the unmarked blocks that repeated runs do not cover.
"""

from __future__ import annotations

import hashlib
import html as references
import itertools
import re
from collections.abc import Callable, Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave.llm import words as W
from cropweave.session import stage_table

RUN = 8
#: Characters of the pages that a task parses at once.
GROUP_CHARS = 4 << 20
#: In how many differing articles of a host, at least, a block of an article stands that is a notice of the house.
LEAST_ARTICLES = 3

ARTICLE, OUTSIDE, MARKED, OPEN = range(4)

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)", re.I)
_PART = re.compile(r"[A-Za-z]+")

#: Elements whose content is not text of the page; it runs to their end tag, whatever stands in between.
_RAW = frozenset("script style title textarea noscript iframe template svg xmp noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul".split())
#: Elements that are parts around an article.
_AROUND = frozenset("head nav aside footer form button select dialog menu".split())
#: Words of class, id and role that mark such parts.
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices alert "
    "popup modal overlay comment comments disqus respond reply sidebar sidebars aside complementary menu menus nav navbar "
    "navigation breadcrumb breadcrumbs footer contentinfo masthead share sharing social related recommended newsletter "
    "subscribe subscription signup login search pagination pager toolbar skip form".split())
#: Of these, words that text itself may be about: they mark a part only in names that say nothing else, such as ``social``
#: or ``search-box``; in names such as ``search-results`` they leave it open.
_WEAK = frozenset("alert notice notices modal overlay reply respond share sharing social related search login signup skip form "
                  "promo recommended subscription pagination comment".split())
_BOXES = frozenset("area bar block box button buttons container field icons items link links list panel posts region section top "
                   "bottom widget wrapper user site page main".split())
#: Elements that a new one of the same kind closes.
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}


def _mark(name: str, attributes: str, in_article: bool) -> int:
    """Whether an element is a part around an article: MARKED, OPEN (its name leaves it open) or ARTICLE (it is none)."""
    if name in _AROUND or name == "header" and not in_article:
        return MARKED
    if not attributes or name in ("html", "body", "main"):
        return ARTICLE
    if _HIDDEN.search(attributes):
        return MARKED
    words = set()
    unsure = False
    for found in _NAMES.finditer(attributes):
        for given in (found[1] or found[2] or found[3] or "").split():
            parts = {w.lower() for w in _PART.findall(given)}
            if parts <= _MARKS | _BOXES:
                words |= parts
            else:
                words |= parts - _WEAK
                unsure = unsure or not parts.isdisjoint(_WEAK)
    if name == "article":
        words &= {"comment", "comments", "reply", "ad", "advert", "advertisement", "promo", "related"}
        unsure = False
    if "header" in words and not in_article or not words.isdisjoint(_MARKS):
        return MARKED
    return OPEN if unsure else ARTICLE


def blocks(page: str) -> list[tuple[int, str]]:
    """Blocks of a page with their places; white space is single, empty blocks are left out."""
    found: list[tuple[int, str]] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # name, in a marked part, in an open part of an article, in an article
    parts: list[str] = []
    marked = unsure = article = False

    def close() -> None:
        if parts:
            text = " ".join(references.unescape("".join(parts)).split())
            if text:
                found.append((MARKED if marked else OPEN if unsure else ARTICLE if article else OUTSIDE, text))
            parts.clear()

    def pop(size: int) -> None:
        nonlocal marked, unsure, article
        del stack[size:]
        marked, unsure, article = stack[-1][1:] if stack else (False, False, False)

    at = 0
    while True:
        tag = _TAG.search(page, at)
        parts.append(page[at:tag.start() if tag else len(page)])
        if tag is None:
            break
        at = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if tag[1]:
            if name in _BLOCKS:
                close()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    pop(i)
                    break
            continue
        if name in _RAW:
            end = re.compile(rf"</{name}\b", re.I).search(page, at)
            at = end.start() if end else len(page)
            if name != "svg":
                parts.append(" ")
            continue
        if name == "br":
            parts.append(" ")
        elif name in _BLOCKS:
            close()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or stack[i][0] in _SIBLINGS.get(name, ()):
                    pop(i)
                    break
                if stack[i][0] in _BLOCKS:
                    break
        if name not in _VOID and not tag[3].endswith("/"):
            mark = _mark(name, tag[3], article)
            marked = marked or mark == MARKED
            unsure = unsure or mark == OPEN and article
            article = article or name in ("article", "main")
            stack.append((name, marked, unsure, article))
    close()
    return found


def suffix_array(tokens: np.ndarray, whole: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``run`` tokens, and which of them begin otherwise than the one before.

    ``whole`` tells from which places ``run`` tokens of one stream stand; only these are sorted. ``run`` is a power of two:
    the ranks of suffixes to a depth are doubled until they reach it.
    """
    total = len(tokens)
    _, rank = np.unique(tokens, return_inverse=True)
    depth = 1
    while depth < run:
        after = np.zeros(total, np.int64)
        after[:max(0, total - depth)] = rank[depth:]
        _, rank = np.unique(rank.astype(np.int64) << 32 | after, return_inverse=True)
        depth *= 2
    order = np.flatnonzero(whole)
    order = order[np.argsort(rank[order], kind="stable")]
    return order, np.flatnonzero(np.diff(rank[order], prepend=-1))


def repeated(streams: list[np.ndarray], run: int = RUN, owners: list[int] | None = None) -> list[np.ndarray]:
    """For each stream of token ids, which of its tokens lie in a run of ``run`` tokens that another owner's stream has too.

    Without ``owners`` each stream has its own. ``run`` is a power of two.
    """
    sizes = np.array([len(s) for s in streams], np.int64)
    total = int(sizes.sum())
    cover = np.zeros(total + 1, np.int64)
    ends = np.cumsum(sizes)
    if total >= run:
        owner = np.repeat(np.arange(len(streams)) if owners is None else np.array(owners), sizes)
        whole = np.arange(total) + run <= np.repeat(ends, sizes)
        order, heads = suffix_array(np.concatenate(streams), whole, run)
        if len(order):
            low = np.minimum.reduceat(owner[order], heads)
            high = np.maximum.reduceat(owner[order], heads)
            shared = np.repeat(low != high, np.diff(np.append(heads, len(order))))
            np.add.at(cover, order[shared], 1)
            np.add.at(cover, order[shared] + run, -1)
    inside = np.cumsum(cover)[:total] > 0
    return np.split(inside, ends[:-1]) if len(streams) else []


def _has_article(places: list[int]) -> bool:
    return ARTICLE in places or OPEN in places


def _asking(places: list[int]) -> list[bool]:
    """Which blocks of a page repetition decides: all without an article, else its open parts."""
    return [place == OPEN for place in places] if _has_article(places) else [True] * len(places)


def _headline(own: list[tuple[int, str]]) -> str:
    """What tells an article from others of its host: its first block."""
    return next((text for place, text in own if place == ARTICLE), "")


def _tokens(text: str) -> int:
    return text.count(" ") + 1


def _left(places: list[int], texts: list[str], inside: np.ndarray, notices: Collection[int] = ()) -> list[str]:
    """The main text of a page.

    ``inside`` tells which tokens of the blocks that ask lie in repeated runs, ``notices`` which blocks of the article
    most articles of the host have.
    """
    asking = _asking(places)
    outside = not _has_article(places)
    cuts = np.cumsum([0, *(_tokens(text) if asks else 0 for text, asks in zip(texts, asking))])
    covered = np.concatenate(([0], np.cumsum(inside)))
    gone = (np.diff(covered[cuts]) == np.diff(cuts)).tolist()
    known = set(notices)
    if 2 * sum(_tokens(texts[i]) for i in known) >= sum(_tokens(t) for place, t in zip(places, texts) if place == ARTICLE):
        known = set()
    return [text for i, (place, text, out) in enumerate(zip(places, texts, gone))
            if place == ARTICLE and i not in known or not out and (place == OPEN or place == OUTSIDE and outside)]


def _notices(parsed: list[list[tuple[int, str]]], owners: list[int], ids: Callable[[Iterator[str]], np.ndarray],
             run: int) -> list[set[int]]:
    """For each page of a host, the blocks of its article that most differing articles have."""
    holders: dict[tuple[bytes, int], set[int]] = {}
    keys = []
    for own, owner in zip(parsed, owners):
        stream = ids(text for place, text in own if place == ARTICLE)
        at, mine = 0, {}
        for i, (place, text) in enumerate(own):
            if place == ARTICLE:
                if at + run <= len(stream):
                    mine[i] = (stream[at:at + max(run, _tokens(text))].tobytes(), _tokens(text))
                at += _tokens(text)
        keys.append(mine)
        for key in mine.values():
            holders.setdefault(key, set()).add(owner)
    n = len({owner for own, owner in zip(parsed, owners) if any(place == ARTICLE for place, _ in own)})
    return [{i for i, key in mine.items() if len(holders[key]) >= LEAST_ARTICLES and 2 * len(holders[key]) > n} for mine in keys]


def main_texts(pages: list[str], run: int = RUN) -> list[tuple[str, int]]:
    """Main text, and number of blocks left out, of each page of one group of a host."""
    parsed = [blocks(page) for page in pages]
    vocabulary: dict[str, int] = {}

    def ids(texts: Iterator[str]) -> np.ndarray:
        return np.array([vocabulary.setdefault(w, len(vocabulary)) for text in texts for w in text.split()], np.int64)

    # what surely lies in the article asks by whole blocks, and so is not part of a stream
    outer = [ids(text for place, text in own if place in (OUTSIDE, MARKED)) for own in parsed]
    distinct: dict[bytes, int] = {}
    which = [distinct.setdefault(stream.tobytes(), len(distinct)) for stream in outer]
    inner = [ids(text for place, text in own if place == OPEN) for own in parsed]
    articles: dict[str, int] = {}
    of_article = [articles.setdefault(_headline(own), len(articles)) for own in parsed]
    flags, inner_flags = repeated(outer, run, which), repeated(inner, run, of_article)
    notices = _notices(parsed, of_article, ids, run)
    out = []
    for own, outside, within, known in zip(parsed, flags, inner_flags, notices):
        places = [place for place, _ in own]
        kept = _left(places, [text for _, text in own], within if _has_article(places) else outside, known)
        out.append(("\n".join(kept), len(own) - len(kept)))
    return out


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[tuple[int, str]]]]]:
    """Some rows of a batch at a time, with the blocks of their pages."""
    for batch in batches:
        first, size, held = 0, 0, []
        for i in range(len(batch)):
            page = batch.column("html")[i].as_py() or ""
            held.append(blocks(page))
            size += len(page)
            if size > GROUP_CHARS or i + 1 == len(batch):
                yield batch.slice(first, i + 1 - first), held
                first, size, held = i + 1, 0, []


def _suffixes(hosts: np.ndarray, texts: list[str], run: int, owners: list[str] | None) -> Iterator[
        tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Streams of a slice: token hashes, first token of each stream, places of whole runs, keys of these, and owners.

    Hashes differ between hosts. A stream without an owner's name is its own owner.
    """
    for piece in W.slices(pa.array(texts, pa.large_string())):
        found = piece.words(W.NOT_SPACE, lower=False)
        ends = found.of_text
        rows = np.arange(piece.first, piece.last)
        tokens = found.hashes()
        names = [tokens[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())] if owners is None else \
            [owners[i].encode("utf-8", "surrogatepass") for i in rows.tolist()]
        named = np.array([int.from_bytes(hashlib.blake2b(n, digest_size=8).digest(), "little") for n in names], np.uint64)
        tokens = W.mix(tokens * W.MULTIPLIER + np.repeat(hosts[rows], found.counts))
        whole = W.inside(found, run)
        yield tokens, ends, whole, W.gram_hashes(tokens, run)[whole], named


def _salted(hosts: pa.Array, kind: int) -> np.ndarray:
    """What lies outside of articles (0), their open parts (1) and the rest of them (2) are compared with their like only."""
    return W.mix(hosts.to_numpy(zero_copy_only=False).view(np.uint64) + np.uint64(kind))


def _stream_runs(batches: Iterator[pa.RecordBatch], run: int) -> Iterator[pa.RecordBatch]:
    """By suffix arrays: runs of the streams of a task with the smallest and the largest owner that has them there."""
    for batch, parsed in _parsed(batches):
        outer = [" ".join(text for place, text in own if place in (OUTSIDE, MARKED)) for own in parsed]
        inner = [" ".join(text for place, text in own if place == OPEN) for own in parsed]
        for texts, owners in ((outer, None), (inner, [_headline(own) for own in parsed])):
            hosts = _salted(batch.column("host"), int(owners is not None))
            for tokens, ends, at, keys, named in _suffixes(hosts, texts, run, owners):
                if not len(at):
                    continue
                whole = np.zeros(len(tokens), bool)
                whole[at] = True
                order, heads = suffix_array(tokens, whole, run)
                owner = W.signed(named[np.searchsorted(ends, order, "right") - 1])
                key = keys[np.searchsorted(at, order[heads])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(W.signed(key)), pa.array(np.minimum.reduceat(owner, heads)),
                     pa.array(np.maximum.reduceat(owner, heads))], ["run", "low", "high"])


_PAGE = ("page_id", "url")


def _is_open(own: list[tuple[int, str]]) -> bool:
    places = [place for place, _ in own]
    return OPEN in places or ARTICLE not in places


def _article_runs(hosts: pa.Array, parsed: list[list[tuple[int, str]]], run: int) -> Iterator[
        tuple[int | None, list[int], list[int]]]:
    """For each page, who owns its article, and for the blocks of the article their places and runs.

    By suffix arrays of the suffixes that begin at blocks; a block's run is told apart by the whole block too. The last
    blocks, of together less than a run, have none.
    """
    at = [[i for i, (place, _) in enumerate(own) if place == ARTICLE] for own in parsed]
    texts = [" ".join(own[i][1] for i in own_at) for own, own_at in zip(parsed, at)]
    first = 0
    for tokens, _, whole, keys, named in _suffixes(_salted(hosts, 2), texts, run, [_headline(own) for own in parsed]):
        mine = at[first:first + len(named)]
        found: list[tuple[list[int], list[int]]] = [([], []) for _ in mine]
        if len(whole):
            sizes = np.array([_tokens(own[i][1]) for own, own_at in zip(parsed[first:], mine) for i in own_at], np.int64)
            begin = np.cumsum(sizes) - sizes
            page = np.repeat(np.arange(len(mine)), [len(m) for m in mine])
            asking = np.zeros(len(tokens), bool)
            asking[np.intersect1d(begin, whole, assume_unique=True)] = True
            order, heads = suffix_array(tokens, asking, run)
            key = np.repeat(keys[np.searchsorted(whole, order[heads])], np.diff(np.append(heads, len(order))))
            place = (np.arange(len(tokens)) - np.repeat(begin, sizes)).astype(np.uint64)
            of_block = np.add.reduceat(W.mix(tokens + place * W.MULTIPLIER), begin)
            block = np.searchsorted(begin, order)
            key = W.signed(W.mix(key * W.MULTIPLIER + of_block[block]))
            flat = np.concatenate([np.array(m, np.int64) for m in mine])
            for p, i, k in zip(page[block].tolist(), flat[block].tolist(), key.tolist()):
                found[p][0].append(i)
                found[p][1].append(k)
        for own_at, owner, (places, runs) in zip(mine, W.signed(named).tolist(), found):
            yield (owner if own_at else None), places, runs
        first += len(named)


def _articles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of pages with an article that has no open parts, without the notices found in it."""
    for batch, parsed in _parsed(batches):
        at = [i for i, own in enumerate(parsed) if not _is_open(own)]
        notices = batch.column("notices")
        kept = [_left([place for place, _ in parsed[i]], [text for _, text in parsed[i]], np.zeros(0, bool),
                      notices[i].as_py() or ()) for i in at]
        rows = batch.select(_PAGE).take(pa.array(at, pa.int64()))
        yield _rows(rows, kept, [len(parsed[i]) for i in at])


def _rows(pages: pa.RecordBatch, kept: list[list[str]], sizes: list[int]) -> pa.RecordBatch:
    texts = ["\n".join(k) for k in kept]
    return pa.RecordBatch.from_arrays(
        [*pages.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
         pa.array([n - len(k) for n, k in zip(sizes, kept)], pa.int64())],
        [*_PAGE, "text", "n_chars", "n_left_out"])


_READ = ("page_id long, url string, host long, row long, places array<int>, texts array<string>, owner long, at array<int>, "
         "runs array<long>")


def _read(batches: Iterator[pa.RecordBatch], run: int) -> Iterator[pa.RecordBatch]:
    """The blocks of pages without an article, or with open parts in it; and the runs of the blocks of every article."""
    for batch, parsed in _parsed(batches):
        shown = [own if _is_open(own) else None for own in parsed]
        open_rows = pa.array([None if own is None else i for i, own in enumerate(shown)], pa.int64())
        owners, at, runs = zip(*_article_runs(batch.column("host"), parsed, run))
        yield pa.RecordBatch.from_arrays(
            [*batch.select(_PAGE).take(open_rows).columns, batch.column("host"), batch.column("row"),
             pa.array([own and [p for p, _ in own] for own in shown], pa.list_(pa.int32())),
             pa.array([own and [t for _, t in own] for own in shown], pa.list_(pa.string())),
             pa.array(owners, pa.int64()), pa.array(at, pa.list_(pa.int32())), pa.array(runs, pa.list_(pa.int64()))],
            [*_PAGE, "host", "row", "places", "texts", "owner", "at", "runs"])


def _open_runs(batches: Iterator[pa.RecordBatch], run: int) -> Iterator[pa.RecordBatch]:
    """The runs of what repetition decides on these pages."""
    for batch in batches:
        rows = batch.column("row").to_numpy()
        pages = list(zip(batch.column("places").to_pylist(), batch.column("texts").to_pylist()))
        for inner in (0, 1):
            texts = [" ".join(itertools.compress(texts, _asking(places))) if _has_article(places) == inner else ""
                     for places, texts in pages]
            first = 0
            for _, ends, at, keys, named in _suffixes(_salted(batch.column("host"), inner), texts, run, None):
                text = np.searchsorted(ends, at, "right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(rows[first + text]), pa.array((at - ends[text]).astype(np.int32)),
                                                  pa.array(W.signed(keys))], ["row", "at", "run"])
                first += len(named)


def _uncovered(batches: Iterator[pa.RecordBatch], run: int) -> Iterator[pa.RecordBatch]:
    """Rows of pages on which repetition decides, from their blocks and the places of repeated runs."""
    for batch in batches:
        kept, sizes = [], []
        for places, texts, found, notices in zip(*(batch.column(c).to_pylist()
                                                   for c in ("places", "texts", "found", "notices"))):
            edge = np.zeros(sum(map(_tokens, itertools.compress(texts, _asking(places)))) + 1, np.int64)
            starts = np.array(found or [], np.int64)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + run, -1)
            kept.append(_left(places, texts, np.cumsum(edge)[:-1] > 0, notices or ()))
            sizes.append(len(texts))
        yield _rows(batch.select(_PAGE), kept, sizes)


def extract(pages: DataFrame, run: int = RUN) -> DataFrame:
    """``(page_id, url, text, n_chars, n_left_out)`` for every row of ``pages`` (page_id, url, html).

    A null html is empty and gives an empty text. Pages without a host in their url are one host. Rows that repeat come
    out alike. Extra columns are ignored, an empty table gives an empty table. ``run`` is a power of two.
    """
    if run < 1 or run & (run - 1):
        raise ValueError("run must be a power of two")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    source = pages.select(F.col("page_id").cast("long"), "url", "html", F.xxhash64(host).alias("host"),
                          F.xxhash64("page_id", "url", "html").alias("row"))
    rows = "page_id long, url string, text string, n_chars long, n_left_out long"
    # pages are parsed again for each of these, so that no text is stored but that of pages that ask for repeated runs
    read = stage_table(source.mapInArrow(lambda b: _read(b, run), _READ))
    notices = stage_table(_notice_places(read))
    done = source.join(notices, "row", "left").select(*_PAGE, "html", "notices").mapInArrow(_articles, rows)
    open_pages = read.where("places IS NOT NULL")
    repeats = (source.mapInArrow(lambda b: _stream_runs(b, run), "run long, low long, high long").groupBy("run")
               .agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low <> high").select("run"))
    asked = open_pages.select("row", "host", "places", "texts").mapInArrow(lambda b: _open_runs(b, run), "row long, at int, run long")
    # the runs grow with the pages, so they are never broadcast
    found = asked.join(repeats.hint("merge"), "run").groupBy("row").agg(F.collect_set("at").alias("found"))
    left = (open_pages.join(found, "row", "left").join(notices, "row", "left")
            .select(*_PAGE, "places", "texts", "found", "notices"))
    return done.unionByName(left.mapInArrow(lambda b: _uncovered(b, run), rows))


def _notice_places(read: DataFrame) -> DataFrame:
    """``(row, notices)``: the blocks of an article that stand in most differing articles of its host."""
    articles = read.where("owner IS NOT NULL")
    blocks = articles.select("row", "host", "owner", F.explode(F.arrays_zip("at", "runs")).alias("b")).select(
        "row", "host", "owner", "b.at", F.col("b.runs").alias("run"))
    # a run belongs to one host; owners are made distinct first, so no task counts all pages of a large one
    counts = (blocks.select("run", "host", "owner").distinct().groupBy("run").agg(
        F.first("host").alias("host"), F.count("*").alias("n")).where(F.col("n") >= LEAST_ARTICLES))
    hosts = articles.select("host", "owner").distinct().groupBy("host").agg(F.count("*").alias("articles"))
    most = counts.join(hosts, "host").where(2 * F.col("n") > F.col("articles")).select("run")
    return blocks.join(most, "run").groupBy("row").agg(F.collect_set("at").alias("notices"))
