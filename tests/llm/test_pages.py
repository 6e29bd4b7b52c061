"""Operators on pages: archives and main text."""

import base64
import hashlib
import io
import struct
import zipfile
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cropweave.llm import html, storage, warc

PAGES = [(1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, "http://b/ x\n", "zwei ü 日本"), (4, None, None),
         (5, "http://b/5", ""), (None, "http://c", "<p>one</p>"), (None, "http://c", "alone"), (6, "http://d", "same"),
         (6, "http://d", "same"), (7, "http://e", "long " * 200_000)]


def pages_frame(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'own' AS host", "'own' AS digest", "'own' AS payload", "'own' AS original")


@pytest.mark.parametrize("least, package", [(0, 64 << 20), (0, 300), (5, 64 << 20)])
def test_archives_round_trip(shared, least, package):
    catalogue = warc.write_packages(pages_frame(shared), storage.new_folder(shared, "archives"), least, package)
    rows = warc.read_records(warc.read_index(catalogue)).collect()
    largest = {}
    for page_id, _, text in PAGES:
        if page_id is not None:
            largest[text or ""] = max(page_id, largest.get(text or "", page_id))
    want = Counter()
    for page_id, _, text in PAGES:
        data = (text or "").encode()
        first = largest.get(text or "") if len(data) >= least else None
        again = first is not None and first != page_id
        want[page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
             "revisit" if again else "response", first if again else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == want
    assert all((r.payload is None) == (r.record_type == "revisit") for r in rows)
    assert catalogue.count() > 1 or package > 300


def test_archives_without_pages(shared):
    catalogue = warc.write_packages(pages_frame(shared).limit(0), storage.new_folder(shared, "archives"))
    assert warc.read_records(warc.read_index(catalogue)).collect() == []


def test_packages_are_plain_zip_files_of_gzip_members(shared):
    catalogue = warc.write_packages(pages_frame(shared), storage.new_folder(shared, "archives"))
    store, place = storage.located(catalogue.first().path)
    with store.open_input_file(place) as stream, zipfile.ZipFile(stream) as package:
        assert package.testzip() is None
        assert {i.compress_type for i in package.infolist()} == {zipfile.ZIP_STORED}
        import gzip
        assert gzip.decompress(package.read(warc.ARCHIVE)).startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_directory_with_zip64_and_comment(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)  # every size and place is then written as a wide value
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    out.write(b"junk before")
    with zipfile.ZipFile(out, "a") as package:
        package.comment = b"a comment PK\5\6"
        for i in range(5):
            package.writestr(zipfile.ZipInfo(f"dir/m{i}"), bytes([65 + i]) * (40 + i))
        package.writestr(zipfile.ZipInfo("empty"), b"")
    data = out.getvalue()
    assert struct.pack("<I", 0x06064B50) in data
    found = warc.members(io.BytesIO(data), len(data))
    assert list(found) == [*(f"dir/m{i}" for i in range(5)), "empty"]
    for i in range(5):
        assert warc.stored(io.BytesIO(data), found[f"dir/m{i}"]) == bytes([65 + i]) * (40 + i)
        assert warc.stored(io.BytesIO(data), found[f"dir/m{i}"], 3, 2) == bytes([65 + i]) * 2
    with pytest.raises(ValueError):
        warc.stored(io.BytesIO(data), found["dir/m0"], 39, 2)
    with pytest.raises(ValueError):
        warc.members(io.BytesIO(data[:-30]), len(data) - 30)


def test_compressed_members_are_refused():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as package:
        package.writestr("x", b"aaaa" * 100)
    with pytest.raises(ValueError):
        warc.stored(out, warc.members(out, len(out.getvalue()))["x"])


def brute_repeated(streams, run):
    grams = {}
    for owner, s in enumerate(streams):
        for i in range(len(s) - run + 1):
            grams.setdefault(tuple(s[i:i + run]), set()).add(owner)
    out = []
    for s in streams:
        flags = [False] * len(s)
        for i in range(len(s) - run + 1):
            if len(grams[tuple(s[i:i + run])]) > 1:
                flags[i:i + run] = [True] * run
        out.append(flags)
    return out


@settings(deadline=None, max_examples=200)
@given(st.lists(st.lists(st.integers(0, 2), max_size=14), max_size=6), st.sampled_from([1, 2, 4]))
def test_repeated_runs(streams, run):
    got = html.repeated([np.array(s, np.int64) for s in streams], run)
    assert [g.tolist() for g in got] == brute_repeated(streams, run)


def page(body, menu="Home News Sport Culture Travel Money Weather About us"):
    return f"<html><head><title>t</title></head><body><div>{menu}</div>{body}<script>var a='</p>'</script></body></html>"


def test_main_text_of_articles_and_of_pages_without_one():
    mirrored = "".join(f"<p>paragraph {w} shared by all pages of this host as an article</p>" for w in ("one", "two"))
    pages = [page(f"<article>{mirrored}</article>"), page(f"<article>{mirrored}<p>more</p></article>"),
             page("<p>only here &amp; <b>there<br>x</p><p class='cookie-notice'>we use</p>"), page("<p>and here</p>"),
             page("<p>and here</p>"), "", "<p>unclosed <nav>menu", "plain & text < 3 <b>bold"]
    got = [t for t, _ in html.main_texts(pages)]
    text = "\n".join(f"paragraph {w} shared by all pages of this host as an article" for w in ("one", "two"))
    assert got == [text, text + "\nmore", "only here & there x", "and here", "and here", "", "unclosed", "plain & text < 3 bold"]


@pytest.mark.parametrize("markup, want", [
    ("<article><header><h1>T</h1></header><p>a\n  b&nbsp;c</p><aside>s</aside><form>f</form><p>d<footer>g</footer></article>", "T\na b c\nd"),
    ("<main><ul><li>1<li>2</ul><section class='user comments'><p>c</p></section><!-- x > y --><p>e</main>z", "1\n2\ne"),
    ("<article><div class=ad>x</div><p>&lt;b&gt; &eacute;&#233;</p><style>p{}</style><p hidden>h</p></article>", "<b> éé"),
    ("<body class='has-sidebar menu'><article class='post'>t<article class='comment'>c</article></article>", "t"),
    ("<article><P>Upper</P><p title='a > b'>q</p><br/><img src=x>end</article>", "Upper\nq\nend"),
    ("<p>a<table><tr><td>1<td>2</table>", "a\n1\n2"), ("<script>never closed <p>x", ""), ("<!-- open <p>x", "")])
def test_markup(markup, want):
    assert html.main_texts([markup])[0][0] == want


def test_extract_takes_hard_rows(shared):
    rows = [(i, f"http://h{i % 2}/{i}", page(f"<article><p>text {i}</p></article>")) for i in range(20)]
    rows += [(None, None, None), (50, "no host", ""), (50, "no host", ""), (51, "http://h0/51", page("<p>w</p> " * 200_000))]
    frame = pages_frame(shared, rows)
    got = html.extract(frame).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text for r in got if r.page_id is not None and r.page_id < 20} == {i: f"text {i}" for i in range(20)}
    assert html.extract(frame.limit(0)).collect() == []


def test_repeats_of_a_large_host_do_not_depend_on_the_dealing(shared):
    # each notice stands on two or three pages of 700, far apart in any order
    def one(i):
        body = f"<p>main text of page {i} that is only here and {i} nowhere else</p>"
        notice = f"<p>notice {i % 300} of the house with more words than a run has {i % 300}</p>"
        return page(f"<article>{body}</article>{notice}" if i % 5 == 0 else body + notice)

    rows = [(i, f"http://{'Large' if i % 2 else 'large'}.example/{i}", one(i)) for i in range(700)]
    rows += [(1000 + i, f"http://other{i}.example/", one(i)) for i in range(3)] + [(2000, rows[1][1], rows[1][2])] * 2
    want = {}
    for host in {r[1].lower().split("/")[2] for r in rows}:
        own = [r for r in rows if r[1].lower().split("/")[2] == host]
        want |= {r[0]: (t, len(t), n) for r, (t, n) in zip(own, html.main_texts([r[2] for r in own]))}
    assert not any("notice" in want[i][0] for i in range(700)) and "notice" in want[1001][0]
    for parts in (1, 7):
        got = html.extract(pages_frame(shared, rows).repartition(parts, "page_id")).collect()
        assert len(got) == len(rows)
        assert {r.page_id: (r.text, r.n_chars, r.n_left_out) for r in got} == want


@pytest.mark.parametrize("markup, want", [
    ("<p>a b <math><mi>x</mi></math> c</p>", "a b x c"),
    ("<article><div class='search-results'>r</div><div class='search-box'>s</div><div class='social share'>d</div></article>", "r"),
    ("<article><p class=related-work>w</p><p class='related-posts'>p</p><p class='form'>f</p><p class='verb-form'>v</p></article>", "w\nv")])
def test_text_that_names_only_resemble_parts(markup, want):
    assert html.main_texts([markup])[0][0] == want


def open_part_pages():
    """Pages of one host whose articles hold a part that its name leaves open: shared by two articles, or by versions of one."""
    box = "<div class='share-our-paper'>send this paper to all of your friends and to their families</div>"
    own = "<div class='related-work'>earlier work on the subject was done by many people long before us</div>"
    quoted = "<p>the same sentence stands in the articles of several pages and is text in all of them</p>"
    return [page(f"<article><h1>first</h1>{quoted}{box}</article>"), page(f"<article><h1>second</h1>{quoted}{box}</article>"),
            page(f"<article><h1>third</h1>{own}</article>", "Other menu"),
            page(f"<article><h1>third</h1>{own}<p>revised</p></article>" + own)]


def test_repetition_decides_what_names_leave_open_in_an_article():
    quoted = "the same sentence stands in the articles of several pages and is text in all of them"
    own = "earlier work on the subject was done by many people long before us"
    got = [t for t, _ in html.main_texts(open_part_pages())]
    assert got == [f"first\n{quoted}", f"second\n{quoted}", f"third\n{own}", f"third\n{own}\nrevised"]


@pytest.mark.parametrize("parts", [1, 4])
def test_the_query_sorts_suffixes_and_asks_for_open_parts(shared, parts):
    pages = open_part_pages()
    rows = [(i, "http://h/", text) for i, text in enumerate(pages)] + [(9, "http://alone/", pages[0])]
    want = dict(enumerate(html.main_texts(pages))) | {9: html.main_texts(pages[:1])[0]}
    got = html.extract(pages_frame(shared, rows).repartition(parts, "page_id")).collect()
    assert {r.page_id: (r.text, r.n_left_out) for r in got} == want and len(got) == len(rows)
    assert "friends" in want[9][0] and "friends" not in want[0][0]


@settings(deadline=None, max_examples=100)
@given(st.lists(st.lists(st.integers(0, 2), max_size=14), max_size=6), st.sampled_from([1, 2, 4, 8]))
def test_suffix_arrays_of_slices(streams, run):
    tokens = np.array([t for s in streams for t in s], np.uint64)
    ends = np.cumsum([len(s) for s in streams])
    whole = np.array([i + run <= ends[np.searchsorted(ends, i, "right")] for i in range(len(tokens))], bool)
    order, heads = html.suffix_array(tokens, whole, run)
    begin = [tuple(tokens[i:i + run].tolist()) for i in order.tolist()]
    assert sorted(order.tolist()) == np.flatnonzero(whole).tolist() and begin == sorted(begin)
    assert heads.tolist() == [i for i in range(len(begin)) if i == 0 or begin[i] != begin[i - 1]]


def noticed_pages(n=7):
    """Articles of a host with a notice in most of them, a quote in few, and a text that one article has in many versions."""
    notice = "<p>Sign up for the weekly letter of this house to read more</p>"
    quote = "<p>the same sentence stands in the articles of three pages and is text in all of them</p>"
    body = lambda i: f"<p>{' '.join(f'word{i}x{k}' for k in range(40))}</p>"
    pages = [page(f"<article><h1>title {i}</h1>{body(i)}{quote if i < 3 else ''}<p>More:</p>{notice if i != 6 else ''}</article>")
             for i in range(n)]
    box = "<div class='share-our-paper'>send this paper to all of your friends and to their families</div>"
    return [*pages, page(f"<article><h1>title 1</h1>{body(1)}{notice}{box}</article>"), page(f"<p>outside {notice}</p>")]


@pytest.mark.parametrize("parts", [1, 5])
def test_repetition_decides_on_blocks_of_articles(shared, parts):
    pages = noticed_pages()
    copies = [page(f"<article><h1>version {i}</h1><p>{' '.join(f'same{k}' for k in range(30))}</p></article>") for i in range(4)]
    hosts = {"h": pages, "copies": copies, "two": pages[:2], "few": [pages[0], pages[1], *(page(
        f"<article><h1>other {i}</h1><p>{' '.join(f'o{i}y{k}' for k in range(20))}</p></article>") for i in range(5))]}
    rows, want = [], {}
    for host, own in hosts.items():
        for text, (main, out) in zip(own, html.main_texts(own)):
            want[len(rows)] = (main, out)
            rows.append((len(rows), f"http://{host}/", text))
    got = html.extract(pages_frame(shared, rows * 2).repartition(parts, "page_id")).collect()
    assert {r.page_id: (r.text, r.n_left_out) for r in got} == want and len(got) == 2 * len(rows)
    assert not any("Sign up" in want[i][0] or "More:" in want[i][0] for i in (0, 1, 2, 3, 4, 5, 7)) and "friends" in want[7][0]
    assert all("the same sentence" in want[i][0] for i in range(3)) and "More:" in want[6][0]
    at = len(pages)
    assert all("same29" in want[at + i][0] for i in range(4))  # versions of one text stay whole
    assert all("Sign up" in want[at + 4 + i][0] for i in range(4))  # in two articles, of two and of seven
