from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropweave.functions import jsonio, urls
from cropweave.operators import columns, extract
from cropweave.plans import extraction

REPLIES = {
    "plain": ('[{"variety_name":"A"}]', ["A"], "ok"),
    "fenced": ('```json\n[{"variety_name":"A"}]\n```', ["A"], "ok"),
    "bare fence": ('```\n[{"variety_name":"A"}]\n```', ["A"], "ok"),
    "open array": ('[{"variety_name":"A"},{"variety_name":"B"}', ["A", "B"], "repaired"),
    "cut inside": ('[{"variety_name":"A"},{"variety_name":"B', ["A"], "repaired"),
    "cut in first": ('[{"variety_name":"A', [], "failed"),
    "brace in string": ('[{"variety_name":"A}"},{"x":1', ["A}"], "repaired"),
    "escaped quote": ('[{"variety_name":"A\\"]}"},{"x":"', ['A"]}'], "repaired"),
    "nested": ('[{"variety_name":"A","a":[1,{"b":2}]},{"a":[', ["A"], "repaired"),
    "lone object": ('{"variety_name":"A"}', [], "failed"),
    "other element": ('[{"variety_name":"A"}, 5, "{x"]', ["A"], "ok"),
    "unknown key": ('[{"variety_name":"A","zzz":1}]', ["A"], "ok"),
    "blank": ('[{"variety_name":null,"crop_type":""}]', ["Not Specified"], "ok"),
    "number": ('[{"variety_name":3226}]', ["3226"], "ok"),
    "empty array": ("[]", [], "failed"),
    "prose": ("sorry", [], "failed"),
    "nothing": ("", [], "failed"),
    "null": (None, [], "failed"),
}


def reply_frame(spark):
    return spark.createDataFrame([(f"in/{k}.pdf", v[0]) for k, v in REPLIES.items()], "doc_path string, reply_text string")


def test_reply_cases(spark):
    parsed = extract.parse_replies(reply_frame(spark))
    assert {r.doc_path: r.status for r in parsed.select("doc_path", "status").collect()} == {
        f"in/{k}.pdf": v[2] for k, v in REPLIES.items()}
    records = extract.reply_records(parsed, "doc_path", "ts")
    got = {}
    for r in records.orderBy("source_document_filename", "record_pos").collect():
        got.setdefault(r.source_document_filename, []).append(r.variety_name)
    assert got == {f"in/{k}.pdf": v[1] for k, v in REPLIES.items() if v[1]}
    assert [c for c in records.columns if c != "record_pos"] == list(extract.RECORD_FIELDS)
    assert len(extract.RECORD_FIELDS) == 65 and len(set(extract.RECORD_FIELDS)) == 65


def test_batch_summary_and_files(spark, tmp_path):
    summary = extraction.run(reply_frame(spark), str(tmp_path), "2024-01-01T00:00:00").first()
    assert (summary.total_documents, summary.successful, summary.repaired, summary.failed) == (18, 12, 5, 6)
    assert spark.read.json(f"{tmp_path}/failed_documents").count() == 6
    text = "".join(p.read_text() for p in (tmp_path / "records").rglob("*.csv"))
    assert '"Not Specified","Not Specified"' in text


def test_document_key_comes_from_first_record(spark):
    df = spark.createDataFrame([("a/b.pdf", '[{"meeting_number":"92/x","document_date":"2019"},{"meeting_number":"1"}]')],
                               "doc_path string, reply_text string")
    rows = extraction.extract_records(df, "2024-01-01T00:00:00").collect()
    assert {r.document_key for r in rows} == {"AgriRegulatory_92x_2019_ExtractedData"} and len(rows) == 2


def test_string_arrays(spark):
    cells = ['["a", "b"]', " [1, null] ", "[]", "", None, "{", '["a"', '{"a":1}', "x"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    got = [r[0] for r in df.orderBy("i").select(jsonio.parse_string_array("c")).collect()]
    assert got == [["a", "b"], ["1", None], [], [], [], [], [], [], []]


def test_flatten_keeps_lists(spark):
    df = spark.sql("select named_struct('b', named_struct('c', 1, 'd', array(1, 2)), 'e', 'x') a, 2 z")
    flat = jsonio.flatten(df)
    assert flat.columns == ["a.b.c", "a.b.d", "a.e", "z"]
    assert flat.select("`a.b.d`").first()[0] == [1, 2]


def test_parse_object(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    df = spark.createDataFrame([(0, '```json\n{"a": 1}\n```'), (1, "[1]"), (2, None), (3, '{"a": 1')], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(jsonio.parse_object("t", schema)).collect()]
    assert got[0].value.a == 1 and got[0].error is None
    assert [r.error for r in got[1:]] == ["reply is not a JSON object", "empty reply", "reply is not a JSON object"]


BASES = ["http://h.org/a/b/c.html?q=1#f", "https://h.org", "http://h.org/", "http://h.org/x"]
REFS = ["y.pdf", "../y.pdf", "../../../y.pdf", "./y.pdf?z=1", "/m/x.pdf", "//o.org/x.pdf", "https://o.org/x.pdf", "mailto:a@b.c",
        "#top", "?p=2", "", "d/../e/./f.pdf", "a b.pdf", "..", "x/"]


def test_resolve_url_matches_urljoin(spark):
    pairs = [(b, r) for b in BASES for r in REFS]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, b string, r string")
    got = [x[0] for x in df.orderBy("i").select(urls.resolve_url("b", "r")).collect()]
    assert dict(zip(pairs, got)) == {p: urljoin(*p) for p in pairs}


HTML = """<html><script>var x = '<a href="s.pdf">s</a>';</script><!-- <a href="c.pdf">c</a> -->
<A class='k' HREF="A.PDF" title="T &amp; t"> <b>First</b> link </A><a href='/m/x.pdf'>x&nbsp;y</a><a href=u.pdf>u</a>
<a href="page.html">no</a><a data-href="n.pdf" href="n.html">n</a><a href="A.PDF">again</a>
<a href="open.pdf" title="a > b">never closed <a href="next.pdf">next</a><a href="/one"><img src="i.png"/></a>
<div onclick="open('d/y.pdf?z=1')">Open<p>it</p></div><a href="#" onclick='go("e.pdf", "f.pdf")'>Go</a><div onclick="open('z.html')">z</div></html>"""


def test_links(spark):
    df = spark.createDataFrame([(1, "http://h.org/p/i.html", HTML), (2, "http://h.org/", "<p>none</p>")], "id int, url string, html string")
    got = [(r.link_source, r.link_url, r.link_text, r.link_title) for r in extract.html_links(df).orderBy("link_pos").collect()]
    assert got == [
        ("href", "http://h.org/p/A.PDF", "Firstlink", "T & t"), ("href", "http://h.org/m/x.pdf", "x\xa0y", ""),
        ("href", "http://h.org/p/u.pdf", "u", ""), ("href", "http://h.org/p/A.PDF", "again", ""),
        ("href", "http://h.org/p/open.pdf", "never closed", "a > b"), ("href", "http://h.org/p/next.pdf", "next", ""),
        ("onclick", "http://h.org/p/d/y.pdf?z=1", "Openit", ""), ("onclick", "http://h.org/p/e.pdf", "Go", "")]


TABLE = """<table><tr><th>SlNo</th></tr>
<tr><td>1</td><td> RICE </td><td>2015<br>(3)</td><td>Punjab</td><td>PR-124, PR-126;IR 64<br/>X1</td></tr>
<tr><td>2</td><td>RICE</td><td>2016</td><td>Punjab</td><td></td></tr>
<tr><td>3</td><td>RICE</td><td>2017</td><td>Punjab</td></tr>
<tr><td>4</td><td>WHEAT</td><td></td><td></td><td><b>HD 3226</b></td><td>more</td></tr></table>"""


def test_registry_rows(spark):
    df = spark.createDataFrame([(7, TABLE)], "id int, html string")
    rows = extract.registry_rows(extract.table_cells(df)).orderBy("row_pos", "value_pos").collect()
    assert [(r.id, r.sl_no, r.crop_name, r.year, r.variety_count, r.state, r.variety_name) for r in rows] == [
        (7, "1", "RICE", "2015", "3", "Punjab", "PR-124"), (7, "1", "RICE", "2015", "3", "Punjab", "PR-126"),
        (7, "1", "RICE", "2015", "3", "Punjab", "IR 64"), (7, "4", "WHEAT", "", "", "", "HD 3226")]


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, " a ", None, " x ")], "id int, crop_name string, other string, note string")
    out = columns.fill_marker(columns.title_named(columns.trim_strings(df)), ["other", "absent"]).first()
    assert out[:] == (1, "A", "Unknown", "x")
    assert columns.missing_paths(df, ["crop_name", "a.b"]) == ["a.b"]
    with pytest.raises(ValueError):
        columns.pick_column(df, ["x"])
    nested = df.select(F.struct("crop_name").alias("o"))
    assert columns.project_paths(nested, {"n": ["o.absent", "o.crop_name"], "m": "o.absent"}).first()[:] == (" a ", "Unknown")
