"""Array files read in byte ranges, against a plain parse, wherever the borders of the ranges fall."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from cropweave.sources import json_arrays as J
from cropweave.sources import readers

SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("t", T.StringType())])


def awkward(rng, i):
    piece = lambda: rng.choice(['"', "\\", "\\\\", ",", "[", "]", "{", "}", "},{", '\\"', "é", "😀", " ", "\n", "x", "]}"])
    text = "".join(piece() for _ in range(rng.randrange(12)))
    return rng.choice([{"n": i, "t": text}, {"n": i, "t": text, "more": [[text], {"a": [1, [2, {"b": text}]]}]}, {"t": None, "n": i}])


def spans_of(path, split):
    """The planned ranges of one file, without Spark."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    files, notes = path.parent / "files.parquet", path.parent / "notes.parquet"
    pq.write_table(pa.Table.from_pylist([{"source_path": str(path), "length": path.stat().st_size}]), files)
    options = {"files": str(files), "split": str(split)}
    names = ("path", "at", "kind", "begin", "odd", "depths", "commas")
    rows = [dict(zip(names, J.summary(s))) for s in J._RangeReader(options).partitions()]
    if rows:
        pq.write_table(pa.Table.from_pylist(rows), notes)
        options["summaries"] = str(notes)
    return J._ElementReader(options).partitions()


@pytest.mark.parametrize("split, chunk", [(1, 3), (2, 1 << 20), (7, 5), (64, 16), (1 << 20, 11)])
def test_every_range_finds_its_elements(tmp_path, monkeypatch, split, chunk):
    monkeypatch.setattr(J, "CHUNK", chunk)
    rng = random.Random(split)
    for case in range(12):
        rows = [awkward(rng, i) for i in range(rng.choice([0, 1, 2, 9]))]
        path = tmp_path / "a.json"
        path.write_text(rng.choice(["", " \n"]) + json.dumps(rows, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5) + rng.choice(["", "\n "]), encoding="utf-8")
        found = sorted(e for s in spans_of(path, split) for e in J.elements(s))
        assert [(p, k) for p, _, k in found] == [(i, "element") for i in range(len(rows))]
        assert [json.loads(t) for _, t, _ in found] == rows


def test_quotes_and_escapes_across_chunks():
    text = b'a\\"b"\\\\"c\\\\\\"d"'
    data = np.frombuffer(text, np.uint8)
    whole, after = J.real_quotes(data, False)
    assert whole.tolist() == [4, 7, 14] and not after
    for cut in range(len(text) + 1):
        left, escaped = J.real_quotes(data[:cut], False)
        right, last = J.real_quotes(data[cut:], escaped)
        assert [*left, *(right + cut)] == whole.tolist() and last == after


def both(spark, path, split):
    good, bad = readers.read_json_documents(spark, str(path), SCHEMA, split=split)
    return (sorted((r.source_path[-8:], r.source_pos, r.n, r.t) for r in good.collect()),
            sorted((r.source_path[-8:], -1 if r.source_pos is None else r.source_pos, r.reason) for r in bad.collect()))


def test_equal_to_reading_files_whole(spark, tmp_path):
    rng = random.Random(9)
    (tmp_path / "in").mkdir()
    for k in range(4):
        rows = [awkward(rng, i) if rng.random() < 0.9 else rng.choice([1, [2], None, {"n": "x", "t": "y"}]) for i in range(200)]
        (tmp_path / "in" / f"f{k}.json").write_text(json.dumps(rows), encoding="utf-8")
    (tmp_path / "in" / "g0.json").write_text('{"n": 5, "t": "one, [two]"}')
    (tmp_path / "in" / "g1.json").write_text('"only text, that is longer than a range"')
    (tmp_path / "in" / "g2.json").write_text("")
    (tmp_path / "in" / "g3.json").write_text('{"n": "x", "t": "object with a field of another type"}')
    want = both(spark, tmp_path / "in", None)
    assert len(want[0]) > 600 and len(want[1]) > 20
    for split in (97, 1_000, 1 << 20):
        assert both(spark, tmp_path / "in", split) == want


def test_broken_elements_do_not_take_the_file_with_them(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in {"a": '[{"n": 1, "t": "a"}, {"n": 2 "t"}, {"n": 3, "t": "c"},]', "b": '[{"n": 1, "t": "a"}, {"n": 2, "t',
                       "c": '[{"n": 1, "t": "a"}', "d": '[{"n": 1, "t": "a"}] and more, [1]', "e": "[]", "f": "[", "g": "[ , ]"}.items():
        (tmp_path / "in" / f"{name}.json").write_text(text)
    for split in (5, 1 << 20):
        good, bad = both(spark, tmp_path / "in", split)
        assert [(p[-6], i, n) for p, i, n, _ in good] == [("a", 0, 1), ("a", 2, 3), ("b", 0, 1), ("c", 0, 1), ("d", 0, 1)]
        bad = sorted({(p[-6], i, r) for p, i, r in bad})  # text behind an array may fall into several ranges
        assert bad == [("a", 1, "no valid JSON"), ("a", 3, "no valid JSON"), ("b", 1, "no valid JSON"), ("c", -1, "array is not closed"),
                       ("d", -1, "text behind the array"), ("f", 0, "no valid JSON"), ("g", 0, "no valid JSON"), ("g", 1, "no valid JSON")]


def test_one_large_array_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "large.json"
    with path.open("w") as file:
        file.write("[")
        for i in range(60_000):
            file.write((",\n" if i else "") + json.dumps({"n": i, "t": "x, [y] {z} \\ \" " * 8}))
        file.write("]")
    elements = J.read_elements(spark, [str(path)], split=1 << 19)
    from pyspark.sql import functions as F

    tasks = elements.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
    assert len(tasks) == -(-path.stat().st_size // (1 << 19)) > 10 and max(r.n for r in tasks) < 6_000
    row = elements.agg(F.count("*"), F.count_distinct("source_pos"), F.min("source_pos"), F.max("source_pos")).first()
    assert row[:] == (60_000, 60_000, 0, 59_999)


def test_short_ranges_share_a_task():
    spans = [J.Span("f", at, at + 50_000) for at in range(0, 500_000_000, 50_000)]
    parts = J.dealt(spans, 32)
    assert [s for p in parts for s in p.spans] == spans
    assert 32 <= len(parts) < 110 and max(len(p.spans) for p in parts) > 90
    assert [len(p.spans) for p in J.dealt(spans[:5], 32)] == [1] * 5 and J.dealt([], 32) == []
    long = [J.Span("f", at, at + J.SPLIT) for at in range(0, 10 * J.SPLIT, J.SPLIT)]
    assert [len(p.spans) for p in J.dealt(long, 4)] == [1] * 10


def test_many_small_files_make_few_tasks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(200):
        (tmp_path / "in" / f"f{k:03}.json").write_text(json.dumps([{"n": i, "t": "x" * 40} for i in range(10 * k, 10 * k + 10)]))
    elements = J.read_elements(spark, [str(tmp_path / "in")], split=100)
    from pyspark.sql import functions as F

    tasks = elements.groupBy(F.spark_partition_id()).agg(F.count("*")).count()
    assert 8 <= tasks <= 2 * J.WAVES * 8
    assert elements.agg(F.count("*"), F.sum(F.get_json_object("content", "$.n").cast("long"))).first()[:] == (2_000, 1_999_000)
