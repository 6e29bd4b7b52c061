import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropweave.sources import readers, writers
from cropweave.streaming.refresh import refresh

CSV = '''variety_name,crop_type,year_of_release,stressors_tolerated
"Name,
one",ONION,2022,"[""Drought"", ""Heat wave""]"
Two,RICE,,[]
'''
SCHEMA = T.StructType([T.StructField("variety_name", T.StringType()), T.StructField("crop_type", T.StringType()),
                       T.StructField("year_of_release", T.IntegerType()), T.StructField("stressors_tolerated", T.StringType())])


def test_catalogue_csv(spark, tmp_path):
    (tmp_path / "c.csv").write_text(CSV)
    rows = readers.read_catalogue_csv(spark, str(tmp_path / "c.csv"), SCHEMA).collect()
    assert rows[0][:] == ("Name,\none", "ONION", 2022, ["Drought", "Heat wave"])
    assert rows[1][:] == ("Two", "RICE", None, [])


def test_registry_files_are_numbered_in_order(spark, tmp_path):
    names = [f"n{i}" for i in range(2500)]
    (tmp_path / "a.csv").write_text("name\n" + "\n".join(names[:2000]) + "\n")
    (tmp_path / "b.csv").write_text("name\n" + "\n".join(names[2000:]) + "\n")
    schema = T.StructType([T.StructField("name", T.StringType())])
    df = readers.with_source_position(readers.read_registry_csv(spark, [str(tmp_path / "b.csv"), str(tmp_path / "a.csv")], schema))
    assert [r.name for r in df.orderBy("src_pos").collect()] == names
    assert df.agg(F.min("src_pos"), F.max("src_pos")).first()[:] == (0, 2499)


def test_final_falls_back(spark, tmp_path):
    (tmp_path / "c.csv").write_text(CSV)
    assert readers.read_final(spark, "no_such_table", str(tmp_path / "c.csv"), SCHEMA).count() == 2
    empty = readers.read_final(spark, "no_such_table", str(tmp_path / "none.csv"), SCHEMA)
    assert empty.count() == 0 and empty.schema["stressors_tolerated"].dataType == T.ArrayType(T.StringType())


def test_json_documents_and_quarantine(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"n": 1}, {"n": 2}], indent=1))
    (tmp_path / "b.json").write_text('[{"n": 3')
    (tmp_path / "c.json").write_text('{"n": 4}')
    good, bad = readers.read_json_documents(spark, f"{tmp_path}/*.json", T.StructType([T.StructField("n", T.IntegerType())]))
    assert sorted((r.n, r.source_pos, r.source_path[-6:]) for r in good.collect()) == [
        (1, 0, "a.json"), (2, 1, "a.json"), (4, 0, "c.json")]
    assert [(r.source_path.rsplit("/", 1)[1], r.reason) for r in bad.collect()] == [("b.json", "no valid JSON")]


def test_every_json_element_goes_somewhere(spark, tmp_path):
    for name, text in {"a": '[1, {"n": 1}]', "b": '[[{"n": 2}]]', "c": '[{"n": "x"}, {"n": null}, {"z": 1}, null]', "d": '"text"', "e": " "}.items():
        (tmp_path / f"{name}.json").write_text(text)
    good, bad = readers.read_json_documents(spark, f"{tmp_path}/*.json", T.StructType([T.StructField("n", T.IntegerType())]))
    assert sorted((r.source_path[-6], r.source_pos, r.n) for r in good.collect()) == [("a", 1, 1), ("c", 1, None), ("c", 2, None)]
    assert sorted((r.source_path[-6], -1 if r.source_pos is None else r.source_pos, r.reason) for r in bad.collect()) == [
        ("a", 0, "element is no object"), ("b", 0, "element is no object"), ("c", 0, "field of another type"),
        ("c", 3, "element is no object"), ("d", -1, "neither object nor array"), ("e", -1, "no valid JSON")]


def test_document_listing(spark, tmp_path):
    for name, size in (("b.PDF", 10), ("a.pdf", 2000), ("c.txt", 5)):
        (tmp_path / name).write_bytes(b"x" * size)
    files = readers.list_documents(spark, str(tmp_path), limit_bytes=1000)
    assert [(r.file_name, r.length, r.oversize) for r in files.collect()] == [("a.pdf", 2000, True), ("b.PDF", 10, False)]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('say "hi", ok', ["a", 'b"c']), (None, [])], "variety_name string, stressors_tolerated array<string>")
    writers.write_csv(df, str(tmp_path / "out"), quote_all=True)
    schema = T.StructType([SCHEMA["variety_name"], SCHEMA["stressors_tolerated"]])
    back = readers.read_catalogue_csv(spark, str(tmp_path / "out"), schema)
    assert {(r[0], tuple(r[1])) for r in back.collect()} == {('say "hi", ok', ("a", 'b"c')), (None, ())}


def test_versions_replace_only_themselves(spark, tmp_path):
    path = str(tmp_path / "v")
    writers.write_version(spark.range(3), path, "r1")
    writers.write_version(spark.range(5), path, "r2")
    writers.write_version(spark.range(4), path, "r1")
    assert {(r.run_ts, r["count"]) for r in spark.read.parquet(path).groupBy("run_ts").count().collect()} == {("r1", 4), ("r2", 5)}


def test_refresh_processes_each_document_once(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = T.StructType([T.StructField("doc", T.StringType()), T.StructField("text", T.StringType())])

    def go():
        refresh(spark, folder, schema, str(tmp_path / "manifest"), str(tmp_path / "cp"), ["doc"],
                lambda df: df.write.mode("append").parquet(out), str(tmp_path / "aside")).awaitTermination(120)
        return sorted(r.doc for r in spark.read.schema(schema).parquet(out).collect())

    spark.createDataFrame([("a", "1"), ("b", "2")], schema).write.mode("append").parquet(folder)
    assert go() == ["a", "b"]
    spark.createDataFrame([("b", "again"), ("c", "3"), ("c", "3"), ("c", "4"), (None, "5")], schema).write.mode("append").parquet(folder)
    assert go() == ["a", "b", "c"]
    assert spark.read.parquet(str(tmp_path / "manifest")).agg(F.count("*")).first()[0] == 3
    aside = spark.read.parquet(str(tmp_path / "aside")).collect()
    assert sorted((r.doc or "", r.reason) for r in aside) == [("", "null in the key"), ("c", "key shared with another row")]


def test_schema_document(spark):
    rows = writers.schema_document(spark.range(1), {"id": "the id"}).collect()
    assert [r[:] for r in rows] == [("id", "bigint", "the id")]
