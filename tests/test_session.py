from types import SimpleNamespace

import pytest

from cropweave.session import shared_folder, stage_table


def fake(master, conf=None, context=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: conf),
                           sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: context, setCheckpointDir=lambda f: None))


def test_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(fake("yarn"))
    assert shared_folder(fake("yarn", conf="hdfs:///x")) == "hdfs:///x"
    assert shared_folder(fake("yarn", context="hdfs:///y")) == "hdfs:///y"
    assert shared_folder(fake("local[2]")).startswith("/")


def test_staged_table_keeps_rows_and_types(spark):
    df = spark.sql("select 1 a, array('x') b, map('k', named_struct('v', 2.5D)) c, cast(null as string) d")
    staged = stage_table(df)
    assert staged.collect() == df.collect()
    assert [f.dataType.simpleString() for f in staged.schema.fields] == [f.dataType.simpleString() for f in df.schema.fields]
    assert "parquet" in staged._jdf.queryExecution().executedPlan().toString().lower()


def test_collected_stages_are_removed(spark, tmp_path):
    from cropweave.session import collected_stages, remove_stages

    outer = stage_table(spark.range(3))
    with collected_stages() as made:
        inner = stage_table(spark.range(5))
        assert inner.count() == 5
    assert len(made) == 1
    remove_stages([*made, "unknown://x/y", str(tmp_path / "none")])
    with pytest.raises(Exception):
        spark.read.parquet(made[0])
    assert outer.count() == 3
