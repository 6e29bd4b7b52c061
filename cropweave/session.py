"""Session settings and staged tables shared by the whole package."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "cropweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator here is planned for.

    ``master`` is only for tests and benches; on a cluster it comes from spark-submit.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SCOPES: list[list[str]] = []


@contextmanager
def collected_stages() -> Iterator[list[str]]:
    """The folders that ``stage_table`` writes inside the block, to be removed once nothing reads them any more."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield made
    finally:
        del _SCOPES[[scope is made for scope in _SCOPES].index(True)]


def remove_stages(folders: list[str]) -> None:
    """Remove staged tables; those in a store that Arrow does not know stay, as do those already gone."""
    for folder in folders:
        try:
            store, path = fs.FileSystem.from_uri(folder)
            store.delete_dir(path)
        except (OSError, ValueError):
            continue


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local session without it gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="cropweave-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stage_table(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For frames several later steps need: they read only the columns they use, and a lost executor costs a re-read
    and not a re-run. The files stay until ``remove_stages`` or until the folder is cleaned.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/stage-{uuid.uuid4().hex}"
    for scope in _SCOPES:
        scope.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
