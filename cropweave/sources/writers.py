"""Writers. Markers such as 'Not Specified' appear only here; frames hold nulls."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, quote_all: bool = False, partition_by: Sequence[str] = ()) -> None:
    """CSV with header; array columns become JSON text."""
    flat = df.select(*[F.to_json(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
                       else F.col(f"`{f.name}`") for f in df.schema.fields])
    writer = flat.write.mode("overwrite").option("header", True).option("quoteAll", quote_all).option("escape", '"')
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


RECORD_BUCKETS = 64


def write_records(records: DataFrame, path: str, document_key: str) -> None:
    """Extraction records, every cell quoted, in RECORD_BUCKETS folders by a hash of the document key.

    The key is a column of the files, and the bucket of a key follows from it, so one document is found by reading one
    folder. Rows are spread by record position too, so one huge document is still written by several tasks.
    """
    bucketed = records.withColumn("bucket", F.pmod(F.xxhash64(document_key), F.lit(RECORD_BUCKETS)).cast("int"))
    spread = bucketed.repartition(F.col("bucket"), F.floor(F.col("record_pos") / 100_000))
    write_csv(spread.sortWithinPartitions("bucket", document_key, "record_pos"), path, quote_all=True, partition_by=["bucket"])


def write_json(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).json(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> DataFrame:
    """Write, then hand back the written table, so later steps read it instead of running the plan again."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_version(df: DataFrame, path: str, run_ts: str) -> None:
    """Add this run as a partition of a versioned export; a rerun replaces only its own version."""
    (df.withColumn("run_ts", F.lit(run_ts)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_ts").parquet(path))


def snapshot(inputs: Mapping[str, DataFrame], path: str) -> None:
    """Store the raw inputs unchanged beside the results."""
    for name, df in inputs.items():
        write_parquet(df, f"{path}/raw_data/{name}")


def schema_document(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Column name, type and description of a published table, as rows."""
    rows = [(f.name, f.dataType.simpleString(), comments.get(f.name, "")) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string, description string")
