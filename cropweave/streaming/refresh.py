"""Process only documents that are new since the last refresh.

The file source keeps its own record of files seen; the manifest additionally skips documents whose key was
finished by any other run, so a document is downloaded or parsed once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cropweave.operators.context import not_yet_done


def refresh(spark: SparkSession, folder: str, schema: T.StructType, manifest: str, checkpoint: str,
            keys: Sequence[str], process: Callable[[DataFrame], None], aside: str) -> StreamingQuery:
    """Start a run over everything waiting in ``folder`` (Parquet); it stops by itself when all is done.

    ``process`` gets the new rows of a batch, one a key, and must be idempotent: a batch interrupted after it and before
    the manifest entry is processed again. Of rows that share a key, that with the smallest hash of all its columns goes
    on, whatever the order of the files; the others, and rows with a null in their key, are added to ``aside`` (Parquet)
    with a ``reason``. Rows equal in all columns are one row.
    """
    keys = list(keys)
    key_schema = T.StructType([schema[k] for k in keys])

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        done = batch.sparkSession.read.schema(key_schema).parquet(manifest)
        whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        waiting = batch.distinct()
        hashed = not_yet_done(waiting.where(whole), done, keys).withColumn("_hash", F.xxhash64(*schema.fieldNames()))
        chosen = hashed.groupBy(*keys).agg(F.min("_hash").alias("_chosen"))
        ranked = hashed.join(chosen, keys).persist()
        fresh = ranked.where(F.col("_hash") == F.col("_chosen")).select(*schema.fieldNames())
        try:
            process(fresh)
            others = ranked.where(F.col("_hash") != F.col("_chosen")).select(
                *schema.fieldNames(), F.lit("key shared with another row").alias("reason"))
            unnamed = waiting.where(~whole).select(*schema.fieldNames(), F.lit("null in the key").alias("reason"))
            others.unionByName(unnamed).write.mode("overwrite").parquet(
                f"{aside}/batch={batch_id}")
            fresh.select(*keys).write.mode("append").parquet(manifest)
        finally:
            ranked.unpersist()

    spark.createDataFrame([], key_schema).write.mode("append").parquet(manifest)
    return (spark.readStream.schema(schema).parquet(folder).writeStream.foreachBatch(one_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
