"""Readers. Every reader takes an explicit schema, so no source is scanned twice to infer one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropweave.functions.jsonio import is_json_object, parse_string_array
from cropweave.operators.ordering import with_position
from cropweave.session import stage_table
from cropweave.sources.json_arrays import SPLIT, read_elements

OVERSIZE_BYTES = 20 * 1024 * 1024
ARRAY_COLUMNS = ("stressors_tolerated", "quality_traits", "genetic_markers", "parent_lines", "adaptation_zones",
                 "recommended_states", "agro_climatic_zones", "special_features", "data_sources")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a scan out to all cores when it has fewer files than cores; else leave it alone.

    For costly per-row work on a table stored in few row groups. A large table has more files than cores, so it is never
    shuffled by this. Only the plan changes.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def with_source_position(rows: DataFrame, column: str = "src_pos") -> DataFrame:
    """Number the rows of a file read by file and place in the file (0-based), for registries without an order of their own.

    Use it directly on a reader's result. The rows are stored once, so that all later steps see the same numbers.
    """
    placed = rows.withColumn("source_path", F.input_file_name()).withColumn("_line", F.monotonically_increasing_id())
    return with_position(stage_table(placed), ["source_path", "_line"], column).drop("_line")


def read_registry_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV files with header; quotes are doubled inside quoted cells and cells may hold line breaks."""
    return (spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", True).csv(path))


def read_catalogue_csv(spark: SparkSession, path: str, schema: T.StructType,
                       arrays: Sequence[str] = ARRAY_COLUMNS) -> DataFrame:
    """Published catalogue CSV with its JSON array cells parsed."""
    df = read_registry_csv(spark, path, schema)
    return df.select(*[parse_string_array(c).alias(c) if c in arrays else F.col(c) for c in df.columns])


def read_json_documents(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
                        split: int | None = SPLIT) -> tuple[DataFrame, DataFrame]:
    """(documents, quarantine) from files that hold one JSON document or an array of them.

    Documents carry ``source_path`` and ``source_pos``, the place of the element in its array. The quarantine (source_path,
    source_pos, content, reason) takes what is no document: array elements that are no valid JSON or no objects, objects
    with a field of another type than the schema's, and, with ``source_pos`` null, whole files that are neither object nor
    array, text behind the end of an array, and a note on an array that ends without its bracket after a whole element. A
    file of no bytes has nothing to report.

    Arrays are read in ranges of ``split`` bytes by many tasks, from stores that Arrow knows. With ``split=None`` Spark's own
    reader takes each file whole, from any store; a file that is not valid from end to end is then refused as a whole.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if split is None:
        files = spark.read.text(paths, wholetext=True).select(
            F.input_file_name().alias("source_path"), F.col("value").alias("content"), F.lit("file").alias("kind"))
        rows = files.withColumn("_json", F.try_parse_json("content"))
        many = F.coalesce(F.schema_of_variant("_json").startswith("ARRAY"), F.lit(False))
        elements = F.when(many, F.expr("try_variant_get(_json, '$', 'array<variant>')")).otherwise(F.array("_json"))
        each = rows.select("source_path", F.when(many, "element").otherwise(F.col("kind")).alias("kind"), F.col("content").alias("_whole"),
                           F.posexplode(elements).alias("source_pos", "_json"))
        each = each.select("source_path", F.when(F.col("kind") == "element", F.col("source_pos")).cast("long").alias("source_pos"),
                           F.when(F.col("kind") == "element", F.to_json("_json")).otherwise(F.col("_whole")).alias("content"),
                           "kind", "_json")
    else:
        each = read_elements(spark, paths, split).withColumn("_json", F.try_parse_json("content"))
    is_object = is_json_object(F.col("_json"))
    typed = each.select("source_path", "source_pos", "content", "kind", "_json", is_object.alias("_object"),
                        F.when(is_object, F.from_json(F.to_json("_json"), schema)).alias("document"),
                        F.expr("try_variant_get(_json, '$', 'map<string, variant>')").alias("_fields"))
    lost = F.lit(False)
    for field in schema.fieldNames():
        given = F.col("_fields")[field]
        lost = lost | F.coalesce(F.col("document")[field].isNull() & given.isNotNull() & ~F.is_variant_null(given), F.lit(False))
    whole = F.col("kind") == "file"
    reason = (F.when(F.col("kind") == "behind", "text behind the array").when(F.col("_json").isNull(), "no valid JSON")
              .when(whole & ~F.col("_object"), "neither object nor array").when(~F.col("_object"), "element is no object")
              .when(lost, "field of another type"))
    judged = typed.withColumn("reason", reason)
    # a file that is one object stands at place 0; one that is none has no place
    refused = judged.where(F.col("reason").isNotNull()).select(
        "source_path", F.when(whole & F.col("_object"), 0).otherwise(F.col("source_pos")).cast("long").alias("source_pos"), "content", "reason")
    unclosed = judged.where((F.col("kind") == "cut") & F.col("_json").isNotNull()).select(
        "source_path", F.lit(None).cast("long").alias("source_pos"), F.lit(None).cast("string").alias("content"),
        F.lit("array is not closed").alias("reason"))
    documents = judged.where(F.col("reason").isNull()).select(
        "document.*", "source_path", F.coalesce("source_pos", F.lit(0)).cast("long").alias("source_pos"))
    return documents, refused.unionByName(unclosed)


def read_final(spark: SparkSession, table: str | None, csv_path: str | None, schema: T.StructType) -> DataFrame:
    """The published catalogue: the table when it exists, else the CSV, else an empty frame."""
    if table and spark.catalog.tableExists(table):
        return spark.table(table)
    if csv_path:
        try:
            return read_catalogue_csv(spark, csv_path, schema)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    arrays = [T.StructField(f.name, T.ArrayType(T.StringType())) if f.name in ARRAY_COLUMNS else f for f in schema.fields]
    return spark.createDataFrame([], T.StructType(arrays))


def list_documents(spark: SparkSession, folder: str, suffix: str = "pdf", limit_bytes: int = OVERSIZE_BYTES) -> DataFrame:
    """Documents of a folder by case-insensitive suffix, in order of their names: path, length, time, oversize flag.

    File contents are never read: the content column is pruned.
    """
    glob = "*." + "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in suffix)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return (files.select("path", "length", "modificationTime")
            .withColumn("file_name", F.element_at(F.split("path", "/"), -1))
            .withColumn("oversize", F.col("length") > limit_bytes).orderBy("file_name", "path"))
