"""Scans of the input tables with explicit schemas, and the fixture adapter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import config as C
from tessera.functions.text import coerce_text

SCHEMAS = {
    "documents": T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType())]),
    "benchmark": T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())]),
    "labels": T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
        T.StructField("toxic", T.IntegerType())]),
    "conversations": T.StructType([
        T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]),
    "pages": T.StructType([
        T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType())]),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, factor: int = 2) -> DataFrame:
    """Round-robin the rows over ``factor x`` the cores when the scan yields fewer
    splits than cores (a small single-file table). At cluster scale the scan has
    far more splits than cores and this is a no-op: no shuffle of the text."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores * factor)


def fixture_shard(doc_id, n_shards: int = C.FIXTURE_SHARDS):
    return F.pmod(F.floor(doc_id / F.lit(C.FIXTURE_N_SOURCES)), F.lit(n_shards)).cast("int")


def raw_docs(documents: DataFrame, n_shards: int = C.FIXTURE_SHARDS) -> DataFrame:
    """Fixture adapter: the record identity (source, shard, pos) of a raw record.

    On real shards ``pos`` is ``_metadata.row_index`` and ``shard`` the file's rank;
    here ``pos = doc_id`` and ``shard = pmod(doc_id div 20, n_shards)``: independent of the
    fixture's source, which is ``doc_id mod 20``.
    """
    return spread(documents).select(
        "source",
        fixture_shard(F.col("doc_id"), n_shards).alias("shard"),
        F.col("doc_id").alias("pos"),
        coerce_text(F.col("text")).alias("text"))


def raw_records_from_files(spark: SparkSession, paths: list[str], source: str, text_field: str,
                           schema: T.StructType | None = None) -> DataFrame:
    """Raw shard files of one source: identity from the file name and row index.

    ``shard`` is the rank of the file path in sorted order (the manifest order);
    ``pos`` is the row index inside the file, so order-dependent operators see the
    same order as a sequential reader.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(*paths).select(coerce_text(F.col(text_field)).alias("text"),
                                       F.col("_metadata.file_path").alias("path"),
                                       F.col("_metadata.row_index").alias("pos"))
    # one row per file (bounded by the file count): rank in path order, broadcast equi-join
    files = df.select("path").distinct()
    ranks = files.withColumn("shard", (F.row_number().over(Window.orderBy("path")) - 1).cast("int"))
    return df.join(F.broadcast(ranks), "path").select(F.lit(source).alias("source"), "shard", "pos", "text")
