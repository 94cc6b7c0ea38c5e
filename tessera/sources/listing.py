"""Shard files by a listing: which files to read is settled before any text is.

A manifest is a table (source, config, split, path), read from a file or made from the file system's own listing of
``<root>/source=<s>/config=<c>/split=<p>/.../*.parquet``. ``registry.shard_plan`` picks from it by configuration and split,
keeps the first files of a source, or one source only. ``scan`` then opens the chosen files alone, with the one text column;
a record's position is its row in the file, so order-dependent steps see what a sequential reader would.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import coerce_text

MANIFEST = "source string, config string, split string, path string"


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, length) of all files below ``root``: file metadata, contents are not opened."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
            .load(root).select("path", "length"))


def manifest_of(files: DataFrame) -> DataFrame:
    """The manifest rows that the files' folders name; files outside the layout are left out."""
    part = lambda name: F.regexp_extract("path", f"/{name}=([^/]+)/", 1)
    cols = {name: part(name) for name in ("source", "config", "split")}
    return (files.select(*[c.alias(n) for n, c in cols.items()], "path")
            .where("source <> '' AND config <> '' AND split <> ''"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest file: JSON lines, CSV with a header, or Parquet."""
    if path.endswith((".json", ".jsonl")):
        return spark.read.schema(MANIFEST).json(path)
    if path.endswith(".csv"):
        return spark.read.schema(MANIFEST).option("header", True).csv(path)
    return spark.read.parquet(path).select("source", "config", "split", "path")


def with_shards(manifest: DataFrame) -> DataFrame:
    """``manifest`` with ``shard``: the rank of a file among its source's, by path (a row a file)."""
    from pyspark.sql import Window
    rank = F.row_number().over(Window.partitionBy("source").orderBy("path")) - 1
    return manifest.withColumn("shard", rank.cast("int"))


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as ``_metadata.file_path`` gives it: with its scheme, encoded; one slash before a path without a host."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toUri().toString()
    return re.sub("^([a-z0-9]+):///", r"\1:/", uri)


def scan(spark: SparkSession, plan: DataFrame, registry: DataFrame) -> DataFrame:
    """(source, shard, pos, text) of the records of the plan's files (source, shard, path); a missing or null text is empty.

    The driver holds the chosen paths: a row a file, as Spark's own file index does."""
    chosen = plan.join(registry.select(F.col("name").alias("source"), "text_field"), "source") \
        .select("source", "shard", "path", "text_field").collect()
    empty = spark.createDataFrame([], "source string, shard int, pos bigint, text string")
    out = None
    for field in sorted({r.text_field for r in chosen}):
        mine = [r for r in chosen if r.text_field == field]
        names = spark.createDataFrame([(_qualified(spark, r.path), r.source, r.shard) for r in mine],
                                      "path string, source string, shard int")
        rows = (spark.read.schema(f"`{field}` string").option("recursiveFileLookup", True).parquet(*[r.path for r in mine])
                .select(F.regexp_replace("_metadata.file_path", "^([a-z0-9]+):///", "$1:/").alias("path"), F.col("_metadata.row_index").alias("pos"),
                        coerce_text(F.col(field)).alias("text"))
                # bounded by the chosen files, which Spark lists on the driver anyway
                .join(F.broadcast(names), "path").select("source", "shard", "pos", "text"))
        out = rows if out is None else out.unionByName(rows)
    return empty if out is None else out


def write_shards(raw: DataFrame, registry: DataFrame, root: str) -> None:
    """``raw`` (source, shard, pos, text) as shard files in the listing's layout, records in order of ``pos``."""
    pol = registry.select(F.col("name").alias("source"), F.coalesce("config_name", F.lit("default")).alias("config"), "split")
    rows = raw.join(pol, "source").withColumn("part", F.format_string("%05d", F.col("shard")))
    # the folders' columns first: the writer then keeps this order and does not sort again
    (rows.repartition("source", "shard").sortWithinPartitions("source", "config", "split", "part", "pos")
     .select("text", "source", "config", "split", "part")
     .write.mode("overwrite").partitionBy("source", "config", "split", "part").parquet(root))
