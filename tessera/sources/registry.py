"""Source registry (policy table), shard manifest and shard plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import config as C

REGISTRY_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("location", T.StringType()),
    T.StructField("token_budget", T.LongType()), T.StructField("text_field", T.StringType()),
    T.StructField("split", T.StringType()), T.StructField("config_name", T.StringType()),
    T.StructField("strict_ocr", T.BooleanType()), T.StructField("near_dup", T.BooleanType()),
    T.StructField("decontaminate", T.BooleanType()), T.StructField("clean_shards", T.IntegerType()),
    T.StructField("token_shards", T.IntegerType()),
])


def registry_df(spark: SparkSession, sources: list[C.Source] | None = None) -> DataFrame:
    """The source registry as a small DataFrame (its size is the length of the list)."""
    sources = C.fixture_registry() if sources is None else sources
    rows = [(s.name, s.location, s.token_budget, s.text_field, s.split, s.config_name, s.strict_ocr,
             s.near_dup, s.decontaminate, s.clean_shards, s.token_shards) for s in sources]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def attach_policy(docs: DataFrame, registry: DataFrame, cols: tuple[str, ...] = ("strict_ocr",)) -> DataFrame:
    """Lookup join doc -> policy. The registry is a hand-written list: bounded, broadcast."""
    pol = registry.select(F.col("name").alias("source"), *cols)
    return docs.join(F.broadcast(pol), "source", "inner")


def fixture_manifest(raw: DataFrame, registry: DataFrame) -> DataFrame:
    """Manifest rows (source, config, split, shard, path) for the fixture shards.

    One row per distinct (source, shard) of the raw records; config/split come
    from the registry so the listing predicate has something to select on.
    """
    shards = raw.select("source", "shard").distinct()
    pol = registry.select(F.col("name").alias("source"),
                          F.coalesce("config_name", F.lit("default")).alias("config"), "split")
    return (shards.join(F.broadcast(pol), "source")
            .select("source", "config", "split", "shard",
                    F.format_string("%s/shard-%03d.parquet", F.col("source"), F.col("shard")).alias("path")))


def shard_plan(manifest: DataFrame, registry: DataFrame, web_shards: int | None = 1,
               web_sources: list[str] | None = None, only: str = "") -> DataFrame:
    """Select shards by (config, split), keep the first k for web-like sources, cap per shard.

    ``per_shard_cap = token_budget // max(1, n_selected_shards)``.
    """
    reg = registry.select(F.col("name").alias("source"), "token_budget", "split",
                          F.coalesce("config_name", F.lit("default")).alias("config"))
    if only:
        reg = reg.filter(F.col("source") == only)
    sel = manifest.join(F.broadcast(reg), ["source", "config", "split"], "inner")
    if web_shards is not None:
        web = F.col("source").isin(web_sources) if web_sources is not None else (F.col("config") != "default")
        rn = F.row_number().over(Window.partitionBy("source").orderBy("path"))
        sel = sel.withColumn("_rn", rn).filter(~web | (F.col("_rn") <= web_shards)).drop("_rn")
    n = F.count(F.lit(1)).over(Window.partitionBy("source"))
    idx = F.row_number().over(Window.partitionBy("source").orderBy("path")) - 1
    return sel.select(
        "source", "shard", "path", idx.cast("int").alias("shard_index"), "token_budget",
        n.alias("n_shards"),
        F.floor(F.col("token_budget") / F.greatest(n, F.lit(1))).cast("bigint").alias("per_shard_cap"))
