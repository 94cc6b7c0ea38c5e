"""Phase 2: clean shards -> corpus (near-dup, contamination, exact-dup removal)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import config as C
from tessera.functions.text import approx_tokens
from tessera.operators import decontam as DC
from tessera.operators import dedup as DD
from tessera.plans.reports import PHASE2_REASONS, TOTAL

KEY = ["source", "shard", "pos"]


def build_corpus(docs: DataFrame, benchmarks: list[DataFrame], cfg: C.DedupConfig = C.DedupConfig(),
                 exact_scope: str = "shard", sigs: DataFrame | None = None) -> DataFrame:
    """``docs(source, shard, pos, text, near_dup, decontaminate)`` -> same keys + ``reason``, ``text``.

    Reasons, first match wins: near_dup (only near-dup sources), contaminated
    (only decontaminated sources), exact_dup (a copy seen earlier in the shard),
    kept. Equal normal forms share near-dup and contamination status, so
    "seen earlier among kept" is "not the first copy". All flags are computed on
    narrow key tables and joined on the unique document key.
    """
    near = DD.near_duplicates(docs.where("near_dup").select(*KEY, "text"), "text", cfg, sigs)
    grams = DC.contamination_grams(DC.benchmark_sets(benchmarks), cfg.decontam_ngram)
    hit = DC.contaminated_keys(docs.where("decontaminate"), grams, KEY, "text", cfg.decontam_ngram) \
        .withColumn("_contam", F.lit(True))
    ex = DD.exact_firsts(docs, exact_scope).select(*KEY, "is_first")
    flags = (ex.join(near.where("near_dup").select(*KEY, F.lit(True).alias("_near")), KEY, "left")
             .join(hit, KEY, "left"))
    reason = (F.when(F.col("_near").isNotNull(), "near_dup")
              .when(F.col("_contam").isNotNull(), "contaminated")
              .when(~F.col("is_first"), "exact_dup").otherwise("kept"))
    flags = flags.select(*KEY, reason.alias("reason"))
    return docs.select(*KEY, "text").join(flags, KEY)


def corpus_rows(built: DataFrame) -> DataFrame:
    """The corpus itself: kept rows only."""
    return built.where(F.col("reason") == "kept").select(*KEY, "text")


def phase2_report(built: DataFrame) -> DataFrame:
    """Per source + TOTAL: kept, est_tokens (truncated per shard, summed), drop counts."""
    kept = F.col("reason") == "kept"
    per_shard = built.groupBy("source", "shard").agg(
        F.sum(kept.cast("int")).alias("kept"),
        F.sum(F.when(kept, F.length("text")).otherwise(0)).alias("chars"),
        *[F.sum((F.col("reason") == r).cast("int")).alias(r) for r in PHASE2_REASONS if r != "kept"],
    ).withColumn("est_tokens", approx_tokens(F.col("chars")))
    cols = ("kept", "est_tokens", "near_dup", "exact_dup", "contaminated")
    return (per_shard.rollup("source").agg(*[F.sum(c).cast("bigint").alias(c) for c in cols],
                                           F.grouping("source").alias("_g"))
            .select(F.when(F.col("_g") == 1, F.lit(TOTAL)).otherwise(F.col("source")).alias("source"), *cols))
