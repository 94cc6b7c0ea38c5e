"""Phase reports: per-shard tallies, per-source merge with a grand total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import approx_tokens

TOTAL = "TOTAL"
PHASE1_REASONS = ("too_short", "repetitive", "non_english", "ocr")
PHASE2_REASONS = ("near_dup", "exact_dup", "contaminated", "kept")


def drop_report(clean: DataFrame) -> DataFrame:
    """Documents per (source, reason) plus a TOTAL row per reason: one aggregate
    over grouping sets, so the chain below is computed once."""
    g = clean.groupingSets([["source", "reason"], ["reason"]], "source", "reason") \
        .agg(F.count(F.lit(1)).alias("docs"), F.grouping("source").alias("_g"))
    return g.select(F.when(F.col("_g") == 1, F.lit(TOTAL)).otherwise(F.col("source")).alias("source"),
                    "reason", "docs")


def shard_stats(clean: DataFrame) -> DataFrame:
    """streamed / kept / clean chars / truncated token estimate per (source, shard)."""
    kept = F.col("kept")
    return clean.groupBy("source", "shard").agg(
        F.count(F.lit(1)).alias("streamed"),
        F.sum(F.when(kept, 1).otherwise(0)).cast("bigint").alias("kept"),
        F.sum(F.when(kept, F.col("clean_chars")).otherwise(0)).cast("bigint").alias("clean_chars"),
    ).withColumn("est_tokens", approx_tokens(F.col("clean_chars")))


def phase1_report(clean: DataFrame) -> DataFrame:
    """Per source + TOTAL: streamed, kept, est_tokens (truncated per shard, then summed),
    one count column per drop reason (zeros included)."""
    per_shard = clean.groupBy("source", "shard").agg(
        F.count(F.lit(1)).alias("streamed"),
        F.sum(F.when(F.col("kept"), 1).otherwise(0)).alias("kept"),
        F.sum(F.when(F.col("kept"), F.col("clean_chars")).otherwise(0)).alias("chars"),
        *[F.sum(F.when(F.col("reason") == r, 1).otherwise(0)).alias(r) for r in PHASE1_REASONS],
    ).withColumn("est_tokens", approx_tokens(F.col("chars")))
    sums = [F.sum(c).cast("bigint").alias(c) for c in ("streamed", "kept", "est_tokens", *PHASE1_REASONS)]
    return (per_shard.rollup("source").agg(*sums, F.grouping("source").alias("_g"))
            .select(F.when(F.col("_g") == 1, F.lit(TOTAL)).otherwise(F.col("source")).alias("source"),
                    "streamed", "kept", "est_tokens", *PHASE1_REASONS))


# --- nested documents -------------------------------------------------------------------------------------------

def merge_counts(rows: DataFrame, key: str, reasons: tuple[str, ...]) -> DataFrame:
    """(key, counts): the maps ``counts`` of each key's rows added up, reasons in the given order first, zeros included."""
    each = rows.select(key, F.explode("counts").alias("reason", "n")).groupBy(key, "reason").agg(F.sum("n").alias("n"))
    held = each.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("reason", "n"))).alias("_m"))
    order = F.array_union(F.array(*map(F.lit, reasons)), F.array_sort(F.map_keys("_m")))
    return held.select(key, F.map_from_entries(F.transform(order, lambda r: F.struct(
        r, F.coalesce(F.element_at("_m", r), F.lit(0).cast("bigint"))))).alias("counts"))


def document(rows: DataFrame, key: str, *body: str) -> DataFrame:
    """One row ``value``: a JSON object with a member a row, named and ordered by ``key`` (few rows: sources, shards)."""
    by_name = lambda x, y: F.when(x["k"] < y["k"], -1).when(x["k"] > y["k"], 1).otherwise(0)
    members = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.struct(*body).alias("v"))), by_name)
    return rows.agg(F.to_json(F.map_from_entries(members)).alias("value"))


PHASE2_SCHEMA = "map<string, struct<kept: bigint, est_tokens: bigint, reasons: map<string, bigint>>>"


def phase2_document(built: DataFrame) -> DataFrame:
    """The phase-2 report as one document: kept, est_tokens (truncated per shard, summed) and a reasons map of each source."""
    kept = F.col("reason") == "kept"
    tallies = built.groupBy("source", "shard", "reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(kept, F.length("text")).otherwise(0)).alias("chars"))
    shards = tallies.groupBy("source", "shard").agg(
        F.map_from_entries(F.collect_list(F.struct("reason", "n"))).alias("counts"), F.sum("chars").alias("chars"))
    sums = shards.groupBy("source").agg(
        F.sum(F.coalesce(F.element_at("counts", F.lit("kept")), F.lit(0))).cast("bigint").alias("kept"),
        F.sum(approx_tokens(F.col("chars"))).cast("bigint").alias("est_tokens"))
    merged = merge_counts(shards, "source", PHASE2_REASONS).withColumnRenamed("counts", "reasons")
    return document(sums.join(merged, "source"), "source", "kept", "est_tokens", "reasons")


def read_document(text: DataFrame, schema: str) -> DataFrame:
    """The members of a document's map as rows (name, and its fields), in its order."""
    doc = text.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("d"))
    return doc.select(F.posexplode("d").alias("position", "name", "v")).select("position", "name", "v.*")


INDEX_SCHEMA = ("struct<seq_len: int, dtype: string, train_windows: bigint, val_windows: bigint, train_tokens: bigint, val_tokens: bigint, "
                "shards: array<struct<source: string, shard: int, train_windows: bigint, val_windows: bigint, train_tokens: bigint, "
                "val_tokens: bigint>>>")


def index_document(index: DataFrame, seq_len: int, dtype: str = "uint16") -> DataFrame:
    """The token index (with its TOTAL row) as one document: the totals, and the shards inside in order."""
    sums = ["train_windows", "val_windows", "train_tokens", "val_tokens"]
    total = F.col("source") == TOTAL
    shard = F.when(~total, F.struct("source", F.col("tok_shard").alias("shard"), *sums))
    return index.agg(F.to_json(F.struct(
        F.lit(seq_len).alias("seq_len"), F.lit(dtype).alias("dtype"), *[F.coalesce(F.max(F.when(total, F.col(c))), F.lit(0)).alias(c) for c in sums],
        F.array_sort(F.collect_list(shard)).alias("shards"))).alias("value"))


PERPLEXITY_SCHEMA = "map<string, struct<val_loss: double, perplexity: double, windows: bigint>>"


def perplexity_document(rollup: DataFrame) -> DataFrame:
    """The per-source losses as one document in order of the sources, TOTAL among them."""
    return document(rollup, "source", "val_loss", "perplexity", "windows")
