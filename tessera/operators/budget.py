"""Per-shard token budget: stop right after the kept row whose running clean-char
total reaches the cap (that row is still written; later rows are not streamed).

The order-dependent running sum is computed on narrow rows only and reduced to
one cutoff position per shard, which is broadcast back (its size is the number
of shards). The text never moves. The prefix sum is two-level so that a shard
of any size is never sorted in one task: bucket totals -> running sum over the
buckets -> exact search inside the single bucket that crosses the cap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera import config as C

SHARD_KEY = ["source", "shard"]


def budget_cutoffs(clean: DataFrame, caps: DataFrame, bucket_size: int = 1 << 20) -> DataFrame:
    """``clean(source, shard, pos, kept, clean_chars)``, ``caps(source, shard, per_shard_cap)``
    -> ``(source, shard, cutoff_pos)`` for shards whose cap is reached."""
    cap_ok = lambda chars: (chars / F.lit(C.CHARS_PER_TOKEN)) >= F.col("per_shard_cap")
    kept = (clean.where(F.col("kept"))
            .select(*SHARD_KEY, "pos", "clean_chars", F.floor(F.col("pos") / bucket_size).alias("bucket")))
    buckets = kept.groupBy(*SHARD_KEY, "bucket").agg(F.sum("clean_chars").alias("chars"))
    w = Window.partitionBy(*SHARD_KEY).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (buckets.withColumn("before", F.coalesce(F.sum("chars").over(w), F.lit(0)))
               .join(F.broadcast(caps.select(*SHARD_KEY, "per_shard_cap")), SHARD_KEY))
    crossing = (buckets.where(cap_ok(F.col("before") + F.col("chars")))
                .groupBy(*SHARD_KEY).agg(F.min(F.struct("bucket", "before", "per_shard_cap")).alias("c"))
                .select(*SHARD_KEY, "c.bucket", "c.before", "c.per_shard_cap"))
    # one crossing bucket per shard: bounded by the number of shards
    inside = kept.join(F.broadcast(crossing), SHARD_KEY + ["bucket"])
    wi = Window.partitionBy(*SHARD_KEY).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("run", F.col("before") + F.sum("clean_chars").over(wi))
    return inside.where(cap_ok(F.col("run"))).groupBy(*SHARD_KEY).agg(F.min("pos").alias("cutoff_pos"))


def apply_budget(clean: DataFrame, caps: DataFrame, bucket_size: int = 1 << 20) -> DataFrame:
    """Rows streamed under the budget: ``pos <= cutoff_pos`` (all rows if never reached)."""
    cut = budget_cutoffs(clean, caps, bucket_size)
    return (clean.join(F.broadcast(cut), SHARD_KEY, "left")
            .where(F.col("cutoff_pos").isNull() | (F.col("pos") <= F.col("cutoff_pos")))
            .drop("cutoff_pos"))
