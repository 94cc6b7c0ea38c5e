"""Data side of training and evaluation: epoch plan and loss/perplexity roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera import config as C


def dense_position(df: DataFrame, key: F.Column, tie: list[str], bucket_chars: int = 4) -> DataFrame:
    """0-based position of each row in ``key`` order without a global sort.

    ``key`` is a hex digest; its first ``bucket_chars`` characters form an
    order-preserving bucket: rows per bucket -> running total over the bucket
    table -> row number inside the bucket.
    """
    d = df.withColumn("_k", key).withColumn("_b", F.substring("_k", 1, bucket_chars))
    cnt = d.groupBy("_b").agg(F.count(F.lit(1)).alias("_c"))
    wb = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # bucket table: <= 16^bucket_chars rows
    cnt = cnt.withColumn("_o", F.coalesce(F.sum("_c").over(wb), F.lit(0))).drop("_c")
    wi = Window.partitionBy("_b").orderBy("_k", *tie)
    return (d.join(F.broadcast(cnt), "_b")
            .withColumn("global_pos", (F.col("_o") + F.row_number().over(wi) - 1).cast("bigint"))
            .drop("_k", "_b", "_o"))


def epoch_plan(windows: DataFrame, world_size: int = 8, per_gpu_windows: int = 64, micro_batch: int = 32,
               seed: int = C.TRAIN_SEED, max_steps: int = 0, start_step: int = 0,
               global_windows: int | None = None) -> DataFrame:
    """Assign every training window a (rank, step, micro) slot.

    Deterministic global shuffle by an md5 order key, strided round-robin over
    ranks, ``per_gpu_windows`` per rank and step, micro-batches of
    ``micro_batch``; incomplete steps dropped; optional ``max_steps`` and resume
    from ``start_step``. One epoch (positions never wrap).
    """
    micro = min(micro_batch, per_gpu_windows)
    accum = max(1, per_gpu_windows // micro)
    per_gpu = micro * accum
    # steps follow the global batch that was asked for, also where the ranks cannot share it out evenly
    global_batch = global_windows or world_size * per_gpu_windows
    train = windows.where(F.col("split") == "train").select("source", "tok_shard", "window_id")
    key = F.md5(F.concat_ws("/", F.col("source"), F.col("tok_shard").cast("string"),
                            F.col("window_id").cast("string"), F.lit(str(seed))))
    pos = dense_position(train, key, ["source", "tok_shard", "window_id"])
    n = pos.count()  # one scalar to the driver
    steps = n // global_batch
    if max_steps > 0:
        steps = min(steps, max_steps)
    rank_pos = F.floor(F.col("global_pos") / world_size)
    plan = pos.select(
        "source", "tok_shard", "window_id", "global_pos",
        F.pmod(F.col("global_pos"), F.lit(world_size)).cast("int").alias("rank"),
        rank_pos.cast("bigint").alias("rank_pos"),
        F.floor(rank_pos / per_gpu).cast("bigint").alias("step"),
        F.floor(F.pmod(rank_pos, F.lit(per_gpu)) / micro).cast("int").alias("micro"))
    return plan.where((F.col("step") < steps) & (F.col("step") >= start_step))


def gather_windows(plan: DataFrame, windows: DataFrame) -> DataFrame:
    """Token rows by position: each planned slot with the ids of its window (one equi-join on the window's key)."""
    key = ["source", "tok_shard", "window_id"]
    return plan.select("rank", "step", "micro", "rank_pos", *key).join(windows.select(*key, "ids"), key)


def eval_window_plan(windows: DataFrame, world_size: int = 8, n_windows: int = C.EVAL_WINDOWS,
                     bucket_windows: int = 1 << 16) -> DataFrame:
    """Validation windows read by the in-training check: the flat validation index
    (files in (source, tok_shard) order, windows in order) strided over ranks, the
    first ``n_windows`` per rank. Dense index via counts per range of ``bucket_windows`` windows of a file -> running
    total over the ranges -> row number inside a range, so a file's windows lie on many tasks."""
    from tessera.operators.pack import prefix_sum

    val = windows.where(F.col("split") == "val").select("source", "tok_shard", "window_id")
    bucket = F.struct("source", "tok_shard", F.floor(F.col("window_id") / bucket_windows).alias("range"))
    g = prefix_sum(val, [], ["window_id"], F.lit(1), bucket, "global_idx")
    return (g.select("source", "tok_shard", "window_id", "global_idx",
                     F.pmod(F.col("global_idx"), F.lit(world_size)).cast("int").alias("rank"),
                     F.floor(F.col("global_idx") / world_size).cast("bigint").alias("slot"))
            .where(F.col("slot") < n_windows))


def training_check(losses: DataFrame, plan: DataFrame, world_size: int = 8, micro_batch: int = C.MICRO_BATCH,
                   digits: int = 9) -> DataFrame:
    """The in-training validation loss: (rank, windows, batches, loss) per rank, and overall with a NULL rank.

    A rank's loss is the mean over its micro-batches of their mean window loss, 0.0 without windows; the overall loss is the
    mean over ranks. So a short last batch weighs as much as a full one, unlike in ``perplexity_rollup``.
    """
    key = ["source", "tok_shard", "window_id"]
    batches = (plan.join(losses, key).groupBy("rank", F.floor(F.col("slot") / micro_batch).alias("batch"))
               .agg(F.avg("loss").alias("loss"), F.count(F.lit(1)).alias("windows")))
    ranks = batches.groupBy("rank").agg(F.avg("loss").alias("loss"), F.count(F.lit(1)).alias("batches"),
                                        F.sum("windows").alias("windows"))
    every = plan.sparkSession.range(world_size).select(F.col("id").cast("int").alias("rank")).join(ranks, "rank", "left").select(
        "rank", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("windows", "batches")], F.coalesce("loss", F.lit(0.0)).alias("loss"))
    return every.rollup("rank").agg(F.sum("windows").alias("windows"), F.sum("batches").alias("batches"),
                                    F.round(F.avg("loss"), digits).alias("loss"))


def unigram_losses(windows: DataFrame, vocab_size: int) -> DataFrame:
    """Add-one-smoothed unigram model fitted on train windows; mean -log p per val window.

    The count table has at most ``vocab_size`` rows, so it is broadcast.
    """
    train = windows.where(F.col("split") == "train").select(F.explode("ids").alias("id"))
    counts = train.groupBy("id").agg(F.count(F.lit(1)).alias("c"))
    n_train = windows.where(F.col("split") == "train").agg(F.sum(F.size("ids")).alias("N")).first()["N"] or 0
    val = windows.where(F.col("split") == "val").select("source", "tok_shard", "window_id", F.explode("ids").alias("id"))
    scored = (val.join(F.broadcast(counts), "id", "left")
              .withColumn("nll", -F.log((F.coalesce(F.col("c"), F.lit(0)) + 1) / F.lit(float(n_train + vocab_size)))))
    return scored.groupBy("source", "tok_shard", "window_id").agg(F.avg("nll").alias("loss"))


def perplexity_rollup(losses: DataFrame, digits: int = 9) -> DataFrame:
    """Per source and overall: windows, window-weighted mean loss, perplexity = e^loss."""
    per = losses.rollup("source").agg(F.count(F.lit(1)).alias("windows"), F.sum("loss").alias("_s"),
                                      F.grouping("source").alias("_g"))
    mean = F.col("_s") / F.col("windows")
    return per.select(F.when(F.col("_g") == 1, F.lit("TOTAL")).otherwise(F.col("source")).alias("source"),
                      "windows", F.round(mean, digits).alias("val_loss"), F.round(F.exp(mean), digits - 3).alias("perplexity"))
