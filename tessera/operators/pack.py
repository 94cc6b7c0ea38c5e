"""Token packing into fixed windows, train/val split, token index.

Order-dependent running sums use a two-level prefix sum so no group (a whole
source or shard) is ever sorted in one task: totals per order bucket, running
sum over the (small) bucket table, running sum inside each bucket. Windows are
cut from per-document spans, so nothing explodes to one row per token; each
window group holds at most ``seq_len`` tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import config as C
from tessera.session import written


def prefix_sum(df: DataFrame, group: list[str], order: list[str], value: Column, bucket: Column,
               out: str = "offset") -> DataFrame:
    """Exclusive running sum of ``value`` within ``group`` in ``order``.

    ``bucket`` must be non-decreasing in ``order`` inside a group (e.g. a
    position divided by a bucket width); every window below holds one bucket.
    """
    d = df.withColumn("_v", value).withColumn("_b", bucket)
    tot = d.groupBy(*group, "_b").agg(F.sum("_v").alias("_bt"))
    # the bucket table is small (one row per bucket); with no group it is one window
    wb = (Window.partitionBy(*group) if group else Window).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.withColumn("_bo", F.coalesce(F.sum("_bt").over(wb), F.lit(0))).drop("_bt")
    wi = Window.partitionBy(*group, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (d.join(tot, group + ["_b"])
            .withColumn(out, (F.col("_bo") + F.coalesce(F.sum("_v").over(wi), F.lit(0))).cast("bigint"))
            .drop("_v", "_b", "_bo"))


def line_index(docs: DataFrame, bucket_rows: int = 1 << 20) -> DataFrame:
    """0-based line number of each document inside its corpus shard (source, shard) in pos order."""
    key = ["source", "shard", "pos"]
    idx = prefix_sum(docs.select(*key), ["source", "shard"], ["pos"], F.lit(1), F.floor(F.col("pos") / bucket_rows), "line_idx")
    return docs.join(idx, key)


def tok_shards(docs: DataFrame, n_shards: Column) -> DataFrame:
    """Modulo tokenisation shard of each corpus line (``line_idx % n``)."""
    return docs.withColumn("tok_shard", F.pmod(F.col("line_idx"), n_shards).cast("int"))


def pack_windows(docs: DataFrame, ids_col: str = "ids", seq_len: int = C.SEQ_LEN, eos_id: int = 1,
                 val_every: int = C.VAL_EVERY_N_WINDOWS, bucket_rows: int = 1 << 16) -> DataFrame:
    """``docs(source, tok_shard, shard, line_idx, ids)`` -> ``windows(source, tok_shard, window_id, split, ids)``.

    Per tokenisation shard, documents in (shard, line_idx) order, each followed
    by EOS, are concatenated and cut every ``seq_len`` tokens; the tail is
    dropped; window ``w`` goes to validation when ``w % val_every == 0``.
    """
    L = seq_len
    d = docs.select("source", "tok_shard", "shard", "line_idx",
                    F.concat(F.col(ids_col), F.array(F.lit(eos_id))).alias("_ids"))
    # written once: the encoder runs once, and offsets are summed over narrow rows
    d = written(d.withColumn("_n", F.size("_ids").cast("bigint")))
    key = ["source", "tok_shard", "shard", "line_idx"]
    starts = prefix_sum(d.select(*key, "_n"), ["source", "tok_shard"], ["shard", "line_idx"], F.col("_n"),
                        F.col("shard").cast("bigint") * F.lit(1 << 40) + F.floor(F.col("line_idx") / bucket_rows), "_s")
    d = d.join(starts.drop("_n"), key)
    spans = d.select("source", "tok_shard", "_ids", "_s", "_n",
                     F.explode(F.sequence(F.floor(F.col("_s") / L), F.floor((F.col("_s") + F.col("_n") - 1) / L)))
                     .alias("window_id"))
    st = F.greatest(F.col("_s"), F.col("window_id") * L)
    en = F.least(F.col("_s") + F.col("_n"), (F.col("window_id") + 1) * L)
    parts = spans.select("source", "tok_shard", "window_id", st.alias("_st"),
                         F.slice("_ids", (st - F.col("_s") + 1).cast("int"), (en - st).cast("int")).alias("_part"))
    win = (parts.groupBy("source", "tok_shard", "window_id")
           .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_st", "_part"))), lambda x: x["_part"]))
                .alias("ids")))
    return win.where(F.size("ids") == L).select(
        "source", "tok_shard", "window_id",
        F.when(F.col("window_id") % val_every == 0, F.lit("val")).otherwise(F.lit("train")).alias("split"), "ids")


def token_index(windows: DataFrame, seq_len: int = C.SEQ_LEN) -> DataFrame:
    """Per (source, tok_shard) window and token counts by split, plus a TOTAL row
    (one aggregate over grouping sets)."""
    is_val = F.col("split") == "val"
    g = windows.groupingSets([["source", "tok_shard"], []], "source", "tok_shard").agg(
        F.sum((~is_val).cast("int")).cast("bigint").alias("train_windows"),
        F.sum(is_val.cast("int")).cast("bigint").alias("val_windows"),
        F.grouping("source").alias("_g"))
    return g.select(F.when(F.col("_g") == 1, F.lit("TOTAL")).otherwise(F.col("source")).alias("source"),
                    "tok_shard", "train_windows", "val_windows",
                    (F.col("train_windows") * seq_len).alias("train_tokens"),
                    (F.col("val_windows") * seq_len).alias("val_tokens"))
