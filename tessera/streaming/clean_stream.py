"""Structured Streaming twin of the clean phase.

raw files -> clean table -> drop counters, first copies. The clean table is written by the same
``clean_documents`` transform as in batch (every gate, the OCR gate included) on a file-source stream; the two
other queries read that table as a stream. Each has its own checkpoint, so a restarted query resumes exactly once.

* Counters: an update-mode aggregate. Each micro-batch writes the totals it changed under its batch id; a
  replayed batch overwrites its own folder, and a reader takes each key's latest total.
* First copies: state per (source, shard, hash) keeps the smallest position seen. Files come in any order, so a copy
  that turns out not to be the first is taken back: the output is a log of +1 / -1 changes, whose sum equals the
  batch operator's result after any prefix of the input.

The budget cap and packing stay batch-only: they need all earlier documents of a shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera import config as C
from tessera.operators.clean import clean_documents
from tessera.sources.tables import SCHEMAS, fixture_shard


def raw_stream(spark: SparkSession, directory: str, file_glob: str = "documents*.parquet",
               n_shards: int = C.FIXTURE_SHARDS, max_files_per_trigger: int | None = None) -> DataFrame:
    """Documents files of a directory read as a stream (fixture adapter applied). What ``file_glob`` matches may be files or
    folders of part files."""
    r = spark.readStream.schema(SCHEMAS["documents"])
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    # in braces, so that a plain name is a pattern too: Spark takes a plain path to be a folder
    docs = r.parquet(f"{directory.rstrip('/')}/{{{file_glob}}}")
    return docs.select("source", fixture_shard(F.col("doc_id"), n_shards).alias("shard"),
                       F.col("doc_id").alias("pos"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def clean_stream(raw: DataFrame, registry: DataFrame | None = None, dictionary: DataFrame | None = None,
                 cfg: C.CleanConfig = C.CleanConfig()) -> DataFrame:
    """Streaming clean: the batch transform on a streaming DataFrame."""
    if registry is not None:
        pol = registry.select(F.col("name").alias("source"), "strict_ocr")
        raw = raw.join(F.broadcast(pol), "source")
        return clean_documents(raw, dictionary, "strict_ocr", cfg)
    return clean_documents(raw, None, None, cfg)


def start_clean_sink(cleaned: DataFrame, out_path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    w = (cleaned.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def table_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table that another query appends to, read as a stream."""
    return spark.readStream.schema(schema).parquet(path)


# --- drop counters ----------------------------------------------------------------------------------------------

COUNTERS = "source string, reason string, docs bigint, batch_id bigint"

#: Batches between snapshots of all totals.
SNAPSHOT_EVERY = 64


def drop_counters(cleaned: DataFrame) -> DataFrame:
    """Running documents per (source, reason)."""
    return cleaned.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("docs"))


def read_counters(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """(source, reason, docs): each key's total of its latest batch (of those under ``before``); no rows before the first batch."""
    if not _batches(spark, path)[1]:
        return spark.createDataFrame([], "source string, reason string, docs bigint")
    rows = spark.read.schema(COUNTERS).parquet(path)
    if before is not None:
        rows = rows.where(F.col("batch_id") < before)
    return rows.groupBy("source", "reason").agg(F.max_by("docs", "batch_id").alias("docs"))


def _batches(spark: SparkSession, path: str):
    """(Hadoop file system, {batch id: its folder})."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in fs.listStatus(root)] if fs.exists(root) else []
    return fs, {int(p.getName().split("=")[1]): p for p in found if p.getName().startswith("batch_id=")}


def upsert_counters(path: str, snapshot_every: int = SNAPSHOT_EVERY):
    """A ``foreachBatch`` function: writes the changed totals of a batch as the folder of its id.

    Every ``snapshot_every``-th batch writes all totals; the batch after it drops the folders these replace, when
    the snapshot can no longer be replayed. So the table stays small and no step depends on being run once.
    """
    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fs, held = _batches(spark, path)
        rows = batch.select("source", "reason", F.col("docs").cast("bigint").alias("docs"))
        if batch_id % snapshot_every == snapshot_every - 1 and any(k < batch_id for k in held):
            old = read_counters(spark, path, batch_id).withColumn("new", F.lit(0))
            both = old.unionByName(rows.withColumn("new", F.lit(1)))
            rows = both.groupBy("source", "reason").agg(F.max_by("docs", "new").alias("docs"))
        # a shuffle, so that the state's partitions are not one task's
        rows.repartition(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        snapshots = [k for k in held if k < batch_id and k % snapshot_every == snapshot_every - 1]
        for k, folder in held.items():
            if snapshots and k < max(snapshots):
                fs.delete(folder, True)

    return keep


def start_counters(cleaned: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                   snapshot_every: int = SNAPSHOT_EVERY) -> StreamingQuery:
    w = (drop_counters(cleaned).writeStream.outputMode("update").foreachBatch(upsert_counters(path, snapshot_every))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


# --- first copies -----------------------------------------------------------------------------------------------

CHANGES = "source string, shard int, exact_hash string, pos bigint, change int"


def first_copy_changes(cleaned: DataFrame) -> DataFrame:
    """The kept rows' first copies as changes: +1 for a row that is the first of its (source, shard, hash) so far, -1 for one that
    an earlier position replaces."""
    from tessera.functions.text import exact_hash, flatten_newlines

    rows = cleaned.where("kept").select("source", F.col("shard").cast("int").alias("shard"),
                                        exact_hash(flatten_newlines(F.col("text"))).alias("exact_hash"), "pos")

    def smallest(key, frames, state):
        import pandas as pd
        new = min(int(f["pos"].min()) for f in frames)
        old = state.get[0] if state.exists else None
        if old is None or new < old:
            state.update((new,))
            changes = [(*key, new, 1)] + ([(*key, old, -1)] if old is not None else [])
            yield pd.DataFrame(changes, columns=["source", "shard", "exact_hash", "pos", "change"])

    return rows.groupBy("source", "shard", "exact_hash").applyInPandasWithState(
        smallest, CHANGES, "pos bigint", "append", "NoTimeout")


def start_first_copies(cleaned: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append the changes to a Parquet table. The state holds a number a hash and grows with the different texts, so it is kept in
    RocksDB, on disk."""
    conf, key = cleaned.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key)
    conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        w = (first_copy_changes(cleaned).writeStream.format("parquet").option("path", path)
             .option("checkpointLocation", checkpoint).outputMode("append"))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
        return w.start()
    finally:
        conf.set(key, before)


def first_copies(changes: DataFrame) -> DataFrame:
    """(source, shard, pos) of the rows that are first copies by the changes so far."""
    return changes.groupBy("source", "shard", "pos").agg(F.sum("change").alias("n")).where("n = 1").drop("n")
