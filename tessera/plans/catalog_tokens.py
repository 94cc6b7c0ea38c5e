"""Registered queries of the tokeniser / packing / training-plan phase.

All run with the values of ``config``. Packing, split, index, epoch plan and the perplexity roll-up are checked in SQL with
a word-id tokeniser (``id = 7 + md5(word) mod (V - 7)``) that SQL can replay; the same operators run on BPE ids in
``pack_windows_bpe``. A step takes 512 windows, which small tables do not have: ``epoch_plan_small`` and
``epoch_gather_small`` are the same queries with smaller windows and steps.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import config as C
from tessera.operators import bpe as B
from tessera.operators import evalplan as EP
from tessera.operators import pack as P
from tessera.plans import oracle as Q
from tessera.plans import reports as REP
from tessera.plans.catalog_dedup import _ALL as CORPUS_SQL
from tessera.plans.inputs import Inputs
from tessera.session import checkpoint_dir, written
from tessera.sources import registry as R
from tessera.sources import windows as WF
from tessera.sources.tables import read_table

V = C.VOCAB_SIZE
WORLD = 8


@dataclass(frozen=True)
class Sizes:
    seq_len: int = C.SEQ_LEN
    val_every: int = C.VAL_EVERY_N_WINDOWS
    per_gpu: int = C.GLOBAL_BATCH_TOKENS // C.SEQ_LEN // WORLD
    micro: int = C.MICRO_BATCH


FULL = Sizes()
SMALL = Sizes(C.SMALL_SEQ_LEN, C.SMALL_VAL_EVERY, C.SMALL_GLOBAL_WINDOWS // WORLD, C.SMALL_MICRO_BATCH)


def word_ids(text, vocab: int = V):
    return F.transform(F.split(text, " "), lambda w: (
        F.conv(F.substring(F.md5(F.encode(w, "UTF-8")), 1, 6), 16, 10).cast("bigint") % F.lit(vocab - len(B.SPECIALS))
        + F.lit(len(B.SPECIALS))).cast("int"))


def _lines(i: Inputs, corpus: DataFrame | None = None) -> DataFrame:
    """Corpus lines with their line index and tokenisation shard."""
    c = P.line_index(i.corpus() if corpus is None else corpus)
    c = R.attach_policy(c, i.registry, ("token_shards",))
    return P.tok_shards(c, F.col("token_shards")).drop("token_shards")


def _merge_table(spark: SparkSession, d: str, retrain: bool = False, corpus: DataFrame | None = None) -> DataFrame:
    """The tokeniser model of this input, as the pipeline's tokenizer phase leaves it: a table in the shared folder, named by
    what it was trained from (files, their sizes and times, vocabulary) and read by the encode and pack queries. ``corpus``: the
    input's corpus, of a caller that has it."""
    names = ("documents", "labels", "benchmark")
    each = [read_table(spark, d, t).select(F.concat_ws("|", "_metadata.file_path", F.col("_metadata.file_size").cast("string"),
                                                       F.col("_metadata.file_modification_time").cast("string")).alias("f")) for t in names]
    files = reduce(DataFrame.union, each).distinct()
    name = files.agg(F.md5(F.array_join(F.array_sort(F.collect_list("f")), ","))).first()[0]
    path = f"{checkpoint_dir(spark).rstrip('/')}/merges-{V}-{name}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if retrain or not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        merges = B.train_bpe(B.pretoken_counts(corpus if corpus is not None else Inputs(spark, d).corpus()), V)
        B.merges_df(spark, merges).coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _merges(spark: SparkSession, d: str, corpus: DataFrame | None = None) -> B.Merges:
    return B.load_merges(_merge_table(spark, d, corpus=corpus))


def q_pretoken_counts(spark: SparkSession, d: str) -> DataFrame:
    return B.pretoken_counts(Inputs(spark, d).corpus())


def q_bpe_train(spark: SparkSession, d: str) -> DataFrame:
    return _merge_table(spark, d, retrain=True)


def q_vocab_layout(spark: SparkSession, d: str) -> DataFrame:
    return B.vocab_df(spark, _merges(spark, d))


def _encoded(spark: SparkSession, d: str) -> tuple[DataFrame, B.Merges]:
    corpus = Inputs(spark, d).corpus()
    m = _merges(spark, d, corpus)
    return corpus.withColumn("ids", B.encode_column(F.col("text"), m)), m


def q_bpe_encode(spark: SparkSession, d: str) -> DataFrame:
    enc, _ = _encoded(spark, d)
    return enc.select("source", "shard", "pos", "ids", F.size("ids").alias("n_tokens"))


def q_bpe_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    enc, m = _encoded(spark, d)
    return enc.select("source", "shard", "pos", (F.trim(B.decode_column(F.col("ids"), m)) == F.col("text")).alias("roundtrip"))


def q_token_stats(spark: SparkSession, d: str) -> DataFrame:
    enc, _ = _encoded(spark, d)
    return enc.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.size("ids")).cast("bigint").alias("tokens"),
                                     F.sum(F.length("text")).cast("bigint").alias("chars")) \
        .withColumn("chars_per_token", F.col("chars") / F.col("tokens"))


def q_tok_sharding(spark: SparkSession, d: str) -> DataFrame:
    return _lines(Inputs(spark, d)).select("source", "shard", "pos", "line_idx", "tok_shard")


def _windows(spark: SparkSession, d: str, sizes: Sizes = FULL) -> DataFrame:
    lines = _lines(Inputs(spark, d)).withColumn("ids", word_ids(F.col("text")))
    return P.pack_windows(lines, "ids", sizes.seq_len, B.EOS_ID, sizes.val_every)


def _written_windows(spark: SparkSession, d: str, sizes: Sizes = FULL) -> DataFrame:
    """The windows as a written table, for queries that read them more than once."""
    return written(_windows(spark, d, sizes))


def q_pack_windows(spark: SparkSession, d: str) -> DataFrame:
    return _windows(spark, d)


def q_train_val_split(spark: SparkSession, d: str) -> DataFrame:
    return _windows(spark, d).select("source", "tok_shard", "window_id", "split")


def q_token_index(spark: SparkSession, d: str) -> DataFrame:
    return P.token_index(_windows(spark, d), FULL.seq_len)


def q_pack_windows_bpe(spark: SparkSession, d: str) -> DataFrame:
    i = Inputs(spark, d)
    corpus = i.corpus()
    m = _merges(spark, d, corpus)
    lines = _lines(i, corpus)
    lines = lines.withColumn("ids", B.encode_column(F.col("text"), m))
    return P.pack_windows(lines, "ids", FULL.seq_len, B.EOS_ID, FULL.val_every)


def _epoch_plan(windows: DataFrame, sizes: Sizes) -> DataFrame:
    return EP.epoch_plan(windows, WORLD, sizes.per_gpu, sizes.micro)


def q_epoch_plan(spark: SparkSession, d: str, sizes: Sizes = FULL) -> DataFrame:
    return _epoch_plan(_written_windows(spark, d, sizes), sizes)


def q_epoch_gather(spark: SparkSession, d: str, sizes: Sizes = FULL) -> DataFrame:
    """The token rows that each rank reads, step by step: the plan joined to the windows it names."""
    windows = _written_windows(spark, d, sizes)
    return EP.gather_windows(_epoch_plan(windows, sizes), windows)


def q_epoch_plan_small(spark: SparkSession, d: str) -> DataFrame:
    return q_epoch_plan(spark, d, SMALL)


def q_epoch_gather_small(spark: SparkSession, d: str) -> DataFrame:
    return q_epoch_gather(spark, d, SMALL)


def _window_files(spark: SparkSession, d: str, sizes: Sizes) -> str:
    """A folder with this input's windows as fixed-width files."""
    path = f"{WF.mounted(checkpoint_dir(spark)).rstrip('/')}/windows-{uuid.uuid4().hex}"
    WF.write_windows(_windows(spark, d, sizes), path, sizes.seq_len, sizes.val_every)
    return path


def q_window_files(spark: SparkSession, d: str) -> DataFrame:
    """The windows written as fixed-width files and read back."""
    return WF.read_table(spark, _window_files(spark, d, FULL)).select("source", "tok_shard", "window_id", "split", "ids")


def q_epoch_gather_files(spark: SparkSession, d: str) -> DataFrame:
    """``epoch_gather_small`` with each planned window read from its place in the files."""
    path = _window_files(spark, d, SMALL)
    plan = written(_epoch_plan(WF.read_table(spark, path, "train").drop("ids"), SMALL))
    return WF.fetch(plan.select("rank", "step", "micro", "rank_pos", "source", "tok_shard", "window_id"), path)


def q_perplexity_rollup(spark: SparkSession, d: str) -> DataFrame:
    return EP.perplexity_rollup(EP.unigram_losses(_written_windows(spark, d), V))


def q_training_check(spark: SparkSession, d: str, sizes: Sizes = FULL) -> DataFrame:
    """The in-training validation loss of the unigram model."""
    windows = _written_windows(spark, d, sizes)
    return EP.training_check(EP.unigram_losses(windows, V), EP.eval_window_plan(windows, WORLD, C.EVAL_WINDOWS), WORLD, sizes.micro)


def q_training_check_small(spark: SparkSession, d: str) -> DataFrame:
    return q_training_check(spark, d, SMALL)


def q_index_document(spark: SparkSession, d: str) -> DataFrame:
    """The token index written as one JSON document and read back: its shards in their order."""
    text = written(REP.index_document(P.token_index(_windows(spark, d), FULL.seq_len), FULL.seq_len))
    doc = text.select(F.from_json("value", REP.INDEX_SCHEMA, {"mode": "FAILFAST"}).alias("d"))
    return doc.select(F.posexplode("d.shards").alias("position", "s")).select("position", "s.*")


def q_eval_windows(spark: SparkSession, d: str) -> DataFrame:
    return EP.eval_window_plan(_written_windows(spark, d), WORLD, C.EVAL_WINDOWS)


QUERIES = {
    "epoch_gather": q_epoch_gather,
    "eval_windows": q_eval_windows,
    "pretoken_counts": q_pretoken_counts,
    "bpe_train": q_bpe_train,
    "vocab_layout": q_vocab_layout,
    "bpe_encode": q_bpe_encode,
    "bpe_roundtrip": q_bpe_roundtrip,
    "token_stats": q_token_stats,
    "tok_sharding": q_tok_sharding,
    "pack_windows": q_pack_windows,
    "train_val_split": q_train_val_split,
    "token_index": q_token_index,
    "pack_windows_bpe": q_pack_windows_bpe,
    "epoch_plan": q_epoch_plan,
    "training_check": q_training_check,
    "training_check_small": q_training_check_small,
    "index_document": q_index_document,
    "window_files": q_window_files,
    "epoch_gather_files": q_epoch_gather_files,
    "epoch_plan_small": q_epoch_plan_small,
    "epoch_gather_small": q_epoch_gather_small,
    "perplexity_rollup": q_perplexity_rollup,
}

# ----------------------------------------------------------------------------
# Oracle SQL
# ----------------------------------------------------------------------------

# Corpus text is white-space normalised (single spaces), so the look-ahead
# alternative of the pretokeniser never applies and RE2 can run the rest.
RE2_PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"

def _lines_sql(sizes: Sizes) -> str:
    L, VAL_EVERY = sizes.seq_len, sizes.val_every
    return CORPUS_SQL + f""",
corp AS (SELECT source, shard, pos, text FROM reasons WHERE reason = 'kept'),
lines AS (SELECT source, shard, pos, text, row_number() OVER (PARTITION BY source, shard ORDER BY pos) - 1 AS line_idx,
                 CAST((row_number() OVER (PARTITION BY source, shard ORDER BY pos) - 1) % {Q.policy_case('token_shards')}
                      AS INTEGER) AS tok_shard
          FROM corp),
tl AS (SELECT source, tok_shard, shard, line_idx,
              list_append(list_transform(string_split(text, ' '),
                  lambda w: CAST(CAST(('0x' || substr(md5(w), 1, 6)) AS BIGINT) % {V - len(B.SPECIALS)} + {len(B.SPECIALS)} AS INTEGER)),
                  CAST({B.EOS_ID} AS INTEGER)) AS ids
       FROM lines),
sp AS (SELECT tl.*, len(ids) AS n,
              CAST(coalesce(sum(len(ids)) OVER (PARTITION BY source, tok_shard ORDER BY shard, line_idx
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s FROM tl),
pc AS (SELECT source, tok_shard, s, n, ids, unnest(range(s // {L}, (s + n - 1) // {L} + 1)) AS w FROM sp),
pt AS (SELECT source, tok_shard, w, greatest(s, w * {L}) AS st,
              ids[greatest(s, w * {L}) - s + 1 : least(s + n, (w + 1) * {L}) - s] AS part FROM pc),
win AS (SELECT source, tok_shard, CAST(w AS BIGINT) AS window_id,
               CASE WHEN w % {VAL_EVERY} = 0 THEN 'val' ELSE 'train' END AS split,
               flatten(list(part ORDER BY st)) AS ids
        FROM pt GROUP BY source, tok_shard, w HAVING len(flatten(list(part ORDER BY st))) = {L})"""


def _plan_sql(sizes: Sizes) -> str:
    return _lines_sql(sizes) + f""",
tw AS (SELECT source, tok_shard, window_id,
              md5(concat_ws('/', source, CAST(tok_shard AS VARCHAR), CAST(window_id AS VARCHAR), '{C.TRAIN_SEED}')) AS k
       FROM win WHERE split = 'train'),
gp AS (SELECT source, tok_shard, window_id, row_number() OVER (ORDER BY k, source, tok_shard, window_id) - 1 AS global_pos
       FROM tw),
pl AS (SELECT source, tok_shard, window_id, CAST(global_pos AS BIGINT) AS global_pos,
              CAST(global_pos % {WORLD} AS INTEGER) AS rank, CAST(global_pos // {WORLD} AS BIGINT) AS rank_pos,
              CAST((global_pos // {WORLD}) // {sizes.per_gpu} AS BIGINT) AS step,
              CAST(((global_pos // {WORLD}) % {sizes.per_gpu}) // {sizes.micro} AS INTEGER) AS micro
       FROM gp)
SELECT * FROM pl WHERE step < (SELECT count(*) FROM tw) // {WORLD * sizes.per_gpu}"""


LINES, L = _lines_sql(FULL), FULL.seq_len

_LOSSES = f""",
tr AS (SELECT unnest(ids) AS id FROM win WHERE split = 'train'),
cnt AS (SELECT id, count(*) AS c FROM tr GROUP BY id),
va AS (SELECT source, tok_shard, window_id, unnest(ids) AS id FROM win WHERE split = 'val'),
wl AS (SELECT source, tok_shard, window_id,
              avg(-ln((coalesce(cnt.c, 0) + 1) / CAST((SELECT count(*) FROM tr) + {V} AS DOUBLE))) AS loss
       FROM va LEFT JOIN cnt ON va.id = cnt.id GROUP BY source, tok_shard, window_id)"""

SQL = {
    "pretoken_counts": CORPUS_SQL + f"""
SELECT pretoken, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(text, {Q.lit(RE2_PRETOKEN)})) AS pretoken FROM reasons WHERE reason = 'kept')
GROUP BY pretoken""",
    "tok_sharding": LINES + "\nSELECT source, shard, pos, line_idx, tok_shard FROM lines",
    "pack_windows": LINES + "\nSELECT source, tok_shard, window_id, split, ids FROM win",
    "train_val_split": LINES + "\nSELECT source, tok_shard, window_id, split FROM win",
    "token_index": LINES + f""",
per AS (SELECT source, tok_shard, CAST(sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS BIGINT) AS train_windows,
               CAST(sum(CASE WHEN split = 'val' THEN 1 ELSE 0 END) AS BIGINT) AS val_windows FROM win GROUP BY ALL)
SELECT source, tok_shard, train_windows, val_windows, train_windows * {L} AS train_tokens, val_windows * {L} AS val_tokens
FROM per
UNION ALL
SELECT 'TOTAL', NULL, CAST(sum(train_windows) AS BIGINT), CAST(sum(val_windows) AS BIGINT),
       CAST(sum(train_windows) * {L} AS BIGINT), CAST(sum(val_windows) * {L} AS BIGINT) FROM per""",
    "epoch_plan": _plan_sql(FULL),
    "epoch_plan_small": _plan_sql(SMALL),
    "perplexity_rollup": LINES + _LOSSES + f"""
SELECT coalesce(source, 'TOTAL') AS source, count(*) AS windows, round(sum(loss) / count(*), 9) AS val_loss,
       round(exp(sum(loss) / count(*)), 6) AS perplexity
FROM wl GROUP BY ROLLUP (source)""",
}

SQL["eval_windows"] = LINES + f""",
vw AS (SELECT source, tok_shard, window_id,
              CAST(row_number() OVER (ORDER BY source, tok_shard, window_id) - 1 AS BIGINT) AS global_idx
       FROM win WHERE split = 'val')
SELECT source, tok_shard, window_id, global_idx, CAST(global_idx % {WORLD} AS INTEGER) AS rank,
       CAST(global_idx // {WORLD} AS BIGINT) AS slot
FROM vw WHERE global_idx // {WORLD} < {C.EVAL_WINDOWS}"""
_PLAN_END = "SELECT * FROM pl WHERE step < (SELECT count(*) FROM tw)"
for _name in ("epoch_plan", "epoch_plan_small"):
    SQL[_name.replace("plan", "gather")] = SQL[_name].replace(
        _PLAN_END, "SELECT pl.rank, pl.step, pl.micro, pl.rank_pos, pl.source, pl.tok_shard, pl.window_id, win.ids "
        "FROM pl JOIN win USING (source, tok_shard, window_id) WHERE step < (SELECT count(*) FROM tw)")
SQL["window_files"] = SQL["pack_windows"]
SQL["epoch_gather_files"] = SQL["epoch_gather_small"]
SQL["index_document"] = SQL["token_index"].rsplit("UNION ALL", 1)[0].replace(
    "SELECT source, tok_shard, train_windows, val_windows,",
    "SELECT CAST(row_number() OVER (ORDER BY source, tok_shard) - 1 AS INTEGER) AS position, source, tok_shard AS shard, train_windows, val_windows,")
for _name, _sizes in (("training_check", FULL), ("training_check_small", SMALL)):
    SQL[_name] = _lines_sql(_sizes) + _LOSSES + f""",
vw AS (SELECT loss, row_number() OVER (ORDER BY source, tok_shard, window_id) - 1 AS g FROM wl),
bt AS (SELECT g % {WORLD} AS rank, (g // {WORLD}) // {_sizes.micro} AS batch, avg(loss) AS loss, count(*) AS windows
       FROM vw WHERE g // {WORLD} < {C.EVAL_WINDOWS} GROUP BY 1, 2),
per_rank AS (SELECT r AS rank, coalesce(sum(windows), 0) AS windows, count(batch) AS batches, coalesce(avg(loss), 0.0) AS loss
       FROM range({WORLD}) t(r) LEFT JOIN bt ON bt.rank = r GROUP BY r)
SELECT CAST(rank AS INTEGER) AS rank, CAST(sum(windows) AS BIGINT) AS windows, CAST(sum(batches) AS BIGINT) AS batches, round(avg(loss), 9) AS loss
FROM per_rank GROUP BY ROLLUP (rank)"""
