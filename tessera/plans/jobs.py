"""Pipeline jobs: each phase reads the previous phase's tables and writes its own.

    python -m tessera.plans.jobs <phase> --input <dir> --out <dir> [options]

Phases: smoke, measure, clean, dedup, tokenizer, tokenize, ocr, eval, plan.
Outputs are Parquet tables partitioned by ``source`` under ``--out`` plus JSON
reports. Intermediate lineage is cut with reliable checkpoints in the
cluster's ``spark.checkpoint.dir``; every write is an atomic job commit, so a
lost executor only re-runs its tasks.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import config as C
from tessera.functions.text import flatten_newlines
from tessera.operators import bpe as B
from tessera.operators import evalplan as EP
from tessera.operators import pack as P
from tessera.operators.budget import apply_budget
from tessera.operators.clean import clean_documents
from tessera.operators.ocr import dictionary_from_words
from tessera.plans import reports as REP
from tessera.plans.corpus import build_corpus, corpus_rows, phase2_report
from tessera.plans.inputs import Inputs
from tessera.session import cut_lineage, get_spark, written
from tessera.sources import listing as LS
from tessera.sources import registry as R
from tessera.sources import windows as WF


def _write(df: DataFrame, path: str, partition: tuple[str, ...] = ("source",)) -> None:
    w = df.write.mode("overwrite")
    if partition:
        w = w.partitionBy(*partition)
    w.parquet(path)


def _report(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def _document(df: DataFrame, path: str) -> None:
    """A one-row JSON document."""
    df.coalesce(1).write.mode("overwrite").text(path)


def run_smoke(spark: SparkSession, inp: str, out: str, n: int = C.SMOKE_N) -> None:
    from tessera.plans.catalog_clean import q_smoke_excerpts, q_smoke_summary
    _report(q_smoke_summary(spark, inp, n), f"{out}/smoke_summary")
    _report(q_smoke_excerpts(spark, inp, n), f"{out}/smoke_excerpts")


def run_measure(spark: SparkSession, inp: str, out: str, n: int = C.MEASURE_N) -> None:
    from tessera.plans.catalog_clean import q_measure_sources
    _report(q_measure_sources(spark, inp, n), f"{out}/measure")


def run_clean(spark: SparkSession, inp: str, out: str, web_shards: int | None = None, only: str = "",
              dictionary: str | None = None) -> None:
    """Phase 1 over a documents table: raw records -> clean_docs (one row per record streamed under the cap) + report."""
    i = Inputs(spark, inp)
    plan = R.shard_plan(R.fixture_manifest(i.raw, i.registry), i.registry, web_shards=web_shards, only=only)
    _clean(i.raw, plan, i.registry, _words(spark, dictionary) if dictionary else i.dictionary, out)


def run_clean_files(spark: SparkSession, manifest: str, out: str, web_shards: int | None = None, only: str = "",
                    dictionary: str | None = None, registry: DataFrame | None = None) -> None:
    """Phase 1 over shard files: those that the manifest names, or, of a folder, its listing; no other file is opened."""
    registry = registry if registry is not None else R.registry_df(spark)
    is_file = manifest.endswith((".json", ".jsonl", ".csv", ".parquet"))
    listed = LS.read_manifest(spark, manifest) if is_file else LS.manifest_of(LS.list_files(spark, manifest))
    plan = written(R.shard_plan(LS.with_shards(listed), registry, web_shards=web_shards, only=only))
    _clean(LS.scan(spark, plan, registry), plan, registry, _words(spark, dictionary) if dictionary else None, out)


def _words(spark: SparkSession, path: str) -> DataFrame:
    return dictionary_from_words(spark.read.text(path))


def _clean(raw: DataFrame, plan: DataFrame, registry: DataFrame, dictionary: DataFrame | None, out: str) -> None:
    """Clean the plan's shards, apply their caps, write clean_docs and the reports."""
    chosen = raw.join(plan.select("source", "shard"), ["source", "shard"], "left_semi")
    clean = cut_lineage(clean_documents(R.attach_policy(chosen, registry), dictionary, "strict_ocr"))
    capped = apply_budget(clean, plan)
    _write(capped.withColumn("text", F.when(F.col("kept"), flatten_newlines(F.col("text"))).otherwise(F.lit(""))),
           f"{out}/clean_docs")
    done = capped.sparkSession.read.schema(capped.schema).parquet(f"{out}/clean_docs")
    _report(REP.phase1_report(done), f"{out}/phase1_report")
    _report(REP.shard_stats(done), f"{out}/shard_stats")


def run_dedup(spark: SparkSession, inp: str, out: str, reuse_signatures: bool = False, benchmarks: str = "") -> None:
    """Phase 2: clean_docs -> signatures (reusable) -> corpus + phase-2 report. ``benchmarks``: Parquet paths, by commas
    (else the input's table)."""
    from tessera.operators.dedup import with_signature
    i = Inputs(spark, inp)
    clean = spark.read.parquet(f"{out}/clean_docs").where("kept").select("source", "shard", "pos", "text")
    docs = R.attach_policy(clean, i.registry, ("near_dup", "decontaminate"))
    if not reuse_signatures:
        _write(with_signature(docs.where("near_dup").select("source", "shard", "pos", "text"), "text")
               .select("source", "shard", "pos", "sig"), f"{out}/signatures")
    sigs = spark.read.parquet(f"{out}/signatures")
    sets = [spark.read.parquet(p) for p in benchmarks.split(",") if p] or [i.table("benchmark")]
    built = cut_lineage(build_corpus(docs, sets, sigs=sigs))
    _write(corpus_rows(built), f"{out}/corpus")
    _report(phase2_report(built), f"{out}/phase2_report")
    _document(REP.phase2_document(built), f"{out}/phase2_document")


def run_tokenizer(spark: SparkSession, out: str, vocab_size: int = C.VOCAB_SIZE) -> None:
    """Phase 3: corpus -> merges + vocab tables."""
    corpus = spark.read.parquet(f"{out}/corpus")
    merges = B.train_bpe(B.pretoken_counts(corpus), vocab_size)
    B.merges_df(spark, merges).coalesce(1).write.mode("overwrite").parquet(f"{out}/tokenizer/merges")
    B.vocab_df(spark, merges).coalesce(1).write.mode("overwrite").parquet(f"{out}/tokenizer/vocab")


def run_tokenize(spark: SparkSession, inp: str, out: str, seq_len: int = C.SEQ_LEN,
                 val_every: int = C.VAL_EVERY_N_WINDOWS, window_files: str | None = None) -> None:
    """Phase 4: corpus -> packed windows (partitioned by split, source) + token index; ``window_files`` names a mounted folder
    for the same windows as fixed-width files."""
    i = Inputs(spark, inp)
    merges = B.load_merges(spark.read.parquet(f"{out}/tokenizer/merges"))
    corpus = P.line_index(spark.read.parquet(f"{out}/corpus"))
    corpus = R.attach_policy(corpus, i.registry, ("token_shards",))
    lines = P.tok_shards(corpus, F.col("token_shards")).withColumn("ids", B.encode_column(F.col("text"), merges))
    _write(P.pack_windows(lines, "ids", seq_len, B.EOS_ID, val_every), f"{out}/windows", ("split", "source"))
    if window_files:
        WF.write_windows(spark.read.parquet(f"{out}/windows"), window_files, seq_len, val_every)
    index = P.token_index(spark.read.parquet(f"{out}/windows"), seq_len)
    _report(index, f"{out}/token_index")
    _document(REP.index_document(index, seq_len), f"{out}/token_index_document")


def run_ocr(spark: SparkSession, inp: str, out: str, n: int = C.OCR_SAMPLE_N) -> None:
    from tessera.plans.catalog_clean import q_ocr_threshold_sweep
    _report(q_ocr_threshold_sweep(spark, inp, n), f"{out}/ocr_sweep")


def run_eval(spark: SparkSession, out: str, losses_path: str | None = None, vocab_size: int = C.VOCAB_SIZE) -> None:
    """Per-source loss / perplexity roll-up from a losses table (source, loss per window);
    without one, from the add-one unigram model of the train windows."""
    windows = spark.read.parquet(f"{out}/windows")
    losses = spark.read.parquet(losses_path) if losses_path else EP.unigram_losses(windows, vocab_size)
    rollup = EP.perplexity_rollup(losses)
    _report(rollup.orderBy("source"), f"{out}/perplexity")
    _document(REP.perplexity_document(rollup), f"{out}/perplexity_document")


def run_plan(spark: SparkSession, out: str, world_size: int = 8, max_steps: int = 0, start_step: int = 0) -> None:
    windows = spark.read.parquet(f"{out}/windows")
    cfg = C.TrainPlanConfig()
    per_gpu = cfg.global_batch_tokens // cfg.seq_len // world_size
    plan = EP.epoch_plan(windows, world_size, per_gpu, cfg.micro_batch, cfg.seed, max_steps, start_step,
                         cfg.global_batch_tokens // cfg.seq_len)
    plan.write.mode("overwrite").partitionBy("rank").parquet(f"{out}/epoch_plan")


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tessera.plans.jobs")
    ap.add_argument("phase", choices=["smoke", "measure", "clean", "dedup", "tokenizer", "tokenize", "ocr", "eval", "plan"])
    ap.add_argument("--input", required=False, default="")
    ap.add_argument("--out", required=True)
    ap.add_argument("--vocab-size", type=int, default=C.VOCAB_SIZE)
    ap.add_argument("--seq-len", type=int, default=C.SEQ_LEN)
    ap.add_argument("--val-every", type=int, default=C.VAL_EVERY_N_WINDOWS)
    ap.add_argument("--web-shards", type=int, default=None)
    ap.add_argument("--manifest", default=None, help="clean: manifest file, or folder of shard files to list")
    ap.add_argument("--only", default="", help="clean: this source alone")
    ap.add_argument("--dictionary", default=None, help="clean: word list, a word a line")
    ap.add_argument("--n", type=int, default=None, help="smoke, measure, ocr: records a source")
    ap.add_argument("--start-step", type=int, default=0, help="plan: first step to plan")
    ap.add_argument("--window-files", default=None, help="tokenize: mounted folder for fixed-width window files")
    ap.add_argument("--world-size", type=int, default=8)
    ap.add_argument("--max-steps", type=int, default=0)
    ap.add_argument("--losses", default=None)
    ap.add_argument("--benchmarks", default="", help="dedup: Parquet paths of benchmark sets, by commas")
    ap.add_argument("--reuse-signatures", action="store_true")
    a = ap.parse_args(argv)
    spark = get_spark(app=f"tessera-{a.phase}")
    {
        "smoke": lambda: run_smoke(spark, a.input, a.out, a.n or C.SMOKE_N),
        "measure": lambda: run_measure(spark, a.input, a.out, a.n or C.MEASURE_N),
        "clean": lambda: run_clean_files(spark, a.manifest, a.out, a.web_shards, a.only, a.dictionary) if a.manifest
        else run_clean(spark, a.input, a.out, a.web_shards, a.only, a.dictionary),
        "dedup": lambda: run_dedup(spark, a.input, a.out, a.reuse_signatures, a.benchmarks),
        "tokenizer": lambda: run_tokenizer(spark, a.out, a.vocab_size),
        "tokenize": lambda: run_tokenize(spark, a.input, a.out, a.seq_len, a.val_every, a.window_files),
        "ocr": lambda: run_ocr(spark, a.input, a.out, a.n or C.OCR_SAMPLE_N),
        "eval": lambda: run_eval(spark, a.out, a.losses, a.vocab_size),
        "plan": lambda: run_plan(spark, a.out, a.world_size, a.max_steps, a.start_step),
    }[a.phase]()
    print(json.dumps({"phase": a.phase, "out": a.out}))


if __name__ == "__main__":
    main()
