"""Document cleaning chain: line filter -> boilerplate -> length -> repetition ->
language -> OCR, first failing gate names the reason.

One narrow projection per document (no explode, no shuffle); the OCR gate only
sees rows that passed the cheaper gates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import config as C
from tessera.functions import text as X
from tessera.operators import ocr as O

REASONS = ("kept", "too_short", "repetitive", "non_english", "ocr")


def gate_metrics(df: DataFrame, text_col: str = "text", cfg: C.CleanConfig = C.CleanConfig()) -> DataFrame:
    """Add ``raw_chars``, ``_s2`` (text after line filter + boilerplate), ``clean_chars``,
    ``_rep_ratio`` (only for rows past the length gate) and ``_ar`` (ASCII ratio of
    the language sample). One projection per intermediate, each computed once."""
    out = df.withColumn("raw_chars", F.length(text_col).cast("bigint")) \
        .withColumn("_s2", X.clean_text(F.col(text_col), cfg))
    out = out.withColumn("clean_chars", F.length("_s2").cast("bigint"))
    long_enough = F.col("clean_chars") >= cfg.min_doc_chars
    out = X.with_repetition(out, "_s2", cfg, when=long_enough)
    out = out.withColumn("_ar", F.when(long_enough, X.ascii_ratio(X.lang_sample(F.col("_s2"), cfg))))
    return out.drop("_rep_words", "_rep_grams", "_rep_top")


def pre_ocr_reason(cfg: C.CleanConfig) -> Column:
    return (F.when(F.col("clean_chars") < cfg.min_doc_chars, F.lit("too_short"))
            .when(F.coalesce(F.col("_rep_ratio") > F.lit(cfg.max_repetition_ratio), F.lit(False)), F.lit("repetitive"))
            .when(~X.english_by_ratio(F.col("_ar")), F.lit("non_english"))
            .otherwise(F.lit("kept")))


def clean_documents(raw: DataFrame, dictionary: DataFrame | None = None, strict_col: str | None = "strict_ocr",
                    cfg: C.CleanConfig = C.CleanConfig(), keep_cols: tuple[str, ...] = ()) -> DataFrame:
    """``raw(source, shard, pos, text, [strict_ocr])`` -> one CleanResult per row.

    Output: source, shard, pos, kept, reason, raw_chars, clean_chars, text
    (text is the cleaned text for kept rows and "" for dropped rows).
    ``strict_col=None`` turns the OCR gate off (sampling jobs).
    """
    base = raw.select("source", "shard", "pos", "text", *keep_cols,
                      *([F.col(strict_col).alias("_strict")] if strict_col else []))
    staged = gate_metrics(base, "text", cfg).drop("text").withColumn("_pre", pre_ocr_reason(cfg))
    reason = F.col("_pre")
    if strict_col and dictionary is not None:
        gate_in = F.col("_strict") & (F.col("_pre") == "kept")
        ratio = O.nonword_column(F.when(gate_in, F.col("_s2")), O.publish(dictionary), cfg)["nonword_ratio"]
        staged = staged.withColumn("_ocr", ratio)
        reason = F.when(gate_in & (F.col("_ocr") > F.lit(cfg.nonword_ratio_max)), F.lit("ocr")).otherwise(F.col("_pre"))
    staged = staged.withColumn("reason", reason)
    kept = F.col("reason") == F.lit("kept")
    return staged.select(
        "source", "shard", "pos", *keep_cols, kept.alias("kept"), "reason", "raw_chars", "clean_chars",
        F.when(kept, F.col("_s2")).otherwise(F.lit("")).alias("text"))


def clean_stages(raw: DataFrame, cfg: C.CleanConfig = C.CleanConfig()) -> DataFrame:
    """Per-document gate metrics for inspection: raw/clean chars, repetition ratio,
    ASCII ratio of the language sample, language decision (all rows)."""
    base = raw.select("source", "shard", "pos", "text")
    out = base.withColumn("raw_chars", F.length("text").cast("bigint")).withColumn("_s2", X.clean_text(F.col("text"), cfg))
    out = out.withColumn("ascii_ratio", X.ascii_ratio(X.lang_sample(F.col("_s2"), cfg)))
    return out.select("source", "shard", "pos", "raw_chars", F.length("_s2").cast("bigint").alias("clean_chars"),
                      "ascii_ratio", X.english_by_ratio(F.col("ascii_ratio")).alias("is_english"), "_s2")
