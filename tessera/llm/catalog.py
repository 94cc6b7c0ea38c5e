"""Registered queries of the dealt operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (chat, hashing, langid, licenses, linededup, mixing, neardup, packing, phrases, quality, spelling, topk,
                         urlfilter)
from tessera.llm.common import read


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urlfilter.judge(read(spark, sf_dir, "pages", "page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "blocked_score")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), neardup.NearConfig(words=4))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents", "doc_id", "text")).drop("text")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "text")
    return linededup.drop_boilerplate(docs, dropped="n_dropped")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read(spark, sf_dir, "documents"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashing.search(read(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    rows = langid.page_rows(read(spark, sf_dir, "pages")).unionByName(langid.document_rows(docs))
    return langid.fuse(rows, langid.learn(docs)).select("doc_id", "page_id", "host", "suffix", "declared", "lang_id", "score")


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read(spark, sf_dir, "embeddings"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = quality.QualityConfig()
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, read(spark, sf_dir, "labels"), cfg), cfg)
    return scored.select("doc_id", quality.held_out(F.col("doc_id"), cfg.folds).alias("held_out"), "score",
                         (F.col("score") >= cfg.threshold).cast("int").alias("predicted"))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(read(spark, sf_dir, "conversations")).drop("n_tokens")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents", "doc_id", "text"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(read(spark, sf_dir, "documents", "text", "lang"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_near_dedup": op2_near_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_line_dedup": op4_line_dedup,
    "op5_mixing": op5_mixing,
    "op6_nearest": op6_nearest,
    "op7_packing": op7_packing,
    "op8_language_id": op8_language_id,
    "op9_top_k": op9_top_k,
    "op10_quality": op10_quality,
    "op11_chat_format": op11_chat_format,
    "op12_spelling": op12_spelling,
    "op13_phrases": op13_phrases,
}

SQL = {
    "op2_near_dedup": neardup.sql(neardup.NearConfig(words=4)),
    "op3_license_scan": licenses.sql(),
    "op4_line_dedup": linededup.sql(),
    "op5_mixing": mixing.sql(),
    "op9_top_k": topk.sql(),
    "op11_chat_format": chat.SQL,
    "op12_spelling": spelling.sql(),
    "op13_phrases": phrases.sql(),
}
