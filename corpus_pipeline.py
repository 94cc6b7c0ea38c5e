"""A training-data pipeline of five stages over ``documents``.

Each stage is written as Parquet in the shared folder and reread as the next one's documents.
SQL cannot express the first stage (a trained classifier), so there is no ORACLE_SQL; the stages
are tested against brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import linededup, mixing, neardup, packing, quality
from tessera.llm.common import Scratch, read

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels")).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines that are boilerplate of their source go; ``n_chars`` follows the text.

    Copies of a document count as one page: near-dedup comes after, and must find one full text of them."""
    from pyspark.sql import functions as F
    cfg = linededup.LineConfig(distinct=True)
    return linededup.drop_boilerplate(docs, cfg=cfg).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup (five words, 0.8): one document of each group stays."""
    return neardup.dedup(docs).select(*COLUMNS)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: documents as often, or as much of them, as the mix takes."""
    return mixing.mix(docs).select(*COLUMNS)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing into sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("near-dedup", near_stage),
    ("mixing", mix_stage),
    ("packing", pack_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; every stage but the last is written and reread."""
    scratch = Scratch(spark)
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.write(docs, f"stage-{k}")
    return docs
