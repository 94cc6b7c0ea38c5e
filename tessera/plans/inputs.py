"""Per-(session, directory) input views shared by the registered queries."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import config as C
from tessera.operators import ocr as O
from tessera.operators.budget import apply_budget
from tessera.operators.clean import clean_documents
from tessera.sources import registry as R
from tessera.session import small_batches, written
from tessera.sources.tables import raw_docs, read_table


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str, cfg: C.PipelineConfig = C.PipelineConfig()):
        self.spark, self.sf_dir, self.cfg = spark, sf_dir, cfg
        small_batches(spark)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents")

    @cached_property
    def raw(self) -> DataFrame:
        return raw_docs(self.documents)

    @cached_property
    def registry(self) -> DataFrame:
        return R.registry_df(self.spark)

    @cached_property
    def dictionary(self) -> DataFrame:
        return O.dictionary_from_labels(self.documents, self.table("labels"))

    def raw_with_policy(self, cols=("strict_ocr",)) -> DataFrame:
        return R.attach_policy(self.raw, self.registry, cols)

    def clean(self, strict: bool = True) -> DataFrame:
        if strict:
            return clean_documents(self.raw_with_policy(), self.dictionary, "strict_ocr", self.cfg.clean)
        return clean_documents(self.raw, None, None, self.cfg.clean)

    def caps(self, web_shards: int | None = None) -> DataFrame:
        man = R.fixture_manifest(self.raw, self.registry)
        return R.shard_plan(man, self.registry, web_shards=web_shards)

    def clean_table(self) -> DataFrame:
        """The clean result, written once for operators that read it more than once."""
        return written(self.clean())

    def capped(self) -> DataFrame:
        return apply_budget(self.clean_table(), self.caps())

    def corpus_input(self, policy: tuple[str, ...] = ()) -> DataFrame:
        """Clean-shard lines of kept documents: (source, shard, pos, text[, policy cols]).

        Built on the materialised clean table (phase 2 reads it several times).
        The budget cap is a phase-1 policy; the corpus queries run on all kept
        documents so their work grows with the input.
        """
        from tessera.functions.text import flatten_newlines
        c = self.clean_table().where("kept").select("source", "shard", "pos", flatten_newlines(F.col("text")).alias("text"))
        if policy:
            c = R.attach_policy(c, self.registry, policy)
        return c

    def corpus(self) -> DataFrame:
        """Phase-2 output (kept rows: source, shard, pos, text), materialised once."""
        from tessera.plans.corpus import build_corpus, corpus_rows
        built = build_corpus(self.corpus_input(policy=("near_dup", "decontaminate")), [self.table("benchmark")],
                             self.cfg.dedup)
        return written(corpus_rows(built))

    def first_n(self, n: int) -> DataFrame:
        """First n raw records per source in record order (sampling operator)."""
        return first_records(self.raw, n)


def first_records(raw: DataFrame, n: int, salts: int = 32) -> DataFrame:
    """The ``n`` records of each source with the smallest (shard, pos).

    The keys are chosen without the text, first inside salted parts of a source (a hot source is dealt over
    ``salts`` tasks), then among the at most ``salts * n`` left; the text only meets the chosen keys.
    """
    from pyspark.sql import Window
    order = ["shard", "pos"]
    keys = raw.select("source", *order).withColumn("_s", F.pmod(F.xxhash64(*order), F.lit(salts)))
    for part in (["source", "_s"], ["source"]):
        rank = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
        keys = keys.withColumn("_rn", rank).where(F.col("_rn") <= n)
    return raw.join(keys.select("source", *order), ["source", *order], "left_semi")
