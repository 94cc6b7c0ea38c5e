"""Benchmark decontamination: a document sharing any word 13-gram with a
benchmark item is contaminated."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import config as C
from tessera.functions import text as X
from tessera.functions.bits import MAX_BITS, bit_table, passing
from tessera.session import written


def benchmark_text(bench: DataFrame) -> DataFrame:
    """All top-level string fields of a benchmark record joined by a space
    (non-string fields ignored, grams may cross fields)."""
    cols = [F.col(f.name) for f in bench.schema.fields if isinstance(f.dataType, T.StringType)]
    return bench.select(F.concat_ws(" ", *cols).alias("text"))


def contamination_grams(bench_texts: DataFrame, n: int = C.DECONTAM_NGRAM, text_col: str = "text") -> DataFrame:
    """Distinct word n-grams (``[a-z0-9]+`` words of the normal form) of all benchmark texts."""
    w = bench_texts.select(X.dedup_words(F.col(text_col)).alias("_w"))
    return w.select(F.explode(X.word_ngrams_joined(F.col("_w"), n)).alias("gram")).distinct()


def test_or_train(bench: DataFrame) -> DataFrame:
    """The ``test`` rows of a benchmark table with a ``split`` column, the ``train`` rows if it has no test rows; any other table whole."""
    if "split" not in bench.columns:
        return bench
    split = "test" if bench.where(F.col("split") == "test").limit(1).count() else "train"
    return bench.where(F.col("split") == split).drop("split")


def benchmark_sets(tables: list[DataFrame]) -> DataFrame:
    """The texts of several benchmark tables, each with its own fields and its test or else train rows."""
    return reduce(DataFrame.unionByName, [benchmark_text(test_or_train(t)) for t in tables])


def contaminated_keys(docs: DataFrame, grams: DataFrame, keys: list[str], text_col: str = "text",
                      n: int = C.DECONTAM_NGRAM, salts: int = 8, max_bits: int = MAX_BITS) -> DataFrame:
    """Keys of documents sharing at least one n-gram with ``grams``.

    One form at every size. A document's grams are tested in place against a bit table of the set (bounded bytes, broadcast);
    the few that pass are written with the key. Their distinct grams meet the set in a join of unique keys, and what is
    left of them meets the written rows again, dealt over ``salts`` so that a gram of a third of all documents is no one
    task's. Documents with fewer than n words have no grams and never match.
    """
    grams = written(grams.select("gram").distinct())
    table = bit_table(grams.select(F.xxhash64(F.split("gram", " ")).alias("h")), "h", max_bits)
    own = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    # a projection each, and no filter Spark could push below them: the words are made once a document, not once a gram
    w = docs.select(*own, X.dedup_words(F.col(text_col)).alias("_w"))
    # hashed word by word; only a gram that passes is made into a string
    count = F.size("_w") - (n - 1)
    hashes = F.when(count <= 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), count), lambda i: F.xxhash64(F.slice("_w", i, n))))
    w = w.withColumn("_h", hashes)
    w = w.withColumn("_at", passing(F.col("_h"), table))
    found = w.select(*[f"_k{i}" for i in range(len(keys))],
                     F.explode(F.array_distinct(F.transform("_at", lambda i: F.array_join(F.slice("_w", i + 1, n), " ")))).alias("gram"))
    found = written(found.withColumn("_salt", F.pmod(F.xxhash64(*[f"_k{i}" for i in range(len(keys))]), F.lit(salts)).cast("int")))
    true = written(found.select("gram").distinct().join(grams, "gram", "left_semi"))
    dealt = true.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    hit = found.join(dealt, ["gram", "_salt"], "left_semi").select(*[f"_k{i}" for i in range(len(keys))]).distinct()
    return hit.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)])
