"""OCR-garble gate: dictionary table, non-word ratio, threshold sweep.

The ratio is a narrow column: an Arrow function finds a batch's tokens, looks up the distinct ones in the published
dictionary (``functions.words``) and sums per row. It needs no join and no aggregate, so batch and stream share
it, whatever the dictionary's size and however common a token is. Only rows that reach the gate are passed in
(other rows get NULL).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import config as C
from tessera.functions.memory import release
from tessera.functions.text import ocr_tokens
from tessera.functions.words import WordSet, letter_tokens, publish


def dictionary_from_words(lines: DataFrame, col: str = "value") -> DataFrame:
    """Word-list file (one word per line) -> distinct lower-case alphabetic words."""
    w = F.trim(F.col(col))
    return lines.select(F.lower(w).alias("word")).where(w.rlike(r"^\p{L}+$")).distinct()


def dictionary_from_labels(documents: DataFrame, labels: DataFrame, min_docs: int = 2) -> DataFrame:
    """Fixture dictionary: lower ``[A-Za-z]{3,}`` tokens of English, quality-1 labelled
    documents that occur in at least ``min_docs`` documents."""
    good = labels.where(F.col("quality") == 1).select("doc_id")
    docs = documents.where(F.col("lang") == "en").join(good, "doc_id", "left_semi")
    per_doc = docs.select("doc_id", F.explode(F.array_distinct(ocr_tokens(F.col("text")))).alias("word"))
    return (per_doc.groupBy("word").agg(F.count(F.lit(1)).alias("n_docs"))
            .where(F.col("n_docs") >= min_docs).select("word"))


#: Text bytes looked up at once.
LOOKUP_BYTES = 4 << 20


def nonword_counts(texts: pa.Array, words: WordSet) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, tokens not in the dictionary) of each row."""
    n, bad, size = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.zeros(len(texts) + 1, np.int64)
    np.cumsum(pc.fill_null(pc.binary_length(texts.cast(pa.large_string())), 0).to_numpy(zero_copy_only=False), out=size[1:])
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(size, size[at] + LOOKUP_BYTES, side="right")) - 1)
        codes, off, tokens = letter_tokens(texts.slice(at, to - at))
        miss = np.concatenate([[0], np.cumsum(~words.holds(tokens)[codes])]) if len(codes) else np.zeros(1, np.int64)
        n.append(np.diff(off))
        bad.append(miss[off[1:]] - miss[off[:-1]])
        at = to
    return np.concatenate(n), np.concatenate(bad)


def nonword_column(text: Column, words: WordSet, cfg: C.CleanConfig = C.CleanConfig()) -> Column:
    """Struct (n_tokens, n_nonword, nonword_ratio) of a text; NULL in, NULL out.

    The ratio of a text with fewer than ``ocr_min_tokens`` tokens, or of any text against an empty dictionary, is 0."""
    least = cfg.ocr_min_tokens

    @F.arrow_udf("struct<n_tokens: int, n_nonword: bigint, nonword_ratio: double>")
    def measure(texts: pa.Array) -> pa.Array:
        n, bad = nonword_counts(texts, words)
        release()
        bad = np.where((n >= least) & (words.size > 0), bad, 0)
        return pa.StructArray.from_arrays([pa.array(n, pa.int32()), pa.array(bad, pa.int64()), pa.array(bad / np.maximum(n, 1))],
                                          names=["n_tokens", "n_nonword", "nonword_ratio"], mask=texts.is_null())

    return measure(text)


def ocr_ratio(df: DataFrame, keys: list[str], text_col: str, dictionary: DataFrame,
              cfg: C.CleanConfig = C.CleanConfig()) -> DataFrame:
    """``keys + [n_tokens, n_nonword, nonword_ratio]`` of every row."""
    words = publish(dictionary)
    return df.select(*keys, nonword_column(F.col(text_col), words, cfg).alias("_o")).select(*keys, "_o.*")


def threshold_sweep(ratios: DataFrame, thresholds=C.OCR_SWEEP_THRESHOLDS, ratio_col: str = "nonword_ratio") -> DataFrame:
    """Count and share of ratios strictly above each threshold.

    The threshold list is a handful of literals, so it is expressed as one
    conditional aggregate per threshold over a single pass (no cross join),
    then turned into rows with ``stack``.
    """
    aggs = [F.count(F.lit(1)).alias("scored")]
    for i, t in enumerate(thresholds):
        aggs.append(F.sum(F.when(F.col(ratio_col) > F.lit(float(t)), 1).otherwise(0)).cast("bigint").alias(f"d{i}"))
    one = ratios.agg(*aggs)
    stack = "stack({n}, {body}) as (threshold, dropped)".format(
        n=len(thresholds), body=", ".join(f"cast({float(t)!r} as double), d{i}" for i, t in enumerate(thresholds)))
    return one.selectExpr("scored", stack).select(
        "threshold", F.col("scored").cast("bigint").alias("scored"), "dropped",
        F.try_divide(F.col("dropped").cast("double"), F.col("scored").cast("double")).alias("share"))
