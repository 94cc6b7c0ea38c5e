"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed features (words, character
n-grams of words, word bigrams); a softmax layer reads the label off that average. The
model is trained with numpy stochastic gradient descent, one document a step.

* Features are made inside Spark tasks from whole texts; a training document reaches the
  driver only as counts per hash bucket (at most ``2**bits`` of them), never as text.
* Training uses at most ``per_class`` documents of each label (those with the smallest
  hash of doc_id). The class frequencies of *all* training labels correct the prior.
* Because the output is linear in the average, scoring needs one number per bucket: the
  model ships as a float32 vector of ``2**bits`` values, whatever the input size.

Cases: null or empty text has no features and scores the prior; null doc_id is scored and
is never a training row; labels other than 0/1 or null are ignored; a doc_id with several
label rows counts with its smallest label; with labels of one class (or none) every score
is the smoothed class frequency. Extra columns are ignored by the query and kept by the filter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import char_grams, mix64, released, slices, small_batches, words_of


@dataclass(frozen=True)
class QualityConfig:
    bits: int = 18            # 2**bits hash buckets
    dim: int = 16
    gram_low: int = 3         # character n-grams
    gram_high: int = 4
    per_class: int = 3000     # training documents of each label, at most
    epochs: int = 3
    rate: float = 0.5
    seed: int = 7
    folds: int = 5            # crc32(doc_id) mod folds = 0 is held out
    threshold: float = 0.3


def held_out(doc_id, folds: int):
    """The label fold that training never sees; a null doc_id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(True))


def batch_features(texts: pa.Array, cfg: QualityConfig):
    """(bucket per word, bucket per word's n-gram with its word, bucket per bigram, codes, offsets).

    The bigram of a word with itself has a bucket of its own: repeated words are one feature,
    not one for each word.
    """
    codes, offsets, words = words_of(texts)
    shift = np.uint64(64 - cfg.bits)
    if not words:
        none = np.zeros(0, np.int64)
        return none, (none, none), none, codes, offsets
    owner, grams = char_grams(words, cfg.gram_low, cfg.gram_high)
    whole = np.zeros(len(words), np.uint64)
    np.add.at(whole, owner, grams)          # a word's hash: the sum of its n-gram hashes and its length
    whole = mix64(whole + np.fromiter((len(w) for w in words), np.uint64, len(words)))
    h = whole[codes]
    pair = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
    pair = np.where(codes[:-1] == codes[1:], np.uint64(0x1234567), mix64(pair))
    cut = lambda x: (x >> shift).astype(np.int64)
    return cut(whole), (owner, cut(mix64(grams))), cut(mix64(pair)), codes, offsets


def document_counts(texts: pa.Array, cfg: QualityConfig):
    """Per row: (buckets, their share of the row's features). The training form."""
    word_b, (owner, gram_b), pair_b, codes, offsets = batch_features(texts, cfg)
    order = np.argsort(owner, kind="stable")
    gram_b, first = gram_b[order], np.searchsorted(owner[order], np.arange(len(word_b) + 1))
    for i in range(len(texts)):
        lo, hi = int(offsets[i]), int(offsets[i + 1])
        mine = codes[lo:hi]
        each, times = np.unique(mine, return_counts=True)
        sizes = first[each + 1] - first[each] if len(each) else np.zeros(0, np.int64)
        grams = np.concatenate([gram_b[first[c]:first[c + 1]] for c in each] or [np.zeros(0, np.int64)])
        pairs = pair_b[lo:max(lo, hi - 1)]
        buckets = np.concatenate([word_b[each], grams, pairs])
        weight = np.concatenate([times, np.repeat(times, sizes), np.ones(len(pairs), np.int64)])
        found, at = np.unique(buckets, return_inverse=True)
        share = np.bincount(at, weight, len(found))
        yield found.astype(np.int32), (share / max(share.sum(), 1)).astype(np.float32)


def document_scores(texts: pa.Array, vector: np.ndarray, cfg: QualityConfig) -> np.ndarray:
    """Mean of ``vector`` over each row's features (0 for a row without any)."""
    word_b, (owner, gram_b), pair_b, codes, offsets = batch_features(texts, cfg)
    if not len(codes):
        return np.zeros(len(texts))
    n = len(word_b)
    value = vector[word_b] + np.bincount(owner, vector[gram_b], n)
    count = 1 + np.bincount(owner, minlength=n)
    joint = np.append(vector[pair_b], 0.0)          # bigram that starts at word k; none at a row's last word
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    has = np.ones(len(codes), np.int64)
    joint[last], has[last] = 0.0, 0
    rows = np.repeat(np.arange(len(texts)), np.diff(offsets))
    total = np.bincount(rows, value[codes] + joint, len(texts))
    size = np.bincount(rows, count[codes] + has, len(texts))
    return total / np.maximum(size, 1)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], totals: dict[int, int], cfg: QualityConfig):
    """(vector, bias): log-odds of label 1 = mean of ``vector`` over the features + ``bias``."""
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    prior = float(np.log((n1 + 1.0) / (n0 + 1.0)))
    m1 = sum(y for *_, y in rows)
    m0 = len(rows) - m1
    if not m0 or not m1:
        return np.zeros(1 << cfg.bits, np.float32), prior
    rng = np.random.default_rng(cfg.seed)
    emb = rng.uniform(-1.0 / cfg.dim, 1.0 / cfg.dim, (1 << cfg.bits, cfg.dim)).astype(np.float32)
    out = np.zeros((2, cfg.dim), np.float32)
    bias = np.zeros(2, np.float32)
    steps, step = cfg.epochs * len(rows), 0
    # both classes weigh the same in training; the prior comes back from all labels below
    scale = np.array([len(rows) / (2 * m0), len(rows) / (2 * m1)], np.float32)
    for _ in range(cfg.epochs):
        for i in rng.permutation(len(rows)):
            bucket, share, y = rows[i]
            rate = np.float32(cfg.rate * (1 - step / steps) * scale[y])
            step += 1
            vecs = emb[bucket]
            hidden = share @ vecs if len(bucket) else np.zeros(cfg.dim, np.float32)
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1.0
            back = p @ out
            out -= rate * np.outer(p, hidden)
            bias -= rate * p
            if len(bucket):
                # steps per feature are scaled up to the word level, as if each occurrence were a step
                emb[bucket] = vecs - (rate * len(bucket)) * share[:, None] * back[None, :] * np.float32(0.05)
    return emb @ (out[1] - out[0]), float(bias[1] - bias[0]) + prior


def fit(documents: DataFrame, labels: DataFrame, cfg: QualityConfig = QualityConfig()):
    """Train on the labelled rows outside the held-out fold."""
    good = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
            .select("doc_id", F.col("quality").cast("int").alias("quality"))
            .where(~held_out(F.col("doc_id"), cfg.folds))
            .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    totals = {r["quality"]: r["n"] for r in good.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    picked = []
    for y in (0, 1):
        picked += (good.where(F.col("quality") == y).orderBy(F.xxhash64("doc_id"), "doc_id")
                   .limit(cfg.per_class).collect())
    spark = documents.sparkSession
    # at most 2 * per_class ids: a proven bound for the broadcast
    sample = spark.createDataFrame([(r["doc_id"], r["quality"]) for r in picked], "doc_id long, quality int")
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text")

    def features(batches):
        for batch in batches:
            for part in slices(batch):
                made = list(document_counts(part.column("text"), cfg))
                yield pa.record_batch([part.column("doc_id"), part.column("quality"),
                                       pa.array([b.tobytes() for b, _ in made], pa.binary()),
                                       pa.array([s.tobytes() for _, s in made], pa.binary())],
                                      names=["doc_id", "quality", "buckets", "shares"])

    schema = "doc_id long, quality int, buckets binary, shares binary"
    with small_batches(spark):
        rows = sorted(texts.mapInArrow(released(features), schema).collect(), key=lambda r: (r["doc_id"], r["buckets"]))
    return train([(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["shares"], np.float32), r["quality"])
                  for r in rows], totals, cfg)


def score(documents: DataFrame, model, cfg: QualityConfig = QualityConfig(), column: str = "score") -> DataFrame:
    """``documents`` with the probability of label 1 in ``column`` (replaced if it exists). Narrow: no shuffle."""
    vector, bias = model
    shared = documents.sparkSession.sparkContext.broadcast(vector)
    kept = documents.drop(column)

    def scores(batches):
        for batch in batches:
            for part in slices(batch):
                z = document_scores(part.column("text"), shared.value, cfg) + bias
                p = 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p, pa.float64())],
                                                 names=[*part.schema.names, column])

    return kept.mapInArrow(released(scores), T.StructType([*kept.schema.fields, T.StructField(column, T.DoubleType())]))


def keep_good(documents: DataFrame, labels: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """The documents the classifier does not reject (score at or over the threshold), columns unchanged."""
    tmp = "_quality_score"
    return (score(documents, fit(documents, labels, cfg), cfg, tmp)
            .where(F.col(tmp) >= cfg.threshold).drop(tmp))
