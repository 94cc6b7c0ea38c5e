"""Exact and near-duplicate removal.

* exact: md5 of the normal form; first occurrence per (source, shard) wins.
* near: MinHash signatures of 5-word shingles, LSH band buckets, then the
  sequential first-wins rule ("a document is dropped iff it shares a bucket with
  an earlier *kept* document") computed as iterated parallel greedy rounds on a
  member table (no pairwise expansion, so a hot bucket costs its member count,
  not its square).
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import config as C
from tessera.functions import text as X
from tessera.functions.memory import release
from tessera.session import cut_lineage

# Document order key packed in one BIGINT: shard < 2^23, position in shard < 2^40.
# (A BIGINT keeps min/max in hash aggregates; a struct would force sort aggregates.)
POS_BITS = 40


def order_key(shard: Column, pos: Column) -> Column:
    return shard.cast("bigint") * F.lit(1 << POS_BITS) + pos.cast("bigint")


def key_shard(k: Column) -> Column:
    return F.shiftright(k, POS_BITS).cast("int")


def key_pos(k: Column) -> Column:
    return k % F.lit(1 << POS_BITS)


# MinHash family: h(s) = first 32 bits of md5(s) mod P; perm_i(h) = (a_i*h + b_i) mod P.
MERSENNE_P = (1 << 31) - 1
_WORD = re.compile(rb"[a-z0-9]+")
EMPTY_SIGNATURE_VALUE = MERSENNE_P  # wordless documents: every position at the sentinel


def minhash_params(num_perm: int = C.MINHASH_PERM, seed: int = 20240613) -> list[tuple[int, int]]:
    """(a_i, b_i) pairs of the permutation family, from a seeded generator."""
    rng = random.Random(seed)
    return [(rng.randint(1, MERSENNE_P - 1), rng.randint(0, MERSENNE_P - 1)) for _ in range(num_perm)]


def shingles(words: Column, k: int = C.SHINGLE_K) -> Column:
    """k-word shingles; fewer than k words -> one shingle of all words; none -> empty.
    ``words`` should be a column reference."""
    n = F.size(words)
    return (F.when(n == 0, F.array().cast("array<string>"))
            .when(n < k, F.array(F.array_join(words, " ")))
            .otherwise(F.transform(F.sequence(F.lit(1), n - (k - 1)),
                                   lambda i: F.array_join(F.slice(words, i, k), " "))))


def shingle_hash(s: Column) -> Column:
    return F.conv(F.substring(F.md5(F.encode(s, "UTF-8")), 1, 8), 16, 10).cast("bigint") % F.lit(MERSENNE_P)


def _native_minhash(hashes: Column, params: list[tuple[int, int]]) -> Column:
    perms = F.array(*[F.struct(F.lit(a).cast("bigint").alias("a"), F.lit(b).cast("bigint").alias("b"))
                      for a, b in params])
    return F.transform(perms, lambda p: F.coalesce(
        F.array_min(F.transform(hashes, lambda x: (p["a"] * x + p["b"]) % F.lit(MERSENNE_P))),
        F.lit(EMPTY_SIGNATURE_VALUE).cast("bigint")))


#: Shingles whose (perm x shingle) matrix is held at once.
MATRIX_SHINGLES = 4096


def _numpy_minhash(lowered: Column, k: int, params: list[tuple[int, int]]) -> Column:
    """Arrow-batched kernel over lower-cased text: the distinct shingle hashes of a document, their (perm x shingle)
    matrix a block at a time, min per row. a, h < 2^31 so a*h + b < 2^63: exact in int64."""
    a = np.array([x for x, _ in params], dtype=np.int64)[:, None]
    b = np.array([y for _, y in params], dtype=np.int64)[:, None]

    @F.arrow_udf("array<bigint>")
    def _minhash(texts: pa.Array) -> pa.Array:
        def one(body: bytes) -> np.ndarray:
            words = _WORD.findall(body)
            made = {b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else ()
            first = b"".join([hashlib.md5(s, usedforsecurity=False).digest()[:4] for s in made])
            v = np.unique(np.frombuffer(first, ">u4").astype(np.int64) % MERSENNE_P)
            low = np.full(len(a), EMPTY_SIGNATURE_VALUE, np.int64)
            for at in range(0, len(v), MATRIX_SHINGLES):
                np.minimum(low, ((a * v[None, at:at + MATRIX_SHINGLES] + b) % MERSENNE_P).min(axis=1), out=low)
            return low

        rows = [one(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in texts.cast(pa.large_binary())]
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        out = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * len(a), pa.int32()), pa.array(flat))
        release()
        return out

    return _minhash(lowered)


def with_signature(df: DataFrame, text_col: str, cfg: C.DedupConfig = C.DedupConfig(),
                   out: str = "sig", kernel: str = "numpy") -> DataFrame:
    """Add ``out``: ARRAY<BIGINT> of ``num_perm`` MinHash values (narrow, no shuffle).

    Words, shingles, their hashes and the permutation minimum (num_perm x shingles per
    document) run in an Arrow kernel that takes the text alone (``kernel="native"``: the
    same as nested higher-order functions).
    """
    params = minhash_params(cfg.num_perm)
    if kernel == "numpy":
        return df.withColumn(out, _numpy_minhash(F.lower(text_col), cfg.shingle_k, params))
    step = df.withColumn("_mh_w", X.dedup_words(F.col(text_col)))
    step = step.withColumn("_mh_h", F.array_distinct(F.transform(shingles(F.col("_mh_w"), cfg.shingle_k), shingle_hash)))
    return step.withColumn(out, _native_minhash(F.col("_mh_h"), params)).drop("_mh_w", "_mh_h")


def band_members(sigs: DataFrame, cfg: C.DedupConfig = C.DedupConfig(), sig_col: str = "sig") -> DataFrame:
    """``(source, rank, band, bucket)``: one row per (document, band)."""
    keys = F.array(*[F.array_join(F.transform(F.slice(F.col(sig_col), j * cfg.rows + 1, cfg.rows),
                                              lambda v: v.cast("string")), ",")
                     for j in range(cfg.bands)])
    return sigs.select("source", "rank", F.posexplode(keys).alias("band", "bucket"))


def greedy_first_wins(members: DataFrame, cfg: C.DedupConfig = C.DedupConfig()) -> DataFrame:
    """Sequential first-wins over bucket collisions, as parallel rounds.

    ``members(source, rank, band, bucket)`` with a totally ordered ``rank``.
    Each round: a document is *kept* if it has the smallest rank among the
    undecided members of every one of its buckets; every undecided member of a
    bucket that holds a newly kept document is *dropped*. Equal to the
    sequential rule (an earlier kept neighbour always decides first) and
    finishes in few rounds. Returns ``(source, rank, kept)``.
    """
    spark = members.sparkSession
    undecided = cut_lineage(members.select("source", "rank", "band", "bucket"))
    decided_parts = []
    while not undecided.isEmpty():
        # a member is newly kept when it is the minimum of as many buckets as it has: no join on the bucket
        bucket_min = cut_lineage(undecided.groupBy("source", "band", "bucket").agg(F.min("rank").alias("_mr")))
        wins = bucket_min.groupBy("source", F.col("_mr").alias("rank")).agg(F.count("*").alias("_wins"))
        buckets = undecided.select("source", "rank", "band", "bucket").groupBy("source", "rank").agg(
            F.count_distinct("band", "bucket").alias("_buckets"))
        newly_kept = cut_lineage(wins.join(buckets, ["source", "rank"]).where("_wins = _buckets").select("source", "rank"))
        # both sides are plain checkpointed tables, so a hot bucket's rows can be split at run time
        kept_buckets = cut_lineage(bucket_min.join(newly_kept.withColumnRenamed("rank", "_mr"), ["source", "_mr"])
                                   .select("source", "band", "bucket"))
        touched = (undecided.join(kept_buckets, ["source", "band", "bucket"], "left_semi")
                   .select("source", "rank").distinct())
        decided = cut_lineage(touched.join(newly_kept.withColumn("kept", F.lit(True)), ["source", "rank"], "left")
                              .select("source", "rank", F.coalesce("kept", F.lit(False)).alias("kept")))
        undecided = cut_lineage(undecided.join(decided, ["source", "rank"], "left_anti"))
        decided_parts.append(decided)
    if not decided_parts:
        return spark.createDataFrame([], "source string, rank bigint, kept boolean")
    out = decided_parts[0]
    for p in decided_parts[1:]:
        out = out.unionByName(p)
    return out


def near_duplicates(docs: DataFrame, text_col: str = "text", cfg: C.DedupConfig = C.DedupConfig(),
                    sigs: DataFrame | None = None) -> DataFrame:
    """``docs(source, shard, pos, text)`` -> ``(source, shard, pos, near_dup)`` for every doc.

    Identical signatures collapse to their earliest member first: later copies
    are always dropped (they share every bucket with the earliest, or with the
    kept document that dropped it), so a cluster of copies is one member.
    """
    if sigs is None:
        sigs = with_signature(docs.select("source", "shard", "pos", text_col), text_col, cfg)
    # read twice (representatives, final flags): materialise once
    sigs = cut_lineage(sigs.select("source", order_key(F.col("shard"), F.col("pos")).alias("rank"), "sig"))
    reps = sigs.groupBy("source", "sig").agg(F.min("rank").alias("rank"))
    decided = greedy_first_wins(band_members(reps, cfg), cfg)
    kept = decided.where("kept").select("source", "rank", F.lit(True).alias("_k"))
    return (sigs.join(kept, ["source", "rank"], "left")
            .select("source", key_shard(F.col("rank")).alias("shard"), key_pos(F.col("rank")).alias("pos"),
                    F.col("_k").isNull().alias("near_dup")))


def exact_firsts(docs: DataFrame, scope: str = "shard", text_col: str = "text") -> DataFrame:
    """``(source, shard, pos, _h, is_first)``: is this the first occurrence of its
    normal form within its (source, shard) (``scope="shard"``) or source (``"source"``)?

    Skew-safe: a ``min`` aggregate per hash (map-side partial aggregation copes
    with a hash held by a third of all rows), joined back on the unique document
    key rather than on the hash.
    """
    part = ["source", "shard"] if scope == "shard" else ["source"]
    h = docs.select("source", "shard", "pos", X.exact_hash(F.col(text_col)).alias("_h"))
    firsts = (h.groupBy(*part, "_h").agg(F.min(order_key(F.col("shard"), F.col("pos"))).alias("_r"))
              .select("source", key_shard(F.col("_r")).alias("shard"), key_pos(F.col("_r")).alias("pos"),
                      F.lit(True).alias("is_first")))
    return (h.join(firsts, ["source", "shard", "pos"], "left")
            .select("source", "shard", "pos", "_h", F.coalesce("is_first", F.lit(False)).alias("is_first")))
