"""A stated query set against all rows, in pairs of blocks.

Vectors are dealt into blocks of about ``rows`` and queries into blocks of about ``queries`` by a
hash of their ids. A group holds one block of each, so every task has bounded input; a block is
sent once per block of the other side. Groups return at most ``k`` rows per query.

Equal vectors are one row of a block with their ``k + 1`` smallest ids: no query can return more
of them, so a vector that a third of all rows repeat is one row, exactly.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", zeros: bool = True) -> DataFrame:
    """(id, vec): rows with an id and a vector without null or non-finite components (nor, if not ``zeros``, all zero)."""
    v = F.col(vec_col)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    ok = F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, bad)
    if not zeros:
        ok &= F.exists(v, lambda x: x != 0)
    return (vectors.where(F.coalesce(ok, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("vec")))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(vec, ids): each distinct vector with its ``k + 1`` smallest ids in order.

    Two steps, the first over salted groups of at most a sixteenth of a repeated vector's rows.
    """
    narrow = lambda c: F.slice(F.array_sort(c), 1, k + 1)
    some = (rows.groupBy("vec", F.pmod(F.xxhash64("id"), F.lit(16)).alias("salt"))
            .agg(narrow(F.collect_list("id")).alias("ids")))
    return some.groupBy("vec").agg(narrow(F.flatten(F.collect_list("ids"))).alias("ids"))


def matrix(column) -> np.ndarray:
    """Rows of an Arrow list column as a 2-D float64 array (all lists of one length)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def deal(queries: DataFrame, vectors: DataFrame, per_query: int, per_vector: int) -> tuple[DataFrame, DataFrame, int, int]:
    """Both sides with block numbers (qb, vb), each row copied to all blocks of the other side."""
    nq = max(1, -(-queries.count() // per_query))
    nv = max(1, -(-vectors.count() // per_vector))
    q = (queries.withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(nq)).cast("int"))
         .withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(nv - 1)))))
    v = (vectors.withColumn("vb", F.pmod(F.xxhash64("vec"), F.lit(nv)).cast("int"))
         .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1)))))
    return q, v, nq, nv


def against(queries: DataFrame, vectors: DataFrame, match: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``match(query block, vector block)`` on every pair of blocks."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return match(left, right)

    return queries.groupBy("qb", "vb").cogroup(vectors.groupBy("qb", "vb")).applyInArrow(run, schema)


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query: score descending, then the smaller id (at most k rows per block come in)."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def top_of(scores: np.ndarray, ids: list[np.ndarray], own: np.ndarray, k: int):
    """(row, id, score) of the k best candidates of each row of ``scores`` (rows x distinct vectors).

    ``ids`` are the smallest ids of each distinct vector, in order; a row's own id is no candidate. Columns
    under a row's k-th best value cannot matter, columns equal to it all can.
    """
    rows, vecs, vals = [], [], []
    n = scores.shape[1]
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, scores.dtype)
    want = min(n, k + 1)                       # one column may hold nothing but the row's own id
    edge = np.partition(scores, n - want, axis=1)[:, n - want]
    for i in range(len(scores)):
        cols = np.flatnonzero(scores[i] >= edge[i])
        cand = np.concatenate([ids[c] for c in cols])
        value = np.repeat(scores[i, cols], [len(ids[c]) for c in cols])
        mine = cand != own[i]
        cand, value = cand[mine], value[mine]
        order = np.lexsort((cand, -value))[:k]
        rows.append(np.full(len(order), i))
        vecs.append(cand[order])
        vals.append(value[order])
    return np.concatenate(rows), np.concatenate(vecs), np.concatenate(vals)
