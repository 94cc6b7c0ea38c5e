"""Exact top-k inner products by a three-phase uniform threshold.

The components of a vector are split into ``lists`` parts; in a block of vectors each part is a
list of local scores (integer partial inner products) per query.

1. Gather: every list offers its ``k + 1`` highest entries; their totals give, per query and over all
   blocks, a cutoff that at least k candidates reach: a safe one.
2. The cutoff goes back with the queries. A total can reach it only if some list's entry reaches
   ``cutoff / lists``: those entries are collected.
3. The remaining scores are resolved exactly from all lists, and those under the cutoff go.

Partial scores are computed in double precision while they are exact there (below 2**53), else in
Python integers; totals beyond 64 bits are held at the 64-bit ends.

Cases: vectors null, empty, or with null or non-finite components take no part; a null id takes no
part; vectors of another length than the query are no candidates; equal vectors and repeated rows
are candidates each, by their ids (rows that repeat an id and a vector count once); ties go to the smaller id;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.blocks import against, best, deal, distinct_vectors, matrix, top_of, usable
from tessera.llm.common import Scratch


@dataclass(frozen=True)
class TopConfig:
    k: int = 5
    every: int = 50             # ids divisible by this are queries
    scale: float = 256.0
    lists: int = 4
    block_queries: int = 1024
    block_vectors: int = 8192


def integers(vectors: DataFrame, scale: float) -> DataFrame:
    """floor(scale * x) of every component, as doubles (exact integers)."""
    return vectors.withColumn("vec", F.transform("vec", lambda x: _floor(x * scale)))


def _floor(x):
    # floor() of a double gives a long in Spark; beyond 2**53 a double is an integer already
    return F.when(F.abs(x) < 2.0 ** 53, F.floor(x).cast("double")).otherwise(x) + F.lit(0.0)


def _partials(q: np.ndarray, v: np.ndarray, lists: int) -> list[np.ndarray]:
    """Per list the partial scores, queries x vectors; float64 where exact, else Python integers."""
    cuts = np.linspace(0, q.shape[1], lists + 1).astype(int)
    bound = np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * q.shape[1]
    if bound >= 2.0 ** 53:
        as_int = np.vectorize(int, otypes=[object])
        q, v = as_int(q), as_int(v)
    return [q[:, a:b] @ v[:, a:b].T for a, b in zip(cuts[:-1], cuts[1:]) if b > a]


def _total(parts: list[np.ndarray]) -> np.ndarray:
    total = sum(parts[1:], parts[0])
    if total.dtype == object:
        total = np.vectorize(lambda x: min(max(x, -(1 << 63)), (1 << 63) - 1), otypes=[object])(total)
    return total.astype(np.int64)


def _blocks_by_length(left: pa.Table, right: pa.Table):
    """(queries, vectors) row numbers of each vector length that both sides have."""
    size = lambda t: np.array([len(x) for x in t.column("vec")], np.int64)
    ql, vl = size(left), size(right)
    for n in np.intersect1d(ql, vl):
        yield left.take(np.flatnonzero(ql == n)), right.take(np.flatnonzero(vl == n))


def search(vectors: DataFrame, cfg: TopConfig = TopConfig(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query row, exactly."""
    scratch = Scratch(vectors.sparkSession)
    rows = scratch.write(integers(usable(vectors, id_col, vec_col), cfg.scale).distinct(), "rows")
    index = scratch.write(distinct_vectors(rows, cfg.k), "index")
    queries = rows.where(F.pmod("id", F.lit(cfg.every)) == 0).select(F.col("id").alias("qid"), "vec")
    q, v, _, _ = deal(queries, index, cfg.block_queries, cfg.block_vectors)

    def gather(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], []]
        for a, b in _blocks_by_length(left, right):
            own, ids = a.column("qid").to_numpy(), [np.array(x.as_py()) for x in b.column("ids")]
            parts = _partials(matrix(a.column("vec")), matrix(b.column("vec")), cfg.lists)
            total = _total(parts)
            want = min(cfg.k + 1, total.shape[1])
            offered = np.concatenate([np.argsort(-p, axis=1)[:, :want] if p.dtype == object
                                      else np.argpartition(-p, want - 1, axis=1)[:, :want] for p in parts], axis=1)
            for i in range(len(own)):
                cols = np.unique(offered[i])
                r, c, s = top_of(total[i:i + 1, cols], [ids[x] for x in cols], own[i:i + 1], cfg.k)
                out[0].append(np.full(len(r), own[i]))
                out[1].append(c)
                out[2].append(s)
        cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return pa.table({"query_id": cat(out[0]), "vec_id": cat(out[1]), "score": cat(out[2]).astype(np.int64)})

    offered = against(q, v, gather, "query_id long, vec_id long, score long")
    kth = best(offered.distinct(), cfg.k).where(F.col("rank") == cfg.k).select(F.col("query_id").alias("_qid"), F.col("score").alias("cutoff"))
    # queries without k offers have no cutoff: everything is collected for them
    cutoffs = scratch.write(queries.join(kth, F.col("qid") == F.col("_qid"), "left").drop("_qid"), "cutoffs")
    q2, v2, _, _ = deal(cutoffs, index, cfg.block_queries, cfg.block_vectors)

    def resolve(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], []]
        for a, b in _blocks_by_length(left, right):
            own, ids = a.column("qid").to_numpy(), [np.array(x.as_py()) for x in b.column("ids")]
            parts = _partials(matrix(a.column("vec")), matrix(b.column("vec")), cfg.lists)
            total = _total(parts)
            for i, cut in enumerate(a.column("cutoff").to_pylist()):
                if cut is None:
                    cols = np.arange(total.shape[1])
                else:
                    some = np.zeros(total.shape[1], bool)
                    for p in parts:
                        some |= p[i] * len(parts) >= cut
                    cols = np.flatnonzero(some)
                    cols = cols[total[i, cols] >= cut]
                r, c, s = top_of(total[i:i + 1, cols], [ids[x] for x in cols], own[i:i + 1], cfg.k)
                out[0].append(np.full(len(r), own[i]))
                out[1].append(c)
                out[2].append(s)
        cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return pa.table({"query_id": cat(out[0]), "vec_id": cat(out[1]), "score": cat(out[2]).astype(np.int64)})

    return best(against(q2, v2, resolve, "query_id long, vec_id long, score long").distinct(), cfg.k)


def sql(cfg: TopConfig = TopConfig()) -> str:
    """DuckDB brute force."""
    return f"""
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({cfg.scale} * x::DOUBLE)::BIGINT) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.w::DOUBLE[], c.w::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % {cfg.every} = 0 AND q.vec_id <> c.vec_id AND len(q.w) = len(c.w)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {cfg.k}"""
