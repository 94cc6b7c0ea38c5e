"""Approximate nearest neighbours by multi-index hashing.

* Codes: a rotation learned by iterative quantisation from a bounded sample (``sample`` rows with the
  smallest id hash) turns each unit vector into ``bits`` signs; every row is coded.
* Index: a code is split into ``substrings``; in a block of vectors each substring has a directory from
  its value to the rows that hold it.
* Probing: a code within Hamming distance r of the query differs in some substring by at most
  ``r // substrings`` bits (pigeonhole), so the directory entries within that radius, over all
  substrings, hold every code within r. Few flips are enumerated; when there are more flips than directory
  entries the entries are tested instead. The codes found are checked against r in full.
* Radius: the distance that ``coverage`` of the sample's true neighbours keep to their queries. A query with
  fewer than k + 1 codes within it goes on with a larger radius, up to the whole block.
* Rerank: exact inner products in double precision on the original vectors.

Nothing grows on the driver: it sees the sample (a documented bound), the rest is blocks.

Cases: vectors null, empty, zero, or with null or non-finite components take no part; a null id takes no
part; vectors of another length than the query are no candidates; equal vectors are candidates each, by
their ids; ties go to the smaller id; fewer than k candidates are all returned; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import against, best, deal, distinct_vectors, matrix, top_of, usable
from tessera.llm.common import Scratch


@dataclass(frozen=True)
class HashConfig:
    k: int = 20
    every: int = 20             # ids divisible by this are queries
    bits: int = 128
    substrings: int = 8         # of 16 bits each
    sample: int = 8000          # rows that the rotation and the radius are learned from
    coverage: float = 0.985
    rounds: int = 20
    block_queries: int = 1024
    block_vectors: int = 16384
    seed: int = 5


@dataclass(frozen=True)
class Code:
    mean: np.ndarray
    rotation: np.ndarray        # dimensions x bits
    radius: int


def unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(scale > 0, scale, 1)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def encode(x: np.ndarray, code: Code) -> np.ndarray:
    """Packed codes, one row of bytes per vector."""
    return np.packbits((unit(x) - code.mean) @ code.rotation > 0, axis=1)


def learn(x: np.ndarray, cfg: HashConfig) -> Code:
    """Iterative quantisation, once per ``dimensions`` bits: a rotation that brings vectors close to their signs."""
    u = unit(x)
    mean = u.mean(axis=0)
    z = u - mean
    d = z.shape[1]
    rng = np.random.default_rng(cfg.seed)
    parts, have = [], 0
    while have < cfg.bits:
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(cfg.rounds):
            left, _, right = np.linalg.svd(np.where(z @ r > 0, 1.0, -1.0).T @ z)
            r = (left @ right).T
        parts.append(r[:, :cfg.bits - have])
        have += parts[-1].shape[1]
    code = Code(mean, np.concatenate(parts, axis=1), 0)
    some = min(len(x), 500)
    bits = encode(x, code)
    score = x[:some] @ x.T
    score[np.arange(some), np.arange(some)] = -np.inf
    near = np.argsort(-score, axis=1)[:, :min(cfg.k, max(1, len(x) - 1))]
    far = np.bitwise_count(bits[:some, None, :] ^ bits[near]).sum(axis=2)
    return Code(mean, code.rotation, int(np.quantile(far, cfg.coverage)) if len(x) > 1 else cfg.bits)


def flips(width: int, radius: int) -> np.ndarray:
    """All ``width``-bit masks with at most ``radius`` set bits."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)], np.int64)


class Directory:
    """The codes of a block by the value of each substring."""

    def __init__(self, codes: np.ndarray, cfg: HashConfig):
        self.codes, self.cfg, self.width = codes, cfg, cfg.bits // cfg.substrings
        self.parts = self.split(codes)
        self.order = np.argsort(self.parts, axis=0, kind="stable")
        self.values, self.starts = [], []
        for j in range(cfg.substrings):
            value, start = np.unique(self.parts[self.order[:, j], j], return_index=True)
            self.values.append(value)
            self.starts.append(np.append(start, len(codes)))

    def split(self, codes: np.ndarray) -> np.ndarray:
        bits = np.unpackbits(codes, axis=1)[:, :self.cfg.bits].reshape(len(codes), self.cfg.substrings, self.width)
        return bits @ (1 << np.arange(self.width, dtype=np.int64))

    def within(self, code: np.ndarray, parts: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code lies within ``radius`` of ``code``."""
        if radius >= self.cfg.bits:
            return np.arange(len(self.codes))
        reach = radius // self.cfg.substrings
        probes = sum(comb(self.width, r) for r in range(reach + 1))
        seen = np.zeros(len(self.codes), bool)
        for j, value in enumerate(self.values):
            if probes < len(value):
                wanted = parts[j] ^ flips(self.width, reach)
                at = np.searchsorted(value, wanted)
                at[at == len(value)] = 0
                hit = at[value[at] == wanted]
            else:
                hit = np.flatnonzero(np.bitwise_count(value ^ parts[j]) <= reach)
            for a, b in zip(self.starts[j][hit], self.starts[j][hit + 1]) if len(hit) < 64 else ():
                seen[self.order[a:b, j]] = True
            if len(hit) >= 64:
                held = np.zeros(len(value) + 1, np.int8)
                held[hit] = 1
                seen[self.order[np.repeat(held[:-1], np.diff(self.starts[j])).astype(bool), j]] = True
        rows = np.flatnonzero(seen)
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(axis=1) <= radius]


def sample_of(rows: DataFrame, cfg: HashConfig) -> np.ndarray:
    """The sample's vectors of the most frequent length (at most ``cfg.sample`` rows reach the driver)."""
    got = [r["vec"] for r in rows.orderBy(F.xxhash64("id"), "id").limit(cfg.sample).select("vec").collect()]
    if not got:
        return np.zeros((0, 1))
    sizes, counts = np.unique([len(x) for x in got], return_counts=True)
    return np.array([x for x in got if len(x) == sizes[counts.argmax()]])


def search(vectors: DataFrame, cfg: HashConfig = HashConfig(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row."""
    scratch = Scratch(vectors.sparkSession)
    rows = scratch.write(usable(vectors, id_col, vec_col, zeros=False).distinct(), "rows")
    code = learn(sample_of(rows, cfg), cfg) if rows.limit(1).count() else None
    index = scratch.write(distinct_vectors(rows, cfg.k), "index")
    queries = rows.where(F.pmod("id", F.lit(cfg.every)) == 0).select(F.col("id").alias("qid"), "vec")
    q, v, _, _ = deal(queries, index, cfg.block_queries, cfg.block_vectors)

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], []]
        ql = np.array([len(x) for x in left.column("vec")], np.int64)
        vl = np.array([len(x) for x in right.column("vec")], np.int64)
        for n in np.intersect1d(ql, vl):
            a, b = left.take(np.flatnonzero(ql == n)), right.take(np.flatnonzero(vl == n))
            own, ids = a.column("qid").to_numpy(), [np.array(x.as_py()) for x in b.column("ids")]
            x, y = matrix(a.column("vec")), matrix(b.column("vec"))
            coded = n == len(code.mean)          # other lengths have no code: all rows are reranked
            if coded:
                book = Directory(encode(y, code), cfg)
                codes = encode(x, code)
                parts = book.split(codes)
            for i in range(len(own)):
                radius, cols = code.radius, np.arange(len(y))
                while coded:
                    cols = book.within(codes[i], parts[i], radius)
                    if len(cols) > cfg.k or radius >= cfg.bits:
                        break
                    radius += cfg.substrings
                score = (y[cols] @ x[i])[None, :]
                r, c, s = top_of(score, [ids[z] for z in cols], own[i:i + 1], cfg.k)
                out[0].append(np.full(len(r), own[i]))
                out[1].append(c)
                out[2].append(s)
        cat = lambda z, t: np.concatenate(z).astype(t) if z else np.zeros(0, t)
        return pa.table({"query_id": cat(out[0], np.int64), "vec_id": cat(out[1], np.int64), "score": cat(out[2], np.float64)})

    found = against(q, v, match, "query_id long, vec_id long, score double").distinct()
    return best(found, cfg.k)
