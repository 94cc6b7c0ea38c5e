"""Near-dedup, nearest neighbours and exact top-k against brute force; the pipeline's stages."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001, SF01
from tests.llm.test_text_operators import empty_documents, odd_documents
from tessera.llm import hashing, neardup, topk
from tessera.llm.common import read


def brute_components(docs, k, percent=80):
    """{doc_id: (set size, component)} by comparing all pairs that share a shingle."""
    sets = {}
    for i, text in docs:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        import re
        w = re.findall(r"[^\x20\x09-\x0D]+", w)
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    holders, pairs = {}, set()
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    for ids in holders.values():
        pairs.update(combinations(sorted(ids), 2))
    comp = {i: i for i in sets}

    def top(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((top(a), top(b)))
            comp[y] = x
    return {i: (len(sets[i]), top(i)) for i in sets}


def near_copies(seed, groups=3, size=40, words=70):
    """Groups of copies with a few words changed each, around the threshold, and unrelated documents."""
    rng = random.Random(seed)
    rows, i = [], 0
    for g in range(groups):
        base = [f"g{g}w{j}" for j in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4])):
                copy[rng.randrange(words)] = f"x{rng.randrange(10 ** 6)}"
            rows.append((i, " ".join(copy)))
            i += 1
    for _ in range(60):
        rows.append((i, " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(words))))
        i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("cfg", [
    neardup.NearConfig(words=4),                                     # pairs
    neardup.NearConfig(words=4, leaf=8, block=10),                   # several blocks a component
    neardup.NearConfig(words=4, leaf=4, block_limit=12, block=8, depth=2, broadcast_ids=0),   # pivots, branching, then blocks
])
def test_components_equal_brute_force(spark, cfg):
    rows = near_copies(cfg.leaf)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), cfg).collect()}
    assert got == brute_components(rows, 4)


def test_components_of_the_fixture(spark):
    docs = read(spark, SF001, "documents")
    for k in (4, 5):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in
               neardup.near_duplicates(docs, neardup.NearConfig(words=k)).collect()}
        assert got == brute_components([(r.doc_id, r.text) for r in docs.collect()], k)


def test_odd_documents(spark):
    odd = odd_documents(spark)
    rows = neardup.near_duplicates(odd, neardup.NearConfig(words=4)).collect()
    assert len(rows) == 9
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows}
    assert (7, 1, 1, False) in got and (2, 0, 2, True) in got and (3, 0, 3, True) in got and (5, 0, 5, True) in got
    assert (None, 1, None, True) in got
    kept = neardup.dedup(odd, neardup.NearConfig(words=4))
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x)) == [1, 2, 3, 4, 5, 6, None]
    assert neardup.near_duplicates(empty_documents(spark)).count() == 0
    assert neardup.dedup(empty_documents(spark)).count() == 0


def test_links_of_a_group_named_by_many_documents(spark):
    """20 nodes of the same 1,000 documents, each a star around another one: about a link a document is left, the components stay."""
    links = spark.range(20, 1000).selectExpr("explode(sequence(0L, 19L)) AS a", "id AS b").union(
        spark.createDataFrame([(5000, 4000), (4000, 5000), (7, 7), (4500, 5000)], "a long, b long"))
    left = [tuple(r) for r in neardup.contracted(links).distinct().collect()]
    assert len(left) < 1200 and all(a < b for a, b in left)
    got = {r.id: r.comp for r in neardup.components(links, neardup.Scratch(spark), "t").collect()}
    assert got == {**{i: 0 for i in range(1000)}, **{i: 4000 for i in (4000, 4500, 5000)}}


def test_components_of_a_long_chain(spark):
    from tessera.llm.common import Scratch
    edges = [(i, i + 1) for i in range(0, 90)] + [(200, 201), (300, 202), (202, 201)]
    random.Random(1).shuffle(edges)
    got = {r.id: r.comp for r in neardup.components(
        spark.createDataFrame(edges, "a long, b long"), Scratch(spark), "chain").collect()}
    assert all(got[i] == 0 for i in range(91)) and got[300] == got[202] == got[201] == got[200] == 200


# --- vectors ----------------------------------------------------------------------------------------------------

def vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(230)]
    rows += [(300 + i, rows[50][1]) for i in range(30)] + [(300, rows[50][1])]      # one vector many times; a repeated row
    rows += [(400, None), (450, []), (500, [float("nan")] * 8), (550, [None] + [1.0] * 7), (600, [0.0] * 8), (650, [1.0, 2.0]),
             (700, [float("inf")] + [0.0] * 7), (None, [1.0] * 8)]
    return spark.createDataFrame([(*r, "s", 1) for r in rows], "vec_id long, embedding array<double>, score string, rank int"), rows


def brute_top(rows, every, k, value, zeros):
    good = {i: v for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
            and (zeros or any(v))}
    out = set()
    for q, x in good.items():
        if q % every == 0:
            scored = sorted((-value(x, y), i) for i, y in good.items() if i != q and len(x) == len(y))
            out |= {(q, r + 1, i, round(-s, 9)) for r, (s, i) in enumerate(scored[:k])}
    return out


def as_set(df):
    return {(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in df.collect()}


@pytest.mark.parametrize("blocks", [(1024, 8192), (3, 40)])
def test_top_k_is_exact(spark, blocks):
    df, rows = vectors(spark)
    cfg = topk.TopConfig(every=10, block_queries=blocks[0], block_vectors=blocks[1])
    floor = lambda v: [int(np.floor(256 * x)) for x in v]
    want = brute_top(rows, 10, 5, lambda a, b: sum(x * y for x, y in zip(floor(a), floor(b))), True)
    assert as_set(topk.search(df, cfg)) == want


def test_top_k_of_huge_components(spark):
    rows = [(0, [2.0 ** 30, 1.0]), (1, [2.0 ** 30, 3.0]), (2, [2.0 ** 30, 2.0]), (3, [-1.0, 5.0])]
    got = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), topk.TopConfig()).collect()
    assert [r.vec_id for r in got] == [1, 2, 3]
    assert got[0].score == min(2 ** 76 + 768 * 256, 2 ** 63 - 1)
    assert topk.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("blocks", [(1024, 16384), (4, 50)])
def test_nearest_small(spark, blocks):
    df, rows = vectors(spark)
    cfg = hashing.HashConfig(every=10, k=20, bits=32, substrings=4, block_queries=blocks[0], block_vectors=blocks[1])
    want = brute_top(rows, 10, 20, lambda a, b: float(np.dot(a, b)), False)
    got = as_set(hashing.search(df, cfg))
    assert len(got) == len(want)                         # every query has as many as there are
    pairs = lambda s: {(q, i) for q, _, i, _ in s}
    assert len(pairs(got) & pairs(want)) >= 0.8 * len(want)
    assert hashing.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_nearest_recall(spark):
    df = read(spark, SF01, "embeddings")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    want = {(q, i) for q, _, i, _ in brute_top(rows, 20, 20, lambda a, b: float(np.dot(a, b)), False)}
    got = hashing.search(df).collect()
    assert len({(r.query_id, r.vec_id) for r in got} & want) >= 0.9 * len(want)
    v = dict(rows)
    assert all(abs(r.score - np.dot(v[r.query_id], v[r.vec_id])) < 1e-12 for r in got)


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(6)
    cfg = hashing.HashConfig(bits=64, substrings=4)
    codes = np.packbits(rng.random((700, 64)) < 0.5, axis=1)
    codes[:40] = codes[0] ^ np.packbits(rng.random((40, 64)) < 0.1, axis=1)
    book = hashing.Directory(codes, cfg)
    for radius in (0, 3, 9, 20, 30):
        for q in (0, 5, 99):
            want = np.flatnonzero(np.bitwise_count(codes ^ codes[q]).sum(axis=1) <= radius)
            assert np.array_equal(book.within(codes[q], book.split(codes)[q], radius), want)


# --- pipeline ---------------------------------------------------------------------------------------------------

def test_pipeline_stages(spark):
    import corpus_pipeline as P
    from tessera.llm.common import Scratch
    scratch, docs = Scratch(spark), read(spark, SF01, "documents")
    kept = []
    for k, (_, stage) in enumerate(P.STAGES):
        out = scratch.write(stage(spark, docs, SF01), f"t{k}")
        if k < 4:
            assert out.columns == P.COLUMNS
            kept.append([(r.doc_id, r.text, r.source) for r in out.collect()])
            docs = out
    quality, lines, near, mixed = kept
    marks = {r.doc_id: r.quality for r in read(spark, SF01, "labels").collect()}
    gone = {r.doc_id for r in read(spark, SF01, "documents").collect()} - {i for i, *_ in quality}
    good = [i for i, q in marks.items() if q == 1]
    assert sum(i in gone for i in good) <= 0.02 * len(good)
    assert len(lines) == len(quality) and sum(len(t) for _, t, _ in lines) < sum(len(t) for _, t, _ in quality)
    want = brute_components([(i, t) for i, t, _ in lines], 5)
    assert sorted(i for i, *_ in near) == sorted(i for i in want if want[i][1] == i)
    assert {i for i, *_ in mixed} <= {i for i, *_ in near}
    assert sum(r.length for r in out.collect()) >= len(mixed)
    assert {r.doc_id for r in out.select("doc_id").collect()} == {i for i, *_ in mixed}


def test_pipeline_stages_on_odd_rows(spark):
    import corpus_pipeline as P
    for docs in (odd_documents(spark), empty_documents(spark)):
        for _, stage in P.STAGES:
            assert stage(spark, docs, SF001).count() >= 0
