import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import config as C
from tessera.operators import dedup as DD


def brute_greedy(members):
    """Sequential first-wins: a doc is dropped iff it shares a bucket with an earlier kept doc."""
    by_doc = {}
    for src, rank, band, bucket in members:
        by_doc.setdefault((src, rank), []).append((band, bucket))
    taken, out = set(), {}
    for key in sorted(by_doc):
        bs = {(key[0],) + b for b in by_doc[key]}
        if bs & taken:
            out[key] = False
        else:
            out[key] = True
            taken |= bs
    return out


def test_greedy_matches_sequential(spark):
    rng = random.Random(11)
    for trial in range(3):
        rows = []
        for src in ("a", "b"):
            for r in range(120):
                for b in range(3):
                    hot = rng.random() < 0.3
                    rows.append((src, r, b, "hot" if hot and b == 0 else str(rng.randint(0, 40))))
        df = spark.createDataFrame(rows, "source string, r int, band int, bucket string") \
            .select("source", DD.order_key(F.lit(0), F.col("r")).alias("rank"), "band", "bucket")
        got = {(x.source, x.rank): x.kept for x in DD.greedy_first_wins(df.repartition(7)).collect()}
        want = brute_greedy(rows)
        assert got == want, trial


def test_near_dup_chain_and_copies(spark):
    base = " ".join(f"w{i}" for i in range(60))
    docs = [
        (0, base),                                   # A
        (1, base),                                   # exact copy of A -> near dup
        (2, " ".join(f"v{i}" for i in range(60))),   # unrelated -> kept
        (3, ""),                                     # no words -> sentinel signature
        (4, "one two three"),                        # < 5 words -> one shingle
        (5, ""),                                     # second wordless doc collides with doc 3
    ]
    df = spark.createDataFrame([("s", 0, p, t) for p, t in docs], "source string, shard int, pos long, text string")
    got = {r.pos: r.near_dup for r in DD.near_duplicates(df).collect()}
    assert got == {0: False, 1: True, 2: False, 3: False, 4: False, 5: True}


def test_exact_first_wins_per_shard(spark):
    rows = [("s", 0, 1, "Hello  World"), ("s", 0, 2, "hello world"), ("s", 1, 3, "HELLO world"),
            ("s", 0, 4, "other")]
    df = spark.createDataFrame(rows, "source string, shard int, pos long, text string")
    got = {r.pos: r.is_first for r in DD.exact_firsts(df, "shard").collect()}
    assert got == {1: True, 2: False, 3: True, 4: True}
    got = {r.pos: r.is_first for r in DD.exact_firsts(df, "source").collect()}
    assert got == {1: True, 2: False, 3: False, 4: True}


def test_decontamination_13_words(spark):
    from tessera.operators import decontam as DC
    bench = spark.createDataFrame([(1, " ".join(f"b{i}" for i in range(20)), ["ignored list"])],
                                  "item_id long, text string, tags array<string>")
    grams = DC.contamination_grams(DC.benchmark_text(bench))
    assert grams.count() == 20 - C.DECONTAM_NGRAM + 1
    docs = spark.createDataFrame([
        (1, "x " + " ".join(f"b{i}" for i in range(13))),   # shares one 13-gram
        (2, " ".join(f"b{i}" for i in range(12))),          # only 12 words
        (3, "B0 b1 b2 b3 b4 b5 b6 b7 b8 b9 b10 b11 b12"),    # case-insensitive words
    ], "pos long, text string")
    hit = {r.pos for r in DC.contaminated_keys(docs, grams, ["pos"]).collect()}
    assert hit == {1, 3}


@pytest.mark.parametrize("max_bits", [28, 10])
def test_decontamination_equals_the_plain_version(spark, max_bits):
    """A gram in a third of all documents; a bit table so full that it lets most grams pass; keys named like inner columns."""
    from tessera.operators import decontam as DC
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(400)}"
    items = [[word() for _ in range(rng.randrange(5, 80))] for _ in range(60)]
    hot = items[0] = [word() for _ in range(20)]
    docs = []
    for k in range(300):
        text = [word() for _ in range(rng.randrange(0, 60))]
        if k % 3 == 0:
            text += hot[:13 + k % 5]
        elif k % 7 == 0:
            text += rng.choice(items)[:rng.randrange(10, 20)]
        docs.append((k % 2, k, None if k % 50 == 49 else " ".join(text)))
    grams = lambda t: {tuple(t[i:i + 13]) for i in range(len(t) - 12)}
    known = set().union(*(grams(t) for t in items))
    want = {(a, k) for a, k, t in docs if t and grams(t.split()) & known}
    bench = spark.createDataFrame([(" ".join(t),) for t in items], "text string")
    df = spark.createDataFrame(docs, "gram int, _salt int, text string").repartition(4)
    got = DC.contaminated_keys(df, DC.contamination_grams(bench), ["gram", "_salt"], max_bits=max_bits)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want and len(want) > 100
    none = DC.contaminated_keys(df, DC.contamination_grams(bench.limit(0)), ["gram", "_salt"])
    assert none.columns == ["gram", "_salt"] and none.count() == 0


def test_benchmark_sets_take_test_rows_or_else_train_rows(spark):
    from tessera.operators import decontam as DC
    a = spark.createDataFrame([("test", "a one"), ("train", "a two"), ("dev", "a three")], "split string, text string")
    b = spark.createDataFrame([("train", "b one", "more"), ("dev", "b two", "x")], "split string, question string, answer string")
    c = spark.createDataFrame([(1, "c one")], "n int, text string")
    assert sorted(r.text for r in DC.benchmark_sets([a, b, c]).collect()) == ["a one", "b one more", "c one"]


def test_bit_table_never_loses_a_hash(spark):
    from tessera.functions import bits as B
    hashes = [0, 1, -1, 1 << 62, -(1 << 63), *(random.Random(1).getrandbits(64) - (1 << 63) for _ in range(2000))]
    for most in (10, 28):
        shared = B.bit_table(spark.createDataFrame([(h,) for h in hashes], "h bigint"), "h", most)
        assert B.may_hold(shared.value, np.array(hashes)).all()
    others = np.array([random.Random(2).getrandbits(64) - (1 << 63) for _ in range(1)] + list(range(5, 5000)))
    assert B.may_hold(shared.value, others * 0x9E3779B97F4A7).mean() < 0.1


def test_raw_records_from_files(spark):
    from tessera.sources.tables import raw_records_from_files
    from tests.conftest import SF001
    p = f"{SF001}/documents.parquet"
    df = raw_records_from_files(spark, [p, f"{SF001}/benchmark.parquet"], "x", "text")
    n_docs = spark.read.parquet(p).count()
    n_bench = spark.read.parquet(f"{SF001}/benchmark.parquet").count()
    got = df.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max("pos").alias("mx")).orderBy("shard").collect()
    # shards follow sorted path order: benchmark.parquet < documents.parquet
    assert [(r.shard, r.n, r.mx) for r in got] == [(0, n_bench, n_bench - 1), (1, n_docs, n_docs - 1)]


def test_minhash_kernels_agree(spark):
    from tests.conftest import SF001
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(-1, ""), (-2, "a b c")], "doc_id long, text string"))
    a = {r.doc_id: list(r.sig) for r in DD.with_signature(docs, "text", kernel="numpy").collect()}
    b = {r.doc_id: list(r.sig) for r in DD.with_signature(docs, "text", kernel="native").collect()}
    assert a == b
    assert a[-1] == [DD.EMPTY_SIGNATURE_VALUE] * C.MINHASH_PERM


def test_minhash_kernel_reads_the_text_alone(spark):
    """Equal to the native form on odd texts, with no shingle strings or digests made in the JVM."""
    texts = ["", "...", "one", "One  two", "a b c d e", "a b c d e f", "\u212A \u0130 É x1-y2\x1fz", "w " * 9000, " ".join(map(str, range(6000)))]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    fast, native = (DD.with_signature(df, "text", kernel=k).select("id", "sig") for k in ("numpy", "native"))
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, native.collect()))
    assert "md5" not in fast._jdf.queryExecution().optimizedPlan().toString()
