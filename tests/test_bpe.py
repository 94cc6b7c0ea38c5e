import json
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import bpe as B
from tests.conftest import SF001

TEXTS = ["Seven grey herons stood in the shallow water below the mill.",
         "On Tuesday 14 ferries left the harbour; 3 of them turned back.",
         "Über café naïve résumé — 2024: the the the the end.", "aaaa aaaa bbb ab ab ab"]


def library(texts, size):
    """(tokenizer, merges as pairs of ids) of the installed package."""
    tokenizers = pytest.importorskip("tokenizers")
    tok = tokenizers.Tokenizer(tokenizers.models.BPE(unk_token="<|unk|>"))
    tok.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False)
    tr = tokenizers.trainers.BpeTrainer(vocab_size=size, special_tokens=list(B.SPECIALS),
                                        initial_alphabet=tokenizers.pre_tokenizers.ByteLevel.alphabet(), show_progress=False)
    tok.train_from_iterator(texts, trainer=tr)
    j = json.loads(tok.to_str())
    v = j["model"]["vocab"]
    return tok, [(v[a], v[b]) for a, b in (x if isinstance(x, list) else x.split(" ") for x in j["model"]["merges"])]


def plain_merges(counts, size):
    """One merge at a time, all pairs recounted."""
    words = [([B.BYTE_IDS[b] for b in w.encode()], n) for w, n in counts.items()]
    out, nid = [], B.FIRST_MERGE_ID
    while nid < size:
        c = Counter()
        for w, n in words:
            for p in zip(w, w[1:]):
                c[p] += n
        if not c:
            break
        (l, r), n = min(c.items(), key=lambda x: (-x[1], x[0]))
        out.append((l, r, nid, n))
        for w, _ in words:
            i = 0
            while i < len(w) - 1:
                if (w[i], w[i + 1]) == (l, r):
                    w[i:i + 2] = [nid]
                i += 1
        nid += 1
    return out


def test_bpe_small_corpus_order(spark):
    df = spark.createDataFrame([("ab ab cd cd aaa zy zy",)], "text string")
    m = B.train_bpe(B.pretoken_counts(df), B.FIRST_MERGE_ID + 8)
    tb = B.vocab_bytes(m)
    assert [(tb[l], tb[r]) for l, r, _, _ in m] == [
        (b"a", b"a"), (b"a", b"b"), (b"c", b"d"), (b"z", b"y"), (b" ", b"cd"), (b" ", b"zy"), (b" ", b"aa"), (b" ", b"ab")]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=12), st.integers(1, 5)), min_size=1, max_size=12, unique_by=lambda x: x[0]))
def test_rounds_and_changes_equal_single_merges(words):
    """The driver's head and one block, without Spark: batches of merges, signed changes, left to right."""
    syms = np.concatenate([np.array([*(B.BYTE_IDS[b] for b in w.encode()), -1], np.int32) for w, _ in words])
    n = np.array([c for _, c in words], np.int64)
    weight = lambda s: np.repeat(n, np.diff(np.flatnonzero(s == -1), prepend=-1))
    table = lambda keys, c: __import__("pyarrow").table({"l": keys >> 32, "r": keys & 0xFFFFFFFF, "c": c})
    head = B.PairHead(1000)
    head.change(table(*B._pair_sums(syms, weight(syms))))
    got, size = [], B.FIRST_MERGE_ID + 40
    while True:
        some = head.batch(B.FIRST_MERGE_ID + len(got), size)
        if not some:
            break
        got += some
        order = sorted((l << 32 | r, i) for l, r, i, _ in some)
        syms, keys, change = B.merge_block(syms, n, np.array([k for k, _ in order]), np.array([i for _, i in order], np.int32))
        gone = {l << 32 | r for l, r, *_ in some}
        still = np.array([k not in gone for k in keys], bool)
        head.change(table(keys[still], change[still]))
        keys, sums = B._pair_sums(syms, weight(syms))
        assert head.counts == {(int(k >> 32), int(k & 0xFFFFFFFF)): int(c) for k, c in zip(keys, sums)}
    assert got == plain_merges(dict(words), size)


def test_small_head_and_blocks_give_the_same_merges(spark, monkeypatch):
    """The head runs empty again and again, words lie in many blocks, the blocks are written every other round."""
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice(["th", "e", "an", "é", "ing", "o"]) for _ in range(rng.randrange(1, 5))) for _ in range(30)) for _ in range(20)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = B.pretoken_counts(df)
    pack = B.pack_words
    monkeypatch.setattr(B, "pack_words", lambda c: pack(c, block_words=16))
    m = B.train_bpe(counts, B.FIRST_MERGE_ID + 60, head=7, write_every=2)
    assert m == plain_merges({r.pretoken: r.n for r in counts.collect()}, B.FIRST_MERGE_ID + 60)


def test_training_ends_when_no_pair_is_left(spark):
    df = spark.createDataFrame([("ab ab",)], "text string")
    assert len(B.train_bpe(B.pretoken_counts(df))) == 2 and B.train_bpe(B.pretoken_counts(df.limit(0))) == []


def test_bpe_matches_library_and_roundtrips(spark):
    texts = TEXTS * 3
    df = spark.createDataFrame([(t,) for t in texts] + [(None,), ("",), ("<|eos|> x",)], "text string")
    m = B.train_bpe(B.pretoken_counts(df.limit(len(texts))), B.FIRST_MERGE_ID + 60)
    tok, theirs = library(texts, B.FIRST_MERGE_ID + 60)
    assert [(l, r) for l, r, _, _ in m] == theirs
    out = df.select("text", B.encode_column(F.col("text"), m).alias("ids")).select(
        "text", "ids", B.decode_column(F.col("ids"), m).alias("back")).collect()
    for r in out:
        if r.text is None:
            assert r.ids is None and r.back is None
            continue
        assert r.back == r.text
        if "<|" not in r.text:
            assert list(r.ids) == tok.encode(r.text).ids
    # ids of a part of a character are no text
    bad = spark.createDataFrame([([B.BYTE_IDS[0xC3], B.BYTE_IDS[65], B.EOS_ID],)], "ids array<int>")
    assert bad.select(B.decode_column(F.col("ids"), m)).first()[0] == "�A<|eos|>"


def test_merges_of_given_documents_equal_the_library(spark):
    """A thousand merges over the small table, several writes of the blocks."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select(F.regexp_replace("text", "\\s+", " ").alias("text")).where("text <> ''")
    size = B.FIRST_MERGE_ID + 1000
    m = B.train_bpe(B.pretoken_counts(docs), size, head=3000)
    tok, theirs = library([r.text for r in docs.collect()], size)
    assert [(l, r) for l, r, _, _ in m] == theirs
    got = docs.select("text", B.encode_column(F.col("text"), m).alias("ids")).collect()
    assert all(list(r.ids) == tok.encode(r.text).ids for r in got)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=12), st.integers(1, 5)), min_size=1, max_size=12, unique_by=lambda x: x[0]),
       st.integers(1, 12))
def test_settled_rounds_equal_single_merges(words, some):
    """Overlapping merges of a round, settled on the runs of the first pairs alone, and the blocks rewritten in their order."""
    import pyarrow as pa
    syms = np.concatenate([np.array([*(B.BYTE_IDS[b] for b in w.encode()), -1], np.int32) for w, _ in words])
    n = np.array([c for _, c in words], np.int64)
    weight = lambda s: np.repeat(n, np.diff(np.flatnonzero(s == -1), prepend=-1))
    head = B.PairHead(1000)
    table = lambda keys, c: pa.table({"l": keys >> 32, "r": keys & 0xFFFFFFFF, "c": c})
    head.change(table(*B._pair_sums(syms, weight(syms))))
    got, size = [], B.FIRST_MERGE_ID + 40
    while head.counts and B.FIRST_MERGE_ID + len(got) < size:
        chosen, bound = head.first(some)
        runs = Counter()
        for w, c in zip(np.split(syms, np.flatnonzero(syms == -1) + 1), n):
            k = 0
            while k < len(w) - 1:
                e = k
                while e < len(w) - 1 and (w[e], w[e + 1]) in chosen:
                    e += 1
                if e > k:
                    runs[w[k:e + 1].tobytes()] += int(c)
                k = max(e, k + 1)
        made = B.settle(runs.items(), bound, B.FIRST_MERGE_ID + len(got), size)
        assert made
        got += made
        order = sorted((l << 32 | r, i) for l, r, i, _ in made)
        syms, keys, change = B.merge_block(syms, n, np.array([k for k, _ in order]), np.array([i for _, i in order], np.int32))
        head.change(table(keys, change))
        keys, sums = B._pair_sums(syms, weight(syms))
        assert head.counts == {(int(k >> 32), int(k & 0xFFFFFFFF)): int(c) for k, c in zip(keys, sums)}
    assert got == plain_merges(dict(words), size)


def test_training_takes_few_rounds(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("text")
    rounds, merge = [], B.merge_round
    monkeypatch.setattr(B, "merge_round", lambda blocks, accepted: rounds.append(len(accepted)) or merge(blocks, accepted))
    assert len(B.train_bpe(B.pretoken_counts(docs), B.FIRST_MERGE_ID + 600)) == 600
    assert len(rounds) <= 12


def test_few_runs_allowed_give_the_same_merges(spark):
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice(["th", "e", "an", "aa", "ing", "o"]) for _ in range(rng.randrange(1, 5))) for _ in range(30)) for _ in range(20)]
    counts = B.pretoken_counts(spark.createDataFrame([(t,) for t in texts], "text string"))
    m = B.train_bpe(counts, B.FIRST_MERGE_ID + 40, head=9, write_every=3, first_pairs=4, max_runs=6)
    assert m == plain_merges({r.pretoken: r.n for r in counts.collect()}, B.FIRST_MERGE_ID + 40)
