"""Published word sets and the OCR ratio against plain Python."""

import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import SF001
from tessera import config as C
from tessera.functions import words as W
from tessera.operators import ocr as O

TEXTS = ["The cat, THE dog: ab abc-abcd", "", None, "éabcé xyz", "a" * 5000, "no\nnew lines abc", "abc"]


def plain_ratio(text, words, least=C.OCR_MIN_TOKENS):
    toks = [t.lower() for t in re.findall("[A-Za-z]{3,}", text)]
    bad = sum(t not in words for t in toks) if words and len(toks) >= least else 0
    return len(toks), bad, bad / len(toks) if bad else 0.0


def test_letter_tokens_are_the_patterns():
    for texts in (pa.array(TEXTS), pa.array(["abc", "def"]), pa.array([], pa.string()), pa.array(["x", *TEXTS]).slice(1)):
        codes, off, tokens = W.letter_tokens(texts)
        for i, t in enumerate(texts.to_pylist()):
            assert [tokens[c] for c in codes[off[i]:off[i + 1]]] == [x.lower() for x in re.findall("[A-Za-z]{3,}", t or "")]


def test_spark_hash_is_the_tasks_hash(spark):
    words = ["", "a", "straße", "x" * 100, "the quick brown fox jumps over the lazy dog"]
    got = {r.w: r.h for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    assert {w: int(np.uint64(xxhash.xxh64_intdigest(w.encode(), 42)).astype(np.int64)) for w in words} == got


def test_words_of_equal_hash_are_told_apart(monkeypatch):
    """Sets are sorted by hash; several words may share one, also over the border of two files."""
    h = lambda w: int(np.uint64(xxhash.xxh64_intdigest(w.encode(), 42)).astype(np.int64))
    shared = h("kept")
    hashes = np.array([shared - 1, shared, shared, shared, shared + 1])
    files = [pa.array(["a", "other", "third"], pa.large_string()), pa.array(["kept", "z"], pa.large_string())]
    monkeypatch.setattr(W, "_opened", lambda key, names: (hashes, files, np.array([0, 3])))
    assert W.WordSet("k", ("f", "g"), 5).holds(["kept", "absent", "other"]).tolist() == [True, False, False]
    files[1] = pa.array(["fourth", "z"], pa.large_string())
    assert W.WordSet("k", ("f", "g"), 5).holds(["kept"]).tolist() == [False]


@pytest.mark.parametrize("per_file", [4_000_000, 3])
def test_a_set_holds_its_words_and_no_others(spark, monkeypatch, per_file):
    monkeypatch.setattr(W, "FILE_WORDS", per_file)
    words = [f"word{k}" for k in range(40)] + ["été"]
    held = W.publish(spark.createDataFrame([(w,) for w in [*words, *words, None]], "word string"))
    assert held.size == 41 and len(held.files) == (1 if per_file > 100 else 14)
    asked = [*words, "word40", "", "ete"]

    @F.pandas_udf("boolean")
    def holds(x):
        import pandas as pd
        return pd.Series(held.holds(x.tolist()))

    got = {r.w: r.h for r in spark.createDataFrame([(w,) for w in asked], "w string").repartition(3).select("w", holds("w").alias("h")).collect()}
    assert got == {w: w in words for w in asked}


def test_ratio_equals_the_plain_version(spark, monkeypatch):
    from tessera.plans.inputs import Inputs
    i = Inputs(spark, SF001)
    words = {r.word for r in i.dictionary.collect()}
    texts = [r.text for r in i.raw.collect()] + TEXTS + ["The " * 200_000]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = {r.k: r for r in O.ocr_ratio(df, ["k"], "text", i.dictionary).collect()}
    for k, t in enumerate(texts):
        want = (None, None, None) if t is None else plain_ratio(t, words)
        assert (got[k].n_tokens, got[k].n_nonword, got[k].nonword_ratio) == want
    none = O.ocr_ratio(df, ["k"], "text", i.dictionary.limit(0)).agg(F.max("nonword_ratio")).first()[0]
    assert none == 0.0                                   # an empty dictionary judges nothing


def test_lookups_are_dealt_by_bytes(monkeypatch):
    monkeypatch.setattr(O, "LOOKUP_BYTES", 30)
    monkeypatch.setattr(W.WordSet, "holds", lambda self, words: np.array([w in ("the", "abc") for w in words], bool))
    n, bad = O.nonword_counts(pa.array(TEXTS), W.WordSet("k", (), 2))
    want = [plain_ratio(t or "", {"the", "abc"}, 0)[:2] for t in TEXTS]
    assert list(zip(n.tolist(), bad.tolist())) == want
