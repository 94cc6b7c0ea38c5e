"""The language detector: trigram kernels against the native form, profiles and decisions against plain Python."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.functions.words import text_bytes
from tessera.operators import lang as LG

ODD = ["", "a", "ab", "a b", "The cat, the hat. THE bat!", "éè ß Σας İI", "\U00020BB7\U0001D400x y", "x\U00020BB7 \U00020BB8z",
       "\U00010400\U00010401", "\U0001F600 ab", "1234 --", "中文 字 かな", "áb\x00c\td\n e", None, "zz " * 50]


def _native(spark, texts, sample=None):
    """(letter text, its trigrams by the regex) of each text; None for none."""
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", LG.letter_text(F.col("t"), sample).alias("t"))
    rows = df.select("i", "t", LG.char_ngrams(F.col("t")).alias("g")).collect()
    return [(r.t, r.g) for r in sorted(rows, key=lambda r: r.i)]


@pytest.mark.parametrize("piece, cells", [(1 << 18, 1 << 20), (7, 1 << 20), (1 << 18, 0), (5, 0)])
def test_counted_trigrams_are_those_of_the_regex(spark, monkeypatch, piece, cells):
    monkeypatch.setattr(LG, "SLICE_BYTES", piece)
    monkeypatch.setattr(LG, "TABLE_CELLS", cells)
    native = _native(spark, ODD)
    codes, times = LG._counted(text_bytes(pa.array([t for t, _ in native], pa.string()))[0])
    assert dict(zip(LG._as_text(codes).to_pylist(), times.tolist())) == Counter(g for _, gs in native for g in gs or [])
    assert (LG._as_codes(LG._as_text(codes)) == codes).all() and (np.diff(codes) > 0).all()


@pytest.mark.parametrize("piece, cells", [(1 << 18, 1 << 20), (9, 1 << 20), (1 << 18, 0)])
def test_scores_of_odd_texts(spark, monkeypatch, piece, cells):
    monkeypatch.setattr(LG, "SLICE_BYTES", piece)
    monkeypatch.setattr(LG, "TABLE_CELLS", cells)
    native = _native(spark, ODD)
    delta = {(lang, g): 1.0 + k for k, (lang, g) in enumerate(sorted({(lang, g) for n, (_, gs) in enumerate(native) for g in gs or []
                                                                     for lang in "xyz"[:1 + n % 3]}))}
    rows = sorted((int(LG._as_codes(pa.array([g]))[0]), "wxyz".index(lang), d) for (lang, g), d in delta.items())
    columns = [np.array(c) for c in zip(*rows)]
    monkeypatch.setattr(LG, "_opened", lambda *_: columns)
    n, sums = LG._scored(pa.array([t for t, _ in native], pa.string()), LG.Published("", (), tuple("wxyz")))
    assert n.tolist() == [len(gs or []) for _, gs in native]
    assert sums.tolist() == [[sum(delta.get((lang, g), 0.0) for g in gs or []) for lang in "wxyz"] for _, gs in native]


TRAIN = [("en", "the cat and the hat and the bat that sat"), ("de", "der hund und die katze und das haus"), (None, "und the la"),
         ("fr", "le chat et la souris sont dans la maison"), ("en", "the end of the road"), ("xx", "..."), ("de", None), ("en", "1\U00010400\U00010401a")]
DOCS = [("a", 1, "the cat sat and that was the end"), ("a", 2, "der hund und die maus"), ("a", 3, "la maison et le chat"), ("b", 4, "..."),
        ("b", 5, "\U00010400\U00010401a \U00010400"), (None, 6, "the cat sat"), ("b", 7, "the"), ("b", 7, "der hund und die katze und"),
        ("b", 7, "und das"), (None, None, "la maison")]


def _expected(spark):
    """Decisions by sums over every single trigram."""
    counts, langs = Counter(), Counter()
    for (lang, _), (_, gs) in zip(TRAIN, _native(spark, [t or "" for _, t in TRAIN])):
        counts.update((lang, g) for g in gs)
        langs[lang] += len(gs)
    langs = {k: n for k, n in langs.items() if n}
    v = len({g for _, g in counts})
    unseen = {k: math.log(1.0 / (n + v)) for k, n in langs.items()}
    grams = [gs for _, gs in _native(spark, [t for *_, t in DOCS], 5_000)]
    out = []
    for (source, pos, _), own in zip(DOCS, grams):
        same = [] if source is None or pos is None else [g for (s, p, _), gs in zip(DOCS, grams) if (s, p) == (source, pos) for g in gs]
        score = {k: len(own) * unseen[k] + sum(math.log((counts[k, g] + 1) / (langs[k] + v)) - unseen[k] for g in same if k and counts[k, g])
                 for k in langs}
        best = min(score, key=lambda k: (-score[k], k or ""))
        out.append((source, pos, best, None if best is None else best == "en"))
    return sorted(out, key=str)


def test_decisions_with_repeated_and_null_keys(spark):
    profile, langs = LG.train_profiles(spark.createDataFrame(TRAIN, "lang string, text string"))
    assert profile.columns == ["lang", "gram", "delta"] and langs.columns == ["lang", "unseen"]
    docs = spark.createDataFrame(DOCS, "source string, pos bigint, t string")
    got = LG.detect(docs, ["source", "pos"], "t", profile, langs)
    assert sorted(map(tuple, got.collect()), key=str) == _expected(spark)


def test_no_row_per_trigram(spark):
    """Trigrams were exploded to a row each, and the documents' trigram arrays kept in memory and on disk."""
    texts = spark.createDataFrame([("en", "the cat and the hat " * 500)] * 8, "lang string, text string").coalesce(1)
    parts = LG.gram_counts(texts.select("lang", LG.letter_text(F.col("text"), None).alias("_t")))
    assert "explode" not in parts._jdf.queryExecution().optimizedPlan().toString().lower()
    assert sum(r.c for r in parts.collect()) == 8 * (len("the cat and the hat " * 500) - 1)
    profile, langs = LG.train_profiles(texts)
    plan = LG.detect(texts.withColumn("k", F.lit(1)), ["k"], "text", profile, langs)._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan and "explode" not in plan.lower()


def test_profile_in_several_files(spark, monkeypatch):
    monkeypatch.setattr(LG, "FILE_ROWS", 10)
    profile, langs = LG.train_profiles(spark.createDataFrame(TRAIN, "lang string, text string"))
    names = tuple(r.lang for r in langs.orderBy("lang").collect())
    table = LG.publish(profile, names)
    assert len(table.files) > 1
    held, lang, delta = LG._opened(table.key, table.files, names)
    got = sorted(zip((names[k] for k in lang), LG._as_text(held).to_pylist(), delta))
    assert (np.diff(held) >= 0).all() and got == sorted(map(tuple, profile.collect()))
