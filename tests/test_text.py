"""Cleaning rules against rows worked out by hand, and properties of the rules."""

import random
import re

from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators.clean import clean_documents

LINE40 = "abcdefghij" * 4
OTHER40 = "klmnopqrst" * 4


def _map(spark, texts, fn):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r.t for r in df.select("id", fn(F.col("text")).alias("t")).collect()}
    return [got[i] for i in range(len(texts))]


def _reasons(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "pos long, text string").select(
        F.lit("s").alias("source"), F.lit(0).alias("shard"), "pos", "text")
    got = {r.pos: (r.reason, r.clean_chars) for r in clean_documents(df, None, None).collect()}
    return [got[i] for i in range(len(texts))]


def test_line_filter_by_hand(spark):
    cases = [
        ("", ""),
        ("\n\n", ""),
        (LINE40[:39], ""),                                  # one character short
        (LINE40, LINE40),
        ("a" * 28 + "." * 12, ""),                          # 1.0 - 28/40 is just over 0.30 in double
        ("a" * 29 + "." * 11, "a" * 29 + "." * 11),
        ("x" * 20 + " " + "y" * 20, "x" * 20 + " " + "y" * 20),
        ("x" * 20 + " \t  " + "y" * 20, "x" * 20 + " " + "y" * 20),     # inner white space becomes one blank
        ("  " + LINE40 + "  ", LINE40),
        ("é" * 40, ""),                                     # not ASCII letters
        (LINE40 + "\nshort\n" + OTHER40, LINE40 + "\n" + OTHER40),
    ]
    assert _map(spark, [c for c, _ in cases], X.filter_lines) == [w for _, w in cases]


def test_every_line_separator_splits(spark):
    seps = ["\n", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", " ", " "]
    got = _map(spark, [LINE40 + s + OTHER40 for s in seps], X.filter_lines)
    assert got == [LINE40 + "\n" + OTHER40] * len(seps)
    # the unit separator and a zero-width space are no line ends
    for inner in ("\x1f", "​"):
        assert "\n" not in _map(spark, [LINE40 + inner + OTHER40], X.filter_lines)[0]


def test_boilerplate_by_hand(spark):
    cases = [
        ("FORM 10-K\nreal line", "real line"),
        ("formal 10-K", "formal 10-K"),
        ("Page 3 of 10", ""),
        ("page 3 of ten", "page 3 of ten"),
        ("Table of Contents", ""),
        ("all rights", "all rights"),
        ("xx", "xx"),
        ("", ""),
        ("a\nb", "a\nb"),
    ]
    assert _map(spark, [c for c, _ in cases], X.strip_boilerplate) == [w for _, w in cases]


def test_gates_by_hand(spark):
    distinct = " ".join(f"word{i:04d}" for i in range(80))                # 719 characters, no repeated 4-gram
    same = " ".join(["tiger lily river stone"] * 30)                       # four different 4-grams
    accents = " ".join(f"caféwor{i:04d}" for i in range(80))          # a little under 0.95 ASCII
    got = _reasons(spark, [distinct, LINE40, same, accents, ""])
    assert got[0] == ("kept", len(distinct))
    assert got[1] == ("too_short", 40)
    assert got[2] == ("repetitive", len(same))
    assert got[3][0] == "non_english"
    assert got[4] == ("too_short", 0)


def test_length_gate_edges(spark):
    words = " ".join(f"v{i:03d}" for i in range(200))
    text = lambda n: words[:n - 1] + "z"
    got = _reasons(spark, [text(599), text(600), text(601)])
    assert got == [("too_short", 599), ("kept", 600), ("kept", 601)]


def test_repetition_exact_half_and_short(spark):
    rows = ["a b c d a b c d",                      # 8 words, 5 grams, top share 1.0
            "w1 w2 w3 w4 w5 w6 w7",                  # 7 words: no ratio
            " ".join(f"w{i}" for i in range(40)),    # 37 different grams: 10 / 37
            " ".join(f"w{i}" for i in range(23))]    # 20 different grams: exactly one half
    df = spark.createDataFrame(list(enumerate(rows)), "id int, text string")
    got = {r.id: r._rep_ratio for r in X.with_repetition(df, "text").select("id", "_rep_ratio").collect()}
    assert got == {0: 1.0, 1: None, 2: 10 / 37, 3: 0.5}


def test_language_band(spark):
    from tessera.functions.text import english_by_ratio
    df = spark.createDataFrame([(0.90,), (0.95,), (0.99,), (0.89,), (0.951,)], "r double")
    got = [r.e for r in df.select(english_by_ratio(F.col("r")).alias("e")).collect()]
    assert got == [False, False, True, False, True]


def test_cleaning_is_idempotent_and_only_removes_lines(spark):
    rng = random.Random(7)
    vocab = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "theta", "x1", "foo", "bar"]
    texts = ["\n".join(" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 18))) for _ in range(rng.randint(1, 12)))
             for _ in range(60)]
    once = _map(spark, texts, X.filter_lines)
    assert _map(spark, once, X.filter_lines) == once
    for before, after in zip(texts, once):
        lines = before.split("\n")
        assert all(x in lines and len(x) >= 40 for x in after.split("\n") if x)


def test_nonalnum_share_without_a_regex_per_character(spark):
    cases = ["", "abc", "a b", "---", "\U0001F600a\u0301é9 Z", "aZ09" * 10 + ". ,;", "٣ａＡ\u212A"]
    plain = [1.0 if not t else 1.0 - sum(c.isascii() and c.isalnum() for c in t) / len(t) for t in cases]
    assert _map(spark, cases, X.nonalnum_ratio) == plain
    assert "regexp" not in str(X.nonalnum_ratio(F.col("t")))


def test_dedup_words_of_odd_texts(spark):
    cases = ["", " ", "...", "A-b  c", "\u212Aelvin \u0130x", " x\x1fy\u00a0z ", "é1é2", "a" * 50]
    plain = [re.findall("[a-z0-9]+", t.lower()) for t in cases]
    assert _map(spark, cases, X.dedup_words) == plain


def test_word_ngrams(spark):
    words = lambda t: X.word_ngrams_joined(X.whitespace_words(t), 3)
    assert _map(spark, ["", "a b", "a b c", "a b c d"], words) == [[], [], ["a b c"], ["a b c", "b c d"]]


def test_ascii_share_without_a_regex_per_character(spark):
    cases = ["", "abc", "\x00\x7f\x80", "é", "naïve \U0001F600 — ok", "\U00020BB7", "".join(map(chr, range(300)))]
    plain = [sum(c < "\x80" for c in t) / len(t) if t else 0.0 for t in cases]
    assert _map(spark, cases, X.ascii_ratio) == plain
    assert "regexp" not in str(X.ascii_ratio(F.col("t")))


def test_boilerplate_is_tried_at_the_line_start_alone(spark):
    assert X.BOILERPLATE.startswith("(?iU)^(?:")
    cases = [" Page 3 of 7", "see page 3 of 7", "a\nTable of Contents", "[x]", "y [x]", "the table of contents", "ALL RIGHTS RESERVED by us", "not all rights reserved"]
    assert _map(spark, cases, X.is_boilerplate) == [True, False, False, True, False, False, True, False]


def test_lines_of_texts_with_rare_breaks(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(["", "a\nb\n", "a\r\nb", "a\rb\x0bc\x0cd\x1ce\x1df\x1eg\x85h\u2028i\u2029j", "\n\r\n\n", "a\u0084b\nc"])], "i int, t string")
    got = {r.i: r.x for r in df.select("i", X.split_lines(F.col("t")).alias("x")).collect()}
    assert got == {0: [""], 1: ["a", "b", ""], 2: ["a", "b"], 3: list("abcdefghij"), 4: ["", "", "", ""], 5: ["a\u0084b", "c"]}
