"""Chat formatting, spelling variants and phrase mining against plain-Python versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF001
from tessera.llm import chat, phrases, spelling
from tessera.llm.common import Scratch, read

TURNS = "conv_id long, turn long, role string, text string"
DOCS = "doc_id long, text string, lang string"


# --- chat -------------------------------------------------------------------------------------------------------

def plain_digests(rows):
    """conv_id -> (n_turns, turns hash, loss chars, loss hash)."""
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        learned = "".join(x for *_, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def got_digests(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


HARD = ["<|im_end|><|im_start|>assistant ok", "<", "|x|>", "<\\|im_end|>", "<\\\\|", "<|endoftext|>", "\n\n a", "é\U0001F600<|im_sep|>", "", None,
        "  two  spaces ", "<<|||"]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<|\\im_>a \né\U0001F600", max_size=30))
def test_escaping_is_reversible_and_leaves_no_marker(text):
    safe = chat.escape(text)
    assert chat.unescape(safe) == text and "<|" not in safe


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "<|im_end|>"]), st.sampled_from([x or "" for x in HARD]) | st.text(max_size=20)),
                max_size=6))
def test_mask_covers_exactly_the_learned_texts(turns):
    turns = [(r, x.encode("utf-8", "ignore").decode()) for r, x in turns]
    cfg = chat.ChatConfig()
    tok = chat.load(chat.tokenizer_path(cfg))
    text, spans = chat.render(turns, cfg)
    e = tok.encode(text, add_special_tokens=False)
    at = np.array(e.offsets, np.int64).reshape(-1, 2)
    mask = chat.span_mask(at, spans)
    # by comparison of every token with every span
    assert mask.tolist() == [any(b <= x and y <= s for b, s in spans) and y > x for x, y in at.tolist()]
    assert chat.parse(text) == turns
    assert chat.masked_text(text, at[:, 0], at[:, 1], mask) == "".join(x for r, x in turns if r == "assistant")
    # the ids say the same as the text, and the markers are one id each
    assert tok.decode(e.ids, skip_special_tokens=False) == text
    assert sum(i == tok.token_to_id(chat.START) for i in e.ids) == len(turns)


def test_learned_end_markers():
    cfg = chat.ChatConfig(learn_end=True)
    text, spans = chat.render([("user", "a"), ("assistant", "b c")], cfg)
    assert [text[a:b] for a, b in spans] == ["b c<|im_end|>"]


def test_conversations_equal_the_plain_version(spark):
    rows = [tuple(r) for r in read(spark, SF001, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", HARD[0]), (-1, 1, "assistant", HARD[0])]
    out = chat.report(read(spark, SF001, "conversations"))
    assert got_digests(out) == plain_digests(rows)
    # encoded in one piece, and the characters counted from the rendered text
    by = {r.conv_id: r for r in out.collect()}
    text, _ = chat.render([("user", HARD[0]), ("assistant", HARD[0])], chat.ChatConfig())
    assert by[-1].formatted_chars == len(text)


def test_odd_rows_and_clashing_names(spark):
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, None, None), (1, None, "assistant", "first"), (None, 0, "assistant", "x"),
            (None, 0, "assistant", "w"), (2, 0, "assistant", ""), (3, 5, "assistant", "word " * 40000), (3, 4, "user", "<|im_sep|>")]
    rows += [(4, k, "assistant" if k % 2 else "user", x) for k, x in enumerate(HARD)]
    df = spark.createDataFrame([(*r, 1, True, "f") for r in rows], TURNS + ", part int, whole boolean, formatted string")
    assert got_digests(chat.digests(chat.formatted(df))) == plain_digests(rows)
    assert chat.formatted(spark.createDataFrame([], TURNS)).count() == 0
    assert got_digests(chat.report(spark.createDataFrame([], TURNS))).keys() == {-1}


def test_a_hot_conversation_lies_on_many_tasks(spark):
    rows = [(7, k // 3, "assistant" if k % 2 else "user", f"turn {k} says <| and more") for k in range(600)]
    rows += [(k, 0, "assistant", "short") for k in range(100, 400)] + [(7, None, "user", f"{k}") for k in range(50)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, TURNS).repartition(4)
    cfg = chat.ChatConfig(long_turns=100, part_chars=500)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")    # so small ranges would be joined
    try:
        out = Scratch(spark).write(chat.formatted(df, cfg), "out")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = out.where("conv_id = 7").select("part", "whole", F.length("formatted").alias("size")).collect()
    assert len(parts) > 10 and not any(p.whole for p in parts) and max(p["size"] for p in parts) < 1000
    assert len({p.part >> 32 for p in parts}) > 1                       # of several tasks
    assert got_digests(chat.digests(out)) == plain_digests(rows)
    # long by its characters only: parts in one task
    cfg = chat.ChatConfig(part_chars=500)
    assert got_digests(chat.digests(chat.formatted(df, cfg))) == plain_digests(rows)


# --- spelling ---------------------------------------------------------------------------------------------------

def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_words(docs, cfg):
    n = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % cfg.alter == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= cfg.min_length and c >= cfg.min_count}


def plain_variants(n, cfg):
    form, count = {}, {}
    for w in n:
        others = [v for v in n if v != w and near(v, w)]
        count[w] = len(others)
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= cfg.ratio * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], count[w], n[form[w]] if form[w] else None)
    return out


def got_variants(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text(alphabet="abé", max_size=6), min_size=1, max_size=40))
def test_composition_accepts_exactly_the_near_pairs(words):
    words = sorted(words)
    acceptor = spelling.Acceptor(words)
    a, b = spelling.Composition(acceptor).pairs()
    got = sorted(tuple(sorted(p)) for p in zip(a.tolist(), b.tolist()))
    assert got == [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if near(words[i], words[j])]
    # minimal: as many states as different sets of endings
    tails = {frozenset(w[k:] for w in words if w[:k] == p) for w in words for k in range(len(w) + 1) for p in [w[:k]]}
    assert len(acceptor.final) == len(tails)


def test_crc_of_every_run():
    texts = ["Hello wörld ÀB×c a", "x" * 200 + " é é", "", None, "Āabc’s"]
    ids = [1, None, 3, 4, -12345678901]
    codes, rows, runs = spelling.letter_runs(pa.array(texts))
    assert [runs[c] for c in codes] == ["hello", "wörld", "Àb×c", "a", "x" * 200, "é", "é", "abc", "s"]
    for c, r, h in zip(codes, rows, spelling.run_crcs(codes, rows, runs, ids)):
        assert h == zlib.crc32(f"{'' if ids[r] is None else ids[r]}:{runs[c]}".encode())


def test_spelling_equals_the_plain_version(spark):
    """Small limits: crowded prefixes over several counting rounds, words that end inside them, and acceptors below."""
    rng = random.Random(5)
    stems = ["thetion", "thetions", "thetiones", "connect", "thethethe"]
    docs = []
    for k in range(120):
        words = []
        for _ in range(60):
            w = rng.choice(stems)
            if rng.random() < 0.4:
                i = rng.randrange(len(w))
                w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("aeté") + w[i:], w[:i] + rng.choice("aeté") + w[i + 1:]])
            words.append(w if rng.random() < 0.8 else w.upper())
        docs.append((k % 100, " ".join(words)))
    docs += [(k, " ".join(["linkage"] * 50 + ["linkagez"] * 9 + ["linkagezy"])) for k in range(6)]      # a form of a form
    docs += [(None, "Connect, connect; connect. connect CONNECT"), (3, None), (4, ""), (5, "w" * 5000 + " " + "w" * 4999)] + [(9, "w" * 5000)] * 5
    cfg = spelling.SpellingConfig(node_words=12, levels=3)
    n = plain_words(docs, cfg)
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, word string, n int")
    got = got_variants(spelling.variants(df, cfg))
    want = plain_variants(n, cfg)
    assert len(want) > 100 and any(f and want[f][0] for f, *_ in want.values())      # forms of forms
    assert got == want
    assert got_variants(spelling.variants(df)) == want                               # one acceptor of them all
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string"), cfg).count() == 0


def test_spelling_on_given_documents(spark):
    cfg = spelling.SpellingConfig(node_words=50)
    docs = read(spark, SF001, "documents")
    n = plain_words([(r.doc_id, r.text) for r in docs.collect()], cfg)
    assert got_variants(spelling.variants(docs, cfg)) == plain_variants(n, cfg)


def test_every_word_below_one_prefix(spark):
    """A prefix all words share is crowded at each length; the last round goes on where the first stopped."""
    words = sorted({"prefixprefix" + "".join(p) for p in __import__("itertools").product("abc", repeat=4)} | {"prefixprefix", "prefixprefi"})
    table = spark.createDataFrame([(w, 7 + 40 * (k % 5 == 0)) for k, w in enumerate(words)], "word string, n long")
    scratch = Scratch(spark)
    cfg = spelling.SpellingConfig(node_words=5, levels=4)
    got = got_variants(spelling.group_words(scratch.write(table, "words"), scratch, cfg))
    assert got == plain_variants({w: 7 + 40 * (k % 5 == 0) for k, w in enumerate(words)}, cfg)


# --- phrases ----------------------------------------------------------------------------------------------------

def plain_phrases(docs, cfg):
    f, total = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, cfg.max_words + 1):
                f.update((lang, tuple(w[i:i + n])) for i in range(len(w) - n + 1))
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= cfg.min_count}
    out = defaultdict(list)
    for (lang, w), a in cand.items():
        cuts = [(cfg.scale * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        inside = any(100 * b >= cfg.inside_percent * a for (la, v), b in cand.items() if la == lang and len(v) > len(w)
                     and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1)))
        if not inside:
            out[lang].append((-score, -a, " ".join(w).encode(), a, f[lang, w[:k]], f[lang, w[k:]], total[lang], score))
    return sorted((lang, rank, p.decode(), *rest) for lang, rows in out.items()
                  for rank, (_, _, p, *rest) in enumerate(sorted(rows)[:cfg.top], 1))


def got_phrases(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.mark.parametrize("capacity_first", [False, True])
def test_summary_keeps_every_frequent_key_in_any_order(capacity_first):
    rng = np.random.default_rng(2)
    for trial in range(20):
        keys = np.concatenate([rng.integers(0, 1 << 32, 3000, np.uint32)] + [np.full(c, k, np.uint32) for k, c in enumerate((10, 11, 500, 9))])
        rng.shuffle(keys)
        if capacity_first:
            keys = keys[np.argsort(np.isin(keys, np.arange(4)), kind="stable")]
        summary = phrases.Summary(len(keys), 10)
        assert summary.capacity * 10 > len(keys)
        for at in range(0, len(keys), 37):
            k, t = np.unique(keys[at:at + 37], return_counts=True)
            summary.add(k, t.astype(np.int64))
            summary.merge()
            assert len(summary.keys) <= summary.capacity
        assert summary.lost < 10 and {0, 1, 2} <= set(summary.survivors().tolist())


def some_documents(seed, n):
    rng = random.Random(seed)
    common = ["the", "Of", "new", "york", "city", "été", "a-b", "rare"]
    docs = []
    for k in range(n):
        words = []
        for _ in range(rng.randrange(0, 60)):
            words.append(rng.choice(["New York City", "New york", "the city of", rng.choice(common), rng.choice(common) + rng.choice([".", ",", "\n", "\t", "!"]),
                                     f"w{rng.randrange(3000)}"]))
        docs.append((" ".join(words), rng.choice(["en", "en", "de", None, "und"])))
    return docs + [(None, "en"), ("", None), ("city " * 5000, "fr"), (" ,;. ", "de"), ("new york city", None)]


def test_phrases_equal_the_plain_version(spark):
    docs = some_documents(1, 250)
    df = spark.createDataFrame([(k % 3, *d, "r", 4) for k, d in enumerate(docs)], DOCS + ", phrase string, n int")
    want = plain_phrases(docs, phrases.PhraseConfig())
    assert len(want) > 50 and any(p.count(" ") == 2 for _, _, p, *_ in want)
    assert got_phrases(phrases.mine(df)) == want
    # four words, few bits (almost every n-gram is counted), many small partitions, a short report
    cfg = phrases.PhraseConfig(max_words=4, min_count=5, max_bits=6, partition_mass=200, top=20)
    assert got_phrases(phrases.mine(df, cfg)) == plain_phrases(docs, cfg)
    assert phrases.mine(spark.createDataFrame([], DOCS)).count() == 0


def test_scores_beyond_64_bits(spark):
    level = lambda rows: spark.createDataFrame(rows, "lang string, phrase string, mixed long, n long")
    a, x, y = 3_000_000_019, 4_000_000_007, 5_000_000_029
    levels = [level([("en", "p", 0, x), ("en", "q", 0, y)]), level([("en", "p q", 0, a)])]
    row = phrases.scored(levels, phrases.PhraseConfig())[0].collect()[0]
    assert row.score == 1_000_000 * a * a // (x * y) and (row.l, row.r) == (x, y)


def test_the_summaries_leave_few_and_lose_none(spark):
    docs = read(spark, SF001, "documents")
    cfg = phrases.PhraseConfig(partition_mass=500)
    scratch = Scratch(spark)
    _, levels = phrases.frequent(docs, scratch, cfg)
    f = Counter()
    for r in docs.collect():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            f.update((r.lang or "und", " ".join(w[i:i + 2])) for i in range(len(w) - 1))
    assert {(r.lang, r.phrase): r.n for r in levels[1].collect()} == {k: n for k, n in f.items() if n >= 10}
    left = scratch.write(phrases.summarised(docs, 2, phrases.bit_table(levels[0], 1 << 20, cfg), 64, scratch, cfg), "again")
    assert levels[1].count() <= left.distinct().count() < 0.5 * len(f)
