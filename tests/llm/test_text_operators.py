"""Quality classifier, line dedup, license scans, mixing, packing, language ID and URL filters on small fixtures."""

import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001, SF01
from tessera.llm import langid, licenses, linededup, mixing, packing, quality, urlfilter
from tessera.llm.common import read, words_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "host string, score double, rule string, size long, begin long, quota long"


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, other columns with names used inside."""
    rows = [(1, "a b c", "en", "s1", 5), (1, "a b c", "en", "s1", 5), (2, None, None, None, None), (3, "", "en", "s1", 0),
            (None, "x y z w", "en", None, 7), (4, "word " * 30000, "fr", "s2", 150000), (5, "\n\n \t", None, "s2", 4),
            (6, "é ü ß \U0001F600", "de", "s3", 7), (7, "a b c", "en", "s3", 5)]
    return spark.createDataFrame([(*r, "h", 1.0, "r", 9, 9, 9) for r in rows], f"{DOCS}, {CLASH}")


def empty_documents(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_words_match_the_definition():
    import re
    texts = ["  a  b\x0b\x1c c ", "", None, " ", "x", "é ß", "tail\n", "\ta"]
    codes, offsets, words = words_of(pa.array(texts))
    for i, t in enumerate(texts):
        assert [words[c] for c in codes[offsets[i]:offsets[i + 1]]] == re.findall(r"[^\x20\x09-\x0D]+", t or "")


# --- quality ----------------------------------------------------------------------------------------------------

def test_quality_learns_only_its_folds_and_generalises(spark):
    docs, lab = read(spark, SF01, "documents"), read(spark, SF01, "labels")
    cfg = quality.QualityConfig()
    got = quality.score(docs.select("doc_id", "text"), quality.fit(docs, lab, cfg), cfg).drop("text").join(lab, "doc_id") \
        .withColumn("held", quality.held_out(F.col("doc_id"), cfg.folds)).toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(got.doc_id, got.held))
    held = got[got.held]
    good, bad = held[held.quality == 1].score.values, held[held.quality == 0].score.values
    assert (good[:, None] > bad[None, :]).mean() > 0.95          # area under the curve
    assert (good >= cfg.threshold).mean() > 0.98
    # labels of the held-out fold change nothing
    flipped = lab.withColumn("quality", F.when(quality.held_out(F.col("doc_id"), cfg.folds), 1 - F.col("quality"))
                             .otherwise(F.col("quality")))
    again = quality.fit(docs, flipped, cfg)
    same = quality.fit(docs, lab, cfg)
    assert np.array_equal(again[0], same[0]) and again[1] == same[1]


def test_quality_of_odd_rows(spark):
    odd = odd_documents(spark)
    cfg = quality.QualityConfig()
    for rows in ([], [(1, 1, 0)], [(1, 1, 0), (4, 0, 0), (4, 1, 0), (None, 0, 0), (7, None, 0), (6, 5, 0)]):
        out = quality.score(odd, quality.fit(odd, labels(spark, rows), cfg), cfg).select("doc_id", "score").collect()
        assert len(out) == 9 and all(0 <= r.score <= 1 for r in out)
    kept = quality.keep_good(odd, labels(spark), cfg)
    assert kept.columns == odd.columns and kept.count() == 9      # no labels: nothing is rejected
    none = empty_documents(spark)
    assert quality.keep_good(none, labels(spark), cfg).count() == 0


def test_training_counts_equal_scoring_features():
    texts = pa.array(["one two two two three", "", None, "x"])
    cfg = quality.QualityConfig(bits=12)
    vector = np.random.default_rng(0).normal(size=1 << 12)
    mean = quality.document_scores(texts, vector, cfg)
    for (buckets, share), m in zip(quality.document_counts(texts, cfg), mean):
        assert abs((vector[buckets] * share).sum() - m) < 1e-5


# --- line dedup -------------------------------------------------------------------------------------------------

def test_lines_by_hand(spark):
    rows = [(i, f"menu\nonly {i}\n menu \n\nfooter" if i < 6 else f"only {i}\n\nfooter {i}", "s1") for i in range(10)]
    rows += [(20, "menu\nother", "s2"), (21, "menu\nother", None), (22, None, "s1"), (23, "menu", "s1"), (24, "", "s1")]
    df = spark.createDataFrame([(*r, "k", "p") for r in rows], "doc_id long, text string, source string, keys string, n string")
    cfg = linededup.LineConfig(ratio=0.4, min_pages=3)
    got = {r.doc_id: (r.text, r.gone) for r in linededup.drop_boilerplate(df, cfg=cfg, dropped="gone").collect()}
    # 13 pages of s1: menu on 7 (0.54), footer on 6 (0.46)
    assert got[0] == ("only 0\n", 3)
    assert got[7] == ("only 7\n\nfooter 7", 0)
    assert got[20] == ("menu\nother", 0) and got[21] == ("menu\nother", 0)
    assert got[22] == (None, 0) and got[23] == ("", 1) and got[24] == ("", 0)
    assert linededup.drop_boilerplate(df, cfg=cfg).columns == df.columns
    assert linededup.drop_boilerplate(odd_documents(spark)).count() == 9
    assert linededup.drop_boilerplate(empty_documents(spark)).count() == 0


def test_a_copied_document_outlives_line_dedup(spark):
    import corpus_pipeline
    copied = "\n".join(f"line {k} of the copied text says {k * 7} things" for k in range(6))
    rows = [(i, copied if i % 3 == 0 else f"menu of the site\nwords{i} only{i} here{i} on{i} page{i} {i}", "en", "s", 0) for i in range(60)]
    lines = corpus_pipeline.line_stage(spark, spark.createDataFrame(rows, DOCS), "")
    got = {r.doc_id: r.text for r in corpus_pipeline.near_stage(spark, lines, "").collect()}
    assert [t for t in got.values() if t == copied] == [copied] and len(got) == 41
    assert not any("menu" in t for t in got.values())          # 40 of 41 texts


# --- license scans ----------------------------------------------------------------------------------------------

def test_licenses_by_hand(spark):
    apache = "Licensed under the Apache License, Version 2.0."
    rows = [(1, f"some text\n** {apache.upper()} **\nmore"), (2, "released under the mit license"), (3, "the mit license"),
            (4, None), (5, ""), (6, "a"), (7, licenses.TEMPLATES[-1][1].replace(", ", ",\n")), (8, f"{apache}\nLicensed under CC BY-NC 4.0."),
            (9, "Licensed under the Apache License, Version 1.1.")]
    df = spark.createDataFrame([(*r, "x", 0.0) for r in rows], "doc_id long, text string, license string, dice double")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert (got[1].license, got[1].dice, got[1].line) == ("Apache-2.0", 1.0, 2)
    assert (got[2].license, got[2].line) == ("MIT", 1)
    assert all(got[i].license is None and got[i].matches == 0 for i in (3, 4, 5, 6))
    assert (got[7].license, got[7].line, got[7].dice) == ("MIT", 0, 1.0)         # the text as a whole
    assert (got[8].license, got[8].matches) == ("Apache-2.0", 2)
    assert got[9].license is None                                       # 2 * 5 / 14
    assert licenses.scan(empty_documents(spark)).count() == 0


def test_whole_licence_files_and_wrapped_notices(spark):
    import textwrap
    wrap = lambda text, mark="", width=70: "\n".join(mark + x for x in textwrap.wrap(text, width))
    longest = {name: max((t for n, t in licenses.TEMPLATES if n == name), key=len) for name, _ in licenses.TEMPLATES}
    head = "The MIT License (MIT)\n\nCopyright (c) 2020 A. Name\n\n"
    prose = "\n".join(f"def name{i}(x{i}): return x{i} + {i} of the list" for i in range(300))
    at = 40
    body = prose.split("\n")
    rows = [(1, head + wrap(licenses._MIT) + "\n\n" + wrap(licenses._MIT_WARRANTY)),
            (2, "Copyright (c) 2020, A. Name\n\n" + wrap(licenses._ISC) + "\n\n" + wrap(licenses._ISC_WARRANTY)),
            (3, wrap(longest["Apache-2.0"], "# ") + "\n" + prose),
            (4, "\n".join([*body[:at], wrap(longest["GPL-3.0"], " * "), *body[at:]])),
            (5, "\n".join([*body[:at], "", wrap(longest["BSD-3-Clause"], "// "), "", *body[at:]])),
            (6, "\n".join([*body[:at], wrap("Licensed under the Apache License, Version 2.0.", "-- ", 25), *body[at:]])),
            (7, prose)]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].license for i in range(1, 8)] == ["MIT", "ISC", "Apache-2.0", "GPL-3.0", "BSD-3-Clause", "Apache-2.0", None]
    assert [(got[i].dice, got[i].line) for i in (1, 2)] == [(1.0, 5), (1.0, 3)]          # the grant without the warranty
    assert (got[3].line, got[3].dice) == (1, 1.0) and (got[4].line, got[4].dice) == (at + 1, 1.0)
    assert (got[5].line, got[5].dice) == (at + 2, 1.0) and (got[6].line, got[6].dice) == (at + 1, 1.0)


def test_license_size_bounds_lose_nothing():
    cfg = licenses.LicenseConfig()
    for _, _, grams, lo, hi in licenses.bounds(cfg):
        n = len(grams)
        for size in range(0, 3 * n):
            if 2 * min(size, n) / (size + n) >= cfg.threshold:
                assert lo <= size <= hi


# --- mixing -----------------------------------------------------------------------------------------------------

def water_fill(sizes, weights, repeat):
    """Targets by repeated resharing, as worded."""
    total, capped = sum(sizes.values()), {}
    while True:
        rest = total - sum(capped.values())
        free = [s for s in sizes if s not in capped]
        w = sum(weights[s] for s in free)
        over = [s for s in free if rest * weights[s] / w > repeat * sizes[s]] if w else []
        if not over:
            return capped | {s: rest * weights[s] / w for s in free}
        capped |= {s: float(repeat * sizes[s]) for s in over}


def test_targets_equal_resharing(spark):
    rng = np.random.default_rng(3)
    for _ in range(4):
        n = int(rng.integers(1, 9))
        names = [None if i == n - 1 and n > 2 else f"s{i}" for i in range(n)]
        sizes = {s: int(rng.choice([0, 5, 40, 900])) + int(s == "s0") for s in names}
        cfg = mixing.MixConfig()
        order = sorted(names, key=lambda s: (s is None, s or ""))
        weights = {s: cfg.weights[i % 3] for i, s in enumerate(order)}
        got = {r.source: r.target for r in mixing.targets(
            spark.createDataFrame(list(sizes.items()), "source string, source_size long"), cfg).collect()}
        want = water_fill(sizes, weights, 3)
        assert all(abs(got[s] - want[s]) < 1e-6 for s in names), (sizes, got, want)


def test_apportionment_is_by_highest_quotients(spark):
    rng = np.random.default_rng(5)
    for seats in (0, 1, 7, 40):
        claims = {f"k{i}": float(x) for i, x in enumerate(rng.uniform(0, 6, 7))} | {"zero": 0.0}
        df = spark.createDataFrame([(k, c, seats) for k, c in claims.items()], "key string, claim double, seats long")
        got = {r.key: r.quota for r in mixing.apportion(df, [], ["key"], "seats").collect()}
        want = Counter()
        for _ in range(seats):
            want[max(claims, key=lambda k: (claims[k] / (2 * want[k] + 1), [-ord(c) for c in k]))] += 1
        assert got == {k: want[k] for k in claims}


def test_mix_comes_near_its_targets(spark):
    docs = read(spark, SF01, "documents")
    cfg = mixing.MixConfig(shard_words=8000)          # several shards a source
    report = mixing.mix_report(docs, cfg).toPandas()
    assert len(report) == docs.count() and (report.taken <= 3 * report["size"]).all()
    source = docs.select("doc_id", "source").toPandas().merge(report, on="doc_id")
    by = source.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (abs(by.taken / by.target - 1) < 0.05).all()
    again = mixing.mix_report(docs.repartition(5), cfg).toPandas()
    order = ["doc_id", "size", "taken"]
    assert report.sort_values(order).reset_index(drop=True).equals(again.sort_values(order).reset_index(drop=True))
    # the stage takes the words that the report counts, and whole documents stay whole
    mixed = mixing.mix(docs, cfg)
    assert mixed.columns == docs.columns
    words = mixed.select("doc_id", mixing.n_words(F.col("text")).alias("n")).groupBy("doc_id").agg(F.sum("n").alias("n")).toPandas()
    joined = report.merge(words, on="doc_id", how="left").fillna({"n": 0})
    assert (joined.n == joined.taken).all()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text.strip() in texts[r.doc_id] or len(r.text) < len(texts[r.doc_id]) for r in mixed.collect())


def test_mixing_odd_rows(spark):
    odd = odd_documents(spark)
    report = mixing.mix_report(odd).collect()
    assert len(report) == 9 and sum(r.size for r in report) == 3 + 3 + 4 + 30000 + 4 + 3
    assert all(0 <= r.taken <= 3 * r.size for r in report)
    assert mixing.mix(odd).columns == odd.columns
    assert mixing.mix_report(empty_documents(spark)).count() == 0


# --- packing ----------------------------------------------------------------------------------------------------

def library_ids(texts):
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    tok = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    return [tok.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_ids_equal_the_library(spark):
    texts = ["Hello, World! it's 3.5%", "", None, "a.b,c;d 'tis rock'n'roll !'s x!'s", "ÀÉ ÉE\u0301 ﬁ ßẞ İI", "<|endoftext|> A<|ENDOFTEXT|>b",
             "tabs\tand\nlines\r\n\x0b\x0c \x1c nbsp\u00a0em\u2003end", "日本語 text 中文", "☃️ 😀😀 x", "don't DON'T we'LL", "a" * 500,
             "1234 12a34 a1b2", "--- ... *** a--b __x__ $5.00", "\u0301combining start", "Σίσυφος ΟΔΟΣ", "e \u0301"]
    docs = [r.text for r in read(spark, SF001, "documents").limit(60).collect()]
    for some in (texts, docs):
        ids, offsets = packing.token_ids(pa.array(some), packing.load(packing.tokenizer_path(packing.PackConfig())))
        for i, want in enumerate(library_ids(some)):
            assert ids[offsets[i]:offsets[i + 1]].tolist() == want, some[i]


def test_encoding_holds_few_copies_of_the_text():
    """A worker's peak while it encodes, as a multiple of the text's bytes (23 when the per-byte and per-run arrays lived on)."""
    random = np.random.default_rng(5)
    words = ["".join(random.choice(list("abcdefghij"), random.integers(1, 10))) for _ in range(2000)]
    texts = pa.array([" ".join(random.choice(words, 400)) for _ in range(1000)])
    tokenizer = packing.load(packing.tokenizer_path(packing.PackConfig()))
    packing.token_ids(texts, tokenizer)
    tracemalloc.start()
    try:
        packing.token_ids(texts, tokenizer)
        assert tracemalloc.get_traced_memory()[1] < 14 * texts.nbytes
    finally:
        tracemalloc.stop()


def test_ranges():
    for start in ([3, 0, 10], [3, 0, (1 << 31) - 2]):
        got = packing.ranges(np.array(start), np.array([2, 0, 3]))
        assert got.tolist() == [3, 4, start[2], start[2] + 1, start[2] + 2]
    assert packing.ranges(np.zeros(0, np.int64), np.zeros(0, np.int64)).tolist() == []


def check_packing(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


def test_packing_round_trip(spark):
    docs = read(spark, SF01, "documents").select("doc_id", "text")
    rows = packing.pack(docs, packing.PackConfig(group_pieces=300)).collect()
    bins = check_packing(rows, 2048)
    total = sum(r.length for r in rows)
    assert len(bins) <= -(-total // 2048) * 1.03 + 4
    texts = docs.limit(150).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for t, ids in zip(texts, library_ids([t.text for t in texts])):
        ids = np.array([*ids, 0], "<u4")
        want = [(k, a, len(ids[a:a + 2048]), zlib.crc32(ids[a:a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048))]
        assert sorted(by_doc[t.doc_id]) == want


def test_every_capacity_binds():
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(1, 101, 400))[::-1]
    for cfg in (packing.PackConfig(capacity=100), packing.PackConfig(capacity=100, max_documents=3),
                packing.PackConfig(capacity=100, max_cost=10_000, measure="dot"),
                packing.PackConfig(capacity=400, max_cost=30_000, max_documents=50)):
        bins, offsets = packing.best_fit(lengths, cfg)
        for b in np.unique(bins):
            mine = lengths[bins == b]
            assert mine.sum() <= cfg.capacity and len(mine) <= (cfg.max_documents or cfg.capacity)
            assert (mine.astype(float) ** 2).sum() <= (cfg.max_cost or cfg.capacity ** 2)
            assert sorted(offsets[bins == b]) == [0, *np.cumsum(mine[np.argsort(offsets[bins == b])])[:-1]]


def test_packing_odd_rows(spark):
    rows = packing.pack(odd_documents(spark)).collect()
    check_packing(rows, 2048)
    pieces = Counter((r.doc_id, r.piece, r.length) for r in rows)
    assert pieces[(2, 0, 1)] == 1 and pieces[(3, 0, 1)] == 1 and pieces[(1, 0, 4)] == 2
    assert sum(n for (d, _, size), n in pieces.items() if d == 4 for _ in [size]) == 15
    assert packing.pack(empty_documents(spark)).count() == 0


# --- language ID ------------------------------------------------------------------------------------------------

def test_language_of_documents_and_pages(spark):
    docs = read(spark, SF01, "documents")
    model = langid.learn(docs)
    rows = langid.document_rows(docs).unionByName(langid.page_rows(read(spark, SF01, "pages")))
    got = langid.fuse(rows, model).toPandas()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    mine = got[got.doc_id.notna()]
    assert len(mine) == len(truth) and np.mean([truth[d] == x for d, x in zip(mine.doc_id, mine.lang_id)]) > 0.98
    pages = got[got.page_id.notna()]
    assert len(pages) == 250 and (pages.declared == pages.lang_id).mean() > 0.98


def test_evidence_without_text(spark):
    docs = read(spark, SF01, "documents")
    model = langid.learn(docs)
    none = [(i, None, "h.example.fr", "fr", "fr") for i in range(2)]
    text = {r.lang: r.text for r in docs.where("length(text) > 800").collect()}
    rows = [(10 + i, text["fr"], "h.example.fr", "fr", "fr") for i in range(30)] + none \
        + [(50, "", None, None, None), (51, text["de"], None, None, "de"), (52, text["en"], "h.example.fr", "fr", "xx")]
    df = spark.createDataFrame(rows, "k long, text string, host string, suffix string, declared string")
    got = {r.k: r for r in langid.fuse(df, model).collect()}
    assert got[0].lang_id == got[1].lang_id == "fr"          # host and declaration speak for an empty text
    assert got[51].lang_id == "de" and got[52].lang_id == "en"
    assert got[50].lang_id is not None and len(got) == 35
    nothing = langid.learn(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_id for r in langid.fuse(df, nothing).collect()} == {None}
    assert langid.fuse(df.limit(0), model).count() == 0
    assert langid.fuse(langid.document_rows(odd_documents(spark)), langid.learn(odd_documents(spark))).count() == 9


def test_a_rare_language_keeps_its_label(spark):
    docs = read(spark, SF01, "documents").where("length(text) > 200").select("doc_id", "text", "lang", "source").collect()
    rare = [(10 ** 6 + i, f"kivu zorpa {w} talmex ruqo bandril vostu {w} nemkaj ruqo zorpa pelnit", "xq", "s")
            for i, w in enumerate(("jorvat", "hulmex", "tazniq"))]
    df = spark.createDataFrame([(r.doc_id, r.text, r.lang, r.source) for r in docs] + rare, "doc_id long, text string, lang string, source string")
    cfg = langid.LangConfig(sample=40)          # of several hundred documents
    model = langid.learn(df, cfg)
    assert model[0] == sorted({r.lang for r in docs} | {"xq"})
    got = {r.doc_id: r.lang_id for r in langid.fuse(langid.document_rows(df), model, cfg).collect()}
    assert [got[i] for i, *_ in rare] == ["xq"] * 3
    assert np.mean([got[r.doc_id] == r.lang for r in docs]) > 0.95


# --- URL filters ------------------------------------------------------------------------------------------------

def test_url_parts_and_rules_by_hand(spark):
    cases = [("http://A.Example.NET/en/1?x=/de/#f", "a.example.net", "/en/1", "example.net/en/", "allow"),
             ("https://example.net/de/", "example.net", "/de/", "net/", "block"),
             ("https://notexample.com/de/", "notexample.com", "/de/", None, None),
             ("https://x.example.com/de/a", "x.example.com", "/de/a", "example.com/de/", "block"),
             ("http://org/fr/", "org", "/fr/", "org/fr/", "allow"),
             ("http://b.net", "b.net", "", None, None),
             ("http://b.net?q", "b.net", "", None, None),
             ("http://ÄB.net#x/y", "Äb.net", "", None, None),
             ("mailto:a@b.net", "", "", None, None), ("", "", "", None, None), (None, "", "", None, None),
             ("a://b://c.net/x", "b:", "//c.net/x", None, None)]
    df = spark.createDataFrame([(i, c[0], "clash") for i, c in enumerate(cases)], "page_id long, url string, verdict string")
    got = {r.page_id: r for r in urlfilter.judge(df).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), cases[i]
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")
    assert urlfilter.judge(df.limit(0)).count() == 0


def test_trees_learn_lexical_features(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(600):
        bad = int(rng.random() < 0.5)
        name = "".join(rng.choice(list("0123456789") if bad else list("abcdefgh"), 12))
        rows.append((f"http://h{i % 7}.example/{name}" + "?a=1&b=2" * bad, bad))
    df = spark.createDataFrame(rows, "url string, blocked int")
    model = urlfilter.fit(df.limit(300))
    p = model.blocked([u for u, _ in rows[300:]])
    assert np.mean((p >= 0.5) == np.array([b for _, b in rows[300:]])) > 0.95
    one = urlfilter.fit(df.where("blocked = 0"))
    assert (one.blocked(["http://x/", None]) < 0.5).all()
