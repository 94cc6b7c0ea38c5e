from pyspark.sql import functions as F

from tests.conftest import SF001


def test_clean_invariant_under_repartition(spark):
    from tessera.plans.inputs import Inputs
    i = Inputs(spark, SF001)
    base = i.raw_with_policy()
    from tessera.operators.clean import clean_documents
    outs = []
    for n in (1, 7, 64):
        c = clean_documents(base.repartition(n), i.dictionary, "strict_ocr")
        outs.append(sorted(tuple(r) for r in c.collect()))
    assert outs[0] == outs[1] == outs[2]


def test_kept_plus_dropped_is_streamed(spark):
    from tessera.plans import reports as REP
    from tessera.plans.inputs import Inputs
    i = Inputs(spark, SF001)
    rep = {r.source: r for r in REP.phase1_report(i.capped()).collect()}
    for s, r in rep.items():
        assert r.kept + r.too_short + r.repetitive + r.non_english + r.ocr == r.streamed, s


def test_dictionary_from_word_list(spark):
    from tessera.operators.ocr import dictionary_from_words
    lines = spark.createDataFrame([("  Apple",), ("banana1",), ("Café",), ("",), ("apple",), ("o'clock",)], "value string")
    assert sorted(r.word for r in dictionary_from_words(lines).collect()) == ["apple", "café"]

