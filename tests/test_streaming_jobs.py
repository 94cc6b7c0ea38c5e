import os
import random
import tempfile
from collections import Counter

from pyspark.sql import functions as F

from tests.conftest import SF001


def test_clean_stream_equals_batch(spark):
    from tessera.plans.inputs import Inputs
    from tessera.streaming import clean_stream as S
    i = Inputs(spark, SF001)
    base = tempfile.mkdtemp(prefix="stream-")
    cleaned = S.clean_stream(S.raw_stream(spark, SF001, "documents.parquet"), i.registry, i.dictionary)
    q = S.start_clean_sink(cleaned, f"{base}/out", f"{base}/chk")
    q.awaitTermination()
    got = spark.read.parquet(f"{base}/out")
    batch = i.clean()
    cols = ["source", "shard", "pos", "kept", "reason", "raw_chars", "clean_chars", "text"]
    assert got.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert batch.select(cols).exceptAll(got.select(cols)).count() == 0


CLEAN = "source string, shard int, pos bigint, kept boolean, reason string, raw_chars bigint, clean_chars bigint, text string"


def clean_rows(seed):
    """Clean rows with copies in both scopes; a key with a null source, an empty text, a hash in a third of the rows."""
    rng = random.Random(seed)
    rows = []
    for pos in range(240):
        kept = rng.random() < 0.85
        text = rng.choice(["", "The same text", "the  SAME text\n", *(f"text {k}" for k in range(30))]) if kept else ""
        rows.append((rng.choice(["a", "a", "b", None]), rng.randrange(2), pos, kept, "kept" if kept else rng.choice(["ocr", "too_short"]), 9, 9, text))
    return rows


def plain_firsts(rows):
    first = {}
    for source, shard, pos, kept, *_, text in sorted(rows, key=lambda r: r[2]):
        if kept:
            first.setdefault((source, shard, " ".join(text.lower().split())), pos)
    return sorted(first.values())


def test_stream_state_survives_a_restart_and_late_copies(spark):
    """Files in shuffled order, a file a micro-batch, the queries stopped and started again between two of them."""
    from tessera.streaming import clean_stream as S
    base = tempfile.mkdtemp(prefix="stream-state-")
    rows = clean_rows(1)
    files = [rows[k::6] for k in range(6)]
    random.Random(2).shuffle(files)
    files = [sorted(f, key=lambda r: -r[2]) for f in files]
    for turn, some in enumerate((files[:3], files[3:])):
        for k, f in enumerate(some):
            spark.createDataFrame(f, CLEAN).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(CLEAN).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        S.start_first_copies(stream, f"{base}/changes", f"{base}/c1").awaitTermination()
        S.start_counters(stream, f"{base}/counters", f"{base}/c2", snapshot_every=2).awaitTermination()
        seen = [r for f in files[:3 * (turn + 1)] for r in f]
        # equal to the batch result after every prefix of the input
        changes = spark.read.schema(S.CHANGES).parquet(f"{base}/changes")
        assert sorted(r.pos for r in S.first_copies(changes).collect()) == plain_firsts(seen)
        counts = {(r.source, r.reason): r.docs for r in S.read_counters(spark, f"{base}/counters").collect()}
        assert counts == dict(Counter((r[0], r[4]) for r in seen))
    assert changes.where("change = -1").count() > 0                        # some copies came late
    _, held = S._batches(spark, f"{base}/counters")
    assert len(held) <= 3                                                  # snapshots replaced the older folders


def test_a_replayed_batch_changes_nothing(spark):
    from tessera.streaming import clean_stream as S
    path = tempfile.mkdtemp(prefix="stream-replay-") + "/counters"
    put = S.upsert_counters(path, snapshot_every=2)
    batch = lambda *rows: spark.createDataFrame(rows, "source string, reason string, docs bigint")
    put(batch(("a", "kept", 1), ("a", "ocr", 2)), 0)
    for _ in range(2):
        put(batch(("a", "kept", 5)), 1)                                    # the snapshot, and again
    for _ in range(2):
        put(batch(("b", "kept", 1)), 2)
    got = {(r.source, r.reason): r.docs for r in S.read_counters(spark, path).collect()}
    assert got == {("a", "kept"): 5, ("a", "ocr"): 2, ("b", "kept"): 1}
    assert sorted(S._batches(spark, path)[1]) == [1, 2]


def test_pipeline_jobs_end_to_end(spark):
    from tessera.plans import jobs as J
    out = tempfile.mkdtemp(prefix="jobs-")
    J.run_clean(spark, SF001, out)
    J.run_dedup(spark, SF001, out)
    first = sorted(tuple(r) for r in spark.read.parquet(f"{out}/corpus").select("source", "shard", "pos").collect())
    J.run_dedup(spark, SF001, out, reuse_signatures=True)
    again = sorted(tuple(r) for r in spark.read.parquet(f"{out}/corpus").select("source", "shard", "pos").collect())
    assert first == again
    J.run_tokenizer(spark, out, vocab_size=300)
    J.run_tokenize(spark, SF001, out, seq_len=64, val_every=10)
    J.run_eval(spark, out, vocab_size=300)
    J.run_plan(spark, out, world_size=2)
    clean = spark.read.parquet(f"{out}/clean_docs")
    corpus = spark.read.parquet(f"{out}/corpus")
    windows = spark.read.parquet(f"{out}/windows")
    assert clean.count() > 0 and corpus.count() > 0
    assert corpus.count() <= clean.where("kept").count()
    assert windows.where(F.size("ids") != 64).count() == 0
    assert windows.where("split = 'val'").count() > 0
    assert os.path.isdir(f"{out}/phase1_report") and os.path.isdir(f"{out}/phase2_report")
    # corpus has no exact copy inside a shard
    from tessera.functions.text import exact_hash
    dup = corpus.groupBy("source", "shard", exact_hash(F.col("text")).alias("h")).count().where("count > 1")
    assert dup.count() == 0


def test_stream_reads_documents_in_part_files(spark):
    """``documents.parquet`` as a folder of part files: the stream once read none of them."""
    from tessera.plans.catalog_clean import q_clean_stream, q_stream_counters
    base = tempfile.mkdtemp(prefix="stream-parts-")
    rows = [(k, f"{'A line of plain words that is long enough to stay in. ' * 20}{k}", "en", f"src{k % 3}", 1) for k in range(30)]
    for name, some in (("documents", rows), ("labels", [(k, 1, 0) for k in range(30)])):
        schema = {"documents": "doc_id bigint, text string, lang string, source string, n_chars bigint", "labels": "doc_id bigint, quality int, toxic int"}
        spark.createDataFrame(some, schema[name]).repartition(3).write.parquet(f"{base}/{name}.parquet")
    assert sorted(r.pos for r in q_clean_stream(spark, base).collect()) == list(range(30))
    assert sum(r.docs for r in q_stream_counters(spark, base).collect()) == 30


def test_counters_without_a_batch_are_empty(spark):
    from tessera.streaming import clean_stream as S
    assert S.read_counters(spark, tempfile.mkdtemp(prefix="stream-none-") + "/counters").collect() == []
