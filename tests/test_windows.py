"""Fixed-width window files: round trip, ranges, positional fetch, failed writes."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.sources import windows as W

L, EVERY = 8, 5


def make(spark, shards=(("a", 0, 57), ("a", 1, 3), ("b", 0, 1)), bad=None):
    rows = []
    for source, shard, n in shards:
        for w in range(n):
            rows.append(("val" if w % EVERY == 0 else "train", source, shard, w, [(w * 31 + shard * 7 + k * 8191) % 65536 for k in range(L)]))
    if bad:
        rows.append(bad)
    return spark.createDataFrame(rows, W.SCHEMA).repartition(3)


def rows_of(df):
    return sorted((r.split, r.source, r.tok_shard, r.window_id, tuple(r.ids)) for r in df.collect())


def test_places():
    for every in (2, 5, 100):
        for split in ("val", "train"):
            mine = [w for w in range(350) if (w % every == 0) == (split == "val")]
            assert [W.place_of(w, split, every) for w in mine] == list(range(len(mine)))
            assert W.window_at(np.arange(len(mine)), split, every).tolist() == mine


@pytest.mark.parametrize("file_windows", [1 << 19, 4])
def test_round_trip_and_ranges(spark, file_windows):
    path = tempfile.mkdtemp(prefix="windows-")
    df = make(spark)
    W.write_windows(df, path, L, EVERY, file_windows)
    assert rows_of(W.read_table(spark, path)) == rows_of(df)
    assert rows_of(W.read_table(spark, path, "val")) == rows_of(df.where("split = 'val'"))
    # nothing but ids, 16 bits each, in order
    m = W.manifest(path)
    assert all(os.path.getsize(f"{path}/{f['file']}") == f["windows"] * L * 2 for f in m["files"])
    assert max(f["windows"] for f in m["files"]) <= file_windows
    # small ranges: many tasks, the same rows
    r = spark.read.format("token_windows").option("rangeWindows", 3).load(path)
    assert rows_of(r) == rows_of(df) and r.rdd.getNumPartitions() >= 20
    # a second write replaces the first, and only its files stay
    less = df.where("source = 'b' OR tok_shard = 1")
    W.write_windows(less, path, L, EVERY)
    assert rows_of(W.read_table(spark, path)) == rows_of(less)
    held = [f"{d}/{n}" for d in os.listdir(path) if d.startswith("data-") for n in os.listdir(f"{path}/{d}")]
    assert sorted(held) == sorted(f["file"] for f in W.manifest(path)["files"])


def test_a_fetch_reads_only_its_windows(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="windows-")
    df = make(spark)
    W.write_windows(df, path, L, EVERY, 10)
    want = {(r.source, r.tok_shard, r.window_id): list(r.ids) for r in df.collect()}
    plan = df.where("split = 'train' AND window_id % 7 = 1").select("source", "tok_shard", "window_id", F.lit("x").alias("_file2"))
    got = W.fetch(plan.unionByName(plan.limit(2)), path).collect()        # windows asked for twice come twice
    assert len(got) == plan.count() + 2 and all(list(r.ids) == want[r.source, r.tok_shard, r.window_id] and r._file2 == "x" for r in got)
    # bytes beyond the window are not touched: a file cut off right after it still serves it
    part = W.WindowReader({"path": path, "split": "train"}).files[1]
    full = f"{path}/{part['file']}"
    os.truncate(full, 3 * L * 2)
    assert W.read_windows(full, L, 2, 1).shape == (1, L)


@pytest.mark.parametrize("bad", [("train", "a", 9, 1, [1] * (L - 1)), ("train", "a", 9, 1, [70000] * L), ("train", "a", 9, EVERY, [1] * L)])
def test_a_failed_write_leaves_nothing(spark, bad):
    path = tempfile.mkdtemp(prefix="windows-")
    df = make(spark)
    W.write_windows(df, path, L, EVERY)
    before = rows_of(W.read_table(spark, path))
    with pytest.raises(Exception):
        W.write_windows(make(spark, bad=bad), path, L, EVERY)
    assert rows_of(W.read_table(spark, path)) == before                   # the old write is whole
    assert len([d for d in os.listdir(path) if d.startswith("data-") and os.listdir(f"{path}/{d}")]) == 1


def test_empty(spark):
    path = tempfile.mkdtemp(prefix="windows-")
    W.write_windows(make(spark).limit(0), path, L, EVERY)
    assert W.read_table(spark, path).count() == 0
