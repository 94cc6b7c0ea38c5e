"""Listing-driven scans: only the chosen files are opened, positions are a sequential reader's."""

import json
import os
import tempfile
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tessera import config as C
from tessera.plans import jobs as J
from tessera.sources import listing as L
from tessera.sources import registry as R

SOURCES = [C.Source("law", "x", 1000, text_field="body", split="us", strict_ocr=False, clean_shards=2),
           C.Source("web", "x", 300, split="train", config_name="sample")]


@pytest.fixture()
def root():
    base = tempfile.mkdtemp(prefix="listing-")
    n = 0
    for source, config, split, field, files in (("law", "default", "us", "body", 3), ("law", "default", "eu", "body", 1),
                                                ("web", "sample", "train", "text", 4), ("web", "full", "train", "text", 2)):
        folder = f"{base}/source={source}/config={config}/split={split}"
        os.makedirs(folder)
        for k in range(files):
            rows = [None if (n + i) % 5 == 0 else f"{source} {config} {split} {k} {i}" for i in range(7 + k)]
            pq.write_table(pa.table({field: rows, "other": list(range(len(rows)))}), f"{folder}/f {k:03d}.parquet", row_group_size=3)
            n += 1
    open(f"{base}/README.txt", "w").write("not a shard")
    pq.write_table(pa.table({"text": ["stray"]}), f"{base}/stray.parquet")
    return base


def sequential(paths):
    """(source, shard, pos, text) as a reader that opens the files one after the other."""
    out = []
    for source, shard, path, field in paths:
        out += [(source, shard, i, t or "") for i, t in enumerate(pq.read_table(path).column(field).to_pylist())]
    return sorted(out)


def test_only_the_chosen_files_are_opened(spark, root):
    reg = R.registry_df(spark, SOURCES)
    manifest = L.with_shards(L.manifest_of(L.list_files(spark, root)))
    assert manifest.count() == 10
    plan = R.shard_plan(manifest, reg, web_shards=2)
    raw = L.scan(spark, plan, reg)
    law, web = f"{root}/source=law/config=default/split=us", f"{root}/source=web/config=sample/split=train"
    opened = sorted(unquote(f.removeprefix("file://")) for f in raw.inputFiles())
    # the ranks of the listing stay: law's eu file comes first by path, web's full set before its sample
    want = [("law", k + 1, f"{law}/f {k:03d}.parquet", "body") for k in range(3)] + [("web", k + 2, f"{web}/f {k:03d}.parquet", "text") for k in range(2)]
    assert opened == sorted(p for _, _, p, _ in want)
    assert sorted(tuple(r) for r in raw.collect()) == sequential(want)
    scan = raw._jdf.queryExecution().executedPlan().toString()
    assert "other" not in scan
    caps = {(r.source, r.per_shard_cap) for r in plan.collect()}
    assert caps == {("law", 333), ("web", 150)}
    one = L.scan(spark, R.shard_plan(manifest, reg, web_shards=2, only="web"), reg)
    assert {r.source for r in one.collect()} == {"web"} and len(one.inputFiles()) == 2
    assert L.scan(spark, plan.limit(0), reg).count() == 0


@pytest.mark.parametrize("kind", ["jsonl", "csv", "parquet"])
def test_a_clean_job_reads_its_manifest(spark, root, kind):
    path = f"{root}/web.{kind}"
    rows = [{"source": "web", "config": "sample", "split": "train", "path": f"{root}/source=web/config=sample/split=train/f {k:03d}.parquet"} for k in (1, 3)]
    if kind == "jsonl":
        open(path, "w").write("\n".join(map(json.dumps, rows)))
    elif kind == "csv":
        open(path, "w").write("source,config,split,path\n" + "\n".join(",".join(r.values()) for r in rows))
    else:
        pq.write_table(pa.Table.from_pylist(rows), path)
    out = tempfile.mkdtemp(prefix="listing-out-")
    J.run_clean_files(spark, path, out, registry=R.registry_df(spark, SOURCES))
    got = spark.read.parquet(f"{out}/clean_docs")
    assert sorted((r.source, r.shard, r.pos) for r in got.select("source", "shard", "pos").collect()) == \
        [("web", 0, i) for i in range(8)] + [("web", 1, i) for i in range(10)]
    assert got.where("reason = 'too_short'").count() == 18
