"""Token windows as fixed-width binary files: a Spark data source (``token_windows``) and a positional fetch.

A file holds windows of one (split, source, tok_shard) in order, ``seq_len`` little-endian unsigned 16-bit ids each, and
nothing else, so a training process can map it. ``<path>/_manifest.json`` names the files of the last committed write
with the window each begins with; a window's place follows from its number, as every ``val_every``-th window is
for validation and the others are for training.

Writing: tasks write below a folder of the job's own; ``commit`` replaces the manifest in one step, after which the
files of the write before go. ``abort`` removes the job's folder, and a task that fails removes its own files, so
readers see a whole write or none of it. Reading: a task gets a range of windows of one file and
reads those bytes only.

``path`` is a file system mounted by driver and executors. Ids over 65,535 and windows of another length are refused.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

SCHEMA = "split string, source string, tok_shard int, window_id bigint, ids array<int>"
KEY = ("split", "source", "tok_shard")


def place_of(window, split: str | None, val_every: int):
    """Number of windows of the split before ``window`` in its shard (arithmetic on ints, arrays and columns)."""
    before_val = (window - window % val_every) / val_every if not isinstance(window, (int, np.ndarray)) else window // val_every
    return before_val if split == "val" else window - before_val - 1


def window_at(place: np.ndarray, split: str, val_every: int) -> np.ndarray:
    """The window of the split with ``place`` others before it."""
    return place * val_every if split == "val" else place + place // (val_every - 1) + 1


def manifest(path: str) -> dict:
    with open(os.path.join(path, "_manifest.json"), encoding="utf-8") as fh:
        return json.load(fh)


# --- writer -----------------------------------------------------------------------------------------------------

@dataclass
class Written(WriterCommitMessage):
    files: list


class WindowWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"]
        self.seq_len, self.val_every = int(options["seqlen"]), int(options["valevery"])
        self.most = int(options.get("filewindows", 1 << 19))       # windows of a file
        if self.val_every < 2:
            raise ValueError("valEvery must be 2 or more")
        if not overwrite:
            raise ValueError("token windows are written whole: use mode overwrite")
        self.folder = f"data-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        home = os.path.join(self.path, self.folder)
        os.makedirs(home, exist_ok=True)
        files, out, now = [], None, None
        try:
            for batch in iterator:
                col = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
                ids = self._ids(col["ids"])
                keys = list(zip(*(col[k].to_pylist() for k in KEY)))
                windows = col["window_id"].to_numpy()
                val = np.array([k[0] == "val" for k in keys], bool)
                if ((windows % self.val_every == 0) != val).any():
                    raise ValueError(f"each {self.val_every}th window, and no other, is of split val")
                cut = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]] + [len(keys)]
                for lo, hi in zip(cut[:-1], cut[1:]):
                    key = keys[lo]
                    while lo < hi:
                        place = int(place_of(int(windows[lo]), key[0], self.val_every))
                        if now is None or now["key"] != key or now["place"] + now["windows"] != place or now["windows"] >= self.most:
                            if out:
                                out.close()
                            name = f"{self.folder}/{key[0]}-{key[1]}-{key[2]:03d}-{place:012d}-{uuid.uuid4().hex}.bin"
                            now = {"file": name, "key": key, "place": place, "windows": 0}
                            files.append(now)
                            out = open(os.path.join(self.path, name), "wb")
                        # as many as follow on without a gap
                        some = windows[lo:min(hi, lo + self.most - now["windows"])]
                        follow = place_of(some, key[0], self.val_every) == place + np.arange(len(some))
                        n = len(some) if follow.all() else int(np.argmin(follow))
                        out.write(ids[lo:lo + n].tobytes())
                        now["windows"] += n
                        lo += n
            if out:
                out.close()
        except BaseException:
            if out:
                out.close()
            for f in files:
                if os.path.exists(os.path.join(self.path, f["file"])):
                    os.unlink(os.path.join(self.path, f["file"]))
            raise
        return Written([{**f, "key": list(f["key"])} for f in files])

    def _ids(self, column: pa.Array) -> np.ndarray:
        if column.null_count or not (np.diff(column.offsets.to_numpy()) == self.seq_len).all():
            raise ValueError(f"every window must have {self.seq_len} ids")
        ids = column.flatten().to_numpy()
        if len(ids) and (ids.min() < 0 or ids.max() > 0xFFFF):
            raise ValueError("ids must fit 16 bits")
        return ids.astype("<u2").reshape(-1, self.seq_len)

    def commit(self, messages: list) -> None:
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: (*f["key"], f["place"]))
        os.makedirs(self.path, exist_ok=True)
        mine = os.path.join(self.path, f"_manifest-{uuid.uuid4().hex}")
        with open(mine, "w", encoding="utf-8") as fh:
            json.dump({"seq_len": self.seq_len, "val_every": self.val_every, "files": files}, fh)
        os.replace(mine, os.path.join(self.path, "_manifest.json"))
        # files of earlier writes, and of attempts of this one that were not committed
        named = {f["file"] for f in files}
        for folder in os.listdir(self.path):
            if folder.startswith("data-"):
                if folder != self.folder:
                    shutil.rmtree(os.path.join(self.path, folder), ignore_errors=True)
                    continue
                for name in os.listdir(os.path.join(self.path, folder)):
                    if f"{folder}/{name}" not in named:
                        os.unlink(os.path.join(self.path, folder, name))

    def abort(self, messages: list) -> None:
        shutil.rmtree(os.path.join(self.path, self.folder), ignore_errors=True)


# --- reader -----------------------------------------------------------------------------------------------------

@dataclass
class Range(InputPartition):
    file: str
    key: tuple
    place: int         # of the first window, in its shard and split
    skip: int          # windows of the file before it
    windows: int


class WindowReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.split = options["path"], options.get("split")
        self.most = int(options.get("rangewindows", 8192))
        m = manifest(self.path)
        self.seq_len, self.val_every, self.files = m["seq_len"], m["val_every"], m["files"]

    def partitions(self) -> list[Range]:
        return [Range(f["file"], tuple(f["key"]), f["place"] + at, at, min(self.most, f["windows"] - at))
                for f in self.files if self.split in (None, f["key"][0]) for at in range(0, f["windows"], self.most)]

    def read(self, part: Range | None) -> Iterator[pa.RecordBatch]:
        if part is None:                                   # no windows at all
            return
        split, source, shard = part.key
        for at in range(0, part.windows, 512):
            n = min(512, part.windows - at)
            ids = read_windows(os.path.join(self.path, part.file), self.seq_len, part.skip + at, n)
            window = window_at(part.place + at + np.arange(n), split, self.val_every)
            yield pa.record_batch([pa.array([split] * n), pa.array([source] * n), pa.array(np.full(n, shard, np.int32)), pa.array(window, pa.int64()),
                                   _lists(ids)], names=["split", "source", "tok_shard", "window_id", "ids"])


def _lists(ids: np.ndarray) -> pa.Array:
    off = np.arange(len(ids) + 1, dtype=np.int32) * ids.shape[1]
    return pa.ListArray.from_arrays(pa.array(off), pa.array(ids.astype(np.int32).ravel()))


def read_windows(file: str, seq_len: int, first: int, n: int) -> np.ndarray:
    """``n`` windows of a file from window ``first`` on; no other bytes are read."""
    with open(file, "rb") as fh:
        body = os.pread(fh.fileno(), n * seq_len * 2, first * seq_len * 2)
    return np.frombuffer(body, "<u2").reshape(n, seq_len)


class TokenWindows(DataSource):
    """``spark.read.format("token_windows").option("split", "train").load(path)``; see ``write_windows``."""

    @classmethod
    def name(cls) -> str:
        return "token_windows"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WindowReader:
        return WindowReader(self.options)

    def writer(self, schema, overwrite: bool) -> WindowWriter:
        return WindowWriter(self.options, overwrite)


def mounted(uri: str) -> str:
    """The local path of a file URI or path."""
    scheme, _, rest = uri.partition(":") if ":" in uri.split("/")[0] else ("", "", uri)
    if scheme not in ("", "file"):
        raise ValueError(f"{uri}: window files need a mounted file system")
    return "/" + rest.lstrip("/") if scheme else rest


# --- use --------------------------------------------------------------------------------------------------------

def write_windows(windows: DataFrame, path: str, seq_len: int, val_every: int, file_windows: int = 1 << 19) -> None:
    """Write ``windows`` (split, source, tok_shard, window_id, ids). Ranges of windows are dealt over the tasks, so a shard that
    holds most of them becomes several files."""
    windows.sparkSession.dataSource.register(TokenWindows)
    order = [*KEY, "window_id"]
    (windows.select(*order, "ids").repartitionByRange(*order).sortWithinPartitions(*order)
     .write.format("token_windows").option("seqLen", seq_len).option("valEvery", val_every).option("fileWindows", file_windows)
     .mode("overwrite").save(path))


def read_table(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """The windows of ``path`` as rows."""
    spark.dataSource.register(TokenWindows)
    r = spark.read.format("token_windows")
    return (r.option("split", split) if split else r).load(path)


def fetch(plan: DataFrame, path: str, split: str = "train") -> DataFrame:
    """``plan`` (source, tok_shard, window_id and any columns) with the ``ids`` of each window, read by position.

    The file of a window follows from the manifest (a row a file) and its place in the file by arithmetic; a task reads a window's own
    bytes, in file order."""
    spark, m = plan.sparkSession, manifest(path)
    seq_len, val_every = m["seq_len"], m["val_every"]
    files = spark.createDataFrame([(f["key"][1], f["key"][2], f["place"], f["place"] + f["windows"], f["file"])
                                   for f in m["files"] if f["key"][0] == split],
                                  "_source string, _shard int, _from bigint, _to bigint, _file string")
    place = place_of(F.col("window_id"), split, val_every).cast("bigint")
    found = (plan.withColumn("_place", place)
             .join(files, (F.col("source") == F.col("_source")) & (F.col("tok_shard") == F.col("_shard"))
                   & (F.col("_place") >= F.col("_from")) & (F.col("_place") < F.col("_to")))
             .withColumn("_skip", F.col("_place") - F.col("_from")).drop("_source", "_shard", "_from", "_to", "_place"))
    keep = plan.columns
    schema = ", ".join(f"`{c}` {t}" for c, t in plan.dtypes) + ", ids array<int>"

    def read(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                col = {n: some.column(k) for k, n in enumerate(some.schema.names)}
                ids = np.empty((some.num_rows, seq_len), "<u2")
                name, fh = None, None
                for k, (file, skip) in enumerate(zip(col["_file"].to_pylist(), col["_skip"].to_pylist())):
                    if file != name:
                        if fh:
                            fh.close()
                        name, fh = file, open(os.path.join(path, file), "rb")
                    ids[k] = np.frombuffer(os.pread(fh.fileno(), seq_len * 2, skip * seq_len * 2), "<u2")
                if fh:
                    fh.close()
                yield pa.RecordBatch.from_arrays([*(col[c] for c in keep), _lists(ids)], names=[*keep, "ids"])

    return found.sortWithinPartitions("_file", "_skip").mapInArrow(read, schema)
