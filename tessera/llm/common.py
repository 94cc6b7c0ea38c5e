"""Shared helpers: table scans, scratch tables in the cluster's shared folder, word views of Arrow text.

Words are the runs ``[^\\x20\\x09-\\x0D]+`` everywhere in this package.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.memory import release

WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]+"

#: Text bytes handled at once inside a Python task (a longer single text is one slice).
SLICE_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a private folder only where it is unset in local mode (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by driver and executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-llm-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


#: Bytes of an Arrow batch between the JVM and Python. Each is held several times over on both sides.
BATCH_BYTES = 8 << 20


@contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches of at most ``BATCH_BYTES`` for the jobs run inside."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


class Scratch:
    """Parquet tables of one job in the shared folder.

    A written table cuts lineage (a lost executor costs a re-read, not a recompute) and
    gives the optimizer a real size, so it broadcasts only what is small.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.base = spark, f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        with small_batches(self.spark):
            df.write.mode("overwrite").parquet(f"{self.base}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.base}/{name}")

    def drop(self, name: str) -> None:
        """Delete a table no later step reads."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Deal rows evenly over the shuffle partitions, for scans with fewer splits than cores have work for."""
    return df.repartition(*cols) if cols else df


# --- Arrow text -----------------------------------------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, and row offsets into them; null rows are empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(off):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[off[0]:off[-1]] if body is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def slices(batch: pa.RecordBatch, text_col: str = "text", limit: int = SLICE_BYTES):
    """The batch in row ranges of about ``limit`` text bytes each (at least one row)."""
    _, off = text_bytes(batch.column(batch.schema.get_field_index(text_col)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def released(run):
    """The Arrow function ``run``, giving free memory back to the system between batches and at its end: a Python worker
    outlives its task, and what it keeps adds to the next stage's."""
    def wrapped(batches):
        def each():
            for batch in batches:
                yield batch
                release()

        yield from run(each())
        release()

    return wrapped


def run_ends(starts: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, end) of the runs that begin where ``starts`` is set and last while ``keep`` is, up to the next start.

    Positions are counted per run, never per byte."""
    pos = np.flatnonzero(starts)
    last = keep.copy()
    last[:-1] &= ~keep[1:]
    stops = np.flatnonzero(last) + 1
    ends = stops[np.searchsorted(stops, pos, side="right")] if len(pos) else pos
    if len(pos) > 1:
        np.minimum(ends[:-1], pos[1:], out=ends[:-1])
    return pos, ends


def cut_strings(data: np.ndarray, starts: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """First bytes of the runs that begin where ``starts`` is set and hold the bytes where ``keep`` is set; their strings."""
    pos, ends = run_ends(starts, keep)
    offsets = np.zeros(len(pos) + 1, np.int64)
    np.cumsum(ends - pos, out=offsets[1:])
    return pos, pa.LargeStringArray.from_buffers(len(pos), pa.py_buffer(offsets), pa.py_buffer(data[keep]))


def ascii_lower_bytes(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lower-cased."""
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << np.uint8(5))


def run_starts(keep: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where maximal runs of ``keep`` begin; a row's end ends a run."""
    starts = keep.copy()
    starts[1:] &= ~keep[:-1]
    first = off[:-1][off[:-1] < off[1:]]
    starts[first] = keep[first]
    return starts


def words_of(texts: pa.Array, ascii_lower: bool = False) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(codes, row offsets, distinct words): word ``k`` of row ``i`` is ``words[codes[offsets[i] + k]]``."""
    data, off = text_bytes(texts)
    if ascii_lower:
        data = ascii_lower_bytes(data)
    keep = ~_SPACE[data]
    pos, strings = cut_strings(data, run_starts(keep, off), keep)
    encoded = strings.dictionary_encode()
    return np.asarray(encoded.indices), np.searchsorted(pos, off), encoded.dictionary.to_pylist()


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mixer (shift-multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def char_grams(words: list[str], low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``low``..``high``-character n-grams of `` word `` (a space marks each end): (word index, hash)."""
    chars = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    blank = chars == 32
    word = np.cumsum(blank) - 1
    owner, hashes = [], []
    for n in range(low, high + 1):
        m = len(chars) - n + 1
        if m <= 0:
            continue
        inner = np.cumsum(np.concatenate([[0], blank]))
        # blanks strictly inside a window belong to two words
        ok = (inner[n - 1:n - 1 + m] - inner[1:1 + m]) <= 0 if n > 2 else np.ones(m, bool)
        if n == 2:
            ok &= ~(blank[:-1] & blank[1:])
        elif n == 1:
            ok &= ~blank
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + chars[k:k + m]
        at = np.flatnonzero(ok)
        owner.append(word[at])
        hashes.append(mix64(h[at]))
    if not owner:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    owner, hashes = np.concatenate(owner), np.concatenate(hashes)
    inside = owner < len(words)
    return owner[inside], hashes[inside]


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (1-D or 2-D) over the row ranges of ``offsets``; empty ranges give 0."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))
