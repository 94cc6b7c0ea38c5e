"""Word views of Arrow text, and word sets of any size that every Python task can look up.

A word set is written once, as (hash, word) in hash order, to the shared folder. Spark hands its files to
each executor (``addFile``: executors fetch them from the shared file system); the first task there turns them into
two files that all its Python workers map into memory: the sorted 64-bit hashes and, in the same order, the words
themselves, which settle equal hashes. So a worker's memory holds only the pages it touches, nothing of the set
passes through the driver, and batch and stream use the same lookup, which needs no join.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir, written

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


# --- tokens -----------------------------------------------------------------------------------------------------

def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, and row offsets into them; null rows are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[off[0]:off[-1]] if body is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def letter_tokens(texts: pa.Array, least: int = 3) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(codes, row offsets, distinct tokens) of the runs of ``least`` ASCII letters or more, lower-cased."""
    data, off = text_bytes(texts)
    keep = _LETTER[data]
    edge = keep.copy()
    edge[1:] &= ~keep[:-1]
    first = off[:-1][off[:-1] < off[1:]]
    edge[first] = keep[first]
    begin = np.flatnonzero(edge)
    last = keep.copy()
    last[:-1] &= ~keep[1:]
    last[off[1:][off[1:] > off[:-1]] - 1] = keep[off[1:][off[1:] > off[:-1]] - 1]
    size = np.flatnonzero(last) + 1 - begin
    long = size >= least
    begin, size = begin[long], size[long]
    offsets = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    at = np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], size)
    body = data[at] | np.uint8(32)
    tokens = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(body)).dictionary_encode()
    return np.asarray(tokens.indices), np.searchsorted(begin, off), tokens.dictionary.to_pylist()


# --- word sets --------------------------------------------------------------------------------------------------

#: Words of one file of a set.
FILE_WORDS = 4_000_000


@dataclass(frozen=True)
class WordSet:
    """Name and files of a published set; what tasks need to open it."""

    key: str
    files: tuple[str, ...]
    size: int

    def holds(self, words: list[str]) -> np.ndarray:
        """Which of ``words`` are in the set (in a task)."""
        if not self.size or not words:
            return np.zeros(len(words), bool)
        hashes, held, cuts = _opened(self.key, self.files)
        want = np.fromiter((xxhash.xxh64_intdigest(w.encode(), 42) for w in words), np.uint64, len(words)).view(np.int64)
        at = np.searchsorted(hashes, want)
        found = np.zeros(len(words), bool)
        open_ = np.flatnonzero((at < len(hashes)) & (hashes[np.minimum(at, len(hashes) - 1)] == want))
        while len(open_):
            place = at[open_]
            file = np.searchsorted(cuts, place, side="right") - 1
            same = np.array([held[f][int(p - cuts[f])].as_py() == words[k] for f, p, k in zip(file, place, open_)], bool)
            found[open_[same]] = True
            # another word with this hash may follow
            open_ = open_[~same]
            at[open_] += 1
            open_ = open_[at[open_] < len(hashes)]
            open_ = open_[hashes[at[open_]] == want[open_]]
        return found


def publish(words: DataFrame, col: str = "word") -> WordSet:
    """Write the distinct non-null words of ``col`` as a set and hand its files to the executors."""
    spark = words.sparkSession
    rows = written(words.select(F.col(col).alias("word")).where(F.col(col).isNotNull()).distinct()
                   .select(F.xxhash64("word").alias("hash"), "word"))
    size, key = rows.count(), uuid.uuid4().hex
    path = f"{checkpoint_dir(spark)}/words-{key}"
    files = max(1, -(-size // FILE_WORDS))
    rows.repartitionByRange(files, "hash").sortWithinPartitions("hash", "word").write.parquet(path)
    names = []
    for uri in sorted(spark.read.parquet(path).inputFiles()) if size else []:
        spark.sparkContext.addFile(uri)
        names.append(uri.rsplit("/", 1)[1])
    return WordSet(key, tuple(names), size)


@lru_cache(maxsize=8)
def _opened(key: str, files: tuple[str, ...]):
    """(hashes, words of each file, first place of each file), mapped into memory."""
    import pyarrow.parquet as pq
    from pyspark import SparkFiles
    base = os.path.join(SparkFiles.getRootDirectory(), f"words-{key}")
    if not os.path.exists(f"{base}.done"):
        mine = f"{base}-{uuid.uuid4().hex}"
        with open(f"{mine}.hash", "wb") as out:
            for k, name in enumerate(files):
                table = pq.read_table(SparkFiles.get(name)).combine_chunks()
                out.write(table.column("hash").to_numpy().tobytes())
                with pa.OSFile(f"{mine}.{k}", "wb") as sink, pa.ipc.new_file(sink, pa.schema([("word", pa.large_string())])) as ipc:
                    ipc.write_batch(pa.record_batch([pa.concat_arrays(table.column("word").chunks).cast(pa.large_string())], names=["word"]))
        # workers of an executor may do this side by side; each name is replaced whole
        for end in ["hash", *map(str, range(len(files)))]:
            os.replace(f"{mine}.{end}", f"{base}.{end}")
        open(f"{base}.done", "w").close()
    hashes = np.memmap(f"{base}.hash", np.int64, "r")
    held = [pa.ipc.open_file(pa.memory_map(f"{base}.{k}")).get_batch(0).column(0) for k in range(len(files))]
    return hashes, held, np.cumsum([0, *[len(h) for h in held[:-1]]])
