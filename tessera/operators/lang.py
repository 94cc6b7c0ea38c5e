"""Language decision for the ambiguous ASCII band (0.90 <= ratio < 0.99).

Default is the fallback rule ``ratio > 0.95``. This module is the pluggable
detector for that band: character-trigram profiles learned on Spark from
labelled documents (add-one smoothed log-probabilities), documents scored
against the profile table, argmax per document. Only band documents are scored.

Trigrams are counted and looked up in Arrow kernels, a slice of text at a time: a trigram is never a row of
its own. What leaves a kernel are a batch's distinct trigrams with their counts, or one narrow row per document.
The profile table is handed to the executors as files that their Python workers map into memory.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import config as C
from tessera.functions.memory import release
from tessera.functions.words import text_bytes
from tessera.session import checkpoint_dir, written

NGRAM = 3


def letter_text(s: Column, sample_chars: int | None = C.LANG_SAMPLE_CHARS) -> Column:
    """Lower-case letters only, runs of anything else as one space, padded; of the first ``sample_chars`` (None: all)."""
    some = s if sample_chars is None else F.substring(s, 1, sample_chars)
    body = F.trim(F.regexp_replace(F.lower(some), r"[^\p{L}]+", " "))
    return F.concat(F.lit(" "), body, F.lit(" "))


def char_ngrams(t: Column, n: int = NGRAM) -> Column:
    """All overlapping character n-grams (with multiplicity), in one regex pass:
    an empty match with a look-ahead capture at every position. The native form of what the kernels count."""
    return F.regexp_extract_all(t, F.lit("(?=(" + "." * n + "))"), 1)


# --- trigrams of letter text ------------------------------------------------------------------------------------

#: Bytes of text whose trigrams are held at once.
SLICE_BYTES = 1 << 18
#: Trigrams over an alphabet are numbered by a table of up to so many cells, above by sorting.
TABLE_CELLS = 1 << 20
#: What a character beyond the basic plane leaves as its second UTF-16 unit: ``char_ngrams`` begins a trigram there too.
HALF = ord("?")
#: Profile rows of one file.
FILE_ROWS = 4_000_000


def _characters(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)


def _numbered(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    """(distinct trigrams as 63-bit numbers, rising; how often each; the number of each place's one; the places, None: all)."""
    n = max(0, len(chars) - (NGRAM - 1))
    wide = chars[:n] > 0xFFFF
    at = np.repeat(np.arange(n), 1 + wide) if wide.any() else None
    seen = np.zeros(0x110000, bool)
    seen[chars] = True
    seen[HALF] |= at is not None
    letters = np.flatnonzero(seen)
    k = len(letters)
    rank = np.empty(0x110000, np.int32 if k ** NGRAM < 1 << 31 else np.int64)
    rank[letters] = np.arange(k)
    ids = rank[chars]
    if at is None:
        code = (ids[:n] * k + ids[1:n + 1]) * k + ids[2:]
    else:
        first = ids[at]
        first[1:][at[1:] == at[:-1]] = rank[HALF]
        code = (first * k + ids[at + 1]) * k + ids[at + 2]
    if k ** NGRAM <= TABLE_CELLS:
        times = np.bincount(code, minlength=k ** NGRAM)
        held = np.flatnonzero(times)
        number = np.empty(k ** NGRAM, np.int32)
        number[held] = np.arange(len(held), dtype=np.int32)
        number, times = number[code], times[held]
    else:
        held, number, times = np.unique(code, return_inverse=True, return_counts=True)
    return letters[held // (k * k)] << 42 | letters[held // k % k] << 21 | letters[held % k], times, number, at


def _summed(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, times = codes[order], times[order]
    begin = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[begin], np.add.reduceat(times, begin) if len(begin) else times


def _counted(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct trigrams, how often each) of the UTF-8 bytes of letter texts one after the other."""
    codes, times, at, tail = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0, np.zeros(0, np.uint32)
    while at < len(data):
        to = min(at + SLICE_BYTES, len(data))
        while to < len(data) and data[to] & 0xC0 == 0x80:
            to -= 1
        chars = np.concatenate([tail, _characters(data[at:to])])
        held, n, _, _ = _numbered(chars)
        codes.append(held)
        times.append(n)
        at, tail = to, chars[-(NGRAM - 1):]
    held, n = _summed(np.concatenate(codes), np.concatenate(times))
    # letter text has no two spaces in a row; two texts that meet have
    a, b, c = held >> 42, held >> 21 & 0x1FFFFF, held & 0x1FFFFF
    inside = (b != 32) | ((a != 32) & (c != 32))
    return held[inside], n[inside]


def _as_text(codes: np.ndarray) -> pa.Array:
    chars = np.stack([codes >> 42, codes >> 21 & 0x1FFFFF, codes & 0x1FFFFF], axis=1).astype(np.uint32)
    return pa.array(chars.view(f"<U{NGRAM}").ravel(), pa.string())


def _as_codes(grams: pa.Array) -> np.ndarray:
    chars = _characters(text_bytes(grams)[0]).reshape(-1, NGRAM).astype(np.int64)
    return chars[:, 0] << 42 | chars[:, 1] << 21 | chars[:, 2]


# --- profiles ---------------------------------------------------------------------------------------------------

def gram_counts(texts: DataFrame) -> DataFrame:
    """``(lang, gram, c)`` of ``texts(lang, _t)``, ``_t`` being letter text."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column(0).dictionary_encode(null_encoding="encode")
            for k, name in enumerate(lang.dictionary):
                codes, times = _counted(text_bytes(batch.column(1).filter(pa.array(np.asarray(lang.indices) == k)))[0])
                yield pa.RecordBatch.from_arrays([pa.array([name.as_py()] * len(codes), pa.string()), _as_text(codes), pa.array(times)],
                                                 names=["lang", "gram", "c"])
            release()

    parts = texts.select("lang", "_t").mapInArrow(count, "lang string, gram string, c bigint")
    return parts.groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def train_profiles(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """``(profile(lang, gram, delta), langs(lang, unseen))``:
    ``unseen = ln(1 / (N_lang + V))``, ``delta = ln((c + 1) / (N_lang + V)) - unseen``."""
    from tessera.sources.tables import spread
    t = spread(labelled).select(F.col(lang_col).alias("lang"), letter_text(F.coalesce(F.col(text_col), F.lit("")), None).alias("_t"))
    # read three times below (vocabulary size, language totals, profile)
    counts = written(gram_counts(t))
    v = counts.select("gram").distinct().count()  # one scalar
    langs = counts.groupBy("lang").agg(F.sum("c").alias("N")) \
        .select("lang", F.log(F.lit(1.0) / (F.col("N") + F.lit(v))).alias("unseen"), "N")
    profile = counts.join(F.broadcast(langs), "lang").select(
        "lang", "gram", (F.log((F.col("c") + 1) / (F.col("N") + F.lit(v))) - F.col("unseen")).alias("delta"))
    return profile, langs.select("lang", "unseen")


@dataclass(frozen=True)
class Published:
    """Files of a profile table; what tasks need to open it."""

    key: str
    files: tuple[str, ...]
    langs: tuple[str | None, ...]

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index in ``codes``, language, delta) of every profile row of the trigrams ``codes`` (in a task)."""
        held, lang, delta = _opened(self.key, self.files, self.langs)
        first = np.searchsorted(held, codes)
        rows = np.searchsorted(held, codes, side="right") - first
        at = np.arange(rows.sum()) + np.repeat(first - (np.cumsum(rows) - rows), rows)
        return np.repeat(np.arange(len(codes)), rows), lang[at], delta[at]


def publish(profile: DataFrame, langs: tuple[str | None, ...]) -> Published:
    """Write the profile in trigram order and hand its files to the executors."""
    spark = profile.sparkSession
    rows = written(profile.select("lang", "gram", "delta"))
    size, key = rows.count(), uuid.uuid4().hex
    path = f"{checkpoint_dir(spark)}/profile-{key}"
    # UTF-8 order of three characters is the order of their numbers
    rows.repartitionByRange(max(1, -(-size // FILE_ROWS)), "gram").sortWithinPartitions("gram", "lang").write.parquet(path)
    names = []
    for uri in sorted(spark.read.parquet(path).inputFiles()) if size else []:
        spark.sparkContext.addFile(uri)
        names.append(uri.rsplit("/", 1)[1])
    return Published(key, tuple(names), langs)


@lru_cache(maxsize=2)
def _opened(key: str, files: tuple[str, ...], langs: tuple[str | None, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigrams, languages as places in ``langs``, deltas) of all profile rows in trigram order, mapped into memory."""
    import pyarrow.compute as pc
    import pyarrow.parquet as pq
    from pyspark import SparkFiles
    kinds = {"gram": np.int64, "lang": np.int32, "delta": np.float64}
    if not files:
        return tuple(np.zeros(0, kind) for kind in kinds.values())
    base = os.path.join(SparkFiles.getRootDirectory(), f"profile-{key}")
    if not os.path.exists(f"{base}.done"):
        mine = f"{base}-{uuid.uuid4().hex}"
        outs = {col: open(f"{mine}.{col}", "wb") for col in kinds}
        for name in files:
            for batch in pq.ParquetFile(SparkFiles.get(name)).iter_batches():
                outs["gram"].write(_as_codes(batch.column("gram")).tobytes())
                outs["lang"].write(pc.index_in(batch.column("lang"), pa.array(langs, pa.string())).to_numpy(zero_copy_only=False).astype(np.int32).tobytes())
                outs["delta"].write(batch.column("delta").to_numpy(zero_copy_only=False).astype(np.float64).tobytes())
        # workers of an executor may do this side by side; each name is replaced whole
        for col, out in outs.items():
            out.close()
            os.replace(f"{mine}.{col}", f"{base}.{col}")
        open(f"{base}.done", "w").close()
    return tuple(np.memmap(f"{base}.{col}", kind, "r") for col, kind in kinds.items())


# --- scores -----------------------------------------------------------------------------------------------------

def _scored(texts: pa.Array, profile: Published) -> tuple[np.ndarray, np.ndarray]:
    """(trigrams, sum of deltas per language) of each letter text; a null one has none."""
    data, off = text_bytes(texts)
    n, sums, at = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(profile.langs))), 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(off, off[at] + SLICE_BYTES, side="right")) - 1)
        part = data[off[at]:off[to]]
        chars = _characters(part)
        begin = np.concatenate([[0], np.cumsum(part & 0xC0 != 0x80)])[off[at:to + 1] - off[at]]
        n[at:to] = np.maximum(np.diff(begin) - (NGRAM - 1), 0)
        codes, _, number, places = _numbered(chars)
        rows = np.flatnonzero(n[at:to])
        first = begin[rows]
        if places is not None:
            first = np.searchsorted(places, first)
            twice = places[1:][places[1:] == places[:-1]]
            row = np.searchsorted(begin, twice, side="right") - 1
            n[at:to] += np.bincount(row[twice <= begin[row + 1] - NGRAM], minlength=to - at)
        if len(rows):
            # places between two texts hold two spaces in a row, which no profile has
            gram, lang, delta = profile.of(codes)
            for k in range(len(profile.langs)):
                one = np.zeros(len(codes))
                one[gram[lang == k]] = delta[lang == k]
                sums[at + rows, k] = np.add.reduceat(one[number], first)
        at = to
    return n, sums


def _score_column(t: Column, profile: Published) -> Column:
    """Struct (n, s) of a letter text: its trigrams, and the sum of their deltas for each language; n is null for a null text."""
    @F.arrow_udf("struct<n: bigint, s: array<double>>")
    def score(texts: pa.Array) -> pa.Array:
        n, sums = _scored(texts, profile)
        none = np.asarray(texts.is_null())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * sums.shape[1], pa.int32()), pa.array(sums.ravel()))
        out = pa.StructArray.from_arrays([pa.array(n, pa.int64(), mask=none), lists], ["n", "s"])
        release()
        return out

    return score(t)


def detect(docs: DataFrame, keys: list[str], text_col: str, profile: DataFrame, langs: DataFrame) -> DataFrame:
    """``keys + [lang, is_english]``: argmax over languages of the trigram log-likelihood
    (ties to the smaller language name). Trigrams of documents with the same keys count for each of them;
    those of a document with a null key do not."""
    lang_rows = langs.orderBy("lang").collect()  # one row per language
    table = publish(profile, tuple(r["lang"] for r in lang_rows))
    t = docs.select(*keys, letter_text(F.col(text_col)).alias("_t"))
    null_key = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    t = t.select(*keys, _score_column(F.col("_t"), table).alias("_u"),
                 F.when(null_key, F.monotonically_increasing_id()).alias("_alone"))
    same = Window.partitionBy(*keys, "_alone")
    sums = [F.when(F.col("_alone").isNull(), F.sum(F.get("_u.s", F.lit(k))).over(same)).otherwise(F.lit(0.0)) for k in range(len(lang_rows))]
    scored = t.select(*keys, F.col("_u.n").alias("_n"), F.array(*sums).alias("_s"))
    cand = F.array(*[F.struct(F.lit(r["lang"]).alias("lang"),
                              (F.col("_n") * F.lit(r["unseen"]) + F.get("_s", F.lit(k))).alias("score"))
                     for k, r in enumerate(lang_rows)])
    best = F.array_sort(cand, lambda a, b: F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1)
                        .when(a["lang"] < b["lang"], -1).when(a["lang"] > b["lang"], 1).otherwise(0))
    return scored.select(*keys, F.element_at(best, 1)["lang"].alias("lang")) \
        .withColumn("is_english", F.col("lang") == "en")
