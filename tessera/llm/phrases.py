"""Phrase collocation mining with mergeable Misra-Gries summaries.

Phrases of 2 to ``max_words`` words are mined level by level; an n-gram can only be frequent where both (n-1)-grams
in it are. Each level reads the texts twice:

1. Summaries. A task counts the n-grams of a slice of text and deals them over hash partitions. A partition folds what
   it gets, in any order, into one Misra-Gries summary: over ``capacity`` counters, the (capacity + 1)-th largest count
   is taken from all and what reaches zero goes. The partition's mass is summed first and its capacity is
   more than mass / ``min_count``, so in all less than ``min_count`` is taken from any n-gram: each frequent one is
   left, whatever the order, with at least its count less what was taken. Memory follows the capacity, a
   ``min_count``-th of the mass, not the number of different n-grams.
2. Exact counts of what is left, by strings and a grouped sum. Which n-grams to count is told by a bit table of their hashes
   (at most ``2 ** max_bits`` bits, whatever the corpus): a wrong hit only costs a row, whose true count then drops it.

Hashes only ever add to a summary's count, so they lose nothing; every returned number comes from the exact counts.
Scores are exact decimals. The best of each language are found by a ranked window, which keeps ``top`` rows a task.

Cases: null text is empty; a null lang is ``und`` (and joins rows that say so); repeated rows count again; ties go by
count, then by the phrase's bytes; a language without candidates has no rows; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, ascii_lower_bytes, cut_strings, mix64, released, run_starts, slices, text_bytes

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"]] = _BREAK[10:14] = True
_WORD = ~_BREAK
_WORD[[9, 32]] = False

#: Text bytes counted at once.
COUNT_BYTES = 8 << 20


@dataclass(frozen=True)
class PhraseConfig:
    max_words: int = 3
    min_count: int = 10
    inside_percent: int = 50        # a phrase goes if a longer candidate that holds it has this share of its count
    scale: int = 1_000_000
    top: int = 2000
    partition_mass: int = 4_000_000   # n-grams a hash partition is meant for
    max_bits: int = 28


# --- n-grams of a slice -----------------------------------------------------------------------------------------

class Words:
    """The words of some texts: codes, languages, and whether the next word continues the piece."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        data, off = text_bytes(texts)
        data = ascii_lower_bytes(data)
        keep = _WORD[data]
        pos, strings = cut_strings(data, run_starts(keep, off), keep)
        encoded = strings.dictionary_encode()
        self.words = encoded.dictionary
        code = np.asarray(encoded.indices).astype(np.int64)
        row = np.searchsorted(off, pos, side="right") - 1
        piece = np.searchsorted(np.flatnonzero(_BREAK[data]), pos)
        self.follows = np.zeros(len(pos), bool)
        self.follows[:-1] = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
        lang = langs.dictionary_encode()
        self.langs = lang.dictionary.to_pylist()
        # a word of a language is a number below langs * words
        self.count = max(1, len(self.words) * len(self.langs))
        self.code = np.asarray(lang.indices).astype(np.int64)[row] * len(self.words) + code if len(pos) else code
        lang_hash = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in self.langs), np.uint64, len(self.langs))
        word_hash = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in self.words.to_pylist()), np.uint64, len(self.words))
        self.hash = mix64(word_hash[code] + (lang_hash[np.asarray(lang.indices)[row]] if len(pos) else np.zeros(0, np.uint64)))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first word, hash) of every n-gram within a piece."""
        key, ok = self.hash, np.ones(len(self.code), bool)
        for j in range(1, n):
            m = max(0, len(self.code) - j)
            ok = ok[:m] & self.follows[j - 1:j - 1 + m]
            key = mix64(key[:m] * np.uint64(0x9E3779B97F4A7C15) + self.hash[j:j + m])
        at = np.flatnonzero(ok)
        return at, key[at]

    def counted(self, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(a place, count) of each different n-gram that starts at ``at``; by codes, so exact."""
        same = self.code[at]
        for j in range(1, n):
            same = np.unique(same, return_inverse=True)[1] * self.count + self.code[at + j]
        _, first, times = np.unique(same, return_index=True, return_counts=True)
        return at[first], times

    def strings(self, at: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
        """(lang, phrase) of the n-grams at ``at``."""
        size = max(1, len(self.words))
        lang = pa.array(self.langs, pa.string()).take(pa.array(self.code[at] // size))
        parts = [self.words.take(pa.array(self.code[at + j] % size)) for j in range(n)]
        phrase = parts[0] if n == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
        return lang, phrase.cast(pa.string())


def slot(key: np.ndarray, partitions: int) -> np.ndarray:
    """Hash partition (upper half) and hash within it (lower half) of n-grams."""
    return ((key >> np.uint64(40)) % np.uint64(partitions)) << np.uint64(32) | (key & np.uint64(0xFFFFFFFF))


class Bits:
    """A bit table of n-grams; tells which may be in the set."""

    def __init__(self, shared, partitions: int):
        self.shared, self.partitions = shared, partitions

    def hit(self, key: np.ndarray) -> np.ndarray:
        table = self.shared.value
        place = mix64(slot(key, self.partitions)) & np.uint64(len(table) * 64 - 1)
        return (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0


def bit_table(keys: DataFrame, partitions: int, cfg: PhraseConfig) -> Bits:
    """The table of ``keys`` (mixed long), about 16 bits a key: at most 2 ** max_bits bits go through the driver."""
    spark = keys.sparkSession
    size = 1 << min(cfg.max_bits, max(16, int(16 * max(1, keys.count()) - 1).bit_length()))
    place = F.col("mixed").bitwiseAND(F.lit(size - 1))
    words = (keys.select(F.shiftright(place, 6).cast("int").alias("at"), place.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
             .groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))).toArrow()
    table = np.zeros(size >> 6, np.uint64)
    table[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return Bits(spark.sparkContext.broadcast(table), partitions)


def _parts(batches):
    for batch in batches:
        for part in slices(batch, limit=COUNT_BYTES):
            yield Words(part.column("text"), part.column("lang"))


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))


def _within(w: Words, n: int, lower: Bits | None) -> tuple[np.ndarray, np.ndarray]:
    """n-grams whose (n-1)-grams may both be frequent."""
    at, key = w.grams(n)
    if lower is None:
        return at, key
    low_at, low_key = w.grams(n - 1)
    may = np.zeros(len(w.code) + 1, bool)
    may[low_at] = lower.hit(low_key)
    ok = may[at] & may[at + 1]
    return at[ok], key[ok]


# --- summaries --------------------------------------------------------------------------------------------------

class Summary:
    """Misra-Gries counters of one hash partition; ``lost`` is what was taken from every count at most."""

    def __init__(self, mass: int, threshold: int):
        self.capacity = mass // threshold + 1
        self.threshold, self.lost = threshold, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.waiting, self.held = [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.held += len(keys)
        if self.held > max(self.capacity, 1 << 16):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *[k for k, _ in self.waiting]])
        counts = np.concatenate([self.counts, *[c for _, c in self.waiting]])
        self.waiting, self.held = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.diff(keys.astype(np.int64), prepend=-1))
        self.keys, self.counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        over = len(self.keys) - self.capacity
        if over > 0:
            take = int(np.partition(self.counts, over - 1)[over - 1])
            self.lost += take
            left = self.counts > take
            self.keys, self.counts = self.keys[left], self.counts[left] - take

    def survivors(self) -> np.ndarray:
        """Keys whose count may reach the threshold."""
        self.merge()
        return self.keys[self.counts + self.lost >= self.threshold]


def summarised(documents: DataFrame, n: int, lower: Bits, partitions: int, scratch: Scratch, cfg: PhraseConfig) -> DataFrame:
    """(mixed): hashes of the n-grams left by the summaries, every frequent one among them."""
    def count(batches):
        for w in _parts(batches):
            ids, times = np.unique(slot(_within(w, n, lower)[1], partitions), return_counts=True)
            part = (ids >> np.uint64(32)).astype(np.int64)
            key = (ids & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            cuts = np.concatenate([np.flatnonzero(np.diff(part, prepend=-1)), [len(part)]])
            rows = [[], [], [], [], []]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                k, t = key[lo:hi], times[lo:hi]
                one = t == 1
                for col, x in zip(rows, (part[lo], int(t.sum()), k[one].tobytes(), k[~one].tobytes(), t[~one].astype(np.int64).tobytes())):
                    col.append(x)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(rows, kinds)], names=["part", "mass", "ones", "keys", "times"])

    counted = scratch.write(_texts(documents).mapInArrow(released(count), "part long, mass long, ones binary, keys binary, times binary"), f"counted-{n}")
    none = [F.lit(None).cast("binary").alias(c) for c in ("ones", "keys", "times")]
    masses = counted.groupBy("part").agg(F.sum("mass").alias("mass")).select("part", F.lit(0).alias("kind"), "mass", *none)
    dealt = (masses.unionByName(counted.withColumn("kind", F.lit(1)))
             .repartition("part").sortWithinPartitions("part", "kind"))

    def fold(batches):
        part, summary = None, None

        def done():
            left = mix64(np.uint64(part) << np.uint64(32) | summary.survivors().astype(np.uint64))
            return pa.record_batch([pa.array(left.view(np.int64))], names=["mixed"])

        for batch in batches:
            col = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            for k in range(batch.num_rows):
                if col["kind"][k].as_py() == 0:                     # a partition begins with its mass
                    if summary is not None:
                        yield done()
                    part, summary = col["part"][k].as_py(), Summary(col["mass"][k].as_py(), cfg.min_count)
                    continue
                ones = np.frombuffer(col["ones"][k].as_py(), np.uint32)
                summary.add(ones, np.ones(len(ones), np.int64))
                summary.add(np.frombuffer(col["keys"][k].as_py(), np.uint32), np.frombuffer(col["times"][k].as_py(), np.int64))
        if summary is not None:
            yield done()

    left = scratch.write(dealt.mapInArrow(released(fold), "mixed long"), f"left-{n}")
    scratch.drop(f"counted-{n}")
    return left


# --- exact counts -----------------------------------------------------------------------------------------------

def counted(documents: DataFrame, n: int, lower: Bits | None, wanted: Bits | None, partitions: int) -> DataFrame:
    """(lang, phrase, mixed, n): exact counts of the n-grams in ``wanted`` (None: of all)."""
    def count(batches):
        for w in _parts(batches):
            at, key = _within(w, n, lower)
            if wanted is not None:
                at = at[wanted.hit(key)]
            at, times = w.counted(at, n)
            keys = np.zeros(len(w.code), np.uint64)
            every, hashes = w.grams(n)
            keys[every] = hashes
            mixed = mix64(slot(keys[at], partitions)).view(np.int64)
            lang, phrase = w.strings(at, n)
            yield pa.record_batch([lang, phrase, pa.array(mixed), pa.array(times, pa.int64())], names=["lang", "phrase", "mixed", "n"])

    rows = _texts(documents).mapInArrow(released(count), "lang string, phrase string, mixed long, n long")
    return rows.groupBy("lang", "phrase", "mixed").agg(F.sum("n").alias("n"))


def frequent(documents: DataFrame, scratch: Scratch, cfg: PhraseConfig) -> tuple[DataFrame, list[DataFrame]]:
    """(total words by lang), [(lang, phrase, mixed, n) of the frequent 1-, 2-, ... max_words-grams]."""
    words = scratch.write(counted(documents, 1, None, None, 1 << 20), "words")
    totals = scratch.write(words.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    mass = totals.agg(F.sum("total")).first()[0] or 0
    shuffles = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = min(1 << 23, max(shuffles, -(-mass // cfg.partition_mass)))
    levels = [scratch.write(words.where(F.col("n") >= cfg.min_count), "level-1")]
    lower = bit_table(levels[0], 1 << 20, cfg)
    for n in range(2, cfg.max_words + 1):
        left = bit_table(summarised(documents, n, lower, partitions, scratch, cfg), partitions, cfg)
        level = scratch.write(counted(documents, n, lower, left, partitions).where(F.col("n") >= cfg.min_count), f"level-{n}")
        levels.append(level)
        lower = bit_table(level, partitions, cfg)
    return totals, levels


def scored(levels: list[DataFrame], cfg: PhraseConfig) -> list[DataFrame]:
    """(lang, phrase, a, l, r, score) of the candidates of 2, 3, ... words: their lowest cut, the first on ties."""
    out = []
    for size in range(2, len(levels) + 1):
        rows = levels[size - 1].select("lang", "phrase", F.col("n").alias("a"))
        cuts = []
        for k in range(1, size):
            head = F.substring_index("phrase", " ", k)
            rows = rows.withColumn("_head", head).withColumn("_tail", F.expr(f"substring_index(phrase, ' ', {k - size})"))
            part = lambda m, key, name: levels[m - 1].select("lang", F.col("phrase").alias(key), F.col("n").alias(name))
            rows = (rows.join(part(k, "_head", "_l"), ["lang", "_head"]).join(part(size - k, "_tail", "_r"), ["lang", "_tail"]))
            score = F.expr(f"(CAST({cfg.scale} AS DECIMAL(38, 0)) * a * a) DIV (CAST(_l AS DECIMAL(38, 0)) * _r)")
            rows = rows.withColumn(f"_cut{k}", F.struct(score.alias("score"), F.lit(k).alias("k"), F.col("_l").alias("l"), F.col("_r").alias("r"))) \
                .drop("_head", "_tail", "_l", "_r")
            cuts.append(f"_cut{k}")
        low = F.array_min(F.array(*cuts))
        out.append(rows.withColumn("_low", low).select("lang", "phrase", "a", "_low.l", "_low.r", "_low.score"))
    return out


def mine(documents: DataFrame, cfg: PhraseConfig = PhraseConfig()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of ``documents`` (text, lang)."""
    scratch = Scratch(documents.sparkSession)
    totals, levels = frequent(documents, scratch, cfg)
    sized = [scratch.write(rows, f"scored-{k + 2}") for k, rows in enumerate(scored(levels, cfg))]
    kept = []
    for k, rows in enumerate(sized):
        inside = None
        for longer in range(k + 1, len(sized)):
            m, size = k + 2, longer + 2
            some = sized[longer].select("lang", "a", F.split("phrase", " ").alias("w")).select(
                "lang", "a", F.explode(F.array_distinct(F.array(*[F.array_join(F.slice("w", at, m), " ") for at in range(1, size - m + 2)]))).alias("phrase"))
            inside = some if inside is None else inside.unionByName(some)
        if inside is not None:
            most = inside.groupBy("lang", "phrase").agg(F.max("a").alias("_most"))
            rows = (rows.join(most, ["lang", "phrase"], "left")
                    .where(F.coalesce(100 * F.col("_most") < cfg.inside_percent * F.col("a"), F.lit(True))).drop("_most"))
        kept.append(rows)
    every = kept[0]
    for rows in kept[1:]:
        every = every.unionByName(rows)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= cfg.top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                            F.col("total").alias("n"), "score")


#: DuckDB form over exploded words, for two and three words.
SQL = """
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, words FROM (
    SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS words FROM (
      SELECT coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
      FROM documents WHERE text IS NOT NULL))),
grams AS (
  SELECT lang, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase, k
  FROM pieces, (SELECT unnest([1, 2, 3]) AS k) WHERE len(words) >= k),
f AS (SELECT lang, phrase, k, count(*) AS n FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, k AS size, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= {min_count}),
cuts AS (
  SELECT c.lang, c.phrase, c.size, c.a, c.w, cut, x.n AS l, y.n AS r, ({scale}::HUGEINT * c.a * c.a) // (x.n::HUGEINT * y.n) AS score
  FROM (SELECT *, unnest(range(1, size)) AS cut FROM cand) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ') AND x.k = cut
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:], ' ') AND y.k = c.size - cut),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM cand WHERE size = 3)
  GROUP BY lang, phrase),
kept AS (SELECT low.* FROM low LEFT JOIN inside i ON i.lang = low.lang AND i.phrase = low.phrase AND low.size = 2
  WHERE i.most IS NULL OR 100 * i.most < {inside} * low.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, rank, phrase, a, l, r, t.n, score::BIGINT AS score FROM ranked r JOIN total t ON t.lang = r.lang WHERE rank <= {top}"""


def sql(cfg: PhraseConfig = PhraseConfig()) -> str:
    return SQL.format(min_count=cfg.min_count, scale=cfg.scale, inside=cfg.inside_percent, top=cfg.top)
