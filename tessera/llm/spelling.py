"""Spelling variant grouping by finite-state composition.

Two words are near if one edit (a code point inserted, deleted or replaced) turns one into the other. The pairs
are the accepted paths of ``V o E o V``: the minimised vocabulary acceptor, a transducer that makes exactly one
edit, and the acceptor again. Until the edit both copies of ``V`` read the same symbols, so they stand in the same
state; after it they read the same symbols from two states on, and a pair of states is intersected once however
many prefixes lead to it.

Plan:

1. Words are counted slice by slice inside Arrow batches, then by a grouped sum. What the query's contract alters
   (one code point of a run, chosen by a CRC of document and run) comes from CRC combination, all runs at once.
2. The paths are enumerated per initial state: a state that a prefix reaches and that has at most ``node_words``
   words below it. One Python group builds the minimised acceptor from there and composes it. Prefixes with more
   words than that are branched on: their states' own edit arcs (an edit right after the prefix) are the pairs that
   agree in prefix and remainder, an equi-join whose groups hold at most a word a letter. So no group grows with the
   vocabulary, and no edit is left out.
3. A word keeps its number of near words and the best of them, never a list; roots come by pointer doubling.

Cases: null text has no runs; a null doc_id is written as nothing before the colon; repeated rows count again; a run
that loses its only code point and words under ``min_length`` are no words; ties go to the smallest word in
code-point order; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, ascii_lower_bytes, cut_strings, released, run_starts, slices, text_bytes

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LEAD = 0xC3        # first byte of U+00C0 .. U+00FF, and of nothing else


@dataclass(frozen=True)
class SpellingConfig:
    min_length: int = 6       # code points of a word
    min_count: int = 5        # occurrences of a word
    ratio: int = 5            # a form has at least so many times its variant's occurrences
    alter: int = 199          # every run whose CRC it divides loses a code point; 0: none does
    node_words: int = 4096    # words of an initial state's acceptor
    levels: int = 8           # prefix lengths counted in one job


# --- words ------------------------------------------------------------------------------------------------------

def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> 1), c >> 1)
    return c.astype(np.uint32)


def _shift_tables(longest: int) -> np.ndarray:
    """[length, byte, value]: what each byte of a CRC becomes when ``length`` more bytes follow."""
    table = _crc_table()
    state = (np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32))
    out = np.empty((longest + 1, 4, 256), np.uint32)
    for length in range(longest + 1):
        out[length] = state
        state = (state >> 8) ^ table[state & 255]
    return out


_LONGEST = 64
_SHIFT = _shift_tables(_LONGEST)


def letter_runs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(codes, rows, distinct runs): the maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased, in order."""
    data, off = text_bytes(texts)
    data = ascii_lower_bytes(data)
    lead = data == _LEAD
    keep = _LETTER[data] | lead
    keep[1:] |= lead[:-1]
    pos, strings = cut_strings(data, run_starts(keep, off), keep)
    encoded = strings.dictionary_encode()
    return np.asarray(encoded.indices), np.searchsorted(off, pos, side="right") - 1, encoded.dictionary.to_pylist()


def run_crcs(codes: np.ndarray, rows: np.ndarray, runs: list[str], ids: list) -> np.ndarray:
    """Unsigned CRC-32 of ``<id>:<run>`` of every occurrence: the CRC of the id carried over the run's length."""
    raw = [r.encode() for r in runs]
    own = np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw))
    size = np.fromiter(map(len, raw), np.int64, len(raw))[codes]
    heads = [f"{'' if i is None else i}:".encode() for i in ids]
    head = np.fromiter(map(zlib.crc32, heads), np.uint32, len(heads))[rows]
    short = np.minimum(size, _LONGEST)
    out = own[codes]
    for k in range(4):
        out ^= _SHIFT[short, k, (head >> np.uint32(8 * k)) & np.uint32(255)]
    for at in np.flatnonzero(size > _LONGEST):
        out[at] = zlib.crc32(heads[rows[at]] + raw[codes[at]])
    return out


def word_counts(documents: DataFrame, cfg: SpellingConfig = SpellingConfig()) -> DataFrame:
    """(word, n) of all words with ``min_count`` occurrences in whole texts."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                codes, rows, runs = letter_runs(part.column("text"))
                hit = np.zeros(len(codes), bool)
                altered = Counter()
                if cfg.alter and len(codes):
                    crc = run_crcs(codes, rows, runs, part.column("doc_id").to_pylist())
                    hit = crc % np.uint32(cfg.alter) == 0
                    for code, h in zip(codes[hit].tolist(), crc[hit].tolist()):
                        k = h % len(runs[code])
                        altered[runs[code][:k] + runs[code][k + 1:]] += 1
                times = np.bincount(codes[~hit], minlength=len(runs))
                lengths = np.fromiter(map(len, runs), np.int64, len(runs))
                keep = np.flatnonzero((times > 0) & (lengths >= cfg.min_length))
                more = [(w, n) for w, n in altered.items() if len(w) >= cfg.min_length]
                yield pa.record_batch([pa.array([runs[k] for k in keep] + [w for w, _ in more], pa.string()),
                                       pa.array(times[keep].tolist() + [n for _, n in more], pa.int64())], names=["word", "n"])

    counted = documents.select("doc_id", "text").mapInArrow(released(run), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= cfg.min_count)


# --- the acceptor and its composition ---------------------------------------------------------------------------

class Acceptor:
    """Minimal deterministic acceptor of sorted distinct words; a state's arcs carry the index of the first word behind them.

    States are numbered children first, the start last. Words count from 0 in order, in every state's own language.
    """

    def __init__(self, words: list[str]):
        self.final: list[bool] = []
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.size: list[int] = []
        known: dict = {}
        path, before = [(False, [])], ""
        for word in words:
            same = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                same += 1
            self._freeze(path, same + 1, known)
            for symbol in word[same:]:
                path[-1][1].append((symbol, None))
                path.append((False, []))
            path[-1] = (True, path[-1][1])
            before = word
        self._freeze(path, 1, known)
        self.start = self._state(path[0], known)

    def _freeze(self, path: list, keep: int, known: dict) -> None:
        while len(path) > keep:
            state = self._state(path.pop(), known)
            arcs = path[-1][1]
            arcs[-1] = (arcs[-1][0], state)

    def _state(self, node, known: dict) -> int:
        final, arcs = node
        key = (final, tuple(arcs))
        if key not in known:
            known[key] = len(self.final)
            at, placed = int(final), {}
            for symbol, target in arcs:
                placed[symbol] = (target, at)
                at += self.size[target]
            self.final.append(final)
            self.arcs.append(placed)
            self.size.append(at)
        return known[key]


class Composition:
    """Accepted pairs of ``V o E o V`` for one acceptor ``V``, as word indices."""

    def __init__(self, acceptor: Acceptor):
        self.v = acceptor
        self.shared: dict[tuple[int, int], tuple | None] = {}

    def _arcs(self, s: int, t: int, skip: str | None):
        a, b = self.v.arcs[s], self.v.arcs[t]
        small = a if len(a) <= len(b) else b
        return [(a[c], b[c]) for c in small if c in a and c in b and c != skip]

    def _join(self, s: int, t: int, skip: str | None = None):
        """Words both states accept, none that begins with ``skip``: their indices in each; all pairs below are known."""
        left, right = [], []
        if self.v.final[s] and self.v.final[t]:
            left.append(np.zeros(1, np.int64))
            right.append(left[0])
        for (x, at_x), (y, at_y) in self._arcs(s, t, skip):
            if x == y:
                i = j = np.arange(self.v.size[x])
            else:
                found = self.shared[min(x, y), max(x, y)]
                if found is None:
                    continue
                i, j = found if x < y else found[::-1]
            left.append(i + at_x)
            right.append(j + at_y)
        return (np.concatenate(left), np.concatenate(right)) if left else None

    def _below(self, s: int, t: int, skip: str | None = None):
        return [(min(x, y), max(x, y)) for (x, _), (y, _) in self._arcs(s, t, skip)
                if x != y and (min(x, y), max(x, y)) not in self.shared]

    def _settle(self, todo: list) -> None:
        """Intersect pairs of states, those below them first."""
        while todo:
            pair = todo[-1]
            below = [] if pair in self.shared else self._below(*pair)
            if below:
                todo.extend(below)
            else:
                if pair not in self.shared:
                    self.shared[pair] = self._join(*pair)
                todo.pop()

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Each near pair once, as (index, index)."""
        v, done = self.v, []
        for q in range(len(v.final)):
            left, right = [], []
            arcs = list(v.arcs[q].items())
            for k, (symbol, (s, at_s)) in enumerate(arcs):
                left.append(done[s][0] + at_s)                           # the edit comes later
                right.append(done[s][1] + at_s)
                for _, (t, at_t) in arcs[k + 1:]:                        # replaced here
                    if s == t:
                        found = (np.arange(v.size[s]),) * 2
                    else:
                        self._settle([(min(s, t), max(s, t))])
                        found = self.shared[min(s, t), max(s, t)]
                        found = found if found is None or s < t else found[::-1]
                    if found is not None:
                        left.append(found[0] + at_s)
                        right.append(found[1] + at_t)
                # deleted here: the other word goes on with another symbol, so each pair has one place
                self._settle(self._below(s, q, symbol))
                found = self._join(s, q, symbol)
                if found is not None:
                    left.append(found[0] + at_s)
                    right.append(found[1])
            none = np.zeros(0, np.int64)
            done.append((np.concatenate(left or [none]), np.concatenate(right or [none])))
        return done[v.start]


def near_in(words: list[str], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted words: how many are near, and the index of the near word of largest count (first in order on ties; -1: none)."""
    a, b = Composition(Acceptor(words)).pairs()
    me, other = np.concatenate([a, b]), np.concatenate([b, a])
    order = np.lexsort((other, -counts[other], me))
    me, other = me[order], other[order]
    first = np.flatnonzero(np.diff(me, prepend=-1))
    best = np.full(len(words), -1, np.int64)
    best[me[first]] = other[first]
    return np.bincount(me, minlength=len(words)), best


# --- partitions by initial state --------------------------------------------------------------------------------

def crowded(words: DataFrame, scratch: Scratch, cfg: SpellingConfig) -> DataFrame | None:
    """(prefix, p): the prefixes of ``p`` > 0 code points that more than ``node_words`` words share; None if all words fit one state."""
    if words.limit(cfg.node_words + 1).count() <= cfg.node_words:
        return None
    found, active, low = [], words, 1
    while True:
        prefixes = (f"transform(sequence({low}, least(length(word), {low + cfg.levels - 1})), "
                    "k -> struct(substring(word, 1, k) AS prefix, k AS p))")
        each = active.where(F.length("word") >= low).select(F.explode(F.expr(prefixes)).alias("x"))
        big = scratch.write(each.groupBy("x.prefix", "x.p").count().where(F.col("count") > cfg.node_words)
                            .select("prefix", "p"), f"crowded-{low}")
        found.append(big)
        deepest = big.where(F.col("p") == low + cfg.levels - 1)
        if not deepest.limit(1).count():
            break
        active = scratch.write(words.join(deepest.select("prefix"), F.substring("word", 1, low + cfg.levels - 1) == F.col("prefix"),
                                          "left_semi"), f"active-{low}")
        low += cfg.levels
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def with_depth(words: DataFrame, big: DataFrame | None) -> DataFrame:
    """``words`` with ``depth``: the length of the shortest prefix that is not crowded (0: the start itself)."""
    if big is None:
        return words.withColumn("depth", F.lit(0))
    top = big.agg(F.coalesce(F.max("p"), F.lit(0))).first()[0]
    ps = words.select("word", F.explode(F.expr(f"sequence(1, least(length(word), {max(top, 1)}))")).alias("p"))
    deep = (ps.withColumn("prefix", F.expr("substring(word, 1, p)")).join(big, ["prefix", "p"])
            .groupBy("word").agg(F.max("p").alias("deepest")))
    return words.join(deep, "word", "left").select("word", "n", (F.coalesce("deepest", F.lit(0)) + 1).alias("depth"))


NEAR = "word string, n_near long, best struct<less: long, word: string>"


def composed(words: DataFrame, cfg: SpellingConfig) -> DataFrame:
    """Near words below each initial state (word, n_near, best), by composition."""
    # small rows, much work: dealt by the count of words, not by bytes
    tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), words.count() // (4 * cfg.node_words))
    dealt = (words.where(F.col("depth") <= F.length("word"))
             .select(F.expr("substring(word, 1, depth)").alias("node"), "word", "n", "depth")
             .repartition(tasks, "node").sortWithinPartitions("node", "word"))

    def flush(node):
        words, counts, depth = node
        if len(words) < 2:
            return None
        n = np.array(counts, np.int64)
        near, best = near_in([w[depth:] for w in words], n)
        has = np.flatnonzero(near)
        return pa.record_batch([pa.array([words[k] for k in has], pa.string()), pa.array(near[has], pa.int64()),
                                pa.StructArray.from_arrays([pa.array(-n[best[has]], pa.int64()),
                                                            pa.array([words[k] for k in best[has]], pa.string())],
                                                           names=["less", "word"])], names=["word", "n_near", "best"])

    def run(batches):
        name, node = None, ([], [], 0)
        for batch in batches:
            for key, word, n, depth in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if key != name:
                    made = flush(node)
                    if made is not None:
                        yield made
                    name, node = key, ([], [], depth)
                node[0].append(word)
                node[1].append(n)
        made = flush(node)
        if made is not None:
            yield made

    return dealt.mapInArrow(released(run), NEAR)


def edited_above(words: DataFrame) -> DataFrame:
    """Near words whose edit comes above the initial states (word, n_near, best): right after a crowded prefix."""
    at = words.select("word", "n", F.explode(F.expr("sequence(1, least(depth, length(word)))")).alias("k"))
    cut = at.select("word", "n", "k", F.expr("concat(substring(word, 1, k - 1), substring(word, k + 1))").alias("rest"),
                    # of equal symbols in a row the last is the one deleted
                    F.expr("substring(word, k, 1) <> substring(word, k + 1, 1)").alias("last"))
    better = lambda n, w: F.struct((-n).alias("less"), w.alias("word"))
    # replaced: a group holds at most one word a letter
    group = (cut.groupBy("rest", "k").agg(F.collect_list(better(F.col("n"), F.col("word"))).alias("all")).where(F.size("all") > 1)
             .select("all", F.explode("all").alias("me")))
    replaced = group.select(F.col("me.word").alias("word"), (F.size("all") - 1).cast("long").alias("n_near"),
                            F.array_min(F.filter("all", lambda x: x["word"] != F.col("me.word"))).alias("best"))
    shorter = words.select(F.col("word").alias("rest"), F.col("n").alias("rest_n"))
    pairs = cut.where("last").join(shorter, "rest")
    one = F.lit(1).cast("long").alias("n_near")
    deleted = pairs.select("word", one, better(F.col("rest_n"), F.col("rest")).alias("best"))
    inserted = pairs.select(F.col("rest").alias("word"), one, better(F.col("n"), F.col("word")).alias("best"))
    return replaced.unionByName(deleted).unionByName(inserted)


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of every (word, form): the last form reached. Counts grow along forms, so there are no circles."""
    now, turn = scratch.write(forms.select("word", F.col("form").alias("root")), "roots-0"), 0
    while True:
        turn += 1
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = scratch.write(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                   F.col("next").isNotNull().alias("moved")), f"roots-{turn}")
        scratch.drop(f"roots-{turn - 1}")
        now = new.select("word", "root")
        if not new.where("moved").limit(1).count():
            return now


def variants(documents: DataFrame, cfg: SpellingConfig = SpellingConfig()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``documents`` (doc_id, text)."""
    scratch = Scratch(documents.sparkSession)
    words = scratch.write(word_counts(documents, cfg), "words")
    return group_words(words, scratch, cfg)


def group_words(words: DataFrame, scratch: Scratch, cfg: SpellingConfig = SpellingConfig()) -> DataFrame:
    """The same for a written table of distinct (word, n)."""
    big = crowded(words, scratch, cfg)
    placed = scratch.write(with_depth(words, big), "placed")
    found = composed(placed, cfg)
    if big is not None:
        found = found.unionByName(edited_above(placed))
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    is_form = -F.col("best.less") >= cfg.ratio * F.col("n")
    judged = scratch.write(
        words.join(near, "word", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "judged")
    ends = roots(judged.where("form IS NOT NULL"), scratch)
    return (judged.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


#: DuckDB form: CRC by bytes, near pairs by deletion keys over the whole vocabulary.
SQL = """
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda c: list_reduce(list_prepend(c, range(8)),
    lambda a, k: CASE WHEN (a & 1) = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc, run, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents) GROUP BY 1, 2),
coded AS (
  SELECT run, c, hex(encode(doc || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, c, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(x), 2),
      lambda i: 16 * (instr('0123456789ABCDEF', x[i]) - 1) + instr('0123456789ABCDEF', x[i + 1]) - 1)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM coded, tab),
results AS (
  SELECT CASE WHEN h % {alter} = 0 THEN run[1:(h % length(run))] || run[(h % length(run)) + 2:] ELSE run END AS word, c FROM hashed),
v AS (
  SELECT word, sum(c)::BIGINT AS n FROM results WHERE length(word) >= {min_length} GROUP BY word HAVING sum(c) >= {min_count}),
cut AS (
  SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, v.word, v.n FROM cut c JOIN v ON c.rest = v.word
  UNION SELECT v.word, c.word, c.n FROM cut c JOIN v ON c.rest = v.word),
ranked AS (
  SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
    row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS k FROM pairs),
judged AS (
  SELECT v.word, v.n, coalesce(r.n_near, 0)::BIGINT AS n_near,
    CASE WHEN r.other_n >= {ratio} * v.n THEN r.other END AS form, CASE WHEN r.other_n >= {ratio} * v.n THEN r.other_n END AS form_n
  FROM v LEFT JOIN ranked r ON r.word = v.word AND r.k = 1),
walk AS (
  SELECT word, word AS root, form AS ahead FROM judged
  UNION ALL SELECT w.word, j.word, j.form FROM walk w JOIN judged j ON j.word = w.ahead)
SELECT j.word, j.form, w.root, j.n, j.n_near, j.form_n::BIGINT AS form_n FROM judged j JOIN walk w ON w.word = j.word AND w.ahead IS NULL"""


def sql(cfg: SpellingConfig = SpellingConfig()) -> str:
    return SQL.format(alter=cfg.alter, min_length=cfg.min_length, min_count=cfg.min_count, ratio=cfg.ratio)
