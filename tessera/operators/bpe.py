"""Byte-level BPE: pretoken histogram, vocabulary training, encode, decode.

Training runs on Spark over the *distinct* pretokens, held as blocks of symbols on
the executors. Pair counts are kept, not recounted: a round settles the merges of the
most frequent pairs on the runs of symbols that these pairs form, rewrites the words
that hold one of them, and sums the signed changes. Ids: special tokens, then the 256 byte symbols ordered by
their printable stand-in, then merges.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import config as C
from tessera.functions.memory import release
from tessera.session import written

# Byte-level pretokeniser pattern (GPT-2 style), Unicode classes.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
JAVA_PRETOKEN = "(?U)" + PRETOKEN

SPECIALS = C.SPECIAL_TOKENS + C.CHAT_TOKENS
EOS_ID = SPECIALS.index("<|eos|>")


def byte_stand_in(b: int) -> int:
    """Code point of the printable stand-in of byte ``b`` (printable Latin-1 bytes
    stand for themselves, the others take 256, 257, ... in byte order)."""
    printable = (33 <= b <= 126) or (161 <= b <= 172) or (174 <= b <= 255)
    if printable:
        return b
    others = [x for x in range(256) if not ((33 <= x <= 126) or (161 <= x <= 172) or (174 <= x <= 255))]
    return 256 + others.index(b)


def byte_ids() -> list[int]:
    """Token id of each byte value 0..255: ordered by stand-in code point after the specials."""
    order = sorted(range(256), key=byte_stand_in)
    ids = [0] * 256
    for rank, b in enumerate(order):
        ids[b] = len(SPECIALS) + rank
    return ids


BYTE_IDS = byte_ids()
#: (left, right, new id, count) in merge order.
Merges = list[tuple[int, int, int, int]]
FIRST_MERGE_ID = len(SPECIALS) + 256


def pretokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(JAVA_PRETOKEN), 0)


def pretoken_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(pretoken, n)``: histogram of pretokens over the corpus (map-side combined)."""
    return (docs.select(F.explode(pretokens(F.col(text_col))).alias("pretoken"))
            .groupBy("pretoken").agg(F.count(F.lit(1)).alias("n")))


# --- training ---------------------------------------------------------------------------------------------------

#: A block of words: symbols of all of them (int32, each word closed by -1), their counts (int64), and the
#: signed pair counts that the last round changed.
BLOCK = "syms binary, n binary, l array<int>, r array<int>, d array<bigint>"
_LUT = np.array(BYTE_IDS, np.int32)


def _block(syms: np.ndarray, n: np.ndarray, keys: np.ndarray, deltas: np.ndarray) -> pa.RecordBatch:
    one = lambda x, t: pa.array([x], pa.list_(t))
    return pa.record_batch([pa.array([syms.tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary()),
                            one(keys >> 32, pa.int32()), one(keys & 0xFFFFFFFF, pa.int32()), one(deltas, pa.int64())],
                           names=["syms", "n", "l", "r", "d"])


def _pair_sums(syms: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pair keys, weighted counts) of adjacent symbols; ``weight`` is each symbol's word count."""
    left, right = syms[:-1].astype(np.int64), syms[1:].astype(np.int64)
    ok = np.flatnonzero((left >= 0) & (right >= 0))
    keys, at = np.unique((left[ok] << 32) | right[ok], return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, at, weight[ok])
    return keys, sums


def pack_words(counts: DataFrame, block_words: int = 1 << 16) -> DataFrame:
    """The histogram as blocks of at most ``block_words`` words, dealt evenly by a hash of the word."""
    words = written(counts.select("pretoken", F.col("n").cast("bigint").alias("n")).where(F.length("pretoken") > 0))
    parts = max(counts.sparkSession.sparkContext.defaultParallelism, -(-words.count() // block_words))

    def run(batches):
        texts, ns, held = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, block_words):
                some = batch.slice(at, block_words)
                texts += [t.encode() for t in some.column(0).to_pylist()]
                ns.append(np.asarray(some.column(1)))
                held += some.num_rows
                if held >= block_words:
                    yield made(texts, ns)
                    texts, ns, held = [], [], 0
        if held:
            yield made(texts, ns)

    def made(texts: list[bytes], ns: list[np.ndarray]) -> pa.RecordBatch:
        n = np.concatenate(ns)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        syms = np.full(int(size.sum()) + len(texts), -1, np.int32)
        inside = np.ones(len(syms), bool)
        inside[np.cumsum(size + 1) - 1] = False
        syms[inside] = _LUT[np.frombuffer(b"".join(texts), np.uint8)]
        return _block(syms, n, *_pair_sums(syms, np.repeat(n, size + 1)))

    return words.repartition(parts, "pretoken").mapInArrow(run, BLOCK)


def _hits(syms: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where one of ``pairs`` (sorted keys) begins, and which."""
    keys = (syms[:-1].astype(np.int64) << 32) | (syms[1:].astype(np.int64) & 0xFFFFFFFF)
    at = np.minimum(np.searchsorted(pairs, keys), len(pairs) - 1)
    hit = np.flatnonzero(pairs[at] == keys)
    return hit, at[hit]


def merge_words(syms: np.ndarray, word: np.ndarray, pairs: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, their words) after all ``pairs`` became ``ids``, in the ids' order and left to right.

    Each step merges, in every word, the pair of the smallest id; words without a pair left are laid aside. So two hits side by
    side are a run of equal symbols, of which every other place is taken.
    """
    done = []
    while len(syms):
        hit, at = _hits(syms, pairs)
        made, owner = ids[at], word[hit]
        first = np.full(int(word[-1]) + 1, np.iinfo(np.int32).max, np.int32)
        np.minimum.at(first, owner, made)
        open_ = first[word] < np.iinfo(np.int32).max
        done.append((syms[~open_], word[~open_]))
        hit, made = hit[made == first[owner]], made[made == first[owner]]
        if len(hit):
            begin = np.concatenate([[True], np.diff(hit) != 1])
            take = (hit - hit[begin][np.cumsum(begin) - 1]) % 2 == 0
            hit, made = hit[take], made[take]
        syms = syms.copy()
        syms[hit] = made
        open_[hit + 1] = False
        syms, word = syms[open_], word[open_]
    syms, word = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(word, kind="stable")
    return syms[order], word[order]


def merge_block(syms: np.ndarray, n: np.ndarray, pairs: np.ndarray, ids: np.ndarray):
    """(symbols, pair keys, signed changes) after all ``pairs`` (sorted keys) became ``ids``, in the ids' order.

    Only words that hold one of the pairs are rewritten and counted.
    """
    hit, _ = _hits(syms, pairs)
    if not len(hit):
        return syms, hit, hit
    ends = np.flatnonzero(syms == -1)
    sizes = np.diff(ends, prepend=-1)
    word = np.unique(np.searchsorted(ends, hit))
    size = sizes[word]
    here = np.zeros(len(sizes), bool)
    here[word] = True
    inside = np.repeat(here, sizes)                        # symbols of these words
    before = syms[inside]
    old, lost = _pair_sums(before, np.repeat(n[word], size))
    after, owner = merge_words(before, np.repeat(np.arange(len(word)), size), pairs, ids)
    new, won = _pair_sums(after, n[word][owner])
    sizes[word] = np.bincount(owner, minlength=len(word))
    inside_now = np.repeat(here, sizes)
    out = np.empty(len(inside_now), np.int32)
    out[inside_now], out[~inside_now] = after, syms[~inside]
    every, where = np.unique(np.concatenate([old, new]), return_inverse=True)
    change = np.zeros(len(every), np.int64)
    np.add.at(change, where, np.concatenate([-lost, won]))
    some = change != 0
    return out, every[some], change[some]


def merge_round(blocks: DataFrame, accepted: Merges) -> DataFrame:
    """The blocks after the accepted merges, with the pair counts they change."""
    order = sorted((l << 32 | r, nid) for l, r, nid, _ in accepted)
    pairs, ids = np.array([k for k, _ in order], np.int64), np.array([i for _, i in order], np.int32)

    def run(batches):
        for batch in batches:
            for s, n in zip(batch.column(0), batch.column(1)):
                n = np.frombuffer(n.as_buffer(), np.int64)
                syms, keys, change = merge_block(np.frombuffer(s.as_buffer(), np.int32), n, pairs, ids)
                yield _block(syms, n, keys, change)

    return blocks.select("syms", "n").mapInArrow(run, BLOCK)


def recount(blocks: DataFrame) -> DataFrame:
    """The blocks with all their pair counts."""
    def run(batches):
        for batch in batches:
            for s, n in zip(batch.column(0), batch.column(1)):
                syms, n = np.frombuffer(s.as_buffer(), np.int32), np.frombuffer(n.as_buffer(), np.int64)
                ends = np.flatnonzero(syms == -1)
                yield _block(syms, n, *_pair_sums(syms, np.repeat(n, np.diff(ends, prepend=-1))))

    return blocks.select("syms", "n").mapInArrow(run, BLOCK)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(l, r, c): the blocks' signed pair counts, summed."""
    return (blocks.select(F.explode(F.arrays_zip("l", "r", "d")).alias("p"))
            .groupBy("p.l", "p.r").agg(F.sum("p.d").alias("c")).where("c <> 0"))


def pair_runs(blocks: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
    """(run, n): the longest runs of symbols (int32) in which every two neighbours are one of ``pairs``, and how often each occurs."""
    keys = np.array(sorted(l << 32 | r for l, r in pairs), np.int64)

    def run(batches):
        for batch in batches:
            for s, n in zip(batch.column(0), batch.column(1)):
                syms, n = np.frombuffer(s.as_buffer(), np.int32), np.frombuffer(n.as_buffer(), np.int64)
                hit, _ = _hits(syms, keys)
                if not len(hit):
                    continue
                gap = np.diff(hit) != 1
                first, last = hit[np.concatenate([[True], gap])], hit[np.concatenate([gap, [True]])]
                size = last + 2 - first
                off = np.concatenate([[0], np.cumsum(size)])
                body = syms[np.arange(off[-1]) + np.repeat(first - off[:-1], size)]
                runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(off * 4), pa.py_buffer(body)])
                weight = n[np.searchsorted(np.flatnonzero(syms == -1), first)]
                sums = pa.table({"run": runs, "n": weight}).group_by("run").aggregate([("n", "sum")]).combine_chunks()
                yield pa.record_batch([sums.column("run").chunk(0).cast(pa.binary()), sums.column("n_sum").chunk(0)], names=["run", "n"])

    return blocks.select("syms", "n").mapInArrow(run, "run binary, n bigint").groupBy("run").agg(F.sum("n").alias("n"))


def settle(runs: Iterator[tuple[bytes, int]], bound: tuple[int, int, int] | None, next_id: int, vocab_size: int) -> Merges:
    """All merges up to ``bound`` in merge order, one by one, on the runs that the pairs up to ``bound`` form.

    Every place of such a pair, and of a pair that their merges make inside a run, lies in a run, so its count is exact. A pair
    across a run's end counts at most what the pair there did when the round began, and a new symbol's id is above all
    others: so it stays behind the bound.
    """
    words, weights, counts, where = [], [], {}, {}
    for run, n in runs:
        s = np.frombuffer(run, np.int32).tolist()
        for p in zip(s, s[1:]):
            counts[p] = counts.get(p, 0) + n
            where.setdefault(p, set()).add(len(words))
        words.append(s)
        weights.append(n)
    heap = [(-c, *p) for p, c in counts.items()]
    heapq.heapify(heap)
    out: Merges = []
    while heap and next_id < vocab_size and (bound is None or heap[0] <= bound):
        c, l, r = heapq.heappop(heap)
        if counts.get((l, r)) != -c:
            continue                                       # an older count
        changed = set()
        for k in where.pop((l, r)):
            s, n, i, made = words[k], weights[k], 0, []
            while i < len(s):
                if s[i] == l and i + 1 < len(s) and s[i + 1] == r:
                    made.append(next_id)
                    i += 2
                else:
                    made.append(s[i])
                    i += 1
            if len(made) == len(s):
                continue                                   # another merge took the pair here
            for p in zip(s, s[1:]):
                counts[p] -= n
                changed.add(p)
            for p in zip(made, made[1:]):
                counts[p] = counts.get(p, 0) + n
                where.setdefault(p, set()).add(k)
                changed.add(p)
            words[k] = made
        for p in changed:
            if counts[p] > 0:
                heapq.heappush(heap, (-counts[p], *p))
            else:
                del counts[p]
        out.append((l, r, next_id, -c))
        next_id += 1
    return out


class PairHead:
    """The pairs that come up to ``bound`` in merge order (count, then symbols), exactly: the next merges until none is left.

    A pair's count only grows in the round that makes its newer symbol, where all of it arrives as a change; so pairs
    behind the bound stay there, and the head needs no others until it is empty.
    """

    def __init__(self, size: int):
        self.size, self.bound, self.counts, self.heap = size, None, {}, []

    def fill(self, pairs: DataFrame) -> None:
        top = pairs.orderBy(F.desc("c"), "l", "r").limit(self.size + 1).toArrow()
        rows = [(-c, l, r) for l, r, c in zip(*(top.column(c).to_pylist() for c in ("l", "r", "c")))]
        self.bound = rows[self.size - 1] if len(rows) > self.size else None       # None: these are all
        self.heap = sorted(rows)[:self.size]
        self.counts = {(l, r): -c for c, l, r in self.heap}

    def change(self, changes: pa.Table) -> None:
        for l, r, d in zip(*(changes.column(c).to_pylist() for c in ("l", "r", "c"))):
            count = self.counts.get((l, r), 0) + d
            if count > 0 and (self.bound is None or (-count, l, r) <= self.bound):
                self.counts[l, r] = count
                heapq.heappush(self.heap, (-count, l, r))
            else:
                self.counts.pop((l, r), None)

    def first(self, k: int) -> tuple[list[tuple[int, int]], tuple[int, int, int] | None]:
        """The first ``k`` pairs in merge order, and the place (count, symbols) up to which they are all."""
        rows = heapq.nsmallest(k + 1, ((-c, *p) for p, c in self.counts.items()))
        return [p[1:] for p in rows[:k]], rows[k - 1] if len(rows) > k else self.bound

    def batch(self, next_id: int, vocab_size: int) -> Merges:
        """The next merges (l, r, id, count), as many as are sure to come in this order.

        A merge of (l, r) lowers only counts of pairs that end in l or begin with r, and any pair it makes counts at most
        what such a pair did. So the merges go on until a pair ends in an accepted left or begins with an accepted right
        symbol, or a symbol was paired with itself.
        """
        lefts, rights, out = set(), set(), []
        while self.heap and next_id < vocab_size:
            c, l, r = self.heap[0]
            if self.counts.get((l, r)) != -c:
                heapq.heappop(self.heap)                   # an older count
                continue
            if r in lefts or l in rights:
                break
            heapq.heappop(self.heap)
            del self.counts[l, r]
            out.append((l, r, next_id, -c))
            next_id += 1
            lefts.add(l)
            rights.add(r)
            if l == r:
                break
        return out


def next_merges(blocks: DataFrame, pairs: PairHead, some: int, next_id: int, vocab_size: int, max_runs: int) -> tuple[Merges, int]:
    """(the next merges, pairs to look at in the next round), by the first ``some`` pairs of the head and the runs they form.

    More than ``max_runs`` different runs do not go to the driver: then the head gives the merges that are sure without them.
    """
    if not pairs.counts:
        return [], some
    chosen, bound = pairs.first(some)
    runs = pair_runs(blocks, chosen).limit(max_runs + 1).toArrow()
    if runs.num_rows > max_runs:
        return pairs.batch(next_id, vocab_size), max(1, some // 4)
    merges = settle(zip(runs.column("run").to_pylist(), runs.column("n").to_pylist()), bound, next_id, vocab_size)
    return merges, some * 2 if 3 * runs.num_rows < max_runs else some


def train_bpe(counts: DataFrame, vocab_size: int = C.VOCAB_SIZE, head: int = C.TokenConfig.pair_head,
              write_every: int = 24, first_pairs: int = 64, max_runs: int = 1 << 16) -> Merges:
    """Learn merges from a pretoken histogram. Returns ``[(left, right, new_id, count)]`` in merge order
    (the merge table is bounded by the vocabulary size).

    Words stay in blocks on the executors. A round is two jobs. The first gives the runs that the most frequent pairs form,
    counted (at most ``max_runs``); on them the driver settles these pairs' merges, overlapping ones too. In the second each
    block rewrites the words that hold a merged pair and gives the changes of its pair counts; they are summed and only they
    reach the driver, which keeps the ``head`` most frequent pairs (all pairs are recounted only when these are used up).
    Blocks are persisted each round and written to the shared folder every ``write_every`` rounds, which cuts the lineage.
    """
    from pyspark import StorageLevel

    blocks = written(pack_words(counts))
    pairs = PairHead(head)
    pairs.fill(pair_counts(blocks))
    merges: Merges = []
    some = first_pairs
    held, rounds = [], 0                  # persisted frames, back to the last written one
    while FIRST_MERGE_ID + len(merges) < vocab_size:
        accepted, some = next_merges(blocks, pairs, some, FIRST_MERGE_ID + len(merges), vocab_size, max_runs)
        if not accepted:
            if pairs.bound is None:
                break
            pairs.fill(pair_counts(recount(blocks)))
            continue
        merges.extend(accepted)
        rounds += 1
        blocks = merge_round(blocks, accepted)
        if rounds % write_every:
            blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
        else:
            blocks = written(blocks)
        pairs.change(pair_counts(blocks).toArrow())
        for old in held:
            old.unpersist()
        held = [blocks] if rounds % write_every else []
    for old in held:
        old.unpersist()
    return merges


def merges_df(spark: SparkSession, merges: Merges) -> DataFrame:
    rows = [(rank, l, r, nid, c) for rank, (l, r, nid, c) in enumerate(merges)]
    return spark.createDataFrame(rows, "rank int, left_id int, right_id int, new_id int, pair_count bigint")


def load_merges(table: DataFrame) -> Merges:
    """The merge table as a list (bounded by the vocabulary size)."""
    rows = table.orderBy("rank").collect()
    return [(r.left_id, r.right_id, r.new_id, r.pair_count) for r in rows]


def vocab_bytes(merges: Merges) -> dict[int, bytes]:
    tok: dict[int, bytes] = {BYTE_IDS[b]: bytes([b]) for b in range(256)}
    for l, r, nid, _ in merges:
        tok[nid] = tok[l] + tok[r]
    return tok


def vocab_df(spark: SparkSession, merges: Merges) -> DataFrame:
    """``(token_id, token_hex, kind)`` for specials, byte symbols and merges."""
    rows = [(i, s.encode("utf-8").hex(), "special") for i, s in enumerate(SPECIALS)]
    tb = vocab_bytes(merges)
    rows += [(i, tb[i].hex(), "byte" if i < FIRST_MERGE_ID else "merge") for i in sorted(tb)]
    return spark.createDataFrame(rows, "token_id int, token_hex string, kind string")


def word_encoder(merges: Merges):
    """Ids of one pretoken: the lowest-rank adjacent pair is merged, leftmost first, until none is left."""
    ranks = {(l, r): (i, nid) for i, (l, r, nid, _) in enumerate(merges)}

    def encode(word: str) -> list[int]:
        # Positions are a linked list and candidate pairs a heap: n log n in the word's bytes. A merge only
        # makes pairs of higher rank than its own, so the heap order is the rank order.
        syms = [BYTE_IDS[b] for b in word.encode("utf-8")]
        n = len(syms)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*ranks[p], i, *p) for i in range(n - 1) if (p := (syms[i], syms[i + 1])) in ranks]
        heap = [(rank, i, nid, a, b) for rank, nid, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, nid, a, b = heapq.heappop(heap)
            j = after[i]
            if syms[i] != a or j >= n or syms[j] != b:
                continue                                   # a merge took one of the two
            syms[i], syms[j], after[i] = nid, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (p := (syms[left], syms[right])) in ranks:
                    rank, made = ranks[p]
                    heapq.heappush(heap, (rank, left, made, *p))
        return [s for s in syms if s >= 0]

    return encode


#: Pretokens a task remembers.
MEMO = 1_000_000


def encode_column(text: Column, merges: Merges) -> Column:
    """Ids of a text; NULL in, NULL out. Narrow: no explode, no shuffle.

    The JVM cuts the text into pretokens. The Arrow function encodes each different one of a batch once (the merge table, bounded by the
    vocabulary, is broadcast) and lays the ids out for all rows together."""
    sc = SparkSession.getActiveSession().sparkContext
    bc = sc.broadcast(merges)

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one, memo = word_encoder(bc.value), {}             # once per task
        for rows in batches:
            words = rows.flatten().dictionary_encode()
            made = []
            for w in words.dictionary.to_pylist():
                ids = memo.get(w)
                if ids is None:
                    ids = one(w)
                    if len(memo) < MEMO:
                        memo[w] = ids
                made.append(ids)
            size = np.fromiter(map(len, made), np.int64, len(made))
            flat = np.fromiter((i for ids in made for i in ids), np.int32, int(size.sum()))
            begin, codes = np.cumsum(size) - size, np.asarray(words.indices)
            each = size[codes]
            ends = np.cumsum(each)
            at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[codes] - (ends - each), each)
            per_row = np.cumsum(np.concatenate([[0], pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)]))
            off = np.concatenate([[0], ends])[per_row]
            yield pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat[at], pa.int32()), mask=rows.is_null())
            release()

    return encode(pretokens(text))


def decode_column(ids: Column, merges: Merges) -> Column:
    """ids -> text: each id's bytes from the vocabulary, in the ids' order, as UTF-8 (specials as their text; bytes that are no UTF-8 as
    U+FFFD). All in the JVM: the vocabulary is one constant array."""
    tb = vocab_bytes(merges)
    tb.update((i, s.encode("utf-8")) for i, s in enumerate(SPECIALS))
    vocab = F.split(F.lit(",".join(tb[i].hex() for i in range(len(tb)))), ",")
    return F.make_valid_utf8(F.unhex(F.array_join(F.transform(ids, lambda i: F.element_at(vocab, i + 1)), "")).cast("string"))
