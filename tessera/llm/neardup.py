"""MinHash near-dedup as a chosen-path set similarity join.

Documents are sets of word shingles. Equal sets are one class, stood for by its smallest doc_id.
A representative carries ``coords`` minwise values; a tree branches its documents at a node by
the values of one or two coordinates that a hash of the node's path selects (1 / threshold on
average, so a linked pair meets again in one child on average). Independent ``trees`` repeat this.

The join runs twice over, first on sketches, then exactly:

1. Candidates. Inside a node documents are compared by set sizes and 128 one-bit minwise sketches (a filter
   six standard deviations wide): pair by pair in nodes of at most ``leaf`` documents, all at once in nodes of at
   most ``block_limit``. Larger nodes first meet a pivot; a node whose members all reach it is done, any other branches
   on. Only edges that join the same rows are kept, about one a row and node: their components hold both ends of
   every pair that passes the filter in some node.
2. Links. Documents of a candidate component meet once with their full sets, in blocks of at most ``block``
   documents, and are compared unless a link found before puts them in one component already; so a group
   of thousands of near copies costs about a comparison per copy. Components over ``block_limit`` go through
   the same trees again with full sets instead of sketches: pivots, branching, then pairs or blocks.

There is no cap on depth, candidates or partners: a node that ``depth`` levels did not split is compared in
blocks whatever its size. With 16 trees a pair at the threshold is missed by one level of branching with
probability 0.16 ** 16; deeper levels only arise in nodes over ``block_limit`` documents.

Everything is Spark jobs over narrow tables in the shared folder; full sets are made only for documents with a
candidate and shuffled once. Links become components by distributed min-label propagation with pointer jumping.

Cases: null or empty text, or text without words, is an empty set, linked with nothing; with
fewer words than a shingle the whole sequence is one shingle; rows that repeat a doc_id are
judged each by its own text and (in ``dedup``) one of them stays; a null doc_id is never linked
(component NULL, kept); ties cannot arise, components are named by their smallest doc_id;
an empty table gives an empty result; other columns pass through ``dedup``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import Scratch, mix64, released, slices, words_of


@dataclass(frozen=True)
class NearConfig:
    words: int = 5          # words of a shingle
    percent: int = 80       # linked: 100 * intersection >= percent * union
    trees: int = 16
    leaf: int = 64          # nodes compared pair by pair
    block_limit: int = 8192  # nodes of sketches compared at once, nodes and components of full sets compared in blocks
    block: int = 1024       # documents of a block of full sets
    broadcast_ids: int = 4_000_000   # candidates' ids (a few dozen bytes each) are broadcast up to this count, else joined
    depth: int = 40
    seed: int = 11
    coords: int = 128       # minwise values; one bit of each fills the two sketch words

    @property
    def agree(self) -> int:
        """Least number of equal sketch bits: the mean at the threshold less six standard deviations."""
        p = (1 + self.percent / 100) / 2
        return int(np.floor(self.coords * p - 6 * np.sqrt(self.coords * p * (1 - p))))


# --- sets -------------------------------------------------------------------------------------------------------

_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def shingle_sets(texts: pa.Array, k: int):
    """Per row the sorted distinct 64-bit hashes of its ``k``-word shingles."""
    codes, offsets, words = words_of(texts, ascii_lower=True)
    each = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    h = each[codes]

    def joined(width: int, base: np.ndarray) -> np.ndarray:
        n = max(0, len(base) - width + 1)
        acc = np.full(n, width, np.uint64)
        for j in range(width):
            acc = (acc ^ base[j:j + n]) * _STEP[j % 3]
            acc ^= acc >> np.uint64(29)
        return mix64(acc)

    full = joined(k, h)
    for lo, hi in zip(offsets[:-1], offsets[1:]):
        if hi - lo >= k:
            yield np.unique(full[lo:hi - k + 1])
        elif hi > lo:
            yield joined(int(hi - lo), h[lo:hi])
        else:
            yield np.zeros(0, np.uint64)


def _permutations(cfg: NearConfig):
    rng = np.random.default_rng(cfg.seed)
    return (rng.integers(0, 1 << 32, cfg.coords, np.uint32)[:, None],
            (rng.integers(0, 1 << 32, cfg.coords, np.uint32) | np.uint32(1))[:, None])


def signature(hashes: np.ndarray, perms) -> np.ndarray:
    """Minwise values of a set, a block of it at a time."""
    flip, factor = perms
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(flip), np.uint32(0xFFFFFFFF))
    for at in range(0, len(low), 1024):
        np.minimum(best, ((low[None, at:at + 1024] ^ flip) * factor).min(axis=1), out=best)
    return best


def sketch(values: np.ndarray) -> tuple[int, int]:
    """One mixed bit of each minwise value in two signed 64-bit words."""
    bits = (mix64(values.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)
    lo, hi = np.packbits(bits.reshape(2, -1), axis=1).view(np.int64).ravel()
    return int(lo), int(hi)


SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, lo long, hi long, signature binary"


def signed(documents: DataFrame, cfg: NearConfig) -> DataFrame:
    """(doc_id, n_shingles, set digest, sketch, signature) of every row; narrow pass over whole texts."""
    def run(batches):
        perms = _permutations(cfg)
        for batch in batches:
            for part in slices(batch):
                cols = [[], [], [], [], [], []]
                for s in shingle_sets(part.column("text"), cfg.words):
                    if len(s):
                        sig = signature(s, perms)
                        d1 = int(mix64(s).sum(dtype=np.uint64).astype(np.int64))
                        d2 = int(mix64(s ^ _STEP[0]).sum(dtype=np.uint64).astype(np.int64))
                        row = (len(s), d1, d2, *sketch(sig), sig.tobytes())
                    else:
                        row = (0, None, None, None, None, None)
                    for col, value in zip(cols, row):
                        col.append(value)
                kinds = (pa.int64(),) * 5 + (pa.binary(),)
                yield pa.record_batch([part.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, kinds)]],
                                      names=["doc_id", "n_shingles", "d1", "d2", "lo", "hi", "signature"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(released(run), SIGNED)


def full_sets(documents: DataFrame, wanted: DataFrame, cfg: NearConfig) -> DataFrame:
    """``wanted`` (id and any columns, one row per id) with ``hashes``: the full set as packed sorted 64-bit hashes."""
    small = wanted.count() <= cfg.broadcast_ids
    texts = documents.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(wanted) if small else wanted, "id")
    names = [c for c in texts.columns if c != "text"]
    schema = T.StructType([*[texts.schema[c] for c in names], T.StructField("hashes", T.BinaryType())])

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                made = [x.tobytes() for x in shingle_sets(part.column(part.schema.get_field_index("text")), cfg.words)]
                yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(c)) for c in names],
                                                  pa.array(made, pa.binary())], names=[*names, "hashes"])

    return texts.mapInArrow(released(run), schema)


# --- branching --------------------------------------------------------------------------------------------------

NODES = "node long, id long, n long, lo long, hi long, label long, pick int"


def root_coordinates(cfg: NearConfig) -> list[tuple[int, int]]:
    """(tree, coordinate): one for each tree, a second one for every fourth (1.25 on average), all different."""
    order = np.random.default_rng(cfg.seed + 1).permutation(cfg.coords)
    picks = [t for t in range(cfg.trees)] + [t for t in range(0, cfg.trees, 4)]
    return [(t, int(order[i])) for i, t in enumerate(picks)]


def _child(path: np.ndarray, coord: np.ndarray, value: np.ndarray) -> np.ndarray:
    return mix64((path ^ mix64(coord.astype(np.uint64) + _STEP[1])) * _STEP[0] + value.astype(np.uint64))


def branch(rows: DataFrame, cfg: NearConfig, picks: list[tuple[int, tuple[int, int]]] | None) -> DataFrame:
    """Child nodes of rows with a signature: at the roots by the numbered ``picks``, or (None) below each row's node."""

    def run(batches):
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            sig = np.frombuffer(b"".join(get("signature").to_pylist()), np.uint32).reshape(m, cfg.coords)
            every = np.arange(m)
            if picks is not None:
                made = [(every, mix64(np.full(m, t + 1, np.uint64)), np.full(m, c), p) for p, (t, c) in picks]
            else:
                path = np.asarray(get("node")).astype(np.uint64)
                first = mix64(path ^ _STEP[1])
                second = mix64(path ^ _STEP[2])
                c1 = (first % np.uint64(cfg.coords)).astype(np.int64)
                c2 = (second % np.uint64(cfg.coords)).astype(np.int64)
                # the second coordinate in a quarter of the nodes
                two = np.flatnonzero((second >> np.uint64(62) == 0) & (c1 != c2))
                made = [(every, path, c1, -1), (two, path[two], c2[two], -1)]
            take = pa.array(np.concatenate([x for x, *_ in made]))
            node = np.concatenate([_child(path, c, sig[x, c]) for x, path, c, _ in made]).astype(np.int64)
            pick = np.concatenate([np.full(len(x), k, np.int32) for x, _, _, k in made])
            yield pa.record_batch([pa.array(node), *[get(c).take(take) for c in ("id", "n", "lo", "hi", "label")], pa.array(pick)],
                                  names=["node", "id", "n", "lo", "hi", "label", "pick"])

    return rows.mapInArrow(released(run), NODES)


def _lowest(a: np.ndarray, b: np.ndarray, m: int) -> np.ndarray:
    """For each of ``m`` rows the first row of its component under the pairs (a, b)."""
    low = np.arange(m)
    while True:
        up = low.copy()
        np.minimum.at(up, a, low[b])
        np.minimum.at(up, b, low[a])
        up = up[up]
        if np.array_equal(up, low):
            return low
        low = up


def leaf_pairs(rows: DataFrame, cfg: NearConfig, stars: bool) -> DataFrame:
    """Candidate pairs (a < b) of nodes with at most ``leaf`` rows: sizes and sketches allow a link, labels do not settle it.

    With ``stars`` only what joins the same rows: each row with the smallest id of its component in the node, so
    a group of copies makes an edge a row, and the same edge in every tree (pairs still to be verified need all).

    A partition holds whole nodes in order, so pairs are found by comparing each row with the rows
    one, two, ... places on, all rows at once.
    """
    ordered = rows.repartition("node").sortWithinPartitions("node", "id")

    def compare(t: pa.Table) -> pa.RecordBatch:
        c = {k: t.column(k).to_numpy() for k in ("node", "id", "n", "lo", "hi")}
        label = t.column("label").fill_null(-(1 << 62)).to_numpy()
        a_all, b_all = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        at = np.arange(len(c["node"]))
        for step in range(1, len(at)):
            at = at[at + step < len(c["node"])]
            at = at[c["node"][at] == c["node"][at + step]]
            if not len(at):
                break
            to = at + step
            ok = _close(c, at, to, cfg) & (c["id"][at] != c["id"][to]) & (
                (label[at] != label[to]) | (label[at] == -(1 << 62)))
            a_all.append(at[ok])
            b_all.append(to[ok])
        a, b = np.concatenate(a_all), np.concatenate(b_all)
        if stars and len(a):
            low = _lowest(a, b, len(c["node"]))
            b = np.flatnonzero(low != np.arange(len(low)))
            a = low[b]
        a, b = c["id"][a], c["id"][b]           # rows of a node come by id
        return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches):
        rest: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            if not t.num_rows:
                continue
            node = t.column("node").to_numpy()
            cut = int(np.searchsorted(node, node[-1]))
            rest = t.slice(cut)
            if cut:
                yield compare(t.slice(0, cut).combine_chunks())
        if rest is not None and rest.num_rows:
            yield compare(rest.combine_chunks())

    return ordered.mapInArrow(released(run), "a long, b long")


def _close(c, at, to, cfg: NearConfig) -> np.ndarray:
    small, large = np.minimum(c["n"][at], c["n"][to]), np.maximum(c["n"][at], c["n"][to])
    far = np.bitwise_count((c["lo"][at] ^ c["lo"][to]).view(np.uint64)).astype(np.int64) \
        + np.bitwise_count((c["hi"][at] ^ c["hi"][to]).view(np.uint64))
    return (small * 100 >= large * cfg.percent) & (cfg.coords - far >= cfg.agree)


def close(x: str, y: str, cfg: NearConfig):
    """The same filter as a column expression over the structs ``x`` and ``y`` (n, lo, hi)."""
    c = lambda s, f: F.col(f"{s}{f}")
    far = F.bit_count(c(x, "lo").bitwiseXOR(c(y, "lo"))) + F.bit_count(c(x, "hi").bitwiseXOR(c(y, "hi")))
    return ((F.least(c(x, "n"), c(y, "n")) * 100 >= F.greatest(c(x, "n"), c(y, "n")) * cfg.percent)
            & (cfg.coords - far >= cfg.agree))


def linked(x: np.ndarray, y: np.ndarray, cfg: NearConfig) -> bool:
    """100 * intersection >= percent * union, on sorted distinct hashes."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return False
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    shared = int((y[at] == x).sum())
    return 100 * shared >= cfg.percent * (len(x) + len(y) - shared)


def verified(pairs: DataFrame, sets: DataFrame, cfg: NearConfig) -> DataFrame:
    """The pairs whose full sets are linked."""
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("left")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("right")), "b")
            .select("a", "b", "left", "right"))

    def run(batches):
        for batch in batches:
            keep = [linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), cfg)
                    for x, y in zip(batch.column(2), batch.column(3))]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(released(run), "a long, b long")


# --- components -------------------------------------------------------------------------------------------------

def contracted(links: DataFrame) -> DataFrame:
    """Fewer links (a < b) with the same components: of those of an Arrow batch only a star for each of its components.

    The nodes of a large group each name it by another document, so every member comes with a link for each node. Ordered by
    the member, a batch that holds all links of a thousand members keeps about a thousand.
    """
    def run(batches):
        for batch in batches:
            ids, ends = np.unique(np.concatenate([batch.column(k).to_numpy() for k in (0, 1)]), return_inverse=True)
            low = _lowest(ends[:batch.num_rows], ends[batch.num_rows:], len(ids))
            at = np.flatnonzero(low != np.arange(len(low)))
            yield pa.record_batch([pa.array(ids[low[at]]), pa.array(ids[at])], names=["a", "b"])

    each = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # any part of the links contracts by itself, so a partition with a document of very many links may be split
    return each.hint("rebalance", F.col("b")).sortWithinPartitions("b", "a").mapInArrow(released(run), "a long, b long")


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(id, comp) of every linked id: the smallest id it reaches."""
    links = scratch.write(contracted(links).distinct(), f"{name}-links")
    both = scratch.write(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{name}-both")
    labels = scratch.write(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                           .select("id", F.least("id", "m").alias("comp")), f"{name}-0")
    turn = 0
    while True:
        turn += 1
        near = (both.join(labels.select(F.col("id").alias("b"), "comp"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("m")))
        better = (labels.join(near, "id").select("id", F.col("comp").alias("old"), F.least("comp", "m").alias("up")))
        jump = labels.select(F.col("id").alias("up"), F.col("comp").alias("top"))
        new = scratch.write(better.join(jump, "up", "left")
                            .select("id", "old", F.least("up", F.coalesce("top", "up")).alias("comp")), f"{name}-{turn}")
        changed = new.where("comp <> old").limit(1).count()
        scratch.drop(f"{name}-{turn - 1}")
        labels = new.select("id", "comp")
        if not changed:
            scratch.drop(f"{name}-both")
            scratch.drop(f"{name}-links")
            return labels


# --- nodes as wholes --------------------------------------------------------------------------------------------

def forest(t: pa.Table, cfg: NearConfig, home: np.ndarray | None = None) -> pa.Table:
    """Edges (a, b) that join all components of one group of documents.

    Every two documents are compared, by sizes and sketches and, if the table has ``hashes``, by full sets,
    unless their component is already the same, both lie in one block (``own``) of a pair of blocks ``i < j``, or
    they share an entry of ``home`` (they were compared elsewhere).
    """
    c = {k: t.column(k).to_numpy() for k in ("id", "n", "lo", "hi")}
    m = len(c["id"])
    label = t.column("label").fill_null(0).to_numpy()
    alone = t.column("label").is_null().to_numpy(zero_copy_only=False)
    comp = np.unique(np.where(alone, c["id"], label), return_inverse=True)[1]
    exact = "hashes" in t.column_names
    hashes = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("hashes")] if exact else None
    across = "i" in t.column_names and t.column("i")[0].as_py() != t.column("j")[0].as_py()
    own = t.column("own").to_numpy() if across else None
    a, b, every = [], [], np.arange(m)
    for x in range(m):
        to = every[x + 1:]
        to = to[comp[to] != comp[x]]
        if across:
            to = to[own[to] != own[x]]
        if not len(to):
            continue
        to = to[_close(c, np.full(len(to), x), to, cfg)]
        if home is not None and len(to):
            to = to[~((home[to] == home[x]) & (home[x] != 0)).any(axis=1)]
        if not len(to):
            continue
        if not exact:
            _, first = np.unique(comp[to], return_index=True)
            joined = to[first]
            comp[np.isin(comp, comp[joined])] = comp[x]
        else:
            far = np.bitwise_count((c["lo"][to] ^ c["lo"][x]).view(np.uint64)).astype(np.int64) \
                + np.bitwise_count((c["hi"][to] ^ c["hi"][x]).view(np.uint64))
            joined = []
            for y in to[np.argsort(far, kind="stable")]:
                if comp[y] != comp[x] and linked(hashes[x], hashes[y], cfg):
                    comp[comp == comp[y]] = comp[x]
                    joined.append(y)
        for y in joined:
            a.append(min(c["id"][x], c["id"][y]))
            b.append(max(c["id"][x], c["id"][y]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def sketch_forest(rows: DataFrame, cfg: NearConfig) -> DataFrame:
    """Candidate forest of every node of ``rows`` (at most ``block_limit`` narrow rows each)."""
    return rows.select("node", "id", "n", "lo", "hi", "label").groupBy("node").applyInArrow(
        lambda t: forest(t.sort_by([("id", "ascending")]).combine_chunks(), cfg), "a long, b long")


def block_links(rows: DataFrame, cfg: NearConfig, homes: DataFrame | None = None) -> DataFrame:
    """Links that join all components inside each node of ``rows`` (node, size, id, n, lo, hi, label, hashes), by full sets.

    ``homes`` (id, nodes by pick, 0 for none) names the root nodes compared in blocks: a pair that shares an
    earlier one is compared there.
    """
    cols = ["id", "n", "lo", "hi", "label", "hashes"]
    if homes is not None:
        rows = rows.join(homes.select(F.col("id").alias("_home"), "nodes"), F.col("id") == F.col("_home"), "left")
        none = F.array_repeat(F.lit(0).cast("long"), len(root_coordinates(cfg)))
        cols += ["pick", F.coalesce("nodes", none).alias("nodes")]
    own = F.pmod(F.xxhash64("id", "node"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                        lambda o: F.struct(F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j")))
    dealt = (rows.withColumn("blocks", F.ceil(F.col("size") / cfg.block).cast("int")).withColumn("own", own)
             .withColumn("pair", F.explode(pairs))
             .select("node", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), "own", *cols))

    def compare(t: pa.Table) -> pa.Table:
        t = t.sort_by([("id", "ascending")]).combine_chunks()
        home = None
        if "pick" in t.column_names:
            pick = t.column("pick")[0].as_py()
            home = t.column("nodes").combine_chunks().flatten().to_numpy().reshape(len(t), -1)
            home = home if pick < 0 else home[:, :pick]          # roots before this one; all of them below the roots
        return forest(t, cfg, home)

    return dealt.groupBy("node", "i", "j").applyInArrow(compare, "a long, b long")


def _settle(big: DataFrame, sets: DataFrame | None, scratch: Scratch, cfg: NearConfig, tag: str):
    """(links to the pivots, the rows with new labels): each node against its pivot, by sketches or full sets."""
    turn = F.xxhash64("node", "id")
    pivots = scratch.write(
        big.groupBy("node").agg(F.min(F.struct(F.col("label").isNotNull().alias("done"), turn.alias("turn"),
                                               "id", "n", "lo", "hi", "label")).alias("p"))
        .select("node", *[F.col(f"p.{c}").alias(f"p_{c}") for c in ("id", "n", "lo", "hi", "label")]), f"pivots-{tag}")
    joined = big.join(pivots, "node")
    stars = (joined.where((F.col("id") != F.col("p_id")) & close("", "p_", cfg))
             .select(F.least("id", "p_id").alias("a"), F.greatest("id", "p_id").alias("b")).distinct())
    links = scratch.write(stars, f"stars-{tag}")
    if sets is not None:
        links = scratch.write(verified(links, sets, cfg).distinct(), f"links-{tag}")
    found = links.select(F.col("a").alias("_a"), F.col("b").alias("_b"))
    hit = joined.join(found, (F.least("id", "p_id") == F.col("_a")) & (F.greatest("id", "p_id") == F.col("_b")), "left")
    hit = scratch.write(hit.select("node", "id", "n", "lo", "hi", "label", F.coalesce("p_label", "p_id").alias("_name"),
                                   (F.col("_a").isNotNull() | (F.col("id") == F.col("p_id"))).alias("linked")), f"hit-{tag}")
    # a label that reaches the pivot becomes the pivot's
    merged = scratch.write(hit.where("linked AND label IS NOT NULL")
                           .select(F.col("node").alias("_node"), F.col("label").alias("_label")).distinct(), f"merged-{tag}")
    rows = hit.join(merged, (F.col("node") == F.col("_node")) & (F.col("label") == F.col("_label")), "left")
    label = F.when(F.col("linked") | F.col("_label").isNotNull(), F.col("_name")).otherwise(F.col("label"))
    rows = scratch.write(rows.select("node", "id", "n", "lo", "hi", label.alias("label"), F.lit(-1).alias("pick")), f"settled-{tag}")
    return links, rows


# --- the operator -----------------------------------------------------------------------------------------------

def _some(df: DataFrame) -> bool:
    return bool(df.limit(1).count())


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _mixed(rows: DataFrame, least: int) -> DataFrame:
    """(node, size) of nodes with over ``least`` rows that are not of one label throughout."""
    return (rows.groupBy("node").agg(F.count("*").alias("size"), F.count("label").alias("named"),
                                     F.min("label").alias("x"), F.max("label").alias("y"))
            .where((F.col("size") > least))
            .select("node", "size", ((F.col("named") == F.col("size")) & (F.col("x") == F.col("y"))).alias("one")))


def _home(rows: DataFrame, cfg: NearConfig) -> DataFrame:
    """(id, nodes): each document's root nodes among ``rows``, by pick; 0 where it has none."""
    one = F.when(F.min("node") == F.max("node"), F.min("node")).otherwise(0)     # a repeated doc_id may have two
    held = (rows.groupBy("id", "pick").agg(one.alias("node"))
            .groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("pick", "node"))).alias("_m")))
    every = F.sequence(F.lit(0), F.lit(len(root_coordinates(cfg)) - 1))
    return held.select("id", F.transform(every, lambda k: F.coalesce(F.element_at("_m", k), F.lit(0).cast("long"))).alias("nodes"))


def _trees(keyed: DataFrame, sets: DataFrame | None, scratch: Scratch, cfg: NearConfig, tag: str) -> list[DataFrame]:
    """Edges of all trees over ``keyed`` (id, n, lo, hi, label, signature): candidates by sketches, or links by ``sets``."""
    rows, level, found, homes = branch(keyed, cfg, list(enumerate(root_coordinates(cfg)))), 0, [], None
    while True:
        name = f"{tag}-{level}"
        large = scratch.write(_mixed(rows, cfg.leaf), f"large-{name}")
        pairs = scratch.write(leaf_pairs(rows.join(large.select("node"), "node", "left_anti"), cfg, sets is None).distinct(), f"pairs-{name}")
        found.append(pairs if sets is None else scratch.write(verified(pairs, sets, cfg), f"near-{name}"))
        big = scratch.write(rows.join(large.where("NOT one").select("node", "size"), "node"), f"rows-{name}")
        if not _some(big):
            return found
        last = level >= cfg.depth
        middle = big if last and sets is not None else big.where(F.col("size") <= cfg.block_limit)
        if sets is None:
            edges = sketch_forest(middle, cfg)
        else:
            if not level:
                homes = scratch.write(_home(middle, cfg), f"homes-{name}")
            full = middle.join(sets.select(F.col("id").alias("_set"), "hashes"), F.col("id") == F.col("_set"))
            edges = block_links(full, cfg, homes)
        found.append(scratch.write(edges.distinct(), f"blocks-{name}"))
        huge = big.where(F.col("size") > cfg.block_limit).drop("size")
        if not _some(huge) or (last and sets is not None):
            return found
        star, settled = _settle(huge, sets, scratch, cfg, name)
        found.append(star)
        if last:
            # sketches that no level tells apart: the members are candidates of each other
            found.append(scratch.write(settled.join(settled.groupBy(F.col("node").alias("_node")).agg(F.min("id").alias("a")),
                                                    F.col("node") == F.col("_node")).where("id <> a")
                                       .select("a", F.col("id").alias("b")).distinct(), f"rest-{name}"))
            return found
        still = scratch.write(_mixed(settled, 0).where("NOT one").select("node"), f"open-{name}")
        again = settled.join(still, "node", "left_semi").join(keyed.select("id", "signature"), "id")
        rows = scratch.write(branch(again, cfg, None), f"branched-{name}")
        level += 1


def links(documents: DataFrame, reps: DataFrame, scratch: Scratch, cfg: NearConfig) -> DataFrame | None:
    """(id, comp) of all representatives that are linked to another one; None if there are none."""
    keyed = reps.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "lo", "hi",
                        F.lit(None).cast("long").alias("label"), "signature")
    edges = scratch.write(_union(_trees(keyed, None, scratch, cfg, "c")).distinct(), "candidates")
    if not _some(edges):
        return None
    near = components(edges, scratch, "near")
    sizes = scratch.write(near.groupBy(F.col("comp").alias("_comp")).agg(F.count("*").alias("size")), "sizes")
    members = scratch.write(
        keyed.drop("signature", "label").join(near, "id").join(sizes, F.col("comp") == F.col("_comp"))
        .select("id", "n", "lo", "hi", F.col("comp").alias("node"), "size"), "members")
    full = full_sets(documents, members.where(F.col("size") <= cfg.block_limit).dropDuplicates(["id"]), cfg)
    found = [scratch.write(block_links(full.withColumn("label", F.lit(None).cast("long")), cfg).distinct(), "links")]
    giant = scratch.write(members.where(F.col("size") > cfg.block_limit).select("id").distinct(), "giant")
    if _some(giant):
        sets = scratch.write(full_sets(documents, giant, cfg), "sets")
        found += _trees(keyed.join(giant, "id", "left_semi"), sets, scratch, cfg, "x")
        scratch.drop("sets")
    if not any(_some(x) for x in found):
        return None
    return components(_union(found), scratch, "all")


def near_duplicates(documents: DataFrame, cfg: NearConfig = NearConfig()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    scratch = Scratch(documents.sparkSession)
    table = scratch.write(signed(documents, cfg), "signed")
    usable = table.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = scratch.write(usable.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows"))
                            .where("rows > 1").select(F.col("d1").alias("_d1"), F.col("d2").alias("_d2"), "rep"), "classes")
    same = (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2"))
    reps = scratch.write(usable.join(classes, same, "left").where("rep IS NULL OR rep = doc_id")
                         .select("doc_id", "n_shingles", "lo", "hi", "signature"), "reps")
    comps = links(documents, reps, scratch, cfg)
    if comps is None:
        comps = documents.sparkSession.createDataFrame([], "id long, comp long")
    named = (table.select("doc_id", "n_shingles", "d1", "d2").join(classes, same, "left")
             .withColumn("rep", F.coalesce("rep", "doc_id"))
             .join(comps.select(F.col("id").alias("rep"), "comp"), "rep", "left"))
    comp = F.coalesce("comp", "rep")
    return named.select("doc_id", "n_shingles", comp.alias("component_id"),
                        F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"))


def dedup(documents: DataFrame, cfg: NearConfig = NearConfig()) -> DataFrame:
    """One document of each group: the one with the smallest doc_id; columns unchanged."""
    scratch = Scratch(documents.sparkSession)
    judged = scratch.write(near_duplicates(documents, cfg).where("doc_id IS NOT NULL").select("doc_id", "kept"), "judged")
    gone = judged.where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    gone = scratch.write(gone, "gone")
    stay = documents.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
    twice = scratch.write(judged.where("kept").groupBy(F.col("doc_id").alias("_twice")).agg(F.count("*").alias("n"))
                          .where("n > 1").select("_twice"), "twice")
    if not twice.limit(1).count():
        return stay
    repeated = stay.join(twice, F.col("doc_id") == F.col("_twice"), "left_semi").dropDuplicates(["doc_id"])
    return stay.join(twice, F.col("doc_id") == F.col("_twice"), "left_anti").unionByName(repeated)


#: DuckDB brute force over shared shingles, for query op2.
SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= {k}
        THEN list_transform(range(1, len(ws) - {k} + 2), lambda i: array_to_string(ws[i:i + {k} - 1], ' '))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
sets AS (SELECT doc_id, n, md5(string_agg(sh, chr(10) ORDER BY sh)) AS d FROM s JOIN n USING (doc_id) GROUP BY doc_id, n),
rep AS (SELECT min(doc_id) AS rep, d, any_value(n) AS n FROM sets GROUP BY d),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id
  WHERE x.doc_id IN (SELECT rep FROM rep) AND y.doc_id IN (SELECT rep FROM rep) GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * shared >= {percent} * (p.n + q.n - shared)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT rep AS id, rep AS comp FROM rep UNION SELECT e.b, r.comp FROM reach r JOIN edge e ON e.a = r.id),
comp AS (SELECT id, min(comp) AS comp FROM reach GROUP BY id),
out AS (SELECT doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(comp.comp, doc_id) AS component_id
  FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN sets USING (doc_id) LEFT JOIN rep USING (d)
  LEFT JOIN comp ON comp.id = rep.rep)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM out"""


def sql(cfg: NearConfig) -> str:
    return SQL.format(k=cfg.words, percent=cfg.percent)
