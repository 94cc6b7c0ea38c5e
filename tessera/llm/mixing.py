"""Mixing sources to target weights by Sainte-Laguë apportionment (DataFrame functions only).

1. A document's size is its number of words; a source's target is its weighted share of the
   mix, at most ``max_repeat`` times its size, the excess reshared by weight.
2. Every source is dealt into shards of about ``shard_words`` words by a seeded hash, every
   shard into equal blocks of about ``block_words`` words.
3. Blocks are seats: the sources get them by highest quotients ``claim / (2 k + 1)``, then each
   source's shards get its seats the same way. Seats are not listed: with divisor 1 a claim
   rounds to its nearest integer, which are the highest quotients of some seat count, and only
   the difference to the wanted count is settled quotient by quotient.
4. Inside a shard a seeded bijection orders the blocks; quota = q * blocks + r takes every block
   q times and the first r once more.

The report shuffles only (doc_id, source, size); the stage moves the text once, by (source, shard).
Windows see one shard, the shards of one source, or one row per source. A hot source has more shards, not larger ones.

Cases: null text has size 0; null source is a source of its own, last in order; empty documents
take nothing; equal rows share one outcome each in any order; sources without words have
target 0; an empty table gives an empty result; other columns pass through the stage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import SPACE, WORD, Scratch


@dataclass(frozen=True)
class MixConfig:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)   # by source in code point order, repeating
    max_repeat: int = 3
    block_words: int = 256
    shard_words: int = 1 << 21
    seed: int = 20240229


def n_words(text) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """(source, source_size) with weight and target; one row per source, so the window is small.

    The level L of ``sum(min(cap, weight * L)) = total`` lies where the sources ordered by
    ``cap / weight`` stop being capped.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(cfg.weights)
    rank = (F.row_number().over(order) - 1).cast("int")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in cfg.weights]), rank % n + 1)
    s = (sources.withColumn("weight", w).withColumn("cap", F.col("source_size").cast("double") * cfg.max_repeat)
         .withColumn("ratio", F.col("cap") / F.col("weight")))
    up = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_rows = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = (s.withColumn("capped", F.sum("cap").over(up)).withColumn("weighed", F.sum("weight").over(up))
         .withColumn("total", F.sum("source_size").over(all_rows).cast("double"))
         .withColumn("weights", F.sum("weight").over(all_rows)))
    # this source is capped when even with it at its cap the others' level reaches its ratio
    full = F.col("capped") + (F.col("weights") - F.col("weighed")) * F.col("ratio") <= F.col("total")
    s = s.withColumn("full", full)
    s = (s.withColumn("held", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(all_rows), F.lit(0.0)))
         .withColumn("free", F.sum(F.when(~F.col("full"), F.col("weight"))).over(all_rows)))
    level = (F.col("total") - F.col("held")) / F.col("free")
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.least("cap", F.col("weight") * level))
    return s.withColumn("target", target).select("source", "source_size", "weight", "target")


def apportion(claims: DataFrame, group: list[str], key: list[str], seats: str) -> DataFrame:
    """Sainte-Laguë: integer ``quota`` of each claim (column ``claim``), summing to ``seats`` in its group."""
    part = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    base = (claims.withColumn("start", F.floor(F.col("claim") + 0.5).cast("long"))
            .withColumn("lack", F.col(seats) - F.sum("start").over(part)))
    steps = base.where("lack <> 0").withColumn(
        "step", F.explode(F.sequence(F.lit(1).cast("long"), F.abs("lack"))))
    # the next quotients when seats are lacking, the last ones when there are too many
    at = F.when(F.col("lack") > 0, 2 * (F.col("start") + F.col("step")) - 1).otherwise(
        2 * (F.col("start") - F.col("step")) + 1)
    steps = steps.withColumn("at", at).where("at > 0 AND claim > 0")
    turn = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))).orderBy(
        F.when(F.col("lack") > 0, -F.col("claim") / F.col("at")).otherwise(F.col("claim") / F.col("at")),
        *[F.col(k).asc_nulls_last() for k in key])
    moved = (steps.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= F.abs("lack"))
             .groupBy(*group, *key).agg(F.sum(F.signum("lack").cast("long")).alias("moved")))
    names = [*group, *key]
    moved = moved.select(*[F.col(c).alias(f"_{c}") for c in names], "moved")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names]
    cond = same[0]
    for c in same[1:]:
        cond &= c
    return (base.join(moved, cond, "left")
            .withColumn("quota", F.col("start") + F.coalesce("moved", F.lit(0).cast("long")))
            .drop("start", "lack", "moved", *[f"_{c}" for c in names]))


_P = 2147483647  # prime modulus of the seeded order (exact in 64-bit integers in any engine)


def _order(doc_id, cfg: MixConfig):
    x = F.pmod(F.coalesce(doc_id.cast("long"), F.lit(0).cast("long")), F.lit(_P).cast("long"))
    return F.pmod(x * 48271 + cfg.seed, F.lit(_P).cast("long"))


def plan(documents: DataFrame, cfg: MixConfig = MixConfig(), keep: tuple[str, ...] = ()) -> DataFrame:
    """Each document's place in its shard, with the shard's quota: (doc_id, source, size, source_size, target,
    shard, begin, shard_size, blocks, quota, shift) and the columns ``keep``.

    Targets, shard sizes and quotas come from a narrow written table; columns in ``keep`` (the text of the
    stage) are shuffled once, by (source, shard).
    """
    scratch = Scratch(documents.sparkSession)
    size = n_words(F.col("text")).alias("size")
    sized = scratch.write(documents.select("doc_id", "source", size), "sizes")
    per_source = scratch.write(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), cfg), "targets")
    shards = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("source_size") / cfg.shard_words))
    known = per_source.select(F.col("source").alias("_source"), "source_size", "target", shards.alias("shards"))

    def place(rows: DataFrame) -> DataFrame:
        # a row per source: Spark broadcasts it if small
        return (rows.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
                .withColumn("turn", _order(F.col("doc_id"), cfg))
                .withColumn("shard", F.pmod(F.col("turn"), F.col("shards"))))

    by_shard = (place(sized).groupBy("source", "shard", "source_size", "target").agg(F.sum("size").alias("shard_size"))
                .withColumn("blocks", F.greatest(F.lit(1).cast("long"),
                                                 F.round(F.col("shard_size") / cfg.block_words).cast("long")))
                # claim in blocks: the shard's share of the target, in blocks of its own size
                .withColumn("claim", F.when(F.col("source_size") > 0, F.col("blocks") * F.col("target") / F.col("source_size"))
                            .otherwise(0.0)))
    by_shard = scratch.write(by_shard, "shards")
    claims = (by_shard.groupBy("source").agg(F.sum("claim").alias("claim"))
              .withColumn("seats", F.round(F.sum("claim").over(Window.partitionBy(F.lit(0)))).cast("long")))
    seats = apportion(claims, [], ["source"], "seats").select(F.col("source").alias("_source"), F.col("quota").alias("seats"))
    quotas = apportion(by_shard.join(seats, F.col("source").eqNullSafe(F.col("_source"))).drop("_source"),
                       ["source"], ["shard"], "seats")
    # a quota never asks for more than max_repeat passes over its shard
    quota = F.least(F.col("quota"), F.col("blocks") * cfg.max_repeat)
    shift = F.pmod(F.col("shard") * 7919 + cfg.seed, F.col("blocks"))
    quotas = scratch.write(quotas.select(F.col("source").alias("_source"), F.col("shard").alias("_shard"),
                                         "shard_size", "blocks", quota.alias("quota"), shift.alias("shift")), "quotas")
    ends = Window.partitionBy("source", "shard").orderBy("turn", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = documents.select("doc_id", "source", size, *keep) if keep else sized
    return (place(rows).withColumn("begin", F.sum("size").over(ends) - F.col("size"))
            .join(quotas, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")))
            .drop("_source", "_shard", "shards", "turn"))


#: Multipliers of the block bijection; coprime to any block count that the first does not divide.
_STRIDES = (1000003, 998244353)


def _taken_in(lo, hi) -> Column:
    """Words of the shard positions [lo, hi) that the extra pass (the first ``quota mod blocks`` blocks) takes."""
    stride = F.when(F.col("blocks") % _STRIDES[0] != 0, F.lit(_STRIDES[0])).otherwise(F.lit(_STRIDES[1])).cast("long")
    rest = F.col("quota") % F.col("blocks")
    return F.transform(
        F.filter(F.sequence(_block_of(lo), _block_of(hi - 1)),
                 lambda b: F.pmod(b * stride + F.col("shift"), F.col("blocks")) < rest),
        lambda b: F.struct(F.greatest(lo, _edge(b)).alias("a"), F.least(hi, _edge(b + 1)).alias("z")))


def _edge(block) -> Column:
    """First shard position of a block: floor(block * shard_size / blocks)."""
    return F.floor(block * F.col("shard_size") / F.col("blocks")).cast("long")


def _block_of(pos) -> Column:
    """The block with ``edge(b) <= pos < edge(b + 1)``: floor(((pos + 1) * blocks - 1) / shard_size)."""
    return F.floor(((pos + 1) * F.col("blocks") - 1) / F.col("shard_size")).cast("long")


def with_taken(placed: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """Adds ``passes`` (whole copies), ``spans`` (shard ranges of the partial copy) and ``taken`` (words)."""
    end = F.col("begin") + F.col("size")
    spans = F.when(F.col("size") > 0, _taken_in(F.col("begin"), end)).otherwise(
        F.array().cast("array<struct<a:bigint,z:bigint>>"))
    part = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["z"] - s["a"])
    return (placed.withColumn("passes", F.floor(F.col("quota") / F.col("blocks")).cast("long"))
            .withColumn("spans", spans)
            .withColumn("taken", F.col("passes") * F.col("size") + part))


def mix_report(documents: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    return with_taken(plan(documents, cfg), cfg).select("doc_id", "size", "source_size", "target", "taken")


def mix(documents: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """The mixed documents: whole copies as often as the mix takes them, and one row with the words of the
    blocks that an extra pass takes, in their order (their own white space kept)."""
    cols = documents.columns
    mine = [f"_mix_{i}" for i in range(len(cols))]   # input columns under names of our own: none clashes
    renamed = documents.select("doc_id", "source", "text", *[F.col(c).alias(m) for c, m in zip(cols, mine)])
    placed = with_taken(plan(renamed, cfg, ("text", *mine)), cfg)
    pieces = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD}(?:{SPACE})?)"), 1)
    partial = F.array_join(F.flatten(F.transform(
        "spans", lambda s: F.slice(pieces, (s["a"] - F.col("begin") + 1).cast("int"), (s["z"] - s["a"]).cast("int")))), "")
    whole = F.col("taken") - F.col("passes") * F.col("size") == F.col("size")
    texts = F.concat(
        F.array_repeat(F.col("text"), (F.col("passes") + F.when(whole & (F.col("size") > 0), 1).otherwise(0)).cast("int")),
        F.when(~whole & (F.size("spans") > 0), F.array(partial)).otherwise(F.array().cast("array<string>")))
    out = placed.withColumn("_text", F.explode(texts))
    return out.select(*[F.col("_text").alias("text") if c == "text"
                        else F.length("_text").cast("long").alias(c) if c == "n_chars"
                        else F.col(m).alias(c) for c, m in zip(cols, mine)])


def sql(cfg: MixConfig = MixConfig()) -> str:
    """DuckDB form of ``mix_report``: every seat is listed and given to the highest quotient."""
    weights = ", ".join(str(float(w)) for w in cfg.weights)
    return f"""
WITH sized AS (SELECT row_number() OVER () AS r, doc_id, source,
    coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(cfg.weights)} AS k
  FROM sized GROUP BY source),
s1 AS (SELECT source, source_size, ([{weights}]::DOUBLE[])[k + 1] AS weight, source_size::DOUBLE * {cfg.max_repeat} AS cap FROM s0),
s2 AS (SELECT *, cap / weight AS ratio, sum(cap) OVER o AS capped, sum(weight) OVER o AS weighed,
    (sum(source_size) OVER ())::DOUBLE AS total, sum(weight) OVER () AS weights
  FROM s1 WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
s3 AS (SELECT *, capped + (weights - weighed) * ratio <= total AS at_cap FROM s2),
s4 AS (SELECT *, coalesce(sum(cap) FILTER (WHERE at_cap) OVER (), 0) AS held, sum(weight) FILTER (WHERE NOT at_cap) OVER () AS free FROM s3),
t AS (SELECT source, source_size, CASE WHEN at_cap THEN cap ELSE least(cap, weight * ((total - held) / free)) END AS target,
    greatest(1, ceil(source_size / {cfg.shard_words}))::BIGINT AS shards FROM s4),
turned AS (SELECT r, doc_id, sized.source, size, source_size, target, shards,
    ((((coalesce(doc_id, 0) % {_P}) + {_P}) % {_P}) * 48271 + {cfg.seed}) % {_P} AS turn
  FROM sized JOIN t ON sized.source IS NOT DISTINCT FROM t.source),
placed AS (SELECT *, turn % shards AS shard, (sum(size) OVER (PARTITION BY source, turn % shards ORDER BY turn, doc_id, size
    ROWS UNBOUNDED PRECEDING))::BIGINT - size AS at_word FROM turned),
sh AS (SELECT source, shard, source_size, target, sum(size)::BIGINT AS z, greatest(1, round(sum(size) / {cfg.block_words}))::BIGINT AS blocks
  FROM placed GROUP BY ALL),
claimed AS (SELECT *, CASE WHEN source_size > 0 THEN blocks * target / source_size ELSE 0.0 END AS claim FROM sh),
by_source AS (SELECT source, sum(claim) AS claim FROM claimed GROUP BY source),
won AS (SELECT source, count(*) AS seats FROM (
    SELECT source, row_number() OVER (ORDER BY claim / (2 * i + 1) DESC, source NULLS LAST) AS turn
    FROM (SELECT source, claim, unnest(range(0, ceil(claim)::BIGINT + 2)) AS i FROM by_source WHERE claim > 0))
  WHERE turn <= (SELECT round(sum(claim)) FROM by_source) GROUP BY source),
quotas AS (SELECT source, shard, count(*) FILTER (WHERE turn <= seats) AS quota FROM (
    SELECT c.source, c.shard, seats, row_number() OVER (PARTITION BY c.source ORDER BY c.claim / (2 * i + 1) DESC, c.shard) AS turn
    FROM (SELECT source, shard, claim, unnest(range(0, ceil(claim)::BIGINT + 2)) AS i FROM claimed WHERE claim > 0) c
    JOIN won ON c.source IS NOT DISTINCT FROM won.source) GROUP BY source, shard),
q AS (SELECT c.source, c.shard, z, blocks, least(coalesce(quota, 0), blocks * {cfg.max_repeat})::BIGINT AS quota,
    (c.shard * 7919 + {cfg.seed}) % blocks AS shift,
    CASE WHEN blocks % {_STRIDES[0]} <> 0 THEN {_STRIDES[0]} ELSE {_STRIDES[1]} END AS stride
  FROM claimed c LEFT JOIN quotas ON c.source IS NOT DISTINCT FROM quotas.source AND c.shard = quotas.shard),
p AS (SELECT placed.*, z, blocks, quota, shift, stride FROM placed
  JOIN q ON placed.source IS NOT DISTINCT FROM q.source AND placed.shard = q.shard),
b AS (SELECT r, unnest(range(((at_word + 1) * blocks - 1) // z, ((at_word + size) * blocks - 1) // z + 1)) AS b FROM p WHERE size > 0),
extra AS (SELECT r, sum(least(at_word + size, (b + 1) * z // blocks) - greatest(at_word, b * z // blocks)) AS n
  FROM b JOIN p USING (r) WHERE (b * stride + shift) % blocks < quota % blocks GROUP BY r)
SELECT doc_id, size, source_size, target, ((quota // blocks) * size + coalesce(n, 0))::BIGINT AS taken FROM p LEFT JOIN extra USING (r)"""
