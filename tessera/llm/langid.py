"""Language ID by Bayesian evidence fusion.

For every row and language l the log-posterior adds up

* the text: mean log-likelihood of its hashed character n-grams under l (naive Bayes learned from labelled
  documents), times an effective count that saturates, as neighbouring n-grams are not independent;
* the declared markup language: ``P(declared | l)``, estimated over all rows that declare one;
* the address: the share of l among the *other* rows of the host, smoothed towards its address suffix,
  which is smoothed towards all rows.

Shares and ``P(declared | l)`` are soft counts of the text posteriors, by grouped aggregation over all
rows (partial sums per task, so a hot host is a few rows). The languages are all that any labelled document
has, by grouped aggregation. Only the n-gram table is learned from a bounded sample: all documents of a
language that has at most ``sample``, else about ``sample`` of them by their hash. One pass reads the texts and writes a
narrow table; the joins after it carry no text.

Cases: null or empty text has no text evidence and falls back on the others; a null host, suffix or
declaration adds nothing (a null host takes its suffix's share, a null suffix the overall one); ties go to
the first language by code; without labelled documents the language is NULL; repeated rows are rows of their own;
an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import Scratch, char_grams, row_sums, slices, words_of
from tessera.llm.urlfilter import host_of


@dataclass(frozen=True)
class LangConfig:
    sample: int = 4000          # labelled documents of each language the n-gram table is learned from, about
    bits: int = 16
    grams: tuple[int, int] = (1, 3)
    add: float = 0.1
    saturate: float = 100.0     # effective n-grams of a long text
    host_weight: float = 20.0   # pseudo-rows of the suffix share in a host's
    suffix_weight: float = 100.0
    declared_weight: float = 20.0
    declared_trust: float = 0.9  # P(declared = l | l) before any row is seen


def word_grams(texts: pa.Array, cfg: LangConfig):
    """(bucket of each n-gram, distinct word it is from, word codes, row offsets, number of words)."""
    codes, offsets, words = words_of(texts, ascii_lower=True)
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), codes, offsets, 0
    owner, h = char_grams(words, *cfg.grams)
    return (h >> np.uint64(64 - cfg.bits)).astype(np.int64), owner, codes, offsets, len(words)


def learn(documents: DataFrame, cfg: LangConfig = LangConfig()):
    """(languages, log-likelihoods [buckets x languages]) from (doc_id, text, lang)."""
    named = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in named.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    # one row per language; a document is in the sample by its own hash: no sort, and no language meets in one task
    least = documents.sparkSession.createDataFrame([(x, min(1.0, cfg.sample / n)) for x, n in sizes.items()], "lang string, _share double")
    draw = (F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53)))
    texts = (named.join(F.broadcast(least), "lang").where((F.col("_share") >= 1.0) | (draw < F.col("_share")))
             .select("lang", "text"))

    def count(batches):
        made = {}
        for batch in batches:
            for part in slices(batch):
                langs = np.array(part.column(0).to_pylist())
                bucket, owner, codes, offsets, n = word_grams(part.column(1), cfg)
                for name in sorted(set(langs)):
                    mine = np.concatenate([codes[a:b] for a, b, x in zip(offsets[:-1], offsets[1:], langs) if x == name])
                    times = np.bincount(mine, minlength=n) if n else np.zeros(0)
                    made[name] = made.get(name, 0) + np.bincount(bucket, times[owner], 1 << cfg.bits)
        for name, counts in made.items():
            yield pa.record_batch([pa.array([name]), pa.array([counts.tobytes()], pa.binary())], names=["lang", "counts"])

    totals: dict[str, np.ndarray] = {x: np.zeros(1 << cfg.bits) for x in sizes}
    for row in texts.mapInArrow(count, "lang string, counts binary").toLocalIterator():
        totals[row["lang"]] = totals[row["lang"]] + np.frombuffer(row["counts"], np.float64)
    langs = sorted(totals)
    if not langs:
        return [], np.zeros((1 << cfg.bits, 0), np.float32)
    table = np.stack([totals[x] for x in langs], axis=1) + cfg.add
    return langs, np.log(table / table.sum(axis=0)).astype(np.float32)


def evidence(rows: DataFrame, model, cfg: LangConfig) -> DataFrame:
    """``rows`` with the text evidence ``ll`` (one number per language) in place of ``text``."""
    langs, table = model
    shared = rows.sparkSession.sparkContext.broadcast(table)
    rest = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches):
        table = shared.value
        for batch in batches:
            for part in slices(batch):
                bucket, owner, codes, offsets, n = word_grams(part.column(part.schema.get_field_index("text")), cfg)
                out = np.zeros((part.num_rows, len(langs)))
                if n:
                    grams = row_sums(np.bincount(owner, minlength=n)[codes], offsets)
                    scale = cfg.saturate / (grams + cfg.saturate)        # effective count / count
                    for j in range(len(langs)):
                        out[:, j] = row_sums(np.bincount(owner, table[bucket, j], n)[codes], offsets) * scale
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(part.schema.get_field_index(f.name)) for f in rest],
                     pa.array(list(out), pa.list_(pa.float64()))], names=[*[f.name for f in rest], "ll"])

    return rows.mapInArrow(run, T.StructType([*rest, T.StructField("ll", T.ArrayType(T.DoubleType()))]))


def _softmax(rows: DataFrame, values: str, out: str) -> DataFrame:
    """``rows`` with the softmax of the array ``values`` in ``out``: a projection per step, linear in the languages."""
    return (rows.withColumn("_top", F.array_max(values))
            .withColumn("_e", F.transform(values, lambda v: F.exp(v - F.col("_top"))))
            .withColumn("_total", F.aggregate("_e", F.lit(0.0), lambda a, x: a + x))
            .withColumn(out, F.transform("_e", lambda x: x / F.col("_total"))).drop("_top", "_e", "_total"))


def fuse(rows: DataFrame, model, cfg: LangConfig = LangConfig()) -> DataFrame:
    """Rows (text, host, suffix, declared and any columns) -> the columns without text, with lang_id and score."""
    langs, _ = model
    keep = [c for c in rows.columns if c != "text"]
    if not langs:
        return rows.drop("text").withColumn("lang_id", F.lit(None).cast("string")).withColumn("score", F.lit(None).cast("double"))
    scratch = Scratch(rows.sparkSession)
    k = range(len(langs))
    seen = evidence(rows, model, cfg)
    seen = _softmax(seen, "ll", "_p")
    seen = scratch.write(seen.select(*keep, "ll", *[F.col("_p")[i].alias(f"_p{i}") for i in k]), "evidence")
    sums = lambda name: [F.sum(f"_p{i}").alias(f"_{name}{i}") for i in k] + [F.count("*").alias(f"_{name}n")]

    def by(column: str, name: str) -> DataFrame:
        table = seen.where(F.col(column).isNotNull()).groupBy(F.col(column).alias(f"_{name}")).agg(*sums(f"{name}_"))
        return scratch.write(table, name)

    # two rows of one number per language
    whole = seen.agg(*sums("all_")).first()
    claimed = seen.where(F.col("declared").isNotNull()).agg(*sums("claim_")).first()
    j = seen
    for column, name in (("host", "host"), ("suffix", "suffix"), ("declared", "said")):
        j = j.join(by(column, name), F.col(column) == F.col(f"_{name}"), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    # the row itself is left out of its host's and suffix's counts
    less = lambda name, i: F.greatest(zero(f"_{name}_{i}") - F.when(F.col(f"_{name}").isNotNull(), F.col(f"_p{i}")).otherwise(0.0), F.lit(0.0))
    size = lambda name: F.greatest(F.coalesce(F.col(f"_{name}_n"), F.lit(1)) - 1, F.lit(0)).cast("double")
    values = []
    for i, lang in enumerate(langs):
        overall = F.lit(((whole[f"_all_{i}"] or 0.0) + 1.0) / (whole["_all_n"] + len(langs)))
        suffix = (less("suffix", i) + cfg.suffix_weight * overall) / (size("suffix") + cfg.suffix_weight)
        host = (less("host", i) + cfg.host_weight * suffix) / (size("host") + cfg.host_weight)
        expected = F.when(F.col("declared") == lang, cfg.declared_trust).otherwise((1 - cfg.declared_trust) / len(langs))
        said = (zero(f"_said_{i}") + cfg.declared_weight * expected) / ((claimed[f"_claim_{i}"] or 0.0) + cfg.declared_weight)
        values.append(F.col("ll")[i] + F.log(host) + F.when(F.col("declared").isNotNull(), F.log(said)).otherwise(0.0))
    j = _softmax(j.select(*keep, F.array(*values).alias("_value")), "_value", "_post").select(*keep, "_post")
    best = F.array_max("_post")
    return j.select(*keep, F.element_at(F.array(*[F.lit(x) for x in langs]), F.array_position("_post", best).cast("int")).alias("lang_id"),
                    best.alias("score"))


_NOISE = "(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>|&[a-z]+;"


def page_rows(pages: DataFrame) -> DataFrame:
    """(page_id, doc_id, text, host, suffix, declared) of web pages."""
    host = host_of(F.col("url"))
    suffix = F.substring_index(host, ".", -1)
    declared = F.lower(F.regexp_extract("html", "(?i)<html[^>]*\\slang\\s*=\\s*[\"']?([A-Za-z]{2,3})", 1))
    none = lambda c: F.when(c != "", c)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.lit(None).cast("long").alias("doc_id"),
                        F.regexp_replace("html", _NOISE, " ").alias("text"), none(host).alias("host"),
                        none(suffix).alias("suffix"), none(declared).alias("declared"))


def document_rows(documents: DataFrame) -> DataFrame:
    """The same of plain documents: the source stands for the host; no address, no markup."""
    none = F.lit(None).cast("string")
    return documents.select(F.lit(None).cast("long").alias("page_id"), F.col("doc_id").cast("long").alias("doc_id"), "text",
                            F.concat(F.lit("source:"), F.col("source")).alias("host"), none.alias("suffix"), none.alias("declared"))
