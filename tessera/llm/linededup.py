"""Line dedup by site-relative frequency (DataFrame functions only).

A line is boilerplate on a host when more than ``ratio`` of the host's pages hold it (and at
least ``min_pages`` do); boilerplate lines are dropped from that host's pages.

Plan: lines are exploded to ``(host, 16-byte digest)`` once per page, counted with map-side
partial aggregation (a line on a third of all pages is a few rows per task), and joined to the
host totals, one row per host. What is left, the boilerplate digests, is at most
``lines per page / ratio`` per host; it is written, so Spark knows its size and broadcasts it
only if small. Otherwise the pages meet it by ``(host, salt)``: a hot host is dealt over
``salts`` groups and both sides are plain exchanges, which adaptive execution can split.
Text moves at most once.

Cases: null text stays null (no lines); a null host is no site, its pages stay as they are;
blank lines are never boilerplate; a line counts once per page however often it repeats;
pages that repeat as rows count as pages of their own unless ``distinct`` is set: then pages of a
host with the same text count once, in the lines as in the host total (null texts as one text), and
still all of them lose the boilerplate; a page that loses every line stays with empty text; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch


@dataclass(frozen=True)
class LineConfig:
    ratio: float = 0.05
    min_pages: int = 3
    salts: int = 16
    distinct: bool = False      # count each text of a host once


def line_key(line):
    """Digest of a line without its outer ASCII white space."""
    return F.unhex(F.md5(F.regexp_replace(line, "^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$", "")))


def page_keys(text):
    """Distinct digests of a page's lines; the blank line's digest among them."""
    return F.array_distinct(F.transform(F.split(text, "\n", -1), line_key))


def boilerplate(pages: DataFrame, host: str, text: str, cfg: LineConfig = LineConfig()) -> DataFrame:
    """(host, keys): the boilerplate digests of each host that has any."""
    named = (pages.where(F.col(host).isNotNull())
             .select(F.col(host).alias("host"), F.unhex(F.md5(F.col(text))).alias("page"), page_keys(F.col(text)).alias("keys")))
    if cfg.distinct:
        # copies collapse per task before the exchange; digests travel, not text
        named = named.dropDuplicates(["host", "page"])
    blank = F.unhex(F.md5(F.lit("")))
    lines = (named.select("host", F.explode("keys").alias("key"))
             .where(F.col("key") != blank)
             .groupBy("host", "key").agg(F.count("*").alias("n"))
             .where(F.col("n") >= cfg.min_pages))
    totals = named.groupBy("host").agg(F.count("*").alias("pages"))
    return (lines.join(totals, "host").where(F.col("n") / F.col("pages") > cfg.ratio)
            .groupBy("host").agg(F.collect_list("key").alias("keys")))


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text",
                     cfg: LineConfig = LineConfig(), dropped: str | None = None) -> DataFrame:
    """``pages`` without their hosts' boilerplate lines; ``dropped`` names an optional count column."""
    scratch = Scratch(pages.sparkSession)
    keys = scratch.write(boilerplate(pages, host, text, cfg), "boilerplate")
    salted = keys.select(F.col("host").alias("_ld_host"), F.col("keys").alias("_ld_keys"),
                         F.explode(F.sequence(F.lit(0), F.lit(cfg.salts - 1))).alias("_ld_slot"))
    # rows of a host differ in their text, so its digest deals them over the salts
    slot = F.pmod(F.xxhash64(F.col(text)), F.lit(cfg.salts)).cast("int")
    joined = (pages.withColumn("_ld_salt", slot)
              .join(salted, (F.col(host) == F.col("_ld_host")) & (F.col("_ld_salt") == F.col("_ld_slot")), "left"))
    parts = F.split(F.col(text), "\n", -1)
    kept = F.filter(parts, lambda x: ~F.array_contains(F.col("_ld_keys"), line_key(x)))
    out = joined.withColumn("_ld_kept", F.when(F.col("_ld_keys").isNotNull() & F.col(text).isNotNull(), kept))
    if dropped:
        out = out.withColumn(dropped, F.coalesce(F.size(parts) - F.size("_ld_kept"), F.lit(0)).cast("int"))
    out = out.withColumn(text, F.when(F.col("_ld_kept").isNotNull(), F.array_join("_ld_kept", "\n"))
                         .otherwise(F.col(text)))
    return out.drop("_ld_salt", "_ld_host", "_ld_keys", "_ld_slot", "_ld_kept")


#: DuckDB form of the operator over a table ``t`` with columns doc_id, source, text.
SQL_STEPS = """
  ld_lines AS (SELECT DISTINCT row_id, source, regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS line
    FROM (SELECT row_id, source, unnest(string_split(text, chr(10))) AS line FROM t WHERE source IS NOT NULL)),
  ld_totals AS (SELECT source, count(*) AS pages FROM t GROUP BY source),
  ld_drop AS (SELECT source, line FROM ld_lines JOIN ld_totals USING (source) WHERE line <> ''
    GROUP BY source, line, pages HAVING count(*) >= {min_pages} AND count(*) / pages > {ratio}),
  ld_kept AS (SELECT row_id, count(*) FILTER (WHERE d.line IS NULL) AS n_left, count(d.line) AS n_dropped,
      string_agg(p.line, chr(10) ORDER BY p.k) FILTER (WHERE d.line IS NULL) AS text
    FROM (SELECT row_id, source, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) AS k FROM t) p
    LEFT JOIN ld_drop d ON p.source = d.source
      AND regexp_replace(p.line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') = d.line
    GROUP BY row_id)"""


def sql(cfg: LineConfig = LineConfig()) -> str:
    return ("WITH t AS (SELECT row_number() OVER () AS row_id, doc_id, source, text FROM documents),"
            + SQL_STEPS.format(min_pages=cfg.min_pages, ratio=cfg.ratio)
            + """
SELECT t.doc_id, t.source, CASE WHEN t.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(k.n_dropped, 0)::INTEGER AS n_dropped
FROM t LEFT JOIN ld_kept k USING (row_id)""")
