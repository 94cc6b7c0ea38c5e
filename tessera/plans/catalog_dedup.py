"""Registered queries of the dedup / decontamination phase."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import config as C
from tessera.operators import decontam as DC
from tessera.operators import dedup as DD
from tessera.plans import oracle as Q
from tessera.plans import reports as REP
from tessera.plans.corpus import build_corpus, phase2_report
from tessera.plans.inputs import Inputs
from tessera.session import written

KEY = ["source", "shard", "pos"]


def q_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    c = Inputs(spark, d).corpus_input()
    return DD.exact_firsts(c, "shard").withColumnRenamed("_h", "exact_hash")


def q_exact_dedup_source(spark: SparkSession, d: str) -> DataFrame:
    c = Inputs(spark, d).corpus_input()
    return DD.exact_firsts(c, "source").withColumnRenamed("_h", "exact_hash")


def q_contam_grams(spark: SparkSession, d: str) -> DataFrame:
    i = Inputs(spark, d)
    return DC.contamination_grams(DC.benchmark_text(i.table("benchmark")))


def q_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    i = Inputs(spark, d)
    c = i.corpus_input(policy=("decontaminate",)).where("decontaminate")
    grams = DC.contamination_grams(DC.benchmark_text(i.table("benchmark")))
    hit = DC.contaminated_keys(c, grams, KEY).withColumn("contaminated", F.lit(True))
    return c.select(*KEY).join(hit, KEY, "left").select(*KEY, F.coalesce("contaminated", F.lit(False)).alias("contaminated"))


def q_minhash_signature(spark: SparkSession, d: str) -> DataFrame:
    i = Inputs(spark, d)
    c = i.corpus_input(policy=("near_dup",)).where("near_dup")
    return DD.with_signature(c.select(*KEY, "text"), "text").select(*KEY, "sig")


def q_near_dups(spark: SparkSession, d: str) -> DataFrame:
    i = Inputs(spark, d)
    c = i.corpus_input(policy=("near_dup",)).where("near_dup")
    return DD.near_duplicates(c.select(*KEY, "text"))


def q_near_dup_counts(spark: SparkSession, d: str) -> DataFrame:
    nd = q_near_dups(spark, d)
    g = nd.rollup("source").agg(F.count(F.lit(1)).alias("docs"),
                                F.sum(F.col("near_dup").cast("int")).cast("bigint").alias("near_dups"),
                                F.grouping("source").alias("_g"))
    return g.select(F.when(F.col("_g") == 1, F.lit(REP.TOTAL)).otherwise(F.col("source")).alias("source"),
                    "docs", "near_dups")


def q_build_corpus(spark: SparkSession, d: str) -> DataFrame:
    i = Inputs(spark, d)
    return build_corpus(i.corpus_input(policy=("near_dup", "decontaminate")), [i.table("benchmark")]) \
        .select(*KEY, "reason", F.length("text").cast("bigint").alias("chars"))


def q_phase2_report(spark: SparkSession, d: str) -> DataFrame:
    i = Inputs(spark, d)
    return phase2_report(build_corpus(i.corpus_input(policy=("near_dup", "decontaminate")), [i.table("benchmark")]))


def q_phase2_document(spark: SparkSession, d: str) -> DataFrame:
    """The phase-2 report written as one JSON document and read back with its schema: a row a source and reason."""
    i = Inputs(spark, d)
    built = build_corpus(i.corpus_input(policy=("near_dup", "decontaminate")), [i.table("benchmark")])
    rows = REP.read_document(written(REP.phase2_document(built)), REP.PHASE2_SCHEMA)
    return rows.select("position", F.col("name").alias("source"), "kept", "est_tokens", F.explode("reasons").alias("reason", "docs"))


QUERIES = {
    "phase2_document": q_phase2_document,
    "exact_dedup": q_exact_dedup,
    "exact_dedup_source": q_exact_dedup_source,
    "contam_grams": q_contam_grams,
    "decontaminate": q_decontaminate,
    "minhash_signature": q_minhash_signature,
    "near_dups": q_near_dups,
    "near_dup_counts": q_near_dup_counts,
    "build_corpus": q_build_corpus,
    "phase2_report": q_phase2_report,
}

# ----------------------------------------------------------------------------
# Oracle SQL
# ----------------------------------------------------------------------------

def norm(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), {Q.lit('[' + Q.WS + ']+')}, ' ', 'g'))"


def words(x: str) -> str:
    return f"regexp_extract_all({norm(x)}, '[a-z0-9]+')"


def grams(w: str, n: int) -> str:
    return (f"(CASE WHEN len({w}) < {n} THEN []::VARCHAR[] ELSE list_transform(range(1, len({w}) - {n - 2}), "
            f"lambda i: array_to_string({w}[i:i + {n - 1}], ' ')) END)")


CORPUS = (Q.clean_ctes() + ",\n" + f"""
corpus AS (SELECT source, shard, pos, trim(replace(text, chr(10), ' ')) AS text,
                  {Q.policy_case('near_dup')} AS near_dup_src, {Q.policy_case('decontaminate')} AS decon_src
           FROM cleaned WHERE kept),
cw AS (SELECT corpus.*, {words('text')} AS w FROM corpus)""")

CONTAM = f"""
bw AS (SELECT {words("concat_ws(' ', text)")} AS w FROM benchmark),
cg AS (SELECT DISTINCT unnest({grams('w', C.DECONTAM_NGRAM)}) AS gram FROM bw),
dg AS (SELECT source, shard, pos, unnest({grams('w', C.DECONTAM_NGRAM)}) AS gram FROM cw WHERE decon_src),
hit AS (SELECT DISTINCT source, shard, pos FROM dg WHERE gram IN (SELECT gram FROM cg)),
contam AS (SELECT c.source, c.shard, c.pos, (h.pos IS NOT NULL) AS contaminated
           FROM cw c LEFT JOIN hit h ON c.source = h.source AND c.shard = h.shard AND c.pos = h.pos WHERE c.decon_src)"""

EXACT = f"""
eh AS (SELECT source, shard, pos, md5({norm('text')}) AS exact_hash FROM corpus),
ef AS (SELECT eh.*, row_number() OVER (PARTITION BY source, shard, exact_hash ORDER BY pos) = 1 AS is_first FROM eh)"""


def _perm_values() -> str:
    return ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(DD.minhash_params()))


SIG = f"""
perms(i, a, b) AS (VALUES {_perm_values()}),
nw AS (SELECT source, shard, pos, w FROM cw WHERE near_dup_src),
sh AS (SELECT source, shard, pos,
              CASE WHEN len(w) = 0 THEN []::VARCHAR[]
                   WHEN len(w) < {C.SHINGLE_K} THEN [array_to_string(w, ' ')]
                   ELSE list_transform(range(1, len(w) - {C.SHINGLE_K - 2}),
                                       lambda i: array_to_string(w[i:i + {C.SHINGLE_K - 1}], ' ')) END AS shs
       FROM nw),
shh AS (SELECT source, shard, pos,
               CAST(('0x' || substr(md5(s), 1, 8)) AS BIGINT) % {DD.MERSENNE_P} AS h
        FROM (SELECT source, shard, pos, unnest(shs) AS s FROM sh)),
pm AS (SELECT source, shard, pos, i, min((a * h + b) % {DD.MERSENNE_P}) AS v FROM shh, perms GROUP BY ALL),
sigs AS (SELECT nw.source, nw.shard, nw.pos,
                CASE WHEN count(pm.v) = 0 THEN list_transform(range({C.MINHASH_PERM}), lambda x: CAST({DD.EMPTY_SIGNATURE_VALUE} AS BIGINT))
                     ELSE list(pm.v ORDER BY pm.i) END AS sig
         FROM nw LEFT JOIN pm ON nw.source = pm.source AND nw.shard = pm.shard AND nw.pos = pm.pos
         GROUP BY nw.source, nw.shard, nw.pos)"""

_DC = C.DedupConfig()
NEAR = f"""
rk AS (SELECT source, shard, pos, sig, row_number() OVER (PARTITION BY source ORDER BY shard, pos) AS rnk FROM sigs),
mem AS (SELECT source, rnk, b AS band, array_to_string(list_transform(sig[b * {_DC.rows} + 1:b * {_DC.rows} + {_DC.rows}],
                                                         lambda v: CAST(v AS VARCHAR)), ',') AS bucket
        FROM rk, range({_DC.bands}) t(b)),
st(it, source, rnk, status) AS (
  SELECT 0, source, rnk, 'u' FROM (SELECT DISTINCT source, rnk FROM mem)
  UNION ALL
  (WITH cur AS (SELECT * FROM st),
        um AS (SELECT m.* FROM mem m JOIN cur ON m.source = cur.source AND m.rnk = cur.rnk WHERE cur.status = 'u'),
        bm AS (SELECT source, band, bucket, min(rnk) AS mr FROM um GROUP BY ALL),
        newk AS (SELECT um.source, um.rnk FROM um JOIN bm USING (source, band, bucket)
                 GROUP BY um.source, um.rnk HAVING bool_and(um.rnk = bm.mr)),
        kb AS (SELECT DISTINCT um.source, band, bucket FROM um JOIN newk USING (source, rnk)),
        newd AS (SELECT DISTINCT um.source, um.rnk FROM um JOIN kb USING (source, band, bucket))
   SELECT it + 1, cur.source, cur.rnk,
          CASE WHEN cur.status <> 'u' THEN cur.status
               WHEN k.rnk IS NOT NULL THEN 'k' WHEN d.rnk IS NOT NULL THEN 'd' ELSE 'u' END
   FROM cur LEFT JOIN newk k USING (source, rnk) LEFT JOIN newd d USING (source, rnk)
   WHERE EXISTS (SELECT 1 FROM cur WHERE status = 'u'))),
fin AS (SELECT source, rnk, status FROM st WHERE it = (SELECT max(it) FROM st)),
near AS (SELECT rk.source, rk.shard, rk.pos, fin.status = 'd' AS near_dup
         FROM rk JOIN fin ON rk.source = fin.source AND rk.rnk = fin.rnk)"""

REASONS = f"""
reasons AS (SELECT c.source, c.shard, c.pos, c.text,
                   CASE WHEN coalesce(n.near_dup, false) THEN 'near_dup'
                        WHEN coalesce(t.contaminated, false) THEN 'contaminated'
                        WHEN NOT e.is_first THEN 'exact_dup' ELSE 'kept' END AS reason
            FROM corpus c
            JOIN ef e ON c.source = e.source AND c.shard = e.shard AND c.pos = e.pos
            LEFT JOIN near n ON c.source = n.source AND c.shard = n.shard AND c.pos = n.pos
            LEFT JOIN contam t ON c.source = t.source AND c.shard = t.shard AND c.pos = t.pos)"""

_ALL = ",\n".join([CORPUS, CONTAM.strip(), EXACT.strip(), SIG.strip(), NEAR.strip(), REASONS.strip()])
_ALL = _ALL.replace("WITH raw AS", "WITH RECURSIVE raw AS", 1)

SQL = {
    "exact_dedup": CORPUS + ",\n" + EXACT.strip() + "\nSELECT source, shard, pos, exact_hash, is_first FROM ef",
    "stream_dedup": CORPUS + ",\n" + EXACT.strip() + "\nSELECT source, shard, pos, is_first FROM ef",
    "exact_dedup_source": CORPUS + ",\n" + EXACT.strip().replace("PARTITION BY source, shard, exact_hash ORDER BY pos",
                                                                  "PARTITION BY source, exact_hash ORDER BY shard, pos")
    + "\nSELECT source, shard, pos, exact_hash, is_first FROM ef",
    "contam_grams": "WITH " + CONTAM.strip().split("),\ndg AS")[0] + ")\nSELECT gram FROM cg",
    "decontaminate": CORPUS + ",\n" + CONTAM.strip() + "\nSELECT source, shard, pos, contaminated FROM contam",
    "minhash_signature": CORPUS + ",\n" + SIG.strip() + "\nSELECT source, shard, pos, sig FROM sigs",
    "near_dups": CORPUS.replace("WITH raw AS", "WITH RECURSIVE raw AS", 1) + ",\n" + SIG.strip() + ",\n" + NEAR.strip()
    + "\nSELECT source, shard, pos, near_dup FROM near",
    "near_dup_counts": CORPUS.replace("WITH raw AS", "WITH RECURSIVE raw AS", 1) + ",\n" + SIG.strip() + ",\n"
    + NEAR.strip() + """,
per AS (SELECT source, count(*) AS docs, CAST(sum(CASE WHEN near_dup THEN 1 ELSE 0 END) AS BIGINT) AS near_dups
        FROM near GROUP BY source)
SELECT * FROM per UNION ALL SELECT 'TOTAL', CAST(sum(docs) AS BIGINT), CAST(sum(near_dups) AS BIGINT) FROM per""",
    "build_corpus": _ALL + "\nSELECT source, shard, pos, reason, CAST(length(text) AS BIGINT) AS chars FROM reasons",
    "phase2_report": _ALL + f""",
ps AS (SELECT source, shard,
              sum(CASE WHEN reason = 'kept' THEN 1 ELSE 0 END) AS kept,
              floor(sum(CASE WHEN reason = 'kept' THEN length(text) ELSE 0 END) / {C.CHARS_PER_TOKEN}) AS est_tokens,
              {", ".join(f"sum(CASE WHEN reason = '{r}' THEN 1 ELSE 0 END) AS {r}_n" for r in REP.PHASE2_REASONS)}
       FROM reasons GROUP BY source, shard)
SELECT coalesce(source, 'TOTAL') AS source, CAST(sum(kept) AS BIGINT) AS kept, CAST(sum(est_tokens) AS BIGINT) AS est_tokens,
       {", ".join(f"CAST(sum({r}_n) AS BIGINT) AS {r}" for r in ("near_dup", "exact_dup", "contaminated"))}
FROM ps GROUP BY ROLLUP (source)""",
}
SQL["phase2_document"] = SQL["phase2_report"].split("SELECT coalesce(source, 'TOTAL')")[0].rstrip() + """,
su AS (SELECT CAST(row_number() OVER (ORDER BY source) - 1 AS INTEGER) AS position, source, CAST(sum(kept) AS BIGINT) AS kept,
              CAST(sum(est_tokens) AS BIGINT) AS est_tokens, """ + ", ".join(
    f"CAST(sum({r}_n) AS BIGINT) AS {r}_n" for r in REP.PHASE2_REASONS) + """ FROM ps GROUP BY source)
SELECT position, source, kept, est_tokens, unnest([""" + ", ".join(f"'{r}'" for r in REP.PHASE2_REASONS) + "]) AS reason, unnest([" \
    + ", ".join(f"{r}_n" for r in REP.PHASE2_REASONS) + "]) AS docs FROM su"
