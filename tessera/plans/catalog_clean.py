"""Registered queries of the cleaning phase (Spark side + DuckDB oracle SQL)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import config as C
from tessera.functions import text as X
from tessera.operators import ocr as O
from tessera.operators.clean import clean_documents, clean_stages
from tessera.plans import oracle as Q
from tessera.plans import reports as REP
from tessera.plans.inputs import Inputs, first_records
from tessera.session import written
from tessera.sources import registry as R

# ----------------------------------------------------------------------------
# Spark queries
# ----------------------------------------------------------------------------


def q_source_policy(spark: SparkSession, d: str) -> DataFrame:
    i = Inputs(spark, d)
    docs = i.raw.groupBy("source").agg(F.count(F.lit(1)).alias("docs"),
                                       F.sum(F.length("text")).cast("bigint").alias("raw_chars"))
    pol = i.registry.select(F.col("name").alias("source"), "token_budget", "strict_ocr", "near_dup", "decontaminate")
    return docs.join(F.broadcast(pol), "source")


def q_shard_plan(spark: SparkSession, d: str) -> DataFrame:
    i = Inputs(spark, d)
    return i.caps(web_shards=1)


def q_first_n_sample(spark: SparkSession, d: str) -> DataFrame:
    i = Inputs(spark, d)
    return i.first_n(C.SMOKE_N).select("source", "shard", "pos", F.length("text").cast("bigint").alias("raw_chars"),
                                       F.md5("text").alias("text_md5"))


def _smoke(spark, d, n):
    i = Inputs(spark, d)
    return clean_documents(i.first_n(n).withColumn("_raw", F.col("text")), None, None,
                           keep_cols=("_raw",))


def q_smoke_summary(spark: SparkSession, d: str, n: int = C.SMOKE_N) -> DataFrame:
    c = _smoke(spark, d, n)
    return c.groupBy("source").agg(
        F.lit(n).cast("bigint").alias("streamed"),
        F.sum(F.col("kept").cast("int")).cast("bigint").alias("kept"),
        *[F.sum((F.col("reason") == r).cast("int")).cast("bigint").alias(r)
          for r in ("too_short", "repetitive", "non_english")])


def q_smoke_excerpts(spark: SparkSession, d: str, n: int = C.SMOKE_N) -> DataFrame:
    c = _smoke(spark, d, n)
    ex = F.when(F.col("kept"), F.substring("text", 1, 240)).otherwise(F.substring("_raw", 1, 160))
    return c.select("source", "pos", "raw_chars", "clean_chars", F.upper("reason").alias("reason"),
                    F.replace(ex, F.lit("\n"), F.lit(" / ")).alias("excerpt"))


def q_measure_sources(spark: SparkSession, d: str, n: int = C.MEASURE_N) -> DataFrame:
    i = Inputs(spark, d)
    c = clean_documents(i.first_n(n), None, None)
    agg = c.groupBy("source").agg(
        F.sum(F.col("kept").cast("int")).cast("bigint").alias("kept"),
        F.sum(F.when(F.col("kept"), F.col("clean_chars")).otherwise(0)).cast("bigint").alias("clean_chars"))
    totals = i.raw.groupBy("source").agg(F.count(F.lit(1)).alias("total_rows"))
    avg = F.col("clean_chars") / F.lit(float(n))
    return agg.join(totals, "source").select(
        "source", "total_rows", "kept",
        (F.col("total_rows") * avg / F.lit(C.CHARS_PER_TOKEN)).cast("bigint").alias("est_clean_tokens"),
        F.round(F.col("kept") / F.lit(float(n)), 3).alias("keep_rate"))


def q_line_nonalnum(spark: SparkSession, d: str) -> DataFrame:
    i = Inputs(spark, d)
    lines = F.transform(X.split_lines(F.col("text")), X.collapse_ws)
    ln = i.raw.select("source", "pos", F.explode(lines).alias("line"))
    short = F.length("line") < C.MIN_LINE_CHARS
    symbolic = X.nonalnum_ratio(F.col("line")) > F.lit(C.MAX_NONALNUM_RATIO)
    return ln.groupBy("source", "pos").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(short.cast("int")).cast("bigint").alias("short_lines"),
        F.sum((~short & symbolic).cast("int")).cast("bigint").alias("symbol_lines"),
        F.sum((~short & ~symbolic).cast("int")).cast("bigint").alias("kept_lines"))


def q_filter_lines(spark: SparkSession, d: str) -> DataFrame:
    i = Inputs(spark, d)
    return i.raw.select("source", "pos", X.filter_lines(F.col("text")).alias("text")) \
        .withColumn("chars", F.length("text").cast("bigint"))


def q_strip_boilerplate(spark: SparkSession, d: str) -> DataFrame:
    i = Inputs(spark, d)
    lines = i.raw.select("source", "pos", X.split_lines_exact(F.col("text")).alias("_lines"))
    kept = lines.withColumn("_kept", X.drop_boilerplate(F.col("_lines")))
    return kept.select("source", "pos", F.array_join("_kept", "\n").alias("text"),
                       (F.size("_lines") - F.size("_kept")).cast("bigint").alias("removed_lines"))


def q_clean_flatten(spark: SparkSession, d: str) -> DataFrame:
    i = Inputs(spark, d)
    return i.clean_table().where("kept").select("source", "shard", "pos", X.flatten_newlines(F.col("text")).alias("line"))


def q_ascii_ratio(spark: SparkSession, d: str) -> DataFrame:
    i = Inputs(spark, d)
    return i.raw.select("source", "pos", X.ascii_ratio(F.col("text")).alias("ascii_ratio"),
                        X.ascii_ratio(X.lang_sample(F.col("text"))).alias("sample_ascii_ratio"))


def q_language_gate(spark: SparkSession, d: str) -> DataFrame:
    i = Inputs(spark, d)
    st = clean_stages(i.raw)
    ar = F.col("ascii_ratio")
    band = F.when(ar >= 0.99, "ascii").when(ar < 0.90, "non_ascii").otherwise("detector")
    return st.select("source", "pos", "ascii_ratio", band.alias("band"), "is_english")


def q_repetition_ratio(spark: SparkSession, d: str) -> DataFrame:
    i = Inputs(spark, d)
    s2 = i.raw.select("source", "pos", X.clean_text(F.col("text")).alias("s2"))
    rep = X.with_repetition(s2, "s2")
    n_words = F.when(F.length("s2") > 0, F.size("_rep_words")).otherwise(0).cast("bigint")
    n_grams = F.greatest(n_words - (C.REPETITION_NGRAM - 1), F.lit(0).cast("bigint"))
    # under 2n words a document has no ratio and is not repetitive
    long_enough = n_words >= 2 * C.REPETITION_NGRAM
    return rep.select("source", "pos", n_words.alias("n_words"), n_grams.alias("n_grams"),
                      F.when(long_enough, F.col("_rep_top").cast("bigint")).alias("top_count"), F.col("_rep_ratio").alias("ratio"),
                      F.coalesce(F.col("_rep_ratio") > F.lit(C.MAX_REPETITION_RATIO), F.lit(False)).alias("repetitive"))


def q_clean_documents(spark: SparkSession, d: str) -> DataFrame:
    return Inputs(spark, d).clean()


def q_drop_report(spark: SparkSession, d: str) -> DataFrame:
    return REP.drop_report(Inputs(spark, d).clean())


def q_token_budget_cap(spark: SparkSession, d: str) -> DataFrame:
    return Inputs(spark, d).capped().select("source", "shard", "pos", "kept", "reason", "clean_chars")


def q_shard_stats(spark: SparkSession, d: str) -> DataFrame:
    return REP.shard_stats(Inputs(spark, d).clean())


def q_phase1_report(spark: SparkSession, d: str) -> DataFrame:
    return REP.phase1_report(Inputs(spark, d).clean())


def _pre_ocr_kept(i: Inputs, first_n: int | None = None) -> DataFrame:
    """Documents of strict-OCR sources that pass every gate before OCR (sweep input)."""
    raw = i.raw_with_policy().where("strict_ocr").drop("strict_ocr")
    if first_n is not None:
        raw = first_records(raw, first_n)
    # materialised: the pre-OCR result is a phase output read by the gate
    return written(clean_documents(raw, None, None)).where("kept")


def q_dictionary_build(spark: SparkSession, d: str) -> DataFrame:
    return Inputs(spark, d).dictionary


def q_ocr_gate(spark: SparkSession, d: str) -> DataFrame:
    i = Inputs(spark, d)
    r = O.ocr_ratio(_pre_ocr_kept(i), ["source", "shard", "pos"], "text", i.dictionary)
    return r.withColumn("ocr", F.col("nonword_ratio") > F.lit(C.NONWORD_RATIO_MAX))


def q_ocr_threshold_sweep(spark: SparkSession, d: str, n: int = C.OCR_SAMPLE_N) -> DataFrame:
    i = Inputs(spark, d)
    r = O.ocr_ratio(_pre_ocr_kept(i, n), ["source", "shard", "pos"], "text", i.dictionary)
    return O.threshold_sweep(r.where(F.col("n_tokens") >= C.OCR_MIN_TOKENS))


def q_shard_scan(spark: SparkSession, d: str) -> DataFrame:
    """The records of the shards that a listing and the plan choose (one shard of web-like sources), from shard files."""
    import uuid

    from tessera.session import checkpoint_dir
    from tessera.sources import listing as LS
    i = Inputs(spark, d)
    root = f"{checkpoint_dir(spark).rstrip('/')}/shards-{uuid.uuid4().hex}"
    LS.write_shards(i.raw, i.registry, root)
    manifest = LS.with_shards(LS.manifest_of(LS.list_files(spark, root)))
    return LS.scan(spark, R.shard_plan(manifest, i.registry, web_shards=1), i.registry)


def _stream_base(spark: SparkSession, d: str) -> str:
    """A folder with the clean table that a stream wrote (file source -> Parquet sink, availableNow trigger, checkpointed)."""
    import uuid

    from tessera.session import checkpoint_dir
    from tessera.streaming import clean_stream as S
    i = Inputs(spark, d)
    base = f"{checkpoint_dir(spark).rstrip('/')}/clean_stream-{uuid.uuid4().hex}"
    cleaned = S.clean_stream(S.raw_stream(spark, d, "documents.parquet"), i.registry, i.dictionary)
    S.start_clean_sink(cleaned, f"{base}/out", f"{base}/chk").awaitTermination()
    return base


_CLEAN_SCHEMA = "source string, shard int, pos bigint, kept boolean, reason string, raw_chars bigint, clean_chars bigint, text string"


def q_clean_stream(spark: SparkSession, d: str) -> DataFrame:
    """The clean phase as a Structured Streaming query; returns what the sink wrote."""
    return spark.read.schema(_CLEAN_SCHEMA).parquet(f"{_stream_base(spark, d)}/out")


def q_stream_counters(spark: SparkSession, d: str) -> DataFrame:
    """Running drop counters over the clean table's stream, as its upserts left them."""
    from tessera.streaming import clean_stream as S
    base = _stream_base(spark, d)
    cleaned = S.table_stream(spark, f"{base}/out", _CLEAN_SCHEMA)
    S.start_counters(cleaned, f"{base}/counters", f"{base}/chk-counters").awaitTermination()
    return S.read_counters(spark, f"{base}/counters")


def q_stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """First copies per (source, shard) by the stream's state, beside every kept row of the clean table."""
    from tessera.streaming import clean_stream as S
    base = _stream_base(spark, d)
    cleaned = S.table_stream(spark, f"{base}/out", _CLEAN_SCHEMA)
    S.start_first_copies(cleaned, f"{base}/changes", f"{base}/chk-changes").awaitTermination()
    first = S.first_copies(spark.read.schema(S.CHANGES).parquet(f"{base}/changes")).withColumn("_f", F.lit(True))
    kept = spark.read.schema(_CLEAN_SCHEMA).parquet(f"{base}/out").where("kept").select("source", "shard", "pos")
    return (kept.join(first, ["source", "shard", "pos"], "left")
            .select("source", "shard", "pos", F.coalesce("_f", F.lit(False)).alias("is_first")))


def q_language_detect(spark: SparkSession, d: str) -> DataFrame:
    """Detector option for the ASCII band: profiles from the labelled documents,
    applied to the band documents of the chain (after the length gate)."""
    from tessera.operators import lang as LG
    i = Inputs(spark, d)
    profile, langs = LG.train_profiles(i.documents)
    st = clean_stages(i.raw)
    band = X.filter_after(st, (F.col("clean_chars") >= C.MIN_DOC_CHARS) & (F.col("ascii_ratio") >= 0.90)
                          & (F.col("ascii_ratio") < 0.99))
    return LG.detect(band, ["source", "pos"], "_s2", profile, langs)


QUERIES = {
    "language_detect": q_language_detect,
    "clean_stream": q_clean_stream,
    "dictionary_build": q_dictionary_build,
    "shard_scan": q_shard_scan,
    "stream_counters": q_stream_counters,
    "stream_dedup": q_stream_dedup,
    "ocr_gate": q_ocr_gate,
    "ocr_threshold_sweep": q_ocr_threshold_sweep,
    "source_policy": q_source_policy,
    "shard_plan": q_shard_plan,
    "first_n_sample": q_first_n_sample,
    "smoke_summary": q_smoke_summary,
    "smoke_excerpts": q_smoke_excerpts,
    "measure_sources": q_measure_sources,
    "line_nonalnum": q_line_nonalnum,
    "filter_lines": q_filter_lines,
    "strip_boilerplate": q_strip_boilerplate,
    "clean_flatten": q_clean_flatten,
    "ascii_ratio": q_ascii_ratio,
    "language_gate": q_language_gate,
    "repetition_ratio": q_repetition_ratio,
    "clean_documents": q_clean_documents,
    "drop_report": q_drop_report,
    "token_budget_cap": q_token_budget_cap,
    "shard_stats": q_shard_stats,
    "phase1_report": q_phase1_report,
}

# ----------------------------------------------------------------------------
# Oracle SQL
# ----------------------------------------------------------------------------

_FIRST_N = """first_n AS (SELECT * FROM (SELECT raw.*, row_number() OVER (PARTITION BY source ORDER BY shard, pos) AS rn
                          FROM raw) WHERE rn <= {n})"""


def _nonstrict_on(table: str) -> str:
    """clean CTEs (no OCR) over ``table`` instead of ``raw`` (continues a WITH list)."""
    return Q.clean_ctes(strict=False, src=table, with_raw=False, with_kw=False)


SQL = {
    "source_policy": f"""
        {'WITH ' + Q.RAW}
        SELECT source, count(*) AS docs, CAST(sum(length(text)) AS BIGINT) AS raw_chars,
               CAST({Q.policy_case('budget')} AS BIGINT) AS token_budget, {Q.policy_case('strict_ocr')} AS strict_ocr,
               {Q.policy_case('near_dup')} AS near_dup, {Q.policy_case('decontaminate')} AS decontaminate
        FROM raw GROUP BY source""",
    "shard_plan": f"""
        {'WITH ' + Q.RAW},
        man AS (SELECT DISTINCT source, shard, printf('%s/shard-%03d.parquet', source, shard) AS path,
                       {Q.policy_case('config')} AS config FROM raw),
        sel AS (SELECT * FROM (SELECT man.*, row_number() OVER (PARTITION BY source ORDER BY path) AS rn FROM man)
                WHERE config = 'default' OR rn <= 1)
        SELECT source, shard, path,
               CAST(row_number() OVER (PARTITION BY source ORDER BY path) - 1 AS INTEGER) AS shard_index,
               CAST({Q.policy_case('budget')} AS BIGINT) AS token_budget,
               count(*) OVER (PARTITION BY source) AS n_shards,
               CAST(floor({Q.policy_case('budget')} / count(*) OVER (PARTITION BY source)) AS BIGINT) AS per_shard_cap
        FROM sel""",
    "first_n_sample": f"""
        {'WITH ' + Q.RAW}, {_FIRST_N.format(n=C.SMOKE_N)}
        SELECT source, shard, pos, CAST(length(text) AS BIGINT) AS raw_chars, md5(text) AS text_md5 FROM first_n""",
    "smoke_summary": f"""
        {'WITH ' + Q.RAW}, {_FIRST_N.format(n=C.SMOKE_N)}, {_nonstrict_on('first_n')}
        SELECT source, CAST({C.SMOKE_N} AS BIGINT) AS streamed, CAST(sum(CASE WHEN kept THEN 1 ELSE 0 END) AS BIGINT) AS kept,
               CAST(sum(CASE WHEN reason = 'too_short' THEN 1 ELSE 0 END) AS BIGINT) AS too_short,
               CAST(sum(CASE WHEN reason = 'repetitive' THEN 1 ELSE 0 END) AS BIGINT) AS repetitive,
               CAST(sum(CASE WHEN reason = 'non_english' THEN 1 ELSE 0 END) AS BIGINT) AS non_english
        FROM cleaned GROUP BY source""",
    "smoke_excerpts": f"""
        {'WITH ' + Q.RAW}, {_FIRST_N.format(n=C.SMOKE_N)}, {_nonstrict_on('first_n')}
        SELECT c.source, c.pos, c.raw_chars, c.clean_chars, upper(c.reason) AS reason,
               replace(CASE WHEN c.kept THEN substring(c.text, 1, 240) ELSE substring(f.text, 1, 160) END, chr(10), ' / ')
                 AS excerpt
        FROM cleaned c JOIN first_n f ON c.pos = f.pos""",
    "measure_sources": f"""
        {'WITH ' + Q.RAW}, {_FIRST_N.format(n=C.MEASURE_N)}, {_nonstrict_on('first_n')},
        agg AS (SELECT source, CAST(sum(CASE WHEN kept THEN 1 ELSE 0 END) AS BIGINT) AS kept,
                       CAST(sum(CASE WHEN kept THEN clean_chars ELSE 0 END) AS BIGINT) AS clean_chars
                FROM cleaned GROUP BY source),
        tot AS (SELECT source, count(*) AS total_rows FROM raw GROUP BY source)
        SELECT agg.source, total_rows, kept,
               CAST(trunc(total_rows * (clean_chars / CAST({C.MEASURE_N} AS DOUBLE)) / {C.CHARS_PER_TOKEN}) AS BIGINT)
                 AS est_clean_tokens,
               round(kept / CAST({C.MEASURE_N} AS DOUBLE), 3) AS keep_rate
        FROM agg JOIN tot ON agg.source = tot.source""",
    "line_nonalnum": f"""
        {'WITH ' + Q.RAW},
        ln AS (SELECT source, pos, unnest(list_transform(string_split_regex(text, {Q.lit(Q.P1)}),
                                                         lambda x: {Q.norm_line('x')})) AS line FROM raw)
        SELECT source, pos, count(*) AS lines,
               CAST(sum(CASE WHEN length(line) < {C.MIN_LINE_CHARS} THEN 1 ELSE 0 END) AS BIGINT) AS short_lines,
               CAST(sum(CASE WHEN length(line) >= {C.MIN_LINE_CHARS}
                              AND {Q.nonalnum('line')} > CAST({C.MAX_NONALNUM_RATIO} AS DOUBLE) THEN 1 ELSE 0 END)
                    AS BIGINT) AS symbol_lines,
               CAST(sum(CASE WHEN length(line) >= {C.MIN_LINE_CHARS}
                              AND {Q.nonalnum('line')} <= CAST({C.MAX_NONALNUM_RATIO} AS DOUBLE) THEN 1 ELSE 0 END)
                    AS BIGINT) AS kept_lines
        FROM ln GROUP BY source, pos""",
    "filter_lines": f"""
        {'WITH ' + Q.RAW}
        SELECT source, pos, t AS text, CAST(length(t) AS BIGINT) AS chars
        FROM (SELECT source, pos, array_to_string({Q.filtered_lines('text')}, {Q.NL}) AS t FROM raw)""",
    "strip_boilerplate": f"""
        {'WITH ' + Q.RAW},
        sp AS (SELECT source, pos, string_split_regex(text, {Q.lit(Q.P1)}) AS parts FROM raw),
        ls AS (SELECT source, pos, CASE WHEN parts[len(parts)] = '' THEN parts[1:len(parts) - 1] ELSE parts END AS lines
               FROM sp)
        SELECT source, pos, array_to_string(list_filter(lines, lambda x: {Q.not_boiler('x')}), {Q.NL}) AS text,
               CAST(len(lines) - len(list_filter(lines, lambda x: {Q.not_boiler('x')})) AS BIGINT) AS removed_lines
        FROM ls""",
    "ascii_ratio": f"""
        {'WITH ' + Q.RAW}
        SELECT source, pos, {Q.ascii_ratio('text')} AS ascii_ratio,
               {Q.ascii_ratio(f'substring(text, 1, {C.LANG_SAMPLE_CHARS})')} AS sample_ascii_ratio
        FROM raw""",
    "language_gate": f"""
        {'WITH ' + Q.RAW}, {Q.STEP2}, {Q.LANG}
        SELECT s2.source, s2.pos, lang.ar AS ascii_ratio,
               CASE WHEN lang.ar >= CAST(0.99 AS DOUBLE) THEN 'ascii' WHEN lang.ar < CAST(0.90 AS DOUBLE) THEN 'non_ascii'
                    ELSE 'detector' END AS band,
               {Q.english('lang.ar')} AS is_english
        FROM s2 JOIN lang ON s2.pos = lang.pos""",
    "repetition_ratio": f"""
        {'WITH ' + Q.RAW}, {Q.STEP2}, {Q.REP.strip()}
        SELECT s2.source, s2.pos, CAST(coalesce(len(w.words), 0) AS BIGINT) AS n_words,
               CAST(greatest(coalesce(len(w.words), 0) - {C.REPETITION_NGRAM - 1}, 0) AS BIGINT) AS n_grams, top_count,
               rep_ratio AS ratio, coalesce(rep_ratio > CAST({C.MAX_REPETITION_RATIO} AS DOUBLE), false) AS repetitive
        FROM s2 LEFT JOIN w ON w.pos = s2.pos LEFT JOIN rep ON rep.pos = s2.pos""",
    "clean_documents": f"""
        {Q.clean_ctes()}
        SELECT * FROM cleaned""",
    "drop_report": f"""
        {Q.clean_ctes()}
        SELECT source, reason, count(*) AS docs FROM cleaned GROUP BY source, reason
        UNION ALL SELECT 'TOTAL' AS source, reason, count(*) AS docs FROM cleaned GROUP BY reason""",
    "token_budget_cap": f"""
        {Q.clean_ctes()}, {Q.caps_cte().strip()}, {Q.CAPPED.strip()}
        SELECT source, shard, pos, kept, reason, clean_chars FROM capped""",
    "shard_stats": f"""
        {Q.clean_ctes()}
        SELECT source, shard, count(*) AS streamed, CAST(sum(CASE WHEN kept THEN 1 ELSE 0 END) AS BIGINT) AS kept,
               CAST(sum(CASE WHEN kept THEN clean_chars ELSE 0 END) AS BIGINT) AS clean_chars,
               CAST(floor(sum(CASE WHEN kept THEN clean_chars ELSE 0 END) / {C.CHARS_PER_TOKEN}) AS BIGINT) AS est_tokens
        FROM cleaned GROUP BY source, shard""",
    "phase1_report": f"""
        {Q.clean_ctes()},
        ps AS (SELECT source, shard, count(*) AS streamed, sum(CASE WHEN kept THEN 1 ELSE 0 END) AS kept,
                      floor(sum(CASE WHEN kept THEN clean_chars ELSE 0 END) / {C.CHARS_PER_TOKEN}) AS est_tokens,
                      {", ".join(f"sum(CASE WHEN reason = '{r}' THEN 1 ELSE 0 END) AS {r}" for r in REP.PHASE1_REASONS)}
               FROM cleaned GROUP BY source, shard)
        SELECT coalesce(source, 'TOTAL') AS source,
               {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("streamed", "kept", "est_tokens", *REP.PHASE1_REASONS))}
        FROM ps GROUP BY ROLLUP (source)""",
}

SQL["shard_scan"] = f"""
        WITH {Q.RAW},
        ranked AS (SELECT source, CAST(dense_rank() OVER (PARTITION BY source ORDER BY shard) - 1 AS INTEGER) AS shard,
                          row_number() OVER (PARTITION BY source, shard ORDER BY pos) - 1 AS pos, text FROM raw)
        SELECT source, shard, pos, text FROM ranked
        WHERE shard < 1 OR CAST(substr(source, 4) AS INTEGER) < {next(lo for lo, *_, cfg, _ in C.FIXTURE_CLASSES if cfg)}"""
SQL["clean_stream"] = SQL["clean_documents"]
SQL["stream_counters"] = f"{Q.clean_ctes()}\nSELECT source, reason, count(*) AS docs FROM cleaned GROUP BY source, reason"
SQL["clean_flatten"] = f"""
        {Q.clean_ctes()}
        SELECT source, shard, pos, trim(replace(text, chr(10), ' ')) AS line FROM cleaned WHERE kept"""


_PRE_OCR = Q.clean_ctes(strict=False) + f""",
cand AS (SELECT source, shard, pos, text FROM cleaned WHERE kept AND {Q.policy_case('strict_ocr')}),
{Q.DICT.strip()},
ot AS (SELECT source, shard, pos, list_transform(regexp_extract_all(text, '[A-Za-z]{{3,}}'), lambda t: lower(t)) AS toks
       FROM cand),
ox AS (SELECT source, shard, pos, len(toks) AS nt, unnest(toks) AS word FROM ot WHERE len(toks) >= {C.OCR_MIN_TOKENS}),
om AS (SELECT ox.source, ox.shard, ox.pos, CAST(count(*) FILTER (WHERE dict.word IS NULL) AS BIGINT) AS n_nonword
       FROM ox LEFT JOIN dict ON ox.word = dict.word GROUP BY ox.source, ox.shard, ox.pos),
ocr_all AS (SELECT ot.source, ot.shard, ot.pos, CAST(len(ot.toks) AS INTEGER) AS n_tokens,
                   CASE WHEN len(ot.toks) < {C.OCR_MIN_TOKENS} THEN CAST(0 AS BIGINT) ELSE coalesce(om.n_nonword, 0) END
                     AS n_nonword,
                   CASE WHEN len(ot.toks) < {C.OCR_MIN_TOKENS} THEN CAST(0.0 AS DOUBLE)
                        ELSE CAST(coalesce(om.n_nonword, 0) AS DOUBLE) / len(ot.toks) END AS nonword_ratio
            FROM ot LEFT JOIN om ON ot.source = om.source AND ot.shard = om.shard AND ot.pos = om.pos)"""

SQL["dictionary_build"] = "WITH " + Q.DICT.strip() + "\nSELECT word FROM dict"
SQL["ocr_gate"] = _PRE_OCR + f"""
SELECT source, shard, pos, n_tokens, n_nonword, nonword_ratio, nonword_ratio > CAST({C.NONWORD_RATIO_MAX} AS DOUBLE) AS ocr
FROM ocr_all"""
_SWEEP_SRC = _PRE_OCR.replace(
    "cand AS (SELECT source, shard, pos, text FROM cleaned WHERE kept AND",
    "cand AS (SELECT source, shard, pos, text FROM cleaned WHERE kept AND pos IN (SELECT pos FROM first_n) AND")
SQL["ocr_threshold_sweep"] = _SWEEP_SRC.replace(
    "WITH raw AS (SELECT", "WITH raw AS (SELECT", 1).replace(
    "s2 AS (SELECT", "first_n AS (SELECT pos FROM (SELECT pos, row_number() OVER (PARTITION BY source ORDER BY shard, pos) AS rn "
    f"FROM raw WHERE {Q.policy_case('strict_ocr')}) WHERE rn <= {C.OCR_SAMPLE_N}),\ns2 AS (SELECT", 1) + """,
sc AS (SELECT nonword_ratio FROM ocr_all WHERE n_tokens >= """ + str(C.OCR_MIN_TOKENS) + """),
th(threshold) AS (VALUES """ + ", ".join(f"(CAST({t} AS DOUBLE))" for t in C.OCR_SWEEP_THRESHOLDS) + """)
SELECT threshold, (SELECT count(*) FROM sc) AS scored,
       CAST((SELECT count(*) FROM sc WHERE nonword_ratio > threshold) AS BIGINT) AS dropped,
       CAST((SELECT count(*) FROM sc WHERE nonword_ratio > threshold) AS DOUBLE) / (SELECT count(*) FROM sc) AS share
FROM th"""


SQL["language_detect"] = f"""
        {'WITH ' + Q.RAW}, {Q.STEP2}, {Q.LANG},
        lt AS (SELECT lang, ' ' || trim(regexp_replace(lower(coalesce(text, '')),
                                                       '[^\\p{{L}}]+', ' ', 'g')) || ' ' AS t FROM documents),
        lg AS (SELECT lang, unnest(list_transform(range(1, length(t) - 1), lambda i: substring(t, i, 3))) AS gram
               FROM lt WHERE length(t) >= 3),
        cnt AS (SELECT lang, gram, count(*) AS c FROM lg GROUP BY lang, gram),
        v AS (SELECT count(DISTINCT gram) AS v FROM cnt),
        langs AS (SELECT lang, sum(c) AS n, ln(1.0 / (sum(c) + (SELECT v FROM v))) AS unseen FROM cnt GROUP BY lang),
        prof AS (SELECT cnt.lang, gram, ln((c + 1) / CAST(langs.n + (SELECT v FROM v) AS DOUBLE)) - langs.unseen AS delta
                 FROM cnt JOIN langs ON cnt.lang = langs.lang),
        band AS (SELECT s2.source, s2.pos, ' ' || trim(regexp_replace(lower(substring(s2.s2, 1, {C.LANG_SAMPLE_CHARS})),
                                                       '[^\\p{{L}}]+', ' ', 'g')) || ' ' AS t
                 FROM s2 JOIN lang ON s2.pos = lang.pos
                 WHERE length(s2.s2) >= {C.MIN_DOC_CHARS} AND lang.ar >= CAST(0.90 AS DOUBLE) AND lang.ar < CAST(0.99 AS DOUBLE)),
        bg AS (SELECT source, pos, unnest(list_transform(range(1, length(t) - 1), lambda i: substring(t, i, 3))) AS gram
               FROM band WHERE length(t) >= 3),
        bn AS (SELECT source, pos, CASE WHEN length(t) >= 3 THEN length(t) - 2 ELSE 0 END AS n FROM band),
        ss AS (SELECT source, pos, lang, sum(delta) AS s FROM bg JOIN prof ON bg.gram = prof.gram GROUP BY ALL),
        sc AS (SELECT bn.source, bn.pos, langs.lang, bn.n * langs.unseen + coalesce(ss.s, 0.0) AS score
               FROM bn CROSS JOIN langs LEFT JOIN ss ON ss.source = bn.source AND ss.pos = bn.pos AND ss.lang = langs.lang),
        best AS (SELECT source, pos, lang, row_number() OVER (PARTITION BY source, pos ORDER BY score DESC, lang) AS r FROM sc)
        SELECT source, pos, lang, lang = 'en' AS is_english FROM best WHERE r = 1"""
