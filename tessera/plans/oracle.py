"""DuckDB SQL for the correctness oracle.

An independent, relational formulation of each query (explode + GROUP BY
where the Spark side works in-row), written for DuckDB's RE2 regex dialect:
RE2's ``\\s`` is ASCII only, so Python's white space is spelled out.
"""

from __future__ import annotations

from tessera import config as C

P1 = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
WS = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
D = "CAST({} AS DOUBLE)"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def re2_boilerplate() -> str:
    alts = []
    for p in C.BOILERPLATE_PATTERNS:
        p = p.replace(r"[-\s]", "\0").replace(r"\s", f"[{WS}]").replace("\0", f"[-{WS}]")
        alts.append(f"(?:{p})")
    return "(?i)" + "|".join(alts)


BP = re2_boilerplate()
NL = "chr(10)"


def norm_line(x: str) -> str:
    return f"trim(regexp_replace({x}, {lit('[' + WS + ']+')}, ' ', 'g'))"


def nonalnum(x: str) -> str:
    return (f"(CASE WHEN length({x}) = 0 THEN CAST(1.0 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) - "
            f"CAST(length(regexp_replace({x}, '[^A-Za-z0-9]', '', 'g')) AS DOUBLE) / length({x}) END)")


def line_keep(x: str) -> str:
    return f"(length({x}) >= {C.MIN_LINE_CHARS} AND {nonalnum(x)} <= CAST({C.MAX_NONALNUM_RATIO} AS DOUBLE))"


def filtered_lines(text: str) -> str:
    return (f"list_filter(list_transform(string_split_regex({text}, {lit(P1)}), lambda x: {norm_line('x')}), "
            f"lambda x: {line_keep('x')})")


def not_boiler(x: str) -> str:
    return f"NOT regexp_matches({x}, {lit(BP)})"


def ascii_ratio(x: str) -> str:
    return (f"(CASE WHEN length({x}) = 0 THEN CAST(0.0 AS DOUBLE) ELSE "
            f"CAST(length(regexp_replace({x}, '[^\\x00-\\x7f]', '', 'g')) AS DOUBLE) / length({x}) END)")


def english(ar: str) -> str:
    return (f"(CASE WHEN {ar} >= CAST(0.99 AS DOUBLE) THEN true WHEN {ar} < CAST(0.90 AS DOUBLE) THEN false "
            f"ELSE {ar} > CAST(0.95 AS DOUBLE) END)")


def src_idx(col: str = "source") -> str:
    return f"CAST(substr({col}, 4) AS INTEGER)"


def policy_case(field: str, col: str = "source") -> str:
    """Fixture registry rule as SQL (same classes as ``config.FIXTURE_CLASSES``)."""
    pos = {"budget": 2, "strict_ocr": 3, "near_dup": 4, "decontaminate": 5, "split": 6, "config": 7,
           "token_shards": 8}[field]
    parts = []
    for cls in C.FIXTURE_CLASSES:
        v = cls[pos]
        if isinstance(v, bool):
            sv = "true" if v else "false"
        elif v is None:
            sv = "'default'"
        elif isinstance(v, str):
            sv = lit(v)
        else:
            sv = str(v)
        parts.append(f"WHEN {src_idx(col)} BETWEEN {cls[0]} AND {cls[1]} THEN {sv}")
    return "(CASE " + " ".join(parts) + " END)"


RAW = (f"raw AS (SELECT source, CAST((doc_id // {C.FIXTURE_N_SOURCES}) % {C.FIXTURE_SHARDS} AS INTEGER) AS shard, doc_id AS pos, "
       f"coalesce(CAST(text AS VARCHAR), '') AS text FROM documents)")

STEP2 = (f"s2 AS (SELECT source, shard, pos, CAST(length(text) AS BIGINT) AS raw_chars, "
         f"array_to_string(list_filter({filtered_lines('text')}, lambda x: {not_boiler('x')}), {NL}) AS s2 "
         f"FROM raw)")

REP = f"""
w AS (SELECT pos, string_split_regex(s2, '[ \\n]+') AS words FROM s2 WHERE length(s2) > 0),
g AS (SELECT pos, len(words) AS nw,
             unnest(list_transform(range(1, len(words) - {C.REPETITION_NGRAM - 2}),
                    lambda i: array_to_string(words[i:i + {C.REPETITION_NGRAM - 1}], ' '))) AS gram
      FROM w WHERE len(words) >= {2 * C.REPETITION_NGRAM}),
gc AS (SELECT pos, nw, gram, count(*) AS c FROM g GROUP BY pos, nw, gram),
gr AS (SELECT pos, nw, c, row_number() OVER (PARTITION BY pos ORDER BY c DESC) AS r FROM gc),
rep AS (SELECT pos, max(nw) AS n_words, max(nw) - {C.REPETITION_NGRAM - 1} AS n_grams,
               CAST(sum(c) FILTER (WHERE r <= {C.REPETITION_TOP_K}) AS BIGINT) AS top_count,
               CAST(sum(c) FILTER (WHERE r <= {C.REPETITION_TOP_K}) AS DOUBLE)
                 / (max(nw) - {C.REPETITION_NGRAM - 1}) AS rep_ratio
        FROM gr GROUP BY pos)"""

LANG = (f"lang AS (SELECT pos, {ascii_ratio('smp')} AS ar FROM "
        f"(SELECT pos, substring(s2, 1, {C.LANG_SAMPLE_CHARS}) AS smp FROM s2))")

DICT = """
dict AS (SELECT word FROM (
           SELECT DISTINCT doc_id, unnest(list_transform(regexp_extract_all(coalesce(text, ''), '[A-Za-z]{3,}'),
                                                     lambda t: lower(t))) AS word
           FROM documents
           WHERE lang = 'en' AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))
         GROUP BY word HAVING count(*) >= 2)"""

PRE = f"""
pre AS (SELECT s2.*, rep.rep_ratio, lang.ar,
               CASE WHEN length(s2.s2) < {C.MIN_DOC_CHARS} THEN 'too_short'
                    WHEN coalesce(rep.rep_ratio > CAST({C.MAX_REPETITION_RATIO} AS DOUBLE), false) THEN 'repetitive'
                    WHEN NOT {english('lang.ar')} THEN 'non_english'
                    ELSE 'kept' END AS pre
        FROM s2 LEFT JOIN rep ON s2.pos = rep.pos LEFT JOIN lang ON s2.pos = lang.pos)"""


def ocr_cte(cand_where: str = "pre = 'kept' AND {strict}") -> str:
    where = cand_where.format(strict=policy_case("strict_ocr"))
    return f"""
ot AS (SELECT pos, list_transform(regexp_extract_all(s2, '[A-Za-z]{{3,}}'), lambda t: lower(t)) AS toks
       FROM pre WHERE {where}),
ox AS (SELECT pos, len(toks) AS nt, unnest(toks) AS word FROM ot WHERE len(toks) >= {C.OCR_MIN_TOKENS}),
ocr AS (SELECT ox.pos, CASE WHEN (SELECT count(*) FROM dict) = 0 THEN CAST(0.0 AS DOUBLE)
                            ELSE CAST(count(*) FILTER (WHERE dict.word IS NULL) AS DOUBLE) / max(ox.nt) END AS ocr_ratio
        FROM ox LEFT JOIN dict ON ox.word = dict.word GROUP BY ox.pos)"""


CLEAN_FINAL = f"""
clean AS (SELECT pre.source, pre.shard, pre.pos, pre.raw_chars, CAST(length(pre.s2) AS BIGINT) AS clean_chars,
                 CASE WHEN pre.pre = 'kept' AND {policy_case('strict_ocr', 'pre.source')}
                           AND coalesce(ocr.ocr_ratio, 0.0) > CAST({C.NONWORD_RATIO_MAX} AS DOUBLE) THEN 'ocr'
                      ELSE pre.pre END AS reason,
                 pre.s2
          FROM pre LEFT JOIN ocr ON pre.pos = ocr.pos),
cleaned AS (SELECT source, shard, pos, reason = 'kept' AS kept, reason, raw_chars, clean_chars,
                   CASE WHEN reason = 'kept' THEN s2 ELSE '' END AS text FROM clean)"""


def clean_ctes(strict: bool = True, src: str = "raw", with_raw: bool = True, with_kw: bool = True) -> str:
    """WITH-list ending in ``cleaned(source, shard, pos, kept, reason, raw_chars, clean_chars, text)``.

    ``src`` names the relation of raw records (source, shard, pos, text).
    """
    parts = ([RAW] if with_raw else []) + [STEP2.replace("FROM raw)", f"FROM {src})"), REP.strip(), LANG, PRE.strip()]
    if strict:
        parts += [DICT.strip(), ocr_cte().strip(), CLEAN_FINAL.strip()]
    else:
        parts.append("""cleaned AS (SELECT source, shard, pos, pre = 'kept' AS kept, pre AS reason, raw_chars,
                          CAST(length(s2) AS BIGINT) AS clean_chars,
                          CASE WHEN pre = 'kept' THEN s2 ELSE '' END AS text FROM pre)""")
    return ("WITH " if with_kw else "") + ",\n".join(parts)


def caps_cte(web_shards: int | None = None) -> str:
    """``caps(source, shard, per_shard_cap)`` from the fixture manifest (all shards)."""
    return f"""
man AS (SELECT DISTINCT source, shard FROM raw),
caps AS (SELECT source, shard,
                CAST(floor({policy_case('budget')} / count(*) OVER (PARTITION BY source)) AS BIGINT) AS per_shard_cap
         FROM man)"""


CAPPED = f"""
runs AS (SELECT c.*, caps.per_shard_cap,
                coalesce(sum(CASE WHEN kept THEN clean_chars ELSE 0 END) OVER (
                    PARTITION BY c.source, c.shard ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                  AS before_chars,
                coalesce(max(CASE WHEN kept THEN 1 ELSE 0 END) OVER (
                    PARTITION BY c.source, c.shard ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                  AS before_kept
         FROM cleaned c JOIN caps ON c.source = caps.source AND c.shard = caps.shard),
capped AS (SELECT source, shard, pos, kept, reason, raw_chars, clean_chars, text FROM runs
           WHERE NOT (before_kept = 1 AND CAST(before_chars AS DOUBLE) / {C.CHARS_PER_TOKEN} >= per_shard_cap))"""
