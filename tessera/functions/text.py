"""Column builders for the text primitives of the cleaning and dedup chain.

Every builder returns a native Spark ``Column`` (JVM-side, no Python per row).
Java regex differs from Python ``re``; each constant below is spelled so the
two agree on the characters the chain can meet.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import config as C

# Python ``str.splitlines`` separators.
LINE_BREAKS = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"
RARE_BREAKS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
# Python ``\s`` for str patterns = Java Unicode white space plus \x1C-\x1F.
WHITESPACE_RUN = r"(?U)[\s\x1C-\x1F]+"
ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
ASCII = "".join(map(chr, range(128)))
# After ``collapse_ws`` and the "\n" line join, str.split() = split on these.
WORD_SEPARATORS = r"[ \n]+"
OCR_TOKEN = r"[A-Za-z]{3,}"
NO_DEDUP_WORD = r"[^a-z0-9]+"


def java_boilerplate_regex() -> str:
    """One alternation of the fixed boilerplate patterns for Java regex.

    ``(?iU)`` gives Python's Unicode case folding and Unicode ``\\d``/``\\b``;
    Python's ``\\s`` also matches \\x1F, which Java's does not, so it is added.
    """
    alts = []
    for p in C.BOILERPLATE_PATTERNS:
        p = p.replace(r"[-\s]", "\0").replace(r"\s", r"[\s\x1F]").replace("\0", r"[-\s\x1F]")
        alts.append(f"(?:{p})")
    # anchored as a whole: else every place of a line is tried, each time with all the patterns
    return "(?iU)^(?:" + "|".join(alts) + ")"


BOILERPLATE = java_boilerplate_regex()


def filter_after(df: DataFrame, cond: Column) -> DataFrame:
    """Keep rows where ``cond`` holds, evaluated *after* the projections that
    compute its inputs. A plain filter would be pushed (with the expressions
    inlined) below them and below any repartition, evaluating them twice and in
    the scan tasks. Dropping rows through a generator (one element when kept,
    none otherwise) is not a predicate, so it stays where it is written."""
    keep = F.explode(F.when(cond, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")))
    return df.withColumn("_keep", keep).drop("_keep")


def coerce_text(c: Column) -> Column:
    """``record.get(field) or ""`` then ``str(x)``: null becomes the empty string."""
    return F.coalesce(c.cast("string"), F.lit(""))


def split_lines(text: Column) -> Column:
    """``text`` should be a column reference (it is read several times)."""
    rare = reduce(or_, [F.contains(text, F.lit(c)) for c in RARE_BREAKS])
    # a plain split and searches for a character each take half the time of the pattern
    return F.when(rare, F.split(text, LINE_BREAKS, -1)).otherwise(F.split(text, "\n", -1))


def split_lines_exact(text: Column) -> Column:
    """``str.splitlines``: no trailing empty piece after a final line break.

    (Empty text gives [""] here and [] in Python; both join to "".)
    """
    return F.split(F.regexp_replace(text, r"(?:" + LINE_BREAKS + r")\z", ""), LINE_BREAKS, -1)


def collapse_ws(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, WHITESPACE_RUN, " "))


def nonalnum_ratio(line: Column) -> Column:
    n = F.length(line)
    # deleted by ``translate``: a regex match for each other character costs several times the rest of the cleaning
    alnum = n - F.length(F.translate(line, ALNUM, ""))
    return F.when(n == 0, F.lit(1.0)).otherwise(F.lit(1.0) - alnum / n)


def filtered_lines(text: Column, cfg: C.CleanConfig = C.CleanConfig()) -> Column:
    """Array of the lines kept by the line filter (normalised)."""
    lines = F.transform(split_lines(text), collapse_ws)
    return F.filter(lines, lambda ln: (F.length(ln) >= cfg.min_line_chars)
                    & (nonalnum_ratio(ln) <= F.lit(cfg.max_nonalnum_ratio)))


def filter_lines(text: Column, cfg: C.CleanConfig = C.CleanConfig()) -> Column:
    return F.array_join(filtered_lines(text, cfg), "\n")


def is_boilerplate(line: Column) -> Column:
    return line.rlike(BOILERPLATE)


def drop_boilerplate(lines: Column) -> Column:
    return F.filter(lines, lambda ln: ~is_boilerplate(ln))


def strip_boilerplate(text: Column) -> Column:
    """Standalone boilerplate removal on any text (Python ``splitlines`` split)."""
    return F.array_join(drop_boilerplate(split_lines_exact(text)), "\n")


def clean_text(text: Column, cfg: C.CleanConfig = C.CleanConfig()) -> Column:
    """Line filter then boilerplate removal (lines already split by "\\n")."""
    return F.array_join(drop_boilerplate(filtered_lines(text, cfg)), "\n")


def ascii_ratio(s: Column) -> Column:
    n = F.length(s)
    # as in ``nonalnum_ratio``; a text with as many bytes as characters has no other
    ascii_n = n - F.length(F.translate(s, ASCII, ""))
    return F.when(n == 0, F.lit(0.0)).when(F.octet_length(s) == n, F.lit(1.0)).otherwise(ascii_n / n)


def lang_sample(s: Column, cfg: C.CleanConfig = C.CleanConfig()) -> Column:
    return F.substring(s, 1, cfg.lang_sample_chars)


def english_by_ratio(ratio: Column) -> Column:
    """Language ladder with the fallback rule for the 0.90-0.99 band."""
    return (F.when(ratio >= F.lit(0.99), F.lit(True))
            .when(ratio < F.lit(0.90), F.lit(False))
            .otherwise(ratio > F.lit(0.95)))


def is_english(s: Column, cfg: C.CleanConfig = C.CleanConfig()) -> Column:
    return english_by_ratio(ascii_ratio(lang_sample(s, cfg)))


def whitespace_words(t: Column) -> Column:
    """``str.split()`` of normalised text; empty text gives an empty array."""
    return F.when(F.length(t) == 0, F.array().cast("array<string>")).otherwise(F.split(t, WORD_SEPARATORS, -1))


def word_ngrams_joined(words: Column, n: int) -> Column:
    """All n-grams (with multiplicity) as space-joined strings; empty if fewer than n words.

    ``words`` should be a column reference (it is read several times).
    """
    cnt = F.size(words) - (n - 1)
    return F.when(cnt <= 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(0), cnt - 1), lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(n)])))


def run_starts(sorted_items: Column) -> Column:
    """1-based positions where a new value starts in a sorted array (column reference)."""
    s = sorted_items
    prev = F.concat(F.array(F.lit(None).cast("string")), F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0))))
    return F.filter(F.transform(F.zip_with(s, prev, lambda a, b: ~a.eqNullSafe(b)),
                                lambda f, i: F.when(f, i + 1).otherwise(F.lit(0))),
                    lambda x: x > 0)


def top_runs_sum(starts: Column, n: Column, k: int) -> Column:
    """Sum of the k longest runs, given run starts (column reference) and the array size."""
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), F.array(n + 1))
    runs = F.zip_with(ends, starts, lambda e, b: e - b)
    top = F.slice(F.sort_array(runs, asc=False), 1, k)
    return F.when(n == 0, F.lit(0)).otherwise(F.aggregate(top, F.lit(0), lambda acc, x: acc + x))


def with_repetition(df: DataFrame, text_col: str, cfg: C.CleanConfig = C.CleanConfig(),
                    when: Column | None = None, prefix: str = "_rep") -> DataFrame:
    """Add ``{prefix}_words``, ``{prefix}_grams``, ``{prefix}_top`` and ``{prefix}_ratio``.

    Top-k multiplicity sum of word n-grams in-row: sort, mark run starts, run
    lengths, k largest; no explode, no shuffle. Each intermediate is its own
    projection so it is computed once per row. ``ratio`` is NULL when the text
    has fewer than 2n words (never repetitive) or ``when`` is false.
    """
    w, g, s, st, top = (f"{prefix}_{x}" for x in ("words", "grams", "sorted", "starts", "top"))
    words = whitespace_words(F.col(text_col))
    if when is not None:
        words = F.when(when, words)
    out = df.withColumn(w, words)
    out = out.withColumn(g, word_ngrams_joined(F.col(w), cfg.ngram_n))
    out = out.withColumn(s, F.sort_array(F.col(g)))
    out = out.withColumn(st, run_starts(F.col(s)))
    out = out.withColumn(top, top_runs_sum(F.col(st), F.size(F.col(s)), cfg.repetition_top_k))
    n_grams = F.size(F.col(g))
    ratio = F.when((F.size(F.col(w)) < 2 * cfg.ngram_n) | (n_grams <= 0), F.lit(None).cast("double")) \
        .otherwise(F.col(top) / n_grams)
    return out.withColumn(f"{prefix}_ratio", ratio).drop(s, st)


def ocr_tokens(t: Column) -> Column:
    return F.transform(F.regexp_extract_all(t, F.lit(OCR_TOKEN), 0), F.lower)


def normalize(t: Column) -> Column:
    """lower, collapse Unicode white space, strip (dedup normal form)."""
    return collapse_ws(F.lower(t))


def dedup_words(t: Column) -> Column:
    """``[a-z0-9]+`` words of the normal form (its white space parts words like any other character)."""
    return F.array_remove(F.split(F.regexp_replace(F.lower(t), NO_DEDUP_WORD, " "), " "), "")


def exact_hash(t: Column) -> Column:
    """Content hash of the normal form; only equality is observable."""
    return F.md5(F.encode(normalize(t), "UTF-8"))


def flatten_newlines(t: Column) -> Column:
    """Clean-shard line form: newline to space, strip."""
    return F.trim(F.regexp_replace(t, "\n", " "))


def approx_tokens(chars: Column) -> Column:
    return F.floor(chars / F.lit(C.CHARS_PER_TOKEN)).cast("bigint")
