"""License scans (DataFrame functions only).

Every line of a document, and the document as a whole, is a unit; unit and template are normalised
(letters and digits, A-Z lower-cased, single blanks) and compared by the Dice coefficient of their
sets of word bigrams. ``dice >= t`` needs ``|A|`` within ``|B| t / (2 - t)`` and ``|B| (2 - t) / t``, so
a unit meets only the templates whose size allows a match.

A template that no unit matches is looked for in runs of consecutive lines (a notice wrapped over
lines of a longer text; blank lines count for nothing), each template's best run as one match. A run
holds at least ``|B| t / (2 - t)`` of the template's bigrams, so only texts that hold as many are
searched; a best run begins with a line that holds one, and its word count lies within the size bounds.
All of it happens inside the row: no shuffle, and the templates are constants of the plan.

Cases: null or empty text, and units of fewer than two words, match nothing (license NULL); several
matches give the highest coefficient, then the earliest unit (the whole text, line 0, first; a run has its
first line's number), then the first template; repeated rows are scanned each; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.")
_ISC_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE.")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.")
_MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.")
_BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
              "products derived from this software without specific prior written permission.")
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")

#: Public licence notices, file headers and licence texts (the long Apache, GPL and MPL texts by their headers only).
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", _ISC),
    ("ISC", f"{_ISC} {_ISC_WARRANTY}"),
    ("MIT", f"{_MIT} {_MIT_WARRANTY}"),
    ("BSD-2-Clause", f"{_BSD} {_BSD_WARRANTY}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_NAMES} {_BSD_WARRANTY}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
                   "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
                   "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
                   "for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
                "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
                "License for more details. You should have received a copy of the GNU General Public License along with this "
                "program. If not, see <https://www.gnu.org/licenses/>."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MIT", _MIT),
)


@dataclass(frozen=True)
class LicenseConfig:
    threshold: float = 0.8
    templates: tuple[tuple[str, str], ...] = TEMPLATES


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.translate(str.maketrans(_UPPER, _LOWER))).split()


def template_grams(text: str) -> list[str]:
    """Distinct word bigrams of a template, in order."""
    words = template_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def words_of(text):
    """Normalised words; an empty text gives one empty word."""
    return F.split(F.trim(F.regexp_replace(F.translate(text, _UPPER, _LOWER), "[^\\p{L}\\p{N}]+", " ")), " ")


def grams_of(words):
    n = F.size(words) - 1
    return F.array_distinct(F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b)))


def bounds(cfg: LicenseConfig) -> list[tuple[int, str, list[str], int, int]]:
    """(index, license, bigrams, least and most bigrams of a unit that can match)."""
    out = []
    for i, (name, text) in enumerate(cfg.templates):
        grams = template_grams(text)
        n = len(grams)
        # as integers, by the test itself: no rounding of n t / (2 - t) can lose a size
        sizes = [m for m in range(1, int(n * 2 / cfg.threshold) + 2) if 2.0 * min(m, n) / (m + n) >= cfg.threshold]
        out.append((i, name, grams, sizes[0], sizes[-1]))
    return out


def runs(rows: DataFrame, known: list, cfg: LicenseConfig) -> DataFrame:
    """``rows`` (_words of each line, _whole: bigrams of the text, _hits) with _runs: the best matching run of lines of
    each template without a hit, as (dice, -first line, -template)."""
    spans = [len(template_words(text)) for _, text in cfg.templates]
    templates = F.array(*[F.struct(
        F.lit(-i).alias("t"), F.array(*[F.lit(g) for g in grams]).alias("g"), F.lit(lo).alias("lo"),
        # words of the longest run: a bigram may repeat as often as in the template
        F.lit(-(-hi * n // len(grams)) + 1).alias("most")) for (i, _, grams, lo, hi), n in zip(known, spans)])
    every = F.array(*[F.lit(g) for g in dict.fromkeys(g for _, _, grams, _, _ in known for g in grams)])
    fewest = min(lo for *_, lo, _ in known)
    none = F.array().cast("array<struct<dice:double,k:int,t:int>>")
    rows = rows.withColumn("_seen", F.array_intersect("_whole", every))
    rows = rows.withColumn("_open", F.when(F.size("_seen") >= fewest, F.filter(templates, lambda t: (
        (F.size(F.array_intersect(F.col("_seen"), t["g"])) >= t["lo"]) & ~F.exists("_hits", lambda h: h["t"] == t["t"])))))
    rows = rows.withColumn("_text", F.when(F.size("_open") > 0, F.filter("_words", lambda u: u["w"] != F.array(F.lit("")))))

    def best(t):
        starts = F.filter(F.sequence(F.lit(0), F.size("_text") - 2), lambda s: F.arrays_overlap(grams_of(
            F.concat(F.col("_text")[s]["w"], F.slice(F.col("_text")[s + 1]["w"], 1, 1))), t["g"]))

        def of(s):
            # words up to each line, as far as a run can reach
            ends = F.aggregate(
                F.slice("_text", s + 1, t["most"]), F.struct(F.array().cast("array<int>").alias("c"), F.lit(0).alias("n")),
                lambda a, u: F.when(a["n"] > t["most"], a).otherwise(F.struct(
                    F.concat(a["c"], F.array(a["n"] + F.size(u["w"]))).alias("c"), (a["n"] + F.size(u["w"])).alias("n"))),
                lambda a: a["c"])
            sized = F.filter(F.transform(ends, lambda n, m: F.struct((m + 1).alias("m"), n.alias("n"))),
                             lambda e: (e["m"] > 1) & (e["n"] > t["lo"]) & (e["n"] <= t["most"]))
            words = F.transform(sized, lambda e: F.flatten(F.transform(F.slice("_text", s + 1, e["m"]), lambda u: u["w"])))
            return F.transform(F.transform(words, grams_of), lambda g: F.struct(
                (F.lit(2.0) * F.size(F.array_intersect(g, t["g"])) / (F.size(g) + F.size(t["g"]))).alias("dice"),
                (-F.col("_text")[s]["k"]).alias("k"), t["t"].alias("t")))

        return F.array_max(F.flatten(F.transform(starts, of)))

    found = F.filter(F.transform("_open", best), lambda h: h.isNotNull() & (h["dice"] >= cfg.threshold))
    return rows.withColumn("_runs", F.when(F.size("_text") > 1, found).otherwise(none)).drop("_seen", "_open", "_text")


def scan(documents: DataFrame, cfg: LicenseConfig = LicenseConfig(), text: str = "text") -> DataFrame:
    """``documents`` with license, dice, line (0: the whole text) and matches; columns of these names are replaced."""
    known = bounds(cfg)
    least = min(lo for *_, lo, _ in known)
    most = max(hi for *_, hi in known)
    base = documents.drop(*[c for c in ("license", "dice", "line", "matches") if c != text])
    lines = F.split(F.col(text), "\n", -1)
    several = F.size(lines) > 1
    words = F.transform(lines, lambda u, k: F.struct((k + 1).alias("k"), words_of(u).alias("w")))
    # a unit's bigrams are at most its words less one
    units = F.transform(F.filter("_words", lambda u: F.size(u["w"]) - 1 >= least),
                        lambda u: F.struct(u["k"].alias("k"), grams_of(u["w"]).alias("g")))
    whole = F.when(several, F.array(F.struct(F.lit(0).alias("k"), F.col("_whole").alias("g"))))
    sets = F.filter(F.when(several, F.concat(whole, units)).otherwise(units),
                    lambda u: (F.size(u["g"]) >= least) & (F.size(u["g"]) <= most))

    def against(u, i, grams, lo, hi):
        shared = F.size(F.array_intersect(u["g"], F.array(*[F.lit(g) for g in grams])))
        dice = F.when((F.size(u["g"]) >= lo) & (F.size(u["g"]) <= hi), 2.0 * shared / (F.size(u["g"]) + len(grams)))
        return F.struct(F.coalesce(dice, F.lit(0.0)).alias("dice"), (-u["k"]).alias("k"), F.lit(-i).alias("t"))

    hits = F.filter(F.flatten(F.transform("_sets", lambda u: F.array(*[against(u, i, g, lo, hi) for i, _, g, lo, hi in known]))),
                    lambda h: h["dice"] >= cfg.threshold)
    names = F.array(*[F.lit(name) for _, name, *_ in known])
    # the sets are used once per template: a projection of its own computes them once
    rows = (base.withColumn("_words", words).withColumn("_whole", F.when(several, grams_of(words_of(F.col(text)))))
            .withColumn("_sets", sets).withColumn("_hits", hits))
    rows = runs(rows, known, cfg).withColumn("_hits", F.concat("_hits", "_runs")).withColumn("_best", F.array_max("_hits"))
    hit = F.col("_best").isNotNull()
    return (rows.withColumn("license", F.when(hit, F.element_at(names, 1 - F.col("_best.t"))))
            .withColumn("dice", F.when(hit, F.col("_best.dice"))).withColumn("line", F.when(hit, -F.col("_best.k")))
            .withColumn("matches", F.when(hit, F.size("_hits")).otherwise(0)).drop("_words", "_whole", "_sets", "_hits", "_runs", "_best"))


def sql(cfg: LicenseConfig = LicenseConfig()) -> str:
    """DuckDB form: units by unnest, bigrams and counts by grouping."""
    values = ",\n  ".join(f"({i}, '{name}', {len(g)}, ['" + "','".join(g) + "'])" for i, name, g, _, _ in bounds(cfg))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
units AS (SELECT r, 0 AS k, text AS u FROM d WHERE len(string_split(text, chr(10))) > 1
  UNION ALL SELECT r, unnest(range(1, len(string_split(text, chr(10))) + 1)), unnest(string_split(text, chr(10))) FROM d),
words AS (SELECT r, k, string_split(trim(regexp_replace(translate(u, '{_UPPER}', '{_LOWER}'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w FROM units),
grams AS (SELECT DISTINCT r, k, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM words),
t(i, name, n, gs) AS (VALUES {values}),
tg AS (SELECT i, name, n, unnest(gs) AS g FROM t),
sizes AS (SELECT r, k, count(*) AS n FROM grams GROUP BY r, k),
shared AS (SELECT r, k, i, name, tg.n AS tn, count(*) AS both_n FROM grams JOIN tg USING (g) GROUP BY ALL),
hits AS (SELECT r, k, i, name, 2.0::DOUBLE * both_n / (sizes.n + tn) AS dice FROM shared JOIN sizes USING (r, k)
  WHERE 2.0::DOUBLE * both_n / (sizes.n + tn) >= {cfg.threshold}),
best AS (SELECT r, count(*)::INTEGER AS matches, arg_min(struct_pack(name := name, dice := dice, k := k), (-dice, k, i)) AS b FROM hits GROUP BY r)
SELECT doc_id, b.name AS license, b.dice AS dice, b.k::INTEGER AS line, coalesce(matches, 0) AS matches FROM d LEFT JOIN best USING (r)"""
