"""URL filters: explicit host/path rules, then gradient-boosted trees on lexical features.

Features of a url: lengths of its parts, path depth, digit ratio, byte entropy, parameter and
subdomain counts, punctuation ratios, and suffix statistics: the smoothed log-odds of the label
under the host's last one and last two labels. The trees (histogram splits, logistic loss) are
trained with numpy on at most ``max_rows`` labelled urls, those with the smallest url hash; only
their numbers reach the driver. Scoring is one narrow pass; the model is a few kilobytes plus the
suffixes of the bounded sample.

Cases: a null url, or one without ``://``, has empty host and path, fits no rule and is judged on
the features of its text (all zero for null); without labelled urls of both classes every url gets
the majority label (allow if there is none); repeated urls get equal verdicts; an empty table gives
an empty result; other columns pass through ``judge``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: (verdict, host, path): a rule fits its host and all subdomains where the path starts with its path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


@dataclass(frozen=True)
class UrlConfig:
    max_rows: int = 20000
    trees: int = 40
    depth: int = 3
    bins: int = 32
    rate: float = 0.2
    ridge: float = 1.0
    smooth: float = 20.0        # pseudo-count of a suffix statistic
    folds: int = 5              # training rows see suffix statistics of the other folds


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url):
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)).otherwise("")


def path_of(url):
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_of(host, path, rules=RULES):
    """(rule, verdict) of the longest rule that fits, as a struct; null if none does."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    # the shortest rule is tested last
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        best = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


# --- features ---------------------------------------------------------------------------------------------------

N_LEXICAL = 13


def lexical(url: str | None) -> list[float]:
    """Numbers that depend on the characters of the url alone."""
    u = url or ""
    raw = u.encode("utf-8", "surrogatepass")
    scheme, _, rest = u.partition("://") if "://" in u else ("", "", u)
    body, _, query = rest.partition("#")[0].partition("?")
    host, slash, path = body.partition("/")
    n = max(1, len(raw))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256, np.int64)
    some = counts[counts > 0] / n
    return [len(raw), len(host), len(slash + path), path.count("/") + bool(slash), counts[48:58].sum() / n,
            float(-(some * np.log2(some)).sum()) if raw else 0.0, query.count("&") + bool(query), host.count("."),
            counts[45] / n, counts[37] + counts[64], float("#" in u), float(scheme.lower() == "https"),
            (counts[33:48].sum() + counts[58:65].sum()) / n]


def suffixes(url: str | None) -> tuple[str, str]:
    u = url or ""
    host = u.partition("://")[2] if "://" in u else ""
    for mark in "/?#":
        host = host.partition(mark)[0]
    labels = host.lower().rpartition("@")[2].split(":")[0].split(".")
    return labels[-1], ".".join(labels[-2:])


def _features(urls: list[str | None]):
    return np.array([lexical(u) for u in urls], np.float64).reshape(len(urls), N_LEXICAL), [suffixes(u) for u in urls]


# --- trees ------------------------------------------------------------------------------------------------------

class Trees:
    """Gradient-boosted regression trees on binned features; complete trees in arrays."""

    def __init__(self, cfg: UrlConfig):
        self.cfg, self.start, self.edges, self.trees = cfg, 0.0, [], []

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1) \
            if len(self.edges) else np.zeros((len(x), 0), np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        cfg = self.cfg
        p = (y.sum() + 1) / (len(y) + 2)
        self.start = float(np.log(p / (1 - p)))
        if not len(y) or y.min() == y.max():
            return self
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, cfg.bins)[1:-1])) for j in range(x.shape[1])]
        bins, score = self.binned(x), np.full(len(y), self.start)
        for _ in range(cfg.trees):
            prob = 1 / (1 + np.exp(-score))
            grad, hess = y - prob, prob * (1 - prob)
            feature = np.full((1 << cfg.depth) - 1, -1)
            split = np.zeros(len(feature), np.int64)
            node = np.zeros(len(y), np.int64)
            for level in range(cfg.depth):
                for k in range((1 << level) - 1, (1 << (level + 1)) - 1):
                    rows = np.flatnonzero(node == k)
                    feature[k], split[k] = self._split(bins[rows], grad[rows], hess[rows])
                right = np.where(feature[node] >= 0, bins[np.arange(len(y)), feature[node]] > split[node], False)
                node = 2 * node + 1 + right
            leaf = node - ((1 << cfg.depth) - 1)
            size = 1 << cfg.depth
            value = cfg.rate * np.bincount(leaf, grad, size) / (np.bincount(leaf, hess, size) + cfg.ridge)
            self.trees.append((feature, split, value))
            score += value[leaf]
        return self

    def _split(self, bins, grad, hess):
        best = (1e-6, -1, 0)
        ridge, g, h = self.cfg.ridge, grad.sum(), hess.sum()
        for j in range(bins.shape[1]):
            n = len(self.edges[j]) + 1
            gl = np.cumsum(np.bincount(bins[:, j], grad, n))[:-1]
            hl = np.cumsum(np.bincount(bins[:, j], hess, n))[:-1]
            if not len(gl):
                continue
            gain = gl ** 2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g ** 2 / (h + ridge)
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (float(gain[at]), j, at)
        return best[1], best[2]

    def predict(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.start)
        if self.trees:
            bins, every = self.binned(x), np.arange(len(x))
            for feature, split, value in self.trees:
                node = np.zeros(len(x), np.int64)
                for _ in range(self.cfg.depth):
                    f = feature[node]
                    node = 2 * node + 1 + np.where(f >= 0, bins[every, f] > split[node], False)
                score += value[node - ((1 << self.cfg.depth) - 1)]
        return 1 / (1 + np.exp(-score))


@dataclass
class UrlModel:
    trees: Trees
    stats: dict[str, tuple[int, int]]       # suffix -> (urls, blocked urls) of the training sample
    base: float
    smooth: float

    def suffix_columns(self, pairs, less: list[dict] | None = None) -> np.ndarray:
        """Smoothed log-odds of both suffixes; ``less`` holds, per row, counts to leave out (its training fold's)."""
        out = np.zeros((len(pairs), 2))
        for i, pair in enumerate(pairs):
            for j, s in enumerate(pair):
                n, bad = self.stats.get(s, (0, 0))
                if less is not None:
                    m, worse = less[i].get(s, (0, 0))
                    n, bad = n - m, bad - worse
                p = (bad + self.smooth * self.base) / (n + self.smooth)
                out[i, j] = np.log(p / (1 - p))
        return out

    def blocked(self, urls: list[str | None]) -> np.ndarray:
        x, pairs = _features(urls)
        return self.trees.predict(np.concatenate([x, self.suffix_columns(pairs)], axis=1))


def fit(labelled: DataFrame, cfg: UrlConfig = UrlConfig()) -> UrlModel:
    """Model from (url, blocked) rows, blocked 0 or 1; at most ``max_rows`` distinct urls are used."""
    sample = (labelled.where(F.col("url").isNotNull() & F.col("blocked").isin(0, 1))
              .groupBy("url").agg(F.max("blocked").cast("int").alias("blocked"))
              .orderBy(F.xxhash64("url"), "url").limit(cfg.max_rows))

    def features(batches):
        for batch in batches:
            x, pairs = _features(batch.column(0).to_pylist())
            yield pa.record_batch([pa.array(list(x), pa.list_(pa.float64())), pa.array([p[0] for p in pairs]),
                                   pa.array([p[1] for p in pairs]), batch.column(1), batch.column(2)],
                                  names=["x", "last", "two", "blocked", "fold"])

    fold = F.pmod(F.xxhash64("url", F.lit("fold")), F.lit(cfg.folds)).cast("int").alias("fold")
    rows = sample.select("url", "blocked", fold).mapInArrow(
        features, "x array<double>, last string, two string, blocked int, fold int").collect()
    y = np.array([r["blocked"] for r in rows], np.float64)
    stats: dict[str, tuple[int, int]] = {}
    by_fold: list[dict] = [{} for _ in range(cfg.folds)]
    for r in rows:
        for s in {r["last"], r["two"]}:
            for table in (stats, by_fold[r["fold"]]):
                n, bad = table.get(s, (0, 0))
                table[s] = (n + 1, bad + r["blocked"])
    base = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.25
    model = UrlModel(Trees(cfg), stats, float(base), cfg.smooth)
    if len(y):
        x = np.array([r["x"] for r in rows])
        # a row sees the statistics of the other folds: its own label would otherwise show in them
        suffix = model.suffix_columns([(r["last"], r["two"]) for r in rows], [by_fold[r["fold"]] for r in rows])
        order = np.lexsort([*x.T, *suffix.T, y])           # the order rows arrive in does not matter
        model.trees.fit(np.concatenate([x, suffix], axis=1)[order], y[order])
    else:
        model.trees.start = -1.0
    return model


def judge(pages: DataFrame, model: UrlModel | None = None, rules=RULES, cfg: UrlConfig = UrlConfig(), url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict and the model's ``blocked_score`` (columns of these names are replaced).

    Without a model, one is trained on the urls that the rules judge.
    """
    made = ["host", "path", "rule", "verdict", "blocked_score"]
    base = pages.drop(*[c for c in made if c != url])
    host, path = F.coalesce(host_of(F.col(url)), F.lit("")), F.coalesce(path_of(F.col(url)), F.lit(""))
    ruled = (base.withColumn("host", host).withColumn("path", path)
             .withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)))
    if model is None:
        model = fit(ruled.where("_rule IS NOT NULL").select(
            F.col(url).alias("url"), (F.col("_rule.verdict") == "block").cast("int").alias("blocked")), cfg)
    shared = pages.sparkSession.sparkContext.broadcast(model)
    ruled = ruled.withColumn("rule", F.col("_rule.rule")).withColumn("verdict", F.col("_rule.verdict")).drop("_rule")

    def score(batches):
        for batch in batches:
            p = shared.value.blocked(batch.column(batch.schema.get_field_index(url)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())],
                                             names=[*batch.schema.names, "blocked_score"])

    scored = ruled.mapInArrow(score, T.StructType([*ruled.schema.fields, T.StructField("blocked_score", T.DoubleType())]))
    by_model = F.when(F.col("blocked_score") >= 0.5, "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce("verdict", by_model))
