"""Quality classification by a sparse ensemble of rules over text statistics.

Shallow boosted trees over a bounded sample of labelled texts propose rules: every path from a root to a
node is a conjunction of thresholds. A logistic regression with an L1 penalty keeps few of them, and these
are compiled into one Spark column expression over the statistics.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.llm.common import fold, pick, release_memory, shielded, table

#: The most labelled rows that the rules are fitted on, those with the least hash of their id.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
TREES, DEPTH, BINS, RATE = 20, 3, 24, 0.3
L1 = 2e-3
#: Distinct words are counted in runs of so many, else the longest texts would look repetitive.
RUN_WORDS = 200

_UPPER, _LOWER, _DIGIT, _SPACE = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91], _LOWER[97:123], _DIGIT[48:58], _SPACE[[32, *range(9, 14)]] = True, True, True, True
_HIGH = np.arange(256) >= 128
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:?'\"()-"]] = True
_SYMBOL = ~(_UPPER | _LOWER | _DIGIT | _SPACE | _HIGH | _STOP)
FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digit", "space", "high", "stop", "symbol", "exclaim", "pipe", "lines_per_word",
    "distinct_words", "distinct_lines", "top_word", "short_words", "capital_words", "byte_entropy", "stop_per_word", "symbol_per_word",
)


def statistics(text: str | None) -> tuple[float, ...]:
    """The features of one whole text; all zero for null and for a text without words."""
    words = (text or "").split()
    if not words:
        return (0.0,) * len(FEATURES)
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, m = len(raw), len(words)
    lines = [x for x in text.split("\n") if x]
    tally: dict[str, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    p = counts[counts > 0] / n
    share = lambda mask: float(counts[mask].sum()) / n
    solid = n - int(counts[_SPACE].sum())
    capitals = sum(map(str.isupper, words))
    return (
        float(np.log1p(n)), float(np.log1p(m)), solid / m, share(_UPPER), share(_DIGIT), share(_SPACE), share(_HIGH), share(_STOP), share(_SYMBOL),
        float(counts[33]) / m, float(counts[124]) / m, len(lines) / m, sum(len(set(words[i : i + RUN_WORDS])) for i in range(0, m, RUN_WORDS)) / m, len(set(lines)) / max(1, len(lines)), max(tally.values()) / m,
        sum(c for w, c in tally.items() if len(w) < 3) / m, capitals / m, float(-(p * np.log2(p)).sum()), float(counts[_STOP].sum()) / m, float(counts[_SYMBOL].sum()) / m,
    )


@F.pandas_udf(T.StructType([T.StructField(f, T.DoubleType()) for f in FEATURES]))
def _measure(texts: pd.Series) -> pd.DataFrame:
    out = pd.DataFrame([statistics(t) for t in texts], columns=list(FEATURES), dtype="float64")
    release_memory()
    return out


def with_statistics(df: DataFrame, text: Column) -> DataFrame:
    """df and a struct `_statistics` of the features; only the texts go to Python."""
    return df.withColumn("_statistics", _measure(text.cast("string")))


Rule = tuple[tuple[str, str, float], ...]  # (feature, "<=" or ">", threshold), all of which hold


def tightened(path: Rule) -> Rule:
    """The conjunction with one condition for each feature and side."""
    least: dict[tuple[str, str], float] = {}
    for f, op, t in path:
        least[f, op] = (min if op == "<=" else max)(t, least.get((f, op), t))
    return tuple(sorted((f, op, t) for (f, op), t in least.items()))


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> list[Rule]:
    """Paths of boosted regression trees for the logistic loss, without repeats, in the order found."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
    score, rules = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))), {}

    def grow(rows: np.ndarray, path: Rule, grad: np.ndarray, hess: np.ndarray) -> None:
        if path:
            rules[tightened(path)] = None
        best, g, h = (1e-3, None, None), grad[rows], hess[rows]
        if len(path) < depth and len(rows) >= 20:
            whole = g.sum() ** 2 / (h.sum() + 1)
            for f, cut in enumerate(cuts):
                gs, hs, ns = (np.cumsum(np.bincount(binned[rows, f], weights=w, minlength=len(cut) + 1))[:-1] for w in (g, h, np.ones(len(rows))))
                if not len(gs):
                    continue
                gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - whole
                gain[(ns < 10) | (len(rows) - ns < 10)] = 0
                if gain.max() > best[0]:
                    best = (gain.max(), f, int(gain.argmax()))
        if best[1] is None:
            score[rows] -= RATE * g.sum() / (h.sum() + 1)
            return
        _, f, at = best
        low = binned[rows, f] <= at
        grow(rows[low], (*path, (FEATURES[f], "<=", float(cuts[f][at]))), grad, hess)
        grow(rows[~low], (*path, (FEATURES[f], ">", float(cuts[f][at]))), grad, hess)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        grow(np.arange(len(y)), (), p - y, p * (1 - p))
    return list(rules)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([x[:, FEATURES.index(f)] <= t if op == "<=" else x[:, FEATURES.index(f)] > t for f, op, t in rule])


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float = L1, steps: int = 600) -> tuple[float, np.ndarray]:
    """Intercept and weights minimising the mean log loss plus penalty * |weights|, by accelerated proximal gradient."""
    b, w = 0.0, np.zeros(z.shape[1])
    vb, vw, t = b, w, 1.0
    v = np.ones(z.shape[1]) / max(1, z.shape[1]) ** 0.5
    for _ in range(20):  # largest eigenvalue of z'z
        v = z.T @ (z @ v)
        v /= max(1e-12, np.linalg.norm(v))
    rate = 4 * len(y) / (np.linalg.norm(z @ v) ** 2 + len(y))
    for _ in range(steps):
        r = 1 / (1 + np.exp(-(z @ vw + vb))) - y
        nb, nw = vb - rate * r.mean(), vw - rate * (z.T @ r) / len(y)
        nw = np.sign(nw) * np.maximum(np.abs(nw) - rate * penalty, 0)
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        vb, vw = nb + (t - 1) / nt * (nb - b), nw + (t - 1) / nt * (nw - w)
        b, w, t = nb, nw, nt
    return float(b), w


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, penalty: float = L1) -> RuleModel:
        """Without both labels the model is the constant share of label 1 (0.5 without rows)."""
        if len(y) == 0 or y.min() == y.max():
            mean = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
            return cls(float(np.log(mean / (1 - mean))), ())
        rules = tree_rules(x, y)
        z = np.stack([holds(r, x) for r in rules], axis=1).astype(np.float32) if rules else np.zeros((len(y), 0), np.float32)
        b, w = lasso_logistic(z, y.astype(np.float32), penalty)
        return cls(b, tuple((r, float(c)) for r, c in zip(rules, w, strict=True) if c != 0))

    def column(self) -> Column:
        """The score as a Spark expression over the statistics."""
        terms = [F.when(reduce(lambda a, b: a & b, [F.col(f"_statistics.{f}") <= t if op == "<=" else F.col(f"_statistics.{f}") > t for f, op, t in rule]), c).otherwise(0.0) for rule, c in self.rules]
        total = reduce(lambda a, b: a + b, terms, F.lit(self.intercept))
        return 1 / (1 + F.exp(-total))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.intercept + sum((w * holds(r, x) for r, w in self.rules), np.zeros(len(x))))))


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> RuleModel:
    """Fit on at most sample_rows labelled rows outside the held-out fold.

    Ids and labels that are null take no part; of several labels of an id the larger counts; an id that several rows have
    gives an example for each. Without labelled rows, or with one label only, the model is a constant.
    """
    known = pick(labels, "doc_id", "quality").where("doc_id is not null and quality is not null").where(fold(F.col("doc_id"), 5) != 0)
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    some = pick(docs, "doc_id", "text").join(F.broadcast(known), "doc_id")  # sample_rows ids at most
    found = with_statistics(some, F.col("text")).select("doc_id", "quality", "_statistics.*").orderBy("doc_id", *FEATURES).toPandas()
    return RuleModel.fit(found[list(FEATURES)].to_numpy(float), found["quality"].to_numpy(float))


def score_quality(docs: DataFrame, model: RuleModel) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs.

    Null, empty and blank texts have all statistics zero and the score the rules give to that. Ties, repeated rows
    and null ids are scored like any row; whole texts of any length are measured; other columns are ignored; an
    empty table gives no rows.
    """
    rows = with_statistics(pick(docs, "doc_id", "text"), F.col("text")).withColumn("score", model.column())
    return rows.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, model: RuleModel) -> DataFrame:
    """The rows of docs, all columns under their names, that the model does not reject; judged like in score_quality, whatever the other columns are called."""
    rows = shielded(docs, "text")
    return with_statistics(rows, F.col("text")).where(model.column() >= THRESHOLD).drop("_statistics").toDF(*docs.columns)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
