"""Quality classifier: histogram gradient-boosted trees over document statistics.

Features are cut into at most BINS quantile bins; each tree is grown level by level from histograms of
gradients and curvatures.  All trees are complete and flattened into arrays (feature, bin, leaf value),
so that numpy walks every document down all trees at once: node = 2 * node + 1 + (bin > cut).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, map_texts, read
from .statistics import FEATURES, features

TREES, DEPTH, BINS, RATE, L2 = 60, 4, 64, 0.15, 1.0
#: Labelled documents that the trees are fitted on at most, chosen by a hash of the id.
FIT_ROWS = 30_000
THRESHOLD = 0.5


class Trees:
    def __init__(self, depth: int = DEPTH):
        self.depth = depth
        self.edges: list[np.ndarray] = []
        self.feature = self.cut = self.value = np.zeros((0, 0))
        self.start = 0.0

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1).astype(np.int16)

    def fit(self, x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Trees:
        n, width = x.shape
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) for j in range(width)]
        bins, inner = self.binned(x), 2**self.depth - 1
        rate = (y.sum() + 1) / (n + 2)
        self.start = float(np.log(rate / (1 - rate)))
        score = np.full(n, self.start)
        feature, cut, value = [], [], []
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            grad, curve = p - y, np.maximum(p * (1 - p), 1e-9)
            node, f, c = np.zeros(n, np.int64), np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
            for level in range(self.depth):
                first, count = 2**level - 1, 2**level
                best = np.zeros(count)
                for j in range(width):
                    key = (node - first) * (BINS + 1) + bins[:, j]
                    g = np.bincount(key, grad, count * (BINS + 1)).reshape(count, -1)
                    h = np.bincount(key, curve, count * (BINS + 1)).reshape(count, -1)
                    gl, hl = g.cumsum(1), h.cumsum(1)
                    gt, ht = gl[:, -1:], hl[:, -1:]
                    gain = gl**2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt**2 / (ht + L2)
                    gain[(hl < 0.5) | (ht - hl < 0.5)] = 0
                    at = gain.argmax(1)
                    better = np.flatnonzero(gain[np.arange(count), at] > best + 1e-12)
                    best[better] = gain[better, at[better]]
                    f[first + better], c[first + better] = j, at[better]
                node = 2 * node + 1 + (bins[np.arange(n), f[node]] > c[node])
            leaf = node - inner
            g, h = np.bincount(leaf, grad, inner + 1), np.bincount(leaf, curve, inner + 1)
            v = -RATE * g / (h + L2)
            score += v[leaf]
            feature.append(f), cut.append(c), value.append(v)
        self.feature, self.cut, self.value = np.array(feature), np.array(cut), np.array(value)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities: all documents step down all trees together."""
        bins, trees = self.binned(x), len(self.feature)
        node = np.zeros((len(x), trees), np.int64)
        which, rows = np.arange(trees)[None, :], np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = 2 * node + 1 + (bins[rows, self.feature[which, node]] > self.cut[which, node])
        return 1 / (1 + np.exp(-(self.start + self.value[which, node - (2**self.depth - 1)].sum(axis=1))))


def fitted(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Trees | None:
    """Trees from labelled documents that are not held out; none if there is no label to learn from.

    Equal texts with equal labels count once, so that groups of copies carry no more weight than one.
    """
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out(3, 1)).select("doc_id", "quality").distinct()
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(fit_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = map_texts(texts, lambda t: {"x": [features(s) for s in t]}, "x array<double>", ("quality",)).distinct().toPandas()
    if not len(rows):
        return None
    rows = rows.sort_values(["quality", "x"], key=lambda s: s.map(tuple) if s.name == "x" else s)  # the same sums each run
    return Trees().fit(np.array(rows["x"].tolist()).reshape(-1, len(FEATURES)), rows["quality"].to_numpy(float))


def score(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.  Null and empty texts are scored as no words;
    without trees every score is 0.5; repeated rows are scored each; other columns are ignored."""
    if trees is None:
        scored = docs.select("doc_id", F.lit(0.5).alias("score"))
    else:
        sent = docs.sparkSession.sparkContext.broadcast(trees)  # TREES x 2**DEPTH numbers

        def row(texts: list[str]) -> dict:
            return {"score": sent.value.predict(np.array([features(t) for t in texts]))}

        scored = map_texts(docs, row, "score double")
    return scored.select(
        "doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return score(docs, fitted(docs, labels))
