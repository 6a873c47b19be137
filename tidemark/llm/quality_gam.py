"""Quality classifier: a generalised additive model with pairwise terms.

Every feature of a text is cut into bins. Cyclic boosting visits the features
in turn, fits a shallow tree to the logistic loss's gradients in that
feature's bins and adds it to the feature's lookup table; then the strongest
pairs of features are boosted in the same way on their joint bins. A score is
the logistic of the sum of table entries, so scoring is bin lookups and adds.

The fit uses at most about ``SAMPLE_ROWS`` labelled rows (a documented bound,
chosen by a hash of id and features); features and scores cover every
document.

Defined results: a null or empty text has all-zero features and is scored
like any other; without usable labels every score is 0.5; rows with a null
label are not learned from; repeated rows get equal scores.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import add_columns, cut, field
from tidemark.llm.quality_rules import text_rules

SAMPLE_ROWS = 20_000
BINS = 32
ROUNDS = 150
PAIR_ROUNDS = 60
PAIRS = 8
RATE = 0.1
MIN_LEAF = 20.0  # rows
L2 = 1.0
CUTOFF = 0.3
FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeat_words", "distinct_words", "adjacent_repeats",
            "upper_letters", "digits", "exclaims", "pipes", "line_words", "stops", "non_ascii", "long_words",
            "common_word")


def features(text: bytes) -> list[float]:
    words, codes, chars, symbols, dup_lines, repeat = text_rules(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    bytes_ = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, lower = int(bytes_[65:91].sum()), int(bytes_[97:123].sum())
    lines = int(bytes_[10]) + 1
    ends = np.fromiter(map(len, words), np.int64, n)
    _, each = np.unique(codes, return_counts=True)
    return [
        float(np.log1p(n)), chars / n, symbols / n, dup_lines / lines, repeat / n, len(each) / n,
        float((codes[1:] == codes[:-1]).sum()) / n, upper / max(1, upper + lower), int(bytes_[48:58].sum()) / n,
        int(bytes_[33]) / n, int(bytes_[124]) / n, n / lines, int(bytes_[46]) / n,
        int(bytes_[128:].sum()) / len(text), float((ends > 20).sum()) / n, float(each.max()) / n,
    ]


def _tree(grad: np.ndarray, hess: np.ndarray, count: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values per bin of a shallow tree on one ordered feature."""
    total = grad.sum(axis=0)
    value = np.full(len(grad), -total / (hess.sum() + L2))
    if depth == 0 or len(grad) < 2:
        return value
    g, h, c = np.cumsum(grad)[:-1], np.cumsum(hess)[:-1], np.cumsum(count)[:-1]
    gain = g * g / (h + L2) + (total - g) ** 2 / (hess.sum() - h + L2) - total**2 / (hess.sum() + L2)
    gain[(c < MIN_LEAF) | (count.sum() - c < MIN_LEAF)] = -1.0
    at = int(gain.argmax()) + 1
    if gain[at - 1] <= 1e-9:
        return value
    return np.concatenate([_tree(grad[:at], hess[:at], count[:at], depth - 1),
                           _tree(grad[at:], hess[at:], count[at:], depth - 1)])


def _pair_tree(grad: np.ndarray, hess: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of the best four-leaf tree on a grid (one cut of each feature,
    the second within either side), and its gain."""
    def best(g, h, c, axis):
        gs, hs, cs = (np.cumsum(x.sum(axis=1 - axis))[:-1] for x in (g, h, c))
        t, u = g.sum(), h.sum()
        gain = gs * gs / (hs + L2) + (t - gs) ** 2 / (u - hs + L2) - t * t / (u + L2)
        gain[(cs < MIN_LEAF) | (c.sum() - cs < MIN_LEAF)] = 0.0
        i = int(gain.argmax())
        return i + 1, float(gain[i])

    value, most = np.zeros_like(grad), 0.0
    for axis in (0, 1):
        at, gain = best(grad, hess, count, axis)
        out = np.empty_like(grad)
        for side in (slice(None, at), slice(at, None)):
            here = (side, slice(None)) if axis == 0 else (slice(None), side)
            g, h, c = grad[here], hess[here], count[here]
            cut_at, more = best(g, h, c, 1 - axis)
            gain += more
            for part in (slice(None, cut_at), slice(cut_at, None)):
                leaf = (slice(None), part) if axis == 0 else (part, slice(None))
                sub = out[here]
                sub[leaf] = -g[leaf].sum() / (h[leaf].sum() + L2)
        if gain > most:
            value, most = out, gain
    return value, most


class Gam:
    """Bin edges, one table for each feature, one for each chosen pair."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        n = x.shape[1]
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0)
                      for j in range(n)]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        mean = (y.sum() + 0.5) / (len(y) + 1.0) if len(y) else 0.5
        self.base = float(np.log(mean / (1 - mean)))
        if len(y) == 0 or y.min() == y.max():
            return
        bins = self.bins(x)
        z = np.full(len(y), self.base)
        for _ in range(ROUNDS):
            for j, table in enumerate(self.tables):
                g, h = self._gradients(z, y)
                b, m = bins[:, j], len(table)
                if m < 2:
                    continue
                step = RATE * _tree(np.bincount(b, g, m), np.bincount(b, h, m), np.bincount(b, minlength=m))
                table += step
                z += step[b]
        ranked = []
        g, h = self._gradients(z, y)
        for i, j in combinations(range(n), 2):
            if len(self.tables[i]) > 1 and len(self.tables[j]) > 1:
                ranked.append((self._grid(bins, i, j, g, h)[1], -i, -j))
        for gain, i, j in sorted(ranked, reverse=True)[:PAIRS]:
            if gain > 0:
                self.pairs.append((-i, -j))
                self.pair_tables.append(np.zeros((len(self.tables[-i]), len(self.tables[-j]))))
        for _ in range(PAIR_ROUNDS):
            for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
                g, h = self._gradients(z, y)
                step = RATE * self._grid(bins, i, j, g, h)[0]
                table += step
                z += step[bins[:, i], bins[:, j]]

    @staticmethod
    def _gradients(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    def _grid(self, bins, i, j, g, h) -> tuple[np.ndarray, float]:
        shape = len(self.tables[i]), len(self.tables[j])
        at, m = bins[:, i] * shape[1] + bins[:, j], shape[0] * shape[1]
        return _pair_tree(*(v.reshape(shape) for v in (np.bincount(at, g, m), np.bincount(at, h, m),
                                                       np.bincount(at, minlength=m).astype(float))))

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            z += table[b[:, j]]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            z += table[b[:, i], b[:, j]]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _sample(featured: DataFrame, labels: DataFrame, learn: Column, label: str) -> tuple[np.ndarray, np.ndarray]:
    marked = labels.where(learn & F.col(label).isin(0, 1)).select(
        F.col("doc_id").alias("label_id"), F.col(label).cast("double").alias("y")).distinct()
    rows = cut(featured.join(marked, F.col("doc_id") == F.col("label_id")).select("doc_id", "x", "y"))
    share = SAMPLE_ROWS / max(1, rows.count())
    if share < 1:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", "x"), F.lit(1_000_000)) < int(share * 1_000_000))
    got = rows.orderBy(F.xxhash64("doc_id", "x", "y"), "doc_id").limit(2 * SAMPLE_ROWS).toPandas()
    x = np.array(got["x"].tolist(), np.float64).reshape(len(got), len(FEATURES))
    return x, got["y"].to_numpy(np.float64)


def quality_gam(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text",
                label: str = "quality") -> DataFrame:
    """One row per document: its id, whether it was held out, score and
    prediction. ``learn`` marks (by ``doc_id``) the rows to learn from."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    featured = cut(add_columns(src, "text", [field("x", "array:float")],
                               lambda texts: [[features(b) for b in texts]], drop=("text",)))
    x, y = _sample(featured, labels.select(F.col(id_col).alias("doc_id"), F.col(label).alias(label)), learn, label)
    model = Gam(x.astype(np.float32), y)

    def score(batches):
        import pyarrow as pa

        for batch in batches:
            got = batch.column(batch.schema.get_field_index("x"))
            x = got.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    kind = featured.schema["doc_id"].dataType.simpleString()
    scored = featured.select("doc_id", "x").mapInArrow(score, f"doc_id {kind}, score double")
    return scored.select("doc_id", (~learn).alias("held_out"), "score",
                         (F.col("score") >= CUTOFF).cast("int").alias("predicted"))
