"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting adds, feature by feature, a shallow tree over the feature's bins to
that feature's lookup table (log-odds), then does the same for the pairs of
features with the most residual gain, one cut on each axis.  A document's score is
the sigmoid of the intercept plus one entry of every table, read by vectorised
indexing.

It is fitted on about ``sample`` labelled rows, chosen by a hash; every document's
whole text is scored.

Edge cases: null and empty texts have all features 0 and get the score the tables
give them; a text of any length is measured whole; labels that are null, conflicting
labels of one document (the lower counts) and repeated label rows are allowed; a
labelled id with several documents is learned from once; with no labels, or labels of
one class, every score is that class's share (0.5 without labels); repeated rows each
get a row; an empty table gives no rows; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow, bounded_ids

FEATURES = ("words", "word_length", "symbols", "shouting", "exclaims", "digits", "distinct", "top_share", "echo", "repeated_lines", "line_words", "stops", "odd_words")
#: Bytes counted as symbols, apart from sentence marks: fixed values.
SYMBOLS = b"#*$%&|<>=+~^@{}[]\\_"


def features(text: bytes | None) -> list[float]:
    """The features of one whole text, in the order of ``FEATURES``."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = sum(map(len, words))
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    plain = sum(c for w, c in counts.items() if w.rstrip(b".,;:!?").isalpha() or w[-1] >= 128 or w[0] >= 128)
    return [
        math.log1p(n),
        chars / n,
        float(size[list(SYMBOLS)].sum()) / chars,
        float(size[65:91].sum()) / chars,
        float(size[33]) / chars,
        float(size[48:58].sum()) / chars,
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(eq, words, words[1:])) / n,
        1 - len(set(lines)) / len(lines),
        math.log1p(n / len(lines)),
        float(size[46]) / n,
        1 - plain / n,
    ]


class Additive:
    """Lookup tables of an additive model with pairs."""

    def __init__(self, intercept: float, edges: list[np.ndarray], tables: list[np.ndarray], pair_edges: list[np.ndarray], pairs: list[tuple[int, int]], pair_tables: list[np.ndarray]):
        self.intercept, self.edges, self.tables, self.pair_edges, self.pairs, self.pair_tables = intercept, edges, tables, pair_edges, pairs, pair_tables

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        logit = np.full(len(x), self.intercept)
        for j, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            logit += t[np.searchsorted(e, x[:, j], "right")]
        for (j, k), t in zip(self.pairs, self.pair_tables, strict=True):
            logit += t[np.searchsorted(self.pair_edges[j], x[:, j], "right"), np.searchsorted(self.pair_edges[k], x[:, k], "right")]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, penalty: float) -> np.ndarray:
    """Step for each bin of a tree with up to ``leaves`` leaves over ordered bins, grown best gain first."""
    out = np.zeros(len(g))
    parts = [(0, len(g))]

    def cut(a: int, b: int) -> tuple[float, int]:
        if b - a < 2:
            return 0.0, a
        gl, hl = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
        gt, ht = g[a:b].sum(), h[a:b].sum()
        gain = gl**2 / (hl + penalty) + (gt - gl) ** 2 / (ht - hl + penalty) - gt**2 / (ht + penalty)
        i = int(gain.argmax())
        return float(gain[i]), a + i + 1

    while len(parts) < leaves:
        gain, at, which = max((*cut(a, b), -i) for i, (a, b) in enumerate(parts))
        if gain <= 1e-12:
            break
        a, b = parts.pop(-which)
        parts += [(a, at), (at, b)]
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + penalty)
    return out


def _corner(g: np.ndarray, h: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Gain and steps of the best cut on each axis of a grid: four leaves."""
    gs, hs = (np.pad(v.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for v in (g, h))
    i, k = np.arange(1, g.shape[0])[:, None], np.arange(1, g.shape[1])[None, :]
    if not i.size or not k.size:
        return 0.0, np.zeros_like(g)

    def corners(s: np.ndarray) -> list[np.ndarray]:
        a, top, left, total = s[i, k], s[i, -1], s[-1, k], s[-1, -1]
        return [a, top - a, left - a, total - top - left + a]

    quarters = list(zip(corners(gs), corners(hs), strict=True))
    gain = sum(a**2 / (b + penalty) for a, b in quarters)
    at = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.empty_like(g)
    step = [float(a[at] / (b[at] + penalty)) for a, b in quarters]
    r, c = at[0] + 1, at[1] + 1
    out[:r, :c], out[:r, c:], out[r:, :c], out[r:, c:] = step
    return float(gain[at] - gs[-1, -1] ** 2 / (hs[-1, -1] + penalty)), out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, pair_bins: int = 8, pairs: int = 6, rounds: int = 60, pair_rounds: int = 20, rate: float = 0.15, leaves: int = 3, penalty: float = 2.0) -> Additive:
    """Boost the tables; rows in any order give the same model up to rounding."""
    d = x.shape[1]
    edges = [_edges(x[:, j], bins) if len(x) else np.zeros(0) for j in range(d)]
    rough = [_edges(x[:, j], pair_bins) if len(x) else np.zeros(0) for j in range(d)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    share = float(y.mean()) if len(y) else 0.5
    if not len(y) or share in (0.0, 1.0):
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Additive(math.log(share / (1 - share)), edges, tables, rough, [], [])
    intercept = math.log(share / (1 - share))
    at = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    logit = np.full(len(y), intercept)
    p = np.full(len(y), share)
    for _ in range(rounds):
        for j in range(d):
            g = np.bincount(at[j], y - p, len(tables[j]))
            h = np.bincount(at[j], p * (1 - p), len(tables[j]))
            step = rate * _tree(g, h, leaves, penalty)
            tables[j] += step
            logit += step[at[j]]
            p = 1 / (1 + np.exp(-logit))
    near = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(rough)]

    def grid(j: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(rough[j]) + 1, len(rough[k]) + 1)
        flat = near[j] * shape[1] + near[k]
        return np.bincount(flat, y - p, shape[0] * shape[1]).reshape(shape), np.bincount(flat, p * (1 - p), shape[0] * shape[1]).reshape(shape)

    ranked = sorted((-_corner(*grid(j, k), penalty)[0], j, k) for j in range(d) for k in range(j + 1, d))
    chosen = [(j, k) for _, j, k in ranked[:pairs]]
    pair_tables = [np.zeros((len(rough[j]) + 1, len(rough[k]) + 1)) for j, k in chosen]
    for _ in range(pair_rounds):
        for t, (j, k) in zip(pair_tables, chosen, strict=True):
            step = rate * _corner(*grid(j, k), penalty)[1]
            t += step
            logit += step[near[j], near[k]]
            p = 1 / (1 + np.exp(-logit))
    return Additive(intercept, edges, tables, rough, chosen, pair_tables)


def learn(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = 12_000) -> Additive:
    """Fit on about ``sample`` labelled documents for which ``usable`` (of the column doc_id) holds."""
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where(usable & F.col("y").isNotNull() & F.col("doc_id").isNotNull())
    chosen = bounded_ids(marks, sample).groupBy("doc_id").agg(F.min("y").alias("y"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [features(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows, pa.list_(pa.float64()))], ["id", "y", "x"])

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("t"))
    fit_rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "t")
    kind = docs.schema[id_col].dataType.simpleString()
    found = arrow(fit_rows, measure, f"id {kind}, y int, x array<double>").groupBy("id").agg(F.min(F.struct("y", "x")).alias("r"))
    rows = [r["r"] for r in found.collect()]  # about ``sample`` rows of features
    x = np.array([r["x"] for r in rows], float).reshape(-1, len(FEATURES))
    y = np.array([r["y"] for r in rows], float)
    order = np.lexsort((*x.T, y))  # the arrival of rows doesn't matter
    return fit(x[order], (y[order] > 0).astype(float))


def classify(docs: DataFrame, model: Additive, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``id_col``, score (probability of label 1) and predicted for each document."""
    tables = docs.sparkSession.sparkContext.broadcast(model)  # bounded by bins and pairs

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t.as_py()) for t in b.column(1)], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(tables.value.score(x), pa.float64())], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"))
    out = arrow(plain, work, f"id {kind}, score double")
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
