"""Toxicity by a classifier chain.

Categories are predicted one after another.  Each has a linear logistic model over
the text's features and the probabilities of the categories before it; while learning,
those come from out-of-fold predictions, so that a later model sees earlier ones as
unsure as they will be.  Features are the letter words of a text and their first
five letters, present or not; a feature is kept if it is frequent enough and its
share differs most between marked and other texts.  For an out-of-fold prediction
features are chosen, too, without the rows that it is made for.

It is fitted on about ``sample`` labelled rows, chosen by a hash; every document's
whole text is scored.  How much shares must differ (``least_z``) and the threshold
were chosen by cross-validation within rows that may be learned from.

Edge cases: null and empty texts have no features and get the intercept's
probability; a text of any length is scored whole, by its set of words; null labels
count as 0; a category without any or with only marked rows predicts that share;
conflicting labels of one document: the higher counts; a labelled id with several
documents is learned from once; repeated rows each get a row; an empty table gives
no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow, bounded_ids

LETTERS = re.compile(r"[^\W\d_]+")
STEM = 5
CACHE = 400_000


def text_words(text: str | None) -> set[str]:
    return set(LETTERS.findall((text or "").lower()))


def hashes(word: str) -> tuple[int, ...]:
    """Numbers of a word's features: the word and its stem."""
    own = xxhash.xxh32_intdigest(word)
    return (own, xxhash.xxh32_intdigest(word[:STEM], 1)) if len(word) > STEM - 1 else (own,)


class Rows:
    """Sparse binary rows: ``at`` holds feature numbers, ``row`` their rows."""

    def __init__(self, lists: list[np.ndarray], width: int):
        self.n, self.width = len(lists), width
        self.at = np.concatenate(lists) if lists else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(self.n), [len(x) for x in lists])

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.at], self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, r[self.row], self.width)


def logistic(rows: Rows, dense: np.ndarray, y: np.ndarray, use: np.ndarray, l2: float = 0.3, steps: int = 300) -> np.ndarray:
    """Weights (features, dense columns, intercept) by accelerated gradient steps on the rows in ``use``."""
    width, extra = rows.width, dense.shape[1]
    share = float(np.clip(y[use].mean() if use.any() else 0.5, 1e-4, 1 - 1e-4))
    w = np.zeros(width + extra + 1)
    w[-1] = np.log(share / (1 - share))
    if not use.any() or y[use].min() == y[use].max():
        return w
    weight = use.astype(float)
    # curvature of each weight bounds its step
    per_row = np.bincount(rows.row, minlength=rows.n) + (dense**2).sum(axis=1) + 1
    reach = np.concatenate([rows.back(weight * np.sqrt(per_row)), (np.abs(dense) * (weight * np.sqrt(per_row))[:, None]).sum(axis=0), [(weight * np.sqrt(per_row)).sum()]]) / 4 + l2
    z, t = w.copy(), 1.0
    for _ in range(steps):
        logit = rows.times(z[:width]) + dense @ z[width:-1] + z[-1]
        r = weight * (y - 1 / (1 + np.exp(-np.clip(logit, -30, 30))))
        g = np.concatenate([rows.back(r), dense.T @ r, [r.sum()]])
        g[:-1] -= l2 * z[:-1]
        new = z + g / reach
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return w


def probability(rows: Rows, dense: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(rows.times(w[: rows.width]) + dense @ w[rows.width : -1] + w[-1], -30, 30)))


class Chain:
    """Fitted chain: feature numbers and, for each category, its weights."""

    def __init__(self, categories: list[str], features: np.ndarray, weights: list[np.ndarray]):
        self.categories, self.features, self.weights = categories, features, weights

    def score(self, lists: list[np.ndarray]) -> np.ndarray:
        """Probability of each category for each row."""
        rows = Rows(lists, len(self.features))
        dense = np.zeros((rows.n, 0))
        out = []
        for w in self.weights:
            p = probability(rows, dense, w)
            out.append(p)
            dense = np.column_stack([dense, p])
        return np.column_stack(out) if out else np.zeros((rows.n, 0))


def choose(lists: list[np.ndarray], y: np.ndarray, most: int, least_df: int, least_z: float = 4.0) -> np.ndarray:
    """Features whose share among marked rows differs most from that among others, in sorted order."""
    if not lists:
        return np.zeros(0, np.int64)
    flat = np.concatenate(lists)
    found, number, df = np.unique(flat, return_inverse=True, return_counts=True)
    n1 = y.sum()
    n0 = len(y) - n1
    marked = np.bincount(number, np.repeat(y, [len(x) for x in lists]), len(found))
    p = df / len(y)
    z = (marked / max(n1, 1) - (df - marked) / max(n0, 1)) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / max(n1, 1) + 1 / max(n0, 1)))
    z[df < least_df] = 0
    best = np.argsort(-np.abs(z), kind="stable")[:most]
    return np.sort(found[best[np.abs(z[best]) > least_z]])


def index(features: np.ndarray, lists: list[np.ndarray]) -> list[np.ndarray]:
    """Places in ``features`` of each row's numbers."""
    out = []
    for x in lists:
        at = np.searchsorted(features, x)
        at = at[(at < len(features))] if not len(features) else at[np.append(features, -1)[at] == x]
        out.append(at.astype(np.int64))
    return out


def _features(lists: list[np.ndarray], marks: np.ndarray, most: int, least_df: int) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros(0, np.int64), *(choose(lists, marks[:, k], most, least_df) for k in range(marks.shape[1]))]))


def fit_chain(lists: list[np.ndarray], marks: np.ndarray, categories: list[str], most: int = 1500, least_df: int = 4, folds: int = 5) -> tuple[Chain, np.ndarray]:
    """Fit each category on the features and the out-of-fold probabilities of those before it; also those probabilities."""
    fold = np.arange(len(lists)) % folds
    parts = []
    for f in range(folds):
        own = [x for x, g in zip(lists, fold.tolist(), strict=True) if g != f]
        keep = _features(own, marks[fold != f], most, least_df)
        parts.append(Rows(index(keep, lists), len(keep)))
    keep = _features(lists, marks, most, least_df)
    rows = Rows(index(keep, lists), len(keep))
    dense = np.zeros((rows.n, 0))
    weights = []
    for k in range(len(categories)):
        y = marks[:, k]
        out = np.zeros(rows.n)
        for f, part in enumerate(parts):
            out[fold == f] = probability(part, dense, logistic(part, dense, y, fold != f))[fold == f]
        weights.append(logistic(rows, dense, y, np.ones(rows.n, bool)))
        dense = np.column_stack([dense, out])
    return Chain(categories, keep, weights), dense


def learn(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], usable: Column, id_col: str = "doc_id", text_col: str = "text", sample: int = 8_000) -> Chain:
    """Fit on about ``sample`` labelled documents; ``categories`` maps names, in the chain's order, to conditions on ``labels``."""
    names = list(categories)
    flags = [F.coalesce(c.cast("int"), F.lit(0)).alias(f"y{i}") for i, c in enumerate(categories.values())]
    marks = labels.select(F.col(id_col).alias("doc_id"), *flags).where(usable & F.col("doc_id").isNotNull())
    chosen = bounded_ids(marks, sample).groupBy("doc_id").agg(*(F.max(f"y{i}").alias(f"y{i}") for i in range(len(names))))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.unique(np.fromiter((h for w in text_words(t.as_py()) for h in hashes(w)), np.uint32)).astype("<u4").tobytes() for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.binary())], ["id", "y", "x"])

    y = F.array(*[F.col(f"y{i}") for i in range(len(names))])
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    fit_rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", y.alias("y"), "t")
    kind = docs.schema[id_col].dataType.simpleString()
    found = arrow(fit_rows, gather, f"id {kind}, y array<int>, x binary").groupBy("id").agg(F.min(F.struct("y", "x")).alias("r"))
    rows = [r["r"] for r in found.collect()]  # about ``sample`` rows of word numbers
    rows.sort(key=lambda r: (xxhash.xxh64_intdigest(bytes(r["x"])), r["y"]))  # the arrival of rows doesn't matter
    lists = [np.frombuffer(r["x"], "<u4").astype(np.int64) for r in rows]
    return fit_chain(lists, np.array([r["y"] for r in rows], float).reshape(-1, len(names)), names)[0]


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.4) -> DataFrame:
    """``id_col``, p_<category> for each, score (the last category's probability) and toxic."""
    model = docs.sparkSession.sparkContext.broadcast(chain)  # bounded by the kept features
    names = [f"p_{c}" for c in chain.categories]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Chain = model.value
        place = {int(f): i for i, f in enumerate(own.features)}
        memo: dict[str, tuple[int, ...]] = {}

        def places(word: str) -> tuple[int, ...]:
            got = memo.get(word)
            if got is None:
                if len(memo) >= CACHE:
                    memo.clear()
                got = memo[word] = tuple(place[h] for h in hashes(word) if h in place)
            return got

        for b in batches:
            lists = [np.array(sorted({i for w in text_words(t.as_py()) for i in places(w)}), np.int64) for t in b.column(1)]
            p = own.score(lists)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(p[:, k], pa.float64()) for k in range(len(names)))], ["id", *names])

    kind = docs.schema[id_col].dataType.simpleString()
    out = arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")), work, f"id {kind}, " + ", ".join(f"{n} double" for n in names))
    last = F.col(names[-1])
    return out.select(F.col("id").alias(id_col), *names, last.alias("score"), (last >= threshold).alias("toxic"))
