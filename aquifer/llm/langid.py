"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, seeded by its code point.  An n-gram
is bound by multiplying its letters' vectors, each rotated by its place; a text is
the bundle (sum) of its n-grams, a language's prototype the bundle of its learning
texts, and the language of the nearest prototype by cosine wins.

Learning texts are a bounded sample for each language (``per_lang``, about); every
n-gram of a whole text counts.  Runs of other characters than letters are one
space, which has a vector too.

Texts are bundled in chunks that bound their number as well as their bytes; a longer
text is a chunk of its own.

Edge cases: null texts and texts without a letter give ``und`` and score 0, as do
all texts where nothing could be learned; ties go to the first language by code
point; a language that is null or ``und`` is never learned; repeated rows each get a
row; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow, bounded_ids, chunks

CHUNK_BYTES = 1 << 20
LEAST = 4 << 10  # bytes that a text counts at least, so that a chunk holds at most 256 texts

_letters: dict[tuple[int, int, int], np.ndarray] = {}
_is_letter: list[np.ndarray] = []


def letter_vector(code: int, dims: int, seed: int) -> np.ndarray:
    """The letter's random vector, the same in every process."""
    key = (code, dims, seed)
    if key not in _letters:
        if len(_letters) > 20_000:
            _letters.clear()
        _letters[key] = np.random.default_rng([seed, code]).integers(0, 2, dims, dtype=np.int8) * 2 - 1
    return _letters[key]


def _codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text; runs of other characters than letters are one 0; a 0 at each end."""
    if not _is_letter:
        _is_letter.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    codes = np.where(_is_letter[0][codes], codes, 0)
    codes = np.concatenate(([0], codes, [0])).astype(np.int64)
    return codes[np.concatenate(([True], (codes[1:] > 0) | (codes[:-1] > 0)))]


def bundles(texts: list[str], dims: int, seed: int) -> np.ndarray:
    """The hypervector of each text: sums of bound trigrams."""
    out = np.zeros((len(texts), dims), np.float32)
    codes = [_codes(t) for t in texts]
    seen = np.zeros(0x110000, np.int64)
    for c in codes:
        seen[c] = 1
    alphabet = np.flatnonzero(seen)
    k = len(alphabet)
    if not k:
        return out
    seen[alphabet] = np.arange(k)
    grams, owner = [], []
    for i, c in enumerate(codes):
        d = seen[c]
        if len(d) > 2:
            grams.append((d[:-2] * k + d[1:-1]) * k + d[2:])
            owner.append(np.full(len(d) - 2, i))
    if not grams:
        return out
    flat, owner = np.concatenate(grams), np.concatenate(owner)
    if k**3 <= 1 << 22:
        there = np.zeros(k**3, bool)
        there[flat] = True
        distinct = np.flatnonzero(there)
        number = np.zeros(k**3, np.int64)
        number[distinct] = np.arange(len(distinct))
        flat = number[flat]
    else:
        distinct, flat = np.unique(flat, return_inverse=True)
    letters = np.stack([letter_vector(int(c), dims, seed) for c in alphabet])
    turned = [np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1), letters]
    for a in range(0, len(distinct), 4096):  # bounds the memory of the bound vectors
        part = distinct[a : a + 4096]
        bound = turned[0][part // (k * k)] * turned[1][part // k % k] * turned[2][part % k]
        inside = (flat >= a) & (flat < a + len(part))
        counts = np.bincount(owner[inside] * len(part) + flat[inside] - a, minlength=len(texts) * len(part))
        out += counts.reshape(len(texts), -1).astype(np.float32) @ bound.astype(np.float32)
    return out


def _grouped(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    for a, b in chunks(np.maximum(sizes, LEAST), CHUNK_BYTES):
        yield a, [texts[i].as_py() or "" for i in range(a, b)]


def prototypes(docs: DataFrame, learn: Column, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", per_lang: int = 1500, dims: int = 1024, seed: int = 7) -> tuple[list[str], np.ndarray]:
    """Languages by code point and their unit prototypes, from about ``per_lang`` texts of each."""
    fit = docs.where(learn & F.col(lang_col).isNotNull() & (F.col(lang_col) != "und")).select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rates = bounded_ids(fit.select("doc_id", "lang"), per_lang, "lang")

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            langs = b.column(0).to_pylist()
            for a, texts in _grouped(b.column(1)):
                for i, v in enumerate(bundles(texts, dims, seed)):
                    sums[langs[a + i]] = sums.get(langs[a + i], 0) + v.astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.astype("<f8").tobytes() for v in sums.values()], pa.binary())], ["lang", "v"])

    sample = fit.join(F.broadcast(rates.select("doc_id").distinct()), "doc_id").select("lang", "text")  # about per_lang ids a language
    total: dict[str, np.ndarray] = {}
    for r in arrow(sample, bundle, "lang string, v binary").collect():  # one vector a task and language
        total[r["lang"]] = total.get(r["lang"], 0) + np.frombuffer(r["v"], "<f8")
    langs = sorted(total)
    if not langs:
        return [], np.zeros((0, dims), np.float32)
    stacked = np.stack([total[x] / max(1e-9, np.linalg.norm(total[x])) for x in langs])
    return langs, stacked.astype(np.float32)


def identify(docs: DataFrame, langs: list[str], profile: np.ndarray, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, sharpness: float = 20.0) -> DataFrame:
    """``id_col``, lang_pred, score (softmax of the cosines) and cosine for each document."""
    model = docs.sparkSession.sparkContext.broadcast(profile)  # languages x dims

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for b in batches:
            pred: list[str] = []
            score: list[float] = []
            near: list[float] = []
            for _, texts in _grouped(b.column(1)):
                v = bundles(texts, profile_dims, seed)
                length = np.linalg.norm(v, axis=1)
                if not langs:
                    best, share, cosine = np.zeros(len(texts), int), np.zeros(len(texts)), np.zeros((len(texts), 1))
                else:
                    cosine = (v @ own.T) / np.maximum(length, 1e-9)[:, None]
                    best = cosine.argmax(axis=1)
                    e = np.exp(sharpness * (cosine - cosine.max(axis=1, keepdims=True)))
                    share = e.max(axis=1) / e.sum(axis=1)
                for i, text in enumerate(texts):
                    known = bool(langs) and any(map(str.isalpha, text))
                    pred.append(langs[best[i]] if known else "und")
                    score.append(float(min(1.0, max(0.0, share[i]))) if known else 0.0)
                    near.append(float(cosine[i, best[i]]) if known else 0.0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(near, pa.float64())], ["id", "lang_pred", "score", "cosine"])

    profile_dims = profile.shape[1]
    kind = docs.schema[id_col].dataType.simpleString()
    out = arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), work, f"id {kind}, lang_pred string, score double, cosine double")
    return out.select(F.col("id").alias(id_col), "lang_pred", "score", "cosine")
