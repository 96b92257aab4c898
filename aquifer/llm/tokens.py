"""Token counts by heap-and-linked-list byte-pair merging.

A pretoken starts as one symbol per byte.  A heap holds the adjacent pairs by
rank, a doubly linked list holds the symbols that are left; the lowest pair is
popped and merged until none is left.  The count is the initial symbols minus the
merges; no identifiers are produced.  A pretoken of n bytes costs O(n log n), so a
text without spaces is safe.

Texts are split by a pattern of our own where every character is one that a check
against the library, at the time of loading, finds normalised and classed alike;
a text with any other character (marks that combine, scripts newer than Python's
tables) is normalised and split by the library itself.  Merging is ours in both.

Edge cases: null and empty texts have 0 bytes and 0 tokens; the vocabulary's
special strings count as one token each and are cut out before normalisation;
a text of any length is counted whole; repeated rows and repeated ids each get
their own row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import arrow

#: White space of the splitter: a fixed value.
SPACES = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Ranges without marks that combine, in which texts of most languages lie; the check at loading narrows them.
COMMON = ((0x0, 0x2FF), (0x370, 0x482), (0x48A, 0x52F), (0x2010, 0x2027), (0x2030, 0x205E), (0x3001, 0x3029), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3), (0xFF01, 0xFF5E))
#: Contractions that the splitter cuts off: a fixed value.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"

FULL = regex.compile(rf"{CONTRACTIONS}|\p{{L}}+|\p{{N}}|[^{SPACES}\p{{L}}\p{{N}}]+")
ASCII = re.compile(rf"{CONTRACTIONS}|[a-z]+|[0-9]|[^{SPACES}a-z0-9]+")

#: Counts kept per Python worker; the table is emptied when full.
CACHE = 400_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + n)
    return [out[b] for b in range(256)]


def load(path: str) -> dict:
    """Merge ranks of a word-level byte-pair vocabulary with word ends, keyed by symbol numbers.

    Symbols 0..255 are bytes, 256..511 bytes that end a word; further ones are merges.
    """
    spec = json.load(open(path, encoding="utf-8"))
    model, end = spec["model"], spec["model"]["end_of_word_suffix"] or ""
    chars = byte_symbols()
    number = {c: b for b, c in enumerate(chars)} | {c + end: 256 + b for b, c in enumerate(chars)}
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        made = number.setdefault(left + right, len(number))
        merges[number[left] << 20 | number[right]] = (rank, made)
    splitter = json.dumps({k: spec[k] for k in ("normalizer", "pre_tokenizer")} | {"version": "1.0", "added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}})
    return {"merges": merges, "special": [t["content"] for t in spec["added_tokens"]], "splitter": splitter, "alike": alike(splitter)}


def normal(text: str) -> str:
    """The text composed and in lower case, without the rule for a sigma at the end."""
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()


def pieces(library: Tokenizer, text: str) -> list[str]:
    """Pretokens as the library splits them; it writes each byte as a character."""
    return [p for p, _ in library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))]


def alike(splitter: str) -> str:
    """The common characters that the library normalises and splits as this module does, as a character class."""
    library, symbols = Tokenizer.from_str(splitter), byte_symbols()
    good = []
    for low, high in COMMON:
        for code in range(low, high + 1):
            c = chr(code)
            probe = f"{c}a{c}1{c}{c}!{c}"
            own = ["".join(symbols[b] for b in p.encode()) for p in FULL.findall(normal(probe))]
            if own == pieces(library, probe):
                good.append(code)
    edges = [(a, b) for a, b in zip([None, *good], [*good, None], strict=True) if a is None or b is None or b != a + 1]
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for (_, a), (b, _) in zip(edges, edges[1:], strict=False))


def merged_count(symbols: list[int], merges: dict[int, tuple[int, int]]) -> int:
    """Symbols left after all merges."""
    n = len(symbols)
    if n < 2:
        return n
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    get = merges.get
    heap = [m[0] << 32 | i for i in range(n - 1) if (m := get(symbols[i] << 20 | symbols[i + 1]))]
    heapify(heap)
    done = 0
    while heap:
        top = heappop(heap)
        rank, i = top >> 32, top & 0xFFFFFFFF
        j = after[i]
        if symbols[i] < 0 or j >= n:
            continue
        m = get(symbols[i] << 20 | symbols[j])
        if m is None or m[0] != rank:
            continue
        symbols[i], symbols[j] = m[1], -1
        k = after[i] = after[j]
        done += 1
        if k < n:
            before[k] = i
            if m := get(symbols[i] << 20 | symbols[k]):
                heappush(heap, m[0] << 32 | i)
        if (h := before[i]) >= 0 and (m := get(symbols[h] << 20 | symbols[i])):
            heappush(heap, m[0] << 32 | h)
    return n - done


class Counts(dict):
    """Tokens of a pretoken, computed on first sight."""

    def __init__(self, merges: dict[int, tuple[int, int]]):
        self.merges = merges

    def __missing__(self, word: str) -> int:
        symbols = list(word.encode("utf-8", "replace"))
        symbols[-1] += 256
        n = merged_count(symbols, self.merges)
        if len(word) <= 64:
            if len(self) >= CACHE:
                self.clear()
            self[word] = n
        return n


class Counter:
    """Counts tokens of whole texts."""

    def __init__(self, model: dict):
        self.counts = Counts(model["merges"])
        self.special = re.compile("|".join(map(re.escape, model["special"]))) if model["special"] else None
        self.other = re.compile(f"[^{model['alike']}]")
        self.library = Tokenizer.from_str(model["splitter"])
        self.byte = {c: b for b, c in enumerate(byte_symbols())}

    def piece(self, text: str) -> int:
        if text.isascii():
            found = ASCII.findall(text.lower())
        elif self.other.search(text) is None:
            found = FULL.findall(normal(text))
        else:
            found = [bytes(map(self.byte.__getitem__, p)).decode() for p in pieces(self.library, text)]
        return sum(map(self.counts.__getitem__, found))

    def count(self, text: str) -> int:
        if self.special is None or "<" not in text or not (hits := self.special.findall(text)):
            return self.piece(text)
        return len(hits) + sum(map(self.piece, self.special.split(text)))


_counters: dict[str, Counter] = {}


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """id, n_bytes, n_tokens and over_limit of every whole text."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(load(vocabulary))  # bounded by the vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _counters.get(vocabulary)
        if own is None:
            own = _counters[vocabulary] = Counter(model.value)
        for b in batches:
            texts = b.column(1)
            n = [own.count(t.as_py() or "") for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), b.column(2)], ["id", "n_tokens", "n_bytes"])

    kind = docs.schema[id_col].dataType.simpleString()
    text: Column = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    out = arrow(out, count, f"id {kind}, n_tokens long, n_bytes long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
