"""How far the sources of a language differ in the words they use.

Terms are counted for each language and source; terms with the same counts in all of a
language's sources, that is with equal sparse vectors, are one vector with a
multiplicity.  What depends on counts only is evaluated once for each vector: the
distance of each two sources that have it in at least one of them, times the
multiplicity (terms that neither has add the same each, so they are counted, not
visited), and the distance of each source from its language.  Only the ranking goes
back to the terms, and of a vector's terms only as many as a ranking shows can be in it.

Distances are triangular discriminations of smoothed shares in parts of 10^9, all in
whole numbers.  Shares are found by long division in steps of 1,000, so nothing
overflows up to 9 * 10^15 words a language.

A task counts whole texts into tables of a bounded number of entries, so a frequent
word travels once a table and source.  Counts meet by language, term and source first,
and only their sums by language and term.  Facts about languages join without a hint:
Spark broadcasts them where their size allows it and shuffles with its handling of
skew where not.

Edge cases: null text, language and source are empty strings; a text of any length is
counted whole; a group without terms has a row for each other source; a language
without kept terms has distances of 0 and no terms; repeated rows count each; ties
stand in the order of their UTF-8 bytes; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow, cut

#: Letters, lower-cased, and bytes of characters beyond ASCII; all else separates terms.
LETTERS = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


#: Counts and shares that are looked at together.
CELLS = 1 << 19


def _tally(entries: int):
    """lang, source, term, n (occurrences) and d (documents) of stretches of input; a row without a term says that a group is there."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, d) in seen.items():
                terms = [None, *n]
                k = len(terms)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()), pa.array(terms, pa.binary()), pa.array([0, *n.values()], pa.int64()), pa.array([0, *map(d.__getitem__, n)], pa.int64())], ["lang", "source", "term", "n", "d"])
            seen.clear()

        for b in batches:
            for lang, source, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                if (group := seen.get((lang, source))) is None:
                    group = seen[lang, source] = Counter(), Counter()
                terms = x.as_py().translate(LETTERS).split()
                held -= len(group[0])
                group[0].update(terms)
                group[1].update(set(terms))
                held += len(group[0])
                if held > entries:
                    yield from rows()
                    held = 0
        yield from rows()

    return work


def counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = 10, entries: int = 200_000) -> DataFrame:
    """lang, term and vector (source and n, by source) of each kept term; the row of a language without a term has all its sources, with 0."""
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))], F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    found = arrow(plain, _tally(entries), "lang string, source string, term binary, n long, d long")
    found = found.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    found = found.groupBy("lang", "term").agg(F.sum("d").alias("d"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("vector"))  # one entry a source
    return found.where((F.col("d") >= least) | F.col("term").isNull()).select("lang", "term", "vector")


def languages(kept: DataFrame) -> DataFrame:
    """One row a language: v (kept terms), total (their occurrences) and sources (source and n, by source)."""
    per = kept.select("lang", F.explode("vector").alias("x")).groupBy("lang", "x.source").agg(F.sum("x.n").alias("n"))
    per = per.groupBy("lang").agg(F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("sources"))  # one entry a source
    return per.join(kept.groupBy("lang").agg(F.count("term").alias("v")), "lang")


def share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 v)), by long division."""
    b = F.greatest(total + 2 * v, F.lit(1).cast("long"))
    over = lambda x: F.call_function("div", x, b)
    rest, out = n + 2, F.lit(0).cast("long")
    for _ in range(3):
        out, rest = out * 1000 + over(rest * 1000), F.pmod(rest * 1000, b)
    return out + 1


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def vectors(kept: DataFrame, top: int) -> DataFrame:
    """lang, vector, m (its terms) and terms, the first ``top`` of them."""
    # the hash comes first, so that sorts seldom compare vectors
    same = ["hash", "lang", "vector"]
    kept = kept.where("term IS NOT NULL").withColumn("hash", F.xxhash64("vector"))
    order = Window.partitionBy(*same).orderBy("term")
    first = kept.withColumn("k", F.row_number().over(order)).where(F.col("k") <= top).groupBy(*same).agg(F.sort_array(F.collect_list("term")).alias("terms"))
    return kept.groupBy(*same).agg(F.count(F.lit(1)).alias("m")).join(first, same).drop("hash")


def _ranked(rows: DataFrame, top: int | None = None) -> DataFrame:
    """Adds the rank of items in their group; ``item`` is binary, which sorts as UTF-8."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rows = rows.withColumn("rank", F.row_number().over(order))
    return rows if top is None else rows.where(F.col("rank") <= top)


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank."""
    kept = cut(counts(docs, text_col, lang_col, source_col, least), "terms")
    langs = cut(languages(kept), "languages")
    found = cut(vectors(kept, top).join(langs, "lang").withColumn("dense", _dense()).drop("sources"), "vectors")
    return _pairs(found, langs).unionByName(_terms(found, top)).select("lang", "source", "part", F.col("item").cast("string").alias("item"), "value", "rank")


def _dense() -> Column:
    """Every source of the language with the vector's count and share there."""
    n = F.map_from_entries("vector")
    return F.transform("sources", lambda s: F.struct(s["source"].alias("source"), F.coalesce(F.try_element_at(n, s["source"]), F.lit(0)).alias("n"), share(F.coalesce(F.try_element_at(n, s["source"]), F.lit(0)), s["n"], F.col("v")).alias("p")))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each two sources of a language, i < j by their place, the distance over a batch's vectors that either has, and the terms of those."""
    for b in batches:
        langs = b.column(0).to_numpy(zero_copy_only=False)
        m, edge = b.column(1).to_numpy(), b.column(2).offsets.to_numpy()
        n, p = (b.column(k).flatten().to_numpy() for k in (2, 3))
        base = edge[0]
        for lang in dict.fromkeys(langs):
            own = np.flatnonzero(langs == lang)
            k = int(edge[own[0] + 1] - edge[own[0]])  # a language's vectors have one length
            for c in range(0, len(own), most := max(1, CELLS // k)):
                rows = own[c : c + most]
                at = edge[rows][:, None] - base + np.arange(k)
                has, share, times = n[at] > 0, p[at], m[rows][:, None]
                for i in range(k - 1):
                    either = has[:, i + 1 :] | has[:, i : i + 1]
                    some = either.any(1)
                    either, other, q = either[some] * times[some], share[some, i + 1 :], share[some, i : i + 1]
                    seen = either.sum(0)
                    value = ((other - q) ** 2 // (other + q) * either).sum(0)
                    j = np.flatnonzero(seen)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(j), pa.string()), pa.array(np.full(len(j), i, np.int32)), pa.array((j + i + 1).astype(np.int32)), pa.array(value[j]), pa.array(seen[j])], ["lang", "i", "j", "value", "seen"])


def _pairs(found: DataFrame, langs: DataFrame) -> DataFrame:
    """Each source's distances from the others of its language."""
    plain = found.select("lang", "m", F.transform("dense", lambda d: d["n"]).alias("n"), F.transform("dense", lambda d: d["p"]).alias("p"))
    sums = arrow(plain, _sums, "lang string, i int, j int, value long, seen long").groupBy("lang", "i", "j").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    # every two sources, and what a term adds that neither has
    none = langs.select("lang", "v", F.transform("sources", lambda s: F.struct(s["source"].alias("source"), share(F.lit(0), s["n"], F.col("v")).alias("p"))).alias("s"))
    none = none.select("lang", "v", "s", F.posexplode("s").alias("i", "a")).select("lang", "v", "i", "a", F.posexplode("s").alias("j", "b")).where("i < j")
    both = none.join(sums, ["lang", "i", "j"], "left")
    value = F.coalesce("value", F.lit(0)) + (F.col("v") - F.coalesce("seen", F.lit(0))) * apart(F.col("a.p"), F.col("b.p"))
    sides = F.array(F.struct("a.source", F.col("b.source").alias("item")), F.struct(F.col("b.source").alias("source"), F.col("a.source").alias("item")))
    rows = both.select("lang", value.alias("value"), F.explode(sides).alias("s")).select("lang", "s.source", F.lit("pair").alias("part"), F.col("s.item").cast("binary").alias("item"), "value")
    return _ranked(rows)


def _terms(found: DataFrame, top: int) -> DataFrame:
    """The terms of each source that set it most apart from its language."""
    q = share(F.aggregate("vector", F.lit(0).cast("long"), lambda a, x: a + x["n"]), F.col("total"), F.col("v"))
    over = F.filter("dense", lambda s: (s["n"] > 0) & (s["p"] > F.col("q")))
    rows = found.withColumn("q", q).select("lang", "terms", "q", F.explode(over).alias("s"))
    rows = rows.select("lang", "s.source", F.lit("term").alias("part"), F.explode("terms").alias("item"), apart(F.col("s.p"), F.col("q")).alias("value"))
    return _ranked(rows, top)
