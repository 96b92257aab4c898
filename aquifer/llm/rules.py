"""Quality rules with a hashed n-gram likelihood ratio, with DataFrame operations only.

Words and pairs of words are hashed to buckets.  The trusted target's and the raw
corpus's bucket counts, brought to one total and smoothed alike, are two
multinomials; a document's score is the mean log ratio of its n-grams, in which
buckets that are too rare to tell count about 0.  Documents that fail the base rules, or whose score
is below ``least``, are not kept.  Every document gets the same arithmetic in the
same order, so a rerun decides alike.

The raw corpus is every document; the target is every document with a trusted id.
Documents meet the ids in a shuffled join that hashes the ids, so no text is sorted
and no list of ids is broadcast.  The table of ratios is one row of ``buckets``
numbers, a scalar subquery of the plan that scores documents.

The verdict itself is computed inside each document's row and shuffles nothing.

Edge cases: null and empty texts have no words and fail the base rules; a text of any
length is judged whole, in its row; without a trusted document all ratios are 0 and
the base rules alone decide; null ids are trusted by nothing; repeated rows each get
a row and each count; an id trusted twice counts once; an empty table gives no rows;
other columns, whatever their names, come back as they were where rows are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BREAKS, whole_row, words

#: Characters counted as symbols: a fixed value.
SYMBOLS = "#*$%&|<>"


def _tokens(rows: DataFrame) -> DataFrame:
    """One row for each word: pos, and the hashes one (the word) and two (with its neighbour; null at the end).

    The array ``words`` stays in reach of compiled code; nothing is gathered.
    """
    rows = rows.select("*", F.posexplode_outer("words").alias("pos", "word"))
    after = F.get("words", F.col("pos") + 1)
    two = F.when(after.isNotNull(), F.xxhash64("word", after))
    return rows.withColumn("one", F.xxhash64("word")).withColumn("two", two)


def ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = 1 << 16, smooth: float = 4.0) -> DataFrame:
    """One row: table, the log ratio of each bucket's share in the target and in the corpus."""
    ids = trusted.select(F.col(id_col).alias("doc_id"), F.xxhash64(id_col).alias("salt")).where("doc_id is not null").distinct().withColumn("good", F.lit(1))
    # documents without an id meet nothing: the salt deals them out instead of to one task
    salt = F.when(F.col(id_col).isNull(), F.xxhash64(text_col)).otherwise(F.xxhash64(id_col))
    flagged = docs.select(F.col(id_col).alias("doc_id"), salt.alias("salt"), F.col(text_col).alias("text")).join(ids.hint("shuffle_hash"), ["doc_id", "salt"], "left")
    grams = _tokens(flagged.select("good", words(F.col("text")).alias("words"))).where("word is not null")
    grams = grams.select("good", F.explode(F.array("one", "two")).alias("gram")).where("gram is not null")
    counts = grams.groupBy(F.pmod("gram", F.lit(buckets)).cast("int").alias("bucket")).agg(F.count("*").alias("raw"), F.count("good").alias("good"))
    return ratio_table(counts, buckets, smooth)


def ratio_table(counts: DataFrame, buckets: int, smooth: float) -> DataFrame:
    """One row: table, from counts of buckets (bucket, raw, good).  Shares are doubles before they meet a count, so no product of counts overflows."""
    full = counts.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(F.broadcast(counts), "bucket", "left").na.fill(0)  # ``buckets`` rows
    row = full.agg(F.sort_array(F.collect_list(F.struct("bucket", "raw", "good"))).alias("c"), F.sum("raw").alias("raws"), F.sum("good").alias("goods"))
    ratio = lambda x: F.when(F.col("goods") > 0, F.log((x["good"] + smooth) / (x["raw"] * (F.col("goods") / F.col("raws")) + smooth))).otherwise(0.0)
    return row.select(F.transform("c", lambda x: F.round(ratio(x), 6)).alias("table"))


def _judged(rows: DataFrame, table: Column, least: float, buckets: int) -> DataFrame:
    """``rows`` (with a column text) and the verdict's columns; everything is computed inside the row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = rows.withColumn("words", words(F.col("text")))
    # hashes of five consecutive words at each place
    after = F.transform("words", lambda w, i: F.xxhash64(w, *[F.get("words", i + k) for k in range(1, 5)]))
    rows = rows.withColumn("windows", F.slice(after, 1, F.greatest(F.lit(0), F.size("words") - 4)))
    rows = rows.withColumn("lines", F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(" " + BREAKS)) != ""))
    # windows with an equal one, by place; each covers five words, less what the next one covers
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("sorted", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed))
    s = F.col("sorted")
    twin = F.transform(s, lambda x, i: F.when((F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]), x["i"]))
    rows = rows.withColumn("places", F.when(s.isNotNull(), F.sort_array(F.filter(twin, lambda x: x.isNotNull()))))
    p = F.col("places")
    covered = F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(5), F.coalesce(F.get(p, i + 1) - x, F.lit(5)))), F.lit(0), lambda a, x: a + x)
    # buckets of the words and of their pairs with the next word
    bucket = lambda h: F.pmod(h, F.lit(buckets)).cast("int")
    pairs = F.transform("words", lambda w, i: bucket(F.xxhash64(w, F.get("words", i + 1))))
    grams = F.concat(F.transform("words", lambda w: bucket(F.xxhash64(w))), F.slice(pairs, 1, F.greatest(F.lit(0), F.size("words") - 1)))
    # a lambda may not be written with a subquery, so the table is a column of one use: the optimizer puts the subquery there, and no row holds it
    rows = rows.withColumn("grams", grams).withColumn("table", table)
    total = F.aggregate(F.transform("grams", lambda g: F.get(F.col("table"), g)), F.lit(0.0), lambda a, x: a + x)
    rows = rows.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
            "total": total,
        }
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = rows.withColumns({"base_failed": failed, "score": F.col("total") / F.greatest(F.lit(1), 2 * F.col("n_words") - 1)})
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= least))


VERDICT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def _above(rows: DataFrame, first: str, *columns: str) -> DataFrame:
    """The columns by way of a one-row generator.  Filters on them stay above it: pushed down, they would compute the verdict's parts once more for each use."""
    return rows.select(first, F.explode(F.array(F.struct(*columns))).alias("v_")).select(first, "v_.*")


def judge(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = -0.2, buckets: int = 1 << 16) -> DataFrame:
    """``id_col``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score and kept."""
    # a subquery's value, ``buckets`` numbers: it reaches the tasks as a constant, but stands in no plan
    table = ratios(docs, trusted, id_col, text_col, buckets).scalar()
    rows = _judged(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), table, least, buckets)
    verdict = _above(rows, "id", *VERDICT)
    return verdict.select(F.col("id").alias(id_col), *VERDICT)


def kept_documents(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = -0.2, buckets: int = 1 << 16) -> DataFrame:
    """The rows of ``docs``, all columns as they came, that :func:`judge` keeps.

    The verdict is computed inside the row, at any size in the same way: nothing is joined back.
    """
    table = ratios(docs, trusted, id_col, text_col, buckets).scalar()
    rows = _judged(docs.select(whole_row(docs).alias("row"), F.col(text_col).alias("text")), table, least, buckets)
    return _above(rows, "row", "kept").where("kept").select("row.*")
