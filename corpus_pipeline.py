"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's documents.  All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aquifer.llm import decontaminate, mixing, rules, simhash, substrings
from aquifer.llm.common import remove, shared_dir, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio.

    Null, empty and very short texts are rejected; repeated rows get one verdict; the
    columns come back as they came.
    """
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return rules.kept_documents(docs, trusted)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates.

    First is the smallest id, null last, then the smallest hash of the text, then of the
    row: which row arrives first decides nothing.  Null and empty texts are one group.
    """
    return simhash.first_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without passages that start earlier elsewhere.

    A null text stays null, one that is all repeats becomes empty; ``n_chars`` follows
    the text; the other columns come back as they came.
    """
    out = substrings.dedup(docs, keep=True)
    cols = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return out.select(*[cols.get(c, F.col(f"row.`{c}`") if c != "text" else None).alias(c) for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item, all columns as they came; null and empty texts have none."""
    return decontaminate.matches(docs, table(spark, sf_dir, "benchmark"), keep=True).where("not contaminated").select("row.*")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the words and epochs it takes of each.

    Null and empty texts have no words to take.  A column of the input that has the
    name of an added one keeps it; the added one's gets the prefix ``mix_``.
    """
    out = mixing.mix(docs, keep=True).where("taken > 0")
    held = {c.lower() for c in docs.columns}

    def free(name: str) -> str:
        return name if name not in held else free(f"mix_{name}")

    return out.select("row.*", *[(F.round(c, 6) if c == "target" else F.col(c)).alias(free(c)) for c in ("size", "source_size", "target", "taken", "epochs", "part")])


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources", source_mix),
]

#: The fingerprints' hash and the hashed n-gram ratio have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
        if k:
            remove(spark, f"{base}/{k - 1}")  # read for the last time
    return docs
