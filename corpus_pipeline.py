"""A corpus from raw documents to a training mix, one operator after another.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as
Parquet and read again as the documents of the next. All but the last return the
columns of documents; the last returns a row for each copy that the mix takes,
with copy, taken (words) and position besides. Every stage works on all that the
one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.llm import decontaminate, line_dedup, mixing, prob_minhash, quality
from lakeferry.llm.scratch import Scratch, free_name, read_table
from lakeferry.llm.shipping import shipped


@shipped
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality.trained(docs, read_table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).where("predicted = 1").select(*docs.columns)


@shipped
def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand elsewhere before, or all but an edit of them, go.

    So do documents that lines were removed from, if no line is left but blank ones.
    """
    removed = free_name(docs, "removed")
    kept = line_dedup.lines_removed(docs, removed=removed)
    kept = kept.where((F.size(removed) == 0) | F.col("text").rlike(r"(?U)\S"))
    # a text without removals keeps its n_chars, whatever that is
    changed = F.when(F.size(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", changed).select(*docs.columns)


@shipped
def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return prob_minhash.near_duplicates_removed(docs)


@shipped
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


@shipped
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights, in training order."""
    return mixing.mixed(docs)


STAGES = [
    ("quality", good_documents),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", without_near_duplicates),
    ("decontaminate", without_benchmark),
    ("mix", mix),
]

#: No SQL expresses the trained and the sketching stages; they are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    scratch = Scratch(spark)
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs
