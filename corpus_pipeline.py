"""A training corpus in five stages: quality, near duplicates, benchmark passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it as Parquet in the shared folder and
reads it back as the next stage's docs. All stages but the last return the columns of `documents`.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadrank.llm import decontaminate, packing, quality_votes, secret_scan, simhash
from leadrank.llm.common import table
from leadrank.session import stage_table

#: Column that tells the rows of a stage apart.
ROW = "_corpus_row"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbours' votes do not reject. Empty texts get the base rate of label 1."""
    model = quality_votes.fit(docs, table(spark, sf_dir, "labels"))
    return quality_votes.kept(docs, model)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of the SimHash operator, with its own shingle length and bit distance.

    It is the row with the smallest doc_id, and of those with the smallest hash; rows without an id come last. Different
    texts under one id are judged apart; of rows that are equal in all columns one stays. Texts without words (null,
    blank, empty) have fingerprint zero, so all of them are one group and one stays.
    """
    rows = docs.withColumn(ROW, F.xxhash64(*docs.columns))
    chosen = simhash.chosen(rows, ROW).select(F.col("doc_id").alias("_corpus_id"), F.col("row").alias("_corpus_chosen"))
    same = F.col("doc_id").eqNullSafe(F.col("_corpus_id")) & (F.col(ROW) == F.col("_corpus_chosen"))
    return rows.join(chosen, same, "left_semi").dropDuplicates(["doc_id", ROW]).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage. Rows without an id are judged as well, by their texts."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mask; n_chars is that of the new text."""
    redacted = secret_scan.redacted(docs, secret_scan.fit(docs))
    return redacted.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a packed sequence of 2048 tokens."""
    return packing.pack(docs)


STAGES = [("quality classifier", quality_classifier), ("simhash near-dedup", simhash_near_dedup),
          ("benchmark decontamination", benchmark_decontamination), ("secret scans", secret_scans),
          ("best-fit packing", best_fit_packing)]

#: No stage of learnt scores or token ids can be written in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
