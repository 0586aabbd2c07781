"""A corpus run: language, quality, near-duplicates, benchmark leaks, packing. Each stage is written as Parquet and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vacancia.llm import bpe, decontamination, language_id, near_copies, packing, quality_classifier
from vacancia.llm.common import read_documents, stored


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found with a score of 0.5 or more."""
    return language_id.keep_identified(docs, language_id.train(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.3 or more, learned from the labels of those that came in."""
    return quality_classifier.keep_good(docs, quality_classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of texts whose sets of five-word shingles are 0.8 or more alike.

    Candidates are the groups that operator 4's SimHash links within four bits. Texts just 0.8 alike
    differ by about ten bits, so those of MinHash bands join them; whole shingle sets decide.
    """
    return near_copies.keep_one_of_each(docs, width=5)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage like a benchmark item."""
    return decontamination.keep_unleaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of at most 2048 ids."""
    return packing.pack(docs, bpe.default_path(), size=2048, end_id=1)


STAGES = [
    ("language_id", languages),
    ("quality_classifier", quality),
    ("simhash_dedup", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the last stage gives for the table documents of ``sf_dir``; labels and benchmark are read there too.

    Documents with a null or blank text have no language and go in the first stage. Of rows that share
    a doc_id one stays; an empty table gives no piece. Extra columns stay up to the last stage.
    """
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
