"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import language, quality
from siltstone.llm.common import settled, table
from siltstone.llm.mixing import mixed_documents
from siltstone.llm.packing import packed_documents
from siltstone.llm.simhash import one_of_each


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from their labels, does not reject.

    Texts too short to judge stay. Without labelled documents all stay.
    """
    return quality.good_only(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; texts without letters and ambiguous ones go."""
    return language.with_language(docs, language.train(docs))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return one_of_each(docs, shingle=4, distance=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return packed_documents(docs, "word_bpe_49k.json", end=0, capacity=2048)


STAGES = [
    ("quality classifier", keep_good),
    ("language ID", keep_identified),
    ("SimHash near-dedup", keep_one_of_each),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: Tokenizers and trained models are beyond SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = settled(docs, f"pipeline-{number}")
    return docs
