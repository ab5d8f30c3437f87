"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays,
sources are mixed to their target weights, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every
stage's rows to the shared checkpoint folder and reads them again for the next one.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobmart.llm import mixing, ngram_join, packing, toxicity
from jobmart.llm.common import materialize, read_table, ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic."""
    ship_package(spark)
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by Jaccard similarity of five-word shingles."""
    ship_package(spark)
    return ngram_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it (0 to 3 times)."""
    ship_package(spark)
    return mixing.apply_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset."""
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard_join", near_duplicates), ("mix_sources", mix), ("best_fit_packing", pack)]

# a trained classifier, MinHash and a genetic algorithm are not SQL: tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over table ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
