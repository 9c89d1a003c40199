"""A corpus pipeline: language, quality, exact copies, near copies, packing.

Each stage works on all rows its predecessor kept, written as Parquet and read again. Rows without a known
language, below the quality cut, copies and near copies go; what stays is packed into sequences.
"""

from pyspark.sql import DataFrame, SparkSession

from landtiles.llm import chosenpath, grace, language, packing, quality
from landtiles.session import scratch_path, ship_package

NEAR_PERCENT = 80  # similarity from which two documents count as near copies


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a letter, a language that is told with confidence, and fits that language."""
    ship_package(spark)
    trees = language.fit_languages(docs)
    return language.with_known_language(docs, trees, language.usual_rates(docs, trees))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at or above the quality cut, learned from the labels of documents that came this far."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.of_good_quality(docs, quality.fit_quality(docs, labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    ship_package(spark)
    return grace.without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar 5-word shingles the one with the smallest id."""
    ship_package(spark)
    return chosenpath.without_near_copies(docs, NEAR_PERCENT)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, with their ids and their places in sequences."""
    ship_package(spark)
    return packing.packed_ids(docs)


STAGES = [
    ("language_id", known_language),
    ("quality_classifier", good_quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("packing", packed),
]

ORACLE_SQL = None  # the stages are models, links and token ids; tests/llm compares them with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each intermediate result is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
