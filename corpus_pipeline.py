"""Five stages from raw documents to packed sequences. Each stage is written as Parquet and read by the next.

Stages take any table with the columns of ``documents``; NULLs, empty texts, repeated rows and further columns are handled
as the operators' docstrings say. Intermediate tables go to the shared folder of the cluster.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from adlake.llm import exact_dedup, jaccard_join, mixing, packing, quality_rules
from adlake.llm.common import read_table, start
from adlake.session import intermediate_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    start(spark)
    return quality_rules.keep(docs.select(*COLUMNS))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the longest stays."""
    start(spark)
    return exact_dedup.keep(docs.select(*COLUMNS))


def unlike_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by similar word shingles, the one with the smallest id stays."""
    start(spark)
    return jaccard_join.keep(docs.select(*COLUMNS))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, some of them not at all."""
    start(spark)
    return mixing.keep(docs.select(*COLUMNS))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    start(spark)
    return packing.pack(docs.select(*COLUMNS))


STAGES = [
    ("quality rules", good_documents),
    ("exact dedup", distinct_documents),
    ("n-gram Jaccard join", unlike_documents),
    ("mixing sources", mixed_documents),
    ("best-fit packing", packed_sequences),
]

# The last stage packs tokens of a subword vocabulary, which SQL cannot produce; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{intermediate_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        result.write.parquet(f"{folder}/{number}")
        docs = spark.read.schema(result.schema).parquet(f"{folder}/{number}")
    return docs
