"""Registered queries of the operators in this folder, one for each, over their whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adlake.llm import (
    chosen_path,
    exact_dedup,
    filter_audit,
    jaccard_join,
    line_dedup,
    mixing,
    packing,
    quality_pu,
    quality_rules,
    suffix_dedup,
    toxicity,
    url_filter,
    whitening,
)
from adlake.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def wrap(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle.strip()
        return fn

    return wrap


@query(quality_rules.oracle())
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules for every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).drop("text")


@query(exact_dedup.ORACLE)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which copy of every text stays."""
    return exact_dedup.deduplicate(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mixing.mix(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.classify(docs, read_table(spark, sf_dir, "labels").select("doc_id", "toxic"))


@query()
def op8_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_pu.classify(docs, read_table(spark, sf_dir, "labels").select("doc_id", "quality"))


@query()
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    return url_filter.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"))


@query()
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 4096 tokens."""
    return packing.pack(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document by Jaccard links of its word shingles."""
    return jaccard_join.join(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which lines of every document repeat an earlier line, or nearly so."""
    return line_dedup.deduplicate(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without the strings of 100 bytes that start earlier elsewhere."""
    return suffix_dedup.deduplicate(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four leading whitened components of every embedding, fitted on the distinct vectors."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query(filter_audit.ORACLE)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove per source, in every order."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return filter_audit.audit(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"), labels)


@query()
def op12_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document by near-equal word shingles, and whether it stays."""
    return chosen_path.deduplicate(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
