"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes what its predecessor kept, written as Parquet and read again.
A doc_id is one document: rows under one id stay or go together, except in the
quality stage, which judges every row by its own text. Rows with a null doc_id
are never dropped by a decision on ids. Extra columns travel along to the last
stage, which returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm import jaccard_join, lang_fusion, packing, ranking, suffix_dedup
from shelfcast.llm.common import documents, fold, small_batches, stage, without_ids
from shelfcast.llm.queries import WORD_BPE


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking predicts good. It learns from labels
    outside the held-out fold."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return ranking.keep_good(docs, ranking.fit_from_labels(docs, labels, fold("doc_id", 5) != 0))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that the fused evidence accepts."""
    small_batches(spark)
    found = lang_fusion.identify_documents(docs, lang_fusion.fit_text_model(docs))
    return without_ids(docs, stage(found.where(~F.col("accepted")).select("doc_id"), "no-language"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest doc_id. Near
    are sets of five-word shingles of similarity 0.8 or more; op8's contract,
    four words and 0.85, binds that query only."""
    small_batches(spark)
    found = jaccard_join.similar_groups(docs, percent=80, n=5)
    return without_ids(docs, stage(found.where("doc_id != component_id").select("doc_id"), "near-copies"))


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with what is left of its text; n_chars follows it. A text
    of which nothing is left is empty."""
    small_batches(spark)
    out = suffix_dedup.without_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    small_batches(spark)
    return packing.pack_documents(docs, WORD_BPE)


STAGES = [
    ("quality classifier", good_quality),
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("suffix-array dedup", without_repeated_passages),
    ("best-fit packing", packed),
]

#: Fitted models, suffixes and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
