"""A corpus pipeline of five stages over ``documents``: quality, near-duplicates, secrets, mix, tokens.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``docs``.  Nulls, empty texts, ties, repeated rows, empty tables and extra columns behave as the
operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capsight.llm import bpe, mixing, ngram_join, quality, secrets
from capsight.llm.common import fresh, materialize, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (score at or over its threshold)."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    name = fresh(docs, "_quality")
    return quality.score(docs, model, out=name).filter(F.col(name) >= quality.THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group of linked documents; repeated rows stay once.

    Documents without words are linked with nothing and stay, as do rows without id.
    """
    groups = ngram_join.ngram_join(docs)
    kept = groups.filter("doc_id = component_id").select("doc_id").distinct()
    name = fresh(docs, "_key")
    once = docs.join(kept, "doc_id", "left_semi").withColumn(name, F.xxhash64("text")).dropDuplicates(["doc_id", name])
    return once.select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    model = secrets.train(secrets.labelled_findings(spark))
    found = materialize(secrets.scan(docs, model).filter("is_secret"), "secrets")
    return secrets.redact(docs, found)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, their texts holding the words that the mix takes."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed little-endian unsigned 32-bit integers) and digests of every document."""
    return bpe.tokenize(docs, bpe.vocabulary_path(), ids=True)


STAGES = [
    ("quality classifier", quality_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secret_redaction),
    ("mixing sources to target weights", source_mix),
    ("byte-level BPE encoding and decoding", tokens),
]

#: A trained classifier, a forest, draws and a tokenizer are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = materialize(docs, f"stage-{k}")
    return docs
