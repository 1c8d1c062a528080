"""Corpus pipeline: toxic documents go, exact copies go, near copies go, benchmark leaks go, the rest is tokenised.

``STAGES`` lists the stages; each takes ``(spark, docs, sf_dir)``. ``run`` applies them to ``documents``, with each
stage's result written to the shared folder and read again. Every row is judged by its own text: of a group of copies
one row stays, and rows with a null id are dropped like others.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statsweep.llm import block_dedup, decontaminate, ngram_join, sentencepiece_bpe, toxicity
from statsweep.llm.common import read_table, save


def _drop(docs: DataFrame, name: str, decide: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``docs`` without the rows whose ``doc_id`` ``decide(rows of doc_id, text)`` returns.

    If ids are repeated or null, the rows are written with a number each, rising with the id (null last), that stands
    for the id in the decision and in the join back.
    """
    rows, key = docs, "doc_id"
    if not docs.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1").isEmpty():
        # the second sort key spreads a frequent id over tasks
        ordered = docs.withColumn("__at", F.monotonically_increasing_id()).orderBy(F.col("doc_id").asc_nulls_last(), "__at").drop("__at")
        rows, key = save(ordered.withColumn("__row", F.monotonically_increasing_id()), "rows"), "__row"
    ids = save(decide(rows.select(F.col(key).alias("doc_id"), "text")).select("doc_id"), name)
    return decontaminate.drop_ids(rows, ids, key).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity field accepts. It learns from the labelled documents among ``docs``."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model, keep=docs.columns, spans=False, prefix="__")
    return scored.where("__predicted = 0").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, one with the smallest id."""
    return _drop(docs, "copies", lambda rows: block_dedup.block_dedup(rows).where(~F.col("kept")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of the five-word shingle Jaccard join (0.8) one row stays, one with the smallest id."""
    return _drop(docs, "near-copies", lambda rows: ngram_join.jaccard_components(rows, n=5, link=80).where("doc_id <> component_id"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text holds no benchmark item."""
    items = read_table(spark, sf_dir, "benchmark")
    return _drop(docs, "leaks", lambda rows: decontaminate.find_leaks(rows, items).select("doc_id").distinct())


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document left."""
    return sentencepiece_bpe.tokenize(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("n-gram Jaccard join", drop_near_copies),
          ("benchmark decontamination", drop_leaks), ("sentencepiece", tokenize)]

ORACLE_SQL = None  # the toxicity field and the vocabulary's merges are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
