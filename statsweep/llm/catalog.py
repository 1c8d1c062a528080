"""The registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (block_dedup, decontaminate, html_text, license_scan, ngram_join, packing, prefix_trie, quality, run_detection, sentencepiece_bpe, toxicity,
               url_filter, warc)
from .common import read_table

MODEL = "piece_bpe_32k.model"
BYTES = "byte_bpe_50k.json"


def fold(n: int):
    """Remainder of the CRC-32 of the id's text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under the 4-word shingle Jaccard join."""
    return ngram_join.jaccard_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of the rows with fold(5) = 0 are held out of the training."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality").where(fold(5) != 0)
    scored = quality.classify_quality(read_table(spark, sf_dir, "documents").select("doc_id", "text"), labels)
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered text of every page."""
    return html_text.extract_text(read_table(spark, sf_dir, "pages").select("page_id", "html"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page URL, by rule or by boosted trees."""
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document under the public merge-type vocabulary."""
    return sentencepiece_bpe.tokenize(read_table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path(MODEL))


def responses(pages: DataFrame) -> DataFrame:
    """Pages as WARC response records: an id, the URI, a date and the HTTP response with the page as payload."""
    md5 = F.md5(F.concat_ws(" ", F.col("page_id").cast("string"), "url"))
    uuid = F.concat_ws("-", *[F.substring(md5, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    head = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nServer: archive\r\n\r\n")
    return pages.select("page_id", F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">")).alias("record_id"), F.col("url").alias("target_uri"),
                        F.lit("2024-01-01T00:00:00Z").alias("date"), F.concat(head, F.coalesce("html", F.lit(""))).cast("binary").alias("block"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the metadata and conversion records of every page's response."""
    return warc.build_derivatives(responses(read_table(spark, sf_dir, "pages")), content=False)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of the rows with fold(4) = 2 are held out of the training."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold(4) != 2))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", (fold(4) == 2).alias("held_out"), "score", "predicted", F.size("spans").alias("n_spans"))


def op8_block_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copy that stays, for every document."""
    return block_dedup.block_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found inside documents, and how much of each."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and template matches of every document."""
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def repeat_words(doc_id, words: list[bytes]) -> list[bytes]:
    """The words of a document whose id's CRC-32 ends in 0, repeated with a period from some place on; others as they are."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def op11_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document's words, the longest one, and the text without the repeats."""
    found = run_detection.detect_runs(read_table(spark, sf_dir, "documents").select("doc_id", "text"), repeat_words)
    top = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("back"), r.start.alias("start"), r.period.alias("period"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")), F.lit("\n")))
    return found.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("top.start").alias("start"), (-F.col("top.back")).alias("length"),
        F.col("top.period").alias("period"), F.expr("-1000 * top.back div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2,048 tokens."""
    pieces = packing.pack(read_table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path(BYTES))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of the conversations, with their heads taken from their group's first one."""
    ordered = prefix_trie.order_turns(read_table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(*prefix_trie.graft_heads(ordered))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_ngram_join, op2_quality, op3_html_text, op4_url_filter, op5_sentencepiece, op6_warc, op7_toxicity, op8_block_dedup, op9_decontaminate, op10_license_scan,
                              op11_run_detection, op12_packing, op13_prefix_trie)}

ORACLE: dict[str, str] = {"op8_block_dedup": block_dedup.ORACLE, "op9_decontaminate": decontaminate.ORACLE, "op13_prefix_trie": prefix_trie.ORACLE}
