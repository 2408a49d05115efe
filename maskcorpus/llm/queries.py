"""Registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, embeddings, html_text, license_scan, lines, mixing, pieces, quality, repair, runs, simhash, url_filter, warc


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Conversation -7: texts that look like the template's own marks.
PROBE = [(-7, turn, role, "\\### Assistant: </turn> ok") for turn, role in enumerate(("user", "assistant"))]


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and the probe, formatted and read back: turn and loss digests, sizes."""
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE, turns.schema)
    return chat.read_back(chat.format_conversations(turns.unionAll(probe)))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint as 16 hex digits, component_id; 3-word shingles, 2 bits."""
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"), words=3, seed=42, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, main text and its length; the tree is trained on the labelled table at the start."""
    return html_text.extract(_read(spark, sf_dir, "pages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the counts, base_failed and the verdict of the adaptive thresholds."""
    return quality.judge(_read(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target and words taken; weights 1, 2, 3 in turn, at most three copies."""
    return mixing.mix(_read(spark, sf_dir, "documents"), seed=42)


def op6_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text; ``model`` is the vocabulary's path."""
    return pieces.digests(_read(spark, sf_dir, "documents"), model or public_tokenizers.path("piece_bpe_32k.model"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back: payload size and digest, record type, what a revisit refers to."""
    archives = warc.write_archives(_read(spark, sf_dir, "pages"))
    return warc.read_archives(archives, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "fault")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the best notice, its coverage, and all notices of every document; coverage 0.8."""
    return license_scan.summary(_read(spark, sf_dir, "documents"), coverage=0.8)


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept; cosine 0.95, four tables of 256 x 256 filters."""
    return embeddings.near_duplicates(_read(spark, sf_dir, "embeddings"), threshold=0.95)


#: (verdict, host and path) of the rules of op8.
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict, template and its purity.

    The labelled sample is the rows of ``labels`` whose id is a page's: bad
    if the quality is 0 or the text toxic.
    """
    labels = _read(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), F.expr("cast(quality = 0 or toxic = 1 as int)").alias("bad"))
    return url_filter.judge(_read(spark, sf_dir, "pages"), labels, RULES, max_depth=None)


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lines, dropped lines and digest of the kept text of every document."""
    return lines.summary(_read(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, number of runs, the longest run, digests of all runs and of the collapsed text of every document."""
    return runs.summary(_read(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, faults, cost and audit of the cheapest repair and the repaired rows' digest, after the contract's damage."""
    turns = _read(spark, sf_dir, "conversations")
    return repair.reports(repair.damaged(turns), every=turns)


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_html_extraction": op3_html_extraction,
    "op4_quality_rules": op4_quality_rules,
    "op5_mixing": op5_mixing,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_warc": op7_warc,
    "op8_url_filters": op8_url_filters,
    "op9_license_scan": op9_license_scan,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "op11_line_dedup": op11_line_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_conversation_repair": op13_conversation_repair,
}
