"""A training-data pipeline over ``documents``: quality rules, near-duplicates, source mix, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from maskcorpus.llm import mixing, pieces, quality, simhash
from maskcorpus.llm.storage import staged

SEED = 42
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the adaptive thresholds; the others go."""
    return quality.keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group linked by fingerprints at most two bits apart."""
    return simhash.drop_near_duplicates(docs, words=3, seed=SEED, radius=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: sources weigh 1, 2, 3 in turn, three copies at most."""
    return mixing.mixed(docs, seed=SEED)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every row of the mix."""
    return pieces.digests(docs, MODEL)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", mix_sources),
    ("encode_pieces", encode_pieces),
]

#: SQL has neither XXH64 nor the vocabulary's segmentation; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
