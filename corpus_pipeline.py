"""Documents to training tokens: quality rules, near-dedup, secret redaction, source mixing, BPE encoding.

Each stage works on all that the one before has kept, written as Parquet and read again; all but the last return the
columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillstone.llm import bpe, mixing, near_copies, quality, secret_scan
from quillstone.llm.common import read_table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, Jaccard similarity of 0.8) stays.

    They meet by SimHash and anchor-point covering; what lies beyond it is found by an exact prefix filter.
    """
    return near_copies.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced."""
    return secret_scan.redact(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix draws it."""
    return mixing.mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each row, with the digests of the ids and of the bytes that they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), path, public_tokenizers.PATTERN, ids="tokens")


STAGES = [("quality rules", quality_rules), ("near dedup", near_dedup), ("secret scans", secrets), ("mixing sources", mixing_sources), ("byte-level BPE", encoding)]

#: Fingerprints and BPE have no SQL; tests/llm/test_pipeline.py holds the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
