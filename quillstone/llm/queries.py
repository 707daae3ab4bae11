"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, html_text, langid, media, mixing, pii, quality, secret_scan, simhash, tokencount
from .common import read_table
from .sql import SQL  # noqa: F401


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.cluster(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "documents"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencount.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = media.MediaStore.write(read_table(spark, sf_dir, "documents"))
    return store.read().select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.assign(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "shards")


def _of_kind(spans: str, kind: int) -> F.Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _per_kind(kinds: tuple[str, ...], spans: str) -> dict:
    return {f"n_{k}": _of_kind(spans, i) for i, k in enumerate(kinds)}


def _joined(kinds: tuple[str, ...], spans) -> F.Column:
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("spans", lambda s: s["kind"] < pii.BASE)
    return found.select("doc_id", *[c.alias(n) for n, c in _per_kind(pii.KINDS[: pii.BASE], "spans").items()], F.sha2(_joined(pii.KINDS, base), 256).alias("base_sha256"), _joined(pii.KINDS, F.col("spans")).alias("spans"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return found.select("doc_id", *[c.alias(n) for n, c in _per_kind(secret_scan.KINDS[:3], "base_spans").items()], F.sha2(_joined(secret_scan.KINDS, F.col("base_spans")), 256).alias("base_sha256"), _joined(secret_scan.KINDS, F.col("spans")).alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_simhash, op2_quality, op3_langid, op4_html, op5_tokens, op6_media, op7_mixing, op8_pii, op9_bpe, op10_secrets)}


