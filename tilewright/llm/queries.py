"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tilewright.llm import bpe_codec, nn_descent, order_minhash, packing, quality_rules, secret_scan, token_counts, token_records, url_filter, warc
from tilewright.llm.sql import QUALITY_SQL, URL_SQL, WARC_SQL

RULES = [url_filter.Rule("block", "net/"), url_filter.Rule("allow", "example.net/en/"), url_filter.Rule("block", "example.com/de/"), url_filter.Rule("allow", "org/fr/")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and link-graph verdict of every page."""
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), RULES).drop("trust", "distrust")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded by byte-level BPE ranks."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_codec.round_trip_digests(table(spark, sf_dir, "documents"), ["doc_id"], path, public_tokenizers.PATTERN)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token count of every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), ["doc_id"], public_tokenizers.path("piece_bpe_32k.model"))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    classes = order_minhash.near_classes(table(spark, sf_dir, "documents"))
    return classes.withColumn("kept", classes["doc_id"].eqNullSafe(classes["class_id"]))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and verdict of every document."""
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"), ["doc_id"])


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and decision of every vector."""
    return nn_descent.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written as binary records and read back."""
    return token_records.write_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 1024 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), ["doc_id"], public_tokenizers.path("byte_bpe_50k.json"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    return secret_scan.span_digests(table(spark, sf_dir, "documents"), ["doc_id"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_url_filter, op2_warc, op3_byte_bpe, op4_token_counts, op5_order_minhash, op6_quality_rules, op7_nn_descent, op8_token_records, op9_packing, op10_secret_scan]
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": URL_SQL, "op2_warc": WARC_SQL, "op6_quality_rules": QUALITY_SQL}
