"""One query for each operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from atlasloom.llm import (
    byte_pairs,
    decontamination,
    exact_copies,
    language,
    main_text,
    manifest,
    near_copies,
    private_data,
    shards,
    spelling,
    token_files,
    toxicity,
    url_filter,
)
from atlasloom.llm.common import folder_for

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
MULTILINGUAL_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
SHARDS = 40
#: Host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder_for(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, BYTE_BPE)
    return token_files.with_checksum(token_files.read_tokens(spark, path))


def op2_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.find_private(table(spark, sf_dir, "documents"))


def op3_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"), SHARDS)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = decontamination.match_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.digest(matches)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prototypes = language.learn(docs.filter(~language.held_out()))
    return language.identify(docs, prototypes, language.held_out().alias("held_out"))


def op6_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_pairs.encode(table(spark, sf_dir, "documents"), MULTILINGUAL_BPE, PATTERN)
    return byte_pairs.digest(encoded, MULTILINGUAL_BPE, PATTERN)


def op7_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies.groups(table(spark, sf_dir, "documents"))


def op8_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_copies(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    grammar = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, grammar, toxicity.held_out().alias("held_out"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(table(spark, sf_dir, "pages"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_token_files, op2_private_data, op3_feistel_shards, op4_decontamination, op5_language, op6_byte_pairs, op7_exact_copies,
    op8_near_copies, op9_toxicity, op10_main_text, op11_spelling, op12_url_filter, op13_manifest)}

ORACLE: dict[str, str] = {
    "op4_decontamination": decontamination.DIGEST_SQL,
    "op7_exact_copies": exact_copies.GROUPS_SQL,
    "op11_spelling": spelling.VARIANTS_SQL,
    "op12_url_filter": url_filter.judge_sql(URL_RULES),
    "op13_manifest": manifest.MANIFEST_SQL,
}
