"""The queries of this subpackage, as registered, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm import conversations, licenses, media, mixing, packing, personal, quality_fm, quality_rules, simhash, spelling, token_counts, token_store, toxicity
from cellweave.llm.common import documents, fresh_path


def table_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.severity(docs, toxicity.train(docs, table_of(spark, sf_dir, "labels")))


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "media")
    media.store(documents(spark, sf_dir), path)
    return media.payloads(spark.read.schema("doc_id long, n_bytes long, media binary").parquet(path))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), fresh_path(spark, "token-cache"), limit=512)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex_of(found.fp).alias("fingerprint"), "component_id")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return licenses.scan(docs, licenses.train(docs))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    token_store.write_files(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), path, end_id=1)
    return token_store.read_files(spark, path).drop("ids")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(documents(spark, sf_dir).select("doc_id", "text", "source", "lang"))
    named = {"doc_id": "doc_id", "cell_source": "source", "cell_lang": "lang", "cell_topic": "topic", "cell_tokens": "n_tokens", "cell_kept": "kept"}
    rounded = [F.round(f"cell_{c}", 6).alias(c) for c in ("weight", "probability")]
    return found.select(*[F.col(a).alias(b) for a, b in named.items()], *rounded)


def op9_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_fm.score(docs, quality_fm.train(docs, table_of(spark, sf_dir, "labels")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(documents(spark, sf_dir))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.scan(documents(spark, sf_dir))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(table_of(spark, sf_dir, "conversations"))


ALL = (op1_toxicity, op2_media, op3_token_counts, op4_packing, op5_simhash, op6_licenses, op7_token_store, op8_mixing, op9_quality_fm, op10_quality_rules, op11_spelling, op12_pii, op13_conversations)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in ALL}
ORACLE_SQL: dict[str, str] = {"op8_mixing": mixing.oracle_sql(), "op11_spelling": spelling.oracle_sql()}
