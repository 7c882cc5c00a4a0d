"""From raw documents to packed sequences: quality rules, toxicity, near duplicates, mixing, packing.

Each stage works on all that the one before kept, written as Parquet and read again. All but the last keep or drop whole rows of documents with all their
columns, whatever their names.

Null and empty texts have no words, so the quality rules drop them; repeated rows, ties in doc_id and rows without one are copies of each other only where their
texts are (one of each group stays). Texts are read whole, however long. Without labels of both classes among what is left nothing is toxic.
An empty table, or one of which nothing is left, gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cellweave.llm import mixing, packing, quality_rules, shingle_copies, toxicity
from cellweave.llm.common import documents, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # copies that are 0.8 alike in five-word shingles differ in any number of bits of a SimHash, so their sets are compared
    return shingle_copies.keep_one(docs)


def keep_mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.keep_mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)


STAGES = [
    ("quality rules", keep_good),
    ("toxicity", keep_clean),
    ("SimHash near-dedup", keep_one_of_each_group),
    ("mixing sources to target weights", keep_mixed),
    ("best-fit packing", pack),
]

#: A trained model, fingerprints by XXH64 and a tokenizer's ids aren't SQL; tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
