"""Token counts with a cache of digests.

A cache is a Parquet table (content digest, tokenizer digest, number of tokens) at a path that the caller keeps.
`count_tokens` joins the documents' digests to it, encodes one text for each digest that it lacks, appends those
counts, and takes every document's count from the stored table. A second call over the same texts encodes nothing.

Content is normalised as the tokenizer itself normalises it before it cuts anything (the byte-level tokenizer doesn't), so equal
digests mean equal counts; a null text counts as an empty one. Equal texts are encoded once, also where a third of
all rows are copies: they meet in the task that read them before anything is shuffled, and counts of digests that very many rows have are broadcast.
Empty input gives no rows and adds nothing to the cache. Texts are read whole, however long. Other columns, whatever their names, are not read; repeated rows, rows
without doc_id and rows that share one each give a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import even_join, id_and_text, slices, table, written
from cellweave.llm.tokens import byte_bpe

CACHE = "content binary, tokenizer binary, n_tokens long"


def version(path: str) -> bytes:
    """The digest of the tokenizer's file; another version's counts are never taken."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).digest()[:16]


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts, none where nothing has been written yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(CACHE).parquet(path) if there else spark.createDataFrame([], CACHE)


def digested(docs: DataFrame) -> DataFrame:
    return id_and_text(docs).withColumn("content", F.unhex(F.substring(F.sha2(F.col("text"), 256), 1, 32)))


def encode_misses(docs: DataFrame, tokenizer: str, cache: str) -> DataFrame:
    """The counts that the cache lacks: each distinct text is encoded once."""
    schema, mark = pa.schema([("content", pa.binary()), ("tokenizer", pa.binary()), ("n_tokens", pa.int64())]), version(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = byte_bpe(tokenizer)
        for batch in slices(batches):
            yield table(schema, content=batch.column("content"), tokenizer=[mark] * batch.num_rows, n_tokens=library.count(batch.column("text")))

    stored = read_cache(docs.sparkSession, cache).where(F.col("tokenizer") == F.lit(mark)).select("content")
    misses = digested(docs).select("content", "text").join(stored, "content", "left_anti")
    return misses.groupBy("content").agg(F.first("text").alias("text")).mapInArrow(run, CACHE)


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document; `cache` then holds all counts."""
    encode_misses(docs, tokenizer, cache).write.mode("append").parquet(cache)
    stored = read_cache(docs.sparkSession, cache).where(F.col("tokenizer") == F.lit(version(tokenizer)))
    # two runs at once may both have appended a digest; its counts are equal
    stored = stored.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    each = written(digested(docs).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "content"), "digests")
    times = each.groupBy("content").agg(F.count("*").alias("n"))
    found = even_join(each, stored.join(times, "content"), "content", each.count())
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
