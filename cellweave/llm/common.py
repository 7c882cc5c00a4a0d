"""What several operators of this subpackage share: rows of groups, batches and words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.operators.graph import even_join, merging
from cellweave.sources.scratch import fresh_path, written

__all__ = ["coded", "codes", "documents", "even_join", "fresh_path", "id_and_text", "merging", "one_of_each", "slices", "split_words", "table", "written"]

#: Words are runs of anything but these characters.
SPACES = r"[\x20\x09-\x0D]+"


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row of each group with all its columns. found: doc_id, t (xxhash64 of the text, null as '') and group of every row.

    It is the one with the smallest doc_id (rows without one come last), then the smallest t; of rows that share both, any. Rows move only where a chosen one stands more than once.
    """
    each = found.groupBy("group", "doc_id", "t").agg(F.count("*").alias("n"))
    least = each.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t", "n")).alias("m"))
    chosen = written(least.select(F.col("group").alias("g"), F.col("m.doc_id").alias("chosen_id"), F.col("m.t").alias("chosen_t"), "m.n"), "chosen")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("row_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("row_t"))
    mine = F.col("row_id").eqNullSafe(F.col("chosen_id")) & (F.col("row_t") == F.col("chosen_t"))
    size = chosen.count()
    once = rows.join(merging(chosen.where("n = 1"), size), mine, "left_semi").select("row.*")
    if chosen.where("n > 1").isEmpty():
        return once
    return once.unionAll(rows.join(merging(chosen.where("n > 1"), size), mine).dropDuplicates(["g"]).select("row.*"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns that most operators need; a null text counts as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that one holds about `most` bytes of a string column, and one row at least."""
    try:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
            part = np.cumsum(sizes, dtype=np.int64) // most
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                yield batch.slice(a, b - a)
    finally:
        pa.default_memory_pool().release_unused()  # the worker process stays for other tasks


def split_words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all rows one after another, and each row's number of words."""
    lists = pc.ascii_split_whitespace(pc.fill_null(text, ""))
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    words = lists.flatten()
    empty = pc.equal(pc.binary_length(words), 0)
    if pc.any(empty).as_py():
        row = np.repeat(np.arange(len(counts)), counts)[~empty.to_numpy(zero_copy_only=False)]
        words, counts = words.filter(pc.invert(empty)), np.bincount(row, minlength=len(counts)).astype(np.int64)
    return words, counts


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each word's number among the distinct words, and these."""
    found = words.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary


def codes(words: pa.Array) -> tuple[np.ndarray, list[str]]:
    number, distinct = coded(words)
    return number, distinct.to_pylist()


def table(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name] for f in schema], schema=schema)
