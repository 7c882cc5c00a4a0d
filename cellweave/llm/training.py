"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import id_and_text

ORDERS = 3


def labelled(docs: DataFrame, labels: DataFrame, column: str, sample: int) -> DataFrame:
    """doc_id, text and label (0 or 1) of at most `sample` documents of each class; the labels taken are few enough to broadcast.

    They come first by a hash of doc_id. Of near copies with the same label one stays: one document for each smallest hash of its
    3-word shingles, under each of ORDERS orders of hashes; else what is peculiar to a group of copies would pass for a rule.
    """
    taken = None
    for value in (0, 1):
        some = labels.where(F.col(column) == value).select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(value).alias("label")).dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        taken = some if taken is None else taken.unionAll(some)
    found = id_and_text(docs).join(F.broadcast(taken), "doc_id")
    words = F.split(F.lower("text"), r"\s+")
    shingles = F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - 2, F.lit(1))), lambda i: F.xxhash64(F.slice("words", i, 3)))
    found = found.withColumn("words", words).withColumn("hashes", shingles)

    def least(order: int) -> Column:
        return F.array_min(F.transform("hashes", lambda h: F.xxhash64(h, F.lit(order))))

    found = found.withColumns({f"least{order}": least(order) for order in range(ORDERS)})
    found = found.drop("words", "hashes")
    for order in range(ORDERS):
        found = found.dropDuplicates(["label", f"least{order}"])
    return found.select("doc_id", "text", "label")
