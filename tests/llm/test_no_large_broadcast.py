"""Joins that must not become broadcasts, however small Spark takes their tables to be."""

from pyspark.sql import functions as F

from cellweave.llm import common, shingle_copies, simhash
from cellweave.operators import graph


def broadcasts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_rings_of_fingerprints_are_not_broadcast(spark):
    """A few fingerprints make files of a few kB; their rings and the 17 values that each asks for are many more rows."""
    prints = graph.cut(spark.range(3000).select("id", F.xxhash64("id").alias("fp"), F.col("id").alias("group")))
    assert broadcasts(simhash.star_links(prints.select("id", "fp"))) == 0
    assert broadcasts(simhash.links(prints)) == 0


def test_only_hot_keys_are_broadcast(spark):
    """100 000 equal numbers are next to nothing as a file."""
    rows = graph.cut(spark.range(200_000).select((F.col("id") % 100_000).alias("key"), F.lit(1).alias("v")))
    right = graph.cut(rows.groupBy("key").agg(F.count("*").alias("n"), F.max("v").alias("w")))
    joined = graph.even_join(rows, right, "key", 200_000)
    assert broadcasts(joined) == 2  # hot rows, and their keys
    assert joined.count() == 200_000


def test_long_tables_of_near_copies_are_not_broadcast(spark):
    """Numbers that compress well: as files the tables are far below Spark's limit for broadcasts."""
    pairs = graph.cut(spark.range(150_000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")))
    sizes = graph.cut(spark.range(150_001).select("id", F.lit(9).cast("long").alias("size")))
    both = shingle_copies.with_both(pairs, sizes, "size")
    found = broadcasts(both)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert broadcasts(shingle_copies.with_both(pairs, sizes, "size")) == found  # hot rows and their keys only
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert both.agg(F.count("*"), F.min("x"), F.max("y")).first() == (150_000, 9, 9)
    docs = graph.cut(spark.range(150_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text")))
    found = graph.cut(docs.select("doc_id", F.xxhash64("text").alias("t"), F.col("doc_id").alias("group")))
    one = common.one_of_each(docs, found)
    assert broadcasts(one) == 0 and one.count() == 150_000
