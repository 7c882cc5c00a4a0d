"""Connected components, and joins whose hot keys don't meet in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.sources.scratch import written

#: Up to so many short rows are broadcast. A key with over 1 / HOT of a table's rows is hot; there are fewer than HOT of them. A table of up to FEW_ROWS is no load for a single task.
FEW, HOT, FEW_ROWS = 1 << 17, 1000, 100_000


def cut(df: DataFrame) -> DataFrame:
    """df without its past."""
    return written(df, "cut")


def merging(df: DataFrame, rows: int) -> DataFrame:
    """df for a join, which merges where df has many rows. Spark sizes tables by their files, and as files numbers can be a tenth of what they take in the driver's memory."""
    return df.hint("merge") if rows > FEW_ROWS else df


def beside(df: DataFrame) -> DataFrame:
    """df, of short rows, for a join with a long table: few rows come to the table, which then stays where it is; many merge."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= FEW else df.hint("merge")


def even_join(left: DataFrame, right: DataFrame, keys: str | list[str], total: int) -> DataFrame:
    """left joined with right, which holds each key once and in n how many of left's `total` rows have it; n is dropped.

    Hot keys are fewer than HOT whatever the size, so their rows of right are broadcast and left's stay where they are; no task gathers them. The rest merge, as by `merging`.
    """
    keys = [keys] if isinstance(keys, str) else keys
    if total <= FEW_ROWS:
        return left.join(right.drop("n"), keys)
    is_hot = F.col("n") * HOT > total
    hot = right.where(is_hot).drop("n")
    rest = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(right.where(~is_hot).drop("n").hint("merge"), keys)
    return left.join(F.broadcast(hot), keys).unionByName(rest)


def components(edges: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) of all ids in the edges (a, b), by alternating large-star and small-star rounds."""
    given = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    edges, size = given.where("a != b"), given.count()
    while size:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
        large = even_join(both.where("b > a"), least, "a", 2 * size).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.unionAll(least.where("m < a").select("a", F.col("m").alias("b"))).distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = even_join(large, least, "a", 2 * size)
        small = small.select("a", F.col("m").alias("b")).unionAll(small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        edges = written(small.distinct(), "small-star")
        # stars: each id has one edge down, to an id that has none
        ends = edges.select("a", F.lit(0).alias("up"), F.lit(1).alias("down")).unionAll(edges.select("b", F.lit(1), F.lit(0)))
        if ends.groupBy("a").agg(F.max("up").alias("up"), F.sum("down").alias("down")).where("down + up > 1").isEmpty():
            break
    ids = given.select("a").unionAll(given.select("b")).distinct().withColumnRenamed("a", "id")
    return ids.join(merging(edges.select(F.col("a").alias("id"), F.col("b").alias("component")), size), "id", "left").select("id", F.coalesce("component", "id").alias("component"))
