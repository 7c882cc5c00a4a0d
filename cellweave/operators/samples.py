"""Statistics by sample. Samples are few; windows run over samples only, never over cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions.values import unassigned

MISSING, ALL_CELLS = "__NA__", "all_cells"


def sample_stats(cells: DataFrame, places: DataFrame, sample: str = "sample") -> DataFrame:
    """sample, cx, cy (means), w, h (extents), n, ordinal (from 0, by first appearance)."""
    each = cells.select("cell_idx", F.col(sample).cast("string").alias("sample")).where("sample is not null").join(places, "cell_idx")
    found = each.groupBy("sample").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"), (F.max("x") - F.min("x")).alias("w"), (F.max("y") - F.min("y")).alias("h"), F.count("*").alias("n"), F.min("cell_idx").alias("first"))
    return found.select("sample", "cx", "cy", "w", "h", "n", (F.row_number().over(Window.orderBy("first")) - 1).alias("ordinal"))


def sample_attribute(cells: DataFrame, column: str, sample: str = "sample") -> DataFrame:
    """sample, category, code (from 0, in sorted order), valid: a sample is valid if it has one value at most, leaving out 'nan' and blanks.

    Samples without a value, and unassigned ones, have the category MISSING.
    """
    value = F.trim(F.col(column).cast("string"))
    value = F.when(F.lower(value).isin("nan", ""), None).otherwise(value)
    each = cells.select(F.col(sample).cast("string").alias("sample"), "cell_idx", value.alias("v")).where("sample is not null")
    found = each.groupBy("sample").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    category = F.when(unassigned(F.col("sample")) | F.col("low").isNull(), MISSING).otherwise(F.col("low"))
    valid = F.coalesce(F.col("low") == F.col("high"), F.lit(True)) | unassigned(F.col("sample"))
    found = found.select("sample", category.alias("category"), valid.alias("valid"))
    return found.select("sample", "category", (F.dense_rank().over(Window.orderBy("category")) - 1).alias("code"), "valid")


def cells_of(cells: DataFrame, column: str | None, category: str | None) -> DataFrame:
    """The cells of one category, compared as strings; all for a blank column or ALL_CELLS. ValueError for a missing column or category, or one that no cell has."""
    if not (column or "").strip() or column == ALL_CELLS:
        return cells
    if column not in cells.columns:
        raise ValueError(f"no column {column!r}; there are {', '.join(cells.columns[:15])}")
    if not (category or "").strip():
        raise ValueError("a category is needed")
    found = cells.where(F.col(column).cast("string") == category)
    if found.isEmpty():
        raise ValueError(f"no cell has {column} {category!r}")
    return found


def cells_in(cells: DataFrame, column: str | None, categories: list[str] | None) -> DataFrame:
    """The cells of some categories; all where there is no such column or no category is given."""
    if not categories or column not in cells.columns:
        return cells
    return cells.where(F.col(column).cast("string").isin([str(c) for c in categories]))


def first_value(cells: DataFrame, column: str, sample: str = "sample") -> DataFrame:
    """sample, value: the first one by cell_idx that isn't null."""
    some = cells.where(F.col(column).isNotNull() & F.col(sample).isNotNull())
    return some.groupBy(F.col(sample).cast("string").alias("sample")).agg(F.min_by(column, "cell_idx").alias("value"))


def upper_median(stats: DataFrame, column: str) -> DataFrame:
    """One row: of n values in ascending order the one with n // 2 before it; 1 if that is 0 or there is none."""
    ranked = stats.select(F.col(column).alias("v"), F.row_number().over(Window.orderBy(column)).alias("k"), F.count("*").over(Window.partitionBy()).alias("n"))
    return ranked.agg(F.max(F.when(F.col("k") == F.floor(F.col("n") / 2) + 1, F.col("v"))).alias("v")).select(F.coalesce(F.nullif("v", F.lit(0.0)), F.lit(1.0)).alias(f"median_{column}"))
