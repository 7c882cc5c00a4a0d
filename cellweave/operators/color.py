"""Display codes: a small number for each cell from an attribute, a gene or a group of genes."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions.values import clean_expression, code_between, code_of_expression, number
from cellweave.operators.graph import FEW_ROWS, cut

EPSILON = 1e-9


def numeric_codes(cells: DataFrame, column: str) -> DataFrame:
    """cell_idx, code: 1 to 255 from the smallest to the largest value; 0 if all are equal. Null and NaN count as 0."""
    values = cells.select("cell_idx", number(F.col(column)).alias("v"))
    ends = values.agg(F.min("v").alias("low"), F.max("v").alias("high"))
    return values.crossJoin(F.broadcast(ends)).select("cell_idx", code_between(F.col("v"), F.col("low"), F.col("high")).alias("code"))


def numbered(df: DataFrame, by: str) -> DataFrame:
    """df with the column number, from 1 in the order of `by` (each value once). Ranges of values are numbered on their own, after the sizes of those before; no task orders all, unless FEW_ROWS are all."""
    held = cut(df)
    if held.count() <= FEW_ROWS:
        return held.withColumn("number", F.row_number().over(Window.orderBy(by)))
    ranged = cut(held.repartitionByRange(by).withColumn("part", F.spark_partition_id()))
    sizes = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a part
    inside = F.row_number().over(Window.partitionBy("part").orderBy(by))
    return ranged.join(F.broadcast(sizes.select("part", before.alias("before"))), "part").withColumn("number", inside + F.col("before")).drop("part", "before")


def dictionary(cells: DataFrame, column: str, categories: list[str] | None = None) -> DataFrame:
    """category, code from 1: in the given order, or in the order of first appearance by cell_idx."""
    if categories is not None:
        return cells.sparkSession.createDataFrame([(c, i + 1) for i, c in enumerate(categories)], "category string, code int")
    first = cells.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("category")).agg(F.min("cell_idx").alias("first"))
    return numbered(first, "first").select("category", F.col("number").cast("int").alias("code"))


def category_codes(cells: DataFrame, column: str, categories: list[str] | None = None, code_base: int = 1) -> DataFrame:
    """cell_idx, category, code, display_code (255 at most). With base 1, 0 stands for none; with base 0, none is 0 too."""
    known = dictionary(cells, column, categories)
    each = cells.select("cell_idx", F.col(column).cast("string").alias("category")).join(known, "category", "left")
    code = F.coalesce(F.col("code") - (1 - code_base), F.lit(0)).cast("int")
    return each.select("cell_idx", "category", code.alias("code"), F.least(code, F.lit(255)).alias("display_code"))


def palette_of(known: DataFrame, palette: DataFrame) -> DataFrame:
    """category, code, color: the palette (cat_code, color) counts only if it has a colour for every category; else colours are null."""
    enough = palette.agg(F.count("*").alias("colours")).crossJoin(known.agg(F.count("*").alias("categories"))).select((F.col("colours") >= F.col("categories")).alias("enough"))
    coloured = known.join(palette.select(F.col("cat_code").alias("code"), "color"), "code", "left").crossJoin(F.broadcast(enough))
    return coloured.select("category", "code", F.when(F.col("enough"), F.col("color")).alias("color"))


def expression_of(cells: DataFrame, expression: DataFrame, gene: str) -> DataFrame:
    """cell_idx, v of all cells: the gene's cleaned value, 0 where none is stored."""
    some = expression.where(F.col("gene") == gene).select("cell_idx", clean_expression(F.col("value")).alias("v"))
    return cells.select("cell_idx").join(some, "cell_idx", "left").select("cell_idx", F.coalesce("v", F.lit(0.0).cast("float")).alias("v"))


def gene_codes(cells: DataFrame, expression: DataFrame, gene: str) -> DataFrame:
    """cell_idx, code, vmax: 1 to 255 up to the largest value, 0 for cells without the gene."""
    most = expression.where(F.col("gene") == gene).agg(F.coalesce(F.max(clean_expression(F.col("value"))), F.lit(0.0).cast("float")).alias("most"))
    each = expression_of(cells, expression, gene).crossJoin(F.broadcast(most))
    return each.select("cell_idx", code_of_expression(F.col("v"), F.col("most")).alias("code"), F.round(F.col("most").cast("double"), 4).alias("vmax"))


def known_genes(genes: DataFrame, wanted: list[str]) -> DataFrame:
    """gene, known for each wanted gene."""
    asked = genes.sparkSession.createDataFrame([(g.strip(),) for g in wanted if g.strip()], "gene string").distinct()
    return asked.join(genes.select("gene", F.lit(True).alias("known")).distinct(), "gene", "left").select("gene", F.coalesce("known", F.lit(False)).alias("known"))


def group_codes(cells: DataFrame, expression: DataFrame, wanted: list[str], genes: DataFrame) -> DataFrame:
    """cell_idx, v, code by the geometric mean of some genes, each raised by EPSILON; a cell with none of them has 0.

    Zeros aren't stored, so a cell's missing genes add log(EPSILON) each, those that no cell has too. What isn't in `genes` is left out; ValueError if none remains.
    """
    there = [r.gene for r in known_genes(genes, wanted).where("known").collect()]  # at most the genes asked for
    n = len(there)
    if not n:
        raise ValueError(f"none of {', '.join(wanted)} is there")
    some = expression.where(F.col("gene").isin(there)).select("cell_idx", "gene", clean_expression(F.col("value")).cast("double").alias("v"))
    sums = some.where("v > 0").groupBy("cell_idx").agg(F.sum(F.log(F.col("v") + EPSILON)).alias("logs"), F.count("*").alias("n"))
    mean = F.exp((F.col("logs") + (n - F.col("n")) * F.lit(math.log(EPSILON))) / n) - EPSILON
    found = sums.select("cell_idx", F.greatest(mean, F.lit(0.0)).alias("v"))
    most = found.agg(F.coalesce(F.max("v"), F.lit(0.0)).alias("most"))
    each = cells.select("cell_idx").join(found, "cell_idx", "left").select("cell_idx", F.coalesce("v", F.lit(0.0)).alias("v")).crossJoin(F.broadcast(most))
    scaled = F.least(F.greatest(F.col("v") / F.col("most") * 254 + 1, F.lit(1.0)), F.lit(255.0)).cast("int")
    return each.select("cell_idx", "v", F.when(F.col("v") > 0, scaled).otherwise(0).alias("code"))


def similar_genes(genes: DataFrame, text: str, most: int = 8) -> DataFrame:
    """Genes whose name contains the text in any case, in gene order."""
    return genes.where(F.upper("gene").contains(text.strip().upper())).orderBy("gene_idx").limit(most)


def display_range(codes: DataFrame, vmax: float, low: float = 0.0, high: float | None = None) -> DataFrame:
    """cell_idx, t: where a code's value lies between low and high, 0 to 1; a range of nothing counts as 1 wide."""
    high = vmax if high is None else high
    span = (high - low) or 1.0
    t = (F.col("code") / F.lit(255.0) * vmax - low) / span
    return codes.select("cell_idx", F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0)).alias("t"))


def visible(cells: DataFrame, column: str, enabled: DataFrame) -> DataFrame:
    """cell_idx, visible: hidden if its category (category, enabled) is switched off; cells without a category stay visible."""
    known = enabled.select(F.col("category").alias(column), "enabled")
    return cells.join(known, column, "left").select("cell_idx", F.coalesce("enabled", F.lit(True)).alias("visible"))


def normalised_z(points: DataFrame) -> DataFrame:
    """cell_idx, z from -1 to 1; 0 if all are equal."""
    ends = points.agg(F.min("z").alias("low"), F.max("z").alias("high"))
    z = F.when(F.col("high") > F.col("low"), (F.col("z") - F.col("low")) / (F.col("high") - F.col("low")) * 2 - 1).otherwise(0.0)
    return points.crossJoin(F.broadcast(ends)).select("cell_idx", z.alias("z"))


def depth(cells: DataFrame, z: DataFrame | None = None, shown: DataFrame | None = None, t: DataFrame | None = None, codes: DataFrame | None = None, n_codes: int = 0) -> DataFrame:
    """cell_idx, depth by the first of: normalised z (hidden: -1), expression t, stacked category code, visibility (1 or -1)."""
    each = cells.select("cell_idx")
    seen = F.lit(True)
    if shown is not None:
        each, seen = each.join(shown, "cell_idx", "left"), F.coalesce("visible", F.lit(True))
    if z is not None:
        each = each.join(z, "cell_idx", "left")
        return each.select("cell_idx", F.when(seen, F.coalesce("z", F.lit(0.0))).otherwise(-1.0).alias("depth"))
    if t is not None:
        return each.join(t, "cell_idx", "left").select("cell_idx", (F.coalesce("t", F.lit(0.0)) * 2 - 1).alias("depth"))
    if codes is not None:
        stacked = F.when((F.col("code") > 0) & F.lit(n_codes > 1), (F.col("code") - 1) / F.lit(float(max(n_codes - 1, 1)))).otherwise(0.0)
        return each.join(codes.select("cell_idx", "code"), "cell_idx", "left").select("cell_idx", F.coalesce(stacked, F.lit(0.0)).alias("depth"))
    return each.select("cell_idx", F.when(seen, 1.0).otherwise(-1.0).alias("depth"))
