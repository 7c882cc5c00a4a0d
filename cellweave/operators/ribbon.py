"""Mean expression along a curved ribbon."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.functions.geometry import bezier, bezier_slope, width_at
from cellweave.operators.color import known_genes
from cellweave.operators.samples import cells_in
from cellweave.operators.spatial_join import captures
from cellweave.sources.cells import CellSet

BINS, WIDTH = 15, 50.0


@dataclass(frozen=True)
class Ribbon:
    """From start to end; control points lie at thirds and widths are WIDTH unless given."""

    start: tuple[float, float]
    end: tuple[float, float]
    controls: tuple[tuple[float, float], ...] = ()
    widths: tuple[float, float, float] = (WIDTH, WIDTH, WIDTH)

    def path(self) -> list[tuple[float, float]]:
        thirds = [tuple(a + k * (b - a) / 3 for a, b in zip(self.start, self.end, strict=True)) for k in (1, 2)]
        given = list(self.controls[:2])
        return [self.start, *given, *thirds[len(given) :], self.end]


def ribbon_bins(spark: SparkSession, ribbon: Ribbon, n_bins: int = BINS) -> DataFrame:
    """bin, center_x, center_y, ring: quads between points at equal steps of the curve's parameter, each as wide as the ribbon there."""
    p = ribbon.path()
    t = F.col("id") / F.lit(float(n_bins))
    slope_x, slope_y = bezier_slope(t, p, 0), bezier_slope(t, p, 1)
    length = F.sqrt(slope_x * slope_x + slope_y * slope_y)
    half = width_at(t, *ribbon.widths) / 2
    one = lambda v: F.when(length > 0, v / length).otherwise(F.lit(0.0))
    ends = spark.range(n_bins + 1).select("id", bezier(t, p, 0).alias("x"), bezier(t, p, 1).alias("y"), (one(-slope_y) * half).alias("wx"), (one(slope_x) * half).alias("wy"))
    a, b = ends.alias("a"), ends.alias("b")
    both = a.join(F.broadcast(b), F.col("b.id") == F.col("a.id") + 1)
    corner = lambda e, sign: F.struct((F.col(f"{e}.x") + sign * F.col(f"{e}.wx")).alias("x"), (F.col(f"{e}.y") + sign * F.col(f"{e}.wy")).alias("y"))
    middle = (F.col("a.id") + 0.5) / F.lit(float(n_bins))
    return both.select(F.col("a.id").cast("int").alias("bin"), bezier(middle, p, 0).alias("center_x"), bezier(middle, p, 1).alias("center_y"), F.array(corner("a", 1), corner("b", 1), corner("b", -1), corner("a", -1)).alias("ring"))


def cells_in_bins(places: DataFrame, bins: DataFrame) -> DataFrame:
    """bin, cell_idx; where the ribbon overlaps itself a cell is in several bins."""
    return captures(places, bins.select("bin", "ring"), ["bin"])


def bin_counts(places: DataFrame, bins: DataFrame) -> DataFrame:
    """bin, n, total: cells of each bin, and of all bins, where a cell counts once for each bin that it is in."""
    counts = cells_in_bins(places, bins).groupBy("bin").agg(F.count("*").alias("n"))
    every = bins.select("bin").join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))
    return every.withColumn("total", F.sum("n").over(Window.partitionBy()))  # as many rows as bins


def heatmap(places: DataFrame, expression: DataFrame, wanted: list[str], bins: DataFrame, genes: DataFrame) -> DataFrame:
    """gene, bin, cell_count, mean: the mean over all cells in the bin, where cells without a stored value count as 0; 0 for empty bins.

    What isn't in `genes` is left out; genes that no cell has are rows of zeros.
    """
    there = [r.gene for r in known_genes(genes, wanted).where("known").collect()]  # at most the genes asked for
    if not there:
        raise ValueError("a heatmap needs genes that are there")
    members = cells_in_bins(places, bins)
    values = expression.where(F.col("gene").isin(there)).select("cell_idx", "gene", F.col("value").cast("double").alias("value"))
    counts = members.groupBy("bin").agg(F.count("*").alias("cell_count"))
    sums = members.join(values, "cell_idx").groupBy("gene", "bin").agg(F.sum("value").alias("total"))
    frame = bins.select("bin", F.explode(F.array(*map(F.lit, there))).alias("gene"))
    found = frame.join(counts, "bin", "left").join(sums, ["gene", "bin"], "left")
    mean = F.coalesce(F.col("total") / F.col("cell_count"), F.lit(0.0))
    return found.select("gene", "bin", F.coalesce("cell_count", F.lit(0)).alias("cell_count"), mean.alias("mean"))


def ribbon_heatmap(c: CellSet, ribbon: Ribbon | None, genes: list[str], embedding: str, column: str | None = None, categories: list[str] | None = None, n_bins: int = BINS) -> DataFrame:
    """The heatmap along a ribbon drawn in an embedding, over all cells or those of some categories; ValueError without a ribbon, genes or coordinates."""
    if ribbon is None:
        raise ValueError("a heatmap needs a ribbon")
    places = c.embedding(embedding, "ribbon")
    some = cells_in(c.cells, column, categories)
    if some is not c.cells:
        places = places.join(some.select("cell_idx"), "cell_idx", "left_semi")
    return heatmap(places, c.expression, genes, ribbon_bins(c.cells.sparkSession, ribbon, n_bins), c.genes)


def scaled(heat: DataFrame, low: float | None = None, high: float | None = None) -> DataFrame:
    """heat with t, 0 to 1 between the smallest and the largest mean, or given ends; ends that leave nothing between them are 1 apart."""
    ends = heat.agg(F.min("mean").alias("low"), F.max("mean").alias("high"))
    ends = ends.select("low", F.when(F.col("high") == F.col("low"), F.col("low") + 1).otherwise(F.col("high")).alias("high"))
    ends = ends.select(F.lit(low).cast("double").alias("low") if low is not None else "low", F.lit(high).cast("double").alias("high") if high is not None else "high")
    ends = ends.select("low", F.when(F.col("low") >= F.col("high"), F.col("low") + 1).otherwise(F.col("high")).alias("high"))
    t = (F.col("mean") - F.col("low")) / (F.col("high") - F.col("low"))
    return heat.crossJoin(F.broadcast(ends)).withColumn("t", F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))).drop("low", "high")


def wide(heat: DataFrame) -> DataFrame:
    """gene, means: the bins' means in order."""
    return heat.groupBy("gene").agg(F.transform(F.array_sort(F.collect_list(F.struct("bin", "mean"))), lambda x: x["mean"]).alias("means"))
