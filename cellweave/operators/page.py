"""Pages of cells for a viewer: chunks, viewports, overviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.functions.values import unit
from cellweave.operators.color import expression_of
from cellweave.sources.cells import CellSet, points

SPREAD, FINE = 0.5, 16


def bounds(coords: DataFrame) -> DataFrame:
    """key, min and max of x and y, and the number of cells."""
    return coords.groupBy("key").agg(F.min("x").cast("double").alias("min_x"), F.max("x").cast("double").alias("max_x"), F.min("y").cast("double").alias("min_y"), F.max("y").cast("double").alias("max_y"), F.count("*").alias("n"))


def loading_order(cells: DataFrame) -> DataFrame:
    """cell_idx, chunk in the order in which a viewer loads them; without chunks by cell_idx."""
    by = ["chunk", "cell_idx"] if "chunk" in cells.columns else ["cell_idx"]
    return cells.select(*by).orderBy(*by)


def circle_of(box: tuple[float, float, float, float]) -> tuple[float, float, float]:
    """Radius and centre of what a box (min_x, max_x, min_y, max_y) shows. Half its width is the radius; its height has no part."""
    if any(v is None for v in box):
        raise ValueError("a viewport needs all four bounds")
    radius, cx, cy = (box[1] - box[0]) / 2, (box[0] + box[1]) / 2, (box[2] + box[3]) / 2
    if radius <= 0:
        raise ValueError("a viewport needs a positive width")
    return radius, cx, cy


def viewport(places: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Cells in the circle about a box, with their distance d."""
    radius, cx, cy = circle_of(box)
    near = places.where(F.col("x").between(cx - radius, cx + radius) & F.col("y").between(cy - radius, cy + radius))
    dx, dy = F.col("x") - cx, F.col("y") - cy
    return near.withColumn("d", F.sqrt(dx * dx + dy * dy)).where(F.col("d") <= radius)


def stored_places(held: CellSet, key: str, box: tuple[float, float, float, float]) -> DataFrame:
    """The places that a viewport needs, without files of other zones."""
    radius, cx, cy = circle_of(box)
    return held.near(key, (cx - radius, cx + radius, cy - radius, cy + radius))


def first_by_draw(cells: DataFrame, most: int) -> DataFrame:
    """The cells with the `most` smallest draws (above 0; ties by cell_idx), without draw.

    Draws are counted by sixteenths of octaves first: the counts prove below which limit the sample lies, so that about as many rows as it has are put in order, not `most` of every task.
    """
    step = F.floor(F.log2("draw") * FINE)
    counts = sorted(cells.groupBy(step.alias("step")).count().collect())  # at most FINE for each exponent of a double
    if sum(n for _, n in counts) <= most:
        return cells.drop("draw")
    limit, held = 0, 0
    for limit, n in counts:
        held += n
        if held >= most:
            break
    return cells.where(step <= limit).orderBy("draw", "cell_idx").limit(most).drop("draw")


def viewport_sample(seen: DataFrame, radius: float, most: int = 30_000, seed: object = 42) -> DataFrame:
    """At most so many cells of a viewport without replacement, those near its centre likelier: weight exp(-(d/r)^2 / (2 * SPREAD^2))."""
    ratio = F.col("d") / radius
    weight = F.exp(-(ratio * ratio) / (2 * SPREAD * SPREAD))
    return first_by_draw(seen.withColumn("draw", -F.log(unit(seed, F.col("cell_idx"))) / weight), most)


def overview_sample(cells: DataFrame, most: int = 50_000, chunk: int = 0, seed: object = 42) -> DataFrame:
    """At most so many cells of a chunk, uniformly without replacement."""
    return first_by_draw(cells.where(F.col("chunk") == chunk).withColumn("draw", unit(seed, F.col("cell_idx"))), most)


def with_coordinates(cells: DataFrame, coords: DataFrame, keys: list[str]) -> DataFrame:
    """Columns <key>_x and <key>_y of several embeddings."""
    cols = [F.first(F.when(F.col("key") == k, F.col(c).cast("double")), ignorenulls=True).alias(f"{k}_{c}") for k in keys for c in ("x", "y")]
    wide = coords.where(F.col("key").isin(keys)).groupBy("cell_idx").agg(*cols)
    return cells.join(wide, "cell_idx", "left")


def page(cells: DataFrame, coords: DataFrame, keys: list[str], expression: DataFrame | None = None, gene: str | None = None, codes: DataFrame | None = None, heights: DataFrame | None = None) -> DataFrame:
    """Some cells with their coordinates in all embeddings, the value of a gene (0 where none is stored), the code of an attribute (cell_idx, code: 0 where none) and heights (key, cell_idx, z) as <key>_z."""
    found = with_coordinates(cells, coords, keys)
    if gene:
        found = found.join(expression_of(cells, expression, gene).withColumnRenamed("v", "expression"), "cell_idx", "left")
    if codes is not None:
        found = found.join(codes.select("cell_idx", "code"), "cell_idx", "left").withColumn("code", F.coalesce("code", F.lit(0)))
    if heights is not None:
        cols = [F.first(F.when(F.col("key") == k, F.col("z")), ignorenulls=True).alias(f"{k}_z") for k in keys]
        found = found.join(heights.where(F.col("key").isin(keys)).groupBy("cell_idx").agg(*cols), "cell_idx", "left")
    return found


def heights(coords: DataFrame) -> DataFrame:
    """key, cell_idx, z from -1 to 1 over all cells of each embedding that has a third dimension; 0 if all are equal."""
    some = coords.where(F.col("z").isNotNull()).select("key", "cell_idx", F.col("z").cast("double").alias("z"))
    ends = some.groupBy("key").agg(F.min("z").alias("low"), F.max("z").alias("high"))
    z = F.when(F.col("high") > F.col("low"), (F.col("z") - F.col("low")) / (F.col("high") - F.col("low")) * 2 - 1).otherwise(0.0)
    return some.join(F.broadcast(ends), "key").select("key", "cell_idx", z.alias("z"))  # a row for each embedding


def chunk_page(cells: DataFrame, coords: DataFrame, keys: list[str], chunk: int, expression: DataFrame | None = None, gene: str | None = None, codes: DataFrame | None = None, heights: DataFrame | None = None) -> DataFrame:
    """One chunk as a page; ValueError if there are no chunks or no cells in it."""
    if "chunk" not in cells.columns:
        raise ValueError("the cells have no chunks")
    some = cells.where(F.col("chunk") == chunk)
    if some.isEmpty():
        raise ValueError(f"no cells in chunk {chunk}")
    return page(some, coords, keys, expression, gene, codes, heights)


def viewport_page(cells: DataFrame, coords: DataFrame, key: str, box: tuple[float, float, float, float], keys: list[str], most: int = 30_000, seed: object = 42, expression: DataFrame | None = None, gene: str | None = None, codes: DataFrame | None = None, places: DataFrame | None = None) -> DataFrame:
    """What a viewport shows beside chunk 0, as a page; no rows where it shows nothing. places: those of the embedding, if fewer will do (stored_places)."""
    rest = cells.where(F.col("chunk") != 0) if "chunk" in cells.columns else cells
    seen = viewport(points(coords, key) if places is None else places, box).select("cell_idx", "d").join(rest, "cell_idx")
    return page(viewport_sample(seen, (box[1] - box[0]) / 2, most, seed).drop("d"), coords, keys, expression, gene, codes)
