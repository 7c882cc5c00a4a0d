"""Outlines of groups of cells: alpha shapes and convex hulls.

With R = 1 / alpha, a pair of points is a boundary edge of the alpha shape if it is closer than 2R and exactly one of the two discs of
radius R through both holds no other point. The centres of discs of radius R through a point lie on a circle about it, where each other point b closer than
2R keeps an arc from being empty; an empty disc through both is an end of b's arc that no other arc covers.

0. The plane is cut into small tiles, the smaller the denser the points. A disc whose centre lies in a tile that has a tile with points wholly within R isn't empty; only points R away from
   other tiles can be on an edge. That is told for tiles, block by block, so points far inside are left out at the cost of a join, and those that stay grow with the square root of the density.
1. Of these, points with few others all around them, one from each small tile nearby, are surrounded: their arcs cover all SECTORS of the circle. Those points are on no edge; the
   work for each is bounded, however dense the cells.
2. For the rest, arcs that only cover what is covered already are left out, and ends covered by another arc are found by a running maximum.
3. The discs that remain, a few for each boundary point, are tested exactly against the points in them.

The edges are put in order by `tracing`. Only hull points reach Python.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.operators.graph import beside, cut
from cellweave.operators.regions import centroids, spread_members
from cellweave.operators.spatial_join import captures, neighbours, tile
from cellweave.operators.tracing import rings

LEAST_POINTS = 3
TOLERANCE = 1e-9
#: Ends of arcs that another one covers by less than SLACK radians are tested exactly.
SECTORS, SLACK, TURN = 64, 1e-6, 2 * math.pi
#: Small tiles along R at least and at most; tiles along the side of a block; what rounding may move a place by, in tiles.
FINE, BLOCK, MOVED = (8, 64), 256, 1e-3


def alpha_edges(places: DataFrame, alpha: float) -> DataFrame:
    """region, a, b (a < b) of the boundary. places: region, cell_idx, x, y; of cells at one place the first stands for all."""
    return boundary(places, alpha).select("region", "a", "b")


def boundary(places: DataFrame, alpha: float) -> DataFrame:
    """The same with side (of the empty disc; 1: left of a to b) and both places, as xa, ya, xb, yb."""
    if alpha <= 0:
        raise ValueError("alpha must be above 0; use hull for 0")
    radius = 1 / alpha
    one = places.groupBy("region", "x", "y").agg(F.min("cell_idx").alias("cell_idx"))
    one = cut(one)
    outer = cut(near_gaps(one, radius))
    discs = cut(open_ends(outer, cut(not_surrounded(one, outer, radius)), radius))
    dx, dy = F.col("xb") - F.col("xa"), F.col("yb") - F.col("ya")
    squared = dx * dx + dy * dy
    discs = discs.where(squared < 4 * radius * radius).withColumn("rise", F.sqrt(F.greatest(F.lit(radius * radius) - squared / 4, F.lit(0.0)) / squared))
    cx = (F.col("xa") + F.col("xb")) / 2 - F.col("side") * F.col("rise") * dy
    cy = (F.col("ya") + F.col("yb")) / 2 + F.col("side") * F.col("rise") * dx
    ends = ["xa", "ya", "xb", "yb"]
    discs = discs.select("region", "a", "b", "side", *ends, cx.alias("cx"), cy.alias("cy"))
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    reach = discs.withColumn("s", steps).select("region", "a", "b", "side", "cx", "cy", (tile(F.col("cx"), radius) + F.col("s.i")).alias("tx"), (tile(F.col("cy"), radius) + F.col("s.j")).alias("ty"))
    points = one.select("region", "cell_idx", "x", "y", tile(F.col("x"), radius).alias("tx"), tile(F.col("y"), radius).alias("ty"))
    points = points.join(beside(reach.select("region", "tx", "ty").distinct()), ["region", "tx", "ty"], "left_semi")
    ex, ey = F.col("x") - F.col("cx"), F.col("y") - F.col("cy")
    inside = reach.hint("merge").join(points, ["region", "tx", "ty"]).where((F.col("cell_idx") != F.col("a")) & (F.col("cell_idx") != F.col("b")))
    full = inside.where(ex * ex + ey * ey < (radius - TOLERANCE) ** 2).select("region", "a", "b", "side").distinct()
    empty = discs.select("region", "a", "b", "side", *ends).join(full, ["region", "a", "b", "side"], "left_anti")
    return empty.groupBy("region", "a", "b").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("side", *ends)]).where("n = 1").drop("n")


def arc(dx: Column, dy: Column, radius: float) -> tuple[Column, Column]:
    """The middle and half the width of the arc that a point at this distance keeps from being empty."""
    near = F.least(F.sqrt(dx * dx + dy * dy) / (2 * radius), F.lit(1.0))
    return F.atan2(dy, dx), F.acos(near)


def sectors(low: Column, high: Column, touched: bool = False) -> Column:
    """The sectors that lie between two angles, or those that are touched, as bits."""
    low, high = low / (TURN / SECTORS), high / (TURN / SECTORS)
    first, last = (F.floor(low), F.ceil(high)) if touched else (F.ceil(low), F.floor(high))
    ones = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(last - first, F.lit(0)).cast("int")) - 1
    start = F.pmod(first, F.lit(SECTORS)).cast("int")
    return F.call_function("shiftleft", ones, start).bitwiseOR(F.call_function("shiftrightunsigned", ones, (SECTORS - start).cast("int")))


def widened(held: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """The tiles of a grid that lie within reach of one that is held: reach[k] tiles to the left and right in the k-th row above and below, -1 for none."""
    high, wide = held.shape
    sums = np.zeros((high, wide + 1), dtype=np.int32)
    np.cumsum(held, axis=1, out=sums[:, 1:])
    out, column = np.zeros_like(held), np.arange(wide)
    for k, w in enumerate(reach.tolist()):
        if w < 0 or k >= high:
            break
        row = sums[:, np.minimum(column + w + 1, wide)] > sums[:, np.maximum(column - w, 0)]
        out[k:] |= row[: high - k]
        if k:
            out[:-k] |= row[k:]
    return out


def open_tiles(held: np.ndarray, fine: int) -> np.ndarray:
    """Of the tiles that hold points those that a disc of `fine` tiles' radius may touch without one wholly inside. Beyond the grid nothing is held."""
    k, margin = np.arange(fine + 2), fine + 2
    within = np.floor(np.sqrt(np.maximum((fine - MOVED) ** 2 - (k + 1) ** 2, 0)) - 1)  # all of a tile about all of another one
    within[(k + 1) > fine - MOVED] = -1
    touched = np.floor(np.sqrt(np.maximum((fine + MOVED) ** 2 - np.maximum(k - 1, 0) ** 2, 0)) + 1)
    held = np.pad(held, margin)
    gaps = ~widened(held, within.astype(int))
    return (held & widened(gaps, touched.astype(int)))[margin:-margin, margin:-margin]


def fineness(one: DataFrame, radius: float) -> int:
    """Tiles along R, a power of two, so that a tile has about one point."""
    counts = one.groupBy("region", tile(F.col("x"), radius), tile(F.col("y"), radius)).agg(F.count("*").alias("n"))
    n = counts.agg(F.avg("n").alias("n")).first().n or 1
    return int(min(max(2 ** round(math.log2(n) / 2), FINE[0]), FINE[1]))


def near_gaps(one: DataFrame, radius: float) -> DataFrame:
    """region, cell_idx, x, y of the points whose tile isn't far inside; all that are on an edge are among them."""
    fine = fineness(one, radius)
    around = 2 * fine + 2  # tiles that tell of a tile
    at = one.select("region", "cell_idx", "x", "y", tile(F.col("x"), radius / fine).alias("ux"), tile(F.col("y"), radius / fine).alias("uy"))
    blocks = lambda u: F.explode(F.sequence(F.floor((F.col(u) - around) / BLOCK), F.floor((F.col(u) + around) / BLOCK)))
    dealt = at.select("region", "ux", "uy").distinct().withColumn("bx", blocks("ux")).withColumn("by", blocks("uy"))
    spark = one.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def of_block(cells: pd.DataFrame) -> pd.DataFrame:
        x, y = cells.ux.to_numpy(), cells.uy.to_numpy()
        own = (x // BLOCK == cells.bx.to_numpy()) & (y // BLOCK == cells.by.to_numpy())
        if not own.any():
            return cells.loc[own, ["region", "ux", "uy"]]
        held = np.zeros((y.max() - y.min() + 1, x.max() - x.min() + 1), dtype=bool)
        held[y - y.min(), x - x.min()] = True
        found = own & open_tiles(held, fine)[y - y.min(), x - x.min()]
        return cells.loc[found, ["region", "ux", "uy"]]

    keys = ["region", "bx", "by"]
    kept = dealt.repartition(tasks, *keys).groupBy(*keys).applyInPandas(of_block, "region string, ux long, uy long")
    return at.join(beside(kept), ["region", "ux", "uy"], "left_semi").select("region", "cell_idx", "x", "y")


def not_surrounded(one: DataFrame, outer: DataFrame, radius: float) -> DataFrame:
    """region, cell_idx, x, y and covered (sectors, as bits) of the outer points whose circle isn't covered by the arcs of one point from each tile nearby."""
    side = radius / 2
    with_tile = lambda df: df.select("region", "cell_idx", "x", "y", tile(F.col("x"), side).alias("tx"), tile(F.col("y"), side).alias("ty"))
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-2, 3) for j in range(-2, 3)])
    few = with_tile(one).groupBy("region", "tx", "ty").agg(F.min_by(F.struct("x", "y"), "cell_idx").alias("p")).withColumn("s", F.explode(steps))
    few = few.groupBy("region", (F.col("tx") + F.col("s.i")).alias("tx"), (F.col("ty") + F.col("s.j")).alias("ty")).agg(F.collect_list("p").alias("near"))  # 25 at most

    def covers(p: Column) -> Column:
        dx, dy = p.x - F.col("x"), p.y - F.col("y")
        middle, half = arc(dx, dy, radius)
        counts = ((dx != 0) | (dy != 0)) & (half > SLACK)
        return F.when(counts, sectors(middle - half + SLACK, middle + half - SLACK)).otherwise(F.lit(0).cast("long"))

    covered = F.aggregate("near", F.lit(0).cast("long"), lambda bits, p: bits.bitwiseOR(covers(p)))
    return with_tile(outer).join(few.hint("merge"), ["region", "tx", "ty"]).select("region", "cell_idx", "x", "y", covered.alias("covered")).where("covered != -1")


def open_ends(outer: DataFrame, some: DataFrame, radius: float) -> DataFrame:
    """region, a, b (a < b), side (1: left of a to b) and both places of the discs that may be empty: ends of arcs that no other arc of the same point covers. Arcs of outer points do: discs that hold other points only are found later."""
    ends = neighbours(outer, 2 * radius, ["region"], some, ["covered"]).where("a != b")
    middle, half = arc(F.col("xb") - F.col("xa"), F.col("yb") - F.col("ya"), radius)
    arcs = ends.withColumns({"middle": middle, "half": half})
    free = sectors(F.col("middle") - F.col("half"), F.col("middle") + F.col("half"), touched=True).bitwiseAND(F.bitwise_not("covered"))
    low = F.pmod(F.col("middle") - F.col("half"), F.lit(TURN))
    twice = F.explode(F.array(F.lit(0), F.lit(1))).alias("turn")  # so that what begins before angle 0 covers what comes after it
    before = lambda by: F.expr(f"max(high) OVER (PARTITION BY {by} ORDER BY low RANGE BETWEEN UNBOUNDED PRECEDING AND {SLACK!r}D PRECEDING)")
    arcs = arcs.where(free != 0).select("region", "tx", "ty", "a", "b", "xa", "ya", "xb", "yb", low.alias("low"), (low + F.col("half") * 2).alias("high"))
    # where they met: an arc inside those before it neither opens nor covers what they don't, so few of a point's arcs move to where all of them meet
    outside = F.col("before").isNull() | (F.col("before") <= F.col("low") + SLACK) | (F.col("before") < F.col("high"))
    arcs = arcs.withColumn("before", before("region, tx, ty, a")).where(outside).select("region", "a", "b", "xa", "ya", "xb", "yb", "low", "high")
    arcs = arcs.repartition("region", "a").select("*", twice).withColumns({c: F.col(c) + F.col("turn") * TURN for c in ("low", "high")})
    found = arcs.withColumn("before", before("region, a")).where((F.col("turn") == 1) & (F.col("before").isNull() | (F.col("before") <= F.col("low") + SLACK)))
    found = found.join(some.select("region", F.col("cell_idx").alias("b")), ["region", "b"], "left_semi")
    # the low end lies right of a to b
    up = F.col("a") < F.col("b")
    pick = lambda x, y, name: F.when(up, F.col(x)).otherwise(F.col(y)).alias(name)
    return found.select("region", pick("a", "b", "a"), pick("b", "a", "b"), F.when(up, -1).otherwise(1).alias("side"), pick("xa", "xb", "xa"), pick("ya", "yb", "ya"), pick("xb", "xa", "xb"), pick("yb", "ya", "yb"))


def nesting(found: DataFrame) -> DataFrame:
    """region, ring_no, depth: in how many other rings of its region a ring lies; at odd depths it is a hole. Rings don't cross, so an edge of it tells."""
    v, w = F.element_at("ring", 1), F.element_at("ring", 2)
    tips = found.select(F.struct("region", "ring_no").alias("cell_idx"), ((v.x + w.x) / 2).alias("x"), ((v.y + w.y) / 2).alias("y"))
    inside = captures(tips, found, ["region", "ring_no"]).where((F.col("cell_idx.region") == F.col("region")) & (F.col("cell_idx.ring_no") != F.col("ring_no")))
    depth = inside.groupBy(F.col("cell_idx.region").alias("region"), F.col("cell_idx.ring_no").alias("ring_no")).agg(F.count("*").alias("depth"))
    return found.select("region", "ring_no").join(depth, ["region", "ring_no"], "left").select("region", "ring_no", F.coalesce("depth", F.lit(0)).alias("depth"))


def area(ring: list[tuple[float, float]]) -> float:
    return sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def chain(points: list[tuple[float, float, int]]) -> list[tuple[float, float, int]]:
    """The corners of the hull of points in ascending order, counter-clockwise from the first; points along an edge are none."""

    def half(some: list) -> list:
        out = []
        for p in some:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out

    return points if len(points) < LEAST_POINTS else half(points)[:-1] + half(points[::-1])[:-1]


def corners(held: pd.DataFrame) -> pd.DataFrame:
    """The hull's corners for each region of a table; of cells at one place the first stands for all."""
    number, names = pd.factorize(held.region)
    x, y, cell = held.x.to_numpy(), held.y.to_numpy(), held.cell_idx.to_numpy()
    order = np.lexsort((cell, y, x, number))
    number, x, y, cell = number[order], x[order], y[order], cell[order]
    new = np.concatenate([[True], (number[1:] != number[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])])[: len(order)]
    number, x, y, cell = number[new], x[new], y[new], cell[new]
    cuts = np.searchsorted(number, np.arange(len(names) + 1)).tolist()
    points = list(zip(x.tolist(), y.tolist(), cell.tolist(), strict=True))
    rows = [(names[k], i, p[2], p[0], p[1]) for k in range(len(names)) for i, p in enumerate(chain(points[cuts[k] : cuts[k + 1]]))]
    return pd.DataFrame(rows, columns=["region", "position", "cell_idx", "x", "y"])


def hull(places: DataFrame, salts: int = 32) -> DataFrame:
    """region, position, cell_idx, x, y of the hull's corners.

    Each batch of rows is cut down to its own hulls, then again after a region's rows are dealt over `salts` tasks at most; few are left to meet.
    """
    schema = "region string, position long, cell_idx long, x double, y double"

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield corners(batch)

    some = places.select("region", "cell_idx", "x", "y").mapInPandas(parts, schema)
    dealt = some.repartition(F.col("region"), F.pmod(F.xxhash64("cell_idx"), F.lit(salts)))
    return dealt.mapInPandas(parts, schema).groupBy("region").applyInPandas(corners, schema)


def outlines(members: DataFrame, places: DataFrame, alpha: float, exterior_only: bool = False, wanted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rings of each region, and failures: region, reason. members: region, cell_idx; alpha 0 gives hulls. With `wanted` (region) of these names, whether they have members or not."""
    names = members.select("region").distinct() if wanted is None else wanted.select("region").distinct()
    mine = members if wanted is None else members.join(beside(names), "region", "left_semi")
    each = cut(mine.join(places.select("cell_idx", "x", "y"), "cell_idx"))
    counts = cut(each.groupBy("region").agg(F.count("*").alias("n")))
    good = each.join(beside(counts.where(F.col("n") >= LEAST_POINTS).select("region")), "region", "left_semi")
    if alpha > 0:
        found = rings(boundary(good, alpha), exterior_only)
    else:
        ordered = hull(good).groupBy("region").agg(F.array_sort(F.collect_list(F.struct("position", "x", "y"))).alias("c"))
        found = ordered.select("region", F.lit(0).alias("ring_no"), F.transform("c", lambda p: F.struct(p.x.alias("x"), p.y.alias("y"))).alias("ring"))
    found = cut(found)
    held = names.join(members.select("region").distinct().withColumn("held", F.lit(True)), "region", "left").join(counts, "region", "left").join(found.select("region").distinct().withColumn("done", F.lit(True)), "region", "left")
    reason = F.when(F.col("held").isNull(), "no members").when(F.coalesce("n", F.lit(0)) < LEAST_POINTS, "fewer than 3 cells").when(F.col("done").isNull(), "no outline")
    return found, held.select("region", reason.alias("reason")).where("reason is not null")


def outlined_regions(members: DataFrame, places: DataFrame, alpha: float, most: int, wanted: DataFrame | None = None) -> dict[str, DataFrame]:
    """Outlines of clusters as a viewer takes them: region_rings, region_cells (every k-th member, `most` at most), regions (region, centroid_x, centroid_y and n over these) and failures; ValueError if all fail."""
    found, failed = outlines(members, places, alpha, wanted=wanted)
    if found.isEmpty():
        raise ValueError("no region has an outline")
    kept = spread_members(members.join(found.select("region").distinct(), "region", "left_semi"), most)
    middle = centroids(kept, places).select("region", F.col("x").alias("centroid_x"), F.col("y").alias("centroid_y"), "n")
    return {"region_rings": found, "region_cells": kept, "regions": middle, "failures": failed}


def recomputed(members: DataFrame, places: DataFrame, alpha: float) -> tuple[DataFrame, DataFrame]:
    """Exterior rings of regions in another embedding, with centroid_x and centroid_y over all members; and failures."""
    found, failed = outlines(members, places, alpha, exterior_only=True)
    middle = centroids(members, places).select("region", F.col("x").alias("centroid_x"), F.col("y").alias("centroid_y"))
    return found.join(middle, "region"), failed
