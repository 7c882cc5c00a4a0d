"""Density clusters within samples.

A cell is core if at least `min_samples` cells of its sample (itself included) lie within `eps`. Core cells within eps of each other are in one
cluster; other cells within eps of a core cell join the lowest-numbered such cluster; the rest is noise. Clusters are numbered from 0 in
each sample by their first core cell.

Neighbours come from an equi-join on tiles. Where at least min_samples cells lie in a tile of diagonal eps, all of them are core and linked
through one of them, so neither their neighbours nor the pairs among them are needed. Two dense tiles are linked if any of their cells are near; that is mostly
told by their outermost cells, else by those of SPLIT x SPLIT parts of each, and only where it isn't, cells of parts that could be near are compared.

A cell of a sparse tile beside a dense one needs to know only whether any cell there is near, and how many are until it has min_samples neighbours. A tree of quarters
tells: quarters whose box lies within eps count as a whole, those whose box is farther don't count, and only those on the circle are opened, down to parts of LEAF cells. So it meets about
as many parts as the circle has on its way, not all cells of the tile.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.operators.graph import beside, components, cut
from cellweave.operators.spatial_join import tile


SPLIT, LEAF = 4, 32
BOX = {"x0": F.min, "x1": F.max, "y0": F.min, "y1": F.max}


def density_clusters(places: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """sample, cell_idx, cluster (-1: noise), core. places: sample, cell_idx, x, y. Samples with fewer than min_samples cells are left out."""
    places = cut(places.select("sample", "cell_idx", "x", "y"))
    enough = places.groupBy("sample").count().where(F.col("count") >= min_samples).select("sample")
    side = eps / math.sqrt(2) * (1 - 1e-12)
    at = places.join(beside(enough), "sample", "left_semi").select("sample", "cell_idx", "x", "y", tile(F.col("x"), side).alias("sx"), tile(F.col("y"), side).alias("sy"))
    tiles = at.groupBy("sample", "sx", "sy").agg(F.count("*").alias("n"), F.min("cell_idx").alias("of_tile"))
    at = cut(at.join(tiles, ["sample", "sx", "sy"]).withColumn("dense", F.col("n") >= min_samples).select("sample", "cell_idx", "x", "y", "sx", "sy", "dense", F.when(F.col("n") >= min_samples, F.col("of_tile")).alias("of_tile")))
    sparse, dense = at.where("not dense"), at.where("dense")
    # pairs that start at a cell of a sparse tile: its degree, and its links; b is a cell, or the first cell of a dense tile for n of its cells
    near = cut(pairs_between(sparse, sparse, eps).withColumn("n", F.lit(1).cast("long")).unionByName(near_parts(sparse, dense, eps, side, min_samples)))
    degree = near.groupBy("a").agg(F.sum("n").alias("degree"))
    core = degree.where(F.col("degree") >= min_samples).select(F.col("a").alias("cell_idx"))
    # core cells of one tile are near each other: the first of them stands for all; of a dense tile, where all are core, no other needs to be known
    core_cells = cut(sparse.join(core, "cell_idx", "left_semi").select("cell_idx", "sample", "sx", "sy"))
    firsts = core_cells.groupBy("sample", "sx", "sy").agg(F.min("cell_idx").alias("node"))
    crowds = dense.groupBy("sample", "of_tile").agg(F.lit(1).alias("one")).select(F.col("of_tile").alias("cell_idx"), F.col("of_tile").alias("node"), "sample")
    stand_in = cut(core_cells.join(firsts, ["sample", "sx", "sy"]).select("cell_idx", "node", "sample").unionByName(crowds))
    of = lambda c, node: stand_in.select(F.col("cell_idx").alias(c), F.col("node").alias(node))
    links = near.join(of("a", "x"), "a").join(of("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
    between = near_tiles(dense, eps, side)
    itself = stand_in.select(F.col("node").alias("a"), F.col("node").alias("b"))
    found = components(links.unionAll(between).unionAll(itself).distinct()).withColumnRenamed("id", "node")
    of_node = stand_in.join(found, "node")
    first = of_node.groupBy("sample", "component").agg(F.min("node").alias("first"))
    numbered = first.select("component", (F.row_number().over(Window.partitionBy("sample").orderBy("first")) - 1).alias("cluster"))
    of_core = cut(of_node.join(numbered, "component").select("cell_idx", "cluster"))
    border = near.join(of_core.withColumnRenamed("cell_idx", "b"), "b").groupBy(F.col("a").alias("cell_idx")).agg(F.min("cluster").alias("near_cluster"))
    of_crowd = of_core.join(crowds.select("cell_idx"), "cell_idx").withColumnRenamed("cell_idx", "of_tile")
    crowded = dense.select("sample", "cell_idx", "of_tile").join(beside(of_crowd), "of_tile", "left")
    others = sparse.select("sample", "cell_idx").join(of_core, "cell_idx", "left").join(border, "cell_idx", "left")
    each = crowded.select("sample", "cell_idx", "cluster", F.lit(None).cast("int").alias("near_cluster")).unionByName(others)
    return each.select("sample", "cell_idx", F.coalesce("cluster", "near_cluster", F.lit(-1)).cast("int").alias("cluster"), F.col("cluster").isNotNull().alias("core"))


def gap_and_span(x: Column, y: Column) -> tuple[Column, Column]:
    """Squares of the least and the greatest distance of a place from a box."""
    gaps = [F.greatest(F.col(f"{c}0") - v, v - F.col(f"{c}1"), F.lit(0.0)) for c, v in (("x", x), ("y", y))]
    spans = [F.greatest(v - F.col(f"{c}0"), F.col(f"{c}1") - v) for c, v in (("x", x), ("y", y))]
    return gaps[0] * gaps[0] + gaps[1] * gaps[1], spans[0] * spans[0] + spans[1] * spans[1]


def near_parts(sparse: DataFrame, dense: DataFrame, eps: float, side: float, least: int) -> DataFrame:
    """a, b, n: cells of sparse tiles with the dense tiles b (of_tile) that hold cells within eps, and how many of these were counted: all, or enough for a to have `least`."""
    nodes = lambda cells: cells.groupBy("sample", "of_tile", "ux", "uy").agg(F.count("*").alias("m"), *[f(c[0]).alias(c) for c, f in BOX.items()])
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-2, 3) for j in range(-2, 3)]))
    asks = sparse.select("sample", F.col("cell_idx").alias("a"), F.col("x").alias("xa"), F.col("y").alias("ya"), "sx", "sy", steps.alias("s"))
    asks = asks.select("sample", "a", "xa", "ya", (F.col("sx") + F.col("s.i")).alias("ux"), (F.col("sy") + F.col("s.j")).alias("uy"))
    cells = dense.select("sample", "of_tile", "x", "y", F.col("sx").alias("ux"), F.col("sy").alias("uy"))
    met, found, level = asks.join(nodes(cells).hint("merge"), ["sample", "ux", "uy"]), None, 0
    while True:
        gap, span = gap_and_span(F.col("xa"), F.col("ya"))
        met = cut(met.withColumns({"gap": gap, "span": span}).where(F.col("gap") <= eps * eps).withColumn("sure", F.col("span") <= eps * eps).drop("gap", "span"))
        sure = met.where("sure").select("a", F.col("of_tile").alias("b"), F.col("m").alias("n"))
        few = met.where(f"not sure and m <= {LEAF}").select("sample", "of_tile", "ux", "uy", "a", "xa", "ya").join(cells.hint("merge"), ["sample", "of_tile", "ux", "uy"])
        dx, dy = F.col("x") - F.col("xa"), F.col("y") - F.col("ya")
        opened = few.where(dx * dx + dy * dy <= eps * eps).groupBy("a", F.col("of_tile").alias("b")).agg(F.count("*").alias("n"))
        part = sure.unionByName(opened)
        found = part if found is None else found.unionByName(part)
        many = met.where(f"not sure and m > {LEAF}")
        if many.isEmpty():
            return found.groupBy("a", "b").agg(F.sum("n").alias("n"))
        found = cut(found.groupBy("a", "b").agg(F.sum("n").alias("n")))
        # told already: near this tile, and with enough neighbours
        enough = found.groupBy("a").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("a")
        told = found.join(enough, "a", "left_semi").select("a", F.col("b").alias("of_tile"))
        many = many.join(told, ["a", "of_tile"], "left_anti").select("sample", "of_tile", F.col("ux").alias("px"), F.col("uy").alias("py"), "a", "xa", "ya")
        level += 1
        cells = cells.join(many.select("sample", "of_tile", F.col("px").alias("ux"), F.col("py").alias("uy")).distinct(), ["sample", "of_tile", "ux", "uy"], "left_semi")
        cells = cut(cells.select("sample", "of_tile", "x", "y", tile(F.col("x"), side / 2**level).alias("ux"), tile(F.col("y"), side / 2**level).alias("uy")))
        quarters = nodes(cells).withColumns({"px": F.floor(F.col("ux") / 2), "py": F.floor(F.col("uy") / 2)})
        met = many.join(quarters, ["sample", "of_tile", "px", "py"]).drop("px", "py")


def outermost() -> list[Column]:
    """The outermost places of a group of cells, as p, and the box about them."""
    place = F.struct("x", "y")
    return [F.array(F.min_by(place, "x"), F.max_by(place, "x"), F.min_by(place, "y"), F.max_by(place, "y")).alias("p"), *[f(c[0]).alias(c) for c, f in BOX.items()]]


def told(both: DataFrame, eps: float) -> tuple[Column, Column]:
    """Of two groups of cells (columns of outermost, after a_ and b_) whether any could be within eps, and whether some outermost ones are."""
    gaps = [F.greatest(F.col(f"a_{c}0") - F.col(f"b_{c}1"), F.col(f"b_{c}0") - F.col(f"a_{c}1"), F.lit(0.0)) for c in "xy"]
    close = lambda p, q: (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) <= eps * eps
    return gaps[0] * gaps[0] + gaps[1] * gaps[1] <= eps * eps, F.exists("a_p", lambda p: F.exists("b_p", lambda q: close(p, q)))


def near_tiles(dense: DataFrame, eps: float, side: float) -> DataFrame:
    """a, b: tiles (of_tile) of which some cells are within eps. dense: sample, cell_idx, x, y, of_tile.

    The outermost cells tell it for most tiles, however many cells these hold; of the others parts are looked at in the same way, and then cells of parts that could be near.
    """
    dense = dense.select("sample", "x", "y", "of_tile", tile(F.col("x"), side).alias("sx"), tile(F.col("y"), side).alias("sy"), tile(F.col("x"), side / SPLIT).alias("ux"), tile(F.col("y"), side / SPLIT).alias("uy"))
    named = lambda df, s, *keys: df.select(*keys, *[F.col(c).alias(f"{s}_{c}") for c in df.columns if c not in keys])
    tiles = cut(dense.groupBy("sample", "sx", "sy", "of_tile").agg(*outermost()))
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(3) for j in range(-2, 3) if (i, j) > (0, 0)]))
    here = tiles.withColumn("s", steps).withColumns({"sx": F.col("sx") + F.col("s.i"), "sy": F.col("sy") + F.col("s.j")}).drop("s")
    at = ["sample", "sx", "sy"]
    both = named(here, "a", *at).join(named(tiles, "b", *at).hint("merge"), at)
    could, sure = told(both, eps)
    pairs = cut(both.where(could).select(F.col("a_of_tile").alias("a"), F.col("b_of_tile").alias("b"), sure.alias("sure")))
    found, unsure = pairs.where("sure").select("a", "b"), pairs.where("not sure").select("a", "b")
    asked = cut(unsure.select(F.col("a").alias("of_tile")).unionAll(unsure.select("b")).distinct())
    cells = cut(dense.join(asked, "of_tile", "left_semi").select("of_tile", "ux", "uy", "x", "y"))
    parts = cut(cells.groupBy("of_tile", "ux", "uy").agg(*outermost()))
    both = unsure.join(named(parts, "a").withColumnRenamed("a_of_tile", "a").hint("merge"), "a").join(named(parts, "b").withColumnRenamed("b_of_tile", "b").hint("merge"), "b")
    could, sure = told(both, eps)
    pairs = cut(both.where(could).select("a", "b", "a_ux", "a_uy", "b_ux", "b_uy", sure.alias("sure")))
    by_parts = cut(pairs.where("sure").select("a", "b").distinct())
    unsure = pairs.where("not sure").join(by_parts, ["a", "b"], "left_anti").drop("sure")
    of = lambda s: named(cells, s).withColumnRenamed(f"{s}_of_tile", s)
    met = unsure.join(of("a").hint("merge"), ["a", "a_ux", "a_uy"]).join(of("b").hint("merge"), ["b", "b_ux", "b_uy"])
    dx, dy = F.col("a_x") - F.col("b_x"), F.col("a_y") - F.col("b_y")
    return found.unionAll(by_parts).unionAll(met.where(dx * dx + dy * dy <= eps * eps).select("a", "b").distinct())


def pairs_between(left: DataFrame, right: DataFrame, eps: float) -> DataFrame:
    """a, b within eps, a from the left and b from the right."""
    at = lambda df, s: df.select("sample", F.col("cell_idx").alias(s), F.col("x").alias(f"x{s}"), F.col("y").alias(f"y{s}"), tile(F.col("x"), eps).alias("tx"), tile(F.col("y"), eps).alias("ty"))
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    a = at(left, "a").withColumn("s", steps).withColumns({"tx": F.col("tx") + F.col("s.i"), "ty": F.col("ty") + F.col("s.j")}).drop("s")
    dx, dy = F.col("xa") - F.col("xb"), F.col("ya") - F.col("yb")
    return a.join(at(right, "b").hint("merge"), ["sample", "tx", "ty"]).where(dx * dx + dy * dy <= eps * eps).select("a", "b")


def summary(labelled: DataFrame, places: DataFrame) -> DataFrame:
    """sample, cluster, n, cx, cy; the noise of a sample as cluster -1."""
    each = labelled.join(places.select("cell_idx", "x", "y"), "cell_idx")
    return each.groupBy("sample", "cluster").agg(F.count("*").alias("n"), F.avg("x").alias("cx"), F.avg("y").alias("cy"))


def cluster_names(members: DataFrame) -> DataFrame:
    """region, n of clusters (region, cell_idx) in ascending order of their names."""
    return members.groupBy("region").agg(F.count("*").alias("n")).orderBy("region")


def named_members(labelled: DataFrame, category: str, needed: bool = True) -> DataFrame:
    """region, cell_idx: clusters as regions named sample_cluster_category; ValueError if there is none but one is needed."""
    found = labelled.where("cluster >= 0").select(F.concat_ws("_", "sample", "cluster", F.lit(category)).alias("region"), "cell_idx")
    if needed and found.isEmpty():
        raise ValueError("no clusters")
    return found


