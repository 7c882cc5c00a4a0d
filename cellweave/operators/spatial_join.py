"""Spatial joins as equi-joins on tiles, refined by the exact test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.geometry import crossed_oddly, edges, in_ring

#: Levels of tiles from a ring's own size down.
DEPTH = 4


def tile(v: Column, side: float) -> Column:
    return F.floor(v / F.lit(side))


def tiles_of_edge(e: Column, side: Column) -> Column:
    """Tiles (tx, ty) that an edge touches; column by column, with the heights at which it enters and leaves. Rounding can only add tiles."""
    slack = side * 1e-9
    low, high = F.least(e.xi, e.xj), F.greatest(e.xi, e.xj)
    columns = F.sequence(F.floor((low - slack) / side), F.floor((high + slack) / side))

    def of_column(tx: Column) -> Column:
        ends = [F.least(F.greatest((tx + k) * side, low), high) for k in (0, 1)]
        heights = [F.when(high > low, e.yi + (x - e.xi) * (e.yj - e.yi) / (e.xj - e.xi)) for x in ends]
        bottom, top = F.coalesce(F.least(*heights), F.least(e.yi, e.yj)), F.coalesce(F.greatest(*heights), F.greatest(e.yi, e.yj))
        more = slack + F.greatest(F.abs(bottom), F.abs(top)) * 1e-12
        return F.transform(F.sequence(F.floor((bottom - more) / side), F.floor((top + more) / side)), lambda ty: F.struct(tx.alias("tx"), ty.alias("ty")))

    return F.flatten(F.transform(columns, of_column))


def cover(rings: DataFrame) -> DataFrame:
    """rings (ring, x0, x1, y0, y1, size) as tiles: level, tx, ty (a tile's side is two to the level) and edges, null where the whole tile is inside, else those that tell inside from outside in it.

    A quadtree, from tiles of about the ring's size to DEPTH levels below: of the tiles that the outline touches, the quarters that it doesn't touch are inside or outside as their centres are;
    only the finest tiles on the outline need a test for each cell.
    """
    level = F.when(F.col("size") > 0, F.ceil(F.log2("size"))).otherwise(F.lit(0)).cast("int") - DEPTH
    tree = rings.withColumn("level", level).withColumn("side", F.pow(F.lit(2.0), F.col("level"))).withColumn("all_edges", edges(F.col("ring")))
    tree = tree.withColumn("border0", F.array_distinct(F.flatten(F.transform("all_edges", lambda e: tiles_of_edge(e, F.col("side"))))))
    up = lambda t: F.struct(F.shiftright(t.tx, 1).alias("tx"), F.shiftright(t.ty, 1).alias("ty"))
    for k in range(1, DEPTH + 1):
        tree = tree.withColumn(f"border{k}", F.array_distinct(F.transform(f"border{k - 1}", up)))

    def parts(t: Column, k: int) -> Column:
        """The tiles of k levels below."""
        steps = F.sequence(F.lit(0), F.lit(2**k - 1))
        return F.flatten(F.transform(steps, lambda i: F.transform(steps, lambda j: F.struct((t.tx * 2**k + i).alias("tx"), (t.ty * 2**k + j).alias("ty")))))

    def inside(k: int) -> Column:
        """The finest tiles of those, k levels above, that lie inside and whose parents don't."""
        side = F.col("side") * 2**k
        quarters = F.flatten(F.transform(f"border{k + 1}", lambda t: parts(t, 1)))
        clear = F.array_except(quarters, F.col(f"border{k}"))
        held = F.filter(clear, lambda t: in_ring((t.tx + 0.5) * side, (t.ty + 0.5) * side, F.col("ring")))
        return F.flatten(F.transform(held, lambda t: parts(t, k)))

    def telling(t: Column) -> Column:
        """Edges that a ray to the right from anywhere in the tile can cross."""
        y0, y1, x0 = t.ty * F.col("side"), (t.ty + 1) * F.col("side"), t.tx * F.col("side") - F.col("side") * 1e-9
        return F.filter("all_edges", lambda e: (F.least(e.yi, e.yj) <= y1) & (F.greatest(e.yi, e.yj) >= y0) & (F.greatest(e.xi, e.xj) >= x0))

    none = F.lit(None).cast("array<struct<xi:double,yi:double,xj:double,yj:double>>")
    whole = F.transform(F.concat(*[inside(k) for k in range(DEPTH)]), lambda t: F.struct(t.tx.alias("tx"), t.ty.alias("ty"), none.alias("edges")))
    cut = F.transform("border0", lambda t: F.struct(t.tx.alias("tx"), t.ty.alias("ty"), telling(t).alias("edges")))
    return tree.withColumn("tile", F.explode(F.concat(whole, cut))).select(*rings.columns, "level", "tile.*")


def captures(places: DataFrame, rings: DataFrame, keys: list[str]) -> DataFrame:
    """keys..., cell_idx for each cell in each ring of three vertices or more. places: cell_idx, x, y; rings: keys..., ring.

    A ring is covered by up to (2^DEPTH + 1)^2 tiles of a side of its own, so a ring about all cells spreads over many keys; most of them take their cells without a test, and the others know the few
    edges that matter there. A cell meets the rings of its tile at each of the few sizes that there are.
    """
    v = F.col("ring")
    sides = {"x0": F.array_min(v.x), "x1": F.array_max(v.x), "y0": F.array_min(v.y), "y1": F.array_max(v.y)}
    boxed = rings.where(F.size("ring") >= 3).withColumns(sides).withColumn("size", F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")))
    tiles = cover(boxed).select(*keys, "level", "tx", "ty", "edges")
    levels = sorted(r.level for r in tiles.select("level").distinct().collect())  # at most as many as doubles have exponents
    at = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), tile(F.col("x"), 2.0**k).alias("tx"), tile(F.col("y"), 2.0**k).alias("ty")) for k in levels] or [F.lit(None).cast("struct<level:int,tx:bigint,ty:bigint>")]))
    each = places.select("cell_idx", "x", "y", at.alias("at")).select("cell_idx", "x", "y", "at.*")
    met = each.join(tiles, ["level", "tx", "ty"])
    return met.where(F.col("edges").isNull() | crossed_oddly(F.col("x"), F.col("y"), F.col("edges"))).select(*keys, "cell_idx")


def neighbours(places: DataFrame, reach: float, by: list[str], of: DataFrame | None = None, carried: list[str] | None = None) -> DataFrame:
    """by..., a, b (with xa, ya, xb, yb) for all ordered pairs within `reach`, itself included; a is in `of` where that is given. places: by..., cell_idx, x, y.

    With `carried`, these columns of `of` stand beside a, and tx and ty say in which tile a pair met: rows of a tile are in one task already.
    """
    carried, met_at = carried or [], [] if carried is None else ["tx", "ty"]
    at = lambda df, *more: df.select(*by, "cell_idx", "x", "y", tile(F.col("x"), reach).alias("tx"), tile(F.col("y"), reach).alias("ty"), *more)
    near = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    left = at(places if of is None else of, *carried).select(*by, F.col("cell_idx").alias("a"), F.col("x").alias("xa"), F.col("y").alias("ya"), "tx", "ty", near.alias("n"), *carried)
    left = left.select(*by, "a", "xa", "ya", (F.col("tx") + F.col("n.i")).alias("tx"), (F.col("ty") + F.col("n.j")).alias("ty"), *carried)
    right = at(places).select(*by, F.col("cell_idx").alias("b"), F.col("x").alias("xb"), F.col("y").alias("yb"), "tx", "ty")
    dx, dy = F.col("xa") - F.col("xb"), F.col("ya") - F.col("yb")
    met = left.join(right.hint("merge"), [*by, "tx", "ty"]).where(dx * dx + dy * dy <= reach * reach)
    return met.select(*by, "a", "xa", "ya", *carried, "b", "xb", "yb", *met_at)
