"""Rings from boundary edges, where no task holds a region's edges.

Every edge is directed so that what is inside lies to its left. At a vertex an edge that comes in goes on along the next one out, clockwise: what lies between is
inside. So each edge has one that follows. Reaching twice as far in each round, an edge learns the least edge of its ring and how many steps ahead that is,
which is its place in the ring; rounds grow with the logarithm of the longest ring, and each is a join in which every key stands once.

A ring that comes to a vertex again (a hole touches the outside there) is parted at it: what came in goes on where the visit before went out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.operators.color import numbered
from cellweave.operators.graph import cut

LEAST_VERTICES = 3


def directed(edges: DataFrame) -> DataFrame:
    """id, region, p, q, xp, yp, xq, yq: the edges (region, a, b, side, xa, ya, xb, yb), where side 1 says that what lies left of a to b is outside."""
    pick = lambda x, y, name: F.when(F.col("side") == 1, F.col(y)).otherwise(F.col(x)).alias(name)
    ends = [pick("a", "b", "p"), pick("b", "a", "q"), pick("xa", "xb", "xp"), pick("ya", "yb", "yp"), pick("xb", "xa", "xq"), pick("yb", "ya", "yq")]
    return cut(edges.select("region", *ends).withColumn("id", F.monotonically_increasing_id()))


def following(steps: DataFrame) -> DataFrame:
    """id, next of the edges that go on. Edges in and out alternate about a vertex; where too few go out some edges have no next."""
    ray = lambda v, w: F.struct(F.atan2(F.col(f"y{w}") - F.col(f"y{v}"), F.col(f"x{w}") - F.col(f"x{v}")).alias("angle"), "id").alias("ray")
    rays = steps.select("region", F.col("p").alias("v"), F.lit(True).alias("out"), ray("p", "q")).unionAll(steps.select("region", "q", F.lit(False), ray("q", "p")))
    some = lambda which: F.sort_array(F.collect_list(F.when(which, F.col("ray"))))
    about = rays.groupBy("region", "v").agg(some(F.col("out")).alias("outs"), some(~F.col("out")).alias("ins"))
    # clockwise from the k-th edge in lies the k-th out, or the one before it where the first ray is an edge in
    shift = F.when(F.get("outs", F.lit(0)).angle < F.get("ins", F.lit(0)).angle, 0).otherwise(-1)
    each = about.select("outs", F.size("outs").alias("n"), shift.alias("shift"), F.posexplode("ins").alias("k", "came")).where("k < n")
    return each.select(F.col("came.id").alias("id"), F.get("outs", F.pmod(F.col("k") + F.col("shift"), F.greatest("n", F.lit(1)))).id.alias("next"))


def on_rings(steps: DataFrame, links: DataFrame) -> DataFrame:
    """id, low (p and q of the ring's least edge) and ahead (steps from here to it) of the edges that lie on a ring."""
    state = cut(steps.select("id", F.struct("p", "q").alias("low")).join(links, "id", "left").select("id", "next", "low", F.lit(0).cast("long").alias("ahead")))
    span, done = 1, False
    while not done:
        there = state.select(F.col("id").alias("next"), F.col("next").alias("after"), F.col("low").alias("low_there"), F.col("ahead").alias("ahead_there"))
        lower = F.coalesce(F.col("low_there") < F.col("low"), F.lit(False))
        ended = F.col("next").isNotNull() & F.col("after").isNull()
        low, ahead = F.when(lower, F.col("low_there")).otherwise(F.col("low")), F.when(lower, F.col("ahead_there") + span).otherwise(F.col("ahead"))
        state = cut(state.join(there, "next", "left").select("id", F.col("after").alias("next"), low.alias("low"), ahead.alias("ahead"), (lower | ended).alias("changed")))
        span, done = 2 * span, state.where("changed").isEmpty()  # a longer ring or way has an edge for which the second half of the span tells more
    return state.where("next is not null").select("id", "low", "ahead")


def place(ahead: Column) -> Column:
    """Orders the edges of a ring, the least first."""
    return F.when(ahead == 0, F.lit(-(2**62))).otherwise(-ahead)


def parted(links: DataFrame, steps: DataFrame, again: DataFrame) -> DataFrame:
    """links, where each visit of a ring to a vertex (again: region, low, p) but the first goes back to where the one before went out, and the first to the last."""
    visits = steps.join(again, ["region", "low", "p"]).groupBy("region", "low", "p").agg(F.sort_array(F.collect_list(F.struct(place(F.col("ahead")).alias("place"), "id"))).alias("outs"))
    each = visits.select("outs", F.posexplode("outs").alias("k", "out"))
    instead = each.select(F.col("out.id").alias("next"), F.get("outs", F.pmod(F.col("k") - 1, F.size("outs"))).id.alias("instead"))
    return links.join(instead, "next", "left").select("id", F.coalesce("instead", "next").alias("next"))


def simple_rings(edges: DataFrame) -> DataFrame:
    """The directed edges that lie on rings, with low and ahead; no ring comes to a vertex twice."""
    steps = directed(edges)
    links, first = cut(following(steps)), True
    while True:
        found = cut(steps.join(on_rings(steps, links), "id"))
        again = cut(found.groupBy("region", "low", "p").count().where("count > 1").drop("count"))
        if again.isEmpty():
            return found
        if not first:  # rings that cross themselves, which only rounding can make, are parted at one vertex at a time
            again = again.groupBy("region", "low").agg(F.min("p").alias("p"))
        links, first = cut(parted(links, found, again)), False


def rings(edges: DataFrame, exterior_only: bool = False) -> DataFrame:
    """region, ring_no, ring from boundary edges as `directed` takes them, the ring with the largest area first, from its least vertex on. Holes run clockwise."""
    found = simple_rings(edges)
    twice = F.sum(F.col("xp") * F.col("yq") - F.col("xq") * F.col("yp"))
    sizes = found.groupBy("region", "low").agg(twice.alias("twice"), F.count("*").alias("n")).where(F.col("n") >= LEAST_VERTICES)
    by = F.struct("region", (-F.abs("twice")).alias("size"), "low").alias("by")
    counted = cut(numbered(sizes.select("region", "low", "twice", by), "by"))
    first = counted.groupBy("region").agg(F.min("number").alias("first"))
    kept = counted.where("twice > 0") if exterior_only else counted
    ring = F.transform(F.array_sort(F.collect_list(F.struct(place(F.col("ahead")).alias("place"), F.col("xp").alias("x"), F.col("yp").alias("y")))), lambda v: F.struct(v.x.alias("x"), v.y.alias("y")))
    drawn = found.groupBy("region", "low").agg(ring.alias("ring"))
    return drawn.join(kept, ["region", "low"]).join(first, "region").select("region", (F.col("number") - F.col("first")).cast("int").alias("ring_no"), "ring")
