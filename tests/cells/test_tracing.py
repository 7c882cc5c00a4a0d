"""Rings traced by edges alone: long ones, holes, rings that touch, and ways that are no ring."""

import math
import random

import pytest

from cellweave.operators import outline, tracing
from cellweave.operators.graph import cut

EDGES = "region string, a long, b long, side int, xa double, ya double, xb double, yb double"


def edges_of(spark, ways, at, region="r"):
    """Directed edges p to q with the inside to their left, in the form that rings takes."""
    rows = [(region, min(p, q), max(p, q), -1 if p < q else 1, *at[min(p, q)], *at[max(p, q)]) for p, q in ways]
    return spark.createDataFrame(rows, EDGES)


def closed(ids):
    return list(zip(ids, ids[1:] + ids[:1], strict=True))


def drawn(found):
    return {(r.region, r.ring_no): [(v.x, v.y) for v in r.ring] for r in found.collect()}


def test_long_rings_and_holes(spark):
    draw = random.Random(5)
    ids = draw.sample(range(5000), 1500)
    circle = lambda some, r: {c: (r * math.cos(2 * math.pi * k / len(some)), r * math.sin(2 * math.pi * k / len(some))) for k, c in enumerate(some)}
    outer, hole, island = ids[:1000], ids[1000:1400], ids[1400:]
    at = circle(outer, 50.0) | circle(hole, 20.0) | circle(island, 5.0)
    edges = edges_of(spark, closed(outer) + closed(hole[::-1]) + closed(island), at).unionAll(edges_of(spark, closed(island), at, "other"))
    got = drawn(tracing.rings(edges))
    turned = lambda some: [at[c] for c in some[some.index(min(some)) :] + some[: some.index(min(some))]]
    assert got == {("r", 0): turned(outer), ("r", 1): turned(hole[::-1]), ("r", 2): turned(island), ("other", 0): turned(island)}
    assert sorted(drawn(tracing.rings(edges, exterior_only=True))) == [("other", 0), ("r", 0), ("r", 2)]


def test_rings_that_touch(spark):
    at = {0: (0.0, 0.0), 1: (10.0, 0.0), 2: (10.0, 10.0), 3: (0.0, 10.0), 4: (4.0, 2.0), 5: (2.0, 4.0), 6: (20.0, 4.0), 7: (20.0, 16.0), 8: (-6.0, -2.0), 9: (-2.0, -6.0)}
    square, hole, right, left = [0, 1, 2, 3], [0, 5, 4], [2, 6, 7], [0, 8, 9]  # a hole and another ring meet the square at 0, one more meets it at 2
    got = drawn(tracing.rings(edges_of(spark, closed(square) + closed(hole) + closed(right) + closed(left), at)))
    assert sorted(got.values()) == sorted([at[c] for c in ring] for ring in (square, hole, right, left))
    only = drawn(tracing.rings(edges_of(spark, closed(square) + closed(hole), at), exterior_only=True))
    assert only == {("r", 0): [at[c] for c in square]}


def test_ways_and_nothing(spark):
    at = {k: (float(k), float(k * k % 7)) for k in range(40)}
    at |= {100: (0.0, 50.0), 101: (5.0, 50.0), 102: (5.0, 55.0)}
    way = list(zip(range(39), range(1, 40), strict=True))
    assert drawn(tracing.rings(edges_of(spark, way + closed([100, 101, 102]), at))) == {("r", 0): [at[100], at[101], at[102]]}
    assert tracing.rings(edges_of(spark, way, at)).count() == 0
    assert tracing.rings(edges_of(spark, [], at)).count() == 0


@pytest.mark.parametrize(("n", "spread", "radius"), [(150, 4, 1.0), (200, 3, 0.6), (120, 5, 1.6)])
def test_rings_hold_every_edge_once(spark, n, spread, radius):
    draw = random.Random(n)
    places = spark.createDataFrame([("r", i, draw.gauss(0, spread), draw.gauss(0, spread)) for i in range(n)], "region string, cell_idx long, x double, y double")
    edges = cut(outline.boundary(places, 1 / radius))
    found = cut(tracing.rings(edges))
    rings = drawn(found)
    wanted = {frozenset([(e.xa, e.ya), (e.xb, e.yb)]) for e in edges.collect()}
    steps = [frozenset(s) for ring in rings.values() for s in closed(ring)]
    assert len(steps) == len(set(steps)) and set(steps) == wanted
    assert all(len(set(ring)) == len(ring) >= 3 for ring in rings.values())
    sizes = [abs(outline.area(rings["r", k])) for k in range(len(rings))]
    assert sizes == sorted(sizes, reverse=True)
    depth = {r.ring_no: r.depth for r in outline.nesting(found).collect()}
    assert all((outline.area(rings["r", k]) > 0) == (depth[k] % 2 == 0) for k in depth)
