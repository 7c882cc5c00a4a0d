import math
import random

import pytest
from pyspark.sql import functions as F

from cellweave.functions.geometry import in_any_ring, in_ring, ring_of
from cellweave.operators import regions
from cellweave.operators.spatial_join import captures, neighbours
from cellweave.sources import sinks

RING = "region string, ring_no int, ring array<struct<x:double,y:double>>"


def ids(df):
    return sorted(r.cell_idx for r in df.collect())


def inside(x, y, ring):
    return sum((yi > y) != (yj > y) and x < (xj - xi) * (y - yi) / (yj - yi) + xi for (xi, yi), (xj, yj) in zip(ring, ring[-1:] + ring[:-1], strict=True)) % 2 == 1


def test_ring_against_half_planes(spark):
    draw = random.Random(20260727)
    rows = []
    for _ in range(50):
        turns = sorted(draw.uniform(0, 2 * math.pi) for _ in range(4))
        quad = [(10 * math.cos(t), 8 * math.sin(t)) for t in turns]
        for _ in range(40):
            x, y = draw.uniform(-12, 12), draw.uniform(-12, 12)
            sides = [(bx - ax) * (y - ay) - (by - ay) * (x - ax) for (ax, ay), (bx, by) in zip(quad, quad[1:] + quad[:1], strict=True)]
            if min(map(abs, sides)) > 1e-6:
                rows.append((x, y, quad, all(s > 0 for s in sides)))
    df = spark.createDataFrame(rows, "x double, y double, ring array<struct<x:double,y:double>>, expected boolean")
    assert df.where(in_ring(F.col("x"), F.col("y"), F.col("ring")) != F.col("expected")).count() == 0


def test_several_rings_and_holes(places):
    outer, hole = ring_of([(-5, -5), (5, -5), (5, 5), (-5, 5)]), ring_of([(-0.2, -0.2), (0.8, -0.2), (0.8, 0.8), (-0.2, 0.8)])
    found = places.where(in_any_ring(F.col("x"), F.col("y"), F.array(outer, hole, ring_of([(0, 0), (9, 9)]))))
    assert ids(found) == [0, 1, 2, 3, 5, 6, 7, 8, 9]


def test_shapes(places, square):
    assert ids(regions.select(places, "polygon", square)) == [0, 1, 2, 3, 5]
    assert ids(regions.select(places, "rectangle", [(4, 4), (0, 3)])) == [6, 7, 8]
    assert ids(regions.select(places, "circle", [(0, 0), (1.5, 9)])) == [0, 1, 2, 5]
    assert ids(regions.select(places, "circle", [(0, 0), (4, 0), (0, 1)])) == [0, 2]
    assert ids(regions.select(places, "circle", [(0, 0), (0, 4)])) == []
    # a flat box turned by 45 degrees lies along the diagonal
    assert ids(regions.select(places, "rectangle", [(-6, -0.1), (6, 0.1)], math.pi / 4)) == [0, 1, 2, 3, 5, 7, 9]
    for tool, path in (("lasso", square[:2]), ("rectangle", square[:1]), ("circle", square[:1])):
        assert ids(regions.select(places, tool, path)) == []
    with pytest.raises(ValueError):
        regions.select(places, "brush", square)
    batch = regions.select_batch(places, [{"name": "a", "tool": "polygon", "path": square}, {"name": "b", "tool": "circle", "path": [(0, 0), (1.5, 0)]}])
    assert sorted((r.selection, r.cell_idx) for r in batch.collect()) == [("a", i) for i in (0, 1, 2, 3, 5)] + [("b", i) for i in (0, 1, 2, 5)]


def test_captures_and_neighbours_against_all_pairs(spark):
    draw = random.Random(1)
    points = [(i, draw.uniform(-50, 50), draw.uniform(-50, 50)) for i in range(400)]
    rings = [(f"r{k}", [(cx + s * math.cos(t), cy + s * math.sin(2 * t)) for t in (0.1, 1.2, 2.5, 3.9, 5.0)]) for k in range(25) for cx, cy, s in [(draw.uniform(-60, 60), draw.uniform(-60, 60), draw.choice([1, 5, 40]))]]
    at = spark.createDataFrame(points, "cell_idx long, x double, y double")
    found = captures(at, spark.createDataFrame(rings, "region string, ring array<struct<x:double,y:double>>"), ["region"])
    assert sorted((r.region, r.cell_idx) for r in found.collect()) == sorted((k, i) for i, x, y in points for k, ring in rings if inside(x, y, ring))
    near = neighbours(at.withColumn("s", F.lit(1)), 6.0, ["s"])
    assert sorted((r.a, r.b) for r in near.collect()) == [(i, j) for i, x, y in points for j, u, v in points if (x - u) ** 2 + (y - v) ** 2 <= 36]


def test_recapture(spark, places, square):
    rings = spark.createDataFrame([("near", 0, square), ("far", 0, [(99.0, 99.0), (100.0, 99.0), (100.0, 100.0)])], RING)
    rows = {r.region: r for r in regions.recapture(places, rings).collect()}
    assert (rows["near"].n, rows["near"].failed, rows["far"].n, rows["far"].failed) == (5, False, 0, True)
    assert rows["near"].centroid_x == 0.5 and rows["far"].centroid_x is None
    assert regions.recapture(places.limit(0), rings).where("failed").count() == 2


def test_fallback_and_last_region(spark, places, square):
    t = lambda rows: spark.createDataFrame(rows, "region string, cell_idx long")
    found = regions.first_found([t([("a", 1)]), t([("a", 2), ("b", 3)]), t([("b", 4), ("c", 5)])])
    assert sorted(map(tuple, found.collect())) == [("a", 1), ("b", 3), ("c", 5)]
    order = spark.createDataFrame([("a", 0), ("b", 1)], "region string, ordinal int")
    labels = regions.last_region(t([("a", 1), ("b", 1), ("a", 2)]), order)
    assert {r.cell_idx: r.label for r in labels.collect()} == {1: "b", 2: "a"}
    column = sinks.attribute_column(places, labels.unionAll(spark.createDataFrame([(99, "z")], labels.schema)), "group")
    assert column.count() == 10 and column.where("group is not null").count() == 2
    with pytest.raises(ValueError):
        sinks.attribute_column(places, labels, " ")


def test_rings_move_rigidly(spark, coords, square):
    rings = spark.createDataFrame([("a", 0, square), ("none", 0, square)], RING)
    members = spark.createDataFrame([("a", i) for i in range(5)], "region string, cell_idx long")
    rows = {r.region: r for r in regions.move_rings(rings, members, coords, "spatial", "X_layout").collect()}
    assert [(v.x, v.y) for v in rows["a"].ring] == [(x + 50, y - 20) for x, y in square]
    assert [(v.x, v.y) for v in rows["none"].ring] == square and rows["none"].centroid_x is None
    assert [(v.x, v.y) for v in regions.move_rings(rings, members, coords, "spatial", "spatial").where("region = 'a'").first().ring] == square
    votes = regions.vote(rings, members, coords).collect()
    assert [(r.region, r.key) for r in votes] == [("a", "spatial")]


def test_deltas(spark):
    lists = spark.createDataFrame([("a", "5,3,4,8"), ("b", ""), ("c", " 7 "), ("d", "1,,2")], "region string, text string")
    rows = regions.decode_deltas(lists, "region", "text").orderBy("region", "position").collect()
    assert [(r.region, r.cell_idx) for r in rows] == [("a", 5), ("a", 8), ("a", 12), ("a", 20), ("c", 7), ("d", 1), ("d", 3)]
    members = spark.createDataFrame([("x", i) for i in (20, 5, 12, 8, 5)], "region string, cell_idx long")
    assert [tuple(r) for r in regions.delta_text(regions.encode_blocks(members)).collect()] == [("x", 0, "5,3,4,8")]
    many = spark.range(0, 5000, 3).selectExpr("if(id % 2 = 0, 'p', 'q') as region", "id as cell_idx")
    for size in (1, 7, 1000, 1 << 20):
        steps = regions.encode_blocks(many.unionAll(many), size)
        rows = sorted(map(tuple, regions.decode_blocks(steps, "region").collect()))
        assert rows == [(r, k, c) for r, first in (("p", 0), ("q", 3)) for k, c in enumerate(range(first, 5000, 6))]


def test_members(spark):
    members = spark.range(1001).select(F.lit("r").alias("region"), (F.col("id") * 2).alias("cell_idx"))
    assert ids(regions.first_members(members, 3)) == [0, 2, 4]
    assert ids(regions.spread_members(members, 100)) == [20 * i for i in range(100)]
    assert ids(regions.spread_members(members, 5000)) == [2 * i for i in range(1001)]
    new = spark.createDataFrame([("r", 1), ("s", 2)], "region string, cell_idx long")
    assert sorted(map(tuple, regions.upsert(members, new).collect())) == [("r", 1), ("s", 2)]


def test_masks_are_kept(spark, places, coords, square, tmp_path):
    path = f"file://{tmp_path}/masks"
    rings = spark.createDataFrame([("a", 0, square)], RING)
    groups = spark.createDataFrame([("g", 0, "a", True, False)], "grp string, ordinal int, region string, expanded boolean, visible boolean")
    tools = spark.createDataFrame([("a", "manual")], "region string, tool string")
    tables = regions.masks(rings, regions.capture(places, rings), places, groups, "spatial", tools)
    for name in ("one", "two"):
        sinks.save_masks(path, name, tables)
    sinks.save_masks(path, "two", regions.rename(tables, "a", "b"))
    stored = sinks.load_masks(spark, path, "one")
    assert ids(stored["region_cells"]) == [0, 1, 2, 3, 5] and stored["regions"].first().tool == "polygon"
    assert [r.region for r in sinks.load_masks(spark, path, "two")["region_groups"].collect()] == ["b"]
    for verify in (False, True):
        moved = regions.loaded_masks(stored, coords, "X_layout", verify)["region_rings"].first()
        assert [(v.x, v.y) for v in moved.ring] == [(x + 50, y - 20) for x, y in square]
    # a wrong name gives way to where the ring lies
    wrong = {**stored, "regions": stored["regions"].withColumn("embedding", F.lit("X_layout"))}
    assert regions.loaded_masks(wrong, coords, "X_layout", True)["region_rings"].first().ring[0].x == 47.5
    assert tuple(regions.totals(stored).first()) == (1, 1, 5)
    # another name of the same places stays
    twin = coords.unionAll(coords.where("key = 'spatial'").withColumn("key", F.lit("A_twin")))
    assert regions.same_embedding(twin, "spatial", "A_twin") and not regions.same_embedding(twin, "spatial", "X_layout") and not regions.same_embedding(twin, "spatial", "none")
    assert regions.embedding_of(stored, twin, True) == "spatial"
    about = sinks.load_masks(spark, path, "one")["mask_info"].first()
    assert (about.fill_opacity, about.outline_weight, about.alpha, about.form) == (0.1, 2.0, 0.05, "regions")
    with pytest.raises(ValueError):
        regions.move_paths(rings.select("region", "ring"), stored["region_cells"], coords, "spatial", "X_none")
    assert regions.rename(tables, "a", " ") is tables
    with pytest.raises(ValueError):
        sinks.load_masks(spark, path, "three")
