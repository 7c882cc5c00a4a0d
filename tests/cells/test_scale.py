"""Plans that must hold for large regions: covers, ranks, prefix sums and samples, against plain versions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cellweave.operators import color, page, regions
from cellweave.operators.spatial_join import DEPTH, captures, cover
from cellweave.sources import sinks
from cellweave.sources.cells import CellSet, points

RING = "region string, ring array<struct<x:double,y:double>>"


def inside(x, y, ring):
    odd = False
    for (xi, yi), (xj, yj) in zip(ring, ring[-1:] + ring[:-1], strict=True):
        if (yi > y) != (yj > y) and x < (xj - xi) * (y - yi) / (yj - yi) + xi:
            odd = not odd
    return odd


@pytest.fixture(scope="module")
def rings():
    draw = random.Random(4)
    star = lambda cx, cy, r, n: [(cx + r * draw.uniform(0.3, 1) * math.cos(2 * math.pi * k / n), cy + r * draw.uniform(0.3, 1) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    found = {f"star{k}": star(draw.uniform(-50, 50), draw.uniform(-50, 50), r, n) for k, (r, n) in enumerate([(1, 5), (10, 9), (40, 40), (100, 300), (0.01, 7), (64, 4)])}
    found["all"] = [(-300.0, -300.0), (300.0, -300.0), (300.0, 300.0), (-300.0, 300.0)]
    found["tiles"] = [(-16.0, -16.0), (16.0, -16.0), (16.0, 16.0), (-16.0, 16.0)]  # edges on edges of tiles
    found["bow"] = [(0.0, 0.0), (60.0, 60.0), (60.0, 0.0), (0.0, 60.0)]
    found["flat"] = [(0.0, 5.0), (50.0, 5.0), (20.0, 5.0)]
    found["point"] = [(1.0, 1.0)] * 3
    found["two"] = [(0.0, 0.0), (9.0, 9.0)]
    return found


def test_captures_of_covered_rings(spark, rings):
    draw = random.Random(8)
    cells = [(i, draw.uniform(-120, 120), draw.uniform(-120, 120)) for i in range(1500)]
    cells += [(2000 + i, x, y) for i, (x, y) in enumerate(p for ring in rings.values() for p in ring[:20])]
    cells += [(5000 + i, float(x), float(y)) for i, (x, y) in enumerate((a, b) for a in range(-20, 21, 4) for b in range(-20, 21, 4))]
    places = spark.createDataFrame(cells, "cell_idx long, x double, y double")
    got = sorted(map(tuple, captures(places, spark.createDataFrame(list(rings.items()), RING), ["region"]).collect()))
    assert got == sorted((r, c) for r, ring in rings.items() if len(ring) > 2 for c, x, y in cells if inside(x, y, ring))


def test_one_ring_about_all_cells_spreads(spark, rings):
    draw = random.Random(9)
    places = spark.createDataFrame([(i, draw.uniform(-250, 250), draw.uniform(-250, 250)) for i in range(4000)], "cell_idx long, x double, y double")
    ring = spark.createDataFrame([("all", rings["all"])], RING).withColumns({"x0": F.lit(-300.0), "x1": F.lit(300.0), "y0": F.lit(-300.0), "y1": F.lit(300.0), "size": F.lit(600.0)})
    tiles = cover(ring)
    assert (2**DEPTH / 2) ** 2 <= tiles.count() <= (2**DEPTH + 2) ** 2 and tiles.where("edges is null").count() > tiles.count() / 2
    side = 2.0 ** tiles.first().level
    n = places.join(tiles, (F.floor(F.col("x") / side) == F.col("tx")) & (F.floor(F.col("y") / side) == F.col("ty"))).groupBy("tx", "ty").count().agg(F.max("count")).first()[0]
    assert n < 4000 / 20
    assert tiles.where("edges is not null").agg(F.max(F.size("edges"))).first()[0] <= 4


@pytest.mark.parametrize("size", [1, 7, 100, 1 << 20])
def test_ranks_by_blocks(spark, size):
    draw = random.Random(size)
    rows = [(r, draw.randrange(2000)) for r, n in (("a", 700), ("b", 3), ("c", 90)) for _ in range(n)]
    got = sorted(tuple(r) for r in regions.ranked_members(spark.createDataFrame(rows, "region string, cell_idx long"), size=size).select("region", "k", "cell_idx", "total").collect())
    want = [(r, k, c, len(own)) for r in "abc" for own in [sorted(c for q, c in rows if q == r)] for k, c in enumerate(own)]
    assert got == want


@pytest.mark.parametrize("size", [1, 3, 1 << 16])
def test_long_lists_are_summed_in_parts(spark, size):
    draw = random.Random(6)
    lists = {"p": [draw.randrange(1, 9) for _ in range(1000)], "q": [], None: [4, 5], "r": [7]}
    table = spark.createDataFrame([(k, " ,".join(map(str, v))) for k, v in lists.items()], "region string, text string")
    got = {(r.region, r.position): r.cell_idx for r in regions.decode_deltas(table, "region", "text", size).collect()}
    assert got == {(k, i): sum(v[: i + 1]) for k, v in lists.items() for i in range(len(v))}


@pytest.mark.parametrize("most", [1, 50, 999, 1000, 5000])
def test_samples_by_limit_are_the_smallest_draws(spark, most):
    seen = spark.range(1000).select(F.col("id").alias("cell_idx"), (F.pmod(F.xxhash64("id"), F.lit(97)) + 1).cast("double").alias("draw"))
    want = sorted((r.draw, r.cell_idx) for r in seen.collect())[:most]
    got = page.first_by_draw(seen, most)
    assert got.columns == ["cell_idx"] and sorted(r.cell_idx for r in got.collect()) == sorted(c for _, c in want)
    assert page.first_by_draw(seen.limit(0), most).count() == 0


def test_views_of_stored_cells_skip_zones(spark, tmp_path):
    draw = random.Random(14)
    rows = [("spatial", i, draw.gauss(0, 40), draw.gauss(0, 40), None) for i in range(3000)] + [("X_umap", i, float(i), 1.0, 2.0) for i in range(50)] + [("spatial", 9000, None, float("nan"), None)]
    coords = spark.createDataFrame(rows, "key string, cell_idx long, x float, y float, z float")
    cells = spark.range(3000).select(F.col("id").alias("cell_idx"), F.lit("s").alias("sample"), (F.col("id") % 3).cast("int").alias("chunk"))
    held = CellSet(cells, coords, spark.createDataFrame([], "cell_idx long, gene string, value float"), spark.createDataFrame([], "gene_idx int, gene string"))
    sinks.save_cells(held, f"file://{tmp_path}/set")
    again = CellSet.open(spark, f"file://{tmp_path}/set")
    assert again.cells.count() == 3000 and again.coords.count() == len(rows) and again.zones.agg(F.sum("n")).first()[0] == len(rows)
    for box in ((-10.0, 10.0, -100.0, 100.0), (30.0, 31.0, 0.0, 9.0), (5000.0, 5001.0, 0.0, 1.0)):
        places = page.stored_places(again, "spatial", box)
        want = sorted(r.cell_idx for r in page.viewport(points(coords, "spatial"), box).collect())
        assert sorted(r.cell_idx for r in page.viewport(places, box).collect()) == want
        read = lambda df: df.select(F.input_file_name().alias("f")).distinct().count()
        assert read(places) < read(points(again.coords, "spatial"))
        if want:
            plan = page.viewport(places, box)._jdf.queryExecution().executedPlan().toString()
            assert "zone" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]


@pytest.mark.parametrize("few", [0, 100_000])
def test_categories_are_numbered_alike_by_ranges_and_at_once(spark, monkeypatch, few):
    monkeypatch.setattr(color, "FEW_ROWS", few)
    some = spark.range(0, 3000, 3).select(F.concat(F.lit("k"), (F.col("id") % 7919).cast("string")).alias("category"), (F.col("id") * 7 % 3001).alias("first"))
    want = {r.category: k + 1 for k, r in enumerate(sorted(some.collect(), key=lambda r: r[1]))}
    got = {r.category: r.number for r in color.numbered(some, "first").collect()}
    assert got == want
