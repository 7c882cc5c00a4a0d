"""Ribbons, layouts, clusters and outlines on small cases with known answers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cellweave.operators import cluster, layout, outline, ribbon, samples
from cellweave.operators.graph import FEW_ROWS, HOT, components, cut, even_join


def test_straight_ribbon(spark):
    places = spark.createDataFrame([(i, 2.0 * i + 1, 0.0) for i in range(5)], "cell_idx long, x double, y double")
    expression = spark.createDataFrame([(i, "G", float(i + 1)) for i in range(5)], "cell_idx long, gene string, value float")
    bins = ribbon.ribbon_bins(spark, ribbon.Ribbon((0, 0), (10, 0), widths=(4, 4, 4)), 5)
    genes = spark.createDataFrame([(0, "G"), (1, "Z")], "gene_idx int, gene string")
    zeros = ribbon.heatmap(places, expression, ["Z", "G"], bins, genes).where("gene = 'Z'").collect()
    assert [(r.cell_count, r.mean) for r in zeros] == [(1, 0.0)] * 5
    rows = ribbon.heatmap(places, expression, ["G", "no"], bins, genes).orderBy("bin").collect()
    assert [(r.gene, r.bin, r.cell_count, r.mean) for r in rows] == [("G", i, 1, i + 1.0) for i in range(5)]
    assert ribbon.wide(ribbon.heatmap(places, expression, ["G"], bins, genes)).first().means == [1, 2, 3, 4, 5]
    assert [r.t for r in ribbon.scaled(ribbon.heatmap(places, expression, ["G"], bins, genes)).orderBy("bin").collect()] == [0, 0.25, 0.5, 0.75, 1]
    assert [r.t for r in ribbon.scaled(ribbon.heatmap(places, expression, ["G"], bins, genes), 4, 4).orderBy("bin").collect()] == [0, 0, 0, 0, 1]
    with pytest.raises(ValueError):
        ribbon.heatmap(places, expression, [], bins, genes)


def test_missing_expression_counts_as_zero(spark):
    places = spark.createDataFrame([(i, 1.0 + i / 10, 0.0) for i in range(4)], "cell_idx long, x double, y double")
    expression = spark.createDataFrame([(0, "G", 8.0)], "cell_idx long, gene string, value float")
    rows = ribbon.heatmap(places, expression, ["G"], ribbon.ribbon_bins(spark, ribbon.Ribbon((0, 0), (10, 0)), 2), spark.createDataFrame([(0, "G")], "gene_idx int, gene string")).orderBy("bin").collect()
    assert [(r.cell_count, r.mean) for r in rows] == [(4, 2.0), (0, 0.0)]


def test_width_and_curve():
    from cellweave.functions.geometry import bezier, width_at  # noqa: F401

    assert ribbon.Ribbon((0, 0), (9, 3)).path() == [(0, 0), (3.0, 1.0), (6.0, 2.0), (9, 3)]
    assert ribbon.Ribbon((0, 0), (9, 3), ((5, 5),)).path()[1:3] == [(5, 5), (6.0, 2.0)]


@pytest.fixture(scope="module")
def grid(spark):
    """Two samples with two 3 x 3 grids each."""
    rows = [(18 * s + 9 * g + 3 * i + j, f"s{s + 1}", 100.0 * g + i - 1, 100.0 * g + j - 1) for s in (0, 1) for g in (0, 1) for i in range(3) for j in range(3)]
    return spark.createDataFrame(rows, "cell_idx long, sample string, x double, y double")


def test_clusters(grid, spark):
    labelled = cluster.density_clusters(grid, 2.0, 3)
    rows = sorted(map(tuple, cluster.summary(labelled, grid).collect()))
    assert rows == [(s, k, 9, 100.0 * k, 100.0 * k) for s in ("s1", "s2") for k in (0, 1)]
    names = {r.region for r in cluster.named_members(labelled, "all").collect()}
    assert names == {"s1_0_all", "s1_1_all", "s2_0_all", "s2_1_all"}
    with pytest.raises(ValueError):
        cluster.named_members(cluster.density_clusters(grid, 0.1, 3), "x")
    assert cluster.density_clusters(grid, 2.0, 19).count() == 0  # too few cells in every sample


def dbscan(points, eps, least):
    near = {i: [j for j, (s, u, v) in enumerate(points) if s == t and (x - u) ** 2 + (y - v) ** 2 <= eps * eps] for i, (t, x, y) in enumerate(points)}
    core, label, following = {i for i in near if len(near[i]) >= least}, {}, {}
    for i in sorted(core):
        if i in label:
            continue
        number, stack = following.get(points[i][0], 0), [i]
        following[points[i][0]] = number + 1
        while stack:
            k = stack.pop()
            if k not in label:
                label[k] = number
                stack += [j for j in near[k] if j in core]
    return [label[i] if i in core else min((label[j] for j in near[i] if j in core), default=-1) for i in range(len(points))]


@pytest.mark.parametrize("leaf", [2, 32])
def test_sparse_cells_beside_a_crowd(spark, monkeypatch, leaf):
    """Crowded spots, one of cells at one place, with single cells all about them at distances near eps."""
    monkeypatch.setattr(cluster, "LEAF", leaf)
    draw, eps, least = random.Random(leaf), 2.0, 9
    points = [("s", draw.gauss(5, 0.35), draw.gauss(5, 0.2)) for _ in range(700)] + [("s", 15.0, 5.0)] * 60 + [("s", draw.gauss(10.5, 0.1), draw.gauss(5, 0.5)) for _ in range(300)]
    points += [("s", cx + r * math.cos(t), 5 + r * math.sin(t)) for cx in (5, 10.5, 15) for r in (1.5, 1.99, 2.0, 2.3, 2.9) for t in [draw.uniform(0, 6.3) for _ in range(12)]]
    points += [("t", x, y) for _, x, y in points[600:760]]
    places = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "cell_idx long, sample string, x double, y double")
    rows = sorted(cluster.density_clusters(places, eps, least).select("cell_idx", "cluster").collect())
    assert [r.cluster for r in rows] == dbscan(points, eps, least)


def test_a_cell_meets_few_parts_of_a_crowd(spark):
    side = 2.0 / math.sqrt(2)
    crowd = spark.range(40_000).select(F.lit("s").alias("sample"), F.lit(0).cast("long").alias("of_tile"), (F.rand(1) * side).alias("x"), (F.rand(2) * side).alias("y"), F.lit(0).cast("long").alias("sx"), F.lit(0).cast("long").alias("sy"))
    crowd = cut(crowd)
    single = spark.createDataFrame([("s", 50_000 + i, 2 * side + 0.1 * i, 0.3) for i in range(5)], "sample string, cell_idx long, x double, y double").withColumns({"sx": F.lit(2).cast("long"), "sy": F.lit(0).cast("long")})
    found = {r.a: r.n for r in cluster.near_parts(single, crowd, 2.0, side, 10).collect()}
    for i in range(5):
        dx, dy = F.col("x") - (2 * side + 0.1 * i), F.col("y") - 0.3
        there = crowd.where(dx * dx + dy * dy <= 4).count()
        assert min(there, 10) <= found.get(50_000 + i, 0) <= there


@pytest.mark.parametrize(("eps", "least", "spread"), [(1.0, 4, 8.0), (2.5, 6, 9.0), (1.5, 3, 3.0), (4.0, 12, 10.0)])
def test_clusters_against_brute_force(spark, eps, least, spread):
    draw = random.Random(int(eps * 10))
    points = [(f"s{draw.randrange(2)}", draw.gauss(0, spread), draw.gauss(0, spread)) for _ in range(300)]
    at = spark.createDataFrame([(s, i, x, y) for i, (s, x, y) in enumerate(points)], "sample string, cell_idx long, x double, y double")
    found = {r.cell_idx: r.cluster for r in cluster.density_clusters(at, eps, least).collect()}
    assert [found[i] for i in range(300)] == dbscan(points, eps, least)


def test_components(spark):
    draw = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(100 + draw.randrange(80), 100 + draw.randrange(80)) for _ in range(60)] + [(300, x) for x in range(301, 340)] + [(500, 500), (60, 50)]
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(rows) == len(label) and {r.id: r.component for r in rows} == label
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_even_join_is_a_join(spark):
    n = FEW_ROWS + 3 * HOT
    left = spark.range(n).selectExpr("id", "if(id % 3 = 0, -1, id) as k")
    right = left.groupBy("k").count().withColumnRenamed("count", "n").selectExpr("k", "n", "k * 2 as twice").where("k != 4")
    rows = {(r.id, r.k, r.twice) for r in even_join(left, right, "k", left.count()).collect()}
    assert rows == {(i, k, 2 * k) for i in range(n) for k in [-1 if i % 3 == 0 else i] if k != 4}


def places_of(spark, points):
    return spark.createDataFrame([("r", i, float(x), float(y)) for i, (x, y) in enumerate(points)], "region string, cell_idx long, x double, y double")


def test_hull(spark):
    draw = random.Random(2)
    points = [(draw.randrange(30), draw.randrange(30)) for _ in range(200)] + [(-1, -1), (31, -1), (31, 31), (-1, 31), (10, -1), (-1, 7)]
    rows = outline.hull(places_of(spark, points)).orderBy("position").collect()
    assert [(r.x, r.y) for r in rows] == [(-1, -1), (31, -1), (31, 31), (-1, 31)]
    assert outline.hull(places_of(spark, [(1, 1), (1, 1), (2, 2)])).count() == 2


def test_outline_of_a_grid_with_a_hole(spark):
    points = [(i, j) for i in range(12) for j in range(12) if not (4 <= i <= 7 and 4 <= j <= 7)]
    places = places_of(spark, points)
    edges = outline.alpha_edges(places, 1 / 1.2)
    assert edges.count() == 44 + 16  # the corners of the hole are cut off
    members = places.select("region", "cell_idx")
    rings, failed = outline.outlines(members, places.drop("region"), 1 / 1.2)
    rows = rings.orderBy("ring_no").collect()
    assert [abs(outline.area([(v.x, v.y) for v in r.ring])) for r in rows] == [121.0, 23.0] and failed.count() == 0
    only, _ = outline.outlines(members, places.drop("region"), 1 / 1.2, exterior_only=True)
    assert [r.ring_no for r in only.collect()] == [0]
    whole, _ = outline.outlines(members, places.drop("region"), 0)
    assert abs(outline.area([(v.x, v.y) for v in whole.first().ring])) == 121.0
    with pytest.raises(ValueError):
        outline.alpha_edges(places, 0)


def alpha_brute(points, radius):
    """Pairs closer than 2R with exactly one empty disc."""
    found = set()
    for i, (x, y) in enumerate(points):
        for j, (u, v) in enumerate(points[:i]):
            q = (x - u) ** 2 + (y - v) ** 2
            if 0 < q < 4 * radius * radius:
                rise, empty = math.sqrt((radius * radius - q / 4) / q), 0
                for s in (1, -1):
                    cx, cy = (x + u) / 2 - s * rise * (v - y), (y + v) / 2 + s * rise * (u - x)
                    empty += all((a - cx) ** 2 + (b - cy) ** 2 >= (radius - 1e-9) ** 2 for k, (a, b) in enumerate(points) if k not in (i, j))
                if empty == 1:
                    found.add((j, i))
    return found


@pytest.mark.parametrize(("n", "spread", "radius"), [(150, 4, 1.0), (150, 4, 3.0), (200, 1.5, 0.7), (60, 10, 2.5), (200, 3, 20.0)])
def test_alpha_edges_against_all_discs(spark, n, spread, radius):
    draw = random.Random(n + int(10 * radius))
    points = [(draw.gauss(0, spread), draw.gauss(0, spread)) for _ in range(n)]
    rows = outline.alpha_edges(places_of(spark, points), 1 / radius).collect()
    assert len(rows) == len(set(map(tuple, rows))) and {(r.a, r.b) for r in rows} == alpha_brute(points, radius)


def test_islands_in_holes(spark):
    """Three nested squares: the one in the midst is no hole."""
    square = lambda k: [{"x": float(x), "y": float(y)} for x, y in ((-k, -k), (k, -k), (k, k), (-k, k))]
    found = spark.createDataFrame([("r", 0, square(9)), ("r", 1, square(5)), ("r", 2, square(2)), ("s", 0, square(4))], "region string, ring_no int, ring array<struct<x:double,y:double>>")
    assert sorted(map(tuple, outline.nesting(found).collect())) == [("r", 0, 0), ("r", 1, 1), ("r", 2, 2), ("s", 0, 0)]
    filled = [(i, j) for i in range(-9, 10) for j in range(-9, 10) if max(abs(i), abs(j)) in (9, 8, 7, 1, 0)]
    places = places_of(spark, filled)
    only, _ = outline.outlines(places.select("region", "cell_idx"), places.drop("region"), 1 / 1.2, exterior_only=True)
    assert sorted(abs(outline.area([(v.x, v.y) for v in r.ring])) for r in only.collect()) == [4.0, 324.0]


def test_outline_failures(spark):
    members = spark.createDataFrame([("few", 0), ("few", 1), ("apart", 2), ("apart", 3), ("apart", 4)], "region string, cell_idx long")
    places = spark.createDataFrame([(i, 100.0 * i, 7.0 * i * i) for i in range(5)], "cell_idx long, x double, y double")
    rings, failed = outline.outlines(members, places, 1.0)
    assert rings.count() == 0 and {r.region: r.reason for r in failed.collect()} == {"few": "fewer than 3 cells", "apart": "no outline"}
    wanted = members.select("region").distinct().unionAll(spark.createDataFrame([("gone",)], "region string"))
    _, failed = outline.outlines(members, places, 1.0, wanted=wanted)
    assert {r.region: r.reason for r in failed.collect()} == {"few": "fewer than 3 cells", "apart": "no outline", "gone": "no members"}
    with pytest.raises(ValueError):
        outline.outlined_regions(members, places, 1.0, 10)


def test_layout_moves_samples_rigidly(spark, cells, places):
    targets = layout.group_grid(cells, places, group_by="condition")
    rows = {r.sample: r for r in targets.collect()}
    assert [rows[s].grp for s in ("s1", "s2")] == ["ctrl", "treated"]
    moved = {r.cell_idx: (r.x, r.y) for r in layout.move_cells(cells, places, targets).collect()}
    before = {r.cell_idx: (r.x, r.y) for r in places.collect()}
    for first in (0, 5):
        for k in range(first, first + 5):
            for a in (0, 1):
                assert abs((moved[k][a] - moved[first][a]) - (before[k][a] - before[first][a])) < 1e-9
    for s, of in (("s1", range(5)), ("s2", range(5, 10))):
        assert abs(sum(moved[i][0] for i in of) / 5 - rows[s].target_x) < 1e-9
    assert {r.grp for r in layout.group_grid(cells, places).collect()} == {"all"}


def test_rebuilt_layout(spark):
    cells = spark.createDataFrame([(i, f"s{1 + i // 3}") for i in range(6)], "cell_idx long, sample string")
    places = spark.createDataFrame([(i, *((0.0, 0.0), (3.0, 0.0), (0.0, 3.0))[i % 3]) for i in range(6)], "cell_idx long, x double, y double")
    targets = spark.createDataFrame([("s1", 100.0, 0.0), ("s9", 5.0, 5.0)], "sample string, target_x double, target_y double")
    rows = {r.cell_idx: (r.x, r.y) for r in layout.rebuild(cells, places, targets).collect()}
    assert rows == {0: (99, -1), 1: (102, -1), 2: (99, 2), 3: (0, 0), 4: (3, 0), 5: (0, 3)}
    ends, labels = layout.loaded(cells, places)
    assert tuple(ends.first()) == (0, 3, 0, 3, 6) and {r.sample: (r.x, r.y) for r in labels.collect()} == {"s1": (1, 1), "s2": (1, 1)}


def test_sample_attribute(spark):
    rows = [(0, "a", "x"), (1, "a", "nan"), (2, "a", None), (3, "b", "x"), (4, "b", "y"), (5, "c", " "), (6, "nan", "z"), (7, "nan", "q")]
    found = samples.sample_attribute(spark.createDataFrame(rows, "cell_idx long, sample string, v string"), "v")
    got = {r.sample: (r.category, r.valid) for r in found.collect()}
    assert got == {"a": ("x", True), "b": ("x", False), "c": (samples.MISSING, True), "nan": (samples.MISSING, True)}


def test_square_layout_skips_unassigned_samples(spark):
    cells = spark.createDataFrame([(i, f"s{i // 2}" if i < 10 else "NaN") for i in range(12)], "cell_idx long, sample string")
    places = spark.createDataFrame([(i, float(i % 2), float(i % 2) * 2) for i in range(12)], "cell_idx long, x double, y double")
    rows = sorted(layout.auto_square(cells, places, gap=0.0).collect())
    assert [(r.sample, r.target_x, r.target_y) for r in rows] == [("s0", 0.5, 1), ("s1", 1.5, 1), ("s2", 2.5, 1), ("s3", 0.5, 3), ("s4", 1.5, 3)]
    turned = sorted(layout.auto_square(cells, places, gap=0.0, transpose=True).collect())
    assert [(r.target_x, r.target_y) for r in turned] == [(0.5, 1), (1.5, 1), (0.5, 3), (1.5, 3), (0.5, 5)]
    assert math.isclose(samples.upper_median(samples.sample_stats(cells, places), "h").first()[0], 2.0)
    assert layout.adjusted({"gap": 1.0, "rows": "x"}, gap=3.0, transpose=None) == {"gap": 3.0, "rows": "x"}
    with pytest.raises(Exception, match="nothing"):
        layout.group_grid(cells, places, sort_by="nothing").collect()
