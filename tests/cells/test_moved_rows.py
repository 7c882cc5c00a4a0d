"""How many rows the steps of outlines move or write."""

import math
from types import SimpleNamespace

from pyspark.sql import functions as F

from cellweave.operators import cluster, outline


def crowd(spark, n, side):
    return spark.range(n).select(F.lit("r").alias("region"), F.lit("r").alias("sample"), F.col("id").alias("cell_idx"), (F.rand(1) * side).alias("x"), (F.rand(2) * side).alias("y")).localCheckpoint()


def test_arcs_are_filtered_where_they_meet(spark, monkeypatch):
    """What comes to the exchange by points is a small part of the pairs of points in reach."""
    places, radius = crowd(spark, 6000, 40.0), 8.0
    outer = outline.near_gaps(places, radius).localCheckpoint()
    some = outline.not_surrounded(places, outer, radius).localCheckpoint()
    pairs = outline.neighbours(outer, 2 * radius, ["region"], some).count()
    dealt = []
    frame = type(places)
    put = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, *by: (dealt.append(self.count()), put(self, *by))[1])
    found = outline.open_ends(outer, some, radius)
    assert len(dealt) == 1 and dealt[0] * 5 < pairs, (dealt, pairs)
    assert found.count() > 0


def test_crowded_tiles_are_told_by_their_outermost_cells(spark, monkeypatch):
    """With 64 times the cells about as many rows are written for pairs of tiles, not for pairs of their parts."""
    eps, least = 6.0, 7
    side = eps / math.sqrt(2) * (1 - 1e-12)
    rows = {}
    cut = cluster.cut
    for n in (1000, 64000):
        at = crowd(spark, n, 40.0).withColumns({"sx": cluster.tile(F.col("x"), side), "sy": cluster.tile(F.col("y"), side)})
        firsts = at.groupBy("sample", "sx", "sy").agg(F.min("cell_idx").alias("of_tile"), F.count("*").alias("n")).where(F.col("n") >= least)
        dense = at.join(firsts, ["sample", "sx", "sy"]).localCheckpoint()
        seen = SimpleNamespace(rows=0)

        def counted(df):
            out = cut(df)
            if {"a", "b"} <= set(out.columns):
                seen.rows += out.count()
            return out

        monkeypatch.setattr(cluster, "cut", counted)
        found = {(r.a, r.b) for r in cluster.near_tiles(dense, eps, side).collect()}
        cells = [(r.of_tile, r.sx, r.sy, r.x, r.y) for r in dense.collect()] if n == 1000 else []
        near = {(p[0], q[0]) for p in cells for q in cells if p[0] != q[0] and (p[3] - q[3]) ** 2 + (p[4] - q[4]) ** 2 <= eps * eps}
        assert not cells or {frozenset(x) for x in near} == {frozenset(x) for x in found}
        rows[n] = (seen.rows, len(found))
    assert all(0 < some <= 8 * pairs for some, pairs in rows.values()), rows
