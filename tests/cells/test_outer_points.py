"""Points that tiles leave out of an outline before any arc is looked at."""

import numpy as np
from pyspark.sql import functions as F

from cellweave.operators import outline


def test_points_far_inside_are_left_out_by_tiles(spark):
    """With 16 times the points in the same square, about four times as many stay for the arcs; all on edges do."""
    stay = {}
    for n in (4000, 64000):
        places = spark.range(n).select(F.lit("r").alias("region"), F.col("id").alias("cell_idx"), (F.rand(1) * 100).alias("x"), (F.rand(2) * 100).alias("y")).localCheckpoint()
        near = {r.cell_idx for r in outline.near_gaps(places, 8.0).collect()}
        ends = {c for r in outline.alpha_edges(places, 0.125).collect() for c in (r.a, r.b)}
        assert ends <= near
        stay[n] = len(near)
    assert stay[4000] < 2000 and stay[64000] < 8 * stay[4000], stay


def test_open_tiles_as_by_all_discs():
    rng = np.random.default_rng(3)
    held, fine = rng.random((30, 40)) < 0.6, 8
    held[8:20, 8:24] = True
    y, x = np.nonzero(held)
    cy, cx = (g.ravel() for g in np.mgrid[-12:42, -12:52])
    dy, dx = np.abs(cy[:, None] - y), np.abs(cx[:, None] - x)
    gaps = ~((dy + 1) ** 2 + (dx + 1) ** 2 <= (fine - outline.MOVED) ** 2).any(axis=1)
    touched = (np.maximum(dy - 1, 0) ** 2 + np.maximum(dx - 1, 0) ** 2 <= (fine + outline.MOVED) ** 2)[gaps].any(axis=0)
    found = outline.open_tiles(held, fine)
    assert (found[y, x] == touched).all() and not found[~held].any()
    assert 0 < found.sum() < held.sum()
