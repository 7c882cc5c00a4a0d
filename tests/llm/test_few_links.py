"""Rows that comparing texts in blocks makes."""

import numpy as np
from pyspark.sql import functions as F

from cellweave.llm import shingle_copies


def test_blocks_make_fewer_pairs_than_rows(spark):
    """All of 120 sets are linked with each other; what comes out joins them all, and each two blocks make fewer pairs than they hold sets."""
    rows = spark.range(120).select(F.lit(1).cast("long").alias("key"), "id", F.lit(3).alias("blocks"), F.array("id").alias("set"))
    found = shingle_copies.in_blocks(rows, "key", [], lambda number, sets, left, right: np.ones((len(left), len(right)), dtype=bool)).collect()
    assert 119 <= len(found) < 3 * 120
    root = list(range(120))
    for a, b in found:
        x, y = root[a], root[b]
        root = [x if r == y else r for r in root]
    assert len(set(root)) == 1


def test_counts_in_common_as_sets_have_them():
    draw = np.random.default_rng(5)
    sets = [np.unique(draw.integers(0, 6000, n)) for n in (1, 40, 900, 3000, 5000, 5000)]
    left, right = np.array([0, 2, 4]), np.array([1, 3, 5])
    assert shingle_copies.common_counts(sets, left, right).tolist() == [[len(np.intersect1d(sets[a], sets[b])) for b in right] for a in left]
