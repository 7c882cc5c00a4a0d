"""Masks that are stored several times find their members once."""

from pyspark.sql import functions as F

from cellweave.operators import regions
from cellweave.sources import sinks


def test_members_are_found_once_however_often_masks_are_stored(spark, places, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def seen(rows):
        for batch in rows:
            calls.add(len(batch))
            yield batch

    members = places.select(F.lit("r").alias("region"), "cell_idx").mapInPandas(seen, "region string, cell_idx long")
    rings = spark.createDataFrame([], "region string, ring_no int, ring array<struct<x:double,y:double>>")
    groups = spark.createDataFrame([], "grp string, ordinal int, region string, expanded boolean, visible boolean")
    tables = regions.masks(rings, members, places, groups, "spatial")
    for name in ("one", "two"):
        sinks.save_masks(str(tmp_path / "masks"), name, tables)
    assert calls.value == places.count()
    for name in ("one", "two"):
        held = sinks.load_masks(spark, str(tmp_path / "masks"), name)
        assert held["region_cells"].count() == places.count()
        assert [round(r.centroid_x, 6) for r in held["regions"].collect()] == [round(places.agg(F.avg("x")).first()[0], 6)]
