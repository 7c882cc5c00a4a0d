"""Storing results next to the cells: attributes, palettes, layouts, pages and masks.

Every writer writes whole partitions of a table below the given path, so that a second run replaces what the first one wrote.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.sources.cells import CellSet, layout_key, points

#: Bits of a place along each axis that name its zone, and that order places.
ZONE_BITS, PLACE_BITS = 4, 16


def spread_bits(v: Column) -> Column:
    """The low 16 bits with a zero bit after each."""
    for by, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, by)).bitwiseAND(F.lit(mask).cast("long"))
    return v


def by_place(coords: DataFrame) -> DataFrame:
    """coords with z_order, the bits of x and y in turns across each embedding's bounds, and zone, the first of them. Places without x or y are in zone 0."""
    ends = coords.groupBy("key").agg(*[f(c).cast("double").alias(f"{n}_{c}") for c in ("x", "y") for n, f in (("low", F.min), ("high", F.max))])
    cells = 2**PLACE_BITS - 1

    def place(c: str) -> Column:
        wide = F.col(f"high_{c}") - F.col(f"low_{c}")
        at = F.when(wide > 0, (F.col(c).cast("double") - F.col(f"low_{c}")) / wide * cells)
        return F.coalesce(F.least(F.greatest(F.floor(F.nanvl(at, F.lit(0.0))), F.lit(0)), F.lit(cells)), F.lit(0)).cast("long")

    order = spread_bits(place("x")).bitwiseOR(F.shiftleft(spread_bits(place("y")), 1))
    placed = coords.join(F.broadcast(ends), "key").withColumn("z_order", order)  # a row for each embedding
    return placed.select(*coords.columns, "z_order", F.shiftright("z_order", 2 * (PLACE_BITS - ZONE_BITS)).cast("int").alias("zone"))


def save_cells(held: CellSet, path: str) -> None:
    """All tables of a cell set, so that CellSet.open finds them: cells by chunk where they have one, coords by embedding and zone, in the order of places.

    Ranges of that order make the files, so a crowded zone has several; zones has the bounds of each zone's places.
    """
    cells = held.cells
    if "chunk" in cells.columns:
        cells.repartitionByRange("chunk", "cell_idx").write.mode("overwrite").partitionBy("chunk").parquet(f"{path}/cells")
    else:
        cells.write.mode("overwrite").parquet(f"{path}/cells")
    placed = by_place(held.coords.select("key", "cell_idx", "x", "y", "z")).repartitionByRange("key", "z_order").sortWithinPartitions("key", "z_order")
    placed.drop("z_order").write.mode("overwrite").partitionBy("key", "zone").parquet(f"{path}/coords")
    stored = cells.sparkSession.read.parquet(f"{path}/coords")
    ends = [f(c).cast("double").alias(f"{n}_{c}") for c in ("x", "y") for n, f in (("min", F.min), ("max", F.max))]
    stored.groupBy("key", "zone").agg(*ends, F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}/zones")
    held.expression.repartitionByRange("gene", "cell_idx").write.mode("overwrite").parquet(f"{path}/expression")
    held.genes.write.mode("overwrite").parquet(f"{path}/genes")


def attribute_column(cells: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """cells with the column `name` from labels (cell_idx, label); cells without a label get null, labels without a cell are ignored."""
    if not (name or "").strip():
        raise ValueError("an attribute needs a name")
    one = labels.groupBy("cell_idx").agg(F.max("label").alias(name))
    return cells.drop(name).join(one, "cell_idx", "left")


def write_partition(df: DataFrame, path: str, by: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def save_palette(cells: DataFrame, path: str, column: str, categories: list[str], colours: list[str]) -> None:
    """Colours of an attribute's categories in their order; ValueError for a column that isn't there."""
    spark = cells.sparkSession
    if column not in cells.columns:
        raise ValueError(f"no column {column!r}; there are {', '.join(cells.columns[:15])}")
    if not colours or not categories:
        raise ValueError("a palette needs categories and colours")
    rows = [(column, i + 1, c, colour) for i, (c, colour) in enumerate(zip(categories, colours, strict=False))]
    write_partition(spark.createDataFrame(rows, "column string, cat_code int, category string, color string"), path, "column")


def save_layout(coords: DataFrame, path: str, name: str, cells: DataFrame | None = None) -> str:
    """cell_idx, x, y as an embedding of its own. With cells: each of them must have a place."""
    key = layout_key(name)
    if cells is not None:
        there, needed = coords.count(), cells.count()
        if there != needed:
            raise ValueError(f"{there} places for {needed} cells")
    placed = coords.select(F.lit(key).alias("key"), "cell_idx", F.col("x").cast("float").alias("x"), F.col("y").cast("float").alias("y"), F.lit(None).cast("float").alias("z"))
    write_partition(placed, path, "key")
    return key


def delete_layout(spark: SparkSession, path: str, name: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/key={layout_key(name)}")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True):
        raise ValueError(f"no layout {name!r}")


def save_layout_targets(path: str, name: str, targets: DataFrame, note: dict | None = None) -> str:
    """The centroids (sample, target_x, target_y) that a layout was made from, and a note on it."""
    key = layout_key(name)
    kept = targets.select(F.lit(key).alias("layout"), "sample", "target_x", "target_y", F.lit(json.dumps(note) if note else None).cast("string").alias("note"))
    write_partition(kept, path, "layout")
    return key


def layout_note(spark: SparkSession, path: str, name: str) -> dict | None:
    """The note on a stored layout, as it was given; ValueError if there is no such layout."""
    row = spark.read.parquet(path).where(F.col("layout") == layout_key(name)).select("note").first()
    if row is None:
        raise ValueError(f"no layout {name!r}")
    return json.loads(row.note) if row.note else None


def load_layout(spark: SparkSession, path: str, name: str) -> DataFrame:
    """cell_idx, x, y of a stored layout; ValueError if there is none."""
    found = points(spark.read.parquet(path), layout_key(name)).drop("z")
    if found.isEmpty():
        raise ValueError(f"no layout {name!r}")
    return found


def export_pages(pages: DataFrame, path: str) -> None:
    """One folder for each chunk; its files hold ranges of cells, each in ascending order. Chunks are few, so ranges of cells inside them make the tasks."""
    pages.repartitionByRange("chunk", "cell_idx").sortWithinPartitions("chunk", "cell_idx").write.mode("overwrite").partitionBy("chunk").parquet(path)


def save_masks(path: str, mask_set: str, tables: dict[str, DataFrame]) -> None:
    """The tables regions, region_rings, region_cells and region_groups of one mask set."""
    for name, df in tables.items():
        write_partition(df.withColumn("mask_set", F.lit(mask_set)), f"{path}/{name}", "mask_set")


MASK_TABLES = {
    "regions": "region string, tool string, visible boolean, embedding string, centroid_x double, centroid_y double, mask_set string",
    "region_rings": "region string, ring_no int, ring array<struct<x:double,y:double>>, mask_set string",
    "region_cells": "region string, cell_idx long, mask_set string",
    "region_groups": "grp string, ordinal int, region string, expanded boolean, visible boolean, mask_set string",
    "mask_info": "sample_column string, fill_opacity double, outline_weight double, alpha double, form string, mask_set string",
}


def load_masks(spark: SparkSession, path: str, mask_set: str) -> dict[str, DataFrame]:
    tables = {n: spark.read.schema(schema).parquet(f"{path}/{n}").where(F.col("mask_set") == mask_set).drop("mask_set") for n, schema in MASK_TABLES.items()}
    if tables["regions"].isEmpty():
        raise ValueError(f"no mask set {mask_set!r}")
    return tables
