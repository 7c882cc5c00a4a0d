"""The tables that stand for one set of cells, and how to open them."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.functions.values import chunk_of

STANDARD_KEYS = ("spatial", "X_spatial", "X_umap", "X_pca", "X_tsne")
MOST_CHUNKS = 50
POLICIES = {
    # names to try for an embedding `k`, in this order; then what else there is
    "region": lambda k: [k, f"X_{k}", "spatial", "X_spatial"],
    "ribbon": lambda k: [k, "spatial", "X_spatial", "X_umap", "X_pca"],
    "recompute": lambda k: [k, "spatial", "X_spatial"],
}


@dataclass(frozen=True)
class CellSet:
    """cells (cell_idx, chunk, attributes), coords (key, cell_idx, x, y, z), expression (cell_idx, gene, value; no zeros)."""

    cells: DataFrame
    coords: DataFrame
    expression: DataFrame
    genes: DataFrame
    sample: str = "sample"
    zones: DataFrame | None = None

    @staticmethod
    def open(spark: SparkSession, path: str, sample: str = "sample") -> CellSet:
        """Tables stored below a path; coords are partitioned by key, and by zone where they were stored by place; cells by chunk where they have one."""
        read = lambda name: spark.read.parquet(f"{path}/{name}")
        coords = read("coords")
        zones = read("zones") if "zone" in coords.columns else None
        return CellSet(read("cells"), coords, read("expression"), read("genes"), sample, zones).checked()

    def checked(self) -> CellSet:
        if self.sample not in self.cells.columns:
            raise ValueError(f"no column {self.sample!r}; there are {', '.join(self.cells.columns[:15])}")
        return self

    def with_sample(self, sample: str, needed: bool = True) -> CellSet:
        """Another column as the sample; one that isn't there is an error, or leaves all as it is."""
        if not needed and sample not in self.cells.columns:
            return self
        return replace(self, sample=sample).checked()

    def catalogue(self, custom: tuple[str, ...] = ()) -> DataFrame:
        """kind, name, detail of what there is now: attributes with their types, embeddings with their labels, saved layouts, and samples in the order of first appearance."""
        keys = embedding_keys(self.coords)
        rows = [("attribute", a, t) for a, t in attributes(self.cells).items()]
        rows += [("embedding", k, k.removeprefix("X_")) for k in keys if k in STANDARD_KEYS or k in custom]
        rows += [("layout", k, k.removeprefix("X_")) for k in keys if k.startswith("X_") and k not in STANDARD_KEYS and k not in custom]
        known = self.cells.sparkSession.createDataFrame(rows, "kind string, name string, detail string")
        named = self.cells.select(F.col(self.sample).cast("string").alias("name"), "cell_idx").where("name is not null").groupBy("name").agg(F.min("cell_idx").alias("first"))
        ordinal = F.row_number().over(Window.orderBy("first")) - 1  # samples are few
        return known.unionAll(named.select(F.lit("sample"), "name", ordinal.cast("string")))

    def with_chunks(self, size: int = 250_000) -> CellSet:
        """A chunk for each cell; kept where there are as many chunks already."""
        n = chunk_count(self.cells.count(), size)
        if "chunk" in self.cells.columns and self.cells.agg(F.max("chunk")).first()[0] == n - 1:
            return self
        return replace(self, cells=self.cells.withColumn("chunk", chunk_of(F.col("cell_idx"), n)))

    def embedding(self, key: str, policy: str = "region") -> DataFrame:
        """cell_idx, x, y, z of an embedding, x and y as doubles."""
        return points(self.coords, resolve(embedding_keys(self.coords), key, policy))

    def near(self, key: str, box: tuple[float, float, float, float]) -> DataFrame:
        """cell_idx, x, y, z of all cells in a box (min_x, max_x, min_y, max_y), and of others; where coords are stored by place, files of zones that the box doesn't meet aren't read."""
        if self.zones is None:
            return points(self.coords, key)
        meets = (F.col("max_x") >= box[0]) & (F.col("min_x") <= box[1]) & (F.col("max_y") >= box[2]) & (F.col("min_y") <= box[3])
        met = [r.zone for r in self.zones.where((F.col("key") == key) & meets).select("zone").distinct().collect()]  # as many as there are zones
        return points(self.coords.where(F.col("zone").isin(met)), key)


def chunk_count(cells: int, size: int) -> int:
    return min(MOST_CHUNKS, max(1, math.ceil(cells / size)))


def embedding_keys(coords: DataFrame) -> list[str]:
    """The embeddings that are there, standard ones first."""
    keys = {r.key for r in coords.select("key").distinct().collect()}
    return [k for k in STANDARD_KEYS if k in keys] + sorted(keys.difference(STANDARD_KEYS))


def resolve(keys: list[str], key: str, policy: str) -> str:
    """The embedding that a request means; ValueError if there is none."""
    for name in POLICIES[policy](key):
        if name in keys:
            return name
    if policy == "recompute" and keys:
        return keys[0]
    raise ValueError(f"no embedding for {key!r}; there are {', '.join(keys)}")


def full_scan(coords: DataFrame, key: str) -> DataFrame:
    """cell_idx, x, y of all cells; ValueError for an embedding that isn't there."""
    if key not in (keys := embedding_keys(coords)):
        raise ValueError(f"no embedding {key!r}; there are {', '.join(keys)}")
    return points(coords, key).select("cell_idx", "x", "y")


def points(coords: DataFrame, key: str) -> DataFrame:
    return coords.where(F.col("key") == key).select("cell_idx", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.col("z").cast("double").alias("z"))


def attributes(cells: DataFrame) -> dict[str, str]:
    """Columns that a user may colour by, as 'categorical' or 'numeric'; names that begin with __ are internal."""
    own = {"cell_idx", "cell_name", "chunk"}
    return {f.name: "categorical" if f.dataType.typeName() in ("string", "varchar", "char") else "numeric" for f in cells.schema if f.name not in own and not f.name.startswith("__")}


def attribute(cells: DataFrame, name: str) -> str:
    """The column meant by a name as typed; ValueError names some others."""
    if (name := (name or "").strip()) in cells.columns:
        return name
    raise ValueError(f"no attribute {name!r}; there are {', '.join(cells.columns[:15])}")


def embeddings(coords: DataFrame, custom: tuple[str, ...] = ()) -> dict[str, str]:
    """Standard and custom embeddings that are there, with their labels."""
    return {k: k.removeprefix("X_") for k in embedding_keys(coords) if k in STANDARD_KEYS or k in custom}


def saved_layouts(coords: DataFrame, custom: tuple[str, ...] = ()) -> list[str]:
    return [k for k in embedding_keys(coords) if k.startswith("X_") and k not in STANDARD_KEYS and k not in custom]


def layout_key(name: str) -> str:
    if not (name := (name or "").strip()):
        raise ValueError("a layout needs a name")
    return name if name.startswith("X_") else f"X_{name}"


def mask_sets(regions: DataFrame) -> DataFrame:
    """Stored mask sets with a label to show."""
    return regions.select("mask_set").distinct().select("mask_set", F.initcap(F.replace("mask_set", F.lit("_"), F.lit(" "))).alias("label"))
