"""Layouts: every sample gets a slot in a grid, and its cells move there rigidly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.functions.values import unassigned
from cellweave.operators.graph import cut
from cellweave.operators.page import bounds
from cellweave.operators.samples import first_value, sample_attribute, sample_stats, upper_median

GRID_GAP, GRID_GROUP_GAP = 0.3, 1.5
SQUARE_GAP, SQUARE_GROUP_GAP = 0.25, 1.2
#: Names under which samples are usually kept (fixed values).
SAMPLE_COLUMNS = ("sample_id", "sample", "Sample", "SampleID", "sample_name", "core_id")


def slots(samples: DataFrame, order: list[Column]) -> DataFrame:
    """samples (with grp) with slot (from 0, inside its group) and grp_no (from 0)."""
    slot = F.row_number().over(Window.partitionBy("grp").orderBy(*order)) - 1
    return samples.withColumn("slot", slot).withColumn("grp_no", F.dense_rank().over(Window.orderBy("grp")) - 1)


def group_grid(cells: DataFrame, places: DataFrame, sample: str = "sample", group_by: str | None = None, group_ncols: int = 2, sample_ncols: int = 3, sort_by: str | None = None, order_by: str | None = None, gap_x: float = 1.0, gap_y: float = 1.0) -> DataFrame:
    """sample, grp, slot, cx, cy, target_x, target_y; a slot is as large as the largest sample and a gap."""
    stats = sample_stats(cells, places, sample)
    order: list[Column] = [F.col("sample")]
    if group_by:
        stats = stats.join(first_value(cells, group_by, sample).select("sample", F.col("value").cast("string").alias("grp")), "sample")
    else:
        stats = stats.withColumn("grp", F.lit("all"))
    if sort_by:
        stats = stats.join(first_value(cells, sort_by, sample).withColumnRenamed("value", "sort_value"), "sample", "left")
        if order_by:
            stats = stats.join(first_value(cells, order_by, sample).withColumnRenamed("value", "order_value"), "sample", "left")
            order = [F.col("sort_value").asc_nulls_last(), F.col("order_value").asc_nulls_last(), F.col("sample")]
        else:
            order = [F.coalesce(F.col("sort_value").cast("string"), F.col("sample")), F.col("ordinal")]
    most = stats.agg((F.max("w") * (1 + gap_x * GRID_GAP)).alias("cell_w"), (F.max("h") * (1 + gap_y * GRID_GAP)).alias("cell_h"))
    placed = slots(stats, order).crossJoin(F.broadcast(most))
    rows = F.max(F.floor(F.col("slot") / sample_ncols) + 1).over(Window.partitionBy())
    x0 = F.col("grp_no") % group_ncols * (sample_ncols * F.col("cell_w") + GRID_GROUP_GAP * F.col("cell_w"))
    y0 = F.floor(F.col("grp_no") / group_ncols) * (rows * F.col("cell_h") + GRID_GROUP_GAP * F.col("cell_h"))
    x = x0 + F.col("slot") % sample_ncols * F.col("cell_w") + F.col("cell_w") / 2
    y = y0 + F.floor(F.col("slot") / sample_ncols) * F.col("cell_h") + F.col("cell_h") / 2
    return placed.select("sample", "grp", "slot", "cx", "cy", x.alias("target_x"), y.alias("target_y"))


def square_parts(cells: DataFrame, places: DataFrame, sample: str, group_by: str | None, group_ncols: int, columns: str | None, rows: str | None, gap: float, transpose: bool) -> DataFrame:
    """Each sample with its group's corner (x0, y0), its column and row there, and the sizes of slot and block. Unassigned samples have none."""
    stats = sample_stats(cells, places, sample)
    scale = 1 + gap * SQUARE_GAP
    sizes = upper_median(stats, "w").crossJoin(upper_median(stats, "h")).select((F.col("median_w") * scale).alias("cell_w"), (F.col("median_h") * scale).alias("cell_h"))
    stats = stats.where(~unassigned(F.col("sample")))
    for name, column in (("grp", group_by), ("col", columns), ("row", rows)):
        if column:
            found = sample_attribute(cells, column, sample).select("sample", F.col("category").alias(f"{name}_name"), F.col("code").alias(f"{name}_code"))
            stats = stats.join(found, "sample")
        else:
            stats = stats.withColumns({f"{name}_name": F.lit("all" if name == "grp" else None).cast("string"), f"{name}_code": F.lit(0)})
    in_group = Window.partitionBy("grp_code")
    order = [F.col("row_code"), F.col("sample")]
    n = F.count("*").over(in_group)
    if columns:
        first = F.dense_rank().over(in_group.orderBy("col_code")) - 1
        second = F.row_number().over(Window.partitionBy("grp_code", "col_code").orderBy(*order)) - 1
        stats = stats.withColumns({"a": first, "b": second})
        stats = stats.withColumns({"n_a": F.max("a").over(in_group) + 1, "n_b": F.max("b").over(in_group) + 1})
        c, r, n_c, n_r = ("b", "a", "n_b", "n_a") if transpose else ("a", "b", "n_a", "n_b")
        stats = stats.select("*", F.col(c).alias("c"), F.col(r).alias("r"), F.col(n_c).alias("n_c"), F.col(n_r).alias("n_r"))
    else:
        wide = F.ceil(F.sqrt(n))
        high = F.ceil(n / wide)
        n_c, n_r = (high, wide) if transpose else (wide, high)
        stats = stats.withColumns({"k": F.row_number().over(in_group.orderBy(*order)) - 1, "n_c": n_c, "n_r": n_r})
        stats = stats.withColumns({"c": F.col("k") % F.col("n_c"), "r": F.floor(F.col("k") / F.col("n_c"))})
    stats = stats.crossJoin(F.broadcast(sizes))
    every = Window.partitionBy()
    stats = stats.withColumns({"block_w": F.max(F.col("n_c") * F.col("cell_w")).over(every), "block_h": F.max(F.col("n_r") * F.col("cell_h")).over(every)})
    x0 = F.col("grp_code") % group_ncols * (F.col("block_w") + SQUARE_GROUP_GAP * F.col("cell_w"))
    y0 = F.floor(F.col("grp_code") / group_ncols) * (F.col("block_h") + SQUARE_GROUP_GAP * F.col("cell_h"))
    return stats.withColumns({"x0": x0, "y0": y0})


def auto_square(cells: DataFrame, places: DataFrame, sample: str = "sample", group_by: str | None = None, group_ncols: int = 2, columns: str | None = None, rows: str | None = None, gap: float = 2.0, transpose: bool = False) -> DataFrame:
    """sample, grp, cx, cy, target_x, target_y in the most square grid, or with `columns` in one column for each of its values."""
    parts = square_parts(cells, places, sample, group_by, group_ncols, columns, rows, gap, transpose)
    x, y = (F.col(o) + F.col(k) * F.col(s) + F.col(s) / 2 for o, k, s in (("x0", "c", "cell_w"), ("y0", "r", "cell_h")))
    return parts.select("sample", F.col("grp_name").alias("grp"), "cx", "cy", x.alias("target_x"), y.alias("target_y"))


def labels(cells: DataFrame, places: DataFrame, sample: str = "sample", group_by: str | None = None, group_ncols: int = 2, columns: str | None = None, rows: str | None = None, gap: float = 2.0, transpose: bool = False) -> DataFrame:
    """kind (group, column, row), name, x, y of a layout's headings; headings follow the values of `columns` and `rows`."""
    parts = square_parts(cells, places, sample, group_by, group_ncols, columns, rows, gap, transpose)
    found = parts.select(F.lit("group").alias("kind"), F.col("grp_name").alias("name"), (F.col("x0") + F.col("block_w") / 2).alias("x"), (F.col("y0") - F.col("cell_h") * 0.8).alias("y")).distinct()
    for name, given in (("col", columns), ("row", rows)):
        if not given or not columns:
            continue
        rank = F.dense_rank().over(Window.partitionBy("grp_code").orderBy(f"{name}_code")) - 1
        top = (name == "col") != transpose
        x = F.col("x0") + rank * F.col("cell_w") + F.col("cell_w") / 2 if top else F.col("x0") - F.col("cell_w") * 0.2
        y = F.col("y0") - F.col("cell_h") * 0.2 if top else F.col("y0") + rank * F.col("cell_h") + F.col("cell_h") / 2
        found = found.unionAll(parts.select(F.lit("column" if top else "row").alias("kind"), F.col(f"{name}_name").alias("name"), x.alias("x"), y.alias("y")).distinct())
    return found


def adjusted(parameters: dict, **changes) -> dict:
    """The parameters of a layout with a new gap or transposition."""
    return {**parameters, **{k: v for k, v in changes.items() if v is not None}}


def move_cells(cells: DataFrame, places: DataFrame, targets: DataFrame, sample: str = "sample") -> DataFrame:
    """cell_idx, x, y: each sample's cells shifted so that its mean (cx, cy) is its target; cells of other samples stay."""
    shift = targets.select(F.col("sample").alias("of"), (F.col("target_x") - F.col("cx")).alias("dx"), (F.col("target_y") - F.col("cy")).alias("dy"))
    each = cells.select("cell_idx", F.col(sample).cast("string").alias("of")).join(shift, "of", "left").join(places, "cell_idx")
    return each.select("cell_idx", *[(F.col(c) + F.coalesce(F.col(f"d{c}"), F.lit(0.0))).alias(c) for c in ("x", "y")])


def sample_column(cells: DataFrame, sample: str | None) -> str:
    """The sample column, or one of the usual names where it isn't there; ValueError if none is."""
    for name in (sample, *SAMPLE_COLUMNS):
        if name and name in cells.columns:
            return name
    raise ValueError(f"no sample column {sample!r}; there are {', '.join(cells.columns[:15])}")


def targets_of(spark: SparkSession, centroids: list[tuple[float, float]], names: list[str]) -> DataFrame:
    """sample, target_x, target_y from two lists of one length."""
    if len(centroids) != len(names):
        raise ValueError(f"{len(centroids)} centroids for {len(names)} samples")
    return spark.createDataFrame([(n, float(x), float(y)) for n, (x, y) in zip(names, centroids, strict=True)], "sample string, target_x double, target_y double")


def grid_parts(cells: DataFrame, places: DataFrame, sample: str = "sample", **parameters) -> dict[str, DataFrame]:
    """A group grid whole: targets, moved (cell_idx, x, y), labels (sample, x, y), groups (grp, samples) and bounds of what moved."""
    targets = cut(group_grid(cells, places, sample, **parameters))
    moved = move_cells(cells, places, targets, sample)
    found = targets.select("sample", F.col("target_x").alias("x"), F.col("target_y").alias("y"))
    groups = targets.groupBy("grp").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "sample"))), lambda s: s.sample).alias("samples"))  # samples are few
    return {"targets": targets, "moved": moved, "labels": found, "groups": groups, "bounds": bounds(moved.select(F.lit("layout").alias("key"), "x", "y")).drop("key")}


def rebuild(cells: DataFrame, places: DataFrame, targets: DataFrame, sample: str | None = "sample") -> DataFrame:
    """cell_idx, x, y from stored targets (sample, target_x, target_y) alone."""
    sample = sample_column(cells, sample)
    stats = sample_stats(cells, places, sample).select("sample", "cx", "cy")
    return move_cells(cells, places, targets.join(stats, "sample"), sample)


def loaded(cells: DataFrame, laid_out: DataFrame, sample: str = "sample") -> tuple[DataFrame, DataFrame]:
    """Bounds of a stored layout, and its samples' label positions (the means of their cells)."""
    found = sample_stats(cells, laid_out, sample).select("sample", F.col("cx").alias("x"), F.col("cy").alias("y"), "n")
    return bounds(laid_out.select(F.lit("layout").alias("key"), "x", "y")).drop("key"), found
