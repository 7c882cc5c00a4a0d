"""Selections and regions: capturing cells, moving rings between embeddings, keeping masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions.geometry import in_ellipse, in_rectangle, in_ring, moved, ring_of
from cellweave.operators.graph import cut
from cellweave.operators.spatial_join import captures
from cellweave.sources.cells import points
from cellweave.sources.sinks import attribute_column

TOOLS = {"lasso", "polygon", "manual", "rectangle", "circle"}
CANVAS_MEMBERS, VOTE_MEMBERS, NO_TOOL = 2000, 500, "polygon"
#: Numbers of cells that one block of steps spans; places compared to tell embeddings apart, and how near they must be.
BLOCK, FIRST_PLACES, SAME_PLACE = 1 << 20, 50, 1e-3
#: Steps of a list that one task sums.
STEPS = 1 << 16


def shape(x: Column, y: Column, tool: str, path: list[tuple[float, float]], rotation: float = 0.0) -> Column:
    """Whether a point lies in a drawn shape; fewer points than the tool needs hold nothing."""
    if tool not in TOOLS:
        raise ValueError(f"no tool {tool!r}; there are {', '.join(sorted(TOOLS))}")
    if tool == "rectangle":
        return in_rectangle(x, y, path[0], path[1], rotation) if len(path) > 1 else F.lit(False)
    if tool == "circle":
        return in_ellipse(x, y, path[0], path[1], path[2] if len(path) > 2 else None, rotation) if len(path) > 1 else F.lit(False)
    return in_ring(x, y, ring_of(path)) if len(path) > 2 else F.lit(False)


def box_of(tool: str, path: list[tuple[float, float]]) -> Column | None:
    """Bounds that a scan can skip by; none for shapes that their points don't bound."""
    if tool == "circle" or len(path) < 2:
        return None
    xs, ys = zip(*path, strict=True)
    return F.col("x").between(min(xs), max(xs)) & F.col("y").between(min(ys), max(ys))


def select(places: DataFrame, tool: str, path: list[tuple[float, float]], rotation: float = 0.0, shown: DataFrame | None = None) -> DataFrame:
    """cell_idx of the cells in a shape; with `shown` (cell_idx, visible) only of visible ones."""
    box = None if rotation else box_of(tool, path)
    found = places if box is None else places.where(box)
    found = found.where(shape(F.col("x"), F.col("y"), tool, path, rotation)).select("cell_idx")
    return found if shown is None else found.join(shown.where("visible"), "cell_idx", "left_semi")


def select_batch(places: DataFrame, shapes: list[dict]) -> DataFrame:
    """selection, cell_idx for several named shapes in one pass over the cells."""
    hits = F.array(*[F.when(shape(F.col("x"), F.col("y"), s["tool"], s["path"], s.get("rotation", 0.0)), F.lit(s["name"])) for s in shapes])
    return places.select("cell_idx", F.explode(F.array_compact(hits)).alias("selection")).select("selection", "cell_idx")


def capture(places: DataFrame, rings: DataFrame) -> DataFrame:
    """region, cell_idx of cells in any ring of a region (region, ring_no, ring); rings of holes count as inside."""
    return captures(places, rings.select("region", "ring"), ["region"]).distinct()


def recapture(places: DataFrame, rings: DataFrame) -> DataFrame:
    """region, n, centroid_x, centroid_y, failed: failed regions hold no cell."""
    members = capture(places, rings).join(places, "cell_idx")
    found = members.groupBy("region").agg(F.count("*").alias("n"), F.avg("x").alias("centroid_x"), F.avg("y").alias("centroid_y"))
    return rings.select("region").distinct().join(found, "region", "left").select("region", F.coalesce("n", F.lit(0)).alias("n"), "centroid_x", "centroid_y", F.col("n").isNull().alias("failed"))


def first_found(sources: list[DataFrame]) -> DataFrame:
    """region, cell_idx from the first of several sources that has any cell for the region."""
    every = None
    for k, s in enumerate(sources):
        part = s.select("region", "cell_idx", F.lit(k).alias("priority"))
        every = part if every is None else every.unionAll(part)
    best = every.groupBy("region").agg(F.min("priority").alias("priority"))
    return every.join(best, ["region", "priority"]).select("region", "cell_idx").distinct()


def last_region(members: DataFrame, order: DataFrame) -> DataFrame:
    """cell_idx, label: of all regions that hold a cell the one that comes last in the order (region, ordinal)."""
    return members.join(order, "region").groupBy("cell_idx").agg(F.max_by("region", "ordinal").alias("label"))


def centroids(members: DataFrame, places: DataFrame) -> DataFrame:
    """region, x, y, n: the mean place of the member cells; regions without any are left out."""
    return members.join(places, "cell_idx").groupBy("region").agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.count("*").alias("n"))


def move_rings(rings: DataFrame, members: DataFrame, coords: DataFrame, source: str, target: str) -> DataFrame:
    """region, ring_no, ring, centroid_x, centroid_y: rings shifted by the difference of the members' means in two embeddings.

    A region without members keeps its rings; the same embedding moves nothing.
    """
    if source == target:
        return rings.select("region", "ring_no", "ring", F.lit(None).cast("double").alias("centroid_x"), F.lit(None).cast("double").alias("centroid_y"))
    both = points(coords, source).select("cell_idx", F.col("x").alias("sx"), F.col("y").alias("sy")).join(points(coords, target), "cell_idx")
    means = members.join(both, "cell_idx").groupBy("region").agg(*[F.avg(c).alias(c) for c in ("sx", "sy", "x", "y")])
    shifted = moved(F.col("ring"), F.coalesce(F.col("x") - F.col("sx"), F.lit(0.0)), F.coalesce(F.col("y") - F.col("sy"), F.lit(0.0)))
    return rings.join(means, "region", "left").select("region", "ring_no", shifted.alias("ring"), F.col("x").alias("centroid_x"), F.col("y").alias("centroid_y"))


def blocks_of(members: DataFrame, size: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The members (region, cell_idx) with their block, and region, block, n, before (members in blocks before) and total of each block.

    A block holds a region's cells of one range of `size` cell numbers, so no task has a whole region, however large it is; windows run over blocks.
    """
    each = members.withColumn("block", F.floor(F.col("cell_idx") / size))
    counts = each.groupBy("region", "block").agg(F.count("*").alias("n"))
    of_region = Window.partitionBy("region")
    before = F.coalesce(F.sum("n").over(of_region.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return each, counts.select("region", "block", "n", before.alias("before"), F.sum("n").over(of_region).alias("total"))


def ranked_members(members: DataFrame, below: int | None = None, size: int = BLOCK) -> DataFrame:
    """region, cell_idx, k (place from 0 by cell_idx) and total of the members; with `below` only of the blocks that begin below that place."""
    each, blocks = blocks_of(members, size)
    blocks = blocks if below is None else blocks.where(F.col("before") < below)
    place = F.row_number().over(Window.partitionBy("region", "block").orderBy("cell_idx")) - 1
    return each.join(blocks.drop("n"), ["region", "block"]).select("region", "cell_idx", (F.col("before") + place).alias("k"), "total")


def first_members(members: DataFrame, most: int) -> DataFrame:
    """region, cell_idx of the first so many members by cell_idx."""
    return ranked_members(members.select("region", "cell_idx"), most).where(F.col("k") < most).select("region", "cell_idx")


def spread_members(members: DataFrame, most: int = CANVAS_MEMBERS) -> DataFrame:
    """region, cell_idx of every k-th member by cell_idx, so that at most so many remain."""
    step = F.greatest(F.lit(1), F.floor(F.col("total") / most))
    return ranked_members(members.select("region", "cell_idx")).where((F.col("k") % step == 0) & (F.col("k") < step * most)).select("region", "cell_idx")


def vote(rings: DataFrame, members: DataFrame, coords: DataFrame) -> DataFrame:
    """region, key, d2: the embedding in which the mean of the first VOTE_MEMBERS members is nearest to the mean of ring 0's vertices."""
    v = F.col("ring")
    mean = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x) / F.size(c)
    ring = rings.where("ring_no = 0").select("region", mean(v.x).alias("rx"), mean(v.y).alias("ry"))
    places = coords.select("key", "cell_idx", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    means = first_members(members, VOTE_MEMBERS).join(places, "cell_idx").groupBy("region", "key").agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
    far = means.join(ring, "region").select("region", "key", (F.pow(F.col("rx") - F.col("x"), 2) + F.pow(F.col("ry") - F.col("y"), 2)).alias("d2"))
    return far.groupBy("region").agg(F.min_by("key", F.struct("d2", "key")).alias("key"), F.min("d2").alias("d2"))


def rename(tables: dict[str, DataFrame], old: str, new: str) -> dict[str, DataFrame]:
    """All mask tables with a region renamed; nothing changes for blank or equal names."""
    old, new = old.strip(), new.strip()
    if not old or not new or old == new:
        return tables
    name = F.when(F.col("region") == old, F.lit(new)).otherwise(F.col("region"))
    return {k: t.withColumn("region", name) if "region" in t.columns else t for k, t in tables.items()}


def decode_deltas(lists: DataFrame, key: str, text: str, size: int = STEPS) -> DataFrame:
    """key, position, cell_idx of lists such as '5,3,4,8': the first number, then steps. Blank lists hold nothing.

    Sums run inside parts of `size` steps; a part starts from the sum of all parts before, so a long list is decoded by many tasks.
    """
    steps = lists.select(key, F.posexplode(F.filter(F.split(text, ","), lambda x: F.trim(x) != "")).alias("position", "step"))
    steps = steps.select(key, "position", F.trim("step").cast("bigint").alias("step"), F.floor(F.col("position") / size).alias("part"))
    sums = steps.groupBy(key, "part").agg(F.sum("step").alias("sum"))
    before = F.coalesce(F.sum("sum").over(Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select(F.col(key).alias("of"), F.col("part").alias("of_part"), before.alias("before"))
    inside = F.sum("step").over(Window.partitionBy(key, "part").orderBy("position"))
    joined = steps.withColumn("inside", inside).join(starts, F.col(key).eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part")))
    return joined.select(key, "position", (F.col("before") + F.col("inside")).alias("cell_idx"))


def decode_blocks(steps: DataFrame, key: str) -> DataFrame:
    """key, position, cell_idx: running sums of steps (key, block, position, step), from each block's first one on."""
    sums = F.sum("step").over(Window.partitionBy(key, "block").orderBy("position"))
    return steps.select(key, "position", sums.alias("cell_idx"))


def encode_blocks(members: DataFrame, size: int = BLOCK) -> DataFrame:
    """region, block, position (in the region), step of the cells of each region in ascending order: a block's first step is the cell itself."""
    one, blocks = blocks_of(members.select("region", "cell_idx").distinct(), size)
    inside = Window.partitionBy("region", "block").orderBy("cell_idx")
    each = one.withColumns({"place": F.row_number().over(inside) - 1, "step": F.col("cell_idx") - F.coalesce(F.lag("cell_idx").over(inside), F.lit(0))})
    return each.join(blocks.select("region", "block", "before"), ["region", "block"]).select("region", "block", (F.col("before") + F.col("place")).cast("int").alias("position"), "step")


def delta_text(steps: DataFrame) -> DataFrame:
    """region, block, deltas: the steps of each block as text, '5,3,4,8'; for one block a region, what decode_deltas takes."""
    listed = F.array_sort(F.collect_list(F.struct("position", "step")))  # at most as many as a block's numbers
    return steps.groupBy("region", "block").agg(F.array_join(F.transform(listed, lambda x: x.step.cast("string")), ",").alias("deltas"))


def upsert(stored: DataFrame, new: DataFrame) -> DataFrame:
    """region, cell_idx: new members replace those stored under the same name."""
    return stored.join(new.select("region").distinct(), "region", "left_anti").unionByName(new.select("region", "cell_idx"))


def save_group(cells: DataFrame, places: DataFrame, rings: DataFrame, order: DataFrame, name: str, fallbacks: list[DataFrame]) -> DataFrame:
    """cells with the attribute `name`: the last region of the order (region, ordinal) that holds a cell. Regions that capture none take the first of the fallbacks (region, cell_idx) that knows them."""
    if order.isEmpty():
        raise ValueError("a region group needs regions")
    wanted = lambda df: df.join(order.select("region"), "region", "left_semi")
    return attribute_column(cells, last_region(first_found([capture(places, wanted(rings)), *map(wanted, fallbacks)]), order), name)


def masks(rings: DataFrame, members: DataFrame, places: DataFrame, groups: DataFrame, embedding: str, tools: DataFrame | None = None, fallbacks: list[DataFrame] | None = None, form: str = "regions", **info) -> dict[str, DataFrame]:
    """The tables of a mask set. groups: grp, ordinal, region, expanded, visible; tools: region, tool ('manual' is kept as NO_TOOL).

    Members are found once and written; all tables come from them, however often they are stored. Regions without members take the first of the fallbacks that knows them. info: sample_column, fill_opacity, outline_weight, alpha; form: 'regions' or 'selections'.
    """
    spark = rings.sparkSession
    if fallbacks:
        members = first_found([members, *fallbacks])
    members = cut(members.select("region", "cell_idx"))
    found = cut(centroids(members, places))  # a row for each region
    named = rings.select("region").union(members.select("region")).distinct().join(found, "region", "left")
    if tools is not None:
        named = named.join(tools.select("region", F.when(F.col("tool") != "manual", F.col("tool")).alias("tool")), "region", "left")
    else:
        named = named.withColumn("tool", F.lit(None).cast("string"))
    regions = named.select("region", F.coalesce("tool", F.lit(NO_TOOL)).alias("tool"), F.lit(True).alias("visible"), F.lit(embedding).alias("embedding"), F.col("x").alias("centroid_x"), F.col("y").alias("centroid_y"))
    row = (info.get("sample_column"), float(info.get("fill_opacity", 0.1)), float(info.get("outline_weight", 2)), float(info.get("alpha", 0.05)), form)
    about = spark.createDataFrame([row], "sample_column string, fill_opacity double, outline_weight double, alpha double, form string")
    return {"regions": regions, "region_rings": rings.select("region", "ring_no", "ring"), "region_cells": members, "region_groups": groups, "mask_info": about}


def same_embedding(coords: DataFrame, a: str, b: str) -> bool:
    """Whether two embeddings have as many cells and the first of them at the same places."""
    if a == b:
        return True
    first = [points(coords, k).select("cell_idx", F.col("x").alias(f"x{s}"), F.col("y").alias(f"y{s}")).orderBy("cell_idx").limit(FIRST_PLACES) for k, s in ((a, "a"), (b, "b"))]
    counts = dict(coords.where(F.col("key").isin(a, b)).groupBy("key").count().collect())
    if not counts.get(a) or counts.get(a) != counts.get(b):
        return False
    near = lambda c: F.abs(F.col(f"{c}a") - F.col(f"{c}b")) <= SAME_PLACE
    return first[0].join(first[1], "cell_idx").where(near("x") & near("y")).count() == first[0].count()


def embedding_of(tables: dict[str, DataFrame], coords: DataFrame, verify: bool = False) -> str:
    """The embedding that masks were stored in. With `verify` the stored name gives way to what the rings' places say, unless both hold the same places."""
    first = tables["regions"].select("embedding").first()
    source = first.embedding if first else None
    if source is not None and not verify:
        return source
    seen = vote(tables["region_rings"], tables["region_cells"], coords).groupBy("key").count().orderBy(F.desc("count"), "key").first()
    if seen is None:
        return source or "spatial"
    return source if source is not None and same_embedding(coords, source, seen.key) else seen.key


def loaded_masks(tables: dict[str, DataFrame], coords: DataFrame, target: str, verify: bool | None = None, most: int | None = CANVAS_MEMBERS) -> dict[str, DataFrame]:
    """Stored masks with their rings moved to an embedding; region_cells are all members, shown_cells the first `most` of each region.

    Masks stored as selections are verified (see embedding_of) unless `verify` says otherwise, their first ring is the path to edit, and all members are shown.
    """
    about = tables["mask_info"].first() if "mask_info" in tables else None
    selections = about is not None and about.form == "selections"
    source = embedding_of(tables, coords, selections if verify is None else verify)
    rings = move_rings(tables["region_rings"], tables["region_cells"], coords, source, target)
    shown = tables["region_cells"] if selections or most is None else first_members(tables["region_cells"], most)
    return {**tables, "region_rings": rings, "region_paths": rings.where("ring_no = 0"), "shown_cells": shown}


def move_paths(paths: DataFrame, members: DataFrame, coords: DataFrame, source: str, target: str) -> DataFrame:
    """region, ring, centroid_x, centroid_y: single rings (region, ring) moved between embeddings; ValueError if one isn't there."""
    for key in (source, target):
        if coords.where(F.col("key") == key).isEmpty():
            raise ValueError(f"no embedding {key!r}")
    return move_rings(paths.withColumn("ring_no", F.lit(0)), members, coords, source, target).drop("ring_no")


def grouped_regions(tables: dict[str, DataFrame]) -> DataFrame:
    """grp, ordinal, region, tool, visible, n of the regions that groups name, in groups' order; regions without a group come as group null."""
    n = tables["region_cells"].groupBy("region").agg(F.count("*").alias("n"))
    groups = tables["region_groups"].select("grp", "ordinal", "region", F.col("visible").alias("group_visible"))
    each = tables["regions"].select("region", "tool", "visible").join(groups, "region", "left").join(n, "region", "left")
    return each.select("grp", "ordinal", "region", "tool", (F.col("visible") & F.coalesce("group_visible", F.lit(True))).alias("visible"), F.coalesce("n", F.lit(0)).alias("n"))


def totals(tables: dict[str, DataFrame]) -> DataFrame:
    """One row: regions, groups, cells (a cell counts once for each region)."""
    return tables["regions"].agg(F.count("*").alias("regions")).crossJoin(tables["region_groups"].agg(F.count_distinct("grp").alias("groups"))).crossJoin(tables["region_cells"].agg(F.count("*").alias("cells")))
