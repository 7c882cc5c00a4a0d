"""All queries of the cell operators: a Spark function and the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.functions.geometry import edges
from cellweave.functions.values import unassigned
from cellweave.operators import cluster, color, layout, outline, page, regions, ribbon, samples
from cellweave.operators.graph import cut
from cellweave.plans import tables
from cellweave.plans.tables import sql_unit
from cellweave.sources import sinks
from cellweave.sources.cells import CellSet, embedding_keys, full_scan, mask_sets, points, resolve
from cellweave.sources.scratch import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str, open_cells: Callable[[SparkSession, str], CellSet] = tables.event_cells, recursive: bool = False) -> Callable:
    """Registers a function of a CellSet under its name, with its SQL over the tables of plans.tables."""

    def register(f: Callable[[CellSet], DataFrame]) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(open_cells(spark, sf_dir))
        ORACLE_SQL[f.__name__] = f"WITH {'RECURSIVE ' if recursive else ''}{tables.SQL}{sql if sql.lstrip().startswith(',') else ' ' + sql}"
        return f

    return register


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def vertices(df: DataFrame, *columns: str) -> DataFrame:
    """The given columns with a row for each vertex of a ring."""
    return df.select(*columns, F.posexplode("ring").alias("vertex", "v")).select(*columns, "vertex", F.round("v.x", 6).alias("x"), F.round("v.y", 6).alias("y"))


# --- colour ---


@query("""SELECT cell_idx, CASE WHEN hi = lo THEN 0 ELSE trunc(least(greatest((v - lo) / (hi - lo) * 254 + 1, 1), 255)) END::INT AS code
FROM (SELECT cell_idx, CASE WHEN isnan(score) THEN 0 ELSE coalesce(score, 0) END AS v, min(v) OVER () AS lo, max(v) OVER () AS hi FROM cells)""")
def attr_numeric_codes(c: CellSet) -> DataFrame:
    return color.numeric_codes(c.cells, "score")


DICTIONARY = "dict AS (SELECT cell_type AS category, row_number() OVER (ORDER BY min(cell_idx))::INT AS code FROM cells WHERE cell_type IS NOT NULL GROUP BY cell_type)"


@query(f""", {DICTIONARY} SELECT cell_idx, cell_type AS category, coalesce(code, 0)::INT AS code, least(coalesce(code, 0), 255)::INT AS display_code FROM cells LEFT JOIN dict ON category = cell_type""")
def attr_category_codes(c: CellSet) -> DataFrame:
    return color.category_codes(c.cells, "cell_type")


PALETTE = [("#d62728", 1), ("#1f77b4", 2), ("#2ca02c", 3), ("#ff7f0e", 4), ("#9467bd", 5), ("#8c564b", 6)]


@query(f""", {DICTIONARY}, pal AS (SELECT * FROM (VALUES {', '.join(f"('{a}', {b})" for a, b in PALETTE)}) t(color, code))
SELECT category, dict.code, n, CASE WHEN (SELECT count(*) FROM pal) >= (SELECT count(*) FROM dict) THEN color END AS color FROM dict LEFT JOIN pal USING (code) JOIN (SELECT cell_type AS category, count(*) AS n FROM cells GROUP BY 1) USING (category)""")
def attr_palette(c: CellSet) -> DataFrame:
    palette = c.cells.sparkSession.createDataFrame(PALETTE, "color string, cat_code int")
    n = c.cells.groupBy(F.col("cell_type").alias("category")).agg(F.count("*").alias("n"))
    return color.palette_of(color.dictionary(c.cells, "cell_type"), palette).join(n, "category")


GENE = """gene_v AS (SELECT cell_idx, coalesce(v, 0::FLOAT) AS v FROM cells LEFT JOIN (SELECT cell_idx, CASE WHEN isnan(value) OR isinf(value) OR value < 0 THEN 0::FLOAT ELSE value END AS v FROM expression WHERE gene = 'G_k') USING (cell_idx)),
gene_m AS (SELECT cell_idx, v, max(v) OVER () AS m FROM gene_v),
coded AS (SELECT cell_idx, v, m, CASE WHEN v > 0 THEN trunc(least(greatest(((v::DOUBLE / m)::FLOAT * 254::FLOAT)::FLOAT + 1::FLOAT, 1::FLOAT), 255::FLOAT))::INT ELSE 0 END AS code FROM gene_m)"""


@query(f", {GENE} SELECT cell_idx, code, round(m::DOUBLE, 4) AS vmax FROM coded")
def gene_codes(c: CellSet) -> DataFrame:
    return color.gene_codes(c.cells, c.expression, "G_k")


@query(""", logs AS (SELECT cell_idx, sum(ln(value::DOUBLE + 1e-9)) AS l, count(*) AS n FROM expression WHERE gene IN ('G_k', 'G_m') AND value > 0 GROUP BY cell_idx),
grp AS (SELECT cell_idx, greatest(exp((l + (2 - n) * ln(1e-9)) / 2) - 1e-9, 0) AS v FROM logs)
SELECT cell_idx, round(coalesce(v, 0), 6) AS v, CASE WHEN coalesce(v, 0) > 0 THEN trunc(least(greatest(v / (SELECT max(v) FROM grp) * 254 + 1, 1), 255)) ELSE 0 END::INT AS code FROM cells LEFT JOIN grp USING (cell_idx)""")
def gene_group_codes(c: CellSet) -> DataFrame:
    return rounded(color.group_codes(c.cells, c.expression, ["G_k", "G_m", "absent"], c.genes), "v")


@query(""", logs AS (SELECT cell_idx, sum(ln(value::DOUBLE + 1e-9)) AS l, count(*) AS n FROM expression WHERE gene IN ('G_k', 'G_m', 'G_0') AND value > 0 GROUP BY cell_idx),
grp AS (SELECT cell_idx, greatest(exp((l + (3 - n) * ln(1e-9)) / 3) - 1e-9, 0) AS v FROM logs)
SELECT cell_idx, round(coalesce(v, 0), 6) AS v, CASE WHEN coalesce(v, 0) > 0 THEN trunc(least(greatest(v / (SELECT max(v) FROM grp) * 254 + 1, 1), 255)) ELSE 0 END::INT AS code FROM cells LEFT JOIN grp USING (cell_idx)""")
def gene_group_silent(c: CellSet) -> DataFrame:
    """A known gene that no cell has counts in the mean."""
    return rounded(color.group_codes(c.cells, c.expression, ["G_k", "G_m", tables.SILENT, "absent"], c.genes), "v")


@query("""SELECT gene_idx, gene, n FROM (SELECT (substr(gene, 2)::INT - 5)::INT AS gene_idx, gene, count(*) AS n FROM (SELECT 'g' || (i - 1) AS gene, embedding[i] AS v FROM embeddings, range(6, 65) r(i)) WHERE v > 0 GROUP BY gene) WHERE gene ILIKE '%G1%' ORDER BY gene_idx LIMIT 8""", tables.vector_cells)
def gene_suggest(c: CellSet) -> DataFrame:
    n = c.expression.groupBy("gene").agg(F.count("*").alias("n"))
    return color.similar_genes(c.genes.join(n, "gene").select("gene_idx", "gene", "n"), "G1")


@query("""SELECT key, min(x)::DOUBLE AS min_x, max(x)::DOUBLE AS max_x, min(y)::DOUBLE AS min_y, max(y)::DOUBLE AS max_y, count(*) AS n FROM coords GROUP BY key""")
def embedding_bounds(c: CellSet) -> DataFrame:
    return page.bounds(c.coords)


ZN = "zn AS (SELECT cell_idx, CASE WHEN max(z) OVER () > min(z) OVER () THEN (z - min(z) OVER ()) / (max(z) OVER () - min(z) OVER ()) * 2 - 1 ELSE 0 END AS zn FROM umap)"


@query(f", {ZN} SELECT cell_idx, round(zn, 6) AS z FROM zn")
def z_normalised(c: CellSet) -> DataFrame:
    return rounded(color.normalised_z(points(c.coords, "X_umap")), "z")


ENABLED = [("click", True), ("view", False), ("error", True)]
SHOWN = f"shown AS (SELECT cell_idx, coalesce(enabled, true) AS visible FROM cells LEFT JOIN (VALUES {', '.join(f"('{a}', {str(b).lower()})" for a, b in ENABLED)}) t(cell_type, enabled) USING (cell_type))"


def shown_cells(c: CellSet) -> DataFrame:
    return color.visible(c.cells, "cell_type", c.cells.sparkSession.createDataFrame(ENABLED, "category string, enabled boolean"))


@query(f""", {ZN}, {SHOWN}, {GENE}, {DICTIONARY} SELECT cell_idx, round(CASE WHEN visible THEN zn ELSE -1 END, 6) AS by_z, round(least(greatest((code / 255.0 * m - 0) / m, 0), 1) * 2 - 1, 6) AS by_t,
round((SELECT CASE WHEN n > 1 THEN (coalesce(k, 1) - 1) / (n - 1)::DOUBLE ELSE 0 END FROM (SELECT count(*) AS n FROM dict)), 6) AS by_code, CASE WHEN visible THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS by_sight
FROM zn JOIN shown USING (cell_idx) JOIN coded USING (cell_idx) JOIN cells USING (cell_idx) LEFT JOIN (SELECT category, code AS k FROM dict) ON category = cell_type""")
def depth_values(c: CellSet) -> DataFrame:
    shown, coded = shown_cells(c), color.gene_codes(c.cells, c.expression, "G_k")
    vmax = c.expression.where("gene = 'G_k'").agg(F.max("value")).first()[0]
    n = color.dictionary(c.cells, "cell_type").count()
    found = color.depth(c.cells, z=color.normalised_z(points(c.coords, "X_umap")), shown=shown).withColumnRenamed("depth", "by_z")
    for name, df in (("by_t", color.depth(c.cells, t=color.display_range(coded, float(vmax)))), ("by_code", color.depth(c.cells, codes=color.category_codes(c.cells, "cell_type"), n_codes=n)), ("by_sight", color.depth(c.cells, shown=shown))):
        found = found.join(df.withColumnRenamed("depth", name), "cell_idx")
    return rounded(found, "by_z", "by_t", "by_code")


@query(f", {GENE} SELECT cell_idx, round(least(greatest((code / 255.0 * 80 - 10) / 50, 0), 1), 6) AS t FROM coded")
def display_range(c: CellSet) -> DataFrame:
    return rounded(color.display_range(color.gene_codes(c.cells, c.expression, "G_k"), 80.0, 10.0, 60.0), "t")


# --- pages ---


@query("SELECT chunk, count(*) AS n FROM cells GROUP BY chunk")
def chunk_sizes(c: CellSet) -> DataFrame:
    return c.cells.groupBy("chunk").agg(F.count("*").alias("n"))


WIDE = "wide AS (SELECT cell_idx, pts.x AS spatial_x, pts.y AS spatial_y, umap.x AS X_umap_x, umap.y AS X_umap_y FROM pts JOIN umap USING (cell_idx))"
PAGE = "cell_idx, sample, cell_type, chunk, round(spatial_x, 6) AS spatial_x, round(spatial_y, 6) AS spatial_y, round(X_umap_x, 6) AS X_umap_x, round(X_umap_y, 6) AS X_umap_y"
KEYS = ["spatial", "X_umap"]


def as_page(df: DataFrame, *more: str) -> DataFrame:
    names = [f"{k}_{a}" for k in KEYS for a in "xy"]
    return rounded(df.select("cell_idx", "sample", "cell_type", "chunk", *names, *more), *names)


@query(f", {WIDE}, {GENE}, {ZN}, {DICTIONARY} SELECT {PAGE}, v AS expression, coalesce(dict.code, 0)::INT AS code, round(zn, 6) AS X_umap_z FROM cells JOIN wide USING (cell_idx) JOIN gene_v USING (cell_idx) JOIN zn USING (cell_idx) LEFT JOIN dict ON category = cell_type WHERE chunk = 1")
def chunk_page(c: CellSet) -> DataFrame:
    """One chunk with all places, z over all cells, a gene and an attribute."""
    found = page.chunk_page(c.cells, c.coords, KEYS, 1, c.expression, "G_k", color.category_codes(c.cells, "cell_type"), page.heights(c.coords))
    return rounded(as_page(found, "expression", "code", "X_umap_z"), "X_umap_z")


BOX = (20.0, 140.0, 60.0, 260.0)
SEEN = "seen AS (SELECT cell_idx, x, y, sqrt((x - 80) * (x - 80) + (y - 160) * (y - 160)) AS d FROM pts WHERE sqrt((x - 80) * (x - 80) + (y - 160) * (y - 160)) <= 60)"


@query(f", {SEEN}, {WIDE} SELECT {PAGE} FROM seen JOIN cells USING (cell_idx) JOIN wide USING (cell_idx) WHERE chunk <> 0")
def viewport_page(c: CellSet) -> DataFrame:
    return as_page(page.viewport_page(c.cells, c.coords, "spatial", BOX, KEYS, most=1_000_000))


@query(f", {SEEN}, {WIDE}, {GENE}, {DICTIONARY} SELECT {PAGE}, v AS expression, coalesce(dict.code, 0)::INT AS code FROM seen JOIN cells USING (cell_idx) JOIN wide USING (cell_idx) JOIN gene_v USING (cell_idx) LEFT JOIN dict ON category = cell_type WHERE chunk <> 0")
def viewport_page_coloured(c: CellSet) -> DataFrame:
    found = page.viewport_page(c.cells, c.coords, "spatial", BOX, KEYS, most=1_000_000, expression=c.expression, gene="G_k", codes=color.category_codes(c.cells, "cell_type"))
    return as_page(found, "expression", "code")


@query(f", {SEEN}, {WIDE}, {GENE} SELECT {PAGE}, v AS expression FROM seen JOIN cells USING (cell_idx) JOIN wide USING (cell_idx) JOIN gene_v USING (cell_idx) WHERE chunk <> 0")
def viewport_stored(c: CellSet) -> DataFrame:
    """The same of a cell set that was stored by place and opened again; zones that the view doesn't meet aren't read."""
    path = fresh_path(c.cells.sparkSession, "cells")
    sinks.save_cells(c, path)
    held = CellSet.open(c.cells.sparkSession, path)
    found = page.viewport_page(held.cells, held.coords, "spatial", BOX, KEYS, most=1_000_000, expression=held.expression, gene="G_k", places=page.stored_places(held, "spatial", BOX))
    return as_page(found, "expression")


@query(f", {SEEN} SELECT cell_idx, round(d, 6) AS d FROM seen ORDER BY -ln({sql_unit(42, 'cell_idx')}) / exp(-((d / 60) * (d / 60)) / 0.5), cell_idx LIMIT 700")
def viewport_sample(c: CellSet) -> DataFrame:
    return rounded(page.viewport_sample(page.viewport(points(c.coords, "spatial"), BOX), 60.0, 700).select("cell_idx", "d"), "d")


@query(f"SELECT cell_idx, chunk FROM cells WHERE chunk = 0 ORDER BY {sql_unit(42, 'cell_idx')}, cell_idx LIMIT 500")
def overview_sample(c: CellSet) -> DataFrame:
    return page.overview_sample(c.cells.select("cell_idx", "chunk"), 500)


@query("SELECT cell_idx, chunk, row_number() OVER (PARTITION BY chunk ORDER BY cell_idx)::BIGINT AS place FROM cells")
def loading_order(c: CellSet) -> DataFrame:
    return page.loading_order(c.cells).withColumn("place", F.row_number().over(Window.partitionBy("chunk").orderBy("cell_idx")).cast("long"))


@query(f", {DICTIONARY} SELECT cell_idx, cell_type, coalesce(code - 1, 0)::INT AS code, score FROM cells LEFT JOIN dict ON category = cell_type WHERE chunk = 2")
def page_attribute_codes(c: CellSet) -> DataFrame:
    codes = color.category_codes(c.cells, "cell_type", code_base=0).select("cell_idx", "code")
    return c.cells.where("chunk = 2").join(codes, "cell_idx").select("cell_idx", "cell_type", "code", "score")


@query("SELECT cell_idx, cell_type, sample FROM cells WHERE cell_type = 'click' OR sample IN ('u1', 'u2')")
def category_filter(c: CellSet) -> DataFrame:
    found = samples.cells_of(c.cells, "cell_type", "click").unionAll(samples.cells_in(c.cells, "sample", ["u1", "u2"]))
    return found.select("cell_idx", "cell_type", "sample").distinct()


@query("SELECT what, count(*) AS n, sum(cell_idx)::BIGINT AS total FROM cells, (VALUES ('all'), ('blank'), ('click'), ('list'), ('no column'), ('no list')) t(what) WHERE CASE what WHEN 'click' THEN cell_type = 'click' WHEN 'list' THEN order_no IN (1, 3) ELSE true END GROUP BY what")
def category_rules(c: CellSet) -> DataFrame:
    """What the two category filters keep, with the names that mean all cells."""
    kept = {"all": samples.cells_of(c.cells, samples.ALL_CELLS, None), "blank": samples.cells_of(c.cells, " ", "x"), "click": samples.cells_of(c.cells, "cell_type", "click")}
    kept |= {"list": samples.cells_in(c.cells, "order_no", ["1", "3"]), "no column": samples.cells_in(c.cells, "nothing", ["1"]), "no list": samples.cells_in(c.cells, "order_no", [])}
    every = None
    for what, df in kept.items():
        part = df.select(F.lit(what).alias("what"), "cell_idx")
        every = part if every is None else every.unionAll(part)
    return every.groupBy("what").agg(F.count("*").alias("n"), F.sum("cell_idx").alias("total"))


@query("""SELECT gene, gene IN ('G_k', 'G_m', 'G_v', 'G_0') AS known FROM (VALUES ('G_k'), ('G_m'), ('G_0'), ('nothing')) t(gene)""")
def groups_known_missing(c: CellSet) -> DataFrame:
    return color.known_genes(c.genes, ["G_k", " G_m ", "G_0", "nothing", ""])


# --- what there is ---


@query("""SELECT * FROM (VALUES ('attribute', 'sample', 'categorical'), ('attribute', 'cell_type', 'categorical'), ('attribute', 'score', 'numeric'), ('attribute', 'condition', 'categorical'), ('attribute', 'batch', 'categorical'), ('attribute', 'order_no', 'numeric')) t(kind, name, detail)
UNION ALL SELECT 'embedding', key, replace(key, 'X_', '') FROM coords GROUP BY key UNION ALL SELECT 'layout', 'X_mine', 'mine'
UNION ALL SELECT 'sample', condition, (row_number() OVER (ORDER BY min(cell_idx)) - 1)::VARCHAR FROM cells GROUP BY condition""")
def catalogue(c: CellSet) -> DataFrame:
    """Attributes, embeddings, layouts and samples after a layout was added and the sample column changed."""
    laid = c.coords.where("key = 'spatial'").withColumn("key", F.lit("X_mine"))
    return replace(c, coords=c.coords.unionAll(laid)).with_sample("condition").with_sample("nothing", needed=False).catalogue()


@query("""SELECT policy, wanted, found, n FROM (VALUES ('region', 'umap', 'X_umap'), ('region', 'other', 'spatial'), ('ribbon', 'umap', 'spatial'), ('ribbon', 'X_umap', 'X_umap'), ('recompute', 'umap', 'spatial'), ('recompute', 'X_umap', 'X_umap')) t(policy, wanted, found) JOIN (SELECT key AS found, count(*) AS n FROM coords GROUP BY key) USING (found)""")
def embedding_rules(c: CellSet) -> DataFrame:
    """The embeddings that names mean under each rule."""
    asked = [(p, k, resolve(embedding_keys(c.coords), k, p)) for p, k in (("region", "umap"), ("region", "other"), ("ribbon", "umap"), ("ribbon", "X_umap"), ("recompute", "umap"), ("recompute", "X_umap"))]
    n = c.coords.groupBy(F.col("key").alias("found")).agg(F.count("*").alias("n"))
    return c.cells.sparkSession.createDataFrame(asked, "policy string, wanted string, found string").join(n, "found").select("policy", "wanted", "found", "n")


@query("SELECT cell_idx, x, y FROM umap")
def embedding_scan(c: CellSet) -> DataFrame:
    return full_scan(c.coords, "X_umap")


@query("SELECT sample, name LIKE 'n%' OR name IN ('', '__NA__') AS off FROM (SELECT sample, CASE ordinal % 6 WHEN 0 THEN 'nan' WHEN 1 THEN 'None' WHEN 2 THEN '' WHEN 3 THEN '__NA__' ELSE sample END AS name FROM stats) WHERE name <> 'None' UNION ALL SELECT sample, true FROM stats WHERE ordinal % 6 = 1")
def sample_guard(c: CellSet) -> DataFrame:
    """Names that stand for no sample."""
    k = F.col("ordinal") % 6
    name = F.when(k == 0, "nan").when(k == 1, "None").when(k == 2, "").when(k == 3, "__NA__").otherwise(F.col("sample"))
    return samples.sample_stats(c.cells, points(c.coords, "spatial")).select("sample", unassigned(name).alias("off"))


@query("""SELECT 'some_set' AS mask_set, 'Some Set' AS label, cell_type AS category, code, color, n FROM (SELECT cell_type, code, color, n FROM (VALUES ('click', 1, '#111111'), ('view', 2, '#222222')) t(cell_type, code, color) JOIN (SELECT cell_type, count(*) AS n FROM cells GROUP BY cell_type) USING (cell_type))""")
def palette_roundtrip(c: CellSet) -> DataFrame:
    """A palette that replaces an earlier one, and the label of a stored mask set."""
    path = store_of(c)
    sinks.save_palette(c.cells, path, "cell_type", ["old"], ["#000000"])
    sinks.save_palette(c.cells, path, "sample", ["u1"], ["#333333"])
    sinks.save_palette(c.cells, path, "cell_type", ["click", "view"], ["#111111", "#222222"])
    stored = c.cells.sparkSession.read.parquet(path).where("column = 'cell_type'")
    n = c.cells.groupBy(F.col("cell_type").alias("category")).agg(F.count("*").alias("n"))
    sets = mask_sets(n.select(F.lit("some_set").alias("mask_set")))
    return stored.join(n, "category").crossJoin(F.broadcast(sets)).select("mask_set", "label", "category", F.col("cat_code").alias("code"), "color", "n")


@query(f", {WIDE} SELECT chunk, count(*) AS n, min(cell_idx) AS low, max(cell_idx) AS high, true AS ascending, round(sum(spatial_x), 3) AS total FROM cells JOIN wide USING (cell_idx) GROUP BY chunk")
def page_export(c: CellSet) -> DataFrame:
    """Exported pages read again: every file holds its cells in ascending order."""
    path = store_of(c)
    sinks.export_pages(page.page(c.cells, c.coords, KEYS), path)
    read = c.cells.sparkSession.read.parquet(path).select("chunk", "cell_idx", "spatial_x", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("place"))
    read = read.withColumn("after", F.lag("cell_idx").over(Window.partitionBy("file").orderBy("place")) < F.col("cell_idx"))
    return read.groupBy("chunk").agg(F.count("*").alias("n"), F.min("cell_idx").alias("low"), F.max("cell_idx").alias("high"), F.bool_and(F.coalesce("after", F.lit(True))).alias("ascending"), F.round(F.sum("spatial_x"), 3).alias("total"))


# --- samples and layouts ---


@query("SELECT sample, round(cx, 6) AS cx, round(cy, 6) AS cy, round(w, 6) AS w, round(h, 6) AS h, n, ordinal::BIGINT AS ordinal FROM stats")
def sample_stats(c: CellSet) -> DataFrame:
    return rounded(samples.sample_stats(c.cells, points(c.coords, "spatial")), "cx", "cy", "w", "h").withColumn("ordinal", F.col("ordinal").cast("long"))


@query("""SELECT a, sample, category, (dense_rank() OVER (PARTITION BY a ORDER BY category) - 1)::BIGINT AS code, valid FROM (SELECT 'condition' AS a, sample, min(condition) AS category, min(condition) = max(condition) AS valid FROM cells GROUP BY sample
UNION ALL SELECT 'cell_type', sample, min(cell_type), min(cell_type) = max(cell_type) FROM cells GROUP BY sample)""")
def sample_attr_check(c: CellSet) -> DataFrame:
    parts = [samples.sample_attribute(c.cells, a).select(F.lit(a).alias("a"), "sample", "category", F.col("code").cast("long").alias("code"), "valid") for a in ("condition", "cell_type")]
    return parts[0].unionAll(parts[1])


GRID = """grid AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY sort_value, order_value, sample) - 1 AS slot, dense_rank() OVER (ORDER BY grp) - 1 AS grp_no, max(w) OVER () * 1.3 AS cw, max(h) OVER () * 1.15 AS ch
  FROM stats JOIN (SELECT sample, min(condition) AS grp, min(batch) AS sort_value, arg_min(order_no, cell_idx) AS order_value FROM cells GROUP BY sample) USING (sample)),
placed AS (SELECT sample, grp, slot, cx, cy, grp_no % 2 * (3 * cw + 1.5 * cw) + slot % 3 * cw + cw / 2 AS tx,
  (grp_no // 2) * ((SELECT max(slot // 3 + 1) FROM grid) * ch + 1.5 * ch) + (slot // 3) * ch + ch / 2 AS ty FROM grid)"""


@query(f""", {GRID} SELECT cell_idx, sample, grp, slot::BIGINT AS slot, round(x + tx - cx, 5) AS x, round(y + ty - cy, 5) AS y FROM placed JOIN cells USING (sample) JOIN pts USING (cell_idx)""")
def layout_group_grid(c: CellSet) -> DataFrame:
    places = points(c.coords, "spatial")
    targets = cut(layout.group_grid(c.cells, places, group_by="condition", sort_by="batch", order_by="order_no", gap_y=0.5))
    found = layout.move_cells(c.cells, places, targets).join(c.cells.select("cell_idx", "sample"), "cell_idx").join(targets.select("sample", "grp", F.col("slot").cast("long").alias("slot")), "sample")
    return rounded(found.select("cell_idx", "sample", "grp", "slot", "x", "y"), "x", "y", places=5)


def square_sql(gap: float, transpose: bool, pivot: bool) -> str:
    """The named sub-queries `part` of a square or pivoted layout by condition; columns by batch, rows by order_no."""
    scale = 1 + gap * 0.25
    base = f"""med AS (SELECT (list(w ORDER BY w))[count(*) // 2 + 1] * {scale} AS cw, (list(h ORDER BY h))[count(*) // 2 + 1] * {scale} AS ch FROM stats),
attrs AS (SELECT sample, min(condition) AS grp, min(batch) AS col_name, arg_min(order_no, cell_idx)::VARCHAR AS row_name FROM cells GROUP BY sample),
coded_s AS (SELECT stats.*, grp, col_name, row_name, dense_rank() OVER (ORDER BY grp) - 1 AS g, dense_rank() OVER (ORDER BY col_name) - 1 AS col_code, dense_rank() OVER (ORDER BY row_name) - 1 AS row_code FROM stats JOIN attrs USING (sample)),"""
    if pivot:
        a, b = ("b", "a") if transpose else ("a", "b")
        base += f"""
ab AS (SELECT *, dense_rank() OVER (PARTITION BY g ORDER BY col_code) - 1 AS a, row_number() OVER (PARTITION BY g, col_code ORDER BY row_code, sample) - 1 AS b FROM coded_s),
cr AS (SELECT *, {a} AS c, {b} AS r, max({a}) OVER (PARTITION BY g) + 1 AS nc, max({b}) OVER (PARTITION BY g) + 1 AS nr FROM ab),"""
    else:
        wide, high = "ceil(sqrt(n_in))::BIGINT", "ceil(n_in / ceil(sqrt(n_in)))::BIGINT"
        nc, nr = (high, wide) if transpose else (wide, high)
        base += f"""
kk AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY row_code, sample) - 1 AS k, count(*) OVER (PARTITION BY g) AS n_in FROM coded_s),
cr AS (SELECT *, {nc} AS nc, {nr} AS nr, k % {nc} AS c, k // {nc} AS r FROM kk),"""
    return base + """
part AS (SELECT *, g % 2 * (max(nc * cw) OVER () + 1.2 * cw) AS x0, (g // 2) * (max(nr * ch) OVER () + 1.2 * ch) AS y0, max(nc * cw) OVER () AS bw FROM cr, med)"""


SQUARE_OUT = "SELECT sample, grp, round(x0 + c * cw + cw / 2, 5) AS target_x, round(y0 + r * ch + ch / 2, 5) AS target_y FROM part"
SQUARE = {"group_by": "condition", "rows": "order_no", "gap": 2.0}
PIVOT = {**SQUARE, "columns": "batch", "gap": 1.0}


def squares(c: CellSet, parameters: dict) -> DataFrame:
    return rounded(layout.auto_square(c.cells, points(c.coords, "spatial"), **parameters).select("sample", "grp", "target_x", "target_y"), "target_x", "target_y", places=5)


@query(f", {square_sql(2.0, False, False)} {SQUARE_OUT}")
def layout_auto_square(c: CellSet) -> DataFrame:
    return squares(c, SQUARE)


@query(f", {square_sql(1.0, False, True)} {SQUARE_OUT}")
def layout_pivot(c: CellSet) -> DataFrame:
    return squares(c, PIVOT)


@query(f", {square_sql(0.5, True, True)} {SQUARE_OUT}")
def layout_adjusted(c: CellSet) -> DataFrame:
    return squares(c, layout.adjusted(PIVOT, gap=0.5, transpose=True))


@query(f""", {square_sql(1.0, False, True)}, lab AS (SELECT DISTINCT 'group' AS kind, grp AS name, x0 + bw / 2 AS x, y0 - ch * 0.8 AS y FROM part
UNION ALL SELECT DISTINCT 'column', col_name, x0 + a * cw + cw / 2, y0 - ch * 0.2 FROM part
UNION ALL SELECT DISTINCT 'row', row_name, x0 - cw * 0.2, y0 + (dense_rank() OVER (PARTITION BY g ORDER BY row_code) - 1) * ch + ch / 2 FROM part)
SELECT kind, name, round(x, 5) AS x, round(y, 5) AS y FROM lab""")
def layout_labels(c: CellSet) -> DataFrame:
    return rounded(layout.labels(c.cells, points(c.coords, "spatial"), **PIVOT), "x", "y", places=5)


@query(f""", {GRID}, lab AS (SELECT sample, grp, slot::BIGINT AS slot, tx, ty, cx, cy FROM placed), moved AS (SELECT x + tx - cx AS x, y + ty - cy AS y FROM lab JOIN cells USING (sample) JOIN pts USING (cell_idx))
SELECT sample, grp, slot, round(tx, 5) AS x, round(ty, 5) AS y, (SELECT string_agg(sample, ',' ORDER BY slot) FROM lab b WHERE b.grp = lab.grp) AS samples, (SELECT round(min(x), 5) FROM moved) AS min_x, (SELECT round(max(y), 5) FROM moved) AS max_y FROM lab""")
def layout_grid_parts(c: CellSet) -> DataFrame:
    """Labels, groups and bounds of a group grid."""
    found = layout.grid_parts(c.cells, points(c.coords, "spatial"), group_by="condition", sort_by="batch", order_by="order_no", gap_y=0.5)
    named = found["targets"].select("sample", "grp", F.col("slot").cast("long").alias("slot")).join(found["labels"], "sample").join(found["groups"].select("grp", F.array_join("samples", ",").alias("samples")), "grp")
    return rounded(named.crossJoin(F.broadcast(found["bounds"].select("min_x", "max_y"))), "x", "y", "min_x", "max_y", places=5)


TARGETS = [("u0", 1000.0, 0.0), ("u3", 0.0, 1000.0), ("u7", -500.0, 250.0), ("nobody", 1.0, 1.0)]
TARGET_SQL = f"targets AS (SELECT * FROM (VALUES {', '.join(map(str, TARGETS))}) t(sample, tx, ty))"
REBUILT = "rebuilt AS (SELECT cell_idx, sample, x + coalesce(tx - cx, 0) AS x, y + coalesce(ty - cy, 0) AS y FROM cells JOIN pts USING (cell_idx) JOIN stats USING (sample) LEFT JOIN targets USING (sample))"


def rebuilt(c: CellSet) -> DataFrame:
    targets = c.cells.sparkSession.createDataFrame(TARGETS, "sample string, target_x double, target_y double")
    return layout.rebuild(c.cells, points(c.coords, "spatial"), targets)


@query(f", {TARGET_SQL}, {REBUILT} SELECT cell_idx, round(x, 5) AS x, round(y, 5) AS y FROM rebuilt")
def layout_rebuild(c: CellSet) -> DataFrame:
    return rounded(rebuilt(c), "x", "y", places=5)


@query(f", {TARGET_SQL}, {REBUILT} SELECT sample, round(avg(x), 3) + 0.0::DOUBLE AS x, round(avg(y), 3) + 0.0::DOUBLE AS y, count(*) AS n, (SELECT round(min(x), 5) FROM rebuilt) AS min_x, (SELECT round(max(y), 5) FROM rebuilt) AS max_y FROM rebuilt GROUP BY sample")
def layout_loaded(c: CellSet) -> DataFrame:
    ends, labels = layout.loaded(c.cells, rebuilt(c))
    found = rounded(labels.crossJoin(F.broadcast(ends.select("min_x", "max_y"))), "min_x", "max_y", places=5)
    return found.withColumns({a: F.round(a, 3) + F.lit(0.0) for a in "xy"})  # no negative zeros


# --- selections and regions ---

LASSO = [(10.0, 20.0), (120.0, 40.0), (180.0, 200.0), (60.0, 330.0), (30.0, 150.0), (90.0, 120.0)]
RINGS = {
    ("one", 0): LASSO,
    ("two", 0): [(0.0, 0.0), (50.0, 0.0), (50.0, 100.0), (0.0, 100.0)],
    ("two", 1): [(40.0, 50.0), (150.0, 50.0), (150.0, 140.0), (40.0, 140.0)],
    ("hole", 0): [(20.0, 200.0), (160.0, 200.0), (160.0, 340.0), (20.0, 340.0)],
    ("hole", 1): [(60.0, 240.0), (100.0, 240.0), (100.0, 300.0), (60.0, 300.0)],
    ("far", 0): [(5000.0, 5000.0), (5010.0, 5000.0), (5010.0, 5010.0)],
    ("line", 0): [(0.0, 0.0), (200.0, 300.0)],
}
ORDER = {"one": 0, "two": 1, "hole": 2, "far": 3, "line": 4}


def edge_sql(rings: dict) -> str:
    rows = [f"('{r}', {k}, {a[0]}, {a[1]}, {b[0]}, {b[1]})" for (r, k), ring in rings.items() if len(ring) > 2 for a, b in zip(ring, ring[-1:] + ring[:-1], strict=True)]
    return f"edge AS (SELECT * FROM (VALUES {', '.join(rows)}) t(region, ring_no, xi, yi, xj, yj))"


HITS = f"""{edge_sql(RINGS)}, hits AS (SELECT DISTINCT region, cell_idx FROM (SELECT region, ring_no, cell_idx FROM pts JOIN edge ON (yi > y) <> (yj > y) AND x < (xj - xi) * (y - yi) / (yj - yi) + xi GROUP BY ALL HAVING count(*) % 2 = 1))"""


def ring_table(c: CellSet, rings: dict = RINGS) -> DataFrame:
    """region, ring_no, ring of the given rings."""
    spark = c.cells.sparkSession
    return spark.createDataFrame([(r, k, ring) for (r, k), ring in rings.items()], "region string, ring_no int, ring array<struct<x:double,y:double>>")


@query(", " + HITS + " SELECT cell_idx FROM hits WHERE region = 'one'")
def select_polygon(c: CellSet) -> DataFrame:
    return regions.select(points(c.coords, "spatial"), "lasso", LASSO)


@query("SELECT cell_idx FROM pts WHERE x BETWEEN 15 AND 70 AND y BETWEEN 100 AND 250")
def select_rect(c: CellSet) -> DataFrame:
    return regions.select(points(c.coords, "spatial"), "rectangle", [(70.0, 100.0), (15.0, 250.0)])


@query("SELECT cell_idx FROM pts WHERE ((x - 80) / 50) * ((x - 80) / 50) + ((y - 180) / 90) * ((y - 180) / 90) <= 1")
def select_ellipse(c: CellSet) -> DataFrame:
    return regions.select(points(c.coords, "spatial"), "circle", [(80.0, 180.0), (130.0, 180.0), (80.0, 270.0)])


@query(", " + HITS + f", {SHOWN}" + """ SELECT selection, cell_idx FROM (SELECT 'lasso' AS selection, cell_idx FROM hits WHERE region = 'one'
UNION ALL SELECT 'box', cell_idx FROM pts WHERE x BETWEEN 15 AND 70 AND y BETWEEN 100 AND 250
UNION ALL SELECT 'disc', cell_idx FROM pts WHERE ((x - 80) / 50) * ((x - 80) / 50) + ((y - 180) / 50) * ((y - 180) / 50) <= 1)""")
def select_batch(c: CellSet) -> DataFrame:
    shapes = [{"name": "lasso", "tool": "lasso", "path": LASSO}, {"name": "box", "tool": "rectangle", "path": [(70.0, 100.0), (15.0, 250.0)]}, {"name": "disc", "tool": "circle", "path": [(80.0, 180.0), (130.0, 180.0)]}]
    return regions.select_batch(points(c.coords, "spatial"), shapes)


@query(", " + HITS + f", {SHOWN} SELECT cell_idx FROM hits JOIN shown USING (cell_idx) WHERE region = 'one' AND visible")
def select_visible(c: CellSet) -> DataFrame:
    return regions.select(points(c.coords, "spatial"), "polygon", LASSO, shown=shown_cells(c))


@query(", " + HITS + """ SELECT region, count(cell_idx) AS n, round(avg(x), 6) AS centroid_x, round(avg(y), 6) AS centroid_y, count(cell_idx) = 0 AS failed
FROM (VALUES ('one'), ('two'), ('hole'), ('far'), ('line')) t(region) LEFT JOIN hits USING (region) LEFT JOIN pts USING (cell_idx) GROUP BY region""")
def recapture_regions(c: CellSet) -> DataFrame:
    return rounded(regions.recapture(points(c.coords, "spatial"), ring_table(c)), "centroid_x", "centroid_y")


LABELS = f"labels AS (SELECT cell_idx, arg_max(region, ordinal) AS label FROM hits JOIN (VALUES {', '.join(f"('{k}', {v})" for k, v in ORDER.items())}) t(region, ordinal) USING (region) GROUP BY cell_idx)"


def region_labels(c: CellSet) -> DataFrame:
    order = c.cells.sparkSession.createDataFrame(list(ORDER.items()), "region string, ordinal int")
    return regions.last_region(regions.capture(points(c.coords, "spatial"), ring_table(c)), order)


@query(f", {HITS}, {LABELS} SELECT cell_idx, sample, label AS region_group FROM cells LEFT JOIN labels USING (cell_idx)")
def region_to_attribute(c: CellSet) -> DataFrame:
    return sinks.attribute_column(c.cells.select("cell_idx", "sample"), region_labels(c), "region_group")


@query(f""", {HITS}, every AS (SELECT region, cell_idx, 0 AS p FROM hits UNION ALL SELECT 'far', cell_idx, 1 FROM cells WHERE cell_type = 'error' UNION ALL SELECT 'one', cell_idx, 1 FROM cells WHERE cell_type = 'error'
UNION ALL SELECT 'line', cell_idx, 2 FROM cells WHERE cell_type = 'view' UNION ALL SELECT 'far', cell_idx, 2 FROM cells WHERE cell_type = 'view')
SELECT DISTINCT region, cell_idx FROM every JOIN (SELECT region, min(p) AS p FROM every GROUP BY region) USING (region, p)""")
def region_fallback(c: CellSet) -> DataFrame:
    some = lambda kind, *names: c.cells.where(F.col("cell_type") == kind).select("cell_idx", F.explode(F.array(*map(F.lit, names))).alias("region"))
    return regions.first_found([regions.capture(points(c.coords, "spatial"), ring_table(c)), some("error", "far", "one"), some("view", "line", "far")])


MOVED_SQL = """means AS (SELECT region, avg(pts.x) AS sx, avg(pts.y) AS sy, avg(umap.x) AS tx, avg(umap.y) AS ty FROM hits JOIN pts USING (cell_idx) JOIN umap USING (cell_idx) GROUP BY region)"""
RING_ROWS = ", ".join(f"('{r}', {k}, {i}, {x}, {y})" for (r, k), ring in RINGS.items() for i, (x, y) in enumerate(ring))


@query(f""", {HITS}, {MOVED_SQL} SELECT region, ring_no::INT AS ring_no, vertex::INT AS vertex, round(vx + coalesce(tx - sx, 0), 6) AS x, round(vy + coalesce(ty - sy, 0), 6) AS y, round(tx, 6) AS centroid_x, round(ty, 6) AS centroid_y
FROM (VALUES {RING_ROWS}) t(region, ring_no, vertex, vx, vy) LEFT JOIN means USING (region)""")
def rings_moved(c: CellSet) -> DataFrame:
    rings = ring_table(c)
    found = regions.move_rings(rings, regions.capture(points(c.coords, "spatial"), rings), c.coords, "spatial", "X_umap")
    return rounded(vertices(found, "region", "ring_no", "centroid_x", "centroid_y"), "centroid_x", "centroid_y")


RING_MEANS = ", ".join(f"('{r}', {sum(p[0] for p in ring) / len(ring)!r}, {sum(p[1] for p in ring) / len(ring)!r})" for (r, k), ring in RINGS.items() if k == 0)


@query(f""", {HITS}, firsts AS (SELECT region, cell_idx FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY cell_idx) AS k FROM hits) WHERE k <= 500),
far AS (SELECT region, key, pow(rx - avg(x::DOUBLE), 2) + pow(ry - avg(y::DOUBLE), 2) AS d2 FROM firsts JOIN coords USING (cell_idx) JOIN (VALUES {RING_MEANS}) t(region, rx, ry) USING (region) GROUP BY region, key, rx, ry)
SELECT region, arg_min(key, d2) AS key, round(min(d2), 4) AS d2 FROM far GROUP BY region""")
def embedding_vote(c: CellSet) -> DataFrame:
    rings = ring_table(c)
    return rounded(regions.vote(rings, regions.capture(points(c.coords, "spatial"), rings), c.coords), "d2", places=4)


@query(f", {HITS} SELECT CASE WHEN region = 'two' THEN 'renamed' ELSE region END AS region, count(*) AS n FROM hits GROUP BY 1")
def masks_rename(c: CellSet) -> DataFrame:
    rings = ring_table(c)
    found = regions.rename({"region_rings": rings, "region_cells": regions.capture(points(c.coords, "spatial"), rings)}, "two", " renamed ")
    return found["region_cells"].groupBy("region").agg(F.count("*").alias("n"))


@query("""SELECT sample, (row_number() OVER (PARTITION BY sample ORDER BY cell_idx) - 1)::INT AS position, cell_idx FROM cells WHERE cell_type = 'click'""")
def delta_decode(c: CellSet) -> DataFrame:
    steps = cut(regions.encode_blocks(c.cells.where("cell_type = 'click'").select(F.col("sample").alias("region"), "cell_idx"), size=1024))
    return regions.decode_blocks(steps, "region").withColumnRenamed("region", "sample")


@query("""SELECT sample, (row_number() OVER (PARTITION BY sample ORDER BY cell_idx) - 1)::INT AS position, cell_idx FROM cells WHERE cell_type = 'error'""")
def delta_text(c: CellSet) -> DataFrame:
    """Steps as text, one list for each region (all numbers of cells lie in one block here), and back."""
    steps = regions.encode_blocks(c.cells.where("cell_type = 'error'").select(F.col("sample").alias("region"), "cell_idx"), size=1 << 40)
    return regions.decode_deltas(cut(regions.delta_text(steps)), "region", "deltas").withColumnRenamed("region", "sample")


@query(f""", {HITS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY cell_idx) - 1 AS k, count(*) OVER (PARTITION BY region) AS n FROM hits)
SELECT region, cell_idx FROM ranked WHERE k % greatest(1, n // 300) = 0 AND k < greatest(1, n // 300) * 300""")
def capped_members(c: CellSet) -> DataFrame:
    return regions.spread_members(regions.capture(points(c.coords, "spatial"), ring_table(c)), 300)


@query(f", {HITS} SELECT region, cell_idx FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY cell_idx) AS k FROM hits) WHERE k <= 500")
def members_first_k(c: CellSet) -> DataFrame:
    return regions.first_members(regions.capture(points(c.coords, "spatial"), ring_table(c)), 500)


@query(f", {HITS} SELECT region, cell_idx FROM hits WHERE region <> 'two' UNION ALL SELECT 'two', cell_idx FROM cells WHERE cell_type = 'error' UNION ALL SELECT 'new', cell_idx FROM cells WHERE cell_type = 'view'")
def members_upsert(c: CellSet) -> DataFrame:
    new = c.cells.select("cell_idx", F.when(F.col("cell_type") == "error", "two").when(F.col("cell_type") == "view", "new").alias("region")).where("region is not null")
    return regions.upsert(regions.capture(points(c.coords, "spatial"), ring_table(c)), new)


@query(f", {HITS} SELECT region, round(avg(x), 6) AS x, round(avg(y), 6) AS y, count(*) AS n FROM hits JOIN umap USING (cell_idx) GROUP BY region")
def selection_labels(c: CellSet) -> DataFrame:
    return rounded(regions.centroids(regions.capture(points(c.coords, "spatial"), ring_table(c)), points(c.coords, "X_umap")), "x", "y")


def store_of(c: CellSet) -> str:
    """A new folder below the one that driver and executors share."""
    return fresh_path(c.cells.sparkSession, "store")


GROUPS = [("first", 0, "one", True, True), ("first", 1, "two", True, True), ("second", 0, "hole", False, True)]


def stored_masks(c: CellSet, members: DataFrame, rings: DataFrame, embedding: str = "spatial", **more) -> dict[str, DataFrame]:
    spark, path = c.cells.sparkSession, store_of(c)
    groups = spark.createDataFrame(GROUPS, "grp string, ordinal int, region string, expanded boolean, visible boolean")
    sinks.save_masks(path, "some_masks", regions.masks(rings, members, points(c.coords, "spatial"), groups, embedding, **more))
    return sinks.load_masks(spark, path, "some_masks")


FALLBACK = f"""every AS (SELECT region, cell_idx, 0 AS p FROM hits UNION ALL SELECT 'far', cell_idx, 1 FROM cells WHERE cell_type = 'error' UNION ALL SELECT 'one', cell_idx, 1 FROM cells WHERE cell_type = 'error'
UNION ALL SELECT 'line', cell_idx, 2 FROM cells WHERE cell_type = 'view' UNION ALL SELECT 'far', cell_idx, 2 FROM cells WHERE cell_type = 'view'),
held AS (SELECT DISTINCT region, cell_idx FROM every JOIN (SELECT region, min(p) AS p FROM every GROUP BY region) USING (region, p))"""


def fallbacks(c: CellSet) -> list[DataFrame]:
    some = lambda kind, *names: c.cells.where(F.col("cell_type") == kind).select("cell_idx", F.explode(F.array(*map(F.lit, names))).alias("region"))
    return [some("error", "far", "one"), some("view", "line", "far")]


@query(f""", {HITS}, {FALLBACK} SELECT cell_idx, sample, arg_max(region, ordinal) AS saved FROM cells LEFT JOIN (SELECT cell_idx, region, ordinal FROM held JOIN (VALUES {', '.join(f"('{k}', {v})" for k, v in ORDER.items())}) t(region, ordinal) USING (region)) USING (cell_idx) GROUP BY cell_idx, sample""")
def region_group_saved(c: CellSet) -> DataFrame:
    """An attribute from a group of regions, where regions that capture nothing take stored members."""
    order = c.cells.sparkSession.createDataFrame(list(ORDER.items()), "region string, ordinal int")
    return regions.save_group(c.cells.select("cell_idx", "sample"), points(c.coords, "spatial"), ring_table(c), order, "saved", fallbacks(c))


@query(f""", {HITS}, {FALLBACK}, n AS (SELECT region, count(*) AS n FROM held GROUP BY region)
SELECT grp, coalesce(ordinal, -1)::INT AS ordinal, region, 'polygon' AS tool, true AS visible, coalesce(n, 0) AS n, 'sample' AS sample_column, 0.25::DOUBLE AS fill_opacity, 2.0::DOUBLE AS outline_weight, 0.125::DOUBLE AS alpha
FROM (VALUES ('one'), ('two'), ('hole'), ('far'), ('line')) t(region) LEFT JOIN (VALUES {', '.join(f"('{g}', {o}, '{r}')" for g, o, r, _, _ in GROUPS)}) u(grp, ordinal, region) USING (region) LEFT JOIN n USING (region)""")
def mask_details(c: CellSet) -> DataFrame:
    """Stored masks by groups, with what is stored about them."""
    rings = ring_table(c)
    stored = stored_masks(c, regions.capture(points(c.coords, "spatial"), rings), rings, fallbacks=fallbacks(c), sample_column="sample", fill_opacity=0.25, alpha=0.125)
    found = regions.grouped_regions(stored).withColumn("ordinal", F.coalesce("ordinal", F.lit(-1)))
    return found.crossJoin(F.broadcast(stored["mask_info"].drop("form")))


@query(f""", {HITS}, {MOVED_SQL}, kept AS (SELECT region, count(*) AS n FROM hits GROUP BY region) SELECT region, vertex::INT AS vertex, round(vx + coalesce(tx - sx, 0), 6) AS x, round(vy + coalesce(ty - sy, 0), 6) AS y, coalesce(n, 0) AS n
FROM (VALUES {RING_ROWS}) t(region, ring_no, vertex, vx, vy) LEFT JOIN means USING (region) LEFT JOIN kept USING (region) WHERE ring_no = 0""")
def manual_loaded(c: CellSet) -> DataFrame:
    """Selections stored under a wrong embedding: the places of their rings tell the right one; first rings and all members come back."""
    rings = ring_table(c)
    stored = stored_masks(c, regions.capture(points(c.coords, "spatial"), rings), rings, "X_umap", form="selections")
    found = regions.loaded_masks(stored, c.coords, "X_umap")
    n = found["shown_cells"].groupBy("region").agg(F.count("*").alias("n"))
    return vertices(found["region_paths"].join(n, "region", "left").withColumn("n", F.coalesce("n", F.lit(0))), "region", "n")


@query(f""", {HITS}, {MOVED_SQL} SELECT region, vertex::INT AS vertex, round(vx + coalesce(tx - sx, 0), 6) AS x, round(vy + coalesce(ty - sy, 0), 6) AS y, round(tx, 6) AS centroid_x FROM (VALUES {RING_ROWS}) t(region, ring_no, vertex, vx, vy) LEFT JOIN means USING (region) WHERE ring_no = 0""")
def paths_moved(c: CellSet) -> DataFrame:
    rings = ring_table(c)
    found = regions.move_paths(rings.where("ring_no = 0").select("region", "ring"), regions.capture(points(c.coords, "spatial"), rings), c.coords, "spatial", "X_umap")
    return rounded(vertices(found, "region", "centroid_x"), "centroid_x")


@query(f", {HITS}, firsts AS (SELECT region, cell_idx FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY cell_idx) AS k FROM hits) WHERE k <= 300) SELECT region, count(*) AS n, (SELECT count(*) FROM firsts f WHERE f.region = hits.region) AS shown, (SELECT max(cell_idx) FROM firsts f WHERE f.region = hits.region) AS last_shown FROM hits GROUP BY region")
def masks_shown(c: CellSet) -> DataFrame:
    """Loaded region masks show the first members of each region and keep all."""
    rings = ring_table(c)
    found = regions.loaded_masks(stored_masks(c, regions.capture(points(c.coords, "spatial"), rings), rings), c.coords, "spatial", most=300)
    n = found["region_cells"].groupBy("region").agg(F.count("*").alias("n"))
    return n.join(found["shown_cells"].groupBy("region").agg(F.count("*").alias("shown"), F.max("cell_idx").alias("last_shown")), "region")


@query(f""", {HITS}, {MOVED_SQL} SELECT region, ring_no::INT AS ring_no, vertex::INT AS vertex, round(vx + coalesce(tx - sx, 0), 6) AS x, round(vy + coalesce(ty - sy, 0), 6) AS y,
7::BIGINT AS rings, 5::BIGINT AS regions, 2::BIGINT AS groups, (SELECT count(*) FROM hits) AS cells FROM (VALUES {RING_ROWS}) t(region, ring_no, vertex, vx, vy) LEFT JOIN means USING (region)""")
def mask_roundtrip(c: CellSet) -> DataFrame:
    rings = ring_table(c)
    stored = stored_masks(c, regions.capture(points(c.coords, "spatial"), rings), rings)
    found = regions.loaded_masks(stored, c.coords, "X_umap")["region_rings"]
    n = stored["region_rings"].agg(F.count("*").alias("rings"))
    return vertices(found, "region", "ring_no").crossJoin(F.broadcast(n)).crossJoin(F.broadcast(regions.totals(stored)))


@query(f", {HITS} SELECT 'one' AS mask_set, region, count(*) AS n FROM hits GROUP BY region UNION ALL SELECT 'two', 'again', count(*) FROM cells WHERE cell_type = 'error'")
def masks_replaced(c: CellSet) -> DataFrame:
    """Two mask sets, of which the second is stored twice: its later form stands alone, and the first stays."""
    spark, path, rings, places = c.cells.sparkSession, store_of(c), ring_table(c), points(c.coords, "spatial")
    groups = spark.createDataFrame(GROUPS, "grp string, ordinal int, region string, expanded boolean, visible boolean")
    first = regions.masks(rings, regions.capture(places, rings), places, groups, "spatial")
    for name in ("one", "two"):
        sinks.save_masks(path, name, first)
    again = c.cells.where("cell_type = 'error'").select(F.lit("again").alias("region"), "cell_idx")
    sinks.save_masks(path, "two", regions.masks(rings.limit(0), again, places, groups.limit(0), "spatial"))
    each = [sinks.load_masks(spark, path, name)["region_cells"].withColumn("mask_set", F.lit(name)) for name in ("one", "two")]
    return each[0].unionByName(each[1]).groupBy("mask_set", "region").agg(F.count("*").alias("n"))


@query("""SELECT region, count(*) AS n, round(avg(x), 6) AS centroid_x, round(avg(y), 6) AS centroid_y, 'polygon' AS tool FROM (SELECT sample AS region, cell_idx FROM cells WHERE cell_type = 'error') JOIN pts USING (cell_idx) GROUP BY region""")
def manual_roundtrip(c: CellSet) -> DataFrame:
    spark = c.cells.sparkSession
    steps = cut(regions.encode_blocks(c.cells.where("cell_type = 'error'").select(F.col("sample").alias("region"), "cell_idx"), size=1024))
    members = regions.decode_blocks(steps, "region").select("region", "cell_idx")
    stored = stored_masks(c, members, spark.createDataFrame([], "region string, ring_no int, ring array<struct<x:double,y:double>>"), form="selections")
    n = stored["region_cells"].groupBy("region").agg(F.count("*").alias("n"))
    return rounded(stored["regions"].join(n, "region").select("region", "n", "centroid_x", "centroid_y", "tool"), "centroid_x", "centroid_y")


@query(f", {HITS}, {LABELS} SELECT coalesce(label, 'none') AS label, count(*) AS n, sum(cell_idx)::BIGINT AS total FROM cells LEFT JOIN labels USING (cell_idx) GROUP BY 1")
def attr_roundtrip(c: CellSet) -> DataFrame:
    path = store_of(c)
    sinks.attribute_column(c.cells, region_labels(c), "label").write.parquet(path)
    return c.cells.sparkSession.read.parquet(path).groupBy(F.coalesce("label", F.lit("none")).alias("label")).agg(F.count("*").alias("n"), F.sum("cell_idx").alias("total"))


@query(f", {TARGET_SQL}, {REBUILT} SELECT 'X_mine' AS key, cell_idx, round(x::FLOAT::DOUBLE, 3) AS x, round(y::FLOAT::DOUBLE, 3) AS y FROM rebuilt")
def layout_roundtrip(c: CellSet) -> DataFrame:
    spark, path = c.cells.sparkSession, store_of(c)
    for name in ("mine", "X_other"):
        sinks.save_layout(rebuilt(c), path, name, c.cells)
    sinks.delete_layout(spark, path, "other")
    return spark.read.parquet(path).select("key", "cell_idx", F.round(F.col("x").cast("double"), 3).alias("x"), F.round(F.col("y").cast("double"), 3).alias("y"))


@query(f", {TARGET_SQL}, {REBUILT} SELECT sample, round(avg(x), 3) + 0.0::DOUBLE AS x, round(avg(y), 3) + 0.0::DOUBLE AS y, 'by hand' AS note, (SELECT count(*) FROM targets) AS n_targets FROM rebuilt GROUP BY sample")
def layout_loaded_by_name(c: CellSet) -> DataFrame:
    """A layout rebuilt from given centroids under a sample column found by its usual name, stored with a note and loaded again."""
    spark, path = c.cells.sparkSession, store_of(c)
    targets = layout.targets_of(spark, [(x, y) for _, x, y in TARGETS], [n for n, _, _ in TARGETS])
    sinks.save_layout(layout.rebuild(c.cells, points(c.coords, "spatial"), targets, "not there"), f"{path}/coords", "mine", c.cells)
    sinks.save_layout_targets(f"{path}/layouts", "mine", targets, {"note": "by hand"})
    _, labels = layout.loaded(c.cells, sinks.load_layout(spark, f"{path}/coords", "X_mine"))
    note = sinks.layout_note(spark, f"{path}/layouts", "mine")["note"]
    n = spark.read.parquet(f"{path}/layouts").where("layout = 'X_mine'").agg(F.count("*").alias("n_targets"))
    found = labels.select("sample", *[(F.round(a, 3) + F.lit(0.0)).alias(a) for a in "xy"], F.lit(note).alias("note"))
    return found.crossJoin(F.broadcast(n))


# --- ribbon ---

RIBBON = ribbon.Ribbon((10.0, 30.0), (150.0, 300.0), ((120.0, 60.0), (30.0, 240.0)), (40.0, 60.0, 40.0))
N_BINS = 15


def bezier_sql(t: str, p: list[float]) -> str:
    return f"(1-{t})*(1-{t})*(1-{t})*{p[0]} + 3*(1-{t})*(1-{t})*{t}*{p[1]} + 3*(1-{t})*{t}*{t}*{p[2]} + {t}*{t}*{t}*{p[3]}"


def slope_sql(t: str, p: list[float]) -> str:
    return f"3*(1-{t})*(1-{t})*({p[1]} - {p[0]}) + 6*(1-{t})*{t}*({p[2]} - {p[1]}) + 3*{t}*{t}*({p[3]} - {p[2]})"


PX, PY = ([p[k] for p in RIBBON.path()] for k in (0, 1))
BINS = f"""tt AS (SELECT i, i / {N_BINS}.0::DOUBLE AS t FROM range(0, {N_BINS + 1}) r(i)),
ends AS (SELECT i, {bezier_sql('t', PX)} AS x, {bezier_sql('t', PY)} AS y, {slope_sql('t', PX)} AS dx, {slope_sql('t', PY)} AS dy, (40 * 2 * (t - 0.5) * (t - 1) - 60 * 4 * t * (t - 1) + 40 * 2 * t * (t - 0.5)) / 2 AS half FROM tt),
ofs AS (SELECT i, x, y, -dy / sqrt(dx * dx + dy * dy) * half AS wx, dx / sqrt(dx * dx + dy * dy) * half AS wy FROM ends),
quad AS (SELECT a.i AS bin, [a.x + a.wx, b.x + b.wx, b.x - b.wx, a.x - a.wx] AS xs, [a.y + a.wy, b.y + b.wy, b.y - b.wy, a.y - a.wy] AS ys FROM ofs a JOIN ofs b ON b.i = a.i + 1),
side AS (SELECT bin, xs[k] AS xi, ys[k] AS yi, xs[(k + 2) % 4 + 1] AS xj, ys[(k + 2) % 4 + 1] AS yj FROM quad, range(1, 5) r(k)),
inbin AS (SELECT bin, cell_idx FROM pts JOIN side ON (yi > y) <> (yj > y) AND x < (xj - xi) * (y - yi) / (yj - yi) + xi GROUP BY ALL HAVING count(*) % 2 = 1),
heat AS (SELECT gene, bin::INT AS bin, (SELECT count(*) FROM inbin i WHERE i.bin = quad.bin) AS cell_count, coalesce((SELECT sum(value::DOUBLE) FROM inbin i JOIN expression e USING (cell_idx) WHERE i.bin = quad.bin AND e.gene = g.gene) / nullif((SELECT count(*) FROM inbin i WHERE i.bin = quad.bin), 0), 0) AS mean
  FROM quad, (VALUES ('G_k'), ('G_m')) g(gene))"""


def heat_of(c: CellSet) -> DataFrame:
    return ribbon.ribbon_heatmap(c, RIBBON, ["G_k", "G_m", "absent"], "spatial", n_bins=N_BINS)


@query(f", {BINS}, counted AS (SELECT bin, count(*) AS n FROM inbin GROUP BY bin) SELECT bin::INT AS bin, coalesce(n, 0) AS n, (k - 1)::INT AS vertex, round(xs[k], 6) AS x, round(ys[k], 6) AS y FROM quad LEFT JOIN counted USING (bin), range(1, 5) r(k)")
def ribbon_bins(c: CellSet) -> DataFrame:
    bins = ribbon.ribbon_bins(c.cells.sparkSession, RIBBON, N_BINS)
    n = ribbon.cells_in_bins(points(c.coords, "spatial"), bins).groupBy("bin").agg(F.count("*").alias("n"))
    return vertices(bins.join(n, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0))), "bin", "n")


@query(f", {BINS} SELECT gene, bin, cell_count, round(mean, 6) AS mean FROM heat")
def ribbon_heatmap(c: CellSet) -> DataFrame:
    return rounded(heat_of(c), "mean")


@query(f", {BINS} SELECT gene, bin, cell_count, round(mean, 6) AS mean FROM heat WHERE gene = 'G_m' UNION ALL SELECT 'G_0', bin, cell_count, 0 FROM heat WHERE gene = 'G_m'")
def ribbon_silent_gene(c: CellSet) -> DataFrame:
    """A known gene that no cell has is a row of zeros."""
    return rounded(ribbon.ribbon_heatmap(c, RIBBON, ["G_m", tables.SILENT, "absent"], "spatial", n_bins=N_BINS), "mean")


@query(f""", {BINS}, part_of AS (SELECT bin, cell_idx FROM inbin JOIN cells USING (cell_idx) WHERE cell_type IN ('click', 'view'))
SELECT 'G_m' AS gene, bin::INT AS bin, (SELECT count(*) FROM part_of s WHERE s.bin = quad.bin) AS cell_count, round(coalesce((SELECT sum(value::DOUBLE) FROM part_of s JOIN expression e USING (cell_idx) WHERE s.bin = quad.bin AND e.gene = 'G_m') / nullif((SELECT count(*) FROM part_of s WHERE s.bin = quad.bin), 0), 0), 6) AS mean FROM quad""")
def ribbon_of_categories(c: CellSet) -> DataFrame:
    return rounded(ribbon.ribbon_heatmap(c, RIBBON, ["G_m"], "elsewhere", "cell_type", ["click", "view"], N_BINS), "mean")


@query(f", {BINS} SELECT quad.bin::INT AS bin, (SELECT count(*) FROM inbin i WHERE i.bin = quad.bin) AS n, (SELECT count(*) FROM inbin) AS total FROM quad")
def ribbon_totals(c: CellSet) -> DataFrame:
    return ribbon.bin_counts(points(c.coords, "spatial"), ribbon.ribbon_bins(c.cells.sparkSession, RIBBON, N_BINS))


@query(f", {BINS} SELECT gene, bin, cell_count, round(mean, 6) AS mean, round((mean - lo) / (hi - lo), 6) AS t FROM heat, (SELECT min(mean) AS lo, max(mean) AS hi FROM heat)")
def ribbon_scaled(c: CellSet) -> DataFrame:
    return rounded(ribbon.scaled(cut(heat_of(c))), "mean", "t")


@query(f", {BINS} SELECT gene, {', '.join(f'max(CASE WHEN bin = {k} THEN round(mean, 6) END) AS bin_{k}' for k in range(N_BINS))} FROM heat GROUP BY gene")
def ribbon_wide(c: CellSet) -> DataFrame:
    return ribbon.wide(rounded(heat_of(c), "mean")).select("gene", *[F.get("means", F.lit(k)).alias(f"bin_{k}") for k in range(N_BINS)])


# --- clusters and outlines ---

EPS, LEAST, ALPHA = 6.0, 7, 0.125
CLUSTERS = f"""sp AS (SELECT sample, cell_idx, x, y FROM cells JOIN pts USING (cell_idx)),
near AS (SELECT a.sample, a.cell_idx AS a, b.cell_idx AS b FROM sp a JOIN sp b ON a.sample = b.sample AND abs(a.x - b.x) <= {EPS} AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {EPS * EPS}),
core AS (SELECT a AS c FROM near GROUP BY a HAVING count(*) >= {LEAST}),
cc AS (SELECT a, b FROM near WHERE a IN (SELECT c FROM core) AND b IN (SELECT c FROM core)),
walk AS (SELECT a AS id, a AS label FROM cc UNION SELECT cc.b, walk.label FROM walk JOIN cc ON cc.a = walk.id WHERE cc.b > walk.label),
comp AS (SELECT id, min(label) AS root FROM walk GROUP BY id),
num AS (SELECT root, dense_rank() OVER (PARTITION BY sample ORDER BY root) - 1 AS cluster FROM (SELECT DISTINCT root, sample FROM comp JOIN sp ON cell_idx = root)),
of_core AS (SELECT id, cluster FROM comp JOIN num USING (root)),
bord AS (SELECT a, min(cluster) AS cluster FROM near JOIN of_core ON id = b GROUP BY a),
labelled AS (SELECT sample, sp.cell_idx, coalesce(of_core.cluster, bord.cluster, -1)::INT AS cluster, of_core.cluster IS NOT NULL AS core FROM sp LEFT JOIN of_core ON id = sp.cell_idx LEFT JOIN bord ON bord.a = sp.cell_idx)"""


def sample_places(c: CellSet) -> DataFrame:
    return c.cells.select("sample", "cell_idx").join(points(c.coords, "spatial"), "cell_idx").select("sample", "cell_idx", "x", "y")


@query(f", {CLUSTERS} SELECT * FROM labelled", recursive=True)
def dbscan_labels(c: CellSet) -> DataFrame:
    return cluster.density_clusters(sample_places(c), EPS, LEAST)


@query(f", {CLUSTERS} SELECT sample, cluster, count(*) AS n, round(avg(x), 6) AS cx, round(avg(y), 6) AS cy FROM labelled JOIN pts USING (cell_idx) GROUP BY sample, cluster", recursive=True)
def dbscan_summary(c: CellSet) -> DataFrame:
    places = sample_places(c)
    return rounded(cluster.summary(cluster.density_clusters(places, EPS, LEAST), places), "cx", "cy")


def edges_sql(places: str, alpha: float = ALPHA) -> str:
    r = 1 / alpha
    return f"""g AS (SELECT region, x, y, min(cell_idx) AS cell_idx FROM ({places}) GROUP BY region, x, y),
pr AS (SELECT a.region, a.cell_idx AS a, b.cell_idx AS b, a.x AS xa, a.y AS ya, b.x AS xb, b.y AS yb, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS q FROM g a JOIN g b ON a.region = b.region AND a.cell_idx < b.cell_idx AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) < {4 * r * r}),
disc AS (SELECT region, a, b, s, (xa + xb) / 2 - s * sqrt(({r * r} - q / 4) / q) * (yb - ya) AS cx, (ya + yb) / 2 + s * sqrt(({r * r} - q / 4) / q) * (xb - xa) AS cy FROM pr, (VALUES (1), (-1)) t(s)),
empt AS (SELECT region, a, b, s FROM disc WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.region = disc.region AND cell_idx <> a AND cell_idx <> b AND (x - cx) * (x - cx) + (y - cy) * (y - cy) < {(r - 1e-9) ** 2!r})),
ed AS (SELECT region, a, b FROM empt GROUP BY ALL HAVING count(*) = 1)"""


def cluster_members(c: CellSet) -> DataFrame:
    """The members of all clusters, as regions."""
    return cut(cluster.named_members(cluster.density_clusters(sample_places(c), EPS, LEAST), "all", needed=False))


MEMBER_SQL = "SELECT concat_ws('_', sample, cluster, 'all') AS region, cell_idx, x, y FROM labelled JOIN pts USING (cell_idx) WHERE cluster >= 0"


@query(f", {CLUSTERS}, {edges_sql(MEMBER_SQL)} SELECT * FROM ed", recursive=True)
def alpha_edges(c: CellSet) -> DataFrame:
    return outline.alpha_edges(cluster_members(c).join(points(c.coords, "spatial"), "cell_idx"), ALPHA)


#: Of the rings that edges make: how many vertices, how long they are, and the area inside, holes taken off.
RING_SUMS = """, sided AS (SELECT ed.region, s, xa, ya, xb, yb FROM ed JOIN empt USING (region, a, b) JOIN pr USING (region, a, b))
SELECT region, count(*) AS vertices, round(sum(sqrt((xb - xa) * (xb - xa) + (yb - ya) * (yb - ya))), 6) AS perimeter, round(sum(-s * (xa * yb - xb * ya)) / 2, 6) AS area FROM sided GROUP BY region"""


def ring_sums(rings: DataFrame) -> DataFrame:
    """region, vertices, perimeter, area of rings, where those at odd depths are holes."""
    steps = rings.select("region", "ring_no", F.explode(edges(F.col("ring"))).alias("e")).select("region", "ring_no", "e.*")
    dx, dy = F.col("xi") - F.col("xj"), F.col("yi") - F.col("yj")
    each = steps.groupBy("region", "ring_no").agg(F.count("*").alias("n"), F.sum(F.sqrt(dx * dx + dy * dy)).alias("way"), F.abs(F.sum(F.col("xj") * F.col("yi") - F.col("xi") * F.col("yj")) / 2).alias("size"))
    each = each.join(outline.nesting(rings), ["region", "ring_no"])
    area = F.sum(F.when(F.col("depth") % 2 == 0, F.col("size")).otherwise(-F.col("size")))
    return rounded(each.groupBy("region").agg(F.sum("n").alias("vertices"), F.sum("way").alias("perimeter"), area.alias("area")), "perimeter", "area")


@query(f", {CLUSTERS}, {edges_sql(MEMBER_SQL)}{RING_SUMS}", recursive=True)
def outline_rings(c: CellSet) -> DataFrame:
    """Rings of alpha shapes with their holes."""
    found, _ = outline.outlines(cluster_members(c), points(c.coords, "spatial"), ALPHA)
    return ring_sums(found)


WIDER = ALPHA / 2
UMAP_MEMBERS = MEMBER_SQL.replace("JOIN pts", "JOIN umap")


@query(f", {CLUSTERS}, {edges_sql(UMAP_MEMBERS, WIDER)}{RING_SUMS}", recursive=True)
def outlines_recomputed(c: CellSet) -> DataFrame:
    """The outlines of the same clusters in another embedding."""
    found, _ = outline.outlines(cluster_members(c), c.embedding("umap", "region"), WIDER)
    return ring_sums(found)


#: Rings as edges that hang together; those that go about the points, not about a hole, have an area above 0.
EXTERIORS = """, sided AS (SELECT region, a, b, s, xa, ya, xb, yb FROM ed JOIN empt USING (region, a, b) JOIN pr USING (region, a, b)),
steps AS (SELECT region, a, b FROM ed UNION ALL SELECT region, b, a FROM ed),
along AS (SELECT region, a AS id, a AS label FROM steps UNION SELECT steps.region, steps.b, along.label FROM along JOIN steps ON steps.region = along.region AND steps.a = along.id WHERE steps.b > along.label),
part AS (SELECT region, id, min(label) AS root FROM along GROUP BY region, id),
outer_rings AS (SELECT sided.region, root, count(*) AS vertices, sum(sqrt((xb - xa) * (xb - xa) + (yb - ya) * (yb - ya))) AS perimeter, sum(-s * (xa * yb - xb * ya)) / 2 AS area FROM sided JOIN part ON part.region = sided.region AND part.id = a GROUP BY sided.region, root HAVING sum(-s * (xa * yb - xb * ya)) > 0)"""


@query(f""", {CLUSTERS}, {edges_sql(MEMBER_SQL)}{EXTERIORS}, middle AS (SELECT region, avg(x) AS x, avg(y) AS y FROM ({MEMBER_SQL}) GROUP BY region)
SELECT outer_rings.region, sum(vertices)::BIGINT AS vertices, round(sum(perimeter), 6) AS perimeter, round(sum(area), 6) AS area, round(any_value(x), 6) AS centroid_x, round(any_value(y), 6) AS centroid_y FROM outer_rings JOIN middle USING (region) GROUP BY outer_rings.region""", recursive=True)
def outlines_exterior(c: CellSet) -> DataFrame:
    """Outlines made anew in the embedding that the recompute rule gives: exterior rings, with the mean of all members."""
    found, _ = outline.recomputed(cluster_members(c), c.embedding("no such embedding", "recompute"), ALPHA)
    middle = found.groupBy("region").agg(F.first("centroid_x").alias("centroid_x"), F.first("centroid_y").alias("centroid_y"))
    return rounded(ring_sums(found.select("region", "ring_no", "ring")).join(middle, "region"), "centroid_x", "centroid_y")


MOST_SHOWN = 20


@query(f""", {CLUSTERS}, {edges_sql(MEMBER_SQL)}, held AS (SELECT region, cell_idx, x, y, row_number() OVER (PARTITION BY region ORDER BY cell_idx) - 1 AS k, count(*) OVER (PARTITION BY region) AS n FROM ({MEMBER_SQL})),
names AS (SELECT DISTINCT region FROM held UNION ALL SELECT 'u0_9999_all'), kept AS (SELECT region, x, y FROM held WHERE k % greatest(1, n // {MOST_SHOWN}) = 0 AND k < greatest(1, n // {MOST_SHOWN}) * {MOST_SHOWN})
SELECT names.region, CASE WHEN region NOT IN (SELECT region FROM held) THEN 'no members' WHEN region NOT IN (SELECT region FROM ed) THEN 'no outline' ELSE '' END AS reason,
coalesce((SELECT count(*) FROM kept WHERE kept.region = names.region AND region IN (SELECT region FROM ed)), 0) AS n, (SELECT round(avg(x), 6) FROM kept WHERE kept.region = names.region AND region IN (SELECT region FROM ed)) AS centroid_x FROM names""", recursive=True)
def outlined_clusters(c: CellSet) -> DataFrame:
    """Outlined clusters with the members shown and their mean, and the names that failed with reasons."""
    members = cluster_members(c)
    wanted = members.select("region").distinct().unionAll(c.cells.limit(1).select(F.lit("u0_9999_all")))
    found = outline.outlined_regions(members, points(c.coords, "spatial"), ALPHA, MOST_SHOWN, wanted)
    named = wanted.join(found["failures"], "region", "left").join(found["regions"], "region", "left")
    return named.select("region", F.coalesce("reason", F.lit("")).alias("reason"), F.coalesce("n", F.lit(0)).alias("n"), F.round("centroid_x", 6).alias("centroid_x"))


@query(f""", {CLUSTERS}, old AS (SELECT 'u1_0_all' AS region, cell_idx FROM cells WHERE cell_type = 'error' UNION ALL SELECT 'kept_from_before', cell_idx FROM cells WHERE cell_type = 'view'), new AS (SELECT region, cell_idx FROM ({MEMBER_SQL}))
SELECT region, count(*) AS n, row_number() OVER (ORDER BY region)::INT AS place FROM (SELECT * FROM new UNION ALL SELECT * FROM old WHERE region NOT IN (SELECT region FROM new)) GROUP BY region""", recursive=True)
def clusters_appended(c: CellSet) -> DataFrame:
    """Clusters added to those of an earlier run: the same name replaces, others stay; then all in order of their names."""
    old = c.cells.where("cell_type = 'error'").select(F.lit("u1_0_all").alias("region"), "cell_idx").unionAll(c.cells.where("cell_type = 'view'").select(F.lit("kept_from_before"), "cell_idx"))
    named = cluster.cluster_names(regions.upsert(old, cluster_members(c)))
    return named.withColumn("place", F.row_number().over(Window.orderBy("region")))  # a row for each cluster


@query(f""", {CLUSTERS}, m AS (SELECT DISTINCT region, x, y, min(cell_idx) OVER (PARTITION BY region, x, y) AS cell_idx FROM ({MEMBER_SQL})),
pq AS (SELECT p.region, p.cell_idx AS p, q.cell_idx AS q FROM m p JOIN m q ON p.region = q.region AND p.cell_idx <> q.cell_idx
  WHERE NOT EXISTS (SELECT 1 FROM m r WHERE r.region = p.region AND r.cell_idx NOT IN (p.cell_idx, q.cell_idx) AND ((q.x - p.x) * (r.y - p.y) - (q.y - p.y) * (r.x - p.x) < 0
    OR ((q.x - p.x) * (r.y - p.y) - (q.y - p.y) * (r.x - p.x) = 0 AND NOT ((r.x BETWEEN least(p.x, q.x) AND greatest(p.x, q.x)) AND (r.y BETWEEN least(p.y, q.y) AND greatest(p.y, q.y)))))))
SELECT DISTINCT region, p AS cell_idx FROM pq""", recursive=True)
def hull_vertices(c: CellSet) -> DataFrame:
    found = outline.hull(cluster_members(c).join(points(c.coords, "spatial"), "cell_idx").select("region", "cell_idx", "x", "y"))
    return found.select("region", "cell_idx")


