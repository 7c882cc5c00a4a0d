import pytest
from pyspark.sql import functions as F

from cellweave.operators import page
from cellweave.sources import sinks
from cellweave.sources.cells import CellSet, attribute, attributes, chunk_count, embedding_keys, embeddings, layout_key, mask_sets, points, resolve, saved_layouts


def ids(df):
    return [r.cell_idx for r in df.orderBy("cell_idx").collect()]


def test_chunk_page_keeps_cells_and_places_together(spark, cells, coords):
    expression = spark.createDataFrame([(2, "G", 7.0)], "cell_idx long, gene string, value float")
    rows = page.chunk_page(cells, coords, ["spatial", "X_layout"], 1, expression, "G").orderBy("cell_idx").collect()
    assert [(r.cell_idx, r.spatial_x, r.X_layout_x, r.expression) for r in rows] == [(2, 0.5, 50.5, 7.0), (3, 2.0, 52.0, 0.0), (4, 10.0, 60.0, 0.0)]
    with pytest.raises(ValueError):
        page.chunk_page(cells.drop("chunk"), coords, ["spatial"], 1)
    with pytest.raises(ValueError):
        page.chunk_page(cells, coords, ["spatial"], 7)


def test_viewport(cells, coords, places):
    assert ids(page.viewport_page(cells, coords, "spatial", (-5, 5, -5, 5), ["spatial"])) == [2, 3, 5, 6, 8]
    assert ids(page.viewport(places, (-5, 5, -1000, 1000))) == ids(page.viewport(places, (-5, 5, -1, 1)))  # the height has no part
    for box in ((5, 5, 0, 1), (6, 5, 0, 1), (None, 1, 0, 1)):
        with pytest.raises(ValueError):
            page.viewport(places, box)


def test_samples_are_seeded_and_prefer_the_centre(spark):
    many = spark.range(4000).select(F.col("id").alias("cell_idx"), (F.col("id") / 4000.0).alias("d"), F.lit(0).alias("chunk"))
    some = page.viewport_sample(many, 1.0, 500)
    assert some.count() == 500 and ids(some) == ids(page.viewport_sample(many.repartition(7), 1.0, 500))
    assert some.agg(F.avg("d")).first()[0] < 0.42
    assert page.viewport_sample(many, 1.0, 9000).count() == 4000
    assert len(ids(page.overview_sample(many, 100))) == 100


def test_loading_order(spark):
    cells = spark.createDataFrame([(i, c) for i, c in enumerate([1, 0, 1, 0, 2])], "cell_idx long, chunk int")
    assert [r.cell_idx for r in page.loading_order(cells).collect()] == [1, 3, 0, 2, 4]
    assert [r.cell_idx for r in page.loading_order(cells.drop("chunk")).collect()] == [0, 1, 2, 3, 4]


def test_bounds(coords):
    row = page.bounds(coords).where("key = 'spatial'").first()
    assert (row.min_x, row.max_x, row.min_y, row.max_y, row.n) == (-4, 10, -4, 10, 10)


def test_chunks(spark, cells, coords):
    assert [chunk_count(n, 250) for n in (0, 1, 250, 251, 10**6)] == [1, 1, 1, 2, 50]
    held = CellSet(cells.drop("chunk"), coords, spark.createDataFrame([], "cell_idx long, gene string, value float"), spark.createDataFrame([], "gene_idx int, gene string"))
    again = held.with_chunks(4)
    assert {r.chunk for r in again.cells.collect()} <= {0, 1, 2}
    fixed = CellSet(cells, coords, held.expression, held.genes)
    assert fixed.with_chunks(4).cells is cells  # three chunks already


def test_catalog(spark, cells, coords):
    assert attributes(cells.withColumn("__own", F.lit(1))) == {"sample": "categorical", "cell_type": "categorical", "score": "numeric", "condition": "categorical"}
    assert attribute(cells, " score ") == "score"
    with pytest.raises(ValueError, match="cell_type"):
        attribute(cells, "nothing")
    more = coords.unionAll(coords.where("key = 'spatial'").withColumn("key", F.lit("X_umap")))
    assert embedding_keys(more) == ["spatial", "X_umap", "X_layout"]
    assert embeddings(more) == {"X_umap": "umap", "spatial": "spatial"} and saved_layouts(more) == ["X_layout"] and saved_layouts(more, ("X_layout",)) == []
    sets = spark.createDataFrame([("my_old_masks", "r"), ("my_old_masks", "q")], "mask_set string, region string")
    assert [tuple(r) for r in mask_sets(sets).collect()] == [("my_old_masks", "My Old Masks")]


def test_resolve():
    keys = ["X_layout", "X_umap", "spatial"]
    assert resolve(keys, "umap", "region") == "X_umap" and resolve(keys, "umap", "ribbon") == "spatial" and resolve(keys, "tsne", "recompute") == "spatial"
    assert resolve(["X_pca"], "x", "ribbon") == "X_pca" and resolve(["X_other"], "x", "recompute") == "X_other"
    with pytest.raises(ValueError):
        resolve(["X_pca"], "x", "region")
    assert layout_key("a") == layout_key("X_a") == "X_a"
    with pytest.raises(ValueError):
        layout_key(" ")


def test_open_and_export(spark, cells, coords, tmp_path):
    path = f"file://{tmp_path}"
    cells.write.parquet(f"{path}/set/cells")
    coords.write.partitionBy("key").parquet(f"{path}/set/coords")
    spark.createDataFrame([(0, "G", 1.0)], "cell_idx long, gene string, value float").write.parquet(f"{path}/set/expression")
    spark.createDataFrame([(0, "G")], "gene_idx int, gene string").write.parquet(f"{path}/set/genes")
    held = CellSet.open(spark, f"{path}/set")
    assert held.embedding("layout").where("cell_idx = 4").first().x == 60
    assert held.with_sample("condition").sample == "condition"
    with pytest.raises(ValueError):
        held.with_sample("nothing")
    sinks.export_pages(page.page(held.cells, held.coords, ["spatial"]), f"{path}/pages")
    for chunk in (0, 1, 2):
        rows = spark.read.parquet(f"{path}/pages/chunk={chunk}").collect()
        assert [r.cell_idx for r in rows] == ids(cells.where(F.col("chunk") == chunk)) and all(r.spatial_x is not None for r in rows)
    sinks.save_palette(held.cells, f"{path}/palettes", "cell_type", ["A", "B"], ["#1", "#2"])
    sinks.save_palette(held.cells, f"{path}/palettes", "condition", ["ctrl"], ["#3"])
    sinks.save_palette(held.cells, f"{path}/palettes", "cell_type", ["A", "B"], ["#8", "#9"])
    assert sorted((r.column, r.color) for r in spark.read.parquet(f"{path}/palettes").collect()) == [("cell_type", "#8"), ("cell_type", "#9"), ("condition", "#3")]
    with pytest.raises(ValueError):
        sinks.save_palette(held.cells, f"{path}/palettes", "cell_type", [], [])
    with pytest.raises(ValueError):
        sinks.save_palette(held.cells, f"{path}/palettes", "x", ["A"], ["#1"])
    sinks.save_layout(points(coords, "X_layout"), f"{path}/layouts", "mine", cells)
    with pytest.raises(ValueError):
        sinks.save_layout(points(coords, "X_layout").limit(3), f"{path}/layouts", "mine", cells)
    sinks.delete_layout(spark, f"{path}/layouts", "mine")
    with pytest.raises(ValueError):
        sinks.delete_layout(spark, f"{path}/layouts", "mine")
