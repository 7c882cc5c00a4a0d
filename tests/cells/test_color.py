import pytest
from pyspark.sql import functions as F

from cellweave.functions.values import clean_expression
from cellweave.operators import color


def codes(df, column="code"):
    return [r[column] for r in df.orderBy("cell_idx").collect()]


@pytest.fixture(scope="module")
def few(spark):
    return spark.createDataFrame([(0, "A", 0.0), (1, "B", 5.0), (2, "A", 10.0), (3, "C", 5.0)], "cell_idx long, ct string, score double")


@pytest.fixture(scope="module")
def gene(spark):
    return spark.createDataFrame([(1, "G", 1.0), (2, "G", 2.0), (3, "G", 4.0), (1, "H", 2.0), (9, "Z", float("nan"))], "cell_idx long, gene string, value float")


def test_numeric_codes(spark, few):
    assert codes(color.numeric_codes(few, "score")) == [1, 128, 255, 128]
    assert codes(color.numeric_codes(few.withColumn("score", F.lit(3.0)), "score")) == [0, 0, 0, 0]
    assert codes(color.numeric_codes(few.withColumn("flag", F.col("ct") == "A").withColumn("flag", F.col("flag").cast("int")), "flag")) == [255, 1, 255, 1]
    odd = spark.createDataFrame([(0, float("nan")), (1, None), (2, -4.0), (3, 4.0)], "cell_idx long, v double")
    assert codes(color.numeric_codes(odd, "v")) == [128, 128, 1, 255]


def test_category_codes(spark, few):
    assert codes(color.category_codes(few, "ct")) == [1, 2, 1, 3]
    assert codes(color.category_codes(few, "ct", ["C", "B", "A"])) == [3, 2, 3, 1]
    assert codes(color.category_codes(few, "ct", code_base=0)) == [0, 1, 0, 2]
    gaps = spark.createDataFrame([(i, None if i == 1 else f"k{i}") for i in range(300)], "cell_idx long, ct string")
    found = color.category_codes(gaps, "ct")
    assert codes(found)[:4] == [1, 0, 2, 3] and max(codes(found)) == 299 and max(codes(found, "display_code")) == 255


def test_palette_needs_a_colour_for_each_category(spark, few):
    known = color.dictionary(few, "ct")
    palette = lambda n: spark.createDataFrame([(i + 1, f"#{i}") for i in range(n)], "cat_code int, color string")
    assert [r.color for r in color.palette_of(known, palette(5)).orderBy("code").collect()] == ["#0", "#1", "#2"]
    assert [r.color for r in color.palette_of(known, palette(2)).orderBy("code").collect()] == [None] * 3


def test_gene_codes(few, gene):
    found = color.gene_codes(few, gene, "G")
    assert codes(found) == [0, 64, 128, 255] and found.first().vmax == 4.0
    assert codes(color.gene_codes(few, gene, "absent")) == [0, 0, 0, 0]


def test_clean(spark):
    values = [1.5, float("nan"), float("inf"), float("-inf"), -2.0, None, 0.0]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v float").select("i", clean_expression(F.col("v")).alias("v")).orderBy("i").collect()
    assert [r.v for r in rows] == [1.5, 0, 0, 0, 0, 0, 0]


def test_group_is_a_geometric_mean(few, gene):
    genes = few.sparkSession.createDataFrame([(0, "G"), (1, "H"), (2, "Z")], "gene_idx int, gene string")
    rows = color.group_codes(few, gene, ["G", "H", "absent"], genes).orderBy("cell_idx").collect()
    assert rows[0].v == 0 and rows[0].code == 0
    assert abs(rows[1].v - 2**0.5) < 1e-6 and rows[1].code == 255
    assert abs(rows[3].v - (4e-9) ** 0.5) < 1e-6 and rows[3].code == 1
    with pytest.raises(ValueError):
        color.group_codes(few, gene, ["absent"], genes)


def test_similar_genes(spark):
    genes = spark.createDataFrame([(i, g) for i, g in enumerate(["abC", "Bc", "xx", "BCD"] + [f"bc{i}" for i in range(20)])], "gene_idx int, gene string")
    assert [r.gene for r in color.similar_genes(genes, " bc ").collect()] == ["abC", "Bc", "BCD", "bc0", "bc1", "bc2", "bc3", "bc4"]
    assert {r.gene: r.known for r in color.known_genes(genes, ["Bc", "no"]).collect()} == {"Bc": True, "no": False}


def test_display(few, gene, spark):
    coded = color.gene_codes(few, gene, "G")
    t = [r.t for r in color.display_range(coded, 4.0, 1.0, 3.0).orderBy("cell_idx").collect()]
    assert t[0] == 0 and abs(t[2] - (128 / 255 * 4 - 1) / 2) < 1e-12 and t[3] == 1
    shown = color.visible(few, "ct", spark.createDataFrame([("A", False), ("B", True)], "category string, enabled boolean"))
    assert [r.visible for r in shown.orderBy("cell_idx").collect()] == [False, True, False, True]
    z = color.normalised_z(few.select("cell_idx", F.col("score").alias("z")))
    assert [r.z for r in z.orderBy("cell_idx").collect()] == [-1, 0, 1, 0]
    assert codes(color.depth(few, z=z, shown=shown), "depth") == [-1, 0, -1, 0]
    assert codes(color.depth(few, shown=shown), "depth") == [-1, 1, -1, 1]
    assert codes(color.depth(few, codes=color.category_codes(few, "ct"), n_codes=3), "depth") == [0, 0.5, 0, 1]
    assert codes(color.depth(few, codes=color.category_codes(few, "ct"), n_codes=1), "depth") == [0] * 4
