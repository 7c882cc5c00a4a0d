"""Events and embeddings seen as cells, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions.values import chunk_of
from cellweave.sources.cells import CellSet, chunk_count

CHUNK_SIZE = 2500
GENES = ("G_k", "G_v", "G_m")
#: Known, but no cell has it.
SILENT = "G_0"


def event_cells(spark: SparkSession, sf_dir: str) -> CellSet:
    """Events as cells: users give samples, event types categories, value and time of day places."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    user = F.col("user_id") % 12
    cells = events.select(
        F.col("event_id").alias("cell_idx"),
        F.concat(F.lit("u"), user.cast("string")).alias("sample"),
        F.col("event_type").alias("cell_type"),
        F.col("value").alias("score"),
        F.concat(F.lit("c"), (user % 3).cast("string")).alias("condition"),
        F.concat(F.lit("b"), (user % 2).cast("string")).alias("batch"),
        (user * 7 % 5).cast("int").alias("order_no"),
        chunk_of(F.col("event_id"), chunk_count(events.count(), CHUNK_SIZE)).alias("chunk"),
    )
    second = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts").cast("int")
    one = lambda c: c.cast("float")
    spatial = events.select(F.lit("spatial").alias("key"), F.col("event_id").alias("cell_idx"), one(F.col("value")).alias("x"), one(second / 240.0).alias("y"), one(F.lit(None)).alias("z"))
    umap = events.select(F.lit("X_umap").alias("key"), F.col("event_id").alias("cell_idx"), one(F.col("user_id")).alias("x"), one(F.col("value")).alias("y"), one(F.hour("ts")).alias("z"))
    values = F.array(*[F.struct(F.lit(g).alias("gene"), one(v).alias("value")) for g, v in zip(GENES, (F.get_json_object("props", "$.k"), F.col("value"), F.minute("ts")), strict=True)])
    expression = events.select(F.col("event_id").alias("cell_idx"), F.inline(values)).where("value != 0")
    return CellSet(cells, spatial.unionAll(umap), expression, gene_table(spark, (*GENES, SILENT)))


def gene_table(spark: SparkSession, genes: tuple[str, ...]) -> DataFrame:
    return spark.createDataFrame([(i, g) for i, g in enumerate(genes)], "gene_idx int, gene string")


def vector_cells(spark: SparkSession, sf_dir: str) -> CellSet:
    """Embedding vectors as cells: the first dimensions are places, the others genes with positive values only."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    cells = vectors.select(F.col("vec_id").alias("cell_idx"), F.concat(F.lit("s"), (F.col("vec_id") % 5).cast("string")).alias("sample"), F.col("label").cast("string").alias("cell_type"))
    v = lambda i: F.col("embedding")[i].cast("float")
    spatial = vectors.select(F.lit("spatial").alias("key"), F.col("vec_id").alias("cell_idx"), (v(0) * F.lit(100.0).cast("float")).alias("x"), (v(1) * F.lit(100.0).cast("float")).alias("y"), F.lit(None).cast("float").alias("z"))
    pca = vectors.select(F.lit("X_pca").alias("key"), F.col("vec_id").alias("cell_idx"), v(2).alias("x"), v(3).alias("y"), v(4).alias("z"))
    expression = vectors.select(F.col("vec_id").alias("cell_idx"), F.posexplode("embedding").alias("i", "value")).where("i >= 5 and value > 0")
    expression = expression.select("cell_idx", F.concat(F.lit("g"), F.col("i").cast("string")).alias("gene"), F.col("value").cast("float").alias("value"))
    return CellSet(cells, spatial.unionAll(pca), expression, gene_table(spark, tuple(f"g{i}" for i in range(5, 64))))


def sql_unit(seed: object, key: str) -> str:
    return f"((('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT + 0.5) / 4294967296.0)"


SQL = f"""cells AS (SELECT event_id AS cell_idx, 'u' || (user_id % 12) AS sample, event_type AS cell_type, value AS score, 'c' || (user_id % 12 % 3) AS condition,
  'b' || (user_id % 12 % 2) AS batch, (user_id % 12 * 7 % 5)::INT AS order_no,
  (('0x' || substr(md5('42:' || event_id), 1, 8))::BIGINT % (SELECT least(50, greatest(1, ceil(count(*) / {CHUNK_SIZE}.0)))::BIGINT FROM events))::INT AS chunk FROM events),
coords AS (SELECT 'spatial' AS key, event_id AS cell_idx, value::FLOAT AS x, ((hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / 240.0)::FLOAT AS y, NULL::FLOAT AS z FROM events
  UNION ALL SELECT 'X_umap', event_id, user_id::FLOAT, value::FLOAT, hour(ts)::FLOAT FROM events),
pts AS (SELECT cell_idx, x::DOUBLE AS x, y::DOUBLE AS y FROM coords WHERE key = 'spatial'),
umap AS (SELECT cell_idx, x::DOUBLE AS x, y::DOUBLE AS y, z::DOUBLE AS z FROM coords WHERE key = 'X_umap'),
expression AS (SELECT * FROM (SELECT event_id AS cell_idx, 'G_k' AS gene, json_extract_string(props, '$.k')::FLOAT AS value FROM events
  UNION ALL SELECT event_id, 'G_v', value::FLOAT FROM events UNION ALL SELECT event_id, 'G_m', minute(ts)::FLOAT FROM events) WHERE value <> 0),
stats AS (SELECT sample, avg(x) AS cx, avg(y) AS cy, max(x) - min(x) AS w, max(y) - min(y) AS h, count(*) AS n, row_number() OVER (ORDER BY min(cell_idx)) - 1 AS ordinal FROM cells JOIN pts USING (cell_idx) GROUP BY sample)"""
