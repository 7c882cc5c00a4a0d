"""Every registered query with SQL against DuckDB, over the small tables."""

import math
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession

import __spark_entry__

ROOT = Path("/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark-queries")
    session = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(f"file://{root}/shared")
    return session


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in ROOT.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    return repr(round(float(value), 9) + 0.0) if isinstance(value, float) else str(value)


def rows_of(frame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted(tuple(map(plain, r)) for r in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_query(spark, duck, name):
    assert rows_of(__spark_entry__.queries()[name](spark, str(ROOT)).toPandas()) == rows_of(duck.execute(__spark_entry__.oracle_sql()[name]).df())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
