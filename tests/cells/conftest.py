import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark-cells")
    builder = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
    session = builder.config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", str(root / "warehouse")).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(f"file://{root}/shared")
    return session


SPATIAL = [(0, 0), (1, 1), (0.5, 0.5), (2, 2), (10, 10), (-1, -1), (3, 4), (4, 4), (0, 3), (-4, -4)]


@pytest.fixture(scope="session")
def places(spark):
    """Ten cells."""
    return spark.createDataFrame([(i, float(x), float(y), None) for i, (x, y) in enumerate(SPATIAL)], "cell_idx long, x double, y double, z double")


@pytest.fixture(scope="session")
def coords(spark):
    rows = [("spatial", i, float(x), float(y), None) for i, (x, y) in enumerate(SPATIAL)] + [("X_layout", i, x + 50.0, y - 20.0, float(i)) for i, (x, y) in enumerate(SPATIAL)]
    return spark.createDataFrame(rows, "key string, cell_idx long, x float, y float, z float")


@pytest.fixture(scope="session")
def cells(spark):
    kinds, chunks = "A B A A B B A B A B".split(), [0, 0, 1, 1, 1, 2, 2, 2, 2, 2]
    rows = [(i, f"s{1 + i // 5}", kinds[i], float(i), "ctrl" if i < 5 else "treated", chunks[i]) for i in range(10)]
    return spark.createDataFrame(rows, "cell_idx long, sample string, cell_type string, score double, condition string, chunk int")


@pytest.fixture(scope="session")
def square():
    return [(-2.5, -2.5), (2.5, -2.5), (2.5, 2.5), (-2.5, 2.5)]
