import pytest
from pyspark.sql import SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long, piece string, text_ string"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    builder = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
    session = builder.config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", str(root / "warehouse")).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(f"file://{root}/shared")
    return session


@pytest.fixture(scope="session")
def make(spark):
    """Documents from texts, with columns beyond those that operators need."""

    def build(texts, ids=None, langs=None, sources=None):
        rows = [((ids or range(len(texts)))[i], t, (langs or ["en"] * len(texts))[i], (sources or ["a"] * len(texts))[i], None, "x", None) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS)

    return build


#: Nulls, empty and odd texts, ties and copies.
ODD = [None, "", "  ", "a", "a", "the the the", "<|endoftext|> x <|startoftext|>", "café CAFÉ 日本語 　 x", "\x1c\x1da\x85b\xa0c", "tab\tx\t\ty \n z  ", "word " * 3000, "it's I'LL don't 12 ½ \U0001f44d", "İstanbul <|ENDOFTEXT|>", "a  b\n \nc", "Line one here\nLine one here\n", "̀x"]


@pytest.fixture(scope="session")
def odd():
    return list(ODD)


@pytest.fixture(scope="session")
def real(spark):
    """All documents of the smallest table, as pandas."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").toPandas()
