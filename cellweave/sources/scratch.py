"""Tables between the steps of a job, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a new local folder if all runs in one process, else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="cellweave-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """df, written to the shared folder and read again; later steps don't depend on what it was made from."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
