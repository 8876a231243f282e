"""Cutting lineage, for iterations: what follows neither plans nor computes the rounds before again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which driver and executors share. Where it is unset, a temporary folder in
    local mode (tests) and an error on a cluster."""
    if at := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp())
    return spark.sparkContext.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, so that a lost executor costs no round; unlike a checkpoint it is computed once, its
    size is known to joins, and it is deleted when the driver ends."""
    path = scratch(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder; it is deleted when the driver ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return path.toString()
