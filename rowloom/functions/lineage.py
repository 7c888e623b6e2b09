"""Reliable checkpoints and scratch space in the folder the cluster names."""

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints, which the session must name: local folders of one machine are lost with it."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if folder:
        if not context.getCheckpointDir():
            context.setCheckpointDir(folder)
        return folder
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise in the shared folder, so that lost executors do not replay the past."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def forget(spark: SparkSession) -> None:
    """Lets Spark drop shuffle files and checkpoints of tables that nobody refers to any more; else they stay until the driver's heap is full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def rows_within(df: DataFrame, limit: int) -> bool:
    """True when the table has at most `limit` rows; reads no further than it must."""
    return df.limit(limit + 1).count() <= limit
