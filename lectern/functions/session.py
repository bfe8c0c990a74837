"""Cutting lineage in the shared checkpoint folder, and spreading small inputs."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def settled(df: DataFrame) -> DataFrame:
    """The frame as a checkpoint below the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a local session gets one of its own; on a cluster it is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='lectern-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def spread(df: DataFrame) -> DataFrame:
    """The frame over all cores where its files make fewer tasks than that; a larger input stays as it is read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
