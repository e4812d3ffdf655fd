"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or in local mode a folder of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not getattr(spark, "_tidemark_folder", None):
        spark._tidemark_folder = tempfile.mkdtemp(prefix="spark-")
    return spark._tidemark_folder


def checkpoints(spark: SparkSession) -> None:
    """Let checkpoint() write into the shared folder."""
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
