"""Reading plain tables, and writing intermediate ones."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def working_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which driver and executors share.

    Where a session on one machine has none a local folder is set; on a cluster that is
    an error, as executors would write to disks of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """A written copy of ``df`` in the working folder."""
    spark = df.sparkSession
    path = f"{working_folder(spark)}/series-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
