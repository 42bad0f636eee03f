"""Frozen corpora, one folder a schema version, and how they read then and now."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .records import read_tree

#: Names of a version's folder and of its readings.
FOLDER, READINGS = re.compile(r"schema-(.*)"), "readings"


def versions(root: str, below: str = "frozen") -> list[int]:
    """The frozen schema versions, in order; none without the folder. A folder that names no version is an error."""
    top, out = os.path.join(root, below), []
    if not os.path.isdir(top):
        return []
    for name in os.listdir(top):
        found = FOLDER.fullmatch(name)
        if found and os.path.isdir(os.path.join(top, name)):
            if not found[1].isdigit():
                raise ValueError(f"{below}/{name} names no schema version")
            out.append(int(found[1]))
    return sorted(out)


def frozen_files(spark: SparkSession, root: str, below: str = "frozen") -> DataFrame:
    """``version, path, text`` of all frozen records; ``path`` is where the record claims to be.

    A version without any file proves nothing, which is an error.
    """
    files = read_tree(spark, root, below).where("path like '%.toml'")
    at = rf"^{re.escape(below)}/schema-([0-9]+)/(.*)$"
    rows = files.where(F.col("path").rlike(at)).select(F.regexp_extract("path", at, 1).cast("int").alias("version"), F.concat(F.lit("record/"), F.regexp_extract("path", at, 2)).alias("path"), "text")
    held = {r.version for r in rows.select("version").distinct().collect()}  # few versions
    empty = [v for v in versions(root, below) if v not in held]
    if empty:
        raise ValueError(f"no file is frozen at schema version {empty[0]}")
    return rows


def read_readings(spark: SparkSession, root: str, below: str = "frozen") -> DataFrame:
    """``version, file, reading`` as frozen beside each version's files; a version without readings is an error."""
    held, out = versions(root, below), spark.createDataFrame([], "version int, file string, reading string")
    for v in held:
        path = os.path.join(root, below, f"schema-{v}", READINGS)
        if not os.path.isdir(path):
            raise FileNotFoundError(f"the corpus frozen at schema version {v} has no readings")
        out = out.unionByName(spark.read.schema("file string, reading string").json(path).withColumn("version", F.lit(v)))
    return out


def write_readings(readings: DataFrame, root: str, below: str = "frozen") -> None:
    """Freeze ``version, file, reading`` beside each version's files."""
    readings = readings.cache()
    for v in versions(root, below):
        own = readings.where(F.col("version") == v).select("file", "reading")
        own.orderBy("file").write.mode("overwrite").json(os.path.join(root, below, f"schema-{v}", READINGS))
    readings.unpersist()
