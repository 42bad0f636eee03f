"""What the repository's own checks read: coverage profiles, refusal sites, tags, the index, headings, imports, TOML files."""

from __future__ import annotations

import itertools
import os
import re
import subprocess
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .records import listing

#: Each release stream's heading in the changelog with the prefix of its tags, and where coming changes stand.
STREAMS = {"# The tool": "v", "# The corpus": "corpus-v"}
UNRELEASED = "## Unreleased"

_line = r"^(.+):(\d+)\.\d+,(\d+)\.\d+ (\d+) (\d+)$"


def coverage_profile(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, end, statements, count`` of a profile: a mode line, then one line a block.

    A line of another form is an error, and so is a profile in which nothing was executed:
    that is a broken measurement.
    """
    lines = spark.read.text(path).where("trim(value) <> '' and value not like 'mode:%'")
    part = lambda i: F.regexp_extract("value", _line, i)
    sound = F.when(F.col("value").rlike(_line), F.col("value")).otherwise(F.raise_error(F.concat(F.lit("no line of a coverage profile: "), F.col("value"))))
    rows = lines.select(sound.alias("value")).select(part(1).alias("file"), *[part(i).cast("int").alias(n) for i, n in ((2, "start"), (3, "end"), (4, "statements"), (5, "count"))])
    if rows.where("count > 0").isEmpty():
        raise ValueError("the coverage profile has no executed block")
    return rows


def tags(spark: SparkSession, root: str) -> DataFrame:
    """``tag`` of each tag of the repository; where they can't be listed they are unknown, which is an error."""
    run = subprocess.run(["git", "-C", root, "tag", "--list"], capture_output=True, text=True, check=False)
    if run.returncode:
        raise ValueError("the tags can't be listed: " + run.stderr.strip())
    return spark.createDataFrame([(t,) for t in run.stdout.split()], "tag string")


def released_versions(tags: DataFrame, prefix: str) -> DataFrame:
    """``version`` of each tag that is ``prefix`` and three numbers."""
    version = F.substring("tag", len(prefix) + 1, 1 << 20)
    return tags.where(F.col("tag").startswith(prefix)).select(version.alias("version")).where(F.col("version").rlike(r"^[0-9]+\.[0-9]+\.[0-9]+$")).distinct()


def changelog_versions(spark: SparkSession, path: str, heading: str, streams: Iterable[str] = STREAMS) -> DataFrame:
    """``version`` of each entry (``## 1.2.3``) of the release stream under the line ``heading``, up to the next stream's.

    A changelog that can't be read, lacks the stream, or whose stream has no section for
    what is not released yet is an error: there would be nowhere to write a change down.
    """
    with open(path, encoding="utf-8", newline=None) as f:
        lines = f.read().split("\n")
    if heading not in lines:
        raise ValueError(f"{path} has no heading {heading!r}")
    own = lines[lines.index(heading) + 1 :]
    own = list(itertools.takewhile(lambda line: line not in streams or line == heading, own))
    if not any(line.startswith(UNRELEASED) for line in own):
        raise ValueError(f"{path} has no {UNRELEASED!r} under {heading!r}")
    found = {m[1] for m in map(re.compile(r"## ([0-9]+\.[0-9]+\.[0-9]+)\b").match, own) if m}
    return spark.createDataFrame([(v,) for v in sorted(found)], "version string")


def tracked(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """``path`` of each file at or below ``paths`` that is in the repository's index; an index that can't be read is an error."""
    run = subprocess.run(["git", "-C", root, "ls-files", "-z", "--", *paths], capture_output=True, text=True, check=False)
    if run.returncode:
        raise ValueError("the index can't be read: " + run.stderr.strip())
    return spark.createDataFrame([(p,) for p in run.stdout.split("\0") if p], "path string")


def refusal_sites(spark: SparkSession, path: str) -> DataFrame:
    """``file, line, site`` of a listing of the places that can refuse, one JSON object a line; a line without one of them is an error."""
    rows = spark.read.schema("file string, line int, site string").json(path)
    whole = F.col("file").isNotNull() & F.col("line").isNotNull() & F.col("site").isNotNull()
    return rows.select(F.when(whole, F.col("file")).otherwise(F.raise_error(F.lit("a refusal site without file, line or name"))).alias("file"), "line", "site")


def import_edges(spark: SparkSession, path: str) -> DataFrame:
    """``src, dst`` of a listing of packages, one JSON object a line with ``ImportPath`` and ``Imports``."""
    rows = spark.read.schema("ImportPath string, Imports array<string>").json(path)
    return rows.select(F.col("ImportPath").alias("src"), F.explode("Imports").alias("dst")).distinct()


def toml_inventory(spark: SparkSession, root: str) -> DataFrame:
    """``path, text`` of all TOML files of a tree, in any case of the ending, records among them, but those in folders that begin with a dot."""
    found = [os.path.normpath(p).replace(os.sep, "/") for p in listing(root, ".") if p.lower().endswith(".toml")]
    found = [p for p in found if not any(part.startswith(".") for part in p.split("/")[:-1])]
    files = spark.createDataFrame([(p,) for p in found], "path string").repartition(max(1, min(len(found) // 1000 + 1, 4096)))

    def read(batches):
        for batch in batches:
            texts = []
            for p in batch["path"]:
                with open(os.path.join(root, p), "rb") as f:
                    texts.append(f.read())
            yield batch.assign(text=texts)

    return files.mapInPandas(read, "path string, text binary")
