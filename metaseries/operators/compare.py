"""Comparisons of two states: full-outer differences, digests, reach, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaseries.sources.tables import materialise


def differences(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key, change`` of what was added, removed or changed between two states."""
    mark = lambda d, side: d.select(F.col(key).alias(key), F.struct(*fields).alias(side), F.lit(True).alias(f"in_{side}"))
    both = mark(old, "old").join(mark(new, "new"), key, "full_outer")
    change = (
        F.when(F.col("in_old").isNull(), "added").when(F.col("in_new").isNull(), "removed").when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    )
    return both.select(key, change.alias("change")).where("change is not null")


def version_bump(changes: DataFrame) -> DataFrame:
    """MAJOR if any value changed or went, MINOR if any was added, else PATCH: one row."""
    rank = F.coalesce(F.max(F.when(F.col("change").isin("changed", "removed"), 2).when(F.col("change") == "added", 1).otherwise(0)), F.lit(0))
    return changes.agg(rank.alias("r")).select(F.element_at(F.array(F.lit("PATCH"), F.lit("MINOR"), F.lit("MAJOR")), F.col("r") + 1).alias("bump"))


def ordered_digest(records: DataFrame, by: list[str], path: str, fields: str) -> DataFrame:
    """SHA-256 over path and fields of each key's records, in path order."""
    line = F.concat(F.col(path), F.lit("\n"), F.col(fields), F.lit("\n"))
    return records.groupBy(*by).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), ""), 256).alias("digest"))


def not_in_intervals(sites: DataFrame, blocks: DataFrame, file: str = "file", line: str = "line") -> DataFrame:
    """Sites that no block of the same file covers."""
    b = blocks.select(F.col("file").alias("_f"), F.col("start").alias("_s"), F.col("end").alias("_e"))
    return sites.join(b, (F.col(file) == F.col("_f")) & F.col(line).between(F.col("_s"), F.col("_e")), "left_anti")


def reach(edges: DataFrame) -> DataFrame:
    """``src, dst`` of each pair joined by a path of ``edges (src, dst)``.

    Each round adds the pairs one edge longer that were not met before, and writes them
    out, until there are none; so paths may be of any length and go in circles.
    """
    links = materialise(edges.select("src", "dst").distinct())
    step = links.select(F.col("src").alias("dst"), F.col("dst").alias("next"))
    found = new = links
    while not new.isEmpty():
        longer = new.join(step, "dst").select("src", F.col("next").alias("dst")).distinct()
        new = materialise(longer.subtract(found))  # null ends are equal here
        found = materialise(found.unionByName(new))
    return found


def symmetric_difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side only, with ``side``."""
    a, b = left.select(*keys).distinct(), right.select(*keys).distinct()
    return a.join(b, keys, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, keys, "left_anti").withColumn("side", F.lit("right")))


def coverage_ratio(lines: DataFrame, by: list[str], position: list[str], statements: str, count: str) -> DataFrame:
    """Covered statements over all, a position counting as covered if any of its lines is."""
    once = lines.groupBy(*by, *position, statements).agg(F.max(count).alias("_c"))
    total = F.sum(statements)
    return once.groupBy(*by).agg(F.try_divide(F.coalesce(F.sum(F.when(F.col("_c") > 0, F.col(statements))), F.lit(0)), total).alias("ratio"), total.alias("statements"))
