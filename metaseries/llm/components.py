"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stash


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of each end of ``links (a, b)``: the smallest id reachable.

    Each round lowers a node's label to the least of its neighbours' and then to its
    label's own label, so paths shorten by half or better. Rounds are written out, so
    a lost executor costs at most one. Null ends are passed over.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a is not null and b is not null").distinct()
    both = stash(both)
    labels = stash(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).select(F.col("a").alias("id"), "label"))
    while True:
        of = labels.select(F.col("id").alias("b"), F.col("label").alias("theirs"))
        lowest = both.join(of, "b").groupBy("a").agg(F.min("theirs").alias("theirs")).withColumnRenamed("a", "id")
        lower = labels.join(lowest, "id").select("id", F.col("label").alias("was"), F.least("label", "theirs").alias("label"))
        lower = stash(lower)
        up = lower.select(F.col("id").alias("label"), F.col("label").alias("above"))
        jumped = stash(lower.join(up, "label", "left").select("id", "was", F.least("label", F.coalesce("above", "label")).alias("label")))
        if jumped.where("label <> was").isEmpty():
            return jumped.select("id", F.col("label").alias("component"))
        labels = jumped.select("id", "label")
