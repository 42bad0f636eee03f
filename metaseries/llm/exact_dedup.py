"""Exact duplicates with the frequent digests split off.

Texts are reduced to SHA-256 digests once. A Misra-Gries style sketch
(``approx_top_k``) names the digests that may be frequent; their exact counts are
verified by a pre-aggregated pass, and the verified winners - at most ``tracked``
rows, whatever the input - are broadcast, so that rows of hot digests are decided
where they lie. All other digests take an ordinary shuffle, pre-aggregated; they have
few rows, but nothing depends on that. Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ascii_lower, stash

#: Digests that the sketch tracks; the most frequent quarter of them are candidates.
TRACKED = 4096


def normal_text(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = TRACKED) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A to Z. The row with the
    largest id of a group stays. A null text counts as empty; null ids lose
    against all others; of rows that repeat the largest id, exactly one stays.
    An empty table gives no rows. Columns besides id and text are not read.
    """
    rows = stash(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.unhex(F.sha2(normal_text(F.col(text_col)), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    # one small row: the sketch's candidates and the number of rows
    found = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(xxhash64(digest), {tracked // 4}, {tracked})").alias("top"),
    )
    candidates = found.select("n", F.explode("top").alias("t")).select("n", F.col("t.item").alias("mark"))
    best = F.max(F.struct("doc_id", "row"))
    winners = stash(
        rows.join(F.broadcast(candidates), F.xxhash64("digest") == F.col("mark"))
        .groupBy("digest")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"), F.first("n").alias("n"))
        .where((F.col("group_size") > 1) & (F.col("group_size") * tracked > F.col("n")))
        .select("digest", "best", "group_size")
    )
    hot = rows.join(F.broadcast(winners), "digest")
    rest = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    # summed up where they lie first; the join back can be split where a digest is large
    groups = rest.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    rest = rest.join(groups, "digest")
    columns = ["doc_id", "row", "digest", "best", "group_size"]
    return (
        hot.select(columns)
        .unionByName(rest.select(columns))
        .select(
            "doc_id",
            F.col("best.doc_id").alias("keep_id"),
            "group_size",
            (F.col("row") == F.col("best.row")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY h) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER (PARTITION BY h ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       h AS text_sha256
FROM (SELECT doc_id,
             sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
      FROM documents)
"""
