"""Line-level deduplication by a line's frequency within its site.

A line's frequency is the number of a host's pages that contain it over the number
of that host's pages. Lines above a ratio are boilerplate and go. Pages' distinct
lines are reduced to hashes and pre-aggregated, so a host with a third of all pages,
or a line on every page, costs no more than others. At most (lines per page) / ratio
lines of a host can pass, so what is joined back is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import private, stash, text_mark

#: A line on more than this share of a host's pages is boilerplate.
RATIO = 0.05
#: On so many pages of the host at least, so that small hosts keep their lines.
LEAST_PAGES = 5
#: Boilerplate lines up to this number, and up to that number of a host, are broadcast.
BROADCAST_ROWS, HOST_ROWS = 100_000, 2_000


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``host, line_hash, pages, host_pages`` of the lines above the ratio.

    Lines are compared with outer blanks trimmed; blank lines never count. A page
    counts once for a line. Pages without host form a host of their own (null).
    """
    lines = F.transform(F.split(F.col(text_col), "\n"), F.trim)
    hashed = F.transform(F.array_distinct(F.filter(lines, lambda x: x != "")), lambda x: F.xxhash64(x))
    pages = docs.select(F.col(host_col).cast("string").alias("host"), hashed.alias("lines"))
    total = F.coalesce(F.sum(F.when(F.col("line_hash").isNull(), F.col("n"))), F.lit(0))
    # a page's own row has no line; so one aggregation counts lines and pages
    marks = F.concat(F.array(F.lit(None).cast("bigint")), F.coalesce("lines", F.array().cast("array<bigint>")))
    counts = pages.select("host", F.explode(marks).alias("line_hash")).groupBy("host", "line_hash").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.where((F.col("n") >= least_pages) | F.col("line_hash").isNull())
    counts = stash(counts)
    hosts = counts.groupBy("host").agg(total.alias("host_pages"))
    lines = counts.where("line_hash is not null").select("host", "line_hash", F.col("n").alias("pages"))
    return (
        lines.join(hosts.withColumnRenamed("host", "its_host"), F.col("host").eqNullSafe(F.col("its_host")))
        .drop("its_host")
        .where(F.col("pages") > F.col("host_pages") * ratio)
    )


def dedup_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES, count_col: str = "lines_dropped") -> DataFrame:
    """``docs`` with boilerplate lines cut from its text, and ``lines_dropped``.

    Every document stays, one row each, all columns kept; a text of nothing but
    boilerplate becomes empty, a null text stays null. Line order and blank lines
    stay. ``count_col`` must not be a column of ``docs``.
    """
    found = boilerplate(docs, host_col, text_col, ratio, least_pages)
    found = stash(found)
    lines, host, mark = private("lines"), private("host"), private("mark")
    sizes = found.groupBy("host").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    own_host, parts = F.col(host_col).cast("string"), F.split(F.col(text_col), "\n")
    if sizes[0] <= BROADCAST_ROWS and sizes[1] <= HOST_ROWS:
        lists = found.groupBy("host").agg(F.collect_set("line_hash").alias(lines)).withColumnRenamed("host", host)
        joined = docs.join(F.broadcast(lists), own_host.eqNullSafe(F.col(host)), "left")
        kept = F.filter(parts, lambda x: ~F.array_contains(F.col(lines), F.xxhash64(F.trim(x))))
    else:
        # a text's lines meet the list by host and line, and only the places to cut come back
        spread = docs.select(own_host.alias(host), text_mark(F.col(text_col)).alias(mark), F.posexplode(F.transform(parts, lambda x: F.xxhash64(F.trim(x)))).alias("at", "line"))
        hits = spread.join(found.select("host", "line_hash"), F.col(host).eqNullSafe(F.col("host")) & (F.col("line") == F.col("line_hash")))
        places = hits.groupBy(host, mark).agg(F.collect_set("at").alias(lines))
        joined = docs.join(places, own_host.eqNullSafe(F.col(host)) & (text_mark(F.col(text_col)) == F.col(mark)), "left")
        kept = F.filter(parts, lambda x, i: ~F.array_contains(F.col(lines), i))
    cut = F.col(lines).isNotNull() & F.col(text_col).isNotNull()
    return joined.select(
        *[F.when(cut, F.array_join(kept, "\n")).otherwise(F.col(c)).alias(c) if c == text_col else F.col(c) for c in docs.columns],
        F.when(cut, F.size(parts) - F.size(kept)).otherwise(F.lit(0)).alias(count_col),
    )


def query(spark, sf_dir: str) -> DataFrame:
    """Documents with lines that are boilerplate of their source cut out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup_lines(docs).select("doc_id", "source", "lines_dropped", "text")


SQL = f"""
WITH pages AS (
  SELECT row_number() OVER () AS page, doc_id, source, text FROM documents
), lines AS (
  SELECT page, source, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM pages
), hosts AS (
  SELECT source, count(*) AS host_pages FROM documents GROUP BY source
), cut AS (
  SELECT l.source, l.line FROM (SELECT source, trim(raw, ' ') AS line, count(DISTINCT page) AS pages FROM lines WHERE trim(raw, ' ') <> '' GROUP BY ALL) l
  JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
  WHERE pages >= {LEAST_PAGES} AND pages > host_pages * {RATIO}
), marked AS (
  SELECT page, pos, raw, c.line IS NOT NULL AS gone FROM lines l LEFT JOIN cut c ON l.source IS NOT DISTINCT FROM c.source AND trim(raw, ' ') = c.line
)
SELECT p.doc_id, p.source, CAST(coalesce(m.dropped, 0) AS INTEGER) AS lines_dropped,
       CASE WHEN p.text IS NULL THEN NULL ELSE coalesce(m.text, '') END AS text
FROM pages p LEFT JOIN (
  SELECT page, count(*) FILTER (gone) AS dropped, string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone) AS text FROM marked GROUP BY page
) m ON p.page = m.page
"""
