"""URL filtering as a sort-merge range join with a sweep over nested rules.

A rule (host, path prefix) becomes an interval of canonical keys: the host's labels
reversed, a separator, the path. All keys with the rule's key as a prefix lie
between that key and the same key followed by the byte 0xFF, which UTF-8 never
has. Intervals nest or are disjoint, so a sweep in key order with a stack names the
innermost active rule of each stretch between two interval ends.

A rule also covers subdomains, so a url is looked up once for each suffix of its
host that is no deeper than the deepest rule, and the longest fitting rule wins.

The stack is expressed by windows: the depth after each interval end is a running
sum, and the top of the stack at depth d is the last interval opened at depth d.
The lookups are merged with the stretches by a range partitioning of both in key
order; each partition carries over the last stretch of those before it. Everything
is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .shared import ascii_lower, stash

#: (verdict, host, path)
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
RULE_SCHEMA = "verdict string, host string, path string"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty where the url is null or has no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    return ascii_lower(host), F.regexp_extract(tail, r"\A[^?#]*", 0)


def canonical_key(host: Column, path: Column) -> Column:
    """Host labels reversed, a separator, the path; as bytes, which sort as UTF-8 does."""
    labels = F.reverse(F.split(host, r"\."))
    return F.concat(F.array_join(labels, "."), F.lit("\x00"), path).cast("binary")


def stretches(rules: DataFrame) -> DataFrame:
    """Of each interval end, the key and the innermost rule from there on (null: none)."""
    rule = F.struct(
        (F.length("host") + F.length("path")).alias("size"),
        F.length("host").alias("host_size"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    )
    # of equal rules with both verdicts, block holds
    one = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    keyed = one.select("host", canonical_key(F.col("host"), F.col("path")).alias("k"), rule.alias("rule"))
    ends = keyed.select("host", F.col("k").alias("key"), F.lit(1).alias("step"), "rule").unionByName(
        keyed.select("host", F.concat("k", F.unhex(F.lit("FF"))).alias("key"), F.lit(-1).alias("step"), F.lit(None).cast(keyed.schema["rule"].dataType).alias("rule"))
    )
    in_order = Window.partitionBy("host").orderBy("key")
    deep = ends.withColumn("depth", F.sum("step").over(in_order))
    at_depth = Window.partitionBy("host", "depth").orderBy("key")
    top = F.last(F.when(F.col("step") == 1, F.col("rule")), ignorenulls=True).over(at_depth)
    return deep.select("key", F.when(F.col("depth") > 0, top).alias("rule"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    A rule fits its host and all subdomains if the path starts with the rule's
    path; the longest rule (then the longest host) wins; where none fits, ``rule``
    is null and the verdict is ``default``. A null url, or one without ``://``, has
    empty host and path. Equal urls are looked up once. Repeated pages stay
    repeated; an empty table gives no rows; other columns are not read.
    """
    host, path = url_parts(F.col(url_col))
    pages = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rules = rules.select("verdict", ascii_lower(F.col("host")).alias("host"), "path").where("host <> ''")
    # one number over the rules
    deepest = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0

    names = pages.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    depth = F.least(F.size(labels), F.lit(deepest))
    suffixes = F.transform(
        F.when(depth > 0, F.sequence(F.lit(1), depth)).otherwise(F.array().cast("array<int>")),
        lambda n: F.array_join(F.slice(labels, -n, n), "."),
    )
    probes = names.select("host", "path", F.explode(suffixes).alias("suffix"))
    marks = stretches(rules)
    none = F.lit(None).cast("string")
    both = marks.select("key", F.lit(0).alias("kind"), none.alias("host"), none.alias("path"), F.struct("rule").alias("mark")).unionByName(
        probes.select(canonical_key(F.col("suffix"), F.col("path")).alias("key"), F.lit(1).alias("kind"), "host", "path"), allowMissingColumns=True
    )
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the partition number is written out, so that it can't change when a task runs again
    swept = stash(both.repartitionByRange(parts, "key", "kind", "host").withColumn("part", F.spark_partition_id()))
    # one row a partition: its last stretch, carried into the partitions after it
    lasts = swept.groupBy("part").agg(F.max_by("mark", F.when(F.col("kind") == 0, F.col("key"))).alias("last"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select("part", F.last("last", ignorenulls=True).over(before).alias("carried"))
    so_far = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    active = swept.withColumn("here", F.last("mark", ignorenulls=True).over(so_far)).where("kind = 1")
    fitting = (
        active.join(F.broadcast(carried), "part", "left")
        .select("host", "path", F.coalesce("here", "carried")["rule"].alias("rule"))
        .where("rule is not null")
        .groupBy("host", "path")
        .agg(F.max("rule").alias("best"))
    )
    return pages.join(fitting, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM parts
), rules(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
)
SELECT s.page_id, s.host, s.path,
       (SELECT arg_max(r.host || r.path, length(r.host || r.path)) FROM rules r
        WHERE (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)) AS rule,
       coalesce((SELECT arg_max(r.verdict, length(r.host || r.path)) FROM rules r
        WHERE (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)), 'allow') AS verdict
FROM split s
"""
