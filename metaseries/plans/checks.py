"""Rule checks, build and comparison operators on the driver's plain tables, with SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaseries.operators import compare, rules
from metaseries.sources.tables import table
from metaseries.streaming import pooled

from .registry import register


def values(spark, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


register(
    "closed_set_violations",
    lambda s, d: rules.outside_set(table(s, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", values(s, [("F",), ("O",)], "value string")),
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')",
)
URL = r"^https://[a-z0-9.]+/[a-z]{2}/[0-9]+$"
register(
    "pattern_violations",
    lambda s, d: rules.malformed(table(s, d, "pages").select("page_id", "url"), "url", URL),
    f"SELECT page_id, url FROM pages WHERE NOT regexp_full_match(url, '{URL[1:-1]}')",
)
register(
    "required_missing",
    lambda s, d: rules.missing(table(s, d, "documents").select("doc_id", "source"), table(s, d, "labels"), ["doc_id"]),
    "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
)
register(
    "fk_unresolved",
    lambda s, d: rules.outside_set(table(s, d, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", table(s, d, "nation").where("n_regionkey < 4"), "n_nationkey"),
    "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 4)",
)


def unknown_keys(s, d) -> DataFrame:
    keys = table(s, d, "events").select("event_type", F.explode(F.json_object_keys("props")).alias("key"))
    found = rules.outside_set(keys, "key", values(s, [("unit",), ("value",)], "value string"))
    return found.groupBy("event_type", "key").agg(F.count(F.lit(1)).alias("n"))


register(
    "unknown_keys",
    unknown_keys,
    "SELECT event_type, key, count(*) AS n FROM (SELECT event_type, unnest(json_keys(props)) AS key FROM events) WHERE key NOT IN ('unit', 'value') GROUP BY event_type, key",
)
register(
    "below_minimum",
    lambda s, d: rules.below(table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_discount"), "l_discount", 0.01),
    "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount < 0.01",
)
register(
    "duplicate_in_list",
    lambda s, d: rules.repeated(table(s, d, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber"), ["l_orderkey"], ["l_suppkey"], ["l_linenumber"]),
    "SELECT * FROM (SELECT l_orderkey, l_suppkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber) AS occurrence FROM lineitem) WHERE occurrence > 1",
)
register(
    "conditional_required",
    lambda s, d: rules.missing(table(s, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey")), table(s, d, "lineitem").where("l_returnflag = 'R'"), ["l_orderkey"]),
    "SELECT o_orderkey AS l_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
)
register(
    "conditional_refused",
    lambda s, d: table(s, d, "orders").where("o_orderstatus = 'O'").join(table(s, d, "lineitem").where("l_returnflag = 'A'"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey"),
    "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')",
)
register(
    "at_least_one_of",
    lambda s, d: rules.none_present(table(s, d, "orders"), ["o_custkey"], "o_orderpriority", ["1-URGENT", "2-HIGH"]),
    "SELECT o_custkey FROM orders GROUP BY o_custkey HAVING max(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END) = 0",
)


def date_format_disjunction(s, d) -> DataFrame:
    day = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd")
    kind = F.col("o_orderkey") % 5
    text = F.when(kind == 0, F.substring(day, 1, 4)).when(kind == 1, F.substring(day, 1, 7)).when(kind == 2, day).when(kind == 3, F.concat(F.substring(day, 1, 8), F.lit("31"))).otherwise(F.concat(day, F.lit("\n")))
    return table(s, d, "orders").select(rules.date_precision(text).alias("precision")).groupBy("precision").agg(F.count(F.lit(1)).alias("n"))


register(
    "date_format_disjunction",
    date_format_disjunction,
    r"""WITH t AS (
  SELECT CASE o_orderkey % 5 WHEN 0 THEN substr(d, 1, 4) WHEN 1 THEN substr(d, 1, 7) WHEN 2 THEN d WHEN 3 THEN substr(d, 1, 8) || '31' ELSE d || chr(10) END AS t
  FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)
) SELECT CASE WHEN regexp_full_match(t, '[0-9]{4}') AND try_strptime(t || '-01-01', '%Y-%m-%d') IS NOT NULL THEN 'year'
              WHEN regexp_full_match(t, '[0-9]{4}-[0-9]{2}') AND try_strptime(t || '-01', '%Y-%m-%d') IS NOT NULL THEN 'month'
              WHEN regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_strptime(t, '%Y-%m-%d') IS NOT NULL THEN 'day' END AS precision, count(*) AS n
FROM t GROUP BY 1""",
)


def unit_arithmetic(s, d) -> DataFrame:
    published = F.round(F.col("l_extendedprice") / F.col("l_quantity"), 2)
    ok = rules.close(published * F.col("l_quantity"), F.col("l_extendedprice"), 1e-6)
    return table(s, d, "lineitem").groupBy("l_returnflag", ok.alias("agrees")).agg(F.count(F.lit(1)).alias("n"))


register(
    "unit_arithmetic",
    unit_arithmetic,
    """SELECT l_returnflag, abs(p - l_extendedprice) <= 1e-6 * greatest(p, l_extendedprice) AS agrees, count(*) AS n
FROM (SELECT *, round(l_extendedprice / l_quantity, 2) * l_quantity AS p FROM lineitem) GROUP BY ALL""",
)
register(
    "negligibility",
    lambda s, d: table(s, d, "lineitem").groupBy(rules.negligible(F.col("l_tax") / 100, F.array(F.col("l_discount"), F.lit(0.05)), 0.01).alias("negligible")).agg(F.count(F.lit(1)).alias("n")),
    "SELECT l_tax / 100 <= CAST(0.01 AS DOUBLE) * least(l_discount, CAST(0.05 AS DOUBLE)) AS negligible, count(*) AS n FROM lineitem GROUP BY 1",
)

# build
def flat_projection(s, d) -> DataFrame:
    nested = table(s, d, "customer").join(table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.struct(F.col("c_custkey").alias("id"), F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")).alias("nation")).alias("r"))
    return nested.select(F.col("r.id").alias("id"), F.col("r.nation.name").alias("nation_name"), F.col("r.nation.region").alias("nation_region"))


register("flat_projection", flat_projection, "SELECT c_custkey AS id, n_name AS nation_name, n_regionkey AS nation_region FROM customer JOIN nation ON c_nationkey = n_nationkey")
register(
    "ordered_digest",
    lambda s, d: compare.ordered_digest(table(s, d, "nation").select("n_regionkey", "n_name", F.col("n_nationkey").cast("string").alias("fields")), ["n_regionkey"], "n_name", "fields"),
    "SELECT n_regionkey, sha256(string_agg(n_name || chr(10) || n_nationkey || chr(10), '' ORDER BY n_name)) AS digest FROM nation GROUP BY n_regionkey",
)
register(
    "stamp_counts",
    lambda s, d: table(s, d, "documents")
    .join(table(s, d, "labels"), "doc_id", "left")
    .groupBy(F.when(F.col("quality").isNull(), "unlabelled").when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").otherwise("selected").alias("reason"))
    .agg(F.count(F.lit(1)).alias("n")),
    "SELECT CASE WHEN quality IS NULL THEN 'unlabelled' WHEN toxic = 1 THEN 'toxic' WHEN quality = 0 THEN 'poor' ELSE 'selected' END AS reason, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1",
)


# comparison
def _states(s, d) -> DataFrame:
    """Two states of the orders: those in process are new in the second, cheap open ones are gone from it, urgent finished ones changed."""
    o = table(s, d, "orders").select(F.col("o_orderkey").alias("key"), "o_orderstatus", "o_totalprice", "o_orderpriority")
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    new = o.where("o_orderstatus <> 'O' or o_totalprice >= 50000").withColumn("o_orderstatus", F.when(urgent, "W").otherwise(F.col("o_orderstatus")))
    return compare.differences(o.where("o_orderstatus <> 'P'"), new, "key", ["o_orderstatus", "o_totalprice"])


STATES = """WITH old AS (SELECT o_orderkey AS key, o_orderstatus AS st, o_totalprice AS p FROM orders WHERE o_orderstatus <> 'P'),
new AS (SELECT o_orderkey AS key, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'W' ELSE o_orderstatus END AS st, o_totalprice AS p FROM orders WHERE o_orderstatus <> 'O' OR o_totalprice >= 50000),
d AS (
  SELECT coalesce(o.key, n.key) AS key, CASE WHEN o.key IS NULL THEN 'added' WHEN n.key IS NULL THEN 'removed' WHEN o.st IS DISTINCT FROM n.st OR o.p IS DISTINCT FROM n.p THEN 'changed' END AS change
  FROM old o FULL JOIN new n ON o.key = n.key
) """
register("reading_full_outer_diff", _states, STATES + "SELECT key, change FROM d WHERE change IS NOT NULL")
register(
    "version_bump",
    lambda s, d: compare.version_bump(_states(s, d)),
    STATES + "SELECT CASE WHEN bool_or(change IN ('changed', 'removed')) THEN 'MAJOR' WHEN bool_or(change = 'added') THEN 'MINOR' ELSE 'PATCH' END AS bump FROM d",
)
BLOCKS = [("click", 0, 199), ("click", 400, 799), ("view", 100, 650), ("error", 0, 20), ("error", 15, 500)]
register(
    "interval_anti_join",
    lambda s, d: compare.not_in_intervals(table(s, d, "events").select("event_id", F.col("event_type").alias("file"), (F.col("event_id") % 1000).alias("line")), values(s, BLOCKS, "file string, start int, end int")),
    f"""WITH b(file, s, e) AS (VALUES {", ".join(map(str, BLOCKS))}), t AS (SELECT event_id, event_type AS file, event_id % 1000 AS line FROM events)
SELECT event_id, file, line FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.file = t.file AND line BETWEEN s AND e)""",
)
EDGES = [("app", "build"), ("app", "gate"), ("build", "validate"), ("validate", "schema"), ("gate", "build"), ("gate", "net"), ("net", "socket"), ("schema", "toml")]
register(
    "recursive_reach",
    lambda s, d: compare.reach(values(s, EDGES, "src string, dst string")),
    f"""WITH RECURSIVE e(src, dst) AS (VALUES {", ".join(map(str, EDGES))}), w AS (SELECT src, dst FROM e UNION SELECT w.src, e.dst FROM w JOIN e ON w.dst = e.src) SELECT src, dst FROM w""",
)


def nation_trade(s, d) -> DataFrame:
    """An edge from each customer's nation to those that supplied the customer's dearest orders."""
    o = table(s, d, "orders").where("o_totalprice >= 400000").join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    lines = o.join(table(s, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).join(table(s, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return lines.where("l_quantity >= 49").select(F.col("c_nationkey").alias("src"), F.col("s_nationkey").alias("dst")).distinct()


register(
    "recursive_reach_nations",
    lambda s, d: compare.reach(nation_trade(s, d)),
    """WITH RECURSIVE e AS (
  SELECT DISTINCT c_nationkey AS src, s_nationkey AS dst FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON o_orderkey = l_orderkey JOIN supplier ON l_suppkey = s_suppkey
  WHERE o_totalprice >= 400000 AND l_quantity >= 49
), w AS (SELECT src, dst FROM e UNION SELECT w.src, e.dst FROM w JOIN e ON w.dst = e.src) SELECT src, dst FROM w""",
)
register(
    "symmetric_difference",
    lambda s, d: compare.symmetric_difference(table(s, d, "orders").where("o_orderstatus = 'F'"), table(s, d, "orders").where("o_orderstatus = 'P'"), ["o_custkey"]),
    """WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P')
SELECT o_custkey, 'left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT o_custkey, 'right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
register(
    "coverage_ratio",
    lambda s, d: compare.coverage_ratio(
        table(s, d, "lineitem").select("l_returnflag", "l_partkey", F.lit(1).cast("long").alias("statements"), (F.col("l_quantity") > 40).cast("int").alias("count")), ["l_returnflag"], ["l_partkey"], "statements", "count"
    ).select("l_returnflag", F.round("ratio", 8).alias("ratio"), "statements"),
    """WITH o AS (SELECT l_returnflag, l_partkey, max(CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END) AS c FROM lineitem GROUP BY l_returnflag, l_partkey)
SELECT l_returnflag, round(CAST(count(*) FILTER (c > 0) AS DOUBLE) / count(*), 8) AS ratio, count(*) AS statements FROM o GROUP BY l_returnflag""",
)
register(
    "confirmation_breakdown",
    lambda s, d: table(s, d, "orders").join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1))).na.fill(0),
    """SELECT c_mktsegment, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P"
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
)
register(
    "correction_kinds",
    lambda s, d: table(s, d, "lineitem")
    .groupBy("l_orderkey")
    .agg(F.collect_set("l_returnflag").alias("kinds"))
    .select(F.explode("kinds").alias("kind"))
    .groupBy("kind")
    .agg(F.count(F.lit(1)).alias("orders")),
    "SELECT l_returnflag AS kind, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY l_returnflag",
)
register(
    "usage_share",
    lambda s, d: table(s, d, "orders").groupBy("o_orderpriority").agg(F.round(F.avg((F.col("o_orderstatus") == "P").cast("int")), 8).alias("share")),
    "SELECT o_orderpriority, round(avg(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END), 8) AS share FROM orders GROUP BY o_orderpriority",
)


# streaming, beyond the reference
def stream_pooled_events(s, d) -> DataFrame:
    found = pooled.run_available(s, d)
    return found.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("mean", 6).alias("mean"), F.round("se", 6).alias("se"))


register(
    "stream_pooled_events",
    stream_pooled_events,
    "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(value) AS n, round(avg(value), 6) AS mean, round(sqrt(var_samp(value) / count(value)), 6) AS se FROM events GROUP BY 1, 2",
)
