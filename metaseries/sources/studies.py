"""Adapters that give plain tables the shape of a measurement series.

A study is one group's value of one quantity: ``quantity, grp, technique, n, y, v, s,
pub`` with the value ``y``, its variance ``v`` and half-width ``s``. Means of a group's
rows with their standard errors have this shape; they stand in for published
measurements by analogy, and are no measurements of anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

LEAST_ROWS = 5


def _means(rows: DataFrame, keys: dict[str, Column], value: Column, when: Column, technique: Column, least: int) -> DataFrame:
    n = F.count(value)
    out = (
        rows.groupBy(*[c.alias(k) for k, c in keys.items()])
        .agg(technique.alias("technique"), n.alias("n"), F.avg(value).alias("y"), (F.var_samp(value) / n).alias("v"), F.min(when.cast("date")).alias("pub"))
        .where((F.col("n") >= least) & (F.col("v") > 0))
    )
    return out.select("quantity", "grp", "technique", "n", "y", "v", F.sqrt("v").alias("s"), "pub")


def event_studies(spark: SparkSession, folder: str, least: int = LEAST_ROWS) -> DataFrame:
    """Event types as quantities, users as groups."""
    rows = table(spark, folder, "events")
    technique = F.concat(F.lit("t"), (F.min("user_id") % 3).cast("string"))
    return _means(rows, {"quantity": F.col("event_type"), "grp": F.col("user_id")}, F.col("value"), F.col("ts"), technique, least)


def price_studies(spark: SparkSession, folder: str, least: int = LEAST_ROWS) -> DataFrame:
    """Part types as quantities, suppliers as groups, unit prices as values; a study for each return flag."""
    rows = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    keys = {"quantity": F.col("p_type"), "grp": F.col("l_suppkey"), "flag": F.col("l_returnflag")}
    return _means(rows, keys, F.col("l_extendedprice") / F.col("l_quantity"), F.col("l_shipdate"), F.min("l_returnflag"), least)


def order_studies(spark: SparkSession, folder: str, least: int = LEAST_ROWS) -> DataFrame:
    """Market segments as quantities, customers as groups, order totals as values."""
    rows = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    keys = {"quantity": F.col("c_mktsegment"), "grp": F.col("o_custkey")}
    return _means(rows, keys, F.col("o_totalprice"), F.col("o_orderdate"), F.min("o_orderpriority"), least)


EVENTS_SQL = f"""study AS (
  SELECT event_type AS quantity, user_id AS grp, 't' || CAST(user_id % 3 AS VARCHAR) AS technique, count(value) AS n, avg(value) AS y,
         var_samp(value) / count(value) AS v, sqrt(var_samp(value) / count(value)) AS s, min(CAST(ts AS DATE)) AS pub
  FROM events GROUP BY event_type, user_id HAVING count(value) >= {LEAST_ROWS} AND var_samp(value) > 0
)"""
PRICES_SQL = f"""study AS (
  SELECT quantity, grp, technique, count(u) AS n, avg(u) AS y, var_samp(u) / count(u) AS v, sqrt(var_samp(u) / count(u)) AS s, min(d) AS pub
  FROM (SELECT p_type AS quantity, l_suppkey AS grp, l_returnflag AS technique, l_extendedprice / l_quantity AS u, CAST(l_shipdate AS DATE) AS d
        FROM lineitem JOIN part ON l_partkey = p_partkey)
  GROUP BY quantity, grp, technique HAVING count(u) >= {LEAST_ROWS} AND var_samp(u) > 0
)"""
ORDERS_SQL = f"""study AS (
  SELECT c_mktsegment AS quantity, o_custkey AS grp, min(o_orderpriority) AS technique, count(o_totalprice) AS n, avg(o_totalprice) AS y,
         var_samp(o_totalprice) / count(o_totalprice) AS v, sqrt(var_samp(o_totalprice) / count(o_totalprice)) AS s, min(CAST(o_orderdate AS DATE)) AS pub
  FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY c_mktsegment, o_custkey HAVING count(o_totalprice) >= {LEAST_ROWS} AND var_samp(o_totalprice) > 0
)"""
