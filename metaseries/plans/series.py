"""Queries over measurement series, with their SQL counterparts.

Results are rounded, so that the order in which a sum's parts meet does not show.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaseries.functions.quantiles import normal_quantile, student_sql
from metaseries.operators import deviation, diagnostics, ordered, pooling, tension
from metaseries.sources import studies
from metaseries.sources.accepted import first_day, last_day
from metaseries.sources.tables import materialise, table

from .registry import register

Q = ["quantity"]
GRID = [1.0, 1.5, 2.0, 2.5, 3.0, 4.0, 5.0]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def _sql(study: str, rest: str) -> str:
    return f"WITH {study}, {rest}"


SUMS = """sums AS (
  SELECT quantity, count(y) AS k, min(y) AS y0, sum(1 / v) AS sw, sum(1 / (v * v)) AS sww FROM study GROUP BY quantity
), means AS (
  SELECT s.quantity, sum((y - y0) / v) / any_value(sw) AS off FROM study s JOIN sums t ON s.quantity = t.quantity GROUP BY s.quantity
), fixed AS (
  SELECT s.quantity, any_value(k) AS k, any_value(sw) AS sw, any_value(y0 + off) AS estimate, any_value(sqrt(1 / sw)) AS se,
         sum((y - y0 - off) * (y - y0 - off) / v) AS q, any_value(sw - sww / sw) AS spare
  FROM study s JOIN sums t ON s.quantity = t.quantity JOIN means m ON s.quantity = m.quantity GROUP BY s.quantity
)"""
RANDOM = (
    SUMS
    + """, tau AS (
  SELECT quantity, k, q, CASE WHEN k > 1 AND spare <> 0 THEN greatest(0, (q - (k - 1)) / spare) ELSE 0 END AS tau2 FROM fixed
), rmeans AS (
  SELECT s.quantity, any_value(y0) AS y0, any_value(tau2) AS tau2, sum(1 / (v + tau2)) AS sw, sum((y - y0) / (v + tau2)) / sum(1 / (v + tau2)) AS off
  FROM study s JOIN tau t ON s.quantity = t.quantity JOIN sums u ON s.quantity = u.quantity GROUP BY s.quantity
), rscatter AS (
  SELECT s.quantity, sum((y - y0 - off) * (y - y0 - off) / (v + tau2)) AS q FROM study s JOIN rmeans r ON s.quantity = r.quantity GROUP BY s.quantity
), random AS (
  SELECT t.quantity, k, t.q, CASE WHEN t.q > 0 THEN greatest(0, (t.q - (k - 1)) / t.q) ELSE 0 END AS i2, t.tau2, y0 + off AS estimate, sqrt(1 / sw) AS se,
         CASE WHEN k > 1 THEN sqrt(c.q / ((k - 1) * sw)) END AS se_hk
  FROM tau t JOIN rmeans r ON t.quantity = r.quantity JOIN rscatter c ON t.quantity = c.quantity
)"""
)

# pooling
register(
    "pool_fixed_events",
    lambda s, d: rounded(pooling.pool_fixed(studies.event_studies(s, d), Q)),
    _sql(studies.EVENTS_SQL, SUMS + " SELECT quantity, k, round(estimate, 6) AS estimate, round(se, 6) AS se, round(q, 6) AS q FROM fixed"),
)
_random = " SELECT quantity, k, round(q, {0}) AS q, round(i2, {0}) AS i2, round(tau2, {0}) AS tau2, round(estimate, {0}) AS estimate, round(se, {0}) AS se, round(se_hk, {0}) AS se_hk FROM random"
register("pool_random_dl_events", lambda s, d: rounded(pooling.pool_random(studies.event_studies(s, d), Q)), _sql(studies.EVENTS_SQL, RANDOM + _random.format(6)))
register("pool_random_lineitem", lambda s, d: rounded(pooling.pool_random(studies.price_studies(s, d), Q), 3), _sql(studies.PRICES_SQL, RANDOM + _random.format(3)))


def tight_studies(s, d) -> DataFrame:
    """Event studies moved so far from zero that their widths are about a billionth of their values."""
    return studies.event_studies(s, d).withColumn("y", F.col("y") + F.lit(1e10))


register(
    "pool_random_tight",
    lambda s, d: rounded(pooling.pool_random(tight_studies(s, d), Q), 3),
    _sql(studies.EVENTS_SQL.replace("study AS", "plain AS"), "study AS (SELECT * REPLACE (y + 1e10 AS y) FROM plain), " + RANDOM + _random.format(3)),
)


def pool_random_pm(s, d) -> DataFrame:
    series = studies.event_studies(s, d)
    return rounded(pooling.pool_random(series, Q, pooling.paule_mandel_variance(series, Q)), 5)


# tested against its defining equation
register("pool_random_pm_events", pool_random_pm)
register(
    "heterogeneity_q_i2",
    lambda s, d: rounded(pooling.pool_random(studies.price_studies(s, d), Q), 5).select("quantity", "k", "q", "i2"),
    _sql(studies.PRICES_SQL, RANDOM + " SELECT quantity, k, round(q, 5) AS q, round(i2, 5) AS i2 FROM random"),
)
register(
    "scale_factor_view",
    lambda s, d: rounded(pooling.scale_factor(studies.event_studies(s, d), Q)),
    _sql(
        studies.EVENTS_SQL,
        SUMS
        + " SELECT quantity, k, round(estimate, 6) AS estimate, round(sqrt(greatest(1, CASE WHEN k > 1 THEN q / (k - 1) ELSE 1 END)), 6) AS scale,"
        " round(se * sqrt(greatest(1, CASE WHEN k > 1 THEN q / (k - 1) ELSE 1 END)), 6) AS se_scaled, 'scale-factor view' AS view FROM fixed",
    ),
)
register(
    "prediction_interval",
    lambda s, d: rounded(pooling.prediction_interval(studies.event_studies(s, d), Q), 5),
    _sql(
        studies.EVENTS_SQL,
        RANDOM + f" SELECT quantity, k, round(estimate, 5) AS estimate, round(estimate - t * sqrt(tau2 + se * se), 5) AS lower, round(estimate + t * sqrt(tau2 + se * se), 5) AS upper"
        f" FROM (SELECT *, {student_sql('(k - 2)')} AS t FROM random)",
    ),
)



def shared_studies(s, d) -> DataFrame:
    """Event studies whose technique is a correlation group, with a share of their width in common that their number of values fixes."""
    share = F.sqrt((F.col("n") % 5) / 8.0)
    return studies.event_studies(s, d).withColumn("correlation_group", F.when(F.col("technique") != "t2", F.col("technique"))).withColumn("shared", F.col("s") * share)


SHARED = """own AS (
  SELECT quantity, grp, y, v, CASE WHEN technique <> 't2' THEN technique END AS g, CASE WHEN technique <> 't2' THEN v * (n % 5) / 8.0 ELSE 0 END AS uu FROM study
), part AS (
  SELECT *, sqrt(uu) AS u, v - uu AS o, y - min(y) OVER (PARTITION BY quantity) AS d, min(y) OVER (PARTITION BY quantity) AS y0 FROM own
), b1 AS (
  SELECT quantity, g, any_value(y0) AS y0, count(*) AS n, sum(1 / o) AS a, sum(d / o) AS b, sum(d * d / o) AS dd, sum(u / o) AS c, sum(u * d / o) AS e, 1 + sum(u * u / o) AS f,
         sum(1 / (o * o)) AS w2, sum(u / (o * o)) AS w2u, sum(u * u / (o * o)) AS w2uu FROM part GROUP BY quantity, g
), s1 AS (
  SELECT quantity, sum(n) AS k, count(*) FILTER (g IS NOT NULL AND n > 1) AS groups, sum(a - c * c / f) AS sw, sum(b - c * e / f) AS swd, sum(dd - e * e / f) AS swdd, sum(a - w2uu / f) AS trace,
         sum(w2 - 2 * c / f * w2u + c / f * c / f * w2uu) AS sww FROM b1 GROUP BY quantity
), t1 AS (
  SELECT quantity, k, groups, swdd - swd * swd / sw AS q, CASE WHEN k > 1 THEN greatest(0, (swdd - swd * swd / sw - (k - 1)) / (trace - sww / sw)) ELSE 0 END AS tau2 FROM s1
), b2 AS (
  SELECT p.quantity, g, any_value(y0) AS y0, any_value(tau2) AS tau2, sum(1 / (o + tau2)) AS a, sum(d / (o + tau2)) AS b, sum(u / (o + tau2)) AS c, sum(u * d / (o + tau2)) AS e, 1 + sum(u * u / (o + tau2)) AS f
  FROM part p JOIN t1 t ON p.quantity = t.quantity GROUP BY p.quantity, g
), s2 AS (SELECT quantity, any_value(y0) AS y0, sum(a - c * c / f) AS sw, sum(b - c * e / f) AS swd FROM b2 GROUP BY quantity)
SELECT t.quantity, CAST(k AS BIGINT) AS k, groups, round(q, 5) AS q, round(tau2, 5) AS tau2, round(y0 + swd / sw, 5) AS estimate, round(sqrt(1 / sw), 5) AS se FROM t1 t JOIN s2 u ON t.quantity = u.quantity"""
# tested against the inverse of the whole covariance matrix
register("pool_correlated_events", lambda s, d: rounded(pooling.pool_correlated(shared_studies(s, d), Q), 5), _sql(studies.EVENTS_SQL, SHARED))

# sequences
register(
    "cumulative_pool_orders",
    lambda s, d: rounded(pooling.cumulative(studies.order_studies(s, d), Q, "fixed").select("quantity", "grp", "pub", "k", "estimate", "se"), 2),
    _sql(
        studies.ORDERS_SQL,
        "c AS (SELECT quantity, grp, pub, count(*) OVER w AS k, sum(y / v) OVER w AS a, sum(1 / v) OVER w AS b FROM study WINDOW w AS (PARTITION BY quantity ORDER BY pub, grp ROWS UNBOUNDED PRECEDING))"
        " SELECT quantity, grp, pub, k, round(a / b, 2) AS estimate, round(sqrt(1 / b), 2) AS se FROM c",
    ),
)
#: Each study (grp) with the studies (y, v) that ``{of}`` holds for it, pooled anew by the random-effects model.
REPOOLED = """met AS (
  SELECT a.quantity, a.grp, b.y, b.v, y0 FROM study a JOIN study b ON a.quantity = b.quantity AND {of} JOIN (SELECT quantity, min(y) AS y0 FROM study GROUP BY quantity) p ON a.quantity = p.quantity
), met1 AS (
  SELECT quantity, grp, count(*) AS k, any_value(y0) AS y0, sum(1 / v) AS sw, sum(1 / (v * v)) AS sww, sum((y - y0) / v) / sum(1 / v) AS off FROM met GROUP BY quantity, grp
), met2 AS (
  SELECT m.quantity, m.grp, any_value(k) AS k, any_value(sw) - any_value(sww) / any_value(sw) AS spare, sum((y - m.y0 - off) * (y - m.y0 - off) / v) AS q FROM met m JOIN met1 n ON m.quantity = n.quantity AND m.grp = n.grp GROUP BY m.quantity, m.grp
), met3 AS (
  SELECT quantity, grp, k, CASE WHEN k > 1 AND spare <> 0 THEN greatest(0, (q - (k - 1)) / spare) ELSE 0 END AS tau2 FROM met2
), repooled AS (
  SELECT m.quantity, m.grp, any_value(k) AS k, any_value(tau2) AS tau2, any_value(y0) + sum((y - y0) / (v + tau2)) / sum(1 / (v + tau2)) AS estimate, sqrt(1 / sum(1 / (v + tau2))) AS se
  FROM met m JOIN met3 n ON m.quantity = n.quantity AND m.grp = n.grp GROUP BY m.quantity, m.grp
)"""
LOO_RANDOM = REPOOLED.format(of="a.grp <> b.grp") + ", loo AS (SELECT s.*, r.estimate AS reference, r.se AS reference_se FROM study s LEFT JOIN repooled r ON s.quantity = r.quantity AND s.grp = r.grp)"
LOO = """loo AS (
  SELECT s.*, CASE WHEN k > 1 THEN y0 + (off * sw - (y - y0) / v) / (sw - 1 / v) END AS reference, CASE WHEN k > 1 THEN sqrt(1 / (sw - 1 / v)) END AS reference_se
  FROM study s JOIN sums t ON s.quantity = t.quantity JOIN means m ON s.quantity = m.quantity
)"""
register(
    "leave_one_out_reference",
    lambda s, d: rounded(pooling.leave_one_out(studies.event_studies(s, d), Q, "fixed")).select("quantity", "grp", "y", "reference", "reference_se"),
    _sql(studies.EVENTS_SQL, SUMS + ", " + LOO + " SELECT quantity, grp, round(y, 6) AS y, round(reference, 6) AS reference, round(reference_se, 6) AS reference_se FROM loo"),
)
register(
    "leave_one_out_random",
    lambda s, d: rounded(pooling.leave_one_out(materialise(studies.event_studies(s, d)), Q)).select("quantity", "grp", "y", "reference", "reference_se"),
    _sql(studies.EVENTS_SQL, LOO_RANDOM + " SELECT quantity, grp, round(y, 6) AS y, round(reference, 6) AS reference, round(reference_se, 6) AS reference_se FROM loo"),
)
register(
    "cumulative_random_orders",
    lambda s, d: rounded(pooling.cumulative(materialise(studies.order_studies(s, d)), Q).select("quantity", "grp", "pub", "k", "tau2", "estimate", "se"), 1),
    _sql(studies.ORDERS_SQL, REPOOLED.format(of="(b.pub < a.pub OR (b.pub = a.pub AND b.grp <= a.grp))") + " SELECT r.quantity, r.grp, pub, k, round(tau2, 1) AS tau2, round(estimate, 1) AS estimate, round(r.se, 1) AS se FROM repooled r JOIN study s ON r.quantity = s.quantity AND r.grp = s.grp"),
)


def partly_dated(s, d) -> DataFrame:
    """Order studies of whose dates a third is known by the year and a third by the month only."""
    known = F.when(F.col("grp") % 3 == 0, 4).when(F.col("grp") % 3 == 1, 7).otherwise(10)
    stated = studies.order_studies(s, d).withColumn("date", F.substring(F.col("pub").cast("string"), F.lit(1), known))
    return materialise(stated.withColumn("pub", first_day(F.col("date"))).withColumn("pub_end", last_day(F.col("date"))))


PARTLY = """study AS (
  SELECT * REPLACE (CASE grp % 3 WHEN 0 THEN date_trunc('year', pub) WHEN 1 THEN date_trunc('month', pub) ELSE pub END::DATE AS pub),
         CASE grp % 3 WHEN 0 THEN date_trunc('year', pub) + INTERVAL 1 YEAR - INTERVAL 1 DAY WHEN 1 THEN date_trunc('month', pub) + INTERVAL 1 MONTH - INTERVAL 1 DAY ELSE pub END::DATE AS pub_end FROM dated
)"""
_partly_sql = lambda rest: _sql(studies.ORDERS_SQL.replace("study AS", "dated AS"), f"{PARTLY}, {rest}")
register(
    "cumulative_partial_dates",
    lambda s, d: rounded(pooling.cumulative(partly_dated(s, d), Q, "fixed"), 2).select("quantity", "grp", "pub", "k", "estimate", "se", "unordered"),
    _partly_sql(
        """c AS (
  SELECT quantity, grp, pub, count(*) OVER w AS k, sum(y / v) OVER w AS a, sum(1 / v) OVER w AS b FROM study WINDOW w AS (PARTITION BY quantity ORDER BY pub_end, pub, grp ROWS UNBOUNDED PRECEDING)
), o AS (
  SELECT a.quantity, a.grp, count(*) - 1 AS unordered FROM study a JOIN study b ON a.quantity = b.quantity AND b.pub <= a.pub_end AND b.pub_end >= a.pub GROUP BY a.quantity, a.grp
) SELECT c.quantity, c.grp, pub, k, round(a / b, 2) AS estimate, round(sqrt(1 / b), 2) AS se, unordered FROM c JOIN o ON c.quantity = o.quantity AND c.grp = o.grp"""
    ),
)
register(
    "latest_per_group",
    lambda s, d: rounded(pooling.latest(studies.order_studies(s, d), ["quantity", "technique"]), 2).select("quantity", "technique", "grp", "pub", "n", "y"),
    _sql(
        studies.ORDERS_SQL,
        "r AS (SELECT *, row_number() OVER (PARTITION BY quantity, technique ORDER BY pub DESC, grp DESC) AS i FROM study) SELECT quantity, technique, grp, pub, n, round(y, 2) AS y FROM r WHERE i = 1",
    ),
)

# diagnostics
register(
    "funnel_points",
    lambda s, d: rounded(diagnostics.funnel_points(studies.event_studies(s, d), Q)),
    _sql(studies.EVENTS_SQL, SUMS + " SELECT s.quantity, grp, technique, round(y - estimate, 6) AS off, round(s, 6) AS s FROM study s JOIN fixed f ON s.quantity = f.quantity"),
)
register(
    "egger_regression",
    lambda s, d: rounded(diagnostics.egger_regression(studies.event_studies(s, d), Q), 5),
    _sql(
        studies.EVENTS_SQL,
        """a AS (
  SELECT quantity, count(*) AS k, min(y) AS y0, avg(1 / s) AS mx FROM study GROUP BY quantity
), b AS (
  SELECT s.quantity, any_value(k) AS k, any_value(y0) AS y0, any_value(mx) AS mx, avg((y - y0) / s) AS mz FROM study s JOIN a ON s.quantity = a.quantity GROUP BY s.quantity
), c AS (
  SELECT s.quantity, any_value(k) AS k, any_value(y0) AS y0, any_value(mx) AS mx, any_value(mz) AS mz, sum((1 / s - mx) * (1 / s - mx)) AS cxx, sum((1 / s - mx) * ((y - y0) / s - mz)) AS cxz
  FROM study s JOIN b ON s.quantity = b.quantity GROUP BY s.quantity
), d AS (
  SELECT s.quantity, any_value(k) AS k, any_value(y0) AS y0, any_value(mx) AS mx, any_value(mz) AS mz, any_value(cxx) AS cxx, any_value(cxz / cxx) AS slope,
         sum(((y - y0) / s - mz - cxz / cxx * (1 / s - mx)) * ((y - y0) / s - mz - cxz / cxx * (1 / s - mx))) AS rest
  FROM study s JOIN c ON s.quantity = c.quantity GROUP BY s.quantity
), e AS (SELECT *, mz - slope * mx AS intercept FROM d)
SELECT quantity, k, round(intercept, 5) AS intercept, round(y0 + slope, 5) AS slope, round(intercept / sqrt(rest / (k - 2) * (1 / k + mx * mx / cxx)), 5) AS t FROM e""",
    ),
)


register(
    "forest_rows",
    lambda s, d: rounded(diagnostics.forest_rows(studies.event_studies(s, d), Q), 8),
    _sql(
        studies.EVENTS_SQL,
        RANDOM
        + f""", line AS (
  SELECT s.quantity, 'study' AS kind, CAST(pub AS VARCHAR) || ' ' || grp AS label, y, sqrt(v) AS w, se * se / v AS weight FROM study s JOIN fixed f ON s.quantity = f.quantity
  UNION ALL SELECT quantity, 'fixed', NULL, estimate, se, NULL FROM fixed UNION ALL SELECT quantity, 'random', NULL, estimate, se, NULL FROM random
) SELECT quantity, kind, label, round(y, 8) AS y, round(y - {normal_quantile(0.975)!r} * w, 8) AS lower, round(y + {normal_quantile(0.975)!r} * w, 8) AS upper, round(weight, 8) AS weight FROM line""",
    ),
)


#: Each key's rounds go on while they change; the row of the last round is its fixed point.
TRIM = """placed AS (
  SELECT quantity, grp, {sign}y AS y, v, row_number() OVER (PARTITION BY quantity ORDER BY {sign}y, grp) AS place, count(*) OVER (PARTITION BY quantity) AS k FROM study
), state AS (
  SELECT DISTINCT quantity, 0 AS step, CAST(0 AS BIGINT) AS filled, CAST(-1 AS BIGINT) AS was, CAST(0 AS DOUBLE) AS c FROM study
  UNION ALL
  SELECT quantity, step + 1, CAST(greatest(0, least(k - 2, floor((4.0 * sum(CASE WHEN y > c THEN r ELSE 0 END) - k * (k + 1)) / (2 * k - 1) + 0.5))) AS BIGINT), filled, c
  FROM (
    SELECT p.quantity, step, filled, k, c, y, row_number() OVER (PARTITION BY p.quantity ORDER BY abs(y - c), grp) AS r
    FROM placed p JOIN (
      SELECT t.quantity, step, filled, sum(y / v) / sum(1 / v) AS c FROM placed t JOIN state z ON t.quantity = z.quantity WHERE filled <> was AND place <= k - filled GROUP BY t.quantity, step, filled
    ) m ON p.quantity = m.quantity
  ) GROUP BY quantity, step, filled, k, c
), settled AS (SELECT quantity, filled, c FROM state WHERE filled = was
), every AS (SELECT quantity, y, v FROM placed UNION ALL SELECT p.quantity, 2 * c - y, v FROM placed p JOIN settled f ON p.quantity = f.quantity WHERE place > k - filled
), adjusted AS (SELECT quantity, sum(y / v) / sum(1 / v) AS adjusted FROM every GROUP BY quantity
), plain AS (SELECT quantity, count(*) AS k, sum(y / v) / sum(1 / v) AS estimate FROM placed GROUP BY quantity
) SELECT p.quantity, k, round({sign}estimate, 5) AS estimate, round({sign}adjusted, 5) AS adjusted, filled FROM plain p JOIN adjusted a ON p.quantity = a.quantity JOIN settled f ON p.quantity = f.quantity"""


def _trim_fill_sql(sign: str = "") -> str:
    return "WITH RECURSIVE " + studies.EVENTS_SQL + ", " + TRIM.format(sign=sign)


def _trim_and_fill(side: str = "right"):
    return lambda s, d: rounded(diagnostics.trim_and_fill(materialise(studies.event_studies(s, d)), Q, side=side), 5)


register("trim_and_fill", _trim_and_fill(), _trim_fill_sql())
register("trim_and_fill_left", _trim_and_fill("left"), _trim_fill_sql("-"))


def trim_and_fill_settled(s, d) -> DataFrame:
    """The fixed point for unit prices, of which there are many short series."""
    return rounded(diagnostics.trim_and_fill(materialise(_one_a_group(studies.price_studies(s, d))), Q), 3)


def _one_a_group(series: DataFrame) -> DataFrame:
    """A series with one number for each study in ``grp``, so that ranks have no ties."""
    return series.withColumn("grp", F.concat_ws("-", "grp", "technique"))


register("trim_and_fill_settled", trim_and_fill_settled, "WITH RECURSIVE " + studies.PRICES_SQL.replace("study AS", "plain_study AS") + ", study AS (SELECT * REPLACE (grp || '-' || technique AS grp) FROM plain_study), " + TRIM.format(sign="").replace(", 5)", ", 3)"))
register(
    "split_by_technique",
    lambda s, d: rounded(diagnostics.shares(studies.price_studies(s, d), ["quantity", "technique"]), 3),
    _sql(studies.PRICES_SQL, "x AS (SELECT quantity, technique, count(y) AS k, sum(y / v) / sum(1 / v) AS e FROM study GROUP BY quantity, technique) SELECT quantity, technique, k, round(e, 3) AS estimate FROM x"),
)

# deviations
def accepted_values(s, d) -> DataFrame:
    """Stand-ins for recommended values: each week's mean of all events of a type so far, revised week by week.

    Types whose name has an even number of letters are declared pinned down by the last
    week's value, whose width is as of one part in n of the scatter.
    """
    rows = table(s, d, "events").select(F.col("event_type").alias("quantity"), "value", (F.date_trunc("week", "ts").cast("date") + 6).alias("valid_from"))
    weeks = rows.groupBy("quantity", "valid_from").agg(F.count("value").alias("n"), F.sum("value").alias("a"), F.sum(F.col("value") * F.col("value")).alias("b"))
    sofar = materialise(ordered.running(weeks, Q, [F.col("valid_from").asc()], {c: ("sum", F.col(c)) for c in ("n", "a", "b")}))
    last = F.col("valid_from") == F.col("last")
    n, spread = F.col("n"), F.sqrt((F.col("b") - F.col("a") * F.col("a") / F.col("n")) / (F.col("n") - 1))
    pinned = last & (F.length("quantity") % 2 == 0)
    dated = sofar.join(sofar.groupBy("quantity").agg(F.max("valid_from").alias("last")), "quantity").where("n > 1")
    return dated.select("quantity", "valid_from", (F.col("a") / n).alias("value"), (spread / F.when(pinned, n).otherwise(F.sqrt(n))).alias("half_width"), pinned.alias("pins_down"))


REFERENCES = (
    RANDOM
    + ", "
    + LOO_RANDOM
    + """, weeks AS (
  SELECT DISTINCT event_type AS quantity, CAST(date_trunc('week', ts) AS DATE) + 6 AS valid_from, max(CAST(date_trunc('week', ts) AS DATE) + 6) OVER (PARTITION BY event_type) AS last FROM events
), accepted AS (
  SELECT quantity, valid_from, avg(value) AS value, valid_from = any_value(last) AND length(quantity) % 2 = 0 AS pins_down,
         CASE WHEN valid_from = any_value(last) AND length(quantity) % 2 = 0 THEN stddev_samp(value) / count(value) ELSE stddev_samp(value) / sqrt(count(value)) END AS half_width
  FROM weeks JOIN events ON event_type = quantity AND CAST(ts AS DATE) <= valid_from GROUP BY quantity, valid_from HAVING count(value) > 1
), vintages AS (
  SELECT quantity, max(pub) AS vintage FROM study GROUP BY quantity
), now AS (
  SELECT quantity, max(valid_from) AS valid_from FROM accepted GROUP BY quantity
), modern AS (
  SELECT s.*, a.value AS r, a.half_width AS r_half, a.valid_from AS vintage FROM study s JOIN now n ON s.quantity = n.quantity JOIN accepted a ON a.quantity = n.quantity AND a.valid_from = n.valid_from
), later AS (
  SELECT * FROM (
    SELECT s.*, y0 + sum((y - y0) / v) OVER w / sum(1 / v) OVER w AS r, sqrt(1 / sum(1 / v) OVER w) AS r_half, max(pub) OVER w AS vintage FROM study s JOIN (SELECT quantity, y0 FROM sums) p ON s.quantity = p.quantity
    WINDOW w AS (PARTITION BY s.quantity ORDER BY pub - DATE '1970-01-01' RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
  ) WHERE r IS NOT NULL
), pinned AS (
  SELECT a.quantity, a.valid_from, any_value(a.value) AS value, any_value(a.half_width) AS half_width FROM accepted a JOIN study s ON a.quantity = s.quantity AND s.pub < a.valid_from
  WHERE a.pins_down GROUP BY a.quantity, a.valid_from HAVING any_value(a.half_width) <= min(s.s) * 0.1
), referred AS (
  SELECT quantity, grp, technique, n, y, v, s, pub, 'modern' AS reference_kind, r, r_half, vintage FROM modern
  UNION ALL SELECT quantity, grp, technique, n, y, v, s, pub, 'later', r, r_half, vintage FROM later
  UNION ALL SELECT o.quantity, grp, technique, n, y, v, s, pub, 'leave-one-out', reference, reference_se, vintage FROM loo o JOIN vintages g ON o.quantity = g.quantity WHERE reference IS NOT NULL
  UNION ALL SELECT s.quantity, grp, technique, n, y, v, s, pub, 'resolved', value, half_width, valid_from FROM study s JOIN pinned p ON s.quantity = p.quantity AND s.pub < valid_from
), dev AS (
  SELECT *, (y - r) / s AS z, r_half / s AS ratio, coalesce(r_half / s <= CAST(1 AS DOUBLE) / 3, false) AS admitted FROM referred
)"""
)


def _deviations(s, d) -> DataFrame:
    return deviation.deviations(deviation.references(materialise(studies.event_studies(s, d)), Q, materialise(accepted_values(s, d))))


register(
    "deviation_z",
    lambda s, d: rounded(_deviations(s, d), 5).select("quantity", "grp", "reference_kind", "vintage", "r", "r_half", "z", "ratio"),
    _sql(studies.EVENTS_SQL, REFERENCES + " SELECT quantity, grp, reference_kind, vintage, round(r, 5) AS r, round(r_half, 5) AS r_half, round(z, 5) AS z, round(ratio, 5) AS ratio FROM dev"),
)
register(
    "admission_counts",
    lambda s, d: _deviations(s, d).groupBy("quantity", "reference_kind").agg(F.count(F.when(F.col("admitted"), 1)).alias("admitted"), F.count(F.when(~F.col("admitted"), 1)).alias("excluded")),
    _sql(studies.EVENTS_SQL, REFERENCES + " SELECT quantity, reference_kind, count(*) FILTER (admitted) AS admitted, count(*) FILTER (NOT admitted) AS excluded FROM dev GROUP BY quantity, reference_kind"),
)
register(
    "deviation_histogram",
    lambda s, d: diagnostics.histogram(_deviations(s, d).where("admitted"), ["reference_kind", "technique"]),
    _sql(
        studies.EVENTS_SQL,
        REFERENCES + " SELECT reference_kind, technique, CAST(least(floor(abs(z) / 0.5), 10) AS BIGINT) AS bin, count(*) AS n FROM dev WHERE admitted GROUP BY reference_kind, technique, CAST(least(floor(abs(z) / 0.5), 10) AS BIGINT)",
    ),
)


#: A value this close to its group's mean, for the size of both, is at the mean; what a mean's sum leaves to rounding is far less.
AT_MEAN = 1e-9


def side_selection(s, d) -> DataFrame:
    """Deviations where upper and lower half-widths differ: the spread above and below each group's mean.

    Values at the mean are on neither side.
    """
    rows = table(s, d, "events")
    means = rows.groupBy(F.col("event_type").alias("quantity"), F.col("user_id").alias("grp")).agg(F.avg("value").alias("y"))
    e = rows.join(means, (F.col("event_type") == F.col("quantity")) & (F.col("user_id") == F.col("grp")))
    off, least = F.col("value") - F.col("y"), F.lit(AT_MEAN) * (F.abs("value") + F.abs("y"))
    wide = lambda side: F.sqrt(F.avg(F.when(side, off * off)))
    sides = e.groupBy("quantity", "grp", "y").agg(wide(off > least).alias("plus"), wide(off < -least).alias("minus"), F.count(F.lit(1)).alias("n")).where("n >= 5 and plus > 0 and minus > 0")
    centre = rows.groupBy(F.col("event_type").alias("quantity")).agg(F.avg("value").alias("r"))
    return rounded(sides.join(centre, "quantity").select("quantity", "grp", deviation.deviation(F.col("y"), F.col("r"), F.col("plus"), F.col("minus")).alias("z")), 5)


register(
    "side_selection",
    side_selection,
    f"""WITH means AS (SELECT event_type, user_id, avg(value) AS y FROM events GROUP BY ALL),
sides AS (
  SELECT e.event_type AS quantity, e.user_id AS grp, y, sqrt(avg(CASE WHEN value - y > {AT_MEAN!r} * (abs(value) + abs(y)) THEN (value - y) * (value - y) END)) AS plus,
         sqrt(avg(CASE WHEN value - y < -{AT_MEAN!r} * (abs(value) + abs(y)) THEN (value - y) * (value - y) END)) AS minus, count(*) AS n
  FROM events e JOIN means m ON e.event_type = m.event_type AND e.user_id = m.user_id GROUP BY e.event_type, e.user_id, y
), centre AS (SELECT event_type AS quantity, avg(value) AS r FROM events GROUP BY event_type)
SELECT s.quantity, grp, round((y - r) / CASE WHEN y < r THEN plus WHEN y > r THEN minus ELSE greatest(plus, minus) END, 5) + 0.0 AS z
FROM sides s JOIN centre c ON s.quantity = c.quantity WHERE n >= 5 AND plus > 0 AND minus > 0""",
)


def exclusion_accounting(s, d) -> DataFrame:
    rows = studies.order_studies(s, d, least=1).unionByName(
        table(s, d, "orders")
        .join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("quantity"), F.col("o_custkey").alias("grp"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("o_orderpriority").alias("technique"), F.min(F.col("o_orderdate").cast("date")).alias("pub"))
        .where("n = 1"),
        allowMissingColumns=True,
    )
    reasons = [("none-in-source", F.col("v").isNull()), ("too-few", F.col("n") < 5), ("wide", F.col("s") > F.col("y"))]
    return deviation.accounting(deviation.with_reason(rows, reasons), Q)


register(
    "exclusion_accounting",
    exclusion_accounting,
    """WITH g AS (
  SELECT c_mktsegment AS quantity, o_custkey AS grp, count(*) AS n, avg(o_totalprice) AS y, var_samp(o_totalprice) / count(*) AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
) SELECT quantity, CASE WHEN v IS NULL THEN 'none-in-source' WHEN n < 5 THEN 'too-few' WHEN sqrt(v) > y THEN 'wide' ELSE 'kept' END AS reason, count(*) AS n
FROM g WHERE v IS NULL OR v > 0 GROUP BY ALL""",
)


def effective_width(s, d) -> DataFrame:
    """Quoted totals, else components in quadrature: tax and discount shares of a line as components."""
    rows = table(s, d, "lineitem")
    part = lambda name, c: F.struct(F.lit(name).alias("component"), F.col(c).alias("width"))
    with_total = F.when(F.col("l_returnflag") == "R", F.array(part("statistical", "l_tax"), part("total", "l_discount"))).otherwise(F.array(part("statistical", "l_tax"), part("systematic", "l_discount")))
    width = deviation.effective_width(with_total)
    return rows.select("l_returnflag", width.alias("s")).groupBy("l_returnflag").agg(F.count("s").alias("usable"), F.count(F.when(F.col("s").isNull(), 1)).alias("zero_width"), F.round(F.avg("s"), 8).alias("mean_s"))


register(
    "effective_width",
    effective_width,
    """WITH w AS (SELECT l_returnflag, CASE WHEN l_returnflag = 'R' THEN l_discount ELSE sqrt(l_tax * l_tax + l_discount * l_discount) END AS s FROM lineitem)
SELECT l_returnflag, count(*) FILTER (s > 0) AS usable, count(*) FILTER (NOT s > 0) AS zero_width, round(avg(s) FILTER (s > 0), 8) AS mean_s FROM w GROUP BY l_returnflag""",
)

# tensions
K = 2.0
_grid = ", ".join(f"({k!r})" for k in GRID)


def tension_curve(s, d) -> DataFrame:
    """Tensions of the admitted deviations at each k, and how many the admission rule leaves out."""
    every = materialise(_deviations(s, d))
    out = every.groupBy("reference_kind").agg(F.count(F.when(~F.col("admitted"), 1)).alias("excluded"))
    return tension.curve(every.where("admitted"), ["reference_kind"], GRID).join(out, "reference_kind")


register(
    "tension_curve_k",
    tension_curve,
    _sql(
        studies.EVENTS_SQL,
        REFERENCES
        + f""", grid(k) AS (VALUES {_grid}), kinds AS (SELECT reference_kind, count(*) FILTER (NOT admitted) AS excluded FROM dev GROUP BY reference_kind)
SELECT d.reference_kind, CAST(k AS DOUBLE) AS k, count(*) AS scored, CAST(count(*) FILTER (abs(z) >= k) AS BIGINT) AS tensions, any_value(excluded) AS excluded
FROM dev d JOIN kinds n ON d.reference_kind = n.reference_kind CROSS JOIN grid WHERE admitted GROUP BY d.reference_kind, k""",
    ),
)
register(
    "pair_tension_counts",
    lambda s, d: tension.pair_tensions(studies.event_studies(s, d), Q, K),
    _sql(
        studies.EVENTS_SQL,
        f"""p AS (
  SELECT a.quantity, a.grp AS g1, b.grp AS g2, abs(a.y - b.y) / sqrt(a.s * a.s + b.s * b.s) >= {K} AS hit FROM study a JOIN study b ON a.quantity = b.quantity AND a.grp < b.grp
), m AS (
  SELECT quantity, count(DISTINCT g) AS measurements FROM (SELECT quantity, unnest([g1, g2]) AS g FROM p WHERE hit) GROUP BY quantity
) SELECT p.quantity, count(*) AS pairs, count(*) FILTER (hit) AS tensions, coalesce(any_value(measurements), 0) AS measurements, (SELECT count(*) FROM m) AS quantities FROM p LEFT JOIN m ON p.quantity = m.quantity GROUP BY p.quantity""",
    ),
)
SPLIT = """rs AS (
  SELECT quantity, technique, count(y) AS k, min(y) AS y0, sum(1 / v) AS sw, sum(1 / (v * v)) AS sww FROM study GROUP BY quantity, technique
), rm AS (
  SELECT s.quantity, s.technique, sum((y - y0) / v) / any_value(sw) AS off FROM study s JOIN rs t ON s.quantity = t.quantity AND s.technique = t.technique GROUP BY s.quantity, s.technique
), rq AS (
  SELECT s.quantity, s.technique, sum((y - y0 - off) * (y - y0 - off) / v) AS q
  FROM study s JOIN rs t ON s.quantity = t.quantity AND s.technique = t.technique JOIN rm m ON s.quantity = m.quantity AND s.technique = m.technique GROUP BY s.quantity, s.technique
), rt AS (
  SELECT t.quantity, t.technique, k, y0, CASE WHEN k > 1 AND sw - sww / sw <> 0 THEN greatest(0, (q - (k - 1)) / (sw - sww / sw)) ELSE 0 END AS tau2
  FROM rs t JOIN rq ON t.quantity = rq.quantity AND t.technique = rq.technique
), rp AS (
  SELECT s.quantity, s.technique, any_value(k) AS k, any_value(y0) + sum((y - y0) / (v + tau2)) / sum(1 / (v + tau2)) AS e, sqrt(1 / sum(1 / (v + tau2))) AS se
  FROM study s JOIN rt t ON s.quantity = t.quantity AND s.technique = t.technique GROUP BY s.quantity, s.technique
)"""
register(
    "split_tension",
    lambda s, d: rounded(tension.split_tensions(studies.price_studies(s, d), Q, "technique"), 4),
    _sql(
        studies.PRICES_SQL,
        SPLIT + " SELECT a.quantity, a.technique AS first, b.technique AS second, 3 AS least, round(abs(a.e - b.e) / sqrt(a.se * a.se + b.se * b.se), 4) AS apart"
        " FROM rp a JOIN rp b ON a.quantity = b.quantity AND a.technique < b.technique WHERE a.k >= 3 AND b.k >= 3",
    ),
)


def identified_errors(s, d) -> DataFrame:
    """Stand-ins for published identified errors: users with an error event on the last day of all events.

    Two errors or more on that day put a user's tensions on the refuted side, one on the confirmed.
    """
    rows = table(s, d, "events").withColumn("day", F.col("ts").cast("date"))
    last = rows.agg(F.max("day").alias("day"))
    errors = rows.where("event_type = 'error'").join(F.broadcast(last), "day").groupBy(F.col("user_id").alias("grp")).agg(F.when(F.count(F.lit(1)) >= 2, "refuted").otherwise("confirmed").alias("side"))
    return studies.event_studies(s, d).select("quantity", "grp", "technique").join(errors, "grp")


def _judged(s, d) -> tuple[DataFrame, DataFrame]:
    """Tensions of admitted deviations from the accepted value with their outcomes; all that were scored."""
    every = materialise(_deviations(s, d).where("reference_kind = 'modern'"))
    admitted = every.where("admitted")
    return tension.outcomes(admitted.where(F.abs("z") >= K), every, Q, identified_errors(s, d), one_value=True), admitted


OUTCOMES = (
    REFERENCES
    + f""", every AS (
  SELECT * FROM dev WHERE reference_kind = 'modern'
), scored AS (
  SELECT * FROM every WHERE admitted
), errors AS (
  SELECT user_id, CASE WHEN count(*) >= 2 THEN 'refuted' ELSE 'confirmed' END AS side FROM events
  WHERE event_type = 'error' AND CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) GROUP BY user_id
), firsts AS (
  SELECT t.quantity, t.grp, t.technique, t.z,
         min(l.pub) FILTER (l.y >= l.r - l.r_half AND l.y <= l.r + l.r_half) AS agrees,
         min(l.pub) FILTER (CASE WHEN t.z > 0 THEN l.y > l.r + l.r_half ELSE l.y < l.r - l.r_half END) AS sides
  FROM scored t LEFT JOIN scored l ON t.quantity = l.quantity AND l.pub > t.pub WHERE abs(t.z) >= {K} GROUP BY t.quantity, t.grp, t.technique, t.z
), judged AS (
  SELECT quantity, grp, CASE WHEN side IS NOT NULL THEN 'explained' WHEN agrees IS NULL AND sides IS NULL THEN 'unresolved' WHEN sides IS NULL OR agrees <= sides THEN 'refuted' ELSE 'confirmed' END AS outcome,
         CASE WHEN side IS NOT NULL THEN side WHEN agrees IS NULL AND sides IS NULL THEN NULL WHEN sides IS NULL OR agrees <= sides THEN 'refuted' ELSE 'confirmed' END AS counts_as
  FROM firsts LEFT JOIN errors ON grp = user_id
)"""
)
register(
    "outcome_classes",
    lambda s, d: _judged(s, d)[0].groupBy("quantity", "outcome", "counts_as").agg(F.count(F.lit(1)).alias("n")),
    _sql(studies.EVENTS_SQL, OUTCOMES + " SELECT quantity, outcome, counts_as, count(*) AS n FROM judged GROUP BY quantity, outcome, counts_as"),
)

ADMISSION = "reference interval at most one third of the measurement's"


def _judged_by_reference(s, d) -> tuple[DataFrame, DataFrame]:
    """Tensions under each of the four references with their outcomes, each judged by the value it was against; all that were scored."""
    every = materialise(_deviations(s, d))
    admitted = every.where("admitted")
    return materialise(tension.outcomes(admitted.where(F.abs("z") >= K), every, SERIES, _errors_by_reference(s, d))), admitted


SERIES = [*Q, "reference_kind"]


def _errors_by_reference(s, d) -> DataFrame:
    kinds = F.explode(F.array(*[F.lit(k) for k in ("modern", "later", "leave-one-out", "resolved")])).alias("reference_kind")
    return identified_errors(s, d).select("*", kinds)


BY_REFERENCE = (
    REFERENCES
    + f""", scored AS (
  SELECT * FROM dev WHERE admitted
), errors AS (
  SELECT user_id, CASE WHEN count(*) >= 2 THEN 'refuted' ELSE 'confirmed' END AS side FROM events
  WHERE event_type = 'error' AND CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) GROUP BY user_id
), firsts AS (
  SELECT t.quantity, t.reference_kind, t.grp,
         min(l.pub) FILTER (l.y >= t.r - t.r_half AND l.y <= t.r + t.r_half) AS agrees,
         min(l.pub) FILTER (CASE WHEN t.z > 0 THEN l.y > t.r + t.r_half ELSE l.y < t.r - t.r_half END) AS sides
  FROM scored t LEFT JOIN scored l ON t.quantity = l.quantity AND t.reference_kind = l.reference_kind AND l.pub > t.pub WHERE abs(t.z) >= {K} GROUP BY t.quantity, t.reference_kind, t.grp
), judged AS (
  SELECT quantity, reference_kind, grp, CASE WHEN side IS NOT NULL THEN 'explained' WHEN agrees IS NULL AND sides IS NULL THEN 'unresolved' WHEN sides IS NULL OR agrees <= sides THEN 'refuted' ELSE 'confirmed' END AS outcome,
         CASE WHEN side IS NOT NULL THEN side WHEN agrees IS NULL AND sides IS NULL THEN NULL WHEN sides IS NULL OR agrees <= sides THEN 'refuted' ELSE 'confirmed' END AS counts_as
  FROM firsts LEFT JOIN errors ON grp = user_id
)"""
)
register(
    "outcome_classes_by_reference",
    lambda s, d: _judged_by_reference(s, d)[0].groupBy(*SERIES, "outcome", "counts_as").agg(F.count(F.lit(1)).alias("n")),
    _sql(studies.EVENTS_SQL, BY_REFERENCE + " SELECT quantity, reference_kind, outcome, counts_as, count(*) AS n FROM judged GROUP BY ALL"),
)


def probability_structure(s, d) -> DataFrame:
    """The probability under each of the four references, with all its members, as JSON."""
    found = tension.probability(*_judged_by_reference(s, d), SERIES, K, ADMISSION)
    return found.select(*SERIES, F.to_json("probability").alias("probability"))


# the struct's numbers are compared with SQL by probability_by_reference and censoring_bounds
register("probability_structure", probability_structure)


def probability_by_reference(s, d) -> DataFrame:
    """Numbers, period and vintage of the probabilities under each of the four references."""
    p = F.col("probability")
    found = tension.probability(*_judged_by_reference(s, d), SERIES, K, ADMISSION)
    members = {
        "resolved": p["count"], "resolved_share": p["number"]["resolved_only"], "censored_low": p["number"]["censored"]["low"], "censored_high": p["number"]["censored"]["high"], "unresolved": p["unresolved"]["count"],
        "vintage": p["reference"]["vintage"], "period_from": p["period"]["from"], "period_to": p["period"]["to"], "disciplines": F.size(p["disciplines"]).cast("long"),
    }
    return rounded(found.select(*SERIES, *[c.alias(name) for name, c in members.items()]))


register(
    "probability_by_reference",
    probability_by_reference,
    _sql(
        studies.EVENTS_SQL,
        BY_REFERENCE
        + """, n AS (
  SELECT s.quantity, s.reference_kind, count(outcome) AS tensions, count(*) FILTER (outcome = 'unresolved') AS unresolved, count(*) FILTER (counts_as = 'confirmed') AS yes, count(*) FILTER (counts_as = 'refuted') AS no,
         max(vintage) AS vintage, min(pub) AS period_from, max(pub) AS period_to, count(DISTINCT technique) AS disciplines
  FROM scored s LEFT JOIN judged j ON s.quantity = j.quantity AND s.reference_kind = j.reference_kind AND s.grp = j.grp GROUP BY s.quantity, s.reference_kind
) SELECT quantity, reference_kind, yes + no AS resolved, CASE WHEN yes + no > 0 THEN round(CAST(yes AS DOUBLE) / (yes + no), 6) END AS resolved_share, CASE WHEN tensions > 0 THEN round(CAST(yes AS DOUBLE) / tensions, 6) END AS censored_low,
         CASE WHEN tensions > 0 THEN round(CAST(yes + unresolved AS DOUBLE) / tensions, 6) END AS censored_high, unresolved, vintage, period_from, period_to, disciplines FROM n""",
    ),
)


def partly_dated_outcomes(s, d) -> DataFrame:
    """Outcomes of tensions with the series' pool, where dates are years, months or days."""
    scored = materialise(deviation.deviations(deviation.references(partly_dated(s, d), Q).where("reference_kind = 'modern'"), admitted=1.0))
    found = tension.outcomes(scored.where("admitted and abs(z) >= 1"), scored, Q, one_value=True)
    return found.groupBy("quantity", "outcome").agg(F.count(F.lit(1)).alias("n"), F.sum("unordered").alias("unordered"))


register(
    "outcomes_partial_dates",
    partly_dated_outcomes,
    _partly_sql(
        SUMS
        + """, scored AS (
  SELECT s.*, estimate AS r, se AS r_half, (y - estimate) / s.s AS z FROM study s JOIN fixed f ON s.quantity = f.quantity WHERE se / s.s <= 1
), firsts AS (
  SELECT t.quantity, t.grp, min(l.pub) FILTER (l.pub > t.pub_end AND abs(l.y - l.r) <= l.r_half) AS agrees,
         min(l.pub_end) FILTER (l.pub > t.pub_end AND CASE WHEN t.z > 0 THEN l.y > l.r + l.r_half ELSE l.y < l.r - l.r_half END) AS sides,
         count(*) FILTER (l.pub <= t.pub_end AND l.pub_end >= t.pub) - 1 AS unordered
  FROM scored t JOIN scored l ON t.quantity = l.quantity WHERE abs(t.z) >= 1 GROUP BY t.quantity, t.grp
) SELECT quantity, CASE WHEN agrees IS NULL AND sides IS NULL THEN 'unresolved' WHEN sides IS NOT NULL AND (agrees IS NULL OR sides < agrees) THEN 'confirmed' ELSE 'refuted' END AS outcome, count(*) AS n, CAST(sum(unordered) AS BIGINT) AS unordered
FROM firsts GROUP BY ALL"""
    ),
)


def censoring_bounds(s, d) -> DataFrame:
    judged, scored = _judged(s, d)
    judged, p = materialise(judged), F.col("probability")
    n = tension.outcome_counts(judged, scored, Q)
    found = tension.probability(judged, scored, Q, K, ADMISSION).join(n, Q)
    return rounded(
        found.select(
            "quantity", "scored", "tensions", "confirmed", "refuted", "explained", "unresolved", p["count"].alias("resolved"), p["number"]["resolved_only"].alias("resolved_share"), p["interval"]["low"].alias("low"),
            p["interval"]["high"].alias("high"), p["number"]["censored"]["low"].alias("censored_low"), p["number"]["censored"]["high"].alias("censored_high"), p["unresolved"]["share"].alias("unresolved_share"),
        )
    )


_z = normal_quantile(0.975)
register(
    "censoring_bounds",
    censoring_bounds,
    _sql(
        studies.EVENTS_SQL,
        OUTCOMES
        + f""", n AS (
  SELECT s.quantity, count(*) AS scored, count(outcome) AS tensions, count(*) FILTER (outcome = 'confirmed') AS confirmed, count(*) FILTER (outcome = 'refuted') AS refuted,
         count(*) FILTER (outcome = 'explained') AS explained, count(*) FILTER (outcome = 'unresolved') AS unresolved,
         count(*) FILTER (counts_as = 'confirmed') AS yes, count(*) FILTER (counts_as = 'refuted') AS no
  FROM scored s LEFT JOIN judged j ON s.quantity = j.quantity AND s.grp = j.grp GROUP BY s.quantity
), m AS (SELECT *, yes + no AS m, CASE WHEN yes + no > 0 THEN CAST(yes AS DOUBLE) / (yes + no) END AS p FROM n)
SELECT quantity, scored, tensions, confirmed, refuted, explained, unresolved, m AS resolved, round(p, 6) AS resolved_share,
       CASE WHEN m > 0 THEN round((p + {_z * _z!r} / (2 * m)) / (1 + {_z * _z!r} / m) - {_z!r} * sqrt(p * (1 - p) / m + {_z * _z!r} / (4 * m * m)) / (1 + {_z * _z!r} / m), 6) END AS low,
       CASE WHEN m > 0 THEN round((p + {_z * _z!r} / (2 * m)) / (1 + {_z * _z!r} / m) + {_z!r} * sqrt(p * (1 - p) / m + {_z * _z!r} / (4 * m * m)) / (1 + {_z * _z!r} / m), 6) END AS high,
       CASE WHEN tensions > 0 THEN round(CAST(yes AS DOUBLE) / tensions, 6) END AS censored_low,
       CASE WHEN tensions > 0 THEN round(CAST(yes + unresolved AS DOUBLE) / tensions, 6) END AS censored_high,
       CASE WHEN tensions > 0 THEN round(CAST(unresolved AS DOUBLE) / tensions, 6) END AS unresolved_share
FROM m""",
    ),
)
