"""Queries that run the record machinery over whole tables: studies written as records, read back, refused or pooled.

A record's text is made from a study's row, with defects and states where its number of
values says so; SQL states what must come of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaseries.functions.quantiles import normal_quantile
from metaseries.operators import analysis, pooling, validate
from metaseries.sources import records, schemas, studies
from metaseries.sources.tables import materialise

from .registry import register

_template = """schema_version = %(version)s
status = "active"
blinding = "%(blinding)s"
group.id = "user-%(grp)s"
measurement.quantity = "%(quantity)s"
measurement.definition_epoch = "%(epoch)s"
measurement.normalization_status = "normalized"
measurement.published = { value = %(y)s, unit = "1", uncertainty_status = "%(widths)s"%(parts)s }
measurement.normalized = { value = %(y)s, unit = "1"%(parts)s }
measurement.conversion = { factor = 1.0, exact = true, factor_source = "none" }
publication = { date = "%(pub)s", data_taken_status = "none-in-source" }
%(method)s
source = { statement_kind = "%(kind)s", directness = "primary", confirmation = "%(confirmation)s", identifier = [{ scheme = "url", value = "%(grp)s" }%(again)s], locator = { page = "1" } }
"""
_part = ', uncertainty = [{ component = "total", plus = %(plus)s, minus = %(s)s, coverage = "%(coverage)s", interval_kind = "unstated" }]'


def _filled(template: str, columns: dict) -> F.Column:
    """``template`` with columns in its places."""
    out, rest = [], template
    while "%(" in rest:
        head, _, tail = rest.partition("%(")
        name, _, rest = tail.partition(")s")
        out += [F.lit(head), columns[name].cast("string")]
    return F.concat(*out, F.lit(rest))


def study_records(s, d, defects: bool) -> DataFrame:
    """``path, text`` of a record for each event study; with ``defects``, some that are refused."""
    n = F.col("n")
    bad = lambda condition, wrong, right: F.when(condition, wrong).otherwise(right) if defects else F.lit(right) if isinstance(right, str) else right
    columns = {k: F.col(k) for k in ("grp", "quantity", "y", "s", "pub")} | {
        "version": bad(n == 9, F.lit("7"), "1"),
        "blinding": bad(n == 6, F.lit("perhaps"), "not-stated"),
        "epoch": F.when(F.col("technique") == "t0", "first").otherwise("second"),
        "widths": F.when(n == 7, "none-in-source").otherwise("reported"),
        "plus": bad(n == 8, -F.col("s"), F.col("s")),
        "coverage": F.when(n == 5, "unstated").when(n == 10, "cl=95").otherwise("k=1"),
        "method": bad(n == 11, F.lit('method.note = "none"'), 'method.technique = "any"'),
        "kind": F.when(n >= 14, "combined-fit").otherwise("primary-result"),
        "confirmation": F.when(n == 13, "disputed").otherwise("unconfirmed"),
        "again": bad(n == 12, F.concat(F.lit(', { scheme = "url", value = "'), F.col("grp").cast("string"), F.lit('" }')), ""),
    }
    columns["parts"] = F.when(n == 7, "").otherwise(_filled(_part, columns))
    path = F.concat(F.lit("record/"), "quantity", F.lit("/1900-user-"), F.col("grp").cast("string"), F.lit(".toml"))
    return studies.event_studies(s, d).select(path.alias("path"), _filled(_template, columns).cast("binary").alias("text"))


def record_refusals(s, d) -> DataFrame:
    """Refusals of the records with defects, by site and field."""
    found = validate.validate_records(records.parse_records(study_records(s, d, defects=True)), schemas.load())
    return found.groupBy("site", "field").agg(F.count(F.lit(1)).alias("n"))


register(
    "record_refusals",
    record_refusals,
    f"""WITH {studies.EVENTS_SQL}, found AS (
  SELECT n, unnest(CASE n WHEN 9 THEN ['schema-version/schema_version'] WHEN 6 THEN ['value-outside-set/blinding'] WHEN 11 THEN ['missing-required-field/method.technique'] WHEN 12 THEN ['duplicate-in-list/source.identifier[1]']
    WHEN 8 THEN ['below-minimum/measurement.published.uncertainty[0].plus', 'below-minimum/measurement.normalized.uncertainty[0].plus'] ELSE [] END) AS r FROM study
) SELECT split_part(r, '/', 1) AS site, split_part(r, '/', 2) AS field, count(*) AS n FROM found GROUP BY r""",
)


def _judged(s, d) -> DataFrame:
    return materialise(analysis.judged(analysis.measurements(records.parse_records(study_records(s, d, defects=False)))))


register(
    "record_exclusions",
    lambda s, d: analysis.excluded_counts(_judged(s, d)),
    f"""WITH {studies.EVENTS_SQL} SELECT quantity, CASE WHEN n = 13 THEN 'disputed' WHEN n >= 14 THEN 'combined-fit' WHEN n = 7 THEN 'none-in-source' WHEN n = 5 THEN 'coverage-unstated' ELSE 'kept' END AS reason, count(*) AS n
FROM study GROUP BY ALL""",
)


def record_pool(s, d) -> DataFrame:
    """The pooled estimate of each quantity and epoch, from the kept records."""
    found = pooling.pool_random(analysis.studies(_judged(s, d)), ["quantity", "epoch"])
    return found.select("quantity", "epoch", "k", *[F.round(c, 6).alias(c) for c in ("q", "tau2", "estimate", "se")])


_z = normal_quantile(0.975)
register(
    "record_pool",
    record_pool,
    f"""WITH {studies.EVENTS_SQL}, kept AS (
  SELECT quantity, CASE WHEN technique = 't0' THEN 'first' ELSE 'second' END AS epoch, y, CASE WHEN n = 10 THEN v / ({_z!r} * {_z!r}) ELSE v END AS v FROM study WHERE n NOT IN (5, 7, 13) AND n < 14
), a AS (
  SELECT quantity, epoch, count(*) AS k, min(y) AS y0, sum(1 / v) AS sw, sum(1 / (v * v)) AS sww FROM kept GROUP BY quantity, epoch
), b AS (
  SELECT s.quantity, s.epoch, sum((y - y0) / v) / any_value(sw) AS off FROM kept s JOIN a ON s.quantity = a.quantity AND s.epoch = a.epoch GROUP BY s.quantity, s.epoch
), c AS (
  SELECT s.quantity, s.epoch, sum((y - y0 - off) * (y - y0 - off) / v) AS q FROM kept s JOIN a ON s.quantity = a.quantity AND s.epoch = a.epoch JOIN b ON s.quantity = b.quantity AND s.epoch = b.epoch GROUP BY s.quantity, s.epoch
), t AS (
  SELECT a.quantity, a.epoch, k, y0, q, CASE WHEN k > 1 AND sw - sww / sw <> 0 THEN greatest(0, (q - (k - 1)) / (sw - sww / sw)) ELSE 0 END AS tau2 FROM a JOIN c ON a.quantity = c.quantity AND a.epoch = c.epoch
) SELECT s.quantity, s.epoch, any_value(k) AS k, round(any_value(q), 6) AS q, round(any_value(tau2), 6) AS tau2, round(any_value(y0) + sum((y - y0) / (v + tau2)) / sum(1 / (v + tau2)), 6) AS estimate, round(sqrt(1 / sum(1 / (v + tau2))), 6) AS se
FROM kept s JOIN t ON s.quantity = t.quantity AND s.epoch = t.epoch GROUP BY s.quantity, s.epoch""",
)
