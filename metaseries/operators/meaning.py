"""Checks that need more than one record: references, arithmetic of units, negligibility."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rules import close


def text_at(field: str) -> Column:
    return F.try_element_at("cells", F.lit(field))["s"]


def number_at(field: str) -> Column:
    return F.try_element_at("cells", F.lit(field))["d"]


def unresolved(parsed: DataFrame, vocabulary: DataFrame, groups: DataFrame) -> DataFrame:
    """``path, field, value`` of references to nothing.

    ``vocabulary (id, techniques, epochs)`` and ``groups (id)``: a record's quantity,
    its technique and epoch among that quantity's, its group, and superseded records.
    """
    quantity = text_at("measurement.quantity")
    rows = parsed.where("parse_error is null").withColumn("quantity", quantity)
    miss = lambda d, field, value: d.where(value.isNotNull()).select("path", F.lit(field).alias("field"), value.alias("value"))
    pairs = lambda column: vocabulary.select(F.col("id").alias("q"), F.explode(column).alias("x"))
    out = [miss(rows.join(vocabulary.select(F.col("id").alias("q")), F.col("quantity") == F.col("q"), "left_anti"), "measurement.quantity", quantity)]
    for field, column in (("method.technique", "techniques"), ("measurement.definition_epoch", "epochs")):
        out.append(miss(rows.join(pairs(column), (F.col("quantity") == F.col("q")) & (text_at(field) == F.col("x")), "left_anti"), field, text_at(field)))
    out.append(miss(rows.join(groups.select(F.col("id").alias("g")), text_at("group.id") == F.col("g"), "left_anti"), "group.id", text_at("group.id")))
    linked = F.filter(F.map_entries("cells"), lambda e: e["value"]["place"].isin("lineage.supersedes[]", "lineage.superseded_by", "superseded_by") & e["value"]["s"].isNotNull())
    targets = rows.select("path", F.explode(linked).alias("e")).select("path", F.col("e.key").alias("field"), F.col("e.value.s").alias("value"))
    out.append(targets.join(parsed.select(F.col("path").alias("value")), "value", "left_anti").select("path", "field", "value"))
    return reduce(DataFrame.unionByName, out)


def denominators(parsed: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``path, problem`` of records whose denominator does not fit their quantity's dimension.

    A dimensionless quantity's record names the quantity it is relative to, or
    ``definitional``; any other record names none.
    """
    own = vocabulary.select(F.col("id").alias("q"), "dimension")
    named = vocabulary.select(F.col("id").alias("named"))
    at = text_at("measurement.denominator_quantity")
    rows = parsed.where("parse_error is null").withColumn("denominator", at).join(F.broadcast(own), text_at("measurement.quantity") == F.col("q")).join(F.broadcast(named), F.col("denominator") == F.col("named"), "left")
    bare, given = F.col("dimension") == "dimensionless", F.col("denominator").isNotNull()
    problem = F.when(bare & ~given, "missing").when(~bare & given, "refused").when(given & (F.col("denominator") != "definitional") & F.col("named").isNull(), "unresolved")
    return rows.select("path", problem.alias("problem")).where("problem is not null")


def unit_mismatch(parsed: DataFrame, relative: float = 1e-9) -> DataFrame:
    """Records whose normalized value is not the published one times the factor."""
    a, f, b = number_at("measurement.published.value"), number_at("measurement.conversion.factor"), number_at("measurement.normalized.value")
    return parsed.where(a.isNotNull() & f.isNotNull() & b.isNotNull() & ~close(a * f, b, relative)).select("path", a.alias("published"), f.alias("factor"), b.alias("normalized"))


def not_negligible(parsed: DataFrame, share: float = 0.01) -> DataFrame:
    """Records that call a factor's uncertainty negligible though it is over ``share`` of the smallest quoted one."""
    value = number_at("measurement.published.value")
    widths = F.filter(F.map_entries("cells"), lambda e: e["value"]["place"].isin("measurement.published.uncertainty[].plus", "measurement.published.uncertainty[].minus") & e["value"]["d"].isNotNull())
    least = F.array_min(F.transform(widths, lambda e: F.abs(F.try_divide(e["value"]["d"], value))))
    factor = number_at("measurement.conversion.factor_relative_uncertainty")
    return parsed.where((text_at("measurement.conversion.imported_uncertainty") == "negligible") & (factor > share * least)).select("path", factor.alias("factor"), least.alias("smallest"))


def misplaced_conversion(parsed: DataFrame) -> DataFrame:
    """Records with a ``unit-conversion`` component among the published ones."""
    found = F.exists(F.map_values("cells"), lambda c: (c["place"] == "measurement.published.uncertainty[].label") & (c["s"] == "unit-conversion"))
    return parsed.where(found).select("path")


def components(parsed: DataFrame) -> DataFrame:
    """``path, block, pos, component, plus, minus, cov_kind, cov_value`` of each uncertainty component."""
    blocks = ("measurement.published.uncertainty", "measurement.normalized.uncertainty")
    entry = F.filter(F.map_entries("cells"), lambda e: e["value"]["place"].isin([b + "[]" for b in blocks]) & (e["value"]["kind"] == "table"))
    rows = parsed.select("path", "cells", F.explode(entry).alias("e")).select("path", "cells", F.col("e.key").alias("at"))
    part = lambda name: F.try_element_at(F.col("cells"), F.concat("at", F.lit("." + name)))
    coverage = part("coverage")["s"]
    return rows.select(
        "path",
        F.regexp_extract("at", r"^(.*)\[", 1).alias("block"),
        F.regexp_extract("at", r"\[(\d+)\]$", 1).cast("int").alias("pos"),
        part("component")["s"].alias("component"),
        part("plus")["d"].alias("plus"),
        part("minus")["d"].alias("minus"),
        F.regexp_extract(coverage, "^([a-z]+)", 1).alias("cov_kind"),
        F.regexp_extract(coverage, "=(.*)$", 1).try_cast("double").alias("cov_value"),
    )
