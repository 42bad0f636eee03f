"""Structural validation of records against their schema, as rows of refusals.

Everything about a record is in its own row (a map of cells), and everything about a
schema is in small literal tables, so all checks are predicates and broadcast joins
over these tables, whose size is the schema's; nothing is shuffled until the refusals
are put in order.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaseries.sources.schemas import Schema, describe_condition, printed
from metaseries.sources.tables import materialise

from .rules import date_precision, whole

#: Every kind of refusal.
SITES = {
    "record-in-the-wrong-place": "a file under record/ whose path is not that of a record",
    "record-does-not-parse": "a file that is not TOML",
    "schema-version": "a record without a loaded schema version",
    "unknown-field": "a field that the schema does not declare",
    "missing-required-field": "a required field that is absent",
    "conditional-field-missing": "a field that the record's own values require",
    "conditional-field-refused": "a field that the record's own values rule out",
    "wrong-type": "a value of another type than declared",
    "malformed-value": "a text that does not have its declared form",
    "value-outside-set": "a value that is not among the declared ones",
    "below-minimum": "a number under its least value",
    "list-too-short": "a list with fewer items than declared",
    "duplicate-in-list": "an item that its list has already",
    "no-member-present": "a block in which none of its alternatives is present",
}
REFUSAL = ("site", "file", "field", "found", "expected")

_article = {"string": "a text", "int": "a whole number", "float": "a number with a decimal point", "bool": "true or false", "table": "a table", "array": "a list", "datetime": "a date-time"}


def excluded(path: Column, prefix: str) -> Column:
    """Whether any folder of a path, its file name left out, begins with ``prefix``; "" excludes nothing."""
    if not prefix:
        return F.lit(False)
    parts = F.split(path, "/")
    return F.exists(F.slice(parts, 1, F.size(parts) - 1), lambda p: p.startswith(prefix))


def parent_folder(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def _named(field: Column) -> Column:
    """A field for reading: without the escapes."""
    return F.regexp_replace(field, r"\\(.)", "$1")


def _describe(cell: Column) -> Column:
    kinds = F.create_map(*[F.lit(x) for pair in _article.items() for x in pair])
    value = F.when(cell["kind"].isin("string", "int", "float", "bool"), F.concat(F.lit(" "), cell["repr"])).otherwise("")
    return F.concat(F.coalesce(kinds[cell["kind"]], F.lit("a value")), value)


_CONDITION = "struct<field:string,root:boolean,op:string,values:array<string>,text:string>"
_RULE = (
    "place string, container string, name string, need string, type string, kinds array<string>, pattern string, most_bytes int, precisions array<string>, `values` array<string>,"
    f" literals array<string>, minimum double, min_length int, checkable boolean, required_when {_CONDITION}, refused_when {_CONDITION}, block_needs array<string>, distinct_items boolean, holds_members boolean"
)
_kind_of = {"string": "string", "integer": "int", "boolean": "bool", "float": "float"}
_expected = {"string": "a text", "int": "a whole number", "bool": "true or false", "float": "a number with a decimal point", "array": "a list", "table": "a table"}


def _condition_row(c: dict | None) -> tuple | None:
    """A condition as data; none where the record alone can't decide it, or it never holds."""
    if c is None or c.get("never") or "vocabulary" in c or "source_stated" in c:
        return None
    op = next(o for o in ("equals", "not_equals", "in", "present", "absent") if o in c)
    values = [printed(v) for v in (c["in"] if op == "in" else [c[op]] if op in ("equals", "not_equals") else [])]
    return c["field"], "." in c["field"], "in" if op == "equals" else op, values, describe_condition(c)


def rule_rows(schema: Schema) -> list[tuple]:
    """The schema as rows: one for each place a value can stand."""
    out = []
    for r in schema.rules():
        base, item = schema.base(r.type), schema.element(r.type)
        scalar = schema.scalars.get(base, {})
        container = schema.is_container(r.type)
        checkable = item is not None or container or base in (*_kind_of, "any") or "pattern" in scalar or "precisions" in scalar
        kinds = ["array"] if item is not None else ["table"] if container else [_kind_of[base]] if base in _kind_of else ["string"] if "pattern" in scalar or "precisions" in scalar else None
        required = _condition_row(r.rule.get("required_when")) if r.rule.get("decidable", True) else None
        minimum = r.rule.get("minimum")
        out.append((
            r.place, r.container if not r.element else None, r.name, r.need, r.type, kinds, whole(scalar["pattern"]) if "pattern" in scalar else None, scalar.get("most_bytes"), scalar.get("precisions"), r.rule.get("values"),
            r.rule.get("literals"), None if minimum is None else float(minimum), r.rule.get("min_length"), checkable, required, _condition_row(r.rule.get("refused_when")), schema.at_least_one_of.get(r.type),
            item not in (None, "string"), container,
        ))
    return out


def _member(block: Column, name: Column) -> Column:
    return F.when(block == "", name).otherwise(F.concat(block, F.lit("."), name))


def holds(c: Column, cells: Column, block: Column) -> Column:
    """Whether a condition holds; one that is undecidable (null) does not.

    A dotted name is looked up from the record's root, a bare one in the enclosing block.
    """
    cell = F.try_element_at(cells, F.when(c["root"], c["field"]).otherwise(_member(block, c["field"])))
    found = (
        F.when(c["op"] == "present", cell.isNotNull())
        .when(c["op"] == "absent", cell.isNull())
        .when(c["op"] == "in", F.array_contains(c["values"], cell["repr"]))
        .otherwise(cell["repr"] != F.get(c["values"], F.lit(0)))
    )
    return F.coalesce(found, F.lit(False))


def _under(field: Column, fields: Column, itself: bool) -> Column:
    deeper = F.exists(fields, lambda s: field.startswith(F.concat(s, F.lit("."))) | field.startswith(F.concat(s, F.lit("["))))
    return deeper | F.array_contains(fields, field) if itself else deeper


def _refusals(rows: DataFrame, site: str | Column, field: Column, found: Column, expected: Column) -> DataFrame:
    site = F.lit(site) if isinstance(site, str) else site
    return rows.select(site.alias("site"), F.col("path").alias("file"), _named(field).alias("field"), found.alias("found"), expected.alias("expected"))


def structure(records: DataFrame, schema: Schema) -> DataFrame:
    """Refusals of parsed ``records (path, cells)`` that are all of ``schema``'s version."""
    spark = records.sparkSession
    rules = F.broadcast(spark.createDataFrame(rule_rows(schema), _RULE))
    interiors = schema.interiors()
    containers = ["", *sorted({r.place for r in schema.rules() if schema.is_container(r.type)})]
    cells = F.col("cells")

    # the blocks of a record, and the fields in them that are present though ruled out; what is in those is not checked
    tables = F.filter(F.map_entries("cells"), lambda e: (e["value"]["kind"] == "table") & e["value"]["place"].isin(containers[1:]))
    blocks = F.concat(F.array(F.struct(F.lit("").alias("block"), F.lit("").alias("at"))), F.transform(tables, lambda e: F.struct(e["key"].alias("block"), e["value"]["place"].alias("at"))))
    names = ("field", "root", "op", "values", "text")
    refusing = [{"container": r[1], "name": r[2], "c": dict(zip(names, r[15], strict=True))} for r in rule_rows(schema) if r[15] is not None]
    refusing = F.from_json(F.lit(json.dumps(refusing)), f"array<struct<container:string,name:string,c:{_CONDITION}>>")
    ruled_out = lambda b: F.transform(
        F.filter(refusing, lambda r: (r["container"] == b["at"]) & F.try_element_at(cells, _member(b["block"], r["name"])).isNotNull() & holds(r["c"], cells, b["block"])), lambda r: _member(b["block"], r["name"])
    )
    held = records.select("path", "cells").withColumn("blocks", blocks).withColumn("refused", F.flatten(F.transform("blocks", ruled_out)))
    out = []

    # presence: the members of each block that is there
    here = held.select("path", "cells", "refused", F.explode("blocks").alias("b")).select("*", "b.block", "b.at").where(~_under(F.col("block"), F.col("refused"), itself=True))
    members = here.join(rules.where("container is not null and need <> 'optional'"), F.col("at") == F.col("container"))
    field = _member(F.col("block"), F.col("name"))
    cell = F.try_element_at(cells, field)
    wanted = F.concat_ws(", of type ", "name", "type")
    problem = lambda site, found, expected: F.struct(F.lit(site).alias("site"), found.alias("found"), expected.alias("expected"))
    nothing = F.lit("nothing")
    presence = (
        F.when((F.col("need") == "required") & cell.isNull(), problem("missing-required-field", nothing, wanted))
        .when(cell.isNull() & F.col("required_when").isNotNull() & holds(F.col("required_when"), cells, F.col("block")), problem("conditional-field-missing", nothing, F.concat_ws(", as ", wanted, "required_when.text")))
        .when(cell.isNotNull() & F.array_contains("refused", field), problem("conditional-field-refused", _describe(cell), F.concat(F.lit("no "), F.col("name"), F.lit(", as "), F.col("refused_when.text"))))
    )
    found = members.select("path", field.alias("field"), presence.alias("r")).where("r is not null")
    out.append(_refusals(found, F.col("r.site"), F.col("field"), F.col("r.found"), F.col("r.expected")))
    needy = here.join(rules.where("block_needs is not null").select("place", "block_needs"), F.col("at") == F.col("place"))
    none = ~F.exists("block_needs", lambda n: F.try_element_at(cells, F.concat("block", F.lit("."), n)).isNotNull())
    out.append(_refusals(needy.where(none), "no-member-present", F.col("block"), F.lit("none of them"), F.concat(F.lit("at least one of "), F.array_join("block_needs", ", "))))

    # values: each cell once, with all that is wrong with it
    entries = held.select("path", "cells", "refused", F.explode("cells").alias("field", "cell")).where(~_under(F.col("field"), F.col("refused"), itself=False))
    typed = entries.join(rules, F.col("cell.place") == F.col("place"), "left")
    cell, declared = F.col("cell"), F.col("place").isNotNull()
    checked = ~F.array_contains("refused", F.col("field"))
    problem = lambda site, field, found, expected: F.struct(F.lit(site).alias("site") if isinstance(site, str) else site.alias("site"), field.alias("field"), found.alias("found"), expected.alias("expected"))

    # undeclared keys of tables whose keys are declared, and tables in between that are none
    parent = F.when(cell["parent"] == "", F.lit("")).otherwise(F.try_element_at(cells, cell["parent"])["place"])
    unknown = checked & ~declared & ~cell["place"].isin(interiors) & (cell["key"] != "") & parent.isin([*containers, *interiors])
    between = cell["place"].isin(interiors) & (cell["kind"] != "table")
    expected_kind = F.create_map(*[F.lit(x) for pair in _expected.items() for x in pair])[F.get("kinds", F.lit(0))]
    bad = lambda site, expected: F.struct(F.lit(site).alias("site"), expected.alias("expected"))
    verdict = (
        F.when(~(checked & declared), None)
        .when(~F.col("checkable"), bad("wrong-type", F.concat(F.lit("a type that can be checked, not "), F.col("type"))))
        .when(F.coalesce(F.array_contains("literals", cell["s"]), F.lit(False)), None)
        .when(F.col("kinds").isNotNull() & ~F.array_contains("kinds", cell["kind"]), bad("wrong-type", F.concat_ws(", for ", expected_kind, "type")))
        .when(F.col("pattern").isNotNull() & ~F.expr("cell.s RLIKE pattern"), bad("malformed-value", F.concat(F.lit("a text of the form "), F.col("pattern"))))
        .when(F.octet_length(cell["s"]) > F.col("most_bytes"), bad("malformed-value", F.concat_ws(" ", F.lit("at most"), F.col("most_bytes").cast("string"), F.lit("characters"))))
        .when(F.col("precisions").isNotNull() & ~F.coalesce(F.array_contains("precisions", date_precision(cell["s"])), F.lit(False)), bad("malformed-value", F.concat(F.lit("an existing date by "), F.array_join("precisions", " or "))))
        .when(~F.array_contains("values", cell["repr"]), bad("value-outside-set", F.concat(F.lit("one of "), F.array_join("values", ", "))))
        .when(~F.isnan(cell["d"]) & (cell["d"] < F.col("minimum")), bad("below-minimum", F.concat(F.col("minimum").cast("string"), F.lit(" or more"))))
        .when(cell["n"] < F.col("min_length"), bad("list-too-short", F.concat_ws(" ", F.lit("at least"), F.col("min_length").cast("string"), F.lit("item(s)"))))
    )
    found = F.when(cell["kind"] == "array", F.concat_ws(" ", cell["n"].cast("string"), F.lit("item(s)"))).otherwise(_describe(cell))
    # repeated items, of lists other than of plain texts
    at = lambda i: F.concat("field", F.lit("["), i.cast("string"), F.lit("]"))
    items = F.transform(F.sequence(F.lit(0), cell["n"] - 1), lambda i: F.struct(i.alias("i"), F.try_element_at(cells, at(i))["repr"].alias("item")))
    again = F.filter(items, lambda x: F.exists(items, lambda y: (y["i"] < x["i"]) & (y["item"] == x["item"])))
    repeats = F.when(
        checked & F.col("distinct_items") & (cell["kind"] == "array") & (cell["n"] > 1),
        F.transform(again, lambda x: problem("duplicate-in-list", at(x["i"]), x["item"], F.lit("an item that the list does not have yet"))),
    )
    first = F.array(
        F.when(unknown, problem("unknown-field", F.col("field"), _describe(cell), F.lit("a declared field"))),
        F.when(between, problem("wrong-type", F.col("field"), _describe(cell), F.lit("a table"))),
        F.when(F.col("verdict").isNotNull(), problem(F.col("verdict.site"), F.col("field"), found, F.col("verdict.expected"))),
    )
    wrong = typed.withColumn("verdict", verdict).select("path", F.concat(F.filter(first, F.isnotnull), F.coalesce(repeats, F.array())).alias("problems"))
    each = wrong.where(F.size("problems") > 0).select("path", F.explode("problems").alias("r"))
    out.append(_refusals(each, F.col("r.site"), F.col("r.field"), F.col("r.found"), F.col("r.expected")))
    return reduce(DataFrame.unionByName, out)


def validate_records(parsed: DataFrame, schemas: dict[int, Schema]) -> DataFrame:
    """Refusals of parsed records; ``in_order`` sorts them for reading.

    The records are written once, as several checks read them.
    """
    parsed = materialise(parsed.select("path", "parse_error", "cells"))
    versions = ", ".join(map(str, schemas))
    broken = parsed.where("parse_error is not null").select(F.lit("record-does-not-parse").alias("site"), F.col("path").alias("file"), F.lit("").alias("field"), F.col("parse_error").alias("found"), F.lit("TOML").alias("expected"))
    good = parsed.where("parse_error is null").withColumn("v", F.try_element_at("cells", F.lit("schema_version")))
    version = F.when(F.col("v.kind") == "int", F.col("v.l"))
    known = F.coalesce(version.isin(list(schemas)), F.lit(False))
    unread = _refusals(good.where(~known), "schema-version", F.lit("schema_version"), F.coalesce(_describe(F.col("v")), F.lit("nothing")), F.lit(f"a loaded version: {versions}"))
    out = [broken, unread, *(structure(good.where(F.coalesce(version == n, F.lit(False))), schema) for n, schema in schemas.items())]
    return reduce(DataFrame.unionByName, out).select(*REFUSAL)


def in_order(refusals: DataFrame) -> DataFrame:
    """By file, field, site and what was found."""
    return refusals.select(*REFUSAL).orderBy("file", "field", "site", "found", "expected")


def validate_tree(files: DataFrame, parsed: DataFrame, schemas: dict[int, Schema]) -> tuple[DataFrame, DataFrame]:
    """Refusals of a whole tree, and one row of its counts.

    ``files (path)`` are all files; ``parsed`` those that are records' own. Files in
    excluded folders are only counted, others off the path pattern are refused.
    """
    low = schemas[min(schemas)]
    away = excluded(F.col("path"), low.excluded_prefix)
    placed = F.col("path").rlike(whole(low.record_path))
    wrong = files.where(~away & ~placed).select(F.lit("record-in-the-wrong-place").alias("site"), F.col("path").alias("file"), F.lit("").alias("field"), F.col("path").alias("found"), F.lit(f"a path of the form {low.record_path}").alias("expected"))
    own = parsed.where(~excluded(F.col("path"), low.excluded_prefix) & F.col("path").rlike(whole(low.record_path)))
    counts = files.agg(
        F.count_if(~away & placed).alias("records"), F.count_if(away).alias("skipped"), F.array_sort(F.collect_set(F.when(away, parent_folder(F.col("path"))))).alias("excluded")
    )
    return validate_records(own, schemas).unionByName(wrong), counts
