"""Command line: validate, schema, build, reproduce, freeze, compare, refusals, meaning, analyse, gate."""

from __future__ import annotations

import argparse
import os
import sys

from metaseries.operators import analysis, artifact, meaning, pooling, validate
from metaseries.operators import gate as checks
from metaseries.plans import legs
from metaseries.sources import records, schemas, vocabulary


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("metaseries").getOrCreate()


def _meaning(spark, root: str, own) -> int:
    """What takes more than one record to see; a line for each."""
    quantities, groups = vocabulary.quantities(spark, root).cache(), vocabulary.groups(spark, root).cache()
    found = 0
    lines = [
        quantities.where("problem is not null").selectExpr("concat(path, ': ', problem) as line"),
        groups.where("problem is not null").selectExpr("concat(path, ': ', problem) as line"),
        meaning.unresolved(own, quantities, groups).selectExpr("concat(path, ': ', field, ': nothing is named ', value) as line"),
        meaning.denominators(own, quantities).selectExpr("concat(path, ': measurement.denominator_quantity: ', problem) as line"),
        meaning.unit_mismatch(own).selectExpr("concat(path, ': ', published, ' times ', factor, ' is not ', normalized) as line"),
        meaning.not_negligible(own).selectExpr("concat(path, ': a factor uncertainty of ', factor, ' is not negligible beside ', smallest) as line"),
        meaning.misplaced_conversion(own).selectExpr("concat(path, ': a unit-conversion component among the published ones') as line"),
    ]
    for kind in lines:
        for row in kind.orderBy("line").toLocalIterator():
            print(row.line)
            found += 1
    return int(found > 0)


def _analyse(own, quantities, schema, provenance, options) -> int:
    """Pooled estimates of each quantity and epoch, led by the confirmation breakdown and ended by the stamp with what was left out."""
    judged = analysis.judged(analysis.measurements(own), options).cache()
    kept = judged.where("reason = 'kept'").count()
    excluded = {r.reason: r.n for r in judged.where("reason <> 'kept'").groupBy("reason").count().withColumnRenamed("count", "n").collect()}  # few reasons
    stamp = artifact.Artifact(own, artifact.stamp_of(provenance, "analyse", analysis.options_stamp(judged, options), "all", kept, excluded), schema).stamp
    for row in analysis.confirmation_breakdown(judged).orderBy("quantity").toLocalIterator():
        print(f"{row.quantity}: {row.confirmed} confirmed, {row.unconfirmed} unconfirmed, {row.disputed} disputed left out")
    series = analysis.studies(judged, quantities).cache()
    for line in pooling.pool_random(series, ["quantity", "epoch"]).orderBy("quantity", "epoch").toJSON().toLocalIterator():
        print(line)
    sys.stdout.write(artifact.plain_stamp(stamp))
    return 0


def _gate(spark, loaded, args) -> int:
    """A line for each leg, with its problems below."""
    inputs = legs.Inputs(args.profile, args.sites, tuple(args.surface), args.floor, args.imports, args.module)
    every = legs.legs(spark, args.root, loaded, inputs, os.path.relpath(args.out, args.root) if os.path.isabs(args.out) else args.out)
    outcomes = checks.run(checks.select(every, args.leg))
    for o in outcomes:
        print(f"{o.state:<8}{o.name}" + (f": {o.examined} examined" if o.state == "passed" else ""))
        for problem in o.problems:
            print("        " + problem)
    print(checks.tally(outcomes))
    return int(any(o.state == "failed" for o in outcomes))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="metaseries", description=__doc__)
    parser.add_argument("verb", choices=["validate", "schema", "build", "reproduce", "freeze", "compare", "refusals", "meaning", "analyse", "gate"])
    parser.add_argument("--root", default=".", help="the folder that holds record/")
    parser.add_argument("--schemas", default=str(schemas.FOLDER))
    parser.add_argument("--out", default="build")
    parser.add_argument("--selection", default="all", help="build: a SQL condition on path, fields and cells")
    parser.add_argument("--confirmed-only", action="store_true", help="analyse: only records that a second reader confirmed")
    parser.add_argument("--assume-coverage", help="analyse: a coverage such as k=1 where a source states none")
    parser.add_argument("--leg", action="append", default=[], help="gate: only the leg of this name; may be repeated")
    parser.add_argument("--profile", help="gate: a coverage profile")
    parser.add_argument("--sites", help="gate: a listing of refusal sites, JSON lines of file, line and site")
    parser.add_argument("--surface", action="append", default=[], help="gate: a package whose coverage is judged; may be repeated")
    parser.add_argument("--floor", type=float, default=85.0, help="gate: the least percentage of statements")
    parser.add_argument("--imports", help="gate: a listing of packages and their imports, JSON lines")
    parser.add_argument("--module", help="gate: the module whose packages must not reach the network")
    args = parser.parse_args(argv)
    loaded = schemas.load(args.schemas)
    if args.verb == "schema":
        sys.stdout.write(schemas.print_schema(loaded))
        return 0
    if args.verb == "refusals":
        for site, text in validate.SITES.items():
            print(f"{site:<28}{text}")
        return 0
    spark = _session()
    if args.verb == "gate":
        return _gate(spark, loaded, args)
    files = records.read_tree(spark, args.root).cache()
    parsed = records.parse_records(files).cache()
    refusals, counts = validate.validate_tree(files, parsed, loaded)
    refusals = refusals.cache()
    count = counts.first()
    if args.verb == "validate":
        found = 0
        for r in validate.in_order(refusals).toLocalIterator():
            found += 1
            print(f"{r.file}: {r.field}: found {r.found}, expected {r.expected} [{r.site}]")
        print(f"{count.records} record(s), {count.skipped} skipped in {list(count.excluded)}, {found} refusal(s).")
        return int(found > 0)
    low = schemas.lowest(loaded)
    own = parsed.where(~validate.excluded(parsed.path, low.excluded_prefix))
    frozen = os.path.join(args.out, "readings")
    left_out = {"excluded folder": count.skipped} if count.skipped else {}
    if args.verb == "build":
        made = artifact.build(own, refusals, left_out, low, artifact.git_provenance(args.root), selection=args.selection)
        print("\n".join(artifact.write_all(made, args.out)))
        return 0
    if args.verb == "reproduce":

        def rebuild(folder: str, stamp: dict) -> artifact.Provenance:
            provenance = artifact.git_provenance(args.root)
            artifact.write_all(artifact.build(own, refusals, left_out, low, provenance, stamp["command"], stamp["options"], stamp["selection"]), folder)
            return provenance

        differ = artifact.reproduce(args.out, rebuild)
        print("\n".join(f"{n}: other bytes" for n in differ) or "the same bytes")
        return int(bool(differ))
    if args.verb == "meaning":
        return _meaning(spark, args.root, own)
    if args.verb == "analyse":
        options = analysis.Options(args.confirmed_only, args.assume_coverage)
        return _analyse(own, vocabulary.quantities(spark, args.root), low, artifact.git_provenance(args.root), options)
    current = artifact.readings(own, refusals)
    if args.verb == "freeze":
        current.write.mode("overwrite").json(frozen)
        return 0
    changed = 0
    for row in artifact.reading_changes(spark.read.schema("file string, reading string").json(frozen), current).toLocalIterator():
        print(f"{row.file}: {row.change}")
        changed += 1
    return int(changed > 0)


if __name__ == "__main__":
    sys.exit(main())
