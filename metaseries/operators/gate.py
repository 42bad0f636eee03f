"""The repository's own checks: legs that run in order, and stop at the first that fails."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaseries.sources.records import parse_records
from metaseries.sources.schemas import Schema

from .artifact import readings
from .compare import reach, symmetric_difference
from .validate import validate_records


@dataclass(frozen=True)
class Leg:
    """A check: ``run`` gives its problems, a row each with the text ``problem``, and how many things it looked at."""

    name: str
    run: Callable[[], tuple[DataFrame, int]] | None = None
    #: Whether it fails where there is nothing to look at.
    needs_some: bool = True
    #: What it lacks, where it can't be run.
    owed: str = ""


@dataclass(frozen=True)
class Outcome:
    name: str
    state: str
    examined: int = 0
    problems: tuple[str, ...] = ()


def select(legs: Iterable[Leg], names: Iterable[str]) -> list[Leg]:
    """The legs of these names, in their own order; all for no names. An unknown name is an error that lists the known."""
    legs, names = list(legs), set(names)
    unknown = names - {leg.name for leg in legs}
    if unknown:
        raise ValueError(f"no leg {', '.join(sorted(unknown))}; there are {', '.join(leg.name for leg in legs)}")
    return [leg for leg in legs if not names or leg.name in names]


def run(legs: Iterable[Leg], shown: int = 20) -> list[Outcome]:
    """Each leg's outcome: passed, failed, or not run, as one before it failed or as something is owed.

    ``shown`` problems at most are kept. No legs at all, or one with neither or both of a
    check and something owed, is an error before any runs.
    """
    out, stopped, legs = [], False, list(legs)
    if not legs:
        raise ValueError("there is no leg to run")
    for leg in legs:
        if (leg.run is None) == (not leg.owed):
            raise ValueError(f"leg {leg.name} must have either a check or what it lacks")
    for leg in legs:
        if stopped or leg.run is None:
            out.append(Outcome(leg.name, "not run", problems=(leg.owed,) if leg.owed else ()))
            continue
        try:
            problems, examined = leg.run()
            found = tuple(r.problem for r in problems.orderBy("problem").limit(shown).collect())
        except (ValueError, OSError) as e:
            found, examined = (str(e),), 0
        if not found and leg.needs_some and not examined:
            found = ("there is nothing to look at",)
        stopped = bool(found)
        out.append(Outcome(leg.name, "failed" if found else "passed", examined, found))
    return out


def tally(outcomes: Iterable[Outcome]) -> str:
    states = [o.state for o in outcomes]
    return f"{states.count('passed')} passed, {states.count('failed')} failed, {states.count('not run')} not run"


def decodes(files: DataFrame) -> tuple[DataFrame, int]:
    """Files ``(path, text)`` that are no TOML."""
    parsed = parse_records(files).select("path", "parse_error").cache()
    return parsed.where("parse_error is not null").select(F.concat_ws(": ", "path", "parse_error").alias("problem")), parsed.count()


def unreleased(released: DataFrame, written: DataFrame) -> tuple[DataFrame, int]:
    """Versions that are a tag but no entry of the changelog, or an entry but no tag; both ``(version)``."""
    sides = symmetric_difference(released, written, ["version"])
    text = F.when(F.col("side") == "left", "is a tag without an entry").otherwise("has an entry, but there is no such tag")
    return sides.select(F.concat_ws(" ", "version", text).alias("problem")), released.unionByName(written).distinct().count()


def unreached_sites(sites: DataFrame, profile: DataFrame) -> tuple[DataFrame, int]:
    """Refusal sites ``(file, line, site)`` that no executed block of a coverage profile holds.

    A profile names files by their import path, so files are matched by its end.
    """
    blocks = profile.where("count > 0").select(F.col("file").alias("of"), "start", "end")
    inside = F.col("of").endswith(F.col("file")) & F.col("line").between(F.col("start"), F.col("end"))
    name = F.element_at(F.split("file", "/"), -1)
    missed = sites.withColumn("name", name).join(blocks.withColumn("name", F.element_at(F.split("of", "/"), -1)), "name", "left").groupBy("file", "line", "site").agg(F.max(F.coalesce(inside, F.lit(False))).alias("hit"))
    return missed.where(~F.col("hit")).select(F.concat("site", F.lit(" at "), "file", F.lit(":"), F.col("line").cast("string"), F.lit(" is never reached")).alias("problem")), sites.count()


def below_floor(profile: DataFrame, surface: list[str], floor: float) -> tuple[DataFrame, int]:
    """The share of executed statements over the packages of ``surface``, where it is under ``floor`` percent.

    A package of the surface that the profile lacks is a problem too. Blocks that are
    listed several times count once, as executed if any of them was.
    """
    package = F.regexp_replace("file", "/[^/]*$", "")
    on = F.array(*[F.lit(s) for s in surface])
    own = profile.withColumn("own", F.get(F.filter(on, lambda s: (package == s) | F.endswith(package, F.concat(F.lit("/"), s))), F.lit(0))).where("own is not null")
    blocks = own.groupBy("own", "file", "start", "end", "statements").agg(F.max("count").alias("count"))
    rows = blocks.groupBy("own").agg(F.sum("statements").alias("all"), F.sum(F.when(F.col("count") > 0, F.col("statements")).otherwise(0)).alias("done")).cache()
    total = rows.agg(F.coalesce(F.sum("all"), F.lit(0)).alias("all"), F.coalesce(F.sum("done"), F.lit(0)).alias("done"))
    share = F.try_divide(100 * F.col("done"), F.col("all"))
    low = total.where(share < floor).select(F.concat(F.round(share, 1).cast("string"), F.lit(f" % of statements, under the floor of {floor} %")).alias("problem"))
    listed = profile.sparkSession.createDataFrame([(s,) for s in surface], "own string")
    absent = listed.join(rows, "own", "left_anti").select(F.concat(F.lit("no statement of "), "own").alias("problem"))
    return low.unionByName(absent), total.first()["all"]


def unlisted_refusers(sites: DataFrame, surface: list[str]) -> DataFrame:
    """Packages that hold a refusal site ``(file, line, site)`` but are not on the ``surface`` whose coverage is judged."""
    package = F.regexp_extract("file", "^(.*)/[^/]*$", 1)
    return sites.where(~package.isin(surface)).select(F.concat(package, F.lit(" can refuse, but is not on the surface")).alias("problem")).distinct()


def tracked_outputs(tracked: DataFrame, outputs: list[str]) -> tuple[DataFrame, int]:
    """Tracked files ``(path)`` that a build writes; each is a problem, as a build is never part of its own revision."""
    return tracked.select(F.concat("path", F.lit(" is what a build writes, but it is tracked")).alias("problem")), len(outputs)


def network_imports(edges: DataFrame, module: str, permitted: str, network: list[str]) -> tuple[DataFrame, int]:
    """Packages of ``module`` that reach one of ``network`` by imports of any length.

    ``permitted`` with its own packages, and whatever these reach, may. Test listings
    (``.test``) don't count. A graph without a package of the module is an error.
    """
    below = lambda c, root: (c == root) | c.startswith(root + "/")
    pairs = reach(edges)
    names = edges.select(F.col("src").alias("name")).unionByName(edges.select(F.col("dst").alias("name"))).where("name is not null").distinct()
    own = names.where(below(F.col("name"), module) & ~F.col("name").endswith(".test"))
    examined = own.count()
    if not examined:
        raise ValueError(f"no package of {module} is in the import graph")
    allowed = names.where(below(F.col("name"), permitted)).unionByName(pairs.where(below(F.col("src"), permitted)).select(F.col("dst").alias("name"))).distinct()
    hits = pairs.where(F.col("dst").isin(network)).join(own.join(allowed, "name", "left_anti"), F.col("src") == F.col("name"), "left_semi")
    return hits.select(F.concat("src", F.lit(" reaches "), "dst").alias("problem")), examined


def network_reach(edges: DataFrame, package: str, allowed: DataFrame) -> tuple[DataFrame, int]:
    """Packages ``(name)`` that ``package`` reaches by imports but that are not ``allowed``."""
    found = reach(edges).where(F.col("src") == package).select(F.col("dst").alias("name")).distinct()
    return found.join(allowed, "name", "left_anti").select(F.concat(F.lit(f"{package} reaches "), "name").alias("problem")), found.count()


def frozen_readings(files: DataFrame, schemas: dict[int, Schema]) -> DataFrame:
    """``version, file, reading`` of frozen ``files (version, path, text)`` by the schemas of today."""
    out = None
    for v in sorted(r.version for r in files.select("version").distinct().collect()):  # few versions
        parsed = parse_records(files.where(F.col("version") == v))
        own = readings(parsed, validate_records(parsed, schemas)).withColumn("version", F.lit(v))
        out = own if out is None else out.unionByName(own)
    return out if out is not None else files.sparkSession.createDataFrame([], "version int, file string, reading string")


def changed_readings(frozen: DataFrame, now: DataFrame) -> tuple[DataFrame, int]:
    """Frozen files that read differently now, or that only one side has."""
    keys = ["version", "file"]
    both = frozen.withColumnRenamed("reading", "was").join(now.withColumnRenamed("reading", "now"), keys, "full_outer")
    change = F.when(F.col("was").isNull(), "is not frozen").when(F.col("now").isNull(), "is gone").when(F.col("was") != F.col("now"), "reads differently")
    return both.where(change.isNotNull()).select(F.concat(F.lit("version "), F.col("version").cast("string"), F.lit(": "), "file", F.lit(" "), change).alias("problem")), frozen.count()
