"""The checks of a repository that holds a corpus, in the order they run."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaseries.operators import artifact, gate, validate
from metaseries.sources import frozen, records, schemas
from metaseries.sources import gate as sources

CHANGELOG = "CHANGELOG.md"


@dataclass(frozen=True)
class Inputs:
    """What some legs read beside the tree; a leg whose files are not named is not run."""

    profile: str | None = None
    sites: str | None = None
    #: Packages whose coverage is judged, and the least percentage of statements.
    surface: tuple[str, ...] = ()
    floor: float = 85.0
    imports: str | None = None
    module: str | None = None
    #: The one package that may reach the network, below the module.
    permitted: str = "internal/net"
    #: Packages that can open a connection.
    network: tuple[str, ...] = ("net", "net/http", "net/rpc", "net/smtp", "crypto/tls")


def legs(spark: SparkSession, root: str, loaded: dict[int, schemas.Schema], inputs: Inputs = Inputs(), out: str = "build") -> list[gate.Leg]:
    """All legs over the tree ``root``; ``out`` is the folder that builds are written to, relative to it."""

    def corpus() -> tuple[DataFrame, int]:
        files = records.read_tree(spark, root).cache()
        refusals, counts = validate.validate_tree(files, records.parse_records(files), loaded)
        text = F.concat("file", F.lit(": "), "field", F.lit(": found "), "found", F.lit(", expected "), "expected", F.lit(" ["), "site", F.lit("]"))
        return refusals.select(text.alias("problem")), counts.first().records

    def compatible() -> tuple[DataFrame, int]:
        return gate.changed_readings(frozen.read_readings(spark, root), gate.frozen_readings(frozen.frozen_files(spark, root), loaded))

    def covered() -> tuple[DataFrame, int]:
        low, examined = gate.below_floor(sources.coverage_profile(spark, inputs.profile), list(inputs.surface), inputs.floor)
        return (low.unionByName(gate.unlisted_refusers(sources.refusal_sites(spark, inputs.sites), list(inputs.surface))) if inputs.sites else low), examined

    def changelog() -> tuple[DataFrame, int]:
        tags, problems, examined = sources.tags(spark, root), None, 0
        for heading, prefix in sources.STREAMS.items():
            written = sources.changelog_versions(spark, os.path.join(root, CHANGELOG), heading)
            found, n = gate.unreleased(sources.released_versions(tags, prefix), written)
            found = found.select(F.concat(F.lit(prefix), "problem").alias("problem"))
            problems, examined = found if problems is None else problems.unionByName(found), examined + n
        return problems, examined

    def untracked() -> tuple[DataFrame, int]:
        paths = [f"{out}/{name}" for name in artifact.FILES]
        return gate.tracked_outputs(sources.tracked(spark, root, [*paths, out]), paths)

    def offline() -> tuple[DataFrame, int]:
        return gate.network_imports(sources.import_edges(spark, inputs.imports), inputs.module, f"{inputs.module}/{inputs.permitted}", list(inputs.network))

    def given(name: str, run, **needed) -> gate.Leg:
        lacking = [n for n, v in needed.items() if not v]
        return gate.Leg(name, owed="not given: " + ", ".join(lacking)) if lacking else gate.Leg(name, run)

    return [
        gate.Leg("corpus-decodes", lambda: gate.decodes(sources.toml_inventory(spark, root))),
        gate.Leg("validate-corpus", corpus, needs_some=False),
        gate.Leg("schema-compatibility", compatible),
        given("refusal-sites", lambda: gate.unreached_sites(sources.refusal_sites(spark, inputs.sites), sources.coverage_profile(spark, inputs.profile)), sites=inputs.sites, profile=inputs.profile),
        given("coverage-floor", covered, profile=inputs.profile, surface=inputs.surface),
        # with neither tags nor entries there is no release to be wrong about
        gate.Leg("changelog", changelog, needs_some=False),
        gate.Leg("artifact-untracked", untracked),
        given("no-network-imports", offline, imports=inputs.imports, module=inputs.module),
    ]
