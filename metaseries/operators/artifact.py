"""The stamped artifact: one JSON document, JSON lines, and a flat CSV view; frozen readings."""

from __future__ import annotations

import filecmp
import json
import os
import subprocess
import tempfile
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaseries.sources.schemas import Schema, shortest


@dataclass(frozen=True)
class Provenance:
    """What a build says about where it comes from; handed in, never looked up by the build."""

    corpus_version: str = "unversioned"
    corpus_revision: str = "unknown"
    corpus_state: str = "unknown"
    tool_version: str = "unversioned"
    tool_revision: str = "unknown"
    tool_state: str = "unknown"


#: Names of a build's files: fixed values.
FILES = ("corpus.json", "corpus.jsonl", "corpus.csv", "corpus.csv.stamp.json")


@dataclass(frozen=True)
class Artifact:
    records: DataFrame
    stamp: dict
    schema: Schema = field(repr=False)


class InvalidCorpus(ValueError):
    """A corpus with refusals; nothing is built from it."""


def git_provenance(root: str) -> Provenance:
    """Revision and state of the working tree that holds ``root``."""

    def git(*args: str) -> str:
        return subprocess.run(["git", "-C", root, *args], capture_output=True, text=True, check=False).stdout.strip()

    revision = git("rev-parse", "HEAD") or "unknown"
    state = "unknown" if revision == "unknown" else "dirty" if git("status", "--porcelain") else "clean"
    version = git("describe", "--tags", "--match", "corpus-*") or "unversioned"
    return Provenance(version, revision, state, git("describe", "--tags", "--match", "tool-*") or "unversioned", revision, state)


def digest(records: DataFrame) -> str:
    """SHA-256 over each record's path and fields, in path order: folded row by row."""
    import hashlib

    fold = hashlib.sha256()
    for row in records.select("path", "fields").orderBy("path").toLocalIterator():
        fold.update(f"{row.path}\n{row.fields}\n".encode())
    return fold.hexdigest()


def stamp_of(p: Provenance, command: str, options: dict, selection: str, selected: int, excluded: dict[str, int], dirty_digest: Callable[[], str] | None = None) -> dict:
    """What an output says about itself, in its fixed order."""
    stamp = {"stamp_version": 1, "corpus_version": p.corpus_version, "corpus_revision": p.corpus_revision, "corpus_state": p.corpus_state}
    if p.corpus_state == "dirty" and dirty_digest is not None:
        stamp["corpus_dirty_digest"] = dirty_digest()
    return stamp | {
        "tool_version": p.tool_version, "tool_revision": p.tool_revision, "tool_state": p.tool_state, "command": command, "options": dict(sorted(options.items())),
        "selection": selection, "selected_count": selected, "excluded": dict(sorted(excluded.items())),
    }


def build(parsed: DataFrame, refusals: DataFrame, excluded: dict[str, int], schema: Schema, provenance: Provenance, command: str = "build", options: dict | None = None, selection: str = "all") -> Artifact:
    """The artifact of a corpus without refusals; ``selection`` is a SQL condition on ``path, fields, cells`` or ``all``."""
    first = refusals.orderBy("file", "field", "site", "found").limit(20).collect()
    if first:
        raise InvalidCorpus("\n".join(f"{r.file}: {r.field}: found {r.found}, expected {r.expected} [{r.site}]" for r in first))
    records = parsed.select("path", "fields") if selection == "all" else parsed.where(selection).select("path", "fields")
    stamp = stamp_of(provenance, command, options or {}, selection, records.count(), excluded, lambda: digest(records))
    return Artifact(records, stamp, schema)


def cell(value: object) -> str:
    """A value as one CSV cell."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        if value != value or value in (float("inf"), float("-inf")):
            raise ValueError("a value that is no number has no place in an artifact")
        return shortest(value)
    if isinstance(value, (int, str)):
        return str(value)
    raise ValueError("only plain values fit a cell")


def lookup(fields: dict, path: str) -> object:
    for key in path.split("."):
        if not isinstance(fields, dict) or key not in fields:
            return None
        fields = fields[key]
    return fields


def _quoted(text: str) -> str:
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in ',"\r\n') or text.startswith(" ") else text


def stamp_lines(stamp: dict) -> list[str]:
    render = lambda v: (", ".join(f"{k}={x}" for k, x in v.items()) or "none") if isinstance(v, dict) else str(v)
    return [f"{k}: {render(v)}" for k, v in stamp.items()]


def write_all(artifact: Artifact, folder: str) -> list[str]:
    """Write ``corpus.json``, ``corpus.jsonl``, ``corpus.csv`` and ``corpus.csv.stamp.json``.

    Records are streamed in path order, a partition at a time; each file is renamed into
    place once it is whole. The same records give the same bytes.
    """
    os.makedirs(folder, exist_ok=True)
    columns, dropped = artifact.schema.flat_columns(), artifact.schema.dropped_columns()
    names = FILES[:3]
    parts = {n: open(os.path.join(folder, n + ".part"), "w", encoding="utf-8", newline="") for n in names}  # noqa: SIM115
    try:
        parts["corpus.json"].write('{\n  "stamp": ' + json.dumps(artifact.stamp, ensure_ascii=False, sort_keys=False) + ',\n  "records": [')
        for line in ["# A flat view; the JSON artifact is the authority.", "# Fields that do not fit a cell are left out.", *("# " + x for x in stamp_lines(artifact.stamp)), "# dropped: " + ", ".join(dropped), ",".join(columns)]:
            parts["corpus.csv"].write(line + "\n")
        comma = "\n"
        for row in artifact.records.orderBy("path").toLocalIterator():
            fields = json.loads(row.fields, parse_constant=_no_number)
            line = f'{{"path": {json.dumps(row.path, ensure_ascii=False)}, "fields": {row.fields}}}'
            parts["corpus.json"].write(comma + "    " + line)
            comma = ",\n"
            parts["corpus.jsonl"].write(line + "\n")
            parts["corpus.csv"].write(",".join(_quoted(cell(lookup(fields, c))) for c in columns) + "\n")
        parts["corpus.json"].write("\n  ]\n}\n")
    finally:
        for f in parts.values():
            f.close()
    with open(os.path.join(folder, "corpus.csv.stamp.json"), "w", encoding="utf-8") as f:
        json.dump({"stamp": artifact.stamp, "lossy": True, "of": "corpus.json", "dropped": dropped}, f, indent=2, ensure_ascii=False)
    for n in names:
        os.replace(os.path.join(folder, n + ".part"), os.path.join(folder, n))
    return [os.path.join(folder, n) for n in (*names, "corpus.csv.stamp.json")]


def _no_number(text: str) -> None:
    raise ValueError(f"{text} has no place in an artifact")


def reproduce(folder: str, rebuild: Callable[[str, dict], Provenance]) -> list[str]:
    """Build again what ``folder`` says it holds; the files that differ, none if all bytes are the same.

    ``rebuild`` gets an empty folder and the stamp, fills the folder, and returns the
    provenance it built from. A dirty stamp, or another revision, can't be reproduced.
    """
    with open(os.path.join(folder, "corpus.csv.stamp.json"), encoding="utf-8") as f:
        stamp = json.load(f)["stamp"]
    if stamp["corpus_state"] == "dirty" or stamp["tool_state"] == "dirty":
        raise ValueError("a dirty build can't be reproduced")
    with tempfile.TemporaryDirectory() as again:
        made = rebuild(again, stamp)
        if made.corpus_revision != stamp["corpus_revision"]:
            raise ValueError(f"this is revision {made.corpus_revision}, the build is of {stamp['corpus_revision']}")
        return [n for n in FILES if not filecmp.cmp(os.path.join(folder, n), os.path.join(again, n), shallow=False)]


def plain_stamp(stamp: dict) -> str:
    """The stamp as a block that a plain-text output ends with."""
    return "\n".join(["-- stamp --", *stamp_lines(stamp)]) + "\n"


def readings(parsed: DataFrame, refusals: DataFrame) -> DataFrame:
    """``file, reading``: of each record its canonical fields, or where refused the refusals' sites and fields."""
    refused = refusals.groupBy("file").agg(F.array_sort(F.collect_list(F.concat_ws(" at ", "site", F.when(F.col("field") != "", F.col("field"))))).alias("refusals"))
    rows = parsed.select(F.col("path").alias("file"), "fields").join(refused, "file", "left")
    reading = F.when(F.col("refusals").isNotNull(), F.to_json(F.struct("refusals"))).otherwise(F.concat(F.lit('{"fields":'), F.col("fields"), F.lit("}")))
    return rows.select("file", reading.alias("reading"))


def reading_changes(frozen: DataFrame, current: DataFrame) -> DataFrame:
    """``file, change`` between frozen and current readings: added, removed or changed."""
    a, b = frozen.select("file", F.col("reading").alias("was")), current.select("file", F.col("reading").alias("now"))
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("was") != F.col("now"), "changed")
    return a.join(b, "file", "full_outer").select("file", change.alias("change")).where("change is not null")
