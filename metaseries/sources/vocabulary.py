"""Vocabulary entries and the group registry: what the coded fields of records resolve to."""

from __future__ import annotations

import os
import tomllib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .records import read_tree

QUANTITIES = (
    "id string, path string, name string, dimension string, canonical_unit string, status string, superseded_by string, techniques array<string>, families map<string,string>,"
    " epochs array<string>, problem string"
)
GROUPS = "id string, path string, name string, aliases array<string>, problem string"
# fixed values: fields of the two kinds of entries
QUANTITY_FIELDS = ("id", "name", "definition", "dimension", "canonical_unit", "includes", "excludes", "techniques", "aliases", "definition_epochs", "status", "external")
GROUP_FIELDS = ("id", "name", "aliases")


def _entry(path: str, text: bytes, fields: tuple[str, ...]) -> tuple[dict, str | None]:
    """An entry and the first thing wrong with it."""
    try:
        entry = tomllib.loads(bytes(text).decode("utf-8"))
    except (tomllib.TOMLDecodeError, UnicodeDecodeError) as e:
        return {}, f"does not parse: {e}"
    missing = [f for f in fields if f not in entry]
    if missing:
        return entry, "missing: " + ", ".join(missing)
    own = os.path.basename(path).removesuffix(".toml")
    if entry["id"] != own:
        return entry, f"its id is {entry['id']}, its file {own}"
    if entry.get("status") == "superseded" and "superseded_by" not in entry:
        return entry, "superseded, but not by what"
    return entry, None


def _rows(spark: SparkSession, root: str, folder: str, fields: tuple[str, ...], row, schema: str) -> DataFrame:
    if not os.path.isdir(os.path.join(root, folder)):
        return spark.createDataFrame([], schema)
    files = read_tree(spark, root, folder).where("path like '%.toml'")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [row(p, *_entry(p, t, fields)) for p, t in zip(batch["path"], batch["text"], strict=True)]
            yield pd.DataFrame(found, columns=names)

    return files.mapInPandas(run, schema)


def _ids(entries: object) -> list[str]:
    return [e["id"] for e in entries if isinstance(e, dict) and "id" in e] if isinstance(entries, list) else []


def quantities(spark: SparkSession, root: str) -> DataFrame:
    """One row for each file of ``vocabulary/``; ``problem`` is null where it is sound. No folder gives no rows."""

    def row(path: str, e: dict, problem: str | None) -> tuple:
        families = {t["id"]: t["family"] for t in e.get("techniques", []) if isinstance(t, dict) and "family" in t and "id" in t}
        plain = [e.get(k) for k in ("name", "dimension", "canonical_unit", "status", "superseded_by")]
        return (e.get("id"), path, *plain, _ids(e.get("techniques")), families, _ids(e.get("definition_epochs")), problem)

    return _rows(spark, root, "vocabulary", QUANTITY_FIELDS, row, QUANTITIES)


def groups(spark: SparkSession, root: str) -> DataFrame:
    """One row for each file of ``group/``; ``problem`` is null where it is sound. No folder gives no rows."""
    return _rows(spark, root, "group", GROUP_FIELDS, lambda path, e, problem: (e.get("id"), path, e.get("name"), e.get("aliases", []), problem), GROUPS)
