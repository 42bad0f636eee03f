"""Record trees: a driver-side listing, and a distributed parse into cells.

Spark's file sources pass over names that begin with ``_`` or ``.``, which must be
counted here, so the tree is listed and the paths are what is distributed. A record is
shredded into a map from place to cell; a key's dots are escaped in places, so a
quoted key never looks like a path.
"""

from __future__ import annotations

import itertools
import json
import os
import tomllib
from collections.abc import Iterator
from datetime import date, datetime, time

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import printed

CELL = "struct<place string, parent string, key string, kind string, s string, d double, l bigint, n int, repr string>"
PARSED = f"path string, parse_error string, fields string, cells map<string,{CELL}>"
INT64 = 1 << 63
#: Records that a task holds as cells at a time; a batch of Arrow's may have 10,000.
AT_ONCE = 200


def listing(root: str, below: str = "record") -> list[str]:
    """Relative paths of all files under ``below``, in order; a missing folder is an error."""
    top = os.path.join(root, below)
    if not os.path.isdir(top):
        raise FileNotFoundError(f"there is no {below}/ in {root}")
    found = [os.path.relpath(os.path.join(d, f), root).replace(os.sep, "/") for d, _, names in os.walk(top) for f in names]
    return sorted(found, key=lambda p: p.encode())


def read_tree(spark: SparkSession, root: str, below: str = "record") -> DataFrame:
    """``path, text`` of each file of a tree on storage that all executors see; text null where it is no UTF-8."""
    paths = listing(root, below)
    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, min(len(paths) // 1000 + 1, 4096)))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for p in batch["path"]:
                with open(os.path.join(root, p), "rb") as f:
                    texts.append(f.read())
            yield batch.assign(text=texts)

    return files.mapInPandas(read, "path string, text binary")


def escape(key: str) -> str:
    return key.replace("\\", "\\\\").replace(".", "\\.").replace("[", "\\[")


def _kind(value: object) -> str:
    if isinstance(value, bool):
        return "bool"
    for types, name in ((str, "string"), (int, "int"), (float, "float"), (dict, "table"), (list, "array"), ((datetime, date, time), "datetime")):
        if isinstance(value, types):
            return name
    return "other"


def canonical(value: object) -> str:
    """JSON with sorted keys; floats keep a decimal point, dates become text."""
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{canonical(value[k])}" for k in sorted(value, key=lambda k: k.encode())) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, (datetime, date, time)):
        return json.dumps(value.isoformat())
    return json.dumps(value, ensure_ascii=False)


def _alike(value: object) -> str:
    """The form in which items of a list are compared."""
    if isinstance(value, dict):
        return "{" + " ".join(f"{k}:{_alike(value[k])}" for k in sorted(value)) + "}"
    if isinstance(value, list):
        return "[" + " ".join(map(_alike, value)) + "]"
    return printed(value)


def shred(record: dict) -> dict[str, dict]:
    """Cells of a record by field; refuses integers beyond 64 bits."""
    cells: dict[str, dict] = {}

    def put(field: str, place: str, parent: str, key: str, value: object) -> None:
        kind = _kind(value)
        if kind == "int" and not -INT64 <= value < INT64:
            raise ValueError(f"{field}: an integer beyond 64 bits")
        cells[field] = {
            "place": place, "parent": parent, "key": key, "kind": kind,
            "s": value if kind == "string" else None, "d": float(value) if kind == "float" else None, "l": value if kind == "int" else None,
            "n": len(value) if kind in ("table", "array") else None, "repr": _alike(value),
        }
        if kind == "table":
            for k, v in value.items():
                put(f"{field}.{escape(k)}", f"{place}.{escape(k)}", field, k, v)
        elif kind == "array":
            for i, v in enumerate(value):
                put(f"{field}[{i}]", f"{place}[]", field, "", v)

    for k, v in record.items():
        put(escape(k), escape(k), "", k, v)
    return cells


_cell = pa.struct([pa.field(n, t) for n, t in (("place", pa.string()), ("parent", pa.string()), ("key", pa.string()), ("kind", pa.string()), ("s", pa.string()), ("d", pa.float64()), ("l", pa.int64()), ("n", pa.int32()), ("repr", pa.string()))])


def parsed_record(text: bytes | None) -> tuple[str | None, str | None, dict[str, dict]]:
    """Error, canonical JSON and cells of a record's text."""
    try:
        if text is None:
            raise ValueError("no text")
        record = tomllib.loads(text.decode("utf-8"))
        return None, canonical(record), shred(record)
    except (tomllib.TOMLDecodeError, UnicodeDecodeError, ValueError, RecursionError) as e:
        return str(e) or type(e).__name__, None, {}


def parse_records(files: DataFrame) -> DataFrame:
    """``path, parse_error, fields, cells`` of ``files (path, text)``; ``fields`` is canonical JSON."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, AT_ONCE) for whole in batches for at in range(0, whole.num_rows, AT_ONCE)):
            errors, fields, cells = zip(*map(parsed_record, batch.column(1).to_pylist()), strict=True)
            every = [c for own in cells for c in own.values()]
            ends = pa.array([0, *itertools.accumulate(map(len, cells))], pa.int32())
            columns = [pa.array([c[f.name] for c in every], f.type) for f in _cell]
            held = pa.MapArray.from_arrays(ends, pa.array([k for own in cells for k in own], pa.string()), pa.StructArray.from_arrays(columns, fields=list(_cell)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(errors, pa.string()), pa.array(fields, pa.string()), held], names=["path", "parse_error", "fields", "cells"])

    return files.select("path", F.col("text").cast("binary").alias("text")).mapInArrow(run, PARSED)
