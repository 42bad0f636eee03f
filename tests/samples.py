"""Invented records for tests: a sound one as data, changed place by place, written as TOML."""

import copy
import json

DROP = object()

SOUND = {
    "group": {"id": "north-workshop"},
    "method": {"technique": "string-comparison", "note": "three strings, one bell"},
    "publication": {"date": "1931-07", "submitted": "1931-02-11", "data_taken_status": "reported", "data_taken": {"start": "1929", "end": "1930-10"}},
    "source": {
        "print": {"publisher": "Bell Founders' Yearbook", "volume": "12", "pages": "88-91", "year": 1931, "authors": ["M. Ferro", "L. Ottavi"]},
        "resolvable": False,
        "locator": {"table": "3", "section": "Tenor bells"},
        "statement_kind": "summary-table",
        "directness": "primary",
        "confirmation": "confirmed",
        "confirmed_by": "second reader",
    },
    "measurement": {
        "quantity": "tenor-bell-pitch",
        "definition_epoch": "concert-pitch",
        "published": {
            "value": 217.25,
            "unit": "double vibrations per second",
            "uncertainty_status": "reported",
            "uncertainty": [
                {"component": "statistical", "plus": 0.75, "minus": 0.5, "coverage": "cl=90", "interval_kind": "unstated"},
                {"component": "systematic", "plus": 0.25, "minus": 0.25, "coverage": "k=2", "interval_kind": "frequentist", "correlation_group": "tuning-fork-7"},
            ],
        },
        "normalization_status": "normalized",
        "normalized": {
            "value": 434.5,
            "unit": "s^-1",
            "uncertainty": [
                {"component": "statistical", "plus": 1.5, "minus": 1.0, "coverage": "cl=90", "interval_kind": "unstated"},
                {"component": "systematic", "plus": 0.5, "minus": 0.5, "coverage": "k=2", "interval_kind": "frequentist", "correlation_group": "tuning-fork-7"},
            ],
        },
        "conversion": {"factor": 2.0, "exact": True, "factor_source": "by definition"},
    },
    "blinding": "blinded",
    "status": "active",
    "schema_version": 1,
}
PATH = "record/tenor-bell-pitch/1931-ferro-01.toml"


def inline(value) -> str:
    if isinstance(value, dict):
        return "{ " + ", ".join(f"{json.dumps(k, ensure_ascii=False)} = {inline(v)}" for k, v in value.items()) + " }"
    if isinstance(value, list):
        return "[" + ", ".join(map(inline, value)) + "]"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float) and value != value:
        return "nan"
    return repr(value) if isinstance(value, (int, float)) else json.dumps(value, ensure_ascii=False)


def toml(record: dict) -> str:
    return "".join(f"{json.dumps(k)} = {inline(v)}\n" for k, v in record.items())


def changed(changes: dict, base: dict = SOUND) -> dict:
    """A copy of ``base`` with a value at each dotted place; numbers are places in lists, DROP takes away."""
    out = copy.deepcopy(base)
    for place, value in changes.items():
        *way, last = [int(k) if k.isdigit() else k for k in place.split("/")]
        at = out
        for k in way:
            at = at[k]
        if value is DROP:
            del at[last]
        else:
            at[last] = value
    return out


def text(changes: dict) -> str:
    return toml(changed(changes))
