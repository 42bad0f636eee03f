"""Record schemas: loading, self-checks, and their expansion into rows.

A schema is data. Its nested types are expanded into one row for each place a value
can stand (``measurement.published.uncertainty[].plus``), so that checks are joins and
predicates over these rows instead of a walk.
"""

from __future__ import annotations

import re
import tomllib
from dataclasses import dataclass, field
from pathlib import Path

FOLDER = Path(__file__).resolve().parent.parent / "schemas"
NEEDS = ("required", "optional", "conditional")
PLAIN = ("string", "integer", "boolean", "float", "any")
_rule_keys = {"type", "need", "values", "literals", "min_length", "minimum", "required_when", "refused_when", "decidable", "resolves_to"}
_top_keys = {"version", "record_path", "excluded_prefix", "scalars", "fields", "blocks", "at_least_one_of"}
_operators = ("equals", "not_equals", "in", "present", "absent", "never")


class SchemaError(ValueError):
    """A schema that can't be relied on; nothing is validated against it."""


@dataclass(frozen=True)
class Rule:
    """What may stand at one place: ``place`` is its path with list indexes left out."""

    place: str
    container: str
    name: str
    type: str
    need: str
    rule: dict
    element: bool = False


@dataclass(frozen=True)
class Schema:
    version: int
    record_path: str
    excluded_prefix: str
    scalars: dict
    fields: dict
    blocks: dict
    at_least_one_of: dict = field(default_factory=dict)

    def base(self, kind: str) -> str:
        return kind.removesuffix("-or-literal")

    def element(self, kind: str) -> str | None:
        m = re.fullmatch(r"list<(.+)>", kind)
        return m[1] if m else None

    def is_container(self, kind: str) -> bool:
        return kind in self.blocks or "ends" in self.scalars.get(kind, {})

    def members(self, kind: str) -> dict:
        if kind in self.blocks:
            return self.blocks[kind]
        scalar = self.scalars[kind]
        return {end: {"type": scalar["of"]} for end in scalar["ends"]}

    def rules(self) -> list[Rule]:
        """Every place, top-level fields first, each followed by what lies in it."""
        out: list[Rule] = []

        def add(container: str, name: str, rule: dict) -> None:
            place = f"{container}.{name}" if container else name
            out.append(Rule(place, container, name, rule["type"], rule.get("need", "required"), rule))
            inside(place, rule["type"])

        def inside(place: str, kind: str) -> None:
            item = self.element(kind)
            if item is not None:
                place = f"{place}[]"
                out.append(Rule(place, "", "", item, "optional", {"type": item}, element=True))
                inside(place, item)
            elif self.is_container(kind):
                for name, rule in self.members(kind).items():
                    add(place, name, rule)

        for name, rule in self.fields.items():
            add("", name, rule)
        return out

    def interiors(self) -> list[str]:
        """Tables that only hold fields: ``measurement``, ``measurement.published``, ..."""
        found = {".".join(name.split(".")[:i]) for name in self.fields for i in range(1, name.count(".") + 1)}
        return sorted(found)

    def flat_columns(self) -> list[str]:
        """Fields that fit one cell, in declared order."""
        return [name for name, rule in self.fields.items() if self.element(rule["type"]) is None and not self.is_container(rule["type"])]

    def dropped_columns(self) -> list[str]:
        kept = set(self.flat_columns())
        return [name for name in self.fields if name not in kept]


def _known(schema: Schema, kind: str) -> bool:
    item = schema.element(kind)
    kind = schema.base(item if item is not None else kind)
    return kind in PLAIN or kind in schema.scalars or kind in schema.blocks


def _check_rule(schema: Schema, where: str, rule: dict) -> None:
    if extra := set(rule) - _rule_keys:
        raise SchemaError(f"{where}: keys that nothing reads: {sorted(extra)}")
    if rule.get("need", "required") not in NEEDS:
        raise SchemaError(f"{where}: need is {rule['need']!r}, not one of {NEEDS}")
    if not _known(schema, rule.get("type", "")):
        raise SchemaError(f"{where}: unknown type {rule.get('type')!r}")
    if rule.get("need") == "conditional" and not ("required_when" in rule and "refused_when" in rule):
        raise SchemaError(f"{where}: conditional, but without both conditions")
    for c in (rule.get("required_when"), rule.get("refused_when")):
        if c is not None and sum(o in c for o in _operators) + ("source_stated" in c) != 1:
            raise SchemaError(f"{where}: a condition has exactly one operator")


def load_file(path: Path) -> Schema:
    """Read and check one schema file, named ``record-<version>.toml``."""
    m = re.fullmatch(r"record-(\d+)\.toml", path.name)
    data = tomllib.loads(path.read_text(encoding="utf-8"))
    if extra := set(data) - _top_keys:
        raise SchemaError(f"{path.name}: keys that nothing reads: {sorted(extra)}")
    if not m or data.get("version") != int(m[1]) or data["version"] < 1:
        raise SchemaError(f"{path.name}: the file's name and its version disagree")
    if not data.get("fields"):
        raise SchemaError(f"{path.name}: no fields")
    schema = Schema(data["version"], data["record_path"], data.get("excluded_prefix", ""), data.get("scalars", {}), data["fields"], data.get("blocks", {}), data.get("at_least_one_of", {}))
    for pattern in (schema.record_path, *(s["pattern"] for s in schema.scalars.values() if "pattern" in s)):
        try:
            re.compile(pattern)
        except re.error as e:
            raise SchemaError(f"{path.name}: bad pattern {pattern!r}: {e}") from e
    for name, rule in schema.fields.items():
        _check_rule(schema, name, rule)
    for block, members in schema.blocks.items():
        for name, rule in members.items():
            _check_rule(schema, f"{block}.{name}", rule)
    for block, names in schema.at_least_one_of.items():
        if set(names) - set(schema.blocks.get(block, {})):
            raise SchemaError(f"{path.name}: at_least_one_of names members that {block} does not have")
    return schema


def load(folder: Path | str = FOLDER) -> dict[int, Schema]:
    """All versions in a folder; none is an error."""
    folder = Path(folder)
    found = {}
    for path in sorted(folder.glob("record-*.toml")):
        schema = load_file(path)
        found[schema.version] = schema
    if not found:
        raise SchemaError(f"no schema in {folder}")
    return dict(sorted(found.items()))


def lowest(schemas: dict[int, Schema]) -> Schema:
    return schemas[min(schemas)]


def describe_condition(c: dict) -> str:
    """A condition as a phrase, for refusals and for the printed schema."""
    if c.get("never"):
        return "never"
    if "source_stated" in c:
        return f"the source {'states' if c['source_stated'] else 'does not state'} it"
    what = f"the quantity's {c['vocabulary']}" if "vocabulary" in c else c["field"]
    if "equals" in c:
        return f"{what} is {printed(c['equals'])}"
    if "not_equals" in c:
        return f"{what} is not {printed(c['not_equals'])}"
    if "in" in c:
        return f"{what} is one of {', '.join(map(printed, c['in']))}"
    return f"{what} is {'present' if 'present' in c else 'absent'}"


def printed(value: object) -> str:
    """A scalar as conditions and duplicates compare it: 1 and "1" are alike."""
    if isinstance(value, bool):
        return "true" if value else "false"
    return shortest(value) if isinstance(value, float) else str(value)


def shortest(x: float) -> str:
    """The shortest decimal that reads back as ``x``; exponents from 1e21 on and under 1e-4."""
    if x != x or x in (float("inf"), float("-inf")):
        return {True: "NaN"}.get(x != x, "+Inf" if x > 0 else "-Inf")
    text = repr(x)
    digits, _, exponent = text.partition("e")
    if exponent:
        e = int(exponent)
        if -4 <= e < 21:
            return f"{x:.0f}" if e > 0 else f"{x:.{len(digits.replace('-', '').replace('.', '')) - 1 - e}f}"
        return f"{digits}e{'-' if e < 0 else '+'}{abs(e):02d}"
    return text.removesuffix(".0")


def print_schema(schemas: dict[int, Schema]) -> str:
    """The loaded schemas as sentences."""
    out = []
    for version, schema in schemas.items():
        out.append(f"Record schema, version {version}")
        for title, entries in [("fields", schema.fields), *schema.blocks.items()]:
            out.append(f"\n{title}")
            for name, rule in entries.items():
                need = {"required": "is required", "optional": "may be left out", "conditional": "depends on other fields"}[rule.get("need", "required")]
                parts = [f"  {name} ({rule['type']}) {need}"]
                if "values" in rule or "literals" in rule:
                    parts.append("one of " + ", ".join(rule.get("values", rule.get("literals"))))
                if "minimum" in rule:
                    parts.append(f"at least {shortest(rule['minimum'])}")
                if "min_length" in rule:
                    parts.append(f"at least {rule['min_length']} item")
                for key, verb in (("required_when", "required"), ("refused_when", "refused")):
                    if key in rule:
                        parts.append(f"{verb} when {describe_condition(rule[key])}")
                out.append("; ".join(parts) + ".")
            if title in schema.at_least_one_of:
                out.append(f"  At least one of {', '.join(schema.at_least_one_of[title])} is present.")
    return "\n".join(out) + "\n"
