import csv
import json
import math

import pytest
from samples import DROP, PATH, SOUND, changed, text, toml

from metaseries.operators import analysis, artifact, meaning, pooling, validate
from metaseries.sources import records, schemas, vocabulary

PARTS = "measurement/published/uncertainty"
FIRST = "measurement.published.uncertainty[0]"
DOI = {"scheme": "doi", "value": "10.5555/bells.88"}
NETWORK = {"source/print": DROP, "source/resolvable": DROP}
CASES = {
    "the sound record": ({}, []),
    # status and lineage
    "withdrawn without successor": ({"status": "withdrawn"}, []),
    "withdrawn with one": ({"status": "withdrawn", "superseded_by": "record/tenor-bell-pitch/1932-ferro-01.toml"}, []),
    "active with one": ({"superseded_by": "record/tenor-bell-pitch/1932-ferro-01.toml"}, [("conditional-field-refused", "superseded_by")]),
    "lineage to no path": ({"lineage": {"supersedes": ["1930-ferro-01"]}}, [("malformed-value", "lineage.supersedes[0]")]),
    # versions
    "version left out": ({"schema_version": DROP}, [("schema-version", "schema_version")]),
    "version with a point": ({"schema_version": 1.0}, [("schema-version", "schema_version")]),
    "version to come": ({"schema_version": 12}, [("schema-version", "schema_version")]),
    # names
    "a key nobody declared": ({"tower": "south"}, [("unknown-field", "tower")]),
    "one within a block": ({"measurement/conversion/rounding": 3}, [("unknown-field", "measurement.conversion.rounding")]),
    "one within a list": ({f"{PARTS}/1/quoted_as": "+-"}, [("unknown-field", "measurement.published.uncertainty[1].quoted_as")]),
    "two letters swapped": ({"group": DROP, "gruop": {"id": "north-workshop"}}, [("missing-required-field", "group.id"), ("unknown-field", "gruop")]),
    "a dotted key in quotes": ({"group.id": "x"}, [("unknown-field", "group.id")]),
    # presence
    "no technique": ({"method/technique": DROP}, [("missing-required-field", "method.technique")]),
    "no optional note": ({"method/note": DROP}, []),
    "no kind of interval": ({f"{PARTS}/0/interval_kind": DROP}, [("missing-required-field", f"{FIRST}.interval_kind")]),
    "other without a label": ({f"{PARTS}/0/component": "other"}, [("conditional-field-missing", f"{FIRST}.label")]),
    "a label beside a known component": ({f"{PARTS}/0/label": "calibration"}, [("conditional-field-refused", f"{FIRST}.label")]),
    "confirmed by nobody": ({"source/confirmed_by": DROP}, [("conditional-field-missing", "source.confirmed_by")]),
    "disputed and confirmed": ({"source/confirmation": "disputed"}, [("conditional-field-refused", "source.confirmed_by")]),
    "second hand without the way": ({"source/directness": "secondary"}, [("conditional-field-missing", "source.via")]),
    "no widths to be had": (
        {"measurement/published/uncertainty_status": "not-transcribed"},
        [("conditional-field-refused", "measurement.normalized.uncertainty"), ("conditional-field-refused", "measurement.published.uncertainty")],
    ),
    "a factor that was measured": (
        {"measurement/conversion/exact": False},
        [("conditional-field-missing", "measurement.conversion.factor_relative_uncertainty"), ("conditional-field-missing", "measurement.conversion.imported_uncertainty")],
    ),
    "neither print nor network": ({"source/print": DROP}, [("conditional-field-missing", "source.identifier"), ("conditional-field-missing", "source.print")]),
    "from the network": (NETWORK | {"source/identifier": [DOI]}, []),
    "a locator that says nothing": ({"source/locator": {}}, [("no-member-present", "source.locator")]),
    "a period without end": ({"publication/data_taken/end": DROP}, [("missing-required-field", "publication.data_taken.end")]),
    # types
    "a text for a table": ({"method": "by ear"}, [("wrong-type", "method"), ("missing-required-field", "method.technique")]),
    "a whole number for a width": ({f"{PARTS}/1/plus": 1}, [("wrong-type", "measurement.published.uncertainty[1].plus")]),
    "a number for a name": ({"measurement/quantity": 217}, [("wrong-type", "measurement.quantity")]),
    "a text for a yes": ({"measurement/conversion/exact": "yes"}, [("wrong-type", "measurement.conversion.exact")]),
    "a text for a year": ({"source/print/year": "1931"}, [("wrong-type", "source.print.year")]),
    "a number for a date": ({"publication/date": 1931}, [("wrong-type", "publication.date")]),
    "a text for a list": ({"correction": "none"}, [("wrong-type", "correction")]),
    "a text for a period": ({"publication/data_taken": "1929"}, [("wrong-type", "publication.data_taken")]),
    # forms
    "a name with a blank": ({"measurement/quantity": "tenor bell"}, [("malformed-value", "measurement.quantity")]),
    "a name with another hyphen": ({"measurement/quantity": "tenor\u2011bell"}, [("malformed-value", "measurement.quantity")]),
    "a name of 61 letters": ({"measurement/quantity": "b" * 61}, [("malformed-value", "measurement.quantity")]),
    "a name of 60 letters": ({"measurement/quantity": "b" * 60}, []),
    "a name and a line's end": ({"group/id": "north-workshop\n"}, [("malformed-value", "group.id")]),
    "a coverage in words": ({f"{PARTS}/0/coverage": "one sigma"}, [("malformed-value", f"{FIRST}.coverage")]),
    "June 31st": ({"publication/submitted": "1931-06-31"}, [("malformed-value", "publication.submitted")]),
    "a leap day": ({"publication/submitted": "1928-02-29"}, []),
    "two digits of a year": ({"publication/date": "31"}, [("malformed-value", "publication.date")]),
    # sets and bounds
    "a kind not in the set": ({"source/statement_kind": "table"}, [("value-outside-set", "source.statement_kind")]),
    "two kinds not in theirs": ({"source/statement_kind": "table", "blinding": "no"}, [("value-outside-set", "blinding"), ("value-outside-set", "source.statement_kind")]),
    "a width below nothing": ({f"{PARTS}/0/minus": -0.5}, [("below-minimum", f"{FIRST}.minus")]),
    "a width of nothing": ({f"{PARTS}/0/minus": 0.0}, []),
    "a width that is no number": ({f"{PARTS}/0/minus": math.nan}, []),
    "a width of minus infinity": ({f"{PARTS}/0/minus": -math.inf}, [("below-minimum", f"{FIRST}.minus")]),
    "no authors": ({"source/print/authors": []}, [("list-too-short", "source.print.authors")]),
    "an author twice": ({"source/print/authors": ["M. Ferro", "M. Ferro"]}, []),
    "an identifier twice": (NETWORK | {"source/identifier": [DOI, {"scheme": "isbn", "value": "9"}, DOI]}, [("duplicate-in-list", "source.identifier[2]")]),
    "two identifiers of one value": (NETWORK | {"source/identifier": [DOI, DOI | {"scheme": "url"}]}, []),
    "relative to itself": ({"measurement/denominator_quantity": "definitional"}, []),
}
BROKEN = {"a quote left open": 'status = "active\n', "no text at all": None}


@pytest.fixture(scope="module")
def loaded():
    return schemas.load()


@pytest.fixture(scope="module")
def refused(spark, loaded):
    texts = {name: text(changes) for name, (changes, _) in CASES.items()} | BROKEN
    files = spark.createDataFrame([(name, None if t is None else t.encode()) for name, t in texts.items()], "path string, text binary")
    found = {}
    for r in validate.validate_records(records.parse_records(files), loaded).collect():
        found.setdefault(r.file, []).append((r.site, r.field))
    return found


@pytest.mark.parametrize("name", CASES)
def test_each_edit_gives_its_refusals(refused, name):
    assert sorted(refused.get(name, [])) == sorted(CASES[name][1])


@pytest.mark.parametrize("name", BROKEN)
def test_what_does_not_parse_is_refused(refused, name):
    assert refused[name] == [("record-does-not-parse", "")]


def test_every_site_but_the_tree_s_is_reached():
    reached = {site for _, expected in CASES.values() for site, _ in expected} | {"record-does-not-parse"}
    assert reached == set(validate.SITES) - {"record-in-the-wrong-place"}


def written(root, files):
    for path, content in files.items():
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_text(content)
    return str(root)


def test_a_tree_and_its_artifact(spark, loaded, tmp_path):
    low = schemas.lowest(loaded)
    later = PATH.replace("1931", "1938").replace("01.toml", "07.toml")
    root = written(tmp_path, {PATH: text({}), later: text({"publication/date": "1938"}), "record/_drafts/notes.txt": "no TOML"})
    files = records.read_tree(spark, root).cache()
    parsed = records.parse_records(files).cache()
    refusals, counts = validate.validate_tree(files, parsed, loaded)
    assert refusals.count() == 0
    assert counts.first().asDict() == {"records": 2, "skipped": 1, "excluded": ["record/_drafts"]}
    own = parsed.where(~validate.excluded(parsed.path, low.excluded_prefix))
    made = artifact.build(own, refusals, {"excluded folder": 1}, low, artifact.Provenance(corpus_state="dirty"))
    assert made.stamp["selected_count"] == 2 and len(made.stamp["corpus_dirty_digest"]) == 64
    out = tmp_path / "build"
    names = artifact.write_all(made, str(out))
    first = [open(n).read() for n in names]
    artifact.write_all(made, str(out))
    assert first == [open(n).read() for n in names]
    whole = json.loads(first[0])
    assert [r["path"] for r in whole["records"]] == sorted([PATH, later])
    assert whole["records"][0]["fields"] == json.loads(json.dumps(SOUND))
    header, *rows = [x for x in first[2].splitlines() if not x.startswith("#")]
    assert len(header.split(",")) == 23 and len(low.dropped_columns()) == 11 and len(rows) == 2
    cells = dict(zip(header.split(","), next(csv.reader(rows)), strict=True))
    assert (cells["measurement.published.value"], cells["method.note"]) == ("217.25", "three strings, one bell")
    with pytest.raises(ValueError, match="dirty"):
        artifact.reproduce(str(out), lambda folder, stamp: artifact.Provenance())
    frozen = artifact.readings(own, refusals)
    assert artifact.reading_changes(frozen, frozen).count() == 0
    one = artifact.build(own, refusals, {}, low, artifact.Provenance(), selection="path like '%1938%'")
    assert [r.path for r in one.records.collect()] == [later] and one.stamp["selection"] == "path like '%1938%'"
    (tmp_path / "record/stray.md").write_text("x")
    files = records.read_tree(spark, root)
    refusals, counts = validate.validate_tree(files, records.parse_records(files), loaded)
    assert [r.site for r in refusals.collect()] == ["record-in-the-wrong-place"]
    with pytest.raises(artifact.InvalidCorpus):
        artifact.build(own, refusals, {}, low, artifact.Provenance())


def test_a_build_is_reproduced_or_refused(spark, loaded, tmp_path):
    low = schemas.lowest(loaded)
    parsed = records.parse_records(spark.createDataFrame([(PATH, text({}).encode())], "path string, text binary")).cache()
    none = spark.createDataFrame([], "site string, file string, field string, found string, expected string")
    provenance = artifact.Provenance("corpus-1", "abc", "clean", "tool-1", "abc", "clean")

    def rebuild(folder, stamp, p=provenance, rows=parsed):
        artifact.write_all(artifact.build(rows, none, {}, low, p, stamp["command"], stamp["options"], stamp["selection"]), folder)
        return p

    out = str(tmp_path / "build")
    artifact.write_all(artifact.build(parsed, none, {}, low, provenance, options={"b": 1, "a": 2}), out)
    assert artifact.reproduce(out, rebuild) == []
    other = records.parse_records(spark.createDataFrame([(PATH, text({"blinding": "not-stated"}).encode())], "path string, text binary"))
    assert artifact.reproduce(out, lambda f, s: rebuild(f, s, rows=other)) == ["corpus.json", "corpus.jsonl", "corpus.csv"]
    with pytest.raises(ValueError, match="revision"):
        artifact.reproduce(out, lambda f, s: rebuild(f, s, p=artifact.Provenance("corpus-1", "def", "clean", "tool-1", "def", "clean")))
    block = artifact.plain_stamp(json.load(open(out + "/corpus.csv.stamp.json"))["stamp"])
    assert block.startswith("-- stamp --\nstamp_version: 1\n") and "end of stamp" not in block and "options: a=2, b=1" in block


def test_a_missing_tree_is_an_error(tmp_path):
    with pytest.raises(FileNotFoundError):
        records.listing(str(tmp_path))


ENTRY = {
    "id": "tenor-bell-pitch", "name": "Pitch of a tenor bell", "definition": "How often it swings.", "dimension": "time^-1", "canonical_unit": "s^-1", "includes": [], "excludes": [], "aliases": [],
    "status": "active", "external": [], "techniques": [{"id": "string-comparison", "name": "a", "family": "by-ear"}, {"id": "strobe", "name": "b"}], "definition_epochs": [{"id": "concert-pitch"}],
}


def test_vocabulary_and_groups(spark, tmp_path):
    root = written(tmp_path, {
        "vocabulary/tenor-bell-pitch.toml": toml(ENTRY),
        "vocabulary/renamed.toml": toml(ENTRY | {"id": "bell-mass", "dimension": "mass"}),
        "vocabulary/short.toml": 'id = "short"\n',
        "vocabulary/broken.toml": "id = ",
        "vocabulary/gone.toml": toml(ENTRY | {"id": "gone", "status": "superseded"}),
        "group/north-workshop.toml": 'id = "north-workshop"\nname = "North"\naliases = ["N"]\n',
        "group/README.md": "x",
    })
    rows = {r.path: r for r in vocabulary.quantities(spark, root).collect()}
    assert {p.split("/")[1]: (r.problem or "")[:9] for p, r in rows.items()} == {"tenor-bell-pitch.toml": "", "renamed.toml": "its id is", "short.toml": "missing: ", "broken.toml": "does not ", "gone.toml": "supersede"}
    sound = rows["vocabulary/tenor-bell-pitch.toml"]
    assert (sound.techniques, sound.families, sound.epochs) == (["string-comparison", "strobe"], {"string-comparison": "by-ear"}, ["concert-pitch"])
    assert [(r.id, r.aliases, r.problem) for r in vocabulary.groups(spark, root).collect()] == [("north-workshop", ["N"], None)]
    assert vocabulary.groups(spark, str(tmp_path / "group")).count() == 0


def test_meaning(spark, tmp_path):
    changes = {
        "sound": {},
        "factor": {"measurement/conversion/factor": 3.0},
        "epoch": {"measurement/definition_epoch": "old-pitch"},
        "technique": {"method/technique": "strob"},
        "group": {"group/id": "south-workshop"},
        "link": {"lineage": {"supersedes": ["record/none/1900-none-01.toml"]}},
        "factor known badly": {"measurement/conversion/exact": False, "measurement/conversion/factor_relative_uncertainty": 1e-4, "measurement/conversion/imported_uncertainty": "negligible"},
        "factor known well": {"measurement/conversion/exact": False, "measurement/conversion/factor_relative_uncertainty": 1e-6, "measurement/conversion/imported_uncertainty": "negligible"},
        "conversion among the published": {f"{PARTS}/0/component": "other", f"{PARTS}/0/label": "unit-conversion"},
        "denominator": {"measurement/denominator_quantity": "definitional"},
    }
    parsed = records.parse_records(spark.createDataFrame([(k, text(c).encode()) for k, c in changes.items()], "path string, text binary")).cache()
    root = written(tmp_path, {"vocabulary/tenor-bell-pitch.toml": toml(ENTRY), "vocabulary/ratio.toml": toml(ENTRY | {"id": "ratio", "dimension": "dimensionless"}), "group/north-workshop.toml": 'id = "north-workshop"\nname = "N"\naliases = []\n'})
    quantities, groups = vocabulary.quantities(spark, root).cache(), vocabulary.groups(spark, root).cache()
    assert [r.path for r in meaning.unit_mismatch(parsed).collect()] == ["factor"]
    assert {(r.path, r.field) for r in meaning.unresolved(parsed, quantities, groups).collect()} == {
        ("epoch", "measurement.definition_epoch"), ("technique", "method.technique"), ("group", "group.id"), ("link", "lineage.supersedes[0]")
    }
    assert [r.path for r in meaning.not_negligible(parsed).collect()] == ["factor known badly"]
    assert [r.path for r in meaning.misplaced_conversion(parsed).collect()] == ["conversion among the published"]
    assert [tuple(r) for r in meaning.denominators(parsed, quantities).collect()] == [("denominator", "refused")]
    bare = {"none": {}, "self": {"measurement/denominator_quantity": "definitional"}, "to a bell": {"measurement/denominator_quantity": "tenor-bell-pitch"}, "to nothing": {"measurement/denominator_quantity": "drum"}}
    rows = [(k, text(c | {"measurement/quantity": "ratio"}).encode()) for k, c in bare.items()]
    found = meaning.denominators(records.parse_records(spark.createDataFrame(rows, "path string, text binary")), quantities).collect()
    assert {tuple(r) for r in found} == {("none", "missing"), ("to nothing", "unresolved")}
    assert meaning.components(parsed).where("path = 'sound' and cov_kind = 'k' and cov_value = 2").count() == 2


NORMAL = "measurement/normalized/uncertainty"
NO_WIDTHS = {PARTS: DROP, NORMAL: DROP}
#: Of each reason, a change that brings it about.
LEFT_OUT = {
    "withdrawn": {"status": "withdrawn"},
    "disputed": {"source/confirmation": "disputed", "source/confirmed_by": DROP},
    "combined-fit": {"source/statement_kind": "combined-fit"},
    "limit": {"measurement/published/value": DROP, "measurement/published/limit": {"direction": "upper", "bound": 1.0, "coverage": "cl=95", "interval_kind": "unstated"}, "measurement/normalized/value": DROP},
    "none-in-source": NO_WIDTHS | {"measurement/published/uncertainty_status": "none-in-source"},
    "not-transcribed": NO_WIDTHS | {"measurement/published/uncertainty_status": "not-transcribed"},
    "not-convertible": {"measurement/normalization_status": "not-convertible-across-redefinition", "measurement/normalized": DROP, "measurement/conversion": DROP},
    "coverage-unstated": {f"{NORMAL}/0/coverage": "unstated"},
    "coverage-other": {f"{NORMAL}/0/coverage": "other", f"{NORMAL}/0/coverage_note": "limits of error"},
    "zero-width": {f"{NORMAL}/1/minus": 0.0},
    "no-width": {f"{NORMAL}/0/component": "total", f"{NORMAL}/1/component": "total"},
    "superseded": {"lineage": {"superseded_by": "record/tenor-bell-pitch/1990-later-01.toml"}},
}


def test_200_records_pooled_end_to_end(spark, loaded, tmp_path):
    files, expected, plain = {}, {}, {}
    for i in range(200):
        quantity, epoch = ("tenor-bell-pitch", "treble-bell-pitch")[i % 2], ("concert-pitch", "old-pitch")[i % 5 == 4]
        path = f"record/{quantity}/{1900 + i % 90}-maker-{"ab"[i // 100]}-{i % 100:02d}.toml"
        plus, minus, value = 0.5 + i % 7 / 4, 0.25 + i % 5 / 4, 430 + (i * 37 % 101) / 8
        own = {
            "measurement/quantity": quantity, "measurement/definition_epoch": epoch, "group/id": f"maker-{i}", "publication/date": str(1900 + i % 90),
            "measurement/normalized/value": value, "measurement/published/value": value / 2,
            f"{NORMAL}/0/plus": plus, f"{NORMAL}/0/minus": minus, f"{NORMAL}/0/coverage": ("k=1", "cl=95", "k=2")[i % 3], "source/confirmation": "unconfirmed", "source/confirmed_by": DROP,
        }
        reason = "kept"
        if i % 9 == 0:
            reason = list(LEFT_OUT)[i // 9 % len(LEFT_OUT)]
            changes = LEFT_OUT[reason]
            own = {k: v for k, v in own.items() if not any(k.startswith(c + "/") and v is not None for c, v2 in changes.items() if v2 is DROP)} | changes
            if reason == "limit":
                own = {k: v for k, v in own.items() if k not in ("measurement/published/value", "measurement/normalized/value")} | changes
        elif i % 25 == 7:
            # the same group's earlier value of the quantity and epoch
            reason, own["group/id"] = "group-repeat", f"twice-{i}"
            later = own | {"publication/date": "1995", "measurement/normalized/value": value + 1, "measurement/published/value": (value + 1) / 2}
            files[f"record/{quantity}/1995-maker-{"ab"[i // 100]}-{i % 100:02d}.toml"] = text(later)
            expected[quantity, "kept"] = expected.get((quantity, "kept"), 0) + 1
            plain.setdefault((quantity, epoch), []).append((value + 1, plus, minus, i % 3))
        files[path] = text(own)
        expected[quantity, reason] = expected.get((quantity, reason), 0) + 1
        if reason == "kept":
            plain.setdefault((quantity, epoch), []).append((value, plus, minus, i % 3))
    assert {r for _, r in expected} == {"kept", "group-repeat", *LEFT_OUT}
    root = written(tmp_path, files)
    tree = records.read_tree(spark, root)
    parsed = records.parse_records(tree).cache()
    refusals, _ = validate.validate_tree(tree, parsed, loaded)
    assert [tuple(r) for r in refusals.where("site <> 'conditional-field-missing'").take(3)] == []
    judged = analysis.judged(analysis.measurements(parsed)).cache()
    assert {(r.quantity, r.reason): r.n for r in analysis.excluded_counts(judged).collect()} == expected
    series = analysis.studies(judged, spark.createDataFrame([("tenor-bell-pitch", {"string-comparison": "by-ear"})], "id string, families map<string,string>")).cache()
    assert {(r.quantity, r.family) for r in series.select("quantity", "family").distinct().collect()} == {("tenor-bell-pitch", "by-ear"), ("treble-bell-pitch", "string-comparison")}
    found = {(r.quantity, r.epoch): r for r in pooling.pool_fixed(series, ["quantity", "epoch"]).collect()}
    assert found.keys() == plain.keys() and len(found) == 4
    spread = (1.0, 1.959963984540054, 2.0)
    for key, rows in plain.items():
        # the second component is 0.5 at two standard deviations
        s = [(math.hypot(p / spread[c], 0.25) + math.hypot(m / spread[c], 0.25)) / 2 for _, p, m, c in rows]
        mean = sum(y / x**2 for (y, *_), x in zip(rows, s, strict=True)) / sum(1 / x**2 for x in s)
        assert (found[key].k, found[key].estimate) == (len(rows), pytest.approx(mean, rel=1e-9))
    shares = {r.quantity: r for r in analysis.confirmation_breakdown(judged).collect()}
    assert sum(r.unconfirmed for r in shares.values()) == sum(map(len, plain.values())) and sum(r.disputed for r in shares.values()) == sum(n for (_, r), n in expected.items() if r == "disputed")
    stamp = analysis.options_stamp(judged, analysis.Options())
    assert stamp["correlation_groups_taken_as_independent"] == sum(map(len, plain.values())) and stamp["assumed_coverage"] == "none"
    with pytest.raises(ValueError, match="epoch"):
        analysis.refuse_mixed_epochs(series, ["quantity"])
    assert analysis.refuse_mixed_epochs(series, ["quantity", "epoch"]) is series
    only = analysis.judged(analysis.measurements(parsed), analysis.Options(confirmed_only=True))
    assert only.where("reason = 'kept'").count() == 0
    assumed = analysis.judged(analysis.measurements(parsed), analysis.Options(assumed_coverage="k=1")).cache()
    assert assumed.where("reason = 'coverage-unstated'").count() == 0
    assert analysis.options_stamp(assumed, analysis.Options(assumed_coverage="k=1"))["assumed_coverage_records"] == sum(n for (_, r), n in expected.items() if r == "coverage-unstated")


def test_coverages():
    known = {"k=1": 1.0, "k=2.5": 2.5, "cl=95": 1.959963984540054, "cl=68.27": 1.0000217, "k=0": None, "cl=0": None, "cl=100": None, "unstated": None, "other": None, None: None}
    for text_, n in known.items():
        assert analysis.standard_deviations(text_) == (None if n is None else pytest.approx(n, rel=1e-5))


def test_widths_and_what_the_conversion_brings_in(spark):
    conversion = {"component": "other", "label": "unit-conversion", "plus": 0.3, "minus": 0.3, "coverage": "k=1", "interval_kind": "frequentist"}
    total = {"component": "total", "plus": 0.4, "minus": 0.8, "coverage": "k=2", "interval_kind": "frequentist"}
    cases = {"quadrature": [SOUND["measurement"]["normalized"]["uncertainty"][1], conversion], "total": [total, SOUND["measurement"]["normalized"]["uncertainty"][0], conversion]}
    rows = [(k, toml(changed({NORMAL: parts, "group/id": k})).encode()) for k, parts in cases.items()]
    found = {r.path: r for r in analysis.studies(analysis.judged(analysis.measurements(records.parse_records(spark.createDataFrame(rows, "path string, text binary"))))).collect()}
    assert (found["quadrature"].width_source, found["quadrature"].plus) == ("quadrature", pytest.approx(math.hypot(0.25, 0.3)))
    assert (found["total"].width_source, found["total"].plus, found["total"].minus) == ("total", pytest.approx(math.hypot(0.2, 0.3)), pytest.approx(0.5))
    assert found["total"].systematic_quoted is False and found["quadrature"].systematic_quoted is True


def test_the_schema_is_checked(tmp_path):
    text = (schemas.FOLDER / "record-1.toml").read_text()
    for old, new in (("version = 1\n", "version = 2\n"), ('"blinding" = { type = "string"', '"blinding" = { type = "strong"'), ("[scalars]", "[extra]\n[scalars]"), ('need = "optional"', 'need = "perhaps"')):
        (tmp_path / "record-1.toml").write_text(text.replace(old, new, 1))
        with pytest.raises(schemas.SchemaError):
            schemas.load(tmp_path)
    assert "is required" in schemas.print_schema(schemas.load())


def test_shortest_numbers():
    assert [schemas.shortest(x) for x in (1.0, 1.5, 1e21, 1e20, 1.5e-7, 0.0001, 1e-05)] == ["1", "1.5", "1e+21", "100000000000000000000", "1.5e-07", "0.0001", "1e-05"]


def test_the_command_line(spark, tmp_path, capsys):
    from metaseries.__main__ import main

    bad = PATH.replace("01.toml", "02.toml")
    root = written(tmp_path / "corpus", {PATH: text({}), "vocabulary/tenor-bell-pitch.toml": toml(ENTRY), "group/north-workshop.toml": 'id = "north-workshop"\nname = "N"\naliases = []\n'})
    out = str(tmp_path / "build")
    run = lambda verb, *more: (main([verb, "--root", root, "--out", out, *more]), capsys.readouterr().out)
    assert run("validate") == (0, "1 record(s), 0 skipped in [], 0 refusal(s).\n")
    assert run("meaning") == (0, "")
    code, said = run("analyse", "--assume-coverage", "k=1")
    result, stamp = said.split("-- stamp --\n")
    assert code == 0 and "assumed_coverage=k=1" in stamp and all(": " in line for line in stamp.splitlines())
    assert "tenor-bell-pitch: 1 confirmed, 0 unconfirmed, 0 disputed left out" in result and json.loads(result.splitlines()[-1])["estimate"] == pytest.approx(434.5)
    assert run("build")[0] == 0 and run("freeze") == (0, "") and run("compare") == (0, "")
    written(tmp_path / "corpus", {bad: text({"group/id": "nobody", "blinding": "no"})})
    assert run("validate") == (1, f"{bad}: blinding: found a text no, expected one of blinded, not-blinded, not-stated [value-outside-set]\n2 record(s), 0 skipped in [], 1 refusal(s).\n")
    assert run("meaning") == (1, f"{bad}: group.id: nothing is named nobody\n")
    assert run("compare") == (1, f"{bad}: added\n")
    assert "is required" in run("schema")[1] and "value-outside-set" in run("refusals")[1]


def test_corrections_and_shares(spark):
    entry = {"date": "1950-01-02", "kind": "transcription", "field": "blinding", "was": "blinded", "now": "not-stated", "reason": "r", "reported_in": "x"}
    kinds = {"a": [], "b": ["transcription", "transcription"], "c": ["transcription", "metadata"]}
    rows = [(k, text({"correction": [entry | {"kind": x} for x in own], "group/id": k, "blinding": "blinded" if k == "a" else "not-stated"}).encode()) for k, own in kinds.items()]
    parsed = records.parse_records(spark.createDataFrame(rows, "path string, text binary"))
    assert {tuple(r) for r in analysis.correction_kinds(parsed).collect()} == {("transcription", 3, 2), ("metadata", 1, 1)}
    found = analysis.shares(analysis.judged(analysis.measurements(parsed)), "blinding").collect()
    assert {(r.blinding, r.n, round(r.share, 3)) for r in found} == {("blinded", 1, 0.333), ("not-stated", 2, 0.667)}
