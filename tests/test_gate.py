"""The repository's checks: each accepts what is sound and refuses what is not."""

import subprocess

import pytest
from samples import text

from metaseries.operators import gate
from metaseries.sources import frozen, schemas
from metaseries.sources import gate as sources

PROFILE = """mode: set
mill.example/bells/internal/cast/mould.go:10.2,14.30 3 1
mill.example/bells/internal/cast/mould.go:16.2,18.3 2 0
mill.example/bells/internal/cast/mould.go:16.2,18.3 2 1
mill.example/bells/internal/tune/fork.go:5.1,9.2 4 0
"""


def problems(found):
    rows, examined = found
    return sorted(r.problem for r in rows.collect()), examined


def test_coverage_profiles(spark, tmp_path):
    (tmp_path / "c.out").write_text(PROFILE)
    profile = sources.coverage_profile(spark, str(tmp_path / "c.out"))
    assert profile.count() == 4 and profile.agg({"statements": "sum"}).first()[0] == 11
    sites = spark.createDataFrame([("cast/mould.go", 12, "too-hot"), ("cast/mould.go", 17, "cracked"), ("cast/mould.go", 20, "hollow"), ("tune/fork.go", 6, "bent")], "file string, line int, site string")
    assert problems(gate.unreached_sites(sites, profile)) == (["bent at tune/fork.go:6 is never reached", "hollow at cast/mould.go:20 is never reached"], 4)
    assert problems(gate.below_floor(profile, ["internal/cast"], 90.0)) == ([], 5)
    assert problems(gate.below_floor(profile, ["internal/cast", "internal/tune"], 90.0)) == (["55.6 % of statements, under the floor of 90.0 %"], 9)
    assert problems(gate.below_floor(profile, ["internal/cast", "internal/ring"], 90.0)) == (["no statement of internal/ring"], 5)
    (tmp_path / "none.out").write_text("mode: set\na/b.go:1.1,2.2 1 0\n")
    with pytest.raises(ValueError, match="no executed"):
        sources.coverage_profile(spark, str(tmp_path / "none.out"))
    (tmp_path / "bad.out").write_text("mode: set\na/b.go 1 0\n")
    with pytest.raises(Exception, match="no line of a coverage profile"):
        sources.coverage_profile(spark, str(tmp_path / "bad.out")).collect()


def test_tags_and_changelog(spark, tmp_path):
    git = lambda *a: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=t", "-c", "user.email=t@t", *a], check=True, capture_output=True)
    git("init", "-q")
    git("commit", "-q", "--allow-empty", "-m", "x")
    for tag in ("bell-1.0.0", "bell-1.1.0", "bell-beta", "1.0.0", "bell-corpus-2.0.0"):
        git("tag", tag)
    released = sources.released_versions(sources.tags(spark, str(tmp_path)), "bell-")
    assert sorted(r.version for r in released.collect()) == ["1.0.0", "1.1.0"]
    news, streams = tmp_path / "NEWS.md", ("# The bells", "# The forks", "# The ropes")
    read = lambda heading: sorted(r.version for r in sources.changelog_versions(spark, str(news), heading, streams).collect())
    news.write_bytes(b"# News\n## 8.8.8\n\n# The bells\r\n\n## Unreleased\n\n## 1.2.0 - today\ntext ## 7.7.7\n### 6.6.6\n## 1.0.0\n## 1.0\n\n# The forks\n## Unreleased\n## 3.0.0\n# The ropes\n## 9.9.9\n")
    written = sources.changelog_versions(spark, str(news), "# The bells", streams)
    assert read("# The bells") == ["1.0.0", "1.2.0"] and read("# The forks") == ["3.0.0"]
    with pytest.raises(ValueError, match="no '## Unreleased' under '# The ropes'"):
        read("# The ropes")
    with pytest.raises(ValueError, match="no heading '# The wheels'"):
        read("# The wheels")
    with pytest.raises(FileNotFoundError):
        sources.changelog_versions(spark, str(tmp_path / "NONE.md"), "# The bells")
    assert problems(gate.unreleased(released, written)) == (["1.1.0 is a tag without an entry", "1.2.0 has an entry, but there is no such tag"], 3)
    with pytest.raises(ValueError, match="tags"):
        sources.tags(spark, str(tmp_path / "nowhere"))


def test_imports_and_inventory(spark, tmp_path):
    (tmp_path / "list.json").write_text('{"ImportPath": "app", "Imports": ["a", "b"]}\n{"ImportPath": "a", "Imports": ["net"]}\n{"ImportPath": "b"}\n')
    edges = sources.import_edges(spark, str(tmp_path / "list.json"))
    allowed = spark.createDataFrame([("a",), ("b",)], "name string")
    assert problems(gate.network_reach(edges, "app", allowed)) == (["app reaches net"], 3)
    for name, content in {"x.toml": "a = 1", "deep/Y.TOML": "a = ", "record/q/z.toml": "b = ", "notes.md": "x", ".hid/a.toml": "a = ", "deep/.hid/b.toml": "a = ", ".c.toml": "c = 1"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(content)
    found = sources.toml_inventory(spark, str(tmp_path))
    assert sorted(r.path for r in found.collect()) == [".c.toml", "deep/Y.TOML", "record/q/z.toml", "x.toml"]
    said, examined = problems(gate.decodes(found))
    assert examined == 4 and [s.split(":")[0] for s in said] == ["deep/Y.TOML", "record/q/z.toml"]


def test_packages_that_reach_the_network(spark):
    graph = lambda *pairs: spark.createDataFrame([tuple(p.split()) for p in pairs], "src string, dst string")
    judge = lambda edges: problems(gate.network_imports(edges, "m", "m/link", ["net", "net/http"]))
    edges = graph("m m/a", "m/a x", "x y", "y net", "net/http net", "m/link net/http", "m/link m/helper", "m/helper net", "m/b net/url", "m/b.test net", "mm net", "m/link/deep net")
    assert judge(edges) == (["m reaches net", "m/a reaches net"], 6)
    assert judge(graph("m/link net", "m/a fmt")) == ([], 2)
    # a package that imports the permitted one reaches the network through it
    assert judge(graph("m/a m/link", "m/link net/http", "net/http net")) == (["m/a reaches net", "m/a reaches net/http"], 2)
    with pytest.raises(ValueError, match="no package of m "):
        judge(graph("other net"))


def test_refusers_off_the_surface(spark):
    sites = spark.createDataFrame([("a/b/x.go", 1, "s"), ("a/b/y.go", 2, "t"), ("a/c/z.go", 1, "u")], "file string, line int, site string")
    assert [r.problem for r in gate.unlisted_refusers(sites, ["a/b"]).collect()] == ["a/c can refuse, but is not on the surface"]
    assert gate.unlisted_refusers(sites, ["a/b", "a/c"]).isEmpty()


def test_the_gate_from_the_command_line(spark, tmp_path, capsys):
    from metaseries.__main__ import main

    root = tmp_path / "tree"
    record = root / "record/tenor-bell-pitch/1931-ferro-01.toml"
    record.parent.mkdir(parents=True)
    record.write_text(text({}))
    git = lambda *a: subprocess.run(["git", "-C", str(root), "-c", "user.name=t", "-c", "user.email=t@t", *a], check=True, capture_output=True)
    run = lambda *more: (main(["gate", "--root", str(root), *more]), capsys.readouterr().out.splitlines())
    git("init", "-q")
    git("commit", "-q", "--allow-empty", "-m", "x")
    (root / "CHANGELOG.md").write_text("# The tool\n\n## Unreleased\n\n# The corpus\n\n## Unreleased\n\n## 1.0.0\n")
    code, said = run()
    assert code == 1 and said[:3] == ["passed  corpus-decodes: 1 examined", "passed  validate-corpus: 1 examined", "failed  schema-compatibility"] and said[-1] == "2 passed, 1 failed, 5 not run"
    copy = root / "frozen/schema-1/tenor-bell-pitch/1931-ferro-01.toml"
    copy.parent.mkdir(parents=True)
    copy.write_text(record.read_text())
    frozen.write_readings(gate.frozen_readings(frozen.frozen_files(spark, str(root)), schemas.load()), str(root))
    code, said = run("--leg", "changelog")
    assert code == 1 and said == ["failed  changelog", "        corpus-v1.0.0 has an entry, but there is no such tag", "0 passed, 1 failed, 0 not run"]
    git("tag", "corpus-v1.0.0")
    code, said = run()
    assert code == 0 and said[-1] == "5 passed, 0 failed, 3 not run" and "        not given: sites, profile" in said
    git("tag", "v0.1.0")
    assert run("--leg", "changelog")[1][1] == "        v0.1.0 is a tag without an entry"
    (root / "build").mkdir()
    (root / "build/corpus.csv").write_text("x")
    assert run("--leg", "artifact-untracked")[0] == 0
    git("add", "build/corpus.csv")
    assert run("--leg", "artifact-untracked") == (1, ["failed  artifact-untracked", "        build/corpus.csv is what a build writes, but it is tracked", "0 passed, 1 failed, 0 not run"])
    (tmp_path / "c.out").write_text(PROFILE)
    (tmp_path / "sites.json").write_text('{"file": "internal/cast/mould.go", "line": 12, "site": "too-hot"}\n')
    (tmp_path / "list.json").write_text('{"ImportPath": "m", "Imports": ["m/internal/net"]}\n{"ImportPath": "m/internal/net", "Imports": ["net"]}\n')
    own = ("--leg", "refusal-sites", "--leg", "coverage-floor", "--leg", "no-network-imports", "--profile", str(tmp_path / "c.out"), "--sites", str(tmp_path / "sites.json"))
    assert run(*own, "--surface", "internal/cast")[1] == ["passed  refusal-sites: 1 examined", "passed  coverage-floor: 5 examined", "not run no-network-imports", "        not given: imports, module", "2 passed, 0 failed, 1 not run"]
    assert run(*own, "--surface", "internal/tune")[1][2] == "        0.0 % of statements, under the floor of 85.0 %"
    code, said = run("--leg", "no-network-imports", "--imports", str(tmp_path / "list.json"), "--module", "m")
    assert code == 1 and said[1] == "        m reaches net"
    record.write_text(text({"blinding": "no"}))
    assert run("--leg", "validate-corpus")[0] == 1


def test_frozen_corpora(spark, tmp_path):
    loaded = schemas.load()
    assert frozen.versions(str(tmp_path)) == []
    own = tmp_path / "frozen/schema-1/tenor-bell-pitch"
    own.mkdir(parents=True)
    (own / "1931-ferro-01.toml").write_text(text({}))
    (own / "1932-ferro-01.toml").write_text(text({"blinding": "no"}))
    root = str(tmp_path)
    now = lambda: gate.frozen_readings(frozen.frozen_files(spark, root), loaded)
    with pytest.raises(FileNotFoundError):
        frozen.read_readings(spark, root)
    frozen.write_readings(now(), root)
    held = {r.file: r.reading for r in frozen.read_readings(spark, root).collect()}
    assert held["record/tenor-bell-pitch/1932-ferro-01.toml"] == '{"refusals":["value-outside-set at blinding"]}'
    assert problems(gate.changed_readings(frozen.read_readings(spark, root), now())) == ([], 2)
    (own / "1932-ferro-01.toml").write_text(text({"status": "gone"}))
    (own / "1933-ferro-01.toml").write_text(text({}))
    (own / "1931-ferro-01.toml").rename(own / "1930-ferro-01.toml")
    assert problems(gate.changed_readings(frozen.read_readings(spark, root), now()))[0] == [
        f"version 1: record/tenor-bell-pitch/{y}-ferro-01.toml {what}" for y, what in ((1930, "is not frozen"), (1931, "is gone"), (1932, "reads differently"), (1933, "is not frozen"))
    ]
    (tmp_path / "frozen/schema-2").mkdir()
    with pytest.raises(ValueError, match="no file is frozen at schema version 2"):
        frozen.frozen_files(spark, root)
    (tmp_path / "frozen/schema-two").mkdir()
    with pytest.raises(ValueError, match="names no schema version"):
        frozen.versions(root)


def test_legs_stop_at_the_first_that_fails(spark):
    rows = lambda *p: spark.createDataFrame([(x,) for x in p], "problem string")

    def broken():
        raise ValueError("can't be read")

    legs = [gate.Leg("sound", lambda: (rows(), 3)), gate.Leg("empty", lambda: (rows(), 0), needs_some=False), gate.Leg("bad", lambda: (rows("b", "a"), 2)), gate.Leg("after", lambda: (rows(), 1))]
    done = gate.run(legs)
    assert [(o.name, o.state, o.examined, o.problems) for o in done] == [("sound", "passed", 3, ()), ("empty", "passed", 0, ()), ("bad", "failed", 2, ("a", "b")), ("after", "not run", 0, ())]
    assert gate.tally(done) == "2 passed, 1 failed, 1 not run"
    assert gate.run([gate.Leg("x", lambda: (rows(), 0))])[0].problems == ("there is nothing to look at",)
    assert gate.run([gate.Leg("x", broken)])[0].problems == ("can't be read",)
    assert [leg.name for leg in gate.select(legs, ["after", "sound"])] == ["sound", "after"] and len(gate.select(legs, [])) == 4
    owed = gate.run([gate.Leg("later", owed="a profile"), legs[0]])
    assert [(o.state, o.problems) for o in owed] == [("not run", ("a profile",)), ("passed", ())]
    for wrong in ([], [gate.Leg("neither")], [gate.Leg("both", broken, owed="x")]):
        with pytest.raises(ValueError, match="leg"):
            gate.run(wrong)
    with pytest.raises(ValueError, match="no leg other; there are sound, empty, bad, after"):
        gate.select(legs, ["other"])
