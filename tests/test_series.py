"""Series, rule and comparison queries against DuckDB, and numbers known from elsewhere."""

import math
from collections import Counter
from datetime import date
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from metaseries.functions import quantiles
from metaseries.operators import compare, deviation, diagnostics, pooling, tension
from metaseries.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages labels".split()


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return db


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return str(value)


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_query_equals_sql(spark, duck, name):
    found = registry.queries()[name](spark, SF)
    expected = duck.sql(registry.oracle_sql()[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    at = [expected.columns.index(c) for c in columns]
    ours = Counter(tuple(plain(r[c]) for c in columns) for r in found.collect())
    assert ours == Counter(tuple(plain(r[i]) for i in at) for r in expected.fetchall())


def test_student_quantiles(spark):
    known = {1: 12.706205, 2: 4.302653, 5: 2.570582, 10: 2.228139, 30: 2.042272, 100: 1.983972, 1000: 1.962339}
    for df, t in known.items():
        assert quantiles.student_quantile(0.975, df) == pytest.approx(t, abs=1e-6)
    rows = spark.createDataFrame([(df,) for df in (0, *known)], "df long").select("df", quantiles.student_column(F.col("df")).alias("t")).collect()
    assert all((r.t is None) if r.df == 0 else r.t == pytest.approx(known[r.df], abs=2e-6) for r in rows)


@pytest.fixture(scope="module")
def series(spark):
    values = [("a", i, y, s * s, s) for i, (y, s) in enumerate([(10.0, 1.0), (12.0, 1.5), (9.0, 0.5), (15.0, 1.0), (11.0, 2.0)])]
    values += [("one", 0, 5.0, 1.0, 1.0), ("alike", 0, 3.0, 1.0, 1.0), ("alike", 1, 3.0, 1.0, 1.0)]
    return spark.createDataFrame(values, "quantity string, grp long, y double, v double, s double")


def test_paule_mandel_meets_its_equation(series):
    tau = {r.quantity: r.tau2 for r in pooling.paule_mandel_variance(series, ["quantity"]).collect()}
    rows = [(r.y, r.v) for r in series.where("quantity = 'a'").collect()]
    w = [1 / (v + tau["a"]) for _, v in rows]
    mean = sum(x * y for x, (y, _) in zip(w, rows, strict=True)) / sum(w)
    assert sum(x * (y - mean) ** 2 for x, (y, _) in zip(w, rows, strict=True)) == pytest.approx(len(rows) - 1, rel=1e-9)
    assert tau["one"] == tau["alike"] == 0


def test_pools_of_one_and_of_equal_values(series):
    rows = {r.quantity: r for r in pooling.pool_random(series, ["quantity"]).collect()}
    assert (rows["one"].estimate, rows["one"].tau2, rows["one"].se_hk) == (5.0, 0.0, None)
    assert (rows["alike"].estimate, rows["alike"].q, rows["alike"].i2) == (3.0, 0.0, 0.0)
    assert {r.quantity for r in pooling.prediction_interval(series, ["quantity"]).where("lower is null").collect()} == {"one", "alike"}


def test_sides_and_admission(spark):
    rows = spark.createDataFrame([(1.0, 2.0, 0.5, 4.0), (3.0, 2.0, 0.5, 4.0), (2.0, 2.0, 0.5, 4.0), (1.0, 2.0, 0.0, 1.0)], "x double, r double, plus double, minus double")
    z = [r.z for r in rows.select(deviation.deviation(F.col("x"), F.col("r"), F.col("plus"), F.col("minus")).alias("z")).collect()]
    assert z == [-2.0, 0.25, 0.0, None]
    referred = spark.createDataFrame([(1.0, 2.0, 1.0, 3.0), (1.0, 2.0, 1.1, 3.0)], "y double, r double, r_half double, s double")
    assert [r.admitted for r in deviation.deviations(referred).collect()] == [True, False]


def test_wilson(spark):
    low, high = tension.wilson(F.lit(8), F.lit(10))
    r = spark.range(1).select(low.alias("low"), high.alias("high")).first()
    assert (r.low, r.high) == (pytest.approx(0.490162, abs=1e-6), pytest.approx(0.943318, abs=1e-6))


def test_version_bump(spark):
    bump = lambda *c: compare.version_bump(spark.createDataFrame([(x,) for x in c], "change string")).first().bump
    assert (bump(), bump("added"), bump("added", "removed")) == ("PATCH", "MINOR", "MAJOR")


def test_reach(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c")], "src string, dst string")
    assert {tuple(r) for r in compare.reach(edges).collect()} == {("a", "b"), ("b", "c"), ("a", "c")}


def test_trim_and_fill_settles(spark):
    """Against plain Python at the fixed point, on a series that four rounds do not settle."""
    rows = [("a", i, (i / 60) ** 0.5, 1.0) for i in range(60)] + [("b", i, float(i % 7), 1.0) for i in range(40)]

    def settled(own, rounds=None):
        own = sorted(own, key=lambda r: (r[2], r[1]))
        k, filled, done = len(own), None, 0
        while rounds is None or done < rounds:
            kept = own[: k - (filled or 0)]
            c = sum(r[2] / r[3] for r in kept) / sum(1 / r[3] for r in kept)
            ranked = sorted(own, key=lambda r: (abs(r[2] - c), r[1]))
            right = sum(i for i, r in enumerate(ranked, 1) if r[2] > c)
            was, filled, done = filled, max(0, min(k - 2, math.floor((4 * right - k * (k + 1)) / (2 * k - 1) + 0.5))), done + 1
            if filled == was:
                break
        return filled

    table = spark.createDataFrame(rows, "quantity string, grp long, y double, v double")
    found = {r.quantity: r.filled for r in diagnostics.trim_and_fill(table, ["quantity"]).collect()}
    assert found == {q: settled([r for r in rows if r[0] == q]) for q in "ab"}
    assert found["a"] != settled([r for r in rows if r[0] == "a"], 4)


def test_reach_beyond_32_hops_and_in_circles(spark):
    chain = [(i, i + 1) for i in range(36)]
    circle = [(100, 101), (101, 102), (102, 100)]
    found = compare.reach(spark.createDataFrame(chain + circle, "src long, dst long").coalesce(1)).collect()
    expected = {(i, j) for i in range(37) for j in range(i + 1, 37)} | {(i, j) for i in range(100, 103) for j in range(100, 103)}
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected


def test_tight_series_against_exact_fractions(spark):
    """Widths of 1e-10 of the values and less, as of the best measured constants."""
    values = [("g", i, y, s) for i, (y, s) in enumerate([(2.0023318414, 1.2e-9), (2.0023318406, 6e-10), (2.00233184122, 3.3e-10), (2.00233184110, 2.6e-10), (2.0023318420, 9e-10)])]
    values += [("far", i, 1e12 + y, s) for i, (y, s) in enumerate([(0.5, 0.25), (1.75, 0.5), (0.125, 0.25), (3.0, 1.0)])]
    table = spark.createDataFrame([(q, i, y, s * s, s) for q, i, y, s in values], "quantity string, grp long, y double, v double, s double")
    found = {r.quantity: r for r in pooling.pool_random(table, ["quantity"]).collect()}
    lines = {r.quantity: r for r in diagnostics.egger_regression(table, ["quantity"]).collect()}
    root = {r.quantity: r.tau2 for r in pooling.paule_mandel_variance(table, ["quantity"]).collect()}
    for q in ("g", "far"):
        own = [(Fraction(y), Fraction(s * s), Fraction(s)) for name, _, y, s in values if name == q]
        sw = sum(1 / v for _, v, _ in own)
        mean = sum(y / v for y, v, _ in own) / sw
        scatter = sum((y - mean) ** 2 / v for y, v, _ in own)
        assert found[q].q == pytest.approx(float(scatter), rel=1e-6)
        tau2 = max(Fraction(0), (scatter - len(own) + 1) / (sw - sum(1 / v**2 for _, v, _ in own) / sw))
        assert found[q].tau2 == pytest.approx(float(tau2), rel=1e-6)
        w = [1 / (v + tau2) for _, v, _ in own]
        centre = sum(a * y for a, (y, _, _) in zip(w, own, strict=True)) / sum(w)
        spread = sum(a * (y - centre) ** 2 for a, (y, _, _) in zip(w, own, strict=True))
        assert found[q].se_hk == pytest.approx(math.sqrt(spread / ((len(own) - 1) * sum(w))), rel=1e-6)
        x, z = [1 / s for _, _, s in own], [y / s for y, _, s in own]
        mx, mz = sum(x) / len(own), sum(z) / len(own)
        slope = sum((a - mx) * (b - mz) for a, b in zip(x, z, strict=True)) / sum((a - mx) ** 2 for a in x)
        assert lines[q].intercept == pytest.approx(float(mz - slope * mx), rel=1e-5)
        if root[q]:
            w = [1 / (v + Fraction(root[q])) for _, v, _ in own]
            centre = sum(a * y for a, (y, _, _) in zip(w, own, strict=True)) / sum(w)
            assert float(sum(a * (y - centre) ** 2 for a, (y, _, _) in zip(w, own, strict=True))) == pytest.approx(len(own) - 1, rel=1e-6)


def test_cumulative_keeps_to_its_epoch(spark):
    rows = [("q", e, i, date(2000 + i // 2, 1, 1), float(i), 1.0) for i, e in enumerate(["old", "old", "new", "old", "new", "new"])]
    table = spark.createDataFrame(rows, "quantity string, epoch string, grp long, pub date, y double, v double")
    found = {(r.epoch, r.grp): (r.k, r.estimate) for r in pooling.cumulative(table, ["quantity", "epoch"]).collect()}
    assert found == {("old", 0): (1, 0.0), ("old", 1): (2, 0.5), ("old", 3): (3, pytest.approx(4 / 3)), ("new", 2): (1, 2.0), ("new", 4): (2, 3.0), ("new", 5): (3, pytest.approx(11 / 3))}


def test_left_trim_mirrors_right(spark):
    rows = [("a", i, (i / 60) ** 0.5, 1.0) for i in range(60)]
    left = spark.createDataFrame([(q, i, -y, v) for q, i, y, v in rows], "quantity string, grp long, y double, v double")
    right = diagnostics.trim_and_fill(spark.createDataFrame(rows, left.schema), ["quantity"]).first()
    found = diagnostics.trim_and_fill(left, ["quantity"], side="left").first()
    assert (found.filled, found.estimate, found.adjusted) == (right.filled, pytest.approx(-right.estimate), pytest.approx(-right.adjusted))


def judged(spark, rows, corrections=None):
    """Outcome of each tension; the accepted value is 10 with half-width 1, tensions are |z| >= 2."""
    table = spark.createDataFrame([("q", i, "t", date(2000 + year, 1, 1), float(y), float(s), float(s * s), 10.0, 1.0, date(2020, 1, 1), "modern") for i, (year, y, s) in enumerate(rows)],
                                  "quantity string, grp long, technique string, pub date, y double, s double, v double, r double, r_half double, vintage date, reference_kind string")
    scored = deviation.deviations(table).cache()
    held = None if corrections is None else spark.createDataFrame([("q", i, "t", side) for i, side in corrections], "quantity string, grp long, technique string, side string")
    tensions = scored.where("admitted and abs(z) >= 2")
    return scored, tension.outcomes(tensions, scored, ["quantity"], held)


def test_the_four_outcomes(spark):
    cases = {
        "a later admitted value on its side, outside the interval": ([(0, 20, 4), (1, 12, 4)], "confirmed"),
        "one on the other side does not speak": ([(0, 20, 4), (1, 3, 3.4)], "unresolved"),
        "one within the interval": ([(0, 20, 4), (1, 10.5, 4)], "refuted"),
        "at the interval's end": ([(0, 20, 4), (1, 11, 4)], "refuted"),
        "the first day decides": ([(0, 20, 4), (1, 12, 4), (2, 10, 4)], "confirmed"),
        "both on one day": ([(0, 20, 4), (1, 12, 4), (1, 10, 4)], "refuted"),
        "a later one that is not admitted": ([(0, 20, 4), (1, 12, 2.9)], "unresolved"),
        "the same day is not later": ([(0, 20, 4), (0, 10, 4)], "unresolved"),
        "an earlier one": ([(1, 20, 4), (0, 10, 4)], "unresolved"),
        "below, and its side is below": ([(0, 0, 4), (1, 8, 4)], "confirmed"),
        "nothing at all": ([(0, 20, 4)], "unresolved"),
    }
    for name, (rows, expected) in cases.items():
        found = judged(spark, rows)[1].where("grp = 0").collect()
        assert [(r.outcome, r.counts_as) for r in found] == [(expected, None if expected == "unresolved" else expected)], name
    for side in ("confirmed", "refuted"):
        found = judged(spark, [(0, 20, 4), (1, 12, 4)], [(0, side)])[1].where("grp = 0").first()
        assert (found.outcome, found.counts_as) == ("explained", side)


def test_probability_carries_its_conditions(spark, tmp_path):
    rows = [(0, 20, 4), (1, 12, 4), (2, 30, 4), (3, 10.5, 4), (4, 25, 4), (5, 40, 4)]
    scored, found = judged(spark, rows, [(4, "refuted")])
    n = tension.outcome_counts(found, scored.where("admitted"), ["quantity"]).first()
    assert (n.scored, n.tensions, n.confirmed, n.refuted, n.explained, n.unresolved, n.real, n.not_real) == (6, 4, 1, 1, 1, 1, 1, 2)
    table = tension.probability(found, scored.where("admitted"), ["quantity"], 2.0, "a third")
    p = table.first().probability
    assert tuple(p.asDict()) == tension.MEMBERS and len(tension.MEMBERS) == 11
    assert (p["count"], p.number.resolved_only, p.number.censored.low, p.number.censored.high) == (3, pytest.approx(1 / 3), 0.25, 0.5)
    assert (p.unresolved["count"], p.unresolved.share, p.quantities, p.disciplines, p.reference.choice) == (1, 0.25, ["q"], ["t"], "modern")
    assert (p.reference.vintage, p.period["from"], p.period.to, p.k) == (date(2020, 1, 1), date(2000, 1, 1), date(2005, 1, 1), 2.0)
    with pytest.raises(ValueError, match="CSV"):
        tension.write_csv(table, str(tmp_path / "p"))
    tension.write_csv(tension.outcome_counts(found, scored, ["quantity"]), str(tmp_path / "n"))


def test_side_selection_does_not_hang_on_the_order_of_a_sum(spark, tmp_path):
    """A value at its group's mean is on neither side, however the mean was rounded."""
    import pandas as pd

    exact, high = (0.2, 0.2, 0.1, 0.3, 0.2), (0.2, 0.2, 0.2, 0.3, 0.1)
    assert sum_in_order(exact) / 5 == 0.2 < sum_in_order(high) / 5
    groups = {1: exact, 2: high, 3: (0.01, 0.02, 0.03, 0.05, 0.06)}
    rows = [("q", user, x) for user, own in groups.items() for x in own]
    pd.DataFrame(rows, columns=["event_type", "user_id", "value"]).to_parquet(tmp_path / "events.parquet")
    found = {r.grp: r.z for r in registry.queries()["side_selection"](spark, str(tmp_path)).collect()}
    db = duckdb.connect()
    db.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    expected = {grp: z for _, grp, z in db.sql(registry.oracle_sql()["side_selection"]).fetchall()}
    mean = sum(x for _, _, x in rows) / len(rows)
    assert found[1] == found[2] == pytest.approx((0.2 - mean) / 0.1, abs=1e-5)
    assert found == expected


def sum_in_order(values):
    total = 0.0
    for x in values:
        total += x
    return total


def shuffled_rows(spark):
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return sum(s.shuffleWriteRecords() for s in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(stages))


def test_pair_tensions_of_a_long_series_move_few_rows(spark):
    """Counts by brute force, ties at the bound and equal studies among them; a study goes to no more tasks than there are blocks."""
    import numpy as np

    draw = np.random.default_rng(3)
    y, s = draw.normal(0, 2, 6000).round(1), draw.choice([3.0, 4.0, 0.5, 1.25, 0.013], 6000) * np.where(draw.random(6000) < 0.5, 1, draw.random(6000) + 0.01)
    table = spark.createDataFrame([("q", i, float(a), float(b)) for i, (a, b) in enumerate(zip(y, s, strict=True))] + [("one", 1, 0.0, 1.0)], "quantity string, grp long, y double, s double")
    hit = np.abs(y[:, None] - y[None, :]) / np.sqrt(s[:, None] ** 2 + s[None, :] ** 2) >= 2.0
    before = shuffled_rows(spark)
    found = {r.quantity: (r.pairs, r.tensions, r.measurements, r.quantities) for r in tension.pair_tensions(table, ["quantity"], 2.0).collect()}
    assert found == {"q": (6000 * 5999 // 2, int(hit.sum()) // 2, int(hit.any(1).sum()), 1), "one": (0, 0, 0, 1)}
    assert shuffled_rows(spark) - before < 30 * 6000


def test_cumulative_nodes_end_with_their_last_question(spark):
    """Each tau2's sums take the studies up to the last one that asks for them, not the whole series once a tau2."""
    rows = [("q", i, date(2000, 1, 1 + i % 28), float(i % 7) * (1 + 50 * (i < 40)), 1.0 + i % 3) for i in range(4000)]
    table = spark.createDataFrame(rows, "quantity string, grp long, pub date, y double, v double")
    before = shuffled_rows(spark)
    last = max(pooling.cumulative(table, ["quantity"]).collect(), key=lambda r: r.k)
    moved = shuffled_rows(spark) - before
    whole = pooling.pool_random(table, ["quantity"]).first()
    assert (last.k, last.tau2, last.estimate, last.se) == (4000, pytest.approx(whole.tau2), pytest.approx(whole.estimate), pytest.approx(whole.se))
    print("moved", moved)
    assert moved < 20 * 4000
