"""Pooled estimates of measurement series, from sums over studies.

All estimators are built from weighted sums, so a series of any length is
pre-aggregated where its studies lie. Values are taken from a value of their own series
first, so that sums keep their digits where widths are a billionth of the values. ``studies`` have ``y`` and ``v`` (value and
variance, v > 0) and key columns. Sources of the formulas: inverse-variance pooling;
DerSimonian and Laird 1986; Paule and Mandel 1982; Hartung and Knapp 2001; Birge 1932;
Higgins, Thompson and Spiegelhalter 2009 for the prediction interval.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaseries.functions.quantiles import student_column
from metaseries.sources.tables import materialise

from .ordered import asof, running


def centred(studies: DataFrame, keys: list[str]) -> DataFrame:
    """``studies`` with ``pivot``, the least value of the key, and ``d``, the distance from it."""
    if "pivot" in studies.columns:
        return studies
    pivot = studies.groupBy(*keys).agg(F.min("y").alias("pivot"))
    return studies.join(pivot, keys).withColumn("d", F.col("y") - F.col("pivot"))


def weighted_sums(studies: DataFrame, keys: list[str], weight: Column | None = None) -> DataFrame:
    """``k, pivot, sw, swd, swdd, sww`` of each key; ``d`` is the distance from the pivot."""
    w = 1 / F.col("v") if weight is None else weight
    d = F.col("d")
    return centred(studies, keys).groupBy(*keys, "pivot").agg(
        F.count("d").alias("k"), F.sum(w).alias("sw"), F.sum(w * d).alias("swd"), F.sum(w * d * d).alias("swdd"), F.sum(w * w).alias("sww")
    )


def centre() -> Column:
    """The weighted mean of weighted sums."""
    return F.col("pivot") + F.col("swd") / F.col("sw")


def scatter() -> Column:
    """Cochran's Q of weighted sums."""
    return F.greatest(F.lit(0.0), F.col("swdd") - F.col("swd") * F.col("swd") / F.col("sw"))


def pool_fixed(studies: DataFrame, keys: list[str]) -> DataFrame:
    """``k, estimate, se, q`` under the fixed-effect model."""
    return weighted_sums(studies, keys).select(*keys, "k", centre().alias("estimate"), F.sqrt(1 / F.col("sw")).alias("se"), scatter().alias("q"))


def between_variance(studies: DataFrame, keys: list[str]) -> DataFrame:
    """``k, q, tau2`` by DerSimonian and Laird; tau2 is 0 for a single study."""
    spare = F.col("sw") - F.col("sww") / F.col("sw")
    tau2 = F.greatest(F.lit(0.0), F.coalesce(F.try_divide(scatter() - (F.col("k") - 1), spare), F.lit(0.0)))
    return weighted_sums(studies, keys).select(*keys, "k", scatter().alias("q"), F.when(F.col("k") > 1, tau2).otherwise(0.0).alias("tau2"))


def paule_mandel_variance(studies: DataFrame, keys: list[str], rounds: int = 100, close: float = 1e-12) -> DataFrame:
    """``k, q, tau2`` by Paule and Mandel: tau2 such that Q(tau2) = k - 1.

    Newton rounds from 0, each one aggregation; Q falls and is convex in tau2, so the
    rounds rise to the root. One row a key is all that is kept between rounds. If they
    have not settled after ``rounds``, that is an error.
    """
    studies = materialise(centred(studies, keys).select(*keys, "y", "v", "pivot", "d"))
    held = materialise(between_variance(studies, keys).select(*keys, "k", "q", F.lit(0.0).alias("tau2")))
    for _ in range(rounds):
        w = 1 / (F.col("v") + F.col("tau2"))
        with_mean = studies.join(held, keys)
        mean = weighted_sums(with_mean, keys, w).select(*keys, (F.col("swd") / F.col("sw")).alias("m"))
        off = (F.col("d") - F.col("m")) ** 2
        step = with_mean.join(mean, keys).groupBy(*keys).agg(F.sum(w * off).alias("qt"), F.sum(w * w * off).alias("slope"))
        rise = F.when((F.col("k") > 1) & (F.col("qt") > F.col("k") - 1), F.coalesce(F.try_divide(F.col("qt") - (F.col("k") - 1), F.col("slope")), F.lit(0.0))).otherwise(0.0)
        after = materialise(held.join(step, keys).select(*keys, "k", "q", (F.col("tau2") + rise).alias("tau2"), rise.alias("rise")))
        held = after.drop("rise")
        if after.where(F.col("rise") > F.lit(close) * (1 + F.col("tau2"))).isEmpty():
            return held
    raise ValueError(f"Paule and Mandel's tau2 does not settle in {rounds} rounds")


def pool_random(studies: DataFrame, keys: list[str], variance: DataFrame | None = None) -> DataFrame:
    """``k, q, i2, tau2, estimate, se, se_hk`` under the random-effects model.

    ``variance`` defaults to DerSimonian and Laird's; ``se_hk`` is Hartung and Knapp's
    standard error, null for a single study.
    """
    held = between_variance(studies, keys) if variance is None else variance
    w = 1 / (F.col("v") + F.col("tau2"))
    sums = weighted_sums(studies.join(held.select(*keys, "tau2"), keys), keys, w).drop("k")
    i2 = F.when(F.col("q") > 0, F.greatest(F.lit(0.0), (F.col("q") - (F.col("k") - 1)) / F.col("q"))).otherwise(0.0)
    return held.join(sums, keys).select(
        *keys,
        "k",
        "q",
        i2.alias("i2"),
        "tau2",
        centre().alias("estimate"),
        F.sqrt(1 / F.col("sw")).alias("se"),
        F.sqrt(F.try_divide(scatter(), (F.col("k") - 1) * F.col("sw"))).alias("se_hk"),
    )


def scale_factor(studies: DataFrame, keys: list[str]) -> DataFrame:
    """The comparison view: the fixed-effect centre with a width scaled by Birge's ratio, where over 1."""
    ratio = F.sqrt(F.greatest(F.lit(1.0), F.coalesce(F.try_divide(F.col("q"), F.col("k") - 1), F.lit(1.0))))
    return pool_fixed(studies, keys).select(*keys, "k", "estimate", ratio.alias("scale"), (F.col("se") * ratio).alias("se_scaled"), F.lit("scale-factor view").alias("view"))


def prediction_interval(studies: DataFrame, keys: list[str]) -> DataFrame:
    """95 % prediction interval of a further study's true value; null under three studies."""
    half = student_column(F.col("k") - 2) * F.sqrt(F.col("tau2") + F.col("se") * F.col("se"))
    return pool_random(studies, keys).select(*keys, "k", "estimate", (F.col("estimate") - half).alias("lower"), (F.col("estimate") + half).alias("upper"))


#: Random-effects sums at variances that differ from row to row: nodes lie STEP apart in
#: log(least v + tau2), so 1 / (v + tau2) is a power series around a node's with a ratio
#: under 0.1, and TERMS of it leave a relative error under 1e-12.
STEP, TERMS = 0.19, 12


def _off_node() -> tuple[Column, Column]:
    """The node nearest to a row's ``tau2`` given its key's ``least`` variance, and how far off it the row is."""
    total = F.col("least") + F.col("tau2")
    node = F.round(F.log(total) / STEP).cast("long")
    return node, total - F.exp(node * STEP)


def _moments() -> dict[str, Column]:
    """The terms that a study adds to a node's sums of weights (a) and of weighted distances (b)."""
    w = 1 / (F.col("v") - F.col("least") + F.exp(F.col("node") * STEP))
    powers = {m: w if m == 0 else F.pow(w, m + 1) for m in range(TERMS)}
    return {f"a{m}": w for m, w in powers.items()} | {f"b{m}": w * F.col("d") for m, w in powers.items()}


def _at_off(name: str) -> Column:
    """The sum of weights (a) or weighted distances (b) at a row's own tau2, from its node's."""
    out = F.col(f"{name}{TERMS - 1}")
    for m in range(TERMS - 2, -1, -1):
        out = F.col(f"{name}{m}") - F.col("off") * out
    return out


def _spread(n: Column, sw: Column, swd: Column, swdd: Column, sww: Column) -> Column:
    """DerSimonian and Laird's tau2 from sums over n studies; 0 for a single one."""
    q = F.greatest(F.lit(0.0), swdd - swd * swd / sw)
    return F.when(n > 1, F.greatest(F.lit(0.0), F.coalesce(F.try_divide(q - (n - 1), sw - sww / sw), F.lit(0.0)))).otherwise(0.0)


def cumulative(studies: DataFrame, keys: list[str], model: str = "random") -> DataFrame:
    """The estimate after each study in order of publication, within each key: ``k, tau2, estimate, se, unordered``.

    Where the studies have ``pub_end``, a study came out between ``pub`` and ``pub_end``
    and the order is by the latter; ``unordered`` counts the other studies that may have
    come out on either side of this one. ``model`` is ``random``, each estimate with the
    tau2 of its own studies, or ``fixed``. Running sums are carried over ranges, so no
    task holds a key. Name the definition epoch among the keys where a series has
    several: estimates never run across them.
    """
    w, d = 1 / F.col("v"), F.col("d")
    rows = centred(with_span(studies), keys).withColumn("w", w)
    order = [F.col(c).asc() for c in ("pub_end", "pub", "grp")]
    one = F.lit(1).cast("long")
    upto = running(rows, keys, order, {"k": ("sum", one), "sw": ("sum", F.col("w")), "swd": ("sum", F.col("w") * d), "swdd": ("sum", F.col("w") * d * d), "sww": ("sum", F.col("w") * F.col("w"))})
    own = [*keys, "grp", "pub", "pub_end"]
    if model == "fixed":
        found = upto.select(*own, "k", F.lit(0.0).alias("tau2"), (F.col("pivot") + F.col("swd") / F.col("sw")).alias("estimate"), F.sqrt(1 / F.col("sw")).alias("se"))
    else:
        least = studies.groupBy(*keys).agg(F.min("v").alias("least"))
        node, off = _off_node()
        placed = upto.withColumn("tau2", _spread(*[F.col(c) for c in ("k", "sw", "swd", "swdd", "sww")])).join(least, keys).withColumn("node", node).withColumn("off", off)
        placed = materialise(placed.select(*own, "k", "pivot", "least", "v", "d", "tau2", F.col("node").alias("its"), "off"))
        # a node takes the studies up to the last one that asks for it
        turn = F.struct("pub_end", "pub", "grp")
        nodes = placed.groupBy(*keys, F.col("its").alias("node")).agg(F.max(turn).alias("last"))
        sums = running(placed.join(nodes, keys).where(turn <= F.col("last")).drop("last"), [*keys, "node"], order, {name: ("sum", c) for name, c in _moments().items()}).where("node = its")
        found = sums.select(*own, "k", "tau2", (F.col("pivot") + _at_off("b") / _at_off("a")).alias("estimate"), F.sqrt(1 / _at_off("a")).alias("se"))
    return found.join(unordered(studies, keys).distinct(), own).drop("pub_end")


def with_span(studies: DataFrame) -> DataFrame:
    """``studies`` with ``pub_end``, the last day on which one may have come out: ``pub`` itself where it is not given."""
    return studies if "pub_end" in studies.columns else studies.withColumn("pub_end", F.col("pub"))


def unordered(studies: DataFrame, keys: list[str]) -> DataFrame:
    """``grp, pub, pub_end, unordered``: how many other studies of its key may have come out before a study and after it."""
    rows = with_span(studies).select(*keys, "grp", "pub", "pub_end")
    one = {"n": ("sum", F.lit(1).cast("long"))}
    before = asof(rows.withColumnRenamed("pub_end", "day"), rows.withColumnRenamed("pub", "day"), keys, "day", one, "before").withColumnsRenamed({"day": "pub", "n": "earlier"})
    both = asof(rows.withColumnRenamed("pub", "day"), before.withColumnRenamed("pub_end", "day"), keys, "day", one, "after").withColumnsRenamed({"day": "pub_end", "n": "later"})
    every = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("all"))
    none = F.lit(0).cast("long")
    return both.join(every, keys).select(*keys, "grp", "pub", "pub_end", (F.col("all") - 1 - F.coalesce("earlier", none) - F.coalesce("later", none)).alias("unordered"))


def leave_one_out(studies: DataFrame, keys: list[str], model: str = "random") -> DataFrame:
    """Each study with the estimate of all others of its key, ``reference`` and ``reference_se``; null if alone.

    ``model`` is ``random``, each with the tau2 of the others, or ``fixed``.
    """
    w, d = 1 / F.col("v"), F.col("d")
    sums = weighted_sums(studies, keys).join(studies.groupBy(*keys).agg(F.min("v").alias("least")), keys).withColumnsRenamed({"k": "of", "pivot": "at"})
    rows = studies.join(sums, keys).withColumn("d", F.col("y") - F.col("at"))
    rest = {"sw": F.col("sw") - w, "swd": F.col("swd") - w * d, "swdd": F.col("swdd") - w * d * d, "sww": F.col("sww") - w * w}
    several = F.col("of") > 1
    if model == "fixed":
        weight, moved = rest["sw"], rest["swd"]
    else:
        node, off = _off_node()
        tau2 = F.when(several, _spread(F.col("of") - 1, *rest.values()))
        rows = materialise(rows.withColumn("tau2", tau2).withColumn("node", node).withColumn("off", off))
        nodes = rows.where(several).select(*keys, "node").distinct()
        held = rows.select(*keys, "v", "d", "least").join(nodes, keys).groupBy(*keys, "node").agg(*[F.sum(c).alias(name) for name, c in _moments().items()])
        rows = rows.join(held, [*keys, "node"], "left")
        own = 1 / (F.col("v") + F.col("tau2"))
        weight, moved = _at_off("a") - own, _at_off("b") - own * d
    rest = F.when(several, weight)
    return rows.select(*studies.columns, (F.col("at") + F.try_divide(moved, rest)).alias("reference"), F.sqrt(F.try_divide(F.lit(1.0), rest)).alias("reference_se"))


def pool_correlated(studies: DataFrame, keys: list[str], model: str = "random") -> DataFrame:
    """``k, groups, q, tau2, estimate, se`` by generalised least squares, with a systematic shared in each ``correlation_group``.

    ``shared`` is the part of a study's width that it has in common with the studies of
    its group; what is left of ``v`` is its own. The covariance is the own variances and,
    within a group, the products of the shared widths; a group's block is inverted by its
    sums (Sherman and Morrison 1950), so no matrix is built. Studies without a group, or
    with a shared width of 0, are independent. ``groups`` counts the groups of several
    studies. tau2 is DerSimonian and Laird's with the full weight matrix, 0 under
    ``model`` fixed. A shared width that leaves no own variance is an error, and so is a
    study with ``several_groups``.
    """
    u = F.when(F.col("correlation_group").isNotNull(), F.coalesce("shared", F.lit(0.0))).otherwise(0.0)
    own = F.col("v") - u * u
    several = F.col("several_groups") if "several_groups" in studies.columns else F.lit(False)
    wrong = F.raise_error(F.lit("a study whose shared width leaves no variance of its own, or with several correlation groups")).cast("double")
    rows = centred(studies, keys).withColumn("u", u).withColumn("own", F.when((own > 0) & ~several, own).otherwise(wrong))
    rows = materialise(rows.select(*keys, "correlation_group", "pivot", "d", "u", "own"))

    def sums(rows: DataFrame) -> DataFrame:
        w, d, u = F.col("w"), F.col("d"), F.col("u")
        parts = {"a": w, "b": w * d, "dd": w * d * d, "c": w * u, "e": w * u * d, "f": w * u * u, "w2": w * w, "w2u": w * w * u, "w2uu": w * w * u * u}
        blocks = rows.groupBy(*keys, "pivot", "correlation_group").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(name) for name, c in parts.items()])
        more = 1 + F.col("f")
        lean = F.col("c") / more
        several = F.count(F.when(F.col("correlation_group").isNotNull() & (F.col("n") > 1), 1))
        return blocks.groupBy(*keys, "pivot").agg(
            F.sum("n").alias("k"), several.alias("groups"), F.sum(F.col("a") - lean * F.col("c")).alias("sw"), F.sum(F.col("b") - lean * F.col("e")).alias("swd"), F.sum(F.col("dd") - F.col("e") * F.col("e") / more).alias("swdd"),
            F.sum(F.col("a") - F.col("w2uu") / more).alias("trace"), F.sum(F.col("w2") - 2 * lean * F.col("w2u") + lean * lean * F.col("w2uu")).alias("sww"),
        )

    fixed = sums(rows.withColumn("w", 1 / F.col("own")))
    spare = F.col("trace") - F.col("sww") / F.col("sw")
    tau2 = F.greatest(F.lit(0.0), F.coalesce(F.try_divide(scatter() - (F.col("k") - 1), spare), F.lit(0.0)))
    held = fixed.select(*keys, scatter().alias("q"), F.when(F.lit(model != "fixed") & (F.col("k") > 1), tau2).otherwise(0.0).alias("tau2"))
    pooled = sums(rows.join(held, keys).withColumn("w", 1 / (F.col("own") + F.col("tau2"))))
    return pooled.join(held, keys).select(*keys, "k", "groups", "q", "tau2", centre().alias("estimate"), F.sqrt(1 / F.col("sw")).alias("se"))


def latest(studies: DataFrame, keys: list[str]) -> DataFrame:
    """The last published study of each key; of equal dates, the largest group."""
    fields = [c for c in studies.columns if c not in keys]
    last = F.max(F.struct("pub", "grp", *[c for c in fields if c not in ("pub", "grp")])).alias("_last")
    return studies.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in fields])
