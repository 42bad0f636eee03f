"""Funnel points, small-study regression, trim and fill, deviation histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaseries.functions.quantiles import normal_quantile
from metaseries.sources.tables import materialise

from .ordered import ranked
from .pooling import centre, centred, pool_fixed, pool_random, weighted_sums


def funnel_points(studies: DataFrame, keys: list[str]) -> DataFrame:
    """Each study's distance from its key's fixed-effect estimate, and its half-width."""
    centre = pool_fixed(studies, keys).select(*keys, "estimate")
    return studies.join(centre, keys).select(*keys, "grp", "technique", (F.col("y") - F.col("estimate")).alias("off"), "s")


def egger_regression(studies: DataFrame, keys: list[str]) -> DataFrame:
    """Regression of y / s on 1 / s (Egger et al. 1997): ``k, intercept, slope, t``; null under three studies.

    Values are taken from the series' least, which lowers the slope by as much and leaves
    the intercept, and 1 / s from the widest study's.
    """
    least = studies.groupBy(*keys).agg(F.min(1 / F.col("s")).alias("px"))
    x, z = 1 / F.col("s") - F.col("px"), F.col("d") / F.col("s")
    sums = centred(studies, keys).join(least, keys).groupBy(*keys, "pivot", "px").agg(F.count(F.lit(1)).alias("k"), F.sum(x).alias("sx"), F.sum(z).alias("sz"), F.sum(x * x).alias("sxx"), F.sum(x * z).alias("sxz"), F.sum(z * z).alias("szz"))
    k = F.col("k")
    cxx, cxz, czz = (F.col(a) - F.col(b) * F.col(c) / k for a, b, c in (("sxx", "sx", "sx"), ("sxz", "sx", "sz"), ("szz", "sz", "sz")))
    slope = F.try_divide(cxz, F.when(k > 2, cxx))
    fitted = sums.withColumn("slope", slope).withColumn("cxx", cxx).withColumn("rest", F.greatest(F.lit(0.0), czz - slope * cxz))
    mean = F.col("px") + F.col("sx") / F.col("k")
    intercept = F.col("sz") / F.col("k") - F.col("slope") * mean
    error = F.sqrt(F.try_divide(F.col("rest"), F.col("k") - 2) * (1 / F.col("k") + mean**2 / F.col("cxx")))
    return fitted.select(*keys, "k", intercept.alias("intercept"), (F.col("pivot") + F.col("slope")).alias("slope"), F.try_divide(intercept, error).alias("t"))


def trim_and_fill(studies: DataFrame, keys: list[str], side: str = "right") -> DataFrame:
    """Duval and Tweedie's L0: ``k, filled, estimate, adjusted``; studies in excess on the right are trimmed, or on the ``left``.

    Each round centres on the studies without the ``filled`` largest values, ranks the
    distances from there, and takes the number of unmatched studies on the right from
    the ranks. The filled mirror images then enter the pool. Rounds go on until no key's
    ``filled`` changes; a key whose rounds come back to an earlier number keeps going
    round, which is an error. Ranks are carried over ranges, so no task holds a key.
    """
    if side == "left":
        mirrored = trim_and_fill(studies.withColumn("y", -F.col("y")), keys)
        return mirrored.select(*keys, "k", (-F.col("estimate")).alias("estimate"), (-F.col("adjusted")).alias("adjusted"), "filled")
    series = studies.select(*keys, "grp", "y", "v")
    sizes = series.groupBy(*keys).agg(F.count(F.lit(1)).alias("k"))
    placed = materialise(ranked(series.join(sizes, keys), keys, [F.col("y").asc(), F.col("grp").asc()], "place"))
    state, seen = None, set()
    while True:
        kept = placed if state is None else placed.join(state.select(*keys, "filled"), keys).where(F.col("place") <= F.col("k") - F.col("filled"))
        centre = pool_fixed(kept.select(*keys, "y", "v"), keys).select(*keys, F.col("estimate").alias("c"))
        ranks = ranked(placed.join(centre, keys).withColumn("off", F.abs(F.col("y") - F.col("c"))), keys, [F.col("off").asc(), F.col("grp").asc()], "r")
        n = F.col("k")
        l0 = (4 * F.col("right") - n * (n + 1)) / (2 * n - 1)
        summed = ranks.groupBy(*keys, "k", "c").agg(F.sum(F.when(F.col("y") > F.col("c"), F.col("r")).otherwise(0)).alias("right"))
        before, state = state, materialise(summed.select(*keys, "k", "c", F.greatest(F.lit(0), F.least(n - 2, F.floor(l0 + 0.5))).cast("long").alias("filled")))
        if before is None:
            continue
        was = before.select(*keys, F.col("filled").alias("was"))
        if state.join(was, keys).where("filled <> was").isEmpty():
            break
        # one hash of all keys' numbers: met again only if the rounds go in a circle
        mark = state.agg(F.sum(F.xxhash64(*keys, "filled").cast("decimal(38,0)"))).first()[0]
        if mark in seen:
            raise ValueError("trim and fill does not settle")
        seen.add(mark)
    mirrored = placed.drop("k").join(state, keys).where(F.col("place") > F.col("k") - F.col("filled")).select(*keys, (2 * F.col("c") - F.col("y")).alias("y"), "v")
    adjusted = pool_fixed(placed.select(*keys, "y", "v").unionByName(mirrored), keys).select(*keys, F.col("estimate").alias("adjusted"))
    plain = pool_fixed(placed, keys).select(*keys, "k", "estimate")
    return plain.join(adjusted, keys).join(state.select(*keys, "filled"), keys)


def forest_rows(studies: DataFrame, keys: list[str], level: float = 0.95) -> DataFrame:
    """The lines of a forest plot: each study with its interval and weight, in order of publication, then the key's pooled lines.

    ``kind`` is study, fixed or random; ``weight`` the share in the fixed-effect pool.
    """
    z = normal_quantile(0.5 + level / 2)
    fixed, random = pool_fixed(studies, keys), pool_random(studies, keys)
    line = lambda d, kind, label, y, s, weight: d.select(
        *keys, F.lit(kind).alias("kind"), label.cast("string").alias("label"), y.alias("y"), (y - z * s).alias("lower"), (y + z * s).alias("upper"), weight.alias("weight")
    )
    joined = studies.join(fixed.select(*keys, F.col("se").alias("of")), keys)
    own = line(joined, "study", F.concat_ws(" ", F.col("pub"), F.col("grp")), F.col("y"), F.sqrt("v"), F.col("of") ** 2 / F.col("v"))
    pools = [line(d, kind, F.lit(None), F.col("estimate"), F.col("se"), F.lit(None).cast("double")) for d, kind in ((fixed, "fixed"), (random, "random"))]
    return own.unionByName(pools[0]).unionByName(pools[1])


def histogram(deviations: DataFrame, by: list[str], width: float = 0.5, last: float = 5.0) -> DataFrame:
    """Counts of |z| in bins of ``width``; all from ``last`` on share one."""
    at = F.least(F.floor(F.abs("z") / width), F.lit(int(last / width))).cast("long")
    return deviations.groupBy(*by, at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def shares(studies: DataFrame, by: list[str]) -> DataFrame:
    """Count, mean width and pooled estimate by any split of the series."""
    return weighted_sums(studies, by).select(*by, "k", centre().alias("estimate"))
