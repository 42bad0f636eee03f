"""Signed deviations from reference values, admission and exclusion accounting."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaseries.sources.accepted import NOW, at_vintage

from .ordered import asof
from .pooling import centred, leave_one_out, pool_fixed, with_span

#: Of a reference's half-width to a measurement's, the largest ratio admitted.
ADMITTED = 1 / 3


def side_width(x: Column, r: Column, plus: Column, minus: Column) -> Column:
    """The half-width facing the reference: plus below it, minus above; the larger at it."""
    return F.when(x < r, plus).when(x > r, minus).otherwise(F.greatest(plus, minus))


def deviation(x: Column, r: Column, plus: Column, minus: Column) -> Column:
    """(x - r) / s with the facing half-width; the reference's own width is never added."""
    return F.try_divide(x - r, side_width(x, r, plus, minus))


def accepted_values(studies: DataFrame, keys: list[str]) -> DataFrame:
    """``r, r_half, vintage`` of each key: the pool of all that was published up to the vintage, the last day.

    It stands in where no accepted value is handed in. Studies that dominate it are those
    that the admission rule leaves out.
    """
    last = studies.groupBy(*keys).agg(F.max("pub").alias("vintage"))
    return pool_fixed(studies, keys).join(last, keys).select(*keys, F.col("estimate").alias("r"), F.col("se").alias("r_half"), "vintage")


#: A pin-down settles a quantity where its width is at most this share of every width in the series before it.
FAR_BELOW = 1 / 10


def references(studies: DataFrame, keys: list[str], accepted: DataFrame | None = None, vintage: date | None = None, model: str = "random") -> DataFrame:
    """Each study with its reference value under four kinds: ``reference_kind, r, r_half, vintage``.

    ``modern``: the value of ``accepted`` (``keys, value, half_width, valid_from,
    pins_down``) that held on the day ``vintage``, by default the last; where no table is
    given, ``accepted_values``. ``later``: the pool of all studies that came out after
    it for sure. ``leave-one-out``: the pool of all others, by ``model``. ``resolved``:
    the first accepted value up to the vintage that is declared to pin the quantity down
    and is far narrower (``FAR_BELOW``) than every study before it; only for those
    studies. The vintage is the last day that a value takes in.
    """
    studies = with_span(studies)
    columns = studies.columns
    kind = lambda d, name: d.select(*columns, F.lit(name).alias("reference_kind"), "r", "r_half", "vintage")
    day = vintage or NOW
    if accepted is None:
        modern = studies.join(accepted_values(studies, keys), keys)
    else:
        series = studies.select(*keys).distinct().withColumn("day", F.lit(day))
        modern = studies.join(at_vintage(accepted, series, keys, "day").where("r is not null").drop("day"), keys)
    w = 1 / F.col("v")
    rows = centred(studies, keys)
    sums = {"w": ("sum", w), "wd": ("sum", w * F.col("d")), "vintage": ("max", F.col("pub_end"))}
    asked = rows.select(*columns, "pivot", F.col("pub_end").alias("day"))
    ahead = asof(rows.withColumn("day", F.col("pub")), asked, keys, "day", sums, "after").where("w is not null")
    later = ahead.withColumn("r", F.col("pivot") + F.col("wd") / F.col("w")).withColumn("r_half", F.sqrt(1 / F.col("w")))
    last = studies.groupBy(*keys).agg(F.max("pub_end").alias("vintage"))
    others = leave_one_out(studies, keys, model).join(last, keys).withColumnRenamed("reference", "r").withColumnRenamed("reference_se", "r_half").where("r is not null")
    found = kind(modern, "modern").unionByName(kind(later, "later")).unionByName(kind(others, "leave-one-out"))
    return found if accepted is None else found.unionByName(kind(resolved(studies, keys, accepted, day), "resolved"))


def resolved(studies: DataFrame, keys: list[str], accepted: DataFrame, day: date) -> DataFrame:
    """The studies that came out before a value that pinned their quantity down, with it: ``r, r_half, vintage``."""
    declared = accepted.where(F.col("pins_down") & (F.col("valid_from") <= F.lit(day))).select(*keys, F.col("valid_from").alias("day"), "value", "half_width")
    before = asof(studies.withColumn("day", F.col("pub_end")), declared, keys, "day", {"narrowest": ("min", F.col("s"))}, "before")
    far = before.where(F.col("half_width") <= F.lit(FAR_BELOW) * F.col("narrowest"))
    first = far.groupBy(*keys).agg(F.min(F.struct("day", "half_width", "value")).alias("p"))
    rows = studies.join(first, keys).where(F.col("pub_end") < F.col("p.day"))
    return rows.select(*studies.columns, F.col("p.value").alias("r"), F.col("p.half_width").alias("r_half"), F.col("p.day").alias("vintage"))


def deviations(referred: DataFrame, plus: str = "s", minus: str = "s", admitted: float = ADMITTED) -> DataFrame:
    """``referred`` with ``z``, ``ratio`` (reference's half-width to the facing one) and ``admitted``."""
    facing = side_width(F.col("y"), F.col("r"), F.col(plus), F.col(minus))
    return (
        referred.withColumn("z", deviation(F.col("y"), F.col("r"), F.col(plus), F.col(minus)))
        .withColumn("ratio", F.try_divide(F.col("r_half"), facing))
        .withColumn("admitted", F.coalesce(F.col("ratio") <= admitted, F.lit(False)))
    )


def with_reason(rows: DataFrame, reasons: list[tuple[str, Column]], kept: str = "kept") -> DataFrame:
    """``rows`` with the first reason whose condition holds, so that each row is counted once."""
    out = None
    for name, condition in reasons:
        held = F.coalesce(condition, F.lit(False))
        out = F.when(held, name) if out is None else out.when(held, name)
    return rows.withColumn("reason", out.otherwise(kept) if out is not None else F.lit(kept))


def accounting(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows of each reason."""
    return rows.groupBy(*by, "reason").agg(F.count(F.lit(1)).alias("n"))


def width_source(components: Column) -> Column:
    """Which width ``effective_width`` gives: ``total``, ``quadrature``, or null for none."""
    totals = F.size(F.filter(components, lambda c: c["component"] == "total"))
    return F.when(effective_width(components).isNotNull(), F.when(totals == 1, "total").otherwise("quadrature"))


def effective_width(components: Column) -> Column:
    """Half-width from an array of (component, width): the quoted total if there is one,
    else the root of the sum of squares; null with several totals, none, or a zero width."""
    totals = F.filter(components, lambda c: c["component"] == "total")
    square = F.aggregate(components, F.lit(0.0), lambda a, c: a + c["width"] * c["width"])
    width = F.when(F.size(totals) > 1, None).when(F.size(totals) == 1, F.element_at(totals, 1)["width"]).otherwise(F.sqrt(square))
    return F.when(width > 0, width)
