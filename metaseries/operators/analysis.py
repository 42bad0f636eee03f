"""From records to studies: which records an analysis may use, each other one with one counted reason.

Values are those in canonical units; widths are brought to one standard deviation by
their stated coverage. Nothing is imputed: what can't be used is left out and counted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaseries.functions.quantiles import normal_quantile

from metaseries.sources.accepted import first_day, last_day
from metaseries.sources.tables import materialise

from .deviation import accounting, with_reason
from .meaning import number_at, text_at

NORMALIZED, PUBLISHED = "measurement.normalized", "measurement.published"
#: Reasons in the order in which they are tried: fixed names.
REASONS = (
    "withdrawn", "disputed", "not-confirmed", "combined-fit", "limit", "none-in-source", "not-transcribed", "not-convertible", "coverage-unstated", "coverage-other", "zero-width", "no-width",
    "superseded", "group-repeat",
)


@dataclass(frozen=True)
class Options:
    """What a user may choose; all of it is in the stamp, defaults too."""

    confirmed_only: bool = False
    #: A coverage such as ``k=1`` to assume where a source states none.
    assumed_coverage: str | None = None
    #: How systematics that name a correlation group are treated: ``independent`` or ``shared``.
    correlation: str = "independent"


def standard_deviations(coverage: str | None) -> float | None:
    """How many standard deviations a stated coverage is: ``k=2`` gives 2, ``cl=95`` 1.96; none where that is no number over 0."""
    found = re.fullmatch(r"(k|cl)=([0-9.]+)", coverage or "")
    if not found:
        return None
    value = float(found[2])
    if found[1] == "k":
        return value if value > 0 else None
    return normal_quantile(0.5 + value / 200) if 0 < value < 100 else None


def multipliers(coverages: DataFrame) -> DataFrame:
    """``coverage, multiplier`` of each distinct text in the one column of ``coverages``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(multiplier=[standard_deviations(c) for c in batch["coverage"]])

    return coverages.toDF("coverage").where("coverage is not null").distinct().mapInPandas(run, "coverage string, multiplier double")


def _parts(block: str, names: tuple[str, ...]) -> Column:
    """The uncertainty components of a block, as an array of structs of ``names``."""
    cells = F.col("cells")
    entry = F.filter(F.map_entries("cells"), lambda e: (e["value"]["place"] == f"{block}.uncertainty[]") & (e["value"]["kind"] == "table"))
    part = lambda e, name: F.try_element_at(cells, F.concat(e["key"], F.lit(f".{name}")))
    return F.transform(F.array_sort(entry), lambda e: F.struct(*[part(e, n)["d" if n in ("plus", "minus") else "s"].alias(n) for n in names]))


def measurements(parsed: DataFrame) -> DataFrame:
    """One row per parsed record: its coded fields, canonical value and components."""
    names = ("component", "label", "plus", "minus", "coverage", "correlation_group")
    texts = {
        "status": "status", "confirmation": "source.confirmation", "statement_kind": "source.statement_kind", "quantity": "measurement.quantity", "epoch": "measurement.definition_epoch",
        "normalization": "measurement.normalization_status", "uncertainty_status": f"{PUBLISHED}.uncertainty_status", "grp": "group.id", "technique": "method.technique", "blinding": "blinding",
        "date": "publication.date", "lineage_by": "lineage.superseded_by",
    }
    linked = F.filter(F.map_entries("cells"), lambda e: e["value"]["place"] == "lineage.supersedes[]")
    return parsed.where("parse_error is null").select(
        "path",
        *[text_at(field).alias(name) for name, field in texts.items()],
        first_day(text_at("publication.date")).alias("pub"),
        last_day(text_at("publication.date")).alias("pub_end"),
        number_at(f"{NORMALIZED}.value").alias("y"),
        F.try_element_at("cells", F.lit(f"{PUBLISHED}.limit")).isNotNull().alias("is_limit"),
        _parts(NORMALIZED, names).alias("components"),
        F.transform(linked, lambda e: e["value"]["s"]).alias("supersedes"),
    )


def _combined(side: str) -> Column:
    """One standard deviation of a side: the quoted total, else all components in quadrature; and what the conversion brought in.

    ``widths`` has each component's width over its multiplier.
    """
    square = lambda a: F.aggregate(a, F.lit(0.0), lambda s, c: s + c[side] * c[side])
    conversion = F.filter("widths", lambda c: F.coalesce(c["label"] == "unit-conversion", F.lit(False)))
    quoted = F.filter("widths", lambda c: ~F.coalesce(c["label"] == "unit-conversion", F.lit(False)))
    totals = F.filter(quoted, lambda c: c["component"] == "total")
    return F.sqrt(F.when(F.size(totals) == 1, square(totals)).when(F.size(totals) == 0, square(quoted)) + square(conversion))


def judged(records: DataFrame, options: Options = Options()) -> DataFrame:  # noqa: B008
    """``measurements`` with widths and a ``reason`` each: one of ``REASONS``, or ``kept``.

    Of what is left of a group's values of one quantity and epoch, the last published
    stays (by the last day on which it may have come out, then the first, then the path);
    the others are repeats. A repeat whose date leaves open which came last is
    ``order_open``.
    """
    known = multipliers(records.select(F.explode("components.coverage")))
    if options.assumed_coverage is not None:
        stated = F.when(F.col("coverage") == "unstated", F.lit(standard_deviations(options.assumed_coverage))).otherwise(F.col("multiplier"))
        known = known.withColumn("multiplier", stated)
    # few rows: one a distinct coverage of a component
    by_name = known.agg(F.map_from_entries(F.collect_list(F.struct("coverage", "multiplier"))).alias("multipliers"))
    over = lambda c, side: c[side] / F.try_element_at("multipliers", c["coverage"])
    rows = records.join(F.broadcast(by_name)).withColumn(
        "widths",
        F.transform("components", lambda c: F.struct(c["component"].alias("component"), c["label"].alias("label"), c["correlation_group"].alias("correlation_group"), over(c, "plus").alias("plus"), over(c, "minus").alias("minus"))),
    )
    rows = rows.withColumn("plus", _combined("plus")).withColumn("minus", _combined("minus"))
    named = F.col("components.component")
    rows = rows.withColumn("width_source", F.when(F.array_contains(named, "total"), "total").otherwise("quadrature")).withColumn("systematic_quoted", F.array_contains(named, "systematic"))
    unread = F.exists("components", lambda c: F.try_element_at("multipliers", c["coverage"]).isNull() & (c["coverage"] == "unstated"))
    other = F.exists("components", lambda c: F.try_element_at("multipliers", c["coverage"]).isNull())
    conditions = {
        "withdrawn": F.col("status") == "withdrawn",
        "disputed": F.col("confirmation") == "disputed",
        "not-confirmed": F.lit(options.confirmed_only) & (F.col("confirmation") != "confirmed"),
        "combined-fit": F.col("statement_kind") == "combined-fit",
        "limit": F.col("is_limit"),
        "none-in-source": F.col("uncertainty_status") == "none-in-source",
        "not-transcribed": F.col("uncertainty_status") == "not-transcribed",
        "not-convertible": (F.col("normalization") != "normalized") | F.col("y").isNull(),
        "coverage-unstated": unread,
        "coverage-other": other,
        "zero-width": F.exists("components", lambda c: (c["plus"] == 0) | (c["minus"] == 0)),
        "no-width": F.isnull("plus") | F.isnull("minus") | F.isnan("plus") | F.isnan("minus") | (F.size("components") == 0) | (F.col("plus") <= 0) | (F.col("minus") <= 0),
    }
    rows = materialise(with_reason(rows, [(name, conditions[name]) for name in REASONS if name in conditions]).drop("multipliers"))
    replaced = superseded(rows).withColumnRenamed("path", "was")
    rows = rows.join(replaced, F.col("path") == F.col("was"), "left")
    rows = rows.withColumn("reason", F.when((F.col("reason") == "kept") & F.col("was").isNotNull(), "superseded").otherwise(F.col("reason"))).drop("was")
    series = ["quantity", "epoch", "grp"]
    last = rows.where("reason = 'kept'").groupBy(*series).agg(F.max(F.struct("pub_end", "pub", "path")).alias("last"))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"l.{c}")) for c in series]
    rows = rows.alias("r").join(last.alias("l"), same[0] & same[1] & same[2], "left").select("r.*", "l.last")
    repeat = (F.col("reason") == "kept") & (F.col("path") != F.col("last.path"))
    # dates of which one holds part of the other don't say which came last
    unsure = repeat & (F.col("pub_end") >= F.col("last.pub"))
    rows = rows.withColumn("order_open", F.coalesce(unsure, F.lit(False)))
    return rows.withColumn("reason", F.when(repeat, "group-repeat").otherwise(F.col("reason"))).drop("last")


def superseded(rows: DataFrame) -> DataFrame:
    """``path`` of the records that a usable one replaces, at any distance.

    ``rows`` have ``path, reason, supersedes, lineage_by``; usable is what is ``kept``.
    A record that may not be used itself replaces nothing of its own accord, but what a
    usable one replaces is replaced with all that it had replaced. A record that names
    a replacement outside the corpus counts as replaced, on its own word. Each round
    goes one record on, over the links alone, and ends when none is new.
    """
    links = rows.select("path", F.explode("supersedes").alias("was")).unionByName(rows.where("lineage_by is not null").select(F.col("lineage_by").alias("path"), F.col("path").alias("was")))
    links = materialise(links.distinct())
    unusable = rows.where("reason <> 'kept'").select("path")
    every = new = materialise(links.join(unusable, "path", "left_anti").select(F.col("was").alias("path")).distinct())
    while not new.isEmpty():
        after = links.join(new, "path", "left_semi").select(F.col("was").alias("path")).distinct()
        new = materialise(after.join(every, "path", "left_anti"))
        every = every.unionByName(new)
    return every


def studies(judged_records: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """The kept records as a series: ``quantity, epoch, grp, technique, family, y, plus, minus, s, v, pub, ...``.

    ``s`` is the mean of both sides. ``family`` is that of the technique in
    ``vocabulary``, else the technique itself. ``correlation_group`` is the one that the
    record's components name and ``shared`` their width; several groups in one record
    are an error where they are to be used, so ``several_groups`` says so.
    """
    rows = judged_records.where("reason = 'kept'").withColumn("s", (F.col("plus") + F.col("minus")) / 2)
    if vocabulary is not None:
        rows = rows.join(F.broadcast(vocabulary.select(F.col("id").alias("its"), "families")), F.col("quantity") == F.col("its"), "left")
        family = F.coalesce(F.try_element_at("families", F.col("technique")), F.col("technique"))
    else:
        family = F.col("technique")
    correlated = F.exists("components", lambda c: c["correlation_group"].isNotNull())
    named = F.filter("widths", lambda c: c["correlation_group"].isNotNull())
    groups = F.array_distinct(F.transform(named, lambda c: c["correlation_group"]))
    shared = F.sqrt(F.aggregate(named, F.lit(0.0), lambda a, c: a + F.pow((c["plus"] + c["minus"]) / 2, F.lit(2))))
    return rows.select(
        "quantity", "epoch", "grp", "technique", family.alias("family"), "path", "y", "plus", "minus", "s", (F.col("s") * F.col("s")).alias("v"), "pub", "pub_end", "blinding", "systematic_quoted", "width_source",
        correlated.alias("names_correlation"), F.try_element_at(groups, F.lit(1)).alias("correlation_group"), shared.alias("shared"), (F.size(groups) > 1).alias("several_groups"), "confirmation",
    )


def excluded_counts(judged_records: DataFrame) -> DataFrame:
    """``quantity, reason, n`` of all records, those kept among them."""
    return accounting(judged_records, ["quantity"])


def confirmation_breakdown(judged_records: DataFrame) -> DataFrame:
    """``quantity``, and how many of the kept are confirmed and unconfirmed, and how many disputed were left out.

    Without a confirmation on each record no analysis may run: that is an error.
    """
    kept = F.col("reason") == "kept"
    stated = F.when(F.col("confirmation").isNull(), F.raise_error(F.lit("a record without confirmation: no breakdown, no analysis")).cast("string")).otherwise(F.col("confirmation"))
    rows = judged_records.withColumn("stated", stated)
    return rows.groupBy("quantity").agg(
        F.count_if(kept & (F.col("stated") == "confirmed")).alias("confirmed"), F.count_if(kept & (F.col("stated") == "unconfirmed")).alias("unconfirmed"), F.count_if(F.col("stated") == "disputed").alias("disputed")
    )


def options_stamp(judged_records: DataFrame, options: Options) -> dict:
    """The options in force for an artifact's stamp, with what they left out or assumed."""
    n = judged_records.agg(
        F.count_if(F.col("reason") == "not-confirmed").alias("removed"),
        F.count_if((F.col("reason") == "kept") & F.exists("components", lambda c: c["coverage"] == "unstated")).alias("assumed"),
        F.count_if((F.col("reason") == "kept") & F.exists("components", lambda c: c["correlation_group"].isNotNull())).alias("correlated"),
        F.count_if("order_open").alias("open"),
    ).first()
    return {
        "confirmed_only": options.confirmed_only, "confirmed_only_removed": n.removed, "assumed_coverage": options.assumed_coverage or "none", "assumed_coverage_records": n.assumed,
        "correlation": options.correlation, f"correlation_groups_taken_as_{options.correlation}": n.correlated, "group_repeats_of_open_order": n.open,
    }


def refuse_mixed_epochs(series: DataFrame, keys: list[str]) -> DataFrame:
    """``series``, unless ``keys`` would pool a quantity across definition epochs: then an error."""
    if "epoch" not in keys:
        mixed = series.groupBy(*keys).agg(F.count_distinct("epoch").alias("n")).where("n > 1").limit(1).collect()
        if mixed:  # one row
            raise ValueError(f"{mixed[0].asDict()} has values of several definition epochs; name epoch among the keys")
    return series


def correction_kinds(parsed: DataFrame) -> DataFrame:
    """``kind, corrections, records``: how many corrections of each kind there are, and in how many records."""
    found = F.filter(F.map_values("cells"), lambda c: c["place"] == "correction[].kind")
    each = parsed.select("path", F.explode(F.transform(found, lambda c: c["s"])).alias("kind"))
    return each.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n")).groupBy("kind").agg(F.sum("n").alias("corrections"), F.count(F.lit(1)).alias("records"))


def shares(judged_records: DataFrame, by: str) -> DataFrame:
    """Of the kept records of each quantity, how many have each value of ``by``, and their share."""
    kept = judged_records.where("reason = 'kept'").groupBy("quantity", by).agg(F.count(F.lit(1)).alias("n"))
    total = kept.groupBy("quantity").agg(F.sum("n").alias("of"))
    return kept.join(total, "quantity").select("quantity", by, "n", (F.col("n") / F.col("of")).alias("share"))
