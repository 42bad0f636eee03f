"""Tensions between values, their outcomes, and probabilities that travel with their counts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaseries.functions.quantiles import normal_quantile
from metaseries.sources.tables import materialise

from .ordered import asof, blocks_between, blocks_of, ranked
from .pooling import pool_random, unordered, with_span


def curve(deviations: DataFrame, by: list[str], grid: list[float]) -> DataFrame:
    """Of each threshold k in ``grid``, how many of the deviations have |z| >= k."""
    steps = F.explode(F.array(*[F.lit(float(k)) for k in grid])).alias("k")
    # the grid is small, and counts are made before it is spread out: one row a |z| step
    step = F.size(F.filter(F.array(*[F.lit(float(k)) for k in sorted(grid)]), lambda k: k <= F.abs("z")))
    held = deviations.groupBy(*by, step.alias("passed")).agg(F.count(F.lit(1)).alias("n"))
    rank = F.array_position(F.array(*[F.lit(float(k)) for k in sorted(grid)]), F.col("k"))
    return held.select(*by, "passed", "n", steps).groupBy(*by, "k").agg(F.sum("n").alias("scored"), F.sum(F.when(F.col("passed") >= rank, F.col("n")).otherwise(0)).alias("tensions"))


def apart(y1: Column, s1: Column, y2: Column, s2: Column) -> Column:
    """|y1 - y2| in units of both half-widths in quadrature."""
    return F.try_divide(F.abs(y1 - y2), F.sqrt(s1 * s1 + s2 * s2))


#: Studies of a series go into at most this many strips of width, each cut into as many blocks of values.
STRIPS = 8
#: Blocks hold this many studies at least, unless the series has fewer.
LEAST_BLOCK = 2048
#: Below this size two sets of studies are compared one by one.
LEAF = 192
#: What the bounds of blocks leave for rounding.
SLACK = 1e-9


def pair_tensions(studies: DataFrame, keys: list[str], k: float) -> DataFrame:
    """Unordered pairs of a series' scorable studies: ``pairs, tensions, measurements, quantities``.

    A study is scorable with a value and a width over zero. Studies are ranked by width
    and, within strips of it, by value into blocks of equal size. Two blocks whose bounds
    put all their pairs in tension, or none, are settled as a whole; the others meet in
    one task each, which goes on in the same way with halves of both blocks and compares
    the last few studies one by one. A series has at most 64 blocks, so each row is
    sent to at most 65 tasks however long it is, and a task holds two blocks. ``quantities``
    counts the distinct keys with a tension in the whole table, for the statement that
    pairs are not independent.
    """
    number = studies.where("y is not null and s > 0").select(*keys, F.col("y").cast("double"), F.col("s").cast("double")).withColumn("_id", F.monotonically_increasing_id())
    number = materialise(number)
    sizes = number.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    strips = F.least(F.lit(STRIPS), F.ceil(F.sqrt(F.col("n") / LEAST_BLOCK))).cast("long")
    share = lambda rank, n: F.floor((F.col(rank) - 1) * strips / n).cast("long")
    of = materialise(sizes.select(*keys, "n", strips.alias("strips")))
    strips = F.col("strips")
    striped = ranked(number, keys, [F.col("s").asc(), F.col("_id").asc()]).join(F.broadcast(of), keys).withColumn("strip", share("rank", F.col("n"))).drop("rank", "n")
    striped = materialise(striped)
    held = striped.groupBy(*keys, "strip").agg(F.count(F.lit(1)).alias("n"))
    placed = ranked(striped, [*keys, "strip"], [F.col("y").asc(), F.col("_id").asc()]).join(F.broadcast(held), [*keys, "strip"])
    placed = materialise(placed.select(*keys, "_id", "y", "s", (F.col("strip") * STRIPS + share("rank", F.col("n"))).alias("block")))

    # a few rows a key
    bounds = materialise(placed.groupBy(*keys, "block").agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{c}_{name}") for c in "ys" for f, name in ((F.min, "low"), (F.max, "high"))]))
    a, b = (bounds.select(*keys, *[F.col(c).alias(f"{side}_{c}") for c in bounds.columns if c not in keys]) for side in "ab")
    least = F.greatest(F.lit(0.0), F.col("b_y_low") - F.col("a_y_high"), F.col("a_y_low") - F.col("b_y_high"))
    most = F.greatest(F.col("b_y_high") - F.col("a_y_low"), F.col("a_y_high") - F.col("b_y_low"))
    width = lambda end: k * F.sqrt(F.col(f"a_s_{end}") * F.col(f"a_s_{end}") + F.col(f"b_s_{end}") * F.col(f"b_s_{end}"))
    met = a.join(b, keys).where("a_block <= b_block and (a_block < b_block or a_n > 1)").withColumn("sure", least >= width("high") * (1 + SLACK)).withColumn("never", most < width("low") * (1 - SLACK))
    met = materialise(met.where("not never").withColumn("pair", F.monotonically_increasing_id()))
    sure = met.where("sure")
    whole = materialise(sure.select(*keys, F.explode(F.array("a_block", "b_block")).alias("block")).distinct())
    known = whole.withColumn("known", F.lit(True))
    open_ = met.where("not sure").select(*keys, "pair", F.explode(F.array(F.struct(F.col("a_block").alias("block"), F.lit(0).alias("side")), F.struct(F.col("b_block").alias("block"), F.lit(1).alias("side")))).alias("at"))
    open_ = open_.select(*keys, "pair", "at.block", "at.side").join(known, [*keys, "block"], "left").withColumn("known", F.coalesce("known", F.lit(False)))
    asked = placed.join(F.broadcast(open_), [*keys, "block"]).select("pair", "side", "known", "block", "_id", "y", "s")
    hits = asked.groupBy("pair").applyInArrow(lambda group: _compared(group, k), "pair long, n long, ids array<long>")
    # one row a pair of blocks; ids of blocks that are measured as a whole are left out
    hits = materialise(hits).join(F.broadcast(met.select("pair", *keys)), "pair")

    ends = placed.join(F.broadcast(whole), [*keys, "block"]).select(*keys, "_id").unionByName(hits.select(*keys, F.explode("ids").alias("_id"))).distinct()
    measurements = ends.groupBy(*keys).agg(F.count(F.lit(1)).alias("measurements"))
    tensions = sure.select(*keys, (F.col("a_n") * F.col("b_n")).alias("n")).unionByName(hits.select(*keys, "n")).groupBy(*keys).agg(F.sum("n").alias("tensions"))
    n, none = F.col("n"), F.lit(0).cast("long")
    total = of.select(*keys, F.floor(n * (n - 1) / 2).cast("long").alias("pairs")).join(tensions, keys, "left").join(measurements, keys, "left")
    found = total.select(*keys, "pairs", F.coalesce("tensions", none).alias("tensions"), F.coalesce("measurements", none).alias("measurements"))
    return found.join(F.broadcast(found.agg(F.count(F.when(F.col("tensions") > 0, 1)).alias("quantities"))))


def _halves(y: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """An order of studies in which each half of each half lies close together, by value or width, and the levels' first places."""
    order, levels = np.arange(len(y)), [np.array([0, len(y)])]
    while np.diff(levels[-1]).max() > LEAF:
        cuts, own = levels[-1], []
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            part, middle = order[start:end], (start + end) // 2
            by = y if np.ptp(y[part]) >= np.ptp(s[part]) else s
            order[start:end] = part[np.argpartition(by[part], middle - start)]
            own += [start, middle]
        levels.append(np.array([*own, len(y)]))
    return order, levels


def _compared(group: pa.Table, k: float) -> pa.Table:
    """Of the studies of two blocks (or of one with itself): how many pairs are in tension, and the ids of those that have one."""
    side, y, s, ids = (group.column(c).to_numpy() for c in ("side", "y", "s", "_id"))
    known = group.column("known").to_numpy(zero_copy_only=False)
    itself = len(set(group.column("block").to_numpy().tolist())) == 1
    halves = []
    for of in (side == 0, side == 1):
        own_y, own_s = y[of], s[of]
        # as the same studies may stand on both sides, both are put in order of their ids
        by_id = np.argsort(ids[of])
        order, levels = _halves(own_y[by_id], own_s[by_id])
        order = by_id[order]
        own_y, own_s = own_y[order], own_s[order]
        bounds = [[f.reduceat(c, cut[:-1]) for c in (own_y, own_s) for f in (np.minimum, np.maximum)] for cut in levels]
        halves.append((own_y, own_s, ids[of][order], levels, bounds, bool(known[of].all())))
    (ya, sa, ida, la, ba, known_a), (yb, sb, idb, lb, bb, known_b) = halves
    hit = [np.zeros(len(ya) + 1, np.int64), np.zeros(len(yb) + 1, np.int64)]
    pairs, total = (np.zeros(1, np.int64), np.zeros(1, np.int64)), 0
    for level in range(max(len(la), len(lb))):
        at_a, at_b = min(level, len(la) - 1), min(level, len(lb) - 1)
        i, j = pairs
        if level:
            # a level that is not the last one has halves; a shorter side stays as it is
            i = (2 * i[:, None] + [0, 1, 0, 1]) if at_a == level else np.repeat(i[:, None], 2, 1)
            j = (2 * j[:, None] + ([0, 0, 1, 1] if at_a == level else [0, 1])) if at_b == level else np.repeat(j[:, None], i.shape[1], 1)
            if at_b != level:
                i, j = i[:, :2], j[:, :2]
            i, j = i.ravel(), j.ravel()
        (ay0, ay1, as0, as1), (by0, by1, bs0, bs1) = [[c[i] for c in ba[at_a]], [c[j] for c in bb[at_b]]]
        nearest = np.maximum(0, np.maximum(by0 - ay1, ay0 - by1))
        farthest = np.maximum(by1 - ay0, ay1 - by0)
        sure = nearest >= k * np.sqrt(as1 * as1 + bs1 * bs1) * (1 + SLACK)
        left = ~sure & (farthest >= k * np.sqrt(as0 * as0 + bs0 * bs0) * (1 - SLACK))
        ca, cb = la[at_a], lb[at_b]
        total += int((np.diff(ca)[i[sure]] * np.diff(cb)[j[sure]]).sum())
        for found, cut, which in ((hit[0], ca, i[sure]), (hit[1], cb, j[sure])):
            np.add.at(found, cut[which], 1)
            np.add.at(found, cut[which + 1], -1)
        pairs = i[left], j[left]
    rows = [np.zeros(len(ya), bool), np.zeros(len(yb), bool)]
    for i, j in zip(*pairs, strict=True):
        own, other = slice(la[-1][i], la[-1][i + 1]), slice(lb[-1][j], lb[-1][j + 1])
        sq = (sa[own] * sa[own])[:, None] + (sb[other] * sb[other])[None, :]
        apart_ = np.abs(ya[own][:, None] - yb[other][None, :]) / np.sqrt(sq) >= k
        total += int(np.count_nonzero(apart_))
        if not known_a:
            rows[0][own] |= apart_.any(1)
        if not known_b:
            rows[1][other] |= apart_.any(0)
    # a block with itself has each pair twice, and no study is apart from itself
    total = total // 2 if itself else total
    named = [of[(np.cumsum(found)[:-1] > 0) | more] for of, found, more, known_ in ((ida, hit[0], rows[0], known_a), (idb, hit[1], rows[1], known_b)) if not known_]
    named = np.unique(np.concatenate(named)) if named else np.zeros(0, np.int64)
    return pa.table({"pair": group.column("pair").slice(0, 1).cast(pa.int64()), "n": pa.array([total], pa.int64()), "ids": pa.array([named], pa.list_(pa.int64()))})


def split_tensions(studies: DataFrame, keys: list[str], split: str, least: int = 3) -> DataFrame:
    """Pooled estimates of a series' parts, two by two: ``first, second, apart, least``; parts of ``least`` studies or more."""
    pooled = pool_random(studies, [*keys, split]).where(F.col("k") >= least)
    a = pooled.select(*keys, F.col(split).alias("first"), F.col("estimate").alias("y1"), F.col("se").alias("s1"))
    b = pooled.select(*keys, F.col(split).alias("second"), F.col("estimate").alias("y2"), F.col("se").alias("s2"))
    return a.join(b, keys).where("first < second").select(*keys, "first", "second", apart(F.col("y1"), F.col("s1"), F.col("y2"), F.col("s2")).alias("apart"), F.lit(least).alias("least"))


def outcomes(tensions: DataFrame, scored: DataFrame, keys: list[str], corrections: DataFrame | None = None, one_value: bool = False) -> DataFrame:
    """Each of ``tensions`` with ``outcome`` and ``counts_as``.

    ``scored`` are the deviations of all studies under the same kind of reference;
    ``tensions`` are rows of it, each judged by the value it was against, its own ``r``
    and ``r_half``. A later study speaks only if it is admitted and came out after the
    tension for sure: its ``pub`` lies behind the tension's ``pub_end`` (``pub`` where
    there is none). It confirms if it lies on the tension's side of the reference and
    outside the reference's interval, and refutes if it lies within that interval. The
    first to do so decides: the tension is confirmed if a confirming study came out
    before every refuting one for sure, else refuted. ``corrections (keys, grp,
    technique, side)`` are published identified errors, with ``side`` confirmed or
    refuted: such a tension is ``explained`` and ``counts_as`` its side. Else it is
    ``unresolved``: no admitted later study, or none on that side or in the interval.

    Where studies have ``pub_end``, ``unordered`` counts the admitted studies that may
    have come out on either side of the tension, and so do not speak. ``one_value`` says
    that all studies of a key have one reference value, which saves a search.
    """
    dated = "pub_end" in scored.columns
    tensions, scored = with_span(tensions), with_span(scored)
    speakers = scored.where("admitted")
    if one_value:
        y, low, high = F.col("y"), F.col("r") - F.col("r_half"), F.col("r") + F.col("r_half")
        says = speakers.select(*keys, F.col("pub").alias("day"), "pub", "pub_end", (y > high).alias("above"), (y < low).alias("below"))
        first = lambda when, c: ("min", F.when(when, F.col(c)))
        within = ~F.col("above") & ~F.col("below")
        measures = {"next_above": first(F.col("above"), "pub_end"), "next_below": first(F.col("below"), "pub_end"), "next_within": first(within, "pub")}
        rows = asof(says, tensions.withColumn("day", F.col("pub_end")), keys, "day", measures, "after").drop("day")
        rows = rows.withColumn("next_with", F.when(F.col("z") > 0, F.col("next_above")).otherwise(F.col("next_below"))).drop("next_above", "next_below")
    else:
        rows = _first_to_speak(tensions, speakers, keys)
    within, with_it = F.col("next_within"), F.col("next_with")
    decided = F.when(with_it.isNotNull() & (within.isNull() | (with_it < within)), "confirmed").when(within.isNotNull(), "refuted")
    rows = rows.withColumn("counts_as", decided).drop("next_within", "next_with")
    if dated:
        rows = rows.join(unordered(speakers, keys).distinct(), [*keys, "grp", "pub", "pub_end"], "left")
    else:
        rows = rows.drop("pub_end")
    if corrections is not None:
        rows = rows.join(corrections.select(*keys, "grp", "technique", "side"), [*keys, "grp", "technique"], "left")
    else:
        rows = rows.withColumn("side", F.lit(None).cast("string"))
    explained = F.col("side").isNotNull()
    outcome = F.when(explained, "explained").otherwise(F.coalesce("counts_as", F.lit("unresolved")))
    return rows.withColumn("outcome", outcome).withColumn("counts_as", F.when(explained, F.col("side")).otherwise(F.col("counts_as"))).drop("side")


def _first_to_speak(tensions: DataFrame, speakers: DataFrame, keys: list[str]) -> DataFrame:
    """``tensions`` with ``next_with``, when one on its side was out for sure, and ``next_within``, when the first in its interval may have been.

    Speakers are ranked by value; a tension's side and interval are ranges of ranks, and
    each range is made up of a few dyadic blocks, each of which is asked for its first
    day after the tension's. So no tension meets all speakers of its key.
    """
    placed = materialise(ranked(speakers.select(*keys, "y", "pub", "pub_end"), keys, [F.col("y").asc(), F.col("pub").asc(), F.col("pub_end").asc()], "place"))
    most = placed.agg(F.max("place")).first()[0] or 0
    levels = most.bit_length() + 1
    own = materialise(tensions.withColumn("_id", F.monotonically_increasing_id()))
    one = {"n": ("sum", F.lit(1).cast("long"))}
    none = F.lit(0).cast("long")
    ends = own.select("_id", *keys, "pub_end", (F.col("z") > 0).alias("up"), (F.col("r") - F.col("r_half")).alias("low"), (F.col("r") + F.col("r_half")).alias("high"))
    ends = asof(placed.withColumn("low", F.col("y")), ends, keys, "low", one, "before").withColumnRenamed("n", "under")
    ends = asof(placed.withColumn("high", F.col("y")), ends, keys, "high", one, "upto").withColumnRenamed("n", "upto")
    ends = ends.join(placed.groupBy(*keys).agg(F.max("place").alias("all")), keys, "left")
    under, upto, every = (F.coalesce(c, none) for c in ("under", "upto", "all"))
    start, end = F.when(F.col("up"), upto).otherwise(none), F.when(F.col("up"), every).otherwise(under)
    ranges = F.array(F.struct(F.lit("with").alias("what"), start.alias("start"), end.alias("end")), F.struct(F.lit("within").alias("what"), under.alias("start"), upto.alias("end")))
    asked = ends.select("_id", *keys, F.col("pub_end").alias("day"), F.explode(ranges).alias("of"))
    asked = asked.select("_id", *keys, "day", "of.what", F.explode(blocks_between(F.col("of.start"), F.col("of.end"), levels)).alias("at")).select("_id", *keys, "day", "what", "at.level", "at.block")
    filed = placed.select(*keys, F.col("pub").alias("day"), "pub_end", F.explode(blocks_of(F.col("place") - 1, levels)).alias("at")).select(*keys, "day", "pub_end", "at.level", "at.block")
    # of a block's speakers of one day, the one out first is enough: large blocks have a row a day
    filed = filed.groupBy(*keys, "level", "block", "day").agg(F.min("pub_end").alias("pub_end"))
    found = asof(filed, asked, [*keys, "level", "block"], "day", {"next_pub": ("min", F.col("day")), "next_end": ("min", F.col("pub_end"))}, "after")
    first = found.groupBy("_id").agg(F.min(F.when(F.col("what") == "with", F.col("next_end"))).alias("next_with"), F.min(F.when(F.col("what") == "within", F.col("next_pub"))).alias("next_within"))
    return own.join(first, "_id", "left").drop("_id")


def wilson(hits: Column, n: Column, level: float = 0.95) -> tuple[Column, Column]:
    """Wilson's interval of a binomial proportion; null for no trials."""
    z = normal_quantile(0.5 + level / 2)
    p = F.try_divide(hits, n)
    middle = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    return F.when(n > 0, middle - half), F.when(n > 0, middle + half)


#: The members without which a probability must not be given: fixed names.
MEMBERS = ("number", "interval", "count", "event_kind", "k", "reference", "admission_rule", "quantities", "disciplines", "period", "unresolved")
OUTCOMES = ("confirmed", "refuted", "explained", "unresolved")


def outcome_counts(judged: DataFrame, scored: DataFrame, by: list[str]) -> DataFrame:
    """``scored, tensions``, a count of each outcome, and ``real`` and ``not_real``: those
    confirmed and refuted with the explained ones on their side."""
    n = judged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("tensions"),
        *[F.count(F.when(F.col("outcome") == o, 1)).alias(o) for o in OUTCOMES],
        F.count(F.when(F.col("counts_as") == "confirmed", 1)).alias("real"),
        F.count(F.when(F.col("counts_as") == "refuted", 1)).alias("not_real"),
    )
    every = scored.groupBy(*by).agg(F.count(F.lit(1)).alias("scored")).join(n, by, "left")
    return every.select(*by, "scored", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("tensions", *OUTCOMES, "real", "not_real")])


def probability(judged: DataFrame, scored: DataFrame, by: list[str], k: float, admission_rule: str, event_kind: str = "deviation tension", discipline: str = "technique") -> DataFrame:
    """One row a key with the struct ``probability`` of all ``MEMBERS``.

    ``number`` is the share of tensions confirmed among those resolved, with its
    ``censored`` bounds, taking all unresolved ones as refuted or as confirmed;
    ``interval`` is Wilson's, ``count`` the resolved tensions that both rest on. The
    rows of ``scored`` say ``reference_kind`` and ``vintage``; put ``reference_kind``
    in ``by`` for all references side by side.
    """
    about = scored.groupBy(*by).agg(
        F.array_sort(F.collect_set("quantity")).alias("quantities"),
        F.array_sort(F.collect_set(discipline)).alias("disciplines"),
        F.struct(F.min("pub").alias("from"), F.max("pub").alias("to")).alias("period"),
        F.struct(F.array_join(F.array_sort(F.collect_set("reference_kind")), ", ").alias("choice"), F.max("vintage").alias("vintage")).alias("reference"),
    )
    resolved, total, open_ = F.col("real") + F.col("not_real"), F.col("tensions"), F.col("unresolved")
    low, high = wilson(F.col("real"), resolved)
    censored = F.struct(F.try_divide(F.col("real"), total).alias("low"), F.try_divide(F.col("real") + open_, total).alias("high"))
    members = {
        "number": F.struct(F.try_divide(F.col("real"), resolved).alias("resolved_only"), censored.alias("censored")),
        "interval": F.struct(low.alias("low"), high.alias("high")),
        "count": resolved,
        "event_kind": F.lit(event_kind),
        "k": F.lit(float(k)),
        "reference": F.col("reference"),
        "admission_rule": F.lit(admission_rule),
        "quantities": F.col("quantities"),
        "disciplines": F.col("disciplines"),
        "period": F.col("period"),
        "unresolved": F.struct(open_.alias("count"), F.try_divide(open_, total).alias("share")),
    }
    return outcome_counts(judged, scored, by).join(about, by).select(*by, F.struct(*[c.alias(m) for m, c in members.items()]).alias("probability"))


def carries_probability(df: DataFrame) -> bool:
    """Whether a column is a probability, or a part of one that would travel without the rest."""
    kinds = [f.dataType for f in df.schema]
    return any(set(MEMBERS) & {m.name for m in t} >= {"number"} for t in kinds if hasattr(t, "names"))


def write_csv(df: DataFrame, path: str) -> None:
    """Write ``df`` as CSV; refused where it holds a probability, which no cell can carry with its conditions."""
    if carries_probability(df):
        raise ValueError("CSV can't carry a probability with its conditions; write JSON or Parquet, or the counts")
    df.write.option("header", True).csv(path)
