"""Running aggregates, ranks and as-of lookups within keys of any size.

A window on a key puts the whole key into one task. Here rows are dealt by ranges of
(key, order), so a large key lies on several tasks; each range's aggregates are carried
on to the ranges after it. The only window over a whole key runs on one row a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from metaseries.sources.tables import materialise

#: Kinds of aggregates that can be carried on.
KINDS = {"sum": F.sum, "min": F.min, "max": F.max}


def _both(kind: str, before: Column, own: Column) -> Column:
    """A carried aggregate and a range's own, as one; null where both are."""
    if kind == "sum":
        return F.when(before.isNull(), own).when(own.isNull(), before).otherwise(before + own)
    return F.least(before, own) if kind == "min" else F.greatest(before, own)


def running(rows: DataFrame, keys: list[str], order: list[Column], measures: dict[str, tuple[str, Column]]) -> DataFrame:
    """``rows`` with each measure's aggregate over its key's rows up to and with its own, in ``order``.

    A measure is a name with its kind (sum, min or max) and a column. Rows of equal
    order are taken in any order, so make it total where that shows. Null keys are a key.
    A measure with the name of a column of ``rows`` takes its place.
    """
    given, part = rows.columns, "_part"
    kept = [c for c in given if c not in measures]
    columns = {f"_m{i}": c for i, (_, c) in enumerate(measures.values())}
    kinds = [kind for kind, _ in measures.values()]
    placed = materialise(rows.repartitionByRange(*[F.col(k) for k in keys], *order).withColumn(part, F.spark_partition_id()))
    # measures are made where rows are read again, so that they are neither shuffled nor written
    placed = placed.select(*given, part, *[c.alias(n) for n, c in columns.items()])
    ranges = placed.groupBy(*keys, part).agg(*[KINDS[kind](n).alias(n) for kind, n in zip(kinds, columns, strict=True)])
    ahead = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(part).alias("_p"), *[KINDS[kind](n).over(ahead).alias(f"_c{n}") for kind, n in zip(kinds, columns, strict=True)])
    same = F.col(part) == F.col("_p")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    own = Window.partitionBy(*keys, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = placed.select("*", *[KINDS[kind](n).over(own).alias(f"_o{n}") for kind, n in zip(kinds, columns, strict=True)])
    return held.join(carried, same).select(*kept, *[_both(kind, F.col(f"_c{n}"), F.col(f"_o{n}")).alias(name) for name, kind, n in zip(measures, kinds, columns, strict=True)])


def ranked(rows: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """``rows`` with their place in their key, from 1 on."""
    return running(rows, keys, order, {name: ("sum", F.lit(1).cast("long"))})


#: Rows that count for a question: the direction in which they are passed, and whether they come before an equal question.
SIDES = {"before": (False, False), "upto": (False, True), "after": (True, False), "from": (True, True)}


def asof(rows: DataFrame, asked: DataFrame, keys: list[str], at: str, measures: dict[str, tuple[str, Column]], side: str) -> DataFrame:
    """``asked (keys, at, ...)`` with each measure's aggregate over the key's rows on one side of ``at``.

    ``side``: ``before`` takes rows with a lesser ``at``, ``upto`` with an equal one too,
    ``after`` those with a greater one, ``from`` with an equal one too. A measure is null
    (a sum too) where there is no such row. Rows without ``at`` count for no question.
    """
    backwards, equal = SIDES[side]
    turn = "_turn"
    columns = {f"_v{i}": c for i, (_, c) in enumerate(measures.values())}
    # a row that counts for an equal question is passed before it
    data = rows.where(F.col(at).isNotNull()).select(*keys, at, F.lit(0 if equal else 2).alias(turn), *[c.alias(n) for n, c in columns.items()])
    questions = asked.select(*keys, at).distinct().withColumn(turn, F.lit(1))
    line = data.unionByName(questions, allowMissingColumns=True)
    order = [F.col(at).desc() if backwards else F.col(at).asc(), F.col(turn).asc()]
    passed = running(line, keys, order, {name: (kind, F.col(n)) for (name, (kind, _)), n in zip(measures.items(), columns, strict=True)}).where(F.col(turn) == 1)
    answers = passed.select(*[F.col(k).alias(f"_q{i}") for i, k in enumerate([*keys, at])], *measures)
    same = F.lit(True)
    for i, k in enumerate([*keys, at]):
        same &= F.col(k).eqNullSafe(F.col(f"_q{i}"))
    return asked.join(answers, same, "left").select(*asked.columns, *measures)


def blocks_of(rank: Column, levels: int = 40) -> Column:
    """The dyadic blocks that a place (from 0 on) lies in, as an array of ``level, block``."""
    return F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), lambda n: F.struct(n.alias("level"), F.floor(rank / F.pow(F.lit(2.0), n)).cast("long").alias("block")))


def blocks_between(start: Column, end: Column, levels: int = 40) -> Column:
    """The fewest dyadic blocks that make up the places from ``start`` to before ``end``, as an array of ``level, block``."""
    size = lambda n: F.pow(F.lit(2.0), n)
    low = lambda n: F.ceil(start / size(n)).cast("long")
    high = lambda n: F.floor(end / size(n)).cast("long")
    block = lambda n, at: F.struct(n.alias("level"), at.alias("block"))
    none = F.array().cast("array<struct<level:int,block:bigint>>")
    pick = lambda n: F.when(
        low(n) < high(n),
        F.concat(F.when(low(n) % 2 == 1, F.array(block(n, low(n)))).otherwise(none), F.when(high(n) % 2 == 1, F.array(block(n, high(n) - 1))).otherwise(none)),
    ).otherwise(none)
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), pick))
