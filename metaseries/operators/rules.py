"""Checks of rows against declared rules, as joins and predicates: each returns the violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def whole(pattern: str) -> str:
    """A pattern whose closing ``$`` means the very end, not the place before a last newline."""
    return pattern[:-1] + r"\z" if pattern.endswith("$") and not pattern.endswith(r"\$") else pattern


def outside_set(rows: DataFrame, column: str, declared: DataFrame, value: str = "value") -> DataFrame:
    """Rows whose value is present and not declared."""
    return rows.where(F.col(column).isNotNull()).join(declared.select(F.col(value).alias("_v")), F.col(column) == F.col("_v"), "left_anti")


def malformed(rows: DataFrame, column: str, pattern: str) -> DataFrame:
    return rows.where(F.col(column).isNotNull() & ~F.col(column).rlike(whole(pattern)))


def missing(required: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Required keys that are not present."""
    return required.join(present.select(*keys), keys, "left_anti")


def below(rows: DataFrame, column: str, minimum: float) -> DataFrame:
    """Rows under the minimum; a value that is not a number is not under it."""
    return rows.where(~F.isnan(F.col(column).cast("double")) & (F.col(column) < minimum))


def repeated(rows: DataFrame, lists: list[str], item: list[str], order: list[str]) -> DataFrame:
    """Later occurrences of an item in its list, with ``occurrence`` from 2 on."""
    same = Window.partitionBy(*lists, *item).orderBy(*order)
    return rows.withColumn("occurrence", F.row_number().over(same)).where("occurrence > 1")


def none_present(rows: DataFrame, keys: list[str], member: str, wanted: list[str]) -> DataFrame:
    """Keys none of whose rows has one of the wanted members."""
    return rows.groupBy(*keys).agg(F.max(F.col(member).isin(wanted).cast("int")).alias("_any")).where("_any = 0").select(*keys)


def date_precision(text: Column) -> Column:
    """``year``, ``month`` or ``day`` for an existing date of that form, else null."""
    form = lambda pattern, filled: text.rlike(pattern) & F.try_to_timestamp(filled, F.lit("yyyy-MM-dd")).isNotNull()
    return (
        F.when(form(r"\A[0-9]{4}\z", F.concat(text, F.lit("-01-01"))), "year")
        .when(form(r"\A[0-9]{4}-[0-9]{2}\z", F.concat(text, F.lit("-01"))), "month")
        .when(form(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z", text), "day")
    )


def close(a: Column, b: Column, relative: float) -> Column:
    """Whether two values agree within a relative tolerance of the larger."""
    return F.abs(a - b) <= relative * F.greatest(F.abs(a), F.abs(b))


def negligible(factor_uncertainty: Column, quoted: Column, share: float = 0.01) -> Column:
    """Whether a conversion's relative uncertainty is at most ``share`` of the smallest quoted one (array)."""
    return factor_uncertainty <= share * F.array_min(quoted)
