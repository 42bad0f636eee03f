"""Accepted values with their dates: recommended values that were revised over time.

A line of JSON is one vintage of one quantity: ``{"quantity": ..., "value": ...,
"half_width": ..., "valid_from": "1986-11", "pins_down": false, "source": ...}``.
``pins_down`` declares a determination that settled the quantity. A date may be a year
or a month; such a value counts from that span's last day on, when it was out for sure.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metaseries.operators.ordered import asof

SCHEMA = "quantity string, value double, half_width double, valid_from string, pins_down boolean, source string"
#: After all dates, for the value that holds now.
NOW = date(9999, 12, 31)


def first_day(partial: Column) -> Column:
    """The first day of a date that may be a year or a month."""
    return F.to_date(F.concat(partial, F.substring(F.lit("-01-01"), F.length(partial) - 3, 10)), "yyyy-MM-dd")


def last_day(partial: Column) -> Column:
    """The last day of a date that may be a year or a month."""
    start = first_day(partial)
    return F.when(F.length(partial) == 4, F.date_add(F.add_months(start, 12), -1)).when(F.length(partial) == 7, F.last_day(start)).otherwise(start)


def read_accepted(spark: SparkSession, path: str) -> DataFrame:
    """``quantity, value, half_width, valid_from, pins_down, source`` of a file or folder of JSON lines; a line without value, width over 0 or date is an error."""
    rows = spark.read.schema(SCHEMA).json(path)
    dated = rows.withColumn("valid_from", last_day(F.col("valid_from")))
    whole = F.col("quantity").isNotNull() & F.col("value").isNotNull() & (F.col("half_width") > 0) & F.col("valid_from").isNotNull()
    wrong = F.raise_error(F.concat(F.lit("accepted value without value, width over 0 or date: "), F.to_json(F.struct(*dated.columns))))
    return dated.withColumn("quantity", F.when(F.coalesce(whole, F.lit(False)), F.col("quantity")).otherwise(wrong.cast("string"))).withColumn("pins_down", F.coalesce("pins_down", F.lit(False)))


def at_vintage(accepted: DataFrame, asked: DataFrame, keys: list[str], day: str) -> DataFrame:
    """``asked (keys, day, ...)`` with the value that held on its day: ``r, r_half, vintage, pins_down``; null before the first."""
    held = F.struct("valid_from", "value", "half_width", "pins_down")
    found = asof(accepted.withColumn(day, F.col("valid_from")), asked, keys, day, {"held": ("max", held)}, "upto")
    of = {"value": "r", "half_width": "r_half", "valid_from": "vintage", "pins_down": "pins_down"}
    return found.select(*asked.columns, *[F.col(f"held.{c}").alias(name) for c, name in of.items()])
