"""Aggregates that pick one value per group.

All are max/min forms, so Spark combines them map-side before the shuffle: a
key holding a large share of the rows sends one row per task, not its rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def any_row(predicate) -> Column:
    """True when at least one row of the group satisfies the predicate."""
    return F.coalesce(F.max(predicate), F.lit(False))


def pick_any(value) -> Column:
    """A repeatable stand-in for ANY_VALUE: the least non-null value."""
    return F.min(_col(value))


def latest(value, by) -> Column:
    """Value of the row with the greatest `by`.

    Rows without a time come last, and the greater value breaks a tie.
    """
    return F.max(F.struct(_col(by).alias("at"), _col(value).alias("value")))["value"]


def latest_by_window(rows: DataFrame, key, value, by, name) -> DataFrame:
    """The same pick as a ranking query (top 1 is pruned before the shuffle)."""
    order = Window.partitionBy(key).orderBy(F.desc(by), F.desc("value"))
    ranked = rows.select(key, by, _col(value).alias("value")).withColumn(
        "place", F.row_number().over(order)
    )
    return ranked.filter("place = 1").select(key, F.col("value").alias(name))
