"""Copies of the event tables in buckets of their id: a rollup over one shuffles no events."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.operators.cohorts import PLAY_ID, with_base_order
from tallyfold.sinks.tables import write_model
from tallyfold.sources.tables import LAYOUTS, layout_name, read_source

#: A bucket is one task, however many rows it has: an id may fill so many average buckets at most.
MAX_BUCKETS_OF_AN_ID = 2


class HotId(ValueError):
    """An id with so many rows that one task would have to read them; the table stays as it is."""


def largest_id(rows: DataFrame, key) -> tuple[int, int]:
    """(rows of the id that has most of them, all rows), from counts that tasks combine first."""
    counted = rows.groupBy(key).count()
    found = counted.agg(F.max("count"), F.sum("count")).first()
    return found[0] or 0, found[1] or 0


def lay_out(spark: SparkSession, source, table, buckets, path=None):
    """Write the copy of a source table that its rollup reads without a shuffle; returns its name.

    The copy is replaced as a model is, so a failed run leaves the old one. A table in which one
    id, null included, has more rows than a few buckets is refused: its rollup combines that
    id's rows in many tasks before the shuffle, which a bucket can't.
    """
    key = LAYOUTS[source, table]
    rows = read_source(spark, source, table, path)
    if key == PLAY_ID:
        rows = with_base_order(rows)
    most, total = largest_id(rows, key)
    if most * buckets > MAX_BUCKETS_OF_AN_ID * max(total, buckets):
        raise HotId(f"one {key} of {source}.{table} has {most} of {total} rows, too many for {buckets} buckets")
    return write_model(rows, *layout_name(source, table), buckets=buckets, key=key)
