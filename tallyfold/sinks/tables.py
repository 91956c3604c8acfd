"""Catalog sinks: full refresh, append, additive schema change, CSV."""

import uuid
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyfold import fixed_values as fv
from tallyfold.operators.spend_rows import csv_rows, require, to_fields
from tallyfold.sources.tables import SPEND

#: What is kept of an entry that can't be loaded, and of which load it was.
REJECTS = f"{SPEND}, account_id string, reason string, level string, place int, entry_text string, load string"


def resolve_schema(target, custom=None):
    """Schema a model lands in: the target, a store's own one, or `target_custom`."""
    name = (custom or "").strip()
    if not name:
        return target
    return fv.FIXED_SCHEMAS.get(name.lower(), f"{target}_{name}")


def table_name(target, alias, custom=None):
    return f"`{resolve_schema(target, custom)}`.`{alias}`"


def _versions(spark: SparkSession, schema, alias) -> list[str]:
    """Names of the written versions of a model, oldest first."""
    mark = f"{alias}__v".lower()
    listed = spark.sql(f"SHOW TABLES IN `{schema}`").collect()
    return sorted(r.tableName for r in listed if r.tableName.lower().startswith(mark))


def _shown_version(spark: SparkSession, schema, alias) -> str | None:
    """The version that the model's view shows; None if it has no view."""
    if not spark.catalog.tableExists(f"`{schema}`.`{alias}`"):
        return None
    said = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED `{schema}`.`{alias}`").collect()}
    if said.get("Type") != "VIEW":
        return ""
    return said["View Text"].rsplit("`", 2)[1]


def write_model(rows: DataFrame, target, alias, custom=None, buckets=0, key=None):
    """Replace the whole table of a model; returns its name. With `buckets` it is bucketed by `key`.

    The rows go to a table of their own, a version, and the model's name is a view of the
    version last written. The view is replaced in one step after the write has succeeded: a
    reader finds the old rows or the new ones, of either schema, and a failed refresh leaves
    the old ones. The version before stays for readers that have begun; what is older goes,
    the remains of refreshes that were killed as well.

    A plain table of that name, from before there were versions, becomes the first version;
    only then is the name missing for a moment.
    """
    spark, schema, table = rows.sparkSession, resolve_schema(target, custom), table_name(target, alias, custom)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")
    version = f"{alias}__v{stamp}_{uuid.uuid4().hex[:8]}"
    writer = rows.write.format("parquet")
    if buckets:
        # Dealt as the buckets are, so a task writes one bucket as one file.
        writer = rows.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
    try:
        writer.saveAsTable(f"`{schema}`.`{version}`")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS `{schema}`.`{version}`")
        raise
    before = _shown_version(spark, schema, alias)
    if before == "":
        before = f"{alias}__v0"
        spark.sql(f"ALTER TABLE {table} RENAME TO `{schema}`.`{before}`")
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM `{schema}`.`{version}`")
    for old in _versions(spark, schema, alias):
        if before and old.lower() < before.lower():
            spark.sql(f"DROP TABLE IF EXISTS `{schema}`.`{old}`")
    return table


@contextmanager
def own_session(rows: DataFrame, table, **settings):
    """The rows as a DataFrame of another session, with settings under which `table` is written.

    This session's settings stay as they are; it forgets the files it knew of the table.
    """
    spark, name = rows.sparkSession, f"rows_{uuid.uuid4().hex}"
    other = spark.newSession()
    for key, value in {**spark.conf.getAll, **settings}.items():
        if other.conf.isModifiable(key):
            other.conf.set(key, value)
    rows.createGlobalTempView(name)
    try:
        yield other.table(f"global_temp.{name}")
    finally:
        spark.catalog.dropGlobalTempView(name)
        spark.catalog.refreshTable(table)


def ensure_table(spark: SparkSession, table, ddl=SPEND, partition="date"):
    """Create the table, or add the declared columns it lacks.

    Columns are never dropped or retyped, and added ones are nullable.
    """
    declared = StructType.fromDDL(ddl)
    if spark.catalog.tableExists(table):
        present = {c.lower() for c in spark.table(table).columns}
        added = [f for f in declared.fields if f.name.lower() not in present]
        if added:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    else:
        empty = spark.createDataFrame([], declared)
        empty.write.format("parquet").partitionBy(partition).saveAsTable(table)


def _write_spend(ready: DataFrame, table, overwrite_window):
    ready = to_fields(ready, ready.sparkSession.table(table).schema.fields).hint("rebalance", "date")
    ready.write.mode("overwrite" if overwrite_window else "append").insertInto(table)


#: insertInto takes this from the session only, not from a write option.
DYNAMIC = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}


def append_spend(rows: DataFrame, table, overwrite_window=False):
    """Append conformed spend rows to a table partitioned by date.

    Appending a day twice doubles it. With `overwrite_window` the days present in
    the rows replace what the table has for them. A row that misses a required
    value fails the load. Rows are rebalanced by day, so a large day is written
    by several tasks and a small one in one file.
    """
    ensure_table(rows.sparkSession, table)
    if not overwrite_window:
        _write_spend(require(rows), table, False)
        return
    with own_session(rows, table, **DYNAMIC) as own:
        _write_spend(require(own), table, True)


def load_spend(rows: DataFrame, table, overwrite_window=False) -> dict[str, int]:
    """Append the rows without a `reason`; returns how many were read, written and rejected.

    The counts come from the scan that writes, so they add up. Spark adds a task's counts
    again when it has to run it again after a lost executor.
    """
    ensure_table(rows.sparkSession, table)
    with own_session(rows, table, **DYNAMIC) as own:
        seen = Observation()
        bad = F.count("reason")
        counted = own.observe(seen, F.count(F.lit(1)).alias("read"), (F.count(F.lit(1)) - bad).alias("written"), bad.alias("rejected"))
        _write_spend(counted.filter("reason IS NULL"), table, overwrite_window)
        return seen.get


def append_rows(rows: DataFrame, table):
    """Append to an unpartitioned table, which is made if it is missing."""
    rows.write.mode("append").format("parquet").saveAsTable(table)


def append_rejects(rows: DataFrame, schema, channel, window, run):
    """Rejected rows into the table `Rejects`; those of the same channel, window and run are replaced."""
    table, load = f"`{schema}`.`Rejects`", f"{channel}_{window[0]}_{window[1]}_{run}"
    ensure_table(rows.sparkSession, table, REJECTS, "load")
    with own_session(rows.withColumn("load", F.lit(load)), table, **DYNAMIC) as own:
        fields = own.sparkSession.table(table).schema.fields
        to_fields(own, fields).write.mode("overwrite").insertInto(table)


def write_spend_csv(rows: DataFrame, path):
    """CSV report with a header, account after account.

    The further sort columns let the rows of a large account spread over files.
    """
    ordered = csv_rows(rows).orderBy("app", "date", "country", "adgroup_id")
    ordered.write.mode("overwrite").option("header", True).csv(path)
