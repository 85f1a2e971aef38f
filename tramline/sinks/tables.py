"""Warehouse writes. Each one pins the schema of its table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.operators.aggregates import next_number
from tramline.operators.ids import assign_ids
from tramline.operators.joins import keyed_update, new_rows
from tramline.operators.key_index import KeyIndex, buckets_for, key_index
from tramline.schemas import BATCH_STATUS, conform
from tramline.session import stage
from tramline.sinks.versions import VERSION, commit_version, last_version, location, properties, remove, replace_location, write_aside
from tramline.sources.tables import counted

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
BUCKETS, INDEXED = "tramline.buckets", "tramline.indexed"  # properties of a key index


def replace_table(df: DataFrame, table: str, schema: T.StructType) -> int:
    """The table holds exactly ``df`` afterwards, in one step; returns the rows written."""
    return replace_location(conform(df, schema), table)


def append_table(
    df: DataFrame, table: str, schema: T.StructType, partition_by: str | None = None
) -> int:
    """Add the rows; a second run adds them again (readers keep the first per key)."""
    rows, seen = counted(_sized(conform(df, schema), partition_by))
    writer = rows.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(table)
    return seen.get["rows"]


def replace_partitions(
    df: DataFrame, table: str, schema: T.StructType, partition_by: str
) -> int:
    """Add the rows, replacing the partitions they fall in: a second run changes nothing."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return append_table(df, table, schema, partition_by)
    ordered = conform(df, schema).select(*spark.table(table).columns)
    rows, seen = counted(_sized(ordered, partition_by))
    with _setting(spark, OVERWRITE_MODE, "dynamic"):
        rows.write.mode("overwrite").insertInto(table)
    return seen.get["rows"]


def replace_covered(
    df: DataFrame, table: str, schema: T.StructType, partition_by: str, covered: Sequence[str]
) -> int:
    """``replace_partitions``, and the ``covered`` partitions without new rows go: what a run no longer finds."""
    spark = df.sparkSession
    rows = replace_partitions(df, table, schema, partition_by)
    names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    there = {n.split("=", 1)[1] for n in names} & set(covered)
    kept = {r[0] for r in df.where(F.col(partition_by).isin(sorted(there))).select(partition_by).distinct().collect()} if there else set()
    for value in sorted(there - kept):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition_by} = '{value}')")
    return rows


def replace_key_index(spark: SparkSession, table: str, key: str) -> None:
    """Keep an index of the table's keys beside it, as ``<table>_<key>_index``, for the content it has now."""
    rows = spark.table(table)
    buckets = buckets_for(rows.count())
    name = f"{table}_{key}_index"
    replace_location(key_index(rows, key, buckets).bitmaps, name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{BUCKETS}' = '{buckets}', '{INDEXED}' = '{location(spark, table)}')")


def read_key_index(spark: SparkSession, table: str, key: str) -> KeyIndex | None:
    """The index that ``replace_key_index`` has kept; None if there is none, or the table was replaced since."""
    name = f"{table}_{key}_index"
    if not spark.catalog.tableExists(name):
        return None
    kept = properties(spark, name)
    if kept.get(INDEXED) != location(spark, table):
        return None
    return KeyIndex(spark.table(name), int(kept[BUCKETS]))


def update_partitions(
    table: str, updates: DataFrame, key: str, column: str, new: str, partition_by: str
) -> int:
    """``joins.keyed_update`` of a partitioned table, in place; returns the rows written.

    Only partitions that hold an updated key are read whole and written again; the files of all others
    stay. The keys are looked for in the key and partition columns alone. Files are
    written aside and moved in when all are done.
    """
    spark = updates.sparkSession
    rows = spark.table(table)
    keys = stage(updates.select(key).distinct(), "updated_keys")
    touched = rows.select(key, partition_by).join(keys, key, "left_semi").select(partition_by).distinct()
    touched = stage(touched, "touched_partitions")
    changed = keyed_update(rows.join(touched, partition_by, "left_semi"), updates, key, column, new)
    written, seen = counted(_sized(changed.select(*rows.columns), partition_by))
    with _setting(spark, OVERWRITE_MODE, "dynamic"):
        written.write.mode("overwrite").insertInto(table)
    spark.catalog.refreshTable(table)
    return seen.get["rows"]


def append_ledger(spark: SparkSession, table: str, executed: dt.datetime, status: int = 0) -> int:
    """Enter a (city, minute) batch time with the next batch number, unless it is entered; returns the new entries."""
    at = spark.range(1).select(F.lit(executed.replace(tzinfo=None)).cast("timestamp_ntz").alias("execute_time"))
    return enter_batches(at.withColumn("status", F.lit(status)), table)


def enter_batches(batches: DataFrame, table: str, tries: int = 10) -> int:
    """Enter all batches (execute_time, status) that the ledger lacks; returns how many.

    Times count by the minute. New entries are numbered without gaps after the highest number, by time
    and status, and become visible together. The ledger is partitioned by version: a run adds the
    version after the one it has read, and if another run has added it meanwhile, reads again. So
    neither a repeated nor a concurrent run enters a batch or a number twice. A missing ledger is created.
    """
    spark = batches.sparkSession
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BATCH_STATUS)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {VERSION} INT) USING parquet PARTITIONED BY ({VERSION})"
    )
    minute = F.date_trunc("minute", F.col("execute_time").cast("timestamp_ntz")).cast("timestamp_ntz")
    key = F.struct(minute.alias("execute_time"), F.col("status").cast("int").alias("status"))
    asked = batches.select(key.alias("entry")).distinct()
    for _ in range(tries):
        version = last_version(spark, table)
        ledger = spark.table(table).where(F.col(VERSION) <= version)
        lacking = new_rows(asked, ledger.select(key.alias("entry")), "entry").select("entry.*")
        (first,) = next_number(ledger, "batch_id").first()
        numbered = assign_ids(lacking, ["execute_time", "status"], "batch_id", first)
        folder, rows = write_aside(conform(numbered, BATCH_STATUS), table)
        if not rows:
            remove(spark, folder)
            return 0
        if commit_version(spark, table, version + 1, folder):
            return rows
        remove(spark, folder)
    raise RuntimeError(f"{table} changed {tries} times while batches were entered")


def read_ledger(spark: SparkSession, table: str) -> DataFrame:
    """All entries: batch_id, execute_time, status."""
    return spark.table(table).select([f.name for f in BATCH_STATUS])


def write_jdbc(df: DataFrame, url: str, table: str, schema: T.StructType, mode: str, **options):
    """The same pinned rows to a database table; dates become timestamps there."""
    rows = conform(df, schema)
    days = [f.name for f in schema if isinstance(f.dataType, T.DateType)]
    rows = rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in days})
    rows.write.format("jdbc").mode(mode).options(url=url, dbtable=table, **options).save()


def _sized(df, partition_by):
    """Files of even size per partition; a large partition is split over several tasks."""
    return df.hint("rebalance", partition_by) if partition_by else df


@contextmanager
def _setting(spark, key, value):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)
