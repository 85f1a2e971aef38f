"""Warehouse tables: catalog probe, scans, row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

FULL = "init"
INCREMENTAL = "sync"


def load_mode(spark: SparkSession, table: str, schema: str | None = None) -> str:
    """``init`` while the target table is missing, ``sync`` once it exists.

    A missing schema is an error: it is set up by hand.
    """
    _require_schema(spark, schema)
    return INCREMENTAL if spark.catalog.tableExists(_qualified(table, schema)) else FULL


def read_table(spark: SparkSession, table: str, schema: str | None = None) -> DataFrame:
    """Scan of a warehouse table; fails right away where schema or table is missing."""
    _require_schema(spark, schema)
    name = _qualified(table, schema)
    if not spark.catalog.tableExists(name):
        raise LookupError(f"table {name} does not exist")
    return spark.table(name)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """Scan of a database table, split into ranges of a numeric or date column.

    Column and bounds come together; without them one task reads the whole table.
    """
    if (partition_column is None) != (bounds is None) or (partitions > 1 and not partition_column):
        raise ValueError("a split needs partition_column, bounds and partitions")
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return reader.load()


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and the row count its next action will report, without a pass of its own.

    Use the frame as it is: steps put on top may drop the count of an empty input.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _qualified(table, schema):
    return f"{schema}.{table}" if schema else table


def _require_schema(spark, schema):
    if schema and not spark.catalog.databaseExists(schema):
        raise LookupError(f"schema {schema} is not set up")
