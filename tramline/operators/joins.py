"""Joins of the load and forecast jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.operators.dedup import keep_first
from tramline.operators.skew import spread_join


def new_rows(incoming: DataFrame, baseline: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key the baseline lacks; null counts as a key like any other.

    Baseline keys are made distinct first (map-side), so a repeated key cannot pile up.
    """
    return spread_join(incoming, baseline.select(key).distinct(), [key], "left_anti", True)


def common_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on every column both sides have."""
    return spread_join(left, right, [c for c in left.columns if c in right.columns])


def keyed_update(
    df: DataFrame, updates: DataFrame, key: str, column: str, new: str
) -> DataFrame:
    """``column`` := ``new`` where ``updates`` has the key, a null included.

    A key that ``updates`` repeats takes its value that sorts first, nulls before others.
    """
    hits = keep_first(updates.select(key, F.col(new).alias("_new")), [key], ["_new"])
    hits = hits.withColumn("_hit", F.lit(True))
    joined = spread_join(df, hits, [key], "left")
    changed = F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column))
    return joined.withColumn(column, changed).select(*df.columns)


def with_default_lookup(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    value: str,
    default: str,
) -> DataFrame:
    """``value`` looked up by ``key``, ``default`` where there is no usable entry.

    A key that ``lookup`` repeats takes its value that sorts first, nulls before others.
    """
    joined = spread_join(df, keep_first(lookup.select(key, value), [key], [value]), [key], "left")
    return joined.withColumn(value, F.coalesce(value, F.lit(default)))


def expand_by_grid(
    items: DataFrame, grid: DataFrame, cell: Sequence[str] = ("nx", "ny")
) -> DataFrame:
    """Each item once per district in its grid cell. The grid is the 25-row literal table."""
    return items.join(F.broadcast(grid), list(cell))
