"""Grouped sums, shares, distinct pairs and scalar scores.

All of these are hash aggregates with a map-side half, so a hot group reaches the shuffle
as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.numbers import ratio


def sum_by(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sums per key. Rows with a null key part drop out; a sum of nothing is 0."""
    sums = [F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures]
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*sums)


def hourly_share(
    history: DataFrame,
    period: str = "use_month",
    name: str = "name",
    hour: str = "hour",
    value: str = "total",
) -> DataFrame:
    """Share of each hour in its station's period total, over all lines.

    The window runs on the already summed rows, so a partition holds one row per hour
    (at most 24), however many rows the station has.
    """
    hourly = sum_by(history, [period, name, hour], [value])
    total = F.sum(value).over(Window.partitionBy(period, name))
    return hourly.withColumn(f"{value}_period", total).withColumn(
        "usage_ratio", ratio(F.col(value), F.col(f"{value}_period"))
    )


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def next_number(df: DataFrame, column: str) -> DataFrame:
    """One row: the highest number plus one, 1 for an empty table."""
    return df.agg((F.coalesce(F.max(column), F.lit(0)) + 1).alias(f"next_{column}"))


def r2_score(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row with the coefficient of determination; one pass, mergeable moments."""
    error = F.col(actual) - F.col(predicted)
    spread = F.var_pop(actual) * F.count(actual)
    return df.dropna(subset=[actual, predicted]).agg(
        (1 - F.try_divide(F.sum(error * error), spread)).alias("r2")
    )


def count_where(condition: Column) -> Column:
    """Number of rows of the group that meet ``condition``."""
    return F.count_if(condition)
