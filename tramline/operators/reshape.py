"""Wide hour columns to one row per hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.operators.aggregates import sum_by

PREFIX = "HR_"


def hour_columns(df: DataFrame, prefix: str = PREFIX) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def header_hour(header: Column) -> Column:
    """``HR_<hour>_GET_<ON|OFF>_…`` → hour."""
    return F.split_part(header, F.lit("_"), F.lit(2)).cast("int")


def header_ride(header: Column) -> Column:
    """``HR_<hour>_GET_<ON|OFF>_…`` → ON or OFF."""
    return F.split_part(header, F.lit("_"), F.lit(4))


def melt_hours(df: DataFrame, ids: Sequence[str], prefix: str = PREFIX) -> DataFrame:
    """One row per id and hour column: ``hour``, ``ride`` and ``riders``."""
    long = df.unpivot(list(ids), hour_columns(df, prefix), "_header", "riders")
    return long.select(
        *ids,
        header_hour(F.col("_header")).alias("hour"),
        header_ride(F.col("_header")).alias("ride"),
        "riders",
    )


def fold_rides(long: DataFrame, ids: Sequence[str]) -> DataFrame:
    """ON and OFF rows of an hour side by side as ``get_on`` and ``get_off``."""
    on = F.when(F.col("ride") == "ON", F.col("riders")).otherwise(0)
    off = F.when(F.col("ride") == "OFF", F.col("riders")).otherwise(0)
    sided = long.withColumns({"get_on": on, "get_off": off})
    return sum_by(sided, [*ids, "hour"], ["get_on", "get_off"])


def hourly_profile(wide: DataFrame, ids: Sequence[str], prefix: str = PREFIX) -> DataFrame:
    """``fold_rides(melt_hours(wide))`` with the sums pulled below the melt.

    Summing the wide rows per id first keeps the shuffle at one row per id and task; the
    summed row then unfolds into its hours in place, without a second shuffle.
    """
    headers = hour_columns(wide, prefix)
    by_hour: dict[int, dict[str, list[Column]]] = {}
    for header in headers:
        _, hour, _, ride = header.split("_")[:4]
        by_hour.setdefault(int(hour), {}).setdefault(ride, []).append(F.col(header))

    whole = all(isinstance(wide.schema[h].dataType, T.IntegralType) for h in headers)
    kind = "long" if whole else "double"

    def side(rides, name):
        return sum(rides.get(name, []), F.lit(0)).cast(kind).alias(f"get_{name.lower()}")

    hours = [
        F.struct(F.lit(hour).alias("hour"), side(rides, "ON"), side(rides, "OFF"))
        for hour, rides in by_hour.items()
    ]
    return sum_by(wide, ids, headers).select(*ids, F.inline(F.array(*hours)))
