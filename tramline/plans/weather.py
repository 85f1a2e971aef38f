"""Short-term weather per district."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline import schemas
from tramline.functions import weather
from tramline.operators.ids import assign_ids
from tramline.operators.joins import expand_by_grid
from tramline.operators.skew import spread_join

SLOT = ["fcstDate", "fcstTime", "gu"]


def district_items(items: DataFrame, grid: DataFrame) -> DataFrame:
    """Forecast items tagged with every district of their grid cell."""
    return expand_by_grid(items, grid).select(*SLOT, "category", "fcstValue")


def refine_weather(items: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """One row per notable weather item with its slot's temperature, null if unknown.

    A slot may keep several statuses, and null slot parts match each other. A temperature with
    decimals is rounded, one that is no number is unknown. ``order`` fixes the numbering; by
    default slot, status and temperature.
    """
    temperatures = items.where(F.col("category") == weather.TEMPERATURE).select(
        *SLOT, F.round(F.col("fcstValue").try_cast("double")).try_cast("int").alias("temperture")
    )
    status = weather.weather_status(F.col("category"), F.col("fcstValue"))
    notable = (
        items.where(F.col("category").isin(weather.STATUS_CATEGORIES))
        .withColumn("weather_status", status)
        .where(F.col("weather_status") != weather.PLAIN)
    )
    merged = spread_join(notable, temperatures, SLOT, "left", null_safe=True)
    numbered = assign_ids(merged, order or [*SLOT, "weather_status", "temperture"], "id")
    named = numbered.withColumnsRenamed({"fcstDate": "fcst_date", "fcstTime": "time"})
    return schemas.conform(named, schemas.WEATHER)
