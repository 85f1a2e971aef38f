"""Forecast classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the forecast service.
TEMPERATURE = "T1H"
STATUS_CATEGORIES = ["SKY", "PTY", "LGT"]
RAIN_CODES = ["1", "2", "4", "5", "6"]
SNOW_CODES = ["3", "7"]
SKY_NAMES = {"1": "맑음", "3": "구름많음", "4": "흐림"}
LIGHTNING = "낙뢰"
RAIN = "비"
SNOW = "눈"
PLAIN = "plain"


def weather_status(category: Column, value: Column) -> Column:
    """Name of the weather a forecast item stands for, ``plain`` if nothing special."""
    lightning = (category == "LGT") & (value.try_cast("int") > 1)
    status = (
        F.when(lightning, LIGHTNING)
        .when((category == "PTY") & value.isin(RAIN_CODES), RAIN)
        .when((category == "PTY") & value.isin(SNOW_CODES), SNOW)
    )
    for code, name in SKY_NAMES.items():
        status = status.when((category == "SKY") & (value == code), name)
    return status.otherwise(PLAIN)
