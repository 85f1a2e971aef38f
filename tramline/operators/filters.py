"""Row filters that keep the feed's treatment of nulls."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def still_running(df: DataFrame, end: str, batch_date: dt.date) -> DataFrame:
    """Rows that end on or after the batch date; rows without an end drop out."""
    return df.where(F.col(end) >= F.lit(batch_date))


def without_value(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose column is not ``value``; nulls stay."""
    return df.where(~F.col(column).eqNullSafe(F.lit(value)))
