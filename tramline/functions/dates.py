"""Calendar columns. Batch dates are arguments; nothing here reads the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CITY_ZONE = "Asia/Seoul"


def city_time(instant: Column, zone: str = CITY_ZONE) -> Column:
    """Wall-clock time in the city for a UTC instant without zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), instant)


def city_date(instant: Column, zone: str = CITY_ZONE) -> Column:
    return F.to_date(city_time(instant, zone))


def city_minute(instant: Column, zone: str = CITY_ZONE) -> Column:
    """City wall-clock time cut to the minute."""
    local = city_time(instant, zone)
    return local - F.make_dt_interval(secs=F.extract(F.lit("SECOND"), local))


def strict_date(text: Column, pattern: str | None = None) -> Column:
    """Date in ``text``; empty text counts as null, anything else that is no date fails."""
    given = F.nullif(text, F.lit(""))
    day = F.try_to_date(given, pattern) if pattern else given.try_cast("date")
    wrong = F.raise_error(F.concat(F.lit("not a date: "), given))
    return F.when(given.isNotNull() & day.isNull(), wrong).otherwise(day)


def ridership_date(batch_date: Column, lag_days: int = 4) -> Column:
    """Day whose ridership is published on ``batch_date``."""
    return F.date_sub(batch_date, lag_days)


def forecast_base(instant: Column, zone: str = CITY_ZONE) -> tuple[Column, Column]:
    """Base date ``yyyyMMdd`` and base time ``HH30`` of the forecast issued an hour before."""
    issued = city_time(instant, zone) - F.expr("INTERVAL 1 HOUR")
    return F.date_format(issued, "yyyyMMdd"), F.date_format(issued, "HH'30'")


def day_of_week(day: Column) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(day)


def is_weekend(day: Column) -> Column:
    return day_of_week(day).isin(5, 6).cast("int")


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMM")


def day_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def previous_year_month(day: Column) -> Column:
    """``yyyyMM`` of the same day a year before; 29 February counts as 28 February."""
    return month_key(F.add_months(day, -12))


def month_dates(day: Column) -> Column:
    """All dates of the month of ``day`` as an array."""
    return F.sequence(F.trunc(day, "MM"), F.last_day(day))


def previous_month_dates(day: Column) -> Column:
    """All dates of the month before ``day``; in January that is last December."""
    return month_dates(F.add_months(day, -1))


def previous_year_months(day: Column) -> Column:
    """First days of the twelve months of the year before ``day`` as an array."""
    start = F.add_months(F.trunc(day, "YEAR"), -12)
    return F.sequence(start, F.add_months(start, 11), F.expr("INTERVAL 1 MONTH"))
