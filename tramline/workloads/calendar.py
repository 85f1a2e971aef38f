"""Calendar functions over order and event dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.functions import dates
from tramline.workloads.tables import BATCH_DATE, table

QUERIES = {}
SQL = {}


def calendar_features(spark, sf_dir):
    batch = F.lit(BATCH_DATE)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.day_of_week(F.col("o_orderdate")).alias("day_of_week"),
        dates.is_weekend(F.col("o_orderdate")).alias("is_weekend"),
        batch.alias("batch_date"),
        dates.day_of_week(batch).alias("batch_day_of_week"),
        dates.is_weekend(batch).alias("batch_is_weekend"),
    )


QUERIES["calendar_features"] = calendar_features
SQL["calendar_features"] = f"""
SELECT o_orderkey, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week,
       CAST(isodow(o_orderdate) >= 6 AS INTEGER) AS is_weekend, DATE '{BATCH_DATE}' AS batch_date,
       CAST(isodow(DATE '{BATCH_DATE}') - 1 AS INTEGER) AS batch_day_of_week,
       CAST(isodow(DATE '{BATCH_DATE}') >= 6 AS INTEGER) AS batch_is_weekend
FROM orders
"""

QUERIES["prev_year_month"] = lambda spark, sf_dir: table(spark, sf_dir, "orders").select(
    "o_orderkey", dates.previous_year_month(F.col("o_orderdate")).alias("use_month")
)
SQL["prev_year_month"] = """
SELECT o_orderkey, strftime(o_orderdate - INTERVAL 1 YEAR, '%Y%m') AS use_month FROM orders
"""


def batch_calendar(spark, sf_dir):
    """Every event as a batch instant."""
    instant = F.col("ts")
    base_date, base_time = dates.forecast_base(instant)
    return table(spark, sf_dir, "events").select(
        "event_id",
        dates.city_date(instant).alias("batch_date"),
        dates.city_minute(instant).alias("batch_minute"),
        dates.ridership_date(dates.city_date(instant)).alias("service_date"),
        base_date.alias("base_date"),
        base_time.alias("base_time"),
    )


QUERIES["batch_calendar"] = batch_calendar
SQL["batch_calendar"] = """
SELECT event_id, CAST(ts + INTERVAL 9 HOUR AS DATE) AS batch_date,
       date_trunc('minute', ts + INTERVAL 9 HOUR) AS batch_minute,
       CAST(CAST(ts + INTERVAL 9 HOUR AS DATE) - INTERVAL 4 DAY AS DATE) AS service_date,
       strftime(ts + INTERVAL 8 HOUR, '%Y%m%d') AS base_date,
       strftime(ts + INTERVAL 8 HOUR, '%H') || '30' AS base_time
FROM events
"""


def month_dates(spark, sf_dir):
    """All dates of every month that has an order."""
    months = table(spark, sf_dir, "orders").select(F.trunc("o_orderdate", "MM").alias("m")).distinct()
    days = months.select("m", F.explode(dates.month_dates(F.col("m"))).alias("d"))
    return days.select(dates.month_key(F.col("m")).alias("month"), dates.day_key(F.col("d")).alias("ymd"))


QUERIES["month_dates"] = month_dates
SQL["month_dates"] = """
WITH months AS (SELECT DISTINCT date_trunc('month', o_orderdate) AS m FROM orders)
SELECT strftime(m, '%Y%m') AS month,
       strftime(unnest(generate_series(m, m + INTERVAL 1 MONTH - INTERVAL 1 DAY, INTERVAL 1 DAY)),
                '%Y%m%d') AS ymd
FROM months
"""


def prev_year_months(spark, sf_dir):
    """The twelve months before every year that has an order."""
    years = table(spark, sf_dir, "orders").select(F.trunc("o_orderdate", "YEAR").alias("y")).distinct()
    months = years.select("y", F.explode(dates.previous_year_months(F.col("y"))).alias("m"))
    return months.select(F.year("y").alias("year"), dates.month_key(F.col("m")).alias("ym"))


QUERIES["prev_year_months"] = prev_year_months
SQL["prev_year_months"] = """
WITH years AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)
SELECT year, CAST((year - 1) * 100 + unnest(range(1, 13)) AS VARCHAR) AS ym FROM years
"""
