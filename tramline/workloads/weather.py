"""Forecast items, the district grid and JSON fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.operators.joins import expand_by_grid
from tramline.plans.weather import SLOT, refine_weather
from tramline.sources.districts import DISTRICT_GRID, district_grid
from tramline.sources.landed import json_fields
from tramline.workloads.tables import table

QUERIES = {}
SQL = {}


def forecast_items(spark, sf_dir):
    """Events as forecast items of a user's quarter day.

    Clicks, purchases and errors are lightning, rain and sky items, signups a category
    that no job reads; views give the slot's one temperature.
    """
    events = json_fields(table(spark, sf_dir, "events"), "props", "k int", "k")
    slot = [
        F.date_format("ts", "yyyyMMdd").alias("fcstDate"),
        F.lpad((F.floor(F.hour("ts") / 6) * 6).cast("string"), 2, "0").alias("fcstTime"),
        F.col("user_id").cast("string").alias("gu"),
    ]
    kinds = {"click": "LGT", "purchase": "PTY", "error": "SKY", "signup": "REH"}
    category = F.lit(None).cast("string")
    for kind, name in kinds.items():
        category = F.when(F.col("event_type") == kind, name).otherwise(category)
    items = events.where("event_type <> 'view'").select(
        *slot, category.alias("category"), F.expr("k div 12").cast("string").alias("fcstValue"),
        "event_id",
    )
    views = events.where("event_type = 'view'").select(*slot, "k", "event_id")
    warm = views.groupBy(*SLOT).agg(
        F.lit("T1H").alias("category"),
        F.max("k").cast("string").alias("fcstValue"),
        F.min("event_id").alias("event_id"),
    )
    return items.unionByName(warm)


def weather_refine(spark, sf_dir):
    return refine_weather(forecast_items(spark, sf_dir), [*SLOT, "event_id"])


QUERIES["weather_refine"] = weather_refine
SQL["weather_refine"] = """
WITH items AS (
  SELECT strftime(ts, '%Y%m%d') AS fcst_date, lpad(CAST(hour(ts) // 6 * 6 AS VARCHAR), 2, '0') AS time,
         CAST(user_id AS VARCHAR) AS gu, event_type, event_id,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k
  FROM events),
notable AS (
  SELECT *, CASE
      WHEN event_type = 'click' AND k // 12 > 1 THEN '낙뢰'
      WHEN event_type = 'purchase' AND k // 12 IN (1, 2, 4, 5, 6) THEN '비'
      WHEN event_type = 'purchase' AND k // 12 IN (3, 7) THEN '눈'
      WHEN event_type = 'error' AND k // 12 = 1 THEN '맑음'
      WHEN event_type = 'error' AND k // 12 = 3 THEN '구름많음'
      WHEN event_type = 'error' AND k // 12 = 4 THEN '흐림' END AS weather_status
  FROM items),
warm AS (
  SELECT fcst_date, time, gu, max(k) AS temperture FROM items
  WHERE event_type = 'view' GROUP BY ALL)
SELECT row_number() OVER (ORDER BY fcst_date, time, gu, event_id) AS id, fcst_date, time, gu,
       weather_status, temperture
FROM notable LEFT JOIN warm USING (fcst_date, time, gu)
WHERE weather_status IS NOT NULL
"""


def grid_enrich(spark, sf_dir):
    """Suppliers placed on grid cells by nation, once per district of the cell."""
    cells = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        (F.col("s_nationkey") % 5 + 58).alias("nx"),
        (F.expr("s_nationkey div 5") + 125).cast("int").alias("ny"),
    )
    return expand_by_grid(cells, district_grid(spark))


QUERIES["grid_enrich"] = grid_enrich
SQL["grid_enrich"] = f"""
WITH grid(gu, nx, ny) AS (VALUES {", ".join(str(row) for row in DISTRICT_GRID)}),
cells AS (SELECT s_suppkey, s_nationkey % 5 + 58 AS nx, s_nationkey // 5 + 125 AS ny FROM supplier)
SELECT nx, ny, s_suppkey, gu FROM cells JOIN grid USING (nx, ny)
"""

QUERIES["json_extract"] = lambda spark, sf_dir: json_fields(
    table(spark, sf_dir, "events").select("event_id", "props"), "props", "k int", "k"
).drop("props")
SQL["json_extract"] = (
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"
)
