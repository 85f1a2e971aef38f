"""Landed responses: tables are landed as JSON the way a collector does, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline import schemas
from tramline.functions import dates
from tramline.operators import reshape
from tramline.plans import ridership
from tramline.plans.events import refine_events
from tramline.plans.weather import district_items
from tramline.session import stage_path
from tramline.sources import landed, quarantine
from tramline.sources.districts import DISTRICT_GRID, district_grid
from tramline.workloads.events import REFINED_SQL, landed_events
from tramline.workloads.ridership import history
from tramline.workloads.tables import BATCH_DATE, table

QUERIES = {}
SQL = {}


def land(rows, service, folder=None):
    """Land each row as one response of ``service``; returns the landing root.

    Rows are rebalanced by folder first: few files per folder, large folders split.
    """
    root = stage_path(rows.sparkSession, "landing")
    fields = [c for c in rows.columns if c != folder]
    body = F.struct(F.lit(1).alias("list_total_count"), F.array(F.struct(*fields)).alias("row"))
    responses = rows.select(*([folder] if folder else []), body.alias(service))
    if folder:
        responses.hint("rebalance", folder).write.partitionBy(folder).json(f"{root}/{service}")
    else:
        responses.write.json(f"{root}/{service}")
    return root


def landed_event_load(spark, sf_dir):
    raw = landed_events(spark, sf_dir).drop("ALT")
    events = landed.event_rows(spark, land(raw, landed.EVENTS))
    undescribed = events.withColumn("ALT", F.lit(None).cast("string"))
    return refine_events(undescribed, BATCH_DATE, order=["HMPG_ADDR"])


QUERIES["landed_events"] = landed_event_load
SQL["landed_events"] = f"""
WITH {REFINED_SQL}
SELECT row_number() OVER (ORDER BY homepage) AS event_id,
       * REPLACE (CAST(NULL AS VARCHAR) AS event_description)
FROM refined
"""


def landed_year(spark, sf_dir):
    """Line quantities landed by month, an hour per line number; last year is read."""
    per_hour = [
        F.sum(F.when(F.col("hour") == hour, F.col("total"))).cast("long").alias(f"HR_{hour}_GET_ON_NOPE")
        for hour in range(1, 8)
    ]
    off = F.count_if(F.col("hour") == 1).alias("HR_1_GET_OFF_NOPE")
    wide = history(spark, sf_dir).groupBy("use_month", "name").agg(*per_hour, off)
    rows = wide.select(
        F.col("use_month").alias("ym"),
        F.col("use_month").alias("USE_MM"),
        F.lit("L").alias("SBWY_ROUT_LN_NM"),
        F.col("name").alias("STTN"),
        *reshape.hour_columns(wide),
    )
    root = land(rows, landed.HOURLY_RIDERS, "ym")
    year = landed.last_year_rows(spark, root, BATCH_DATE)
    return schemas.conform(ridership.refine_hourly(year), schemas.HOURLY)


QUERIES["landed_year"] = landed_year
SQL["landed_year"] = """
WITH lines AS (
  SELECT strftime(o_orderdate, '%Y%m') AS use_month, o_orderpriority AS name, l_linenumber,
         l_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'),
stations AS (SELECT DISTINCT use_month, name FROM lines),
hits AS (
  SELECT use_month, name, l_linenumber AS h, CAST(sum(l_quantity) AS BIGINT) AS get_on,
         count(*) FILTER (l_linenumber = 1) AS get_off
  FROM lines GROUP BY ALL)
SELECT s.use_month, s.name || '역' AS name, 'L' AS line, CAST(hours.h AS INTEGER) AS hour,
       coalesce(get_on, 0) AS get_on, coalesce(get_off, 0) AS get_off,
       coalesce(get_on, 0) + coalesce(get_off, 0) AS total
FROM stations s CROSS JOIN range(24) AS hours(h)
LEFT JOIN hits ON hits.use_month = s.use_month AND hits.name = s.name AND hits.h = hours.h
"""


def landed_forecast(spark, sf_dir):
    """Events landed as nested forecast items of a grid cell, tagged with its districts."""
    items = table(spark, sf_dir, "events").select(
        F.struct(
            F.col("event_type").alias("category"),
            dates.day_key(F.col("ts")).alias("fcstDate"),
            F.date_format("ts", "HHmmss").alias("fcstTime"),
            F.col("event_id").cast("string").alias("fcstValue"),
            (F.col("user_id") % 5 + 58).cast("int").alias("nx"),
            (F.col("user_id") % 6 + 124).cast("int").alias("ny"),
        ).alias("item")
    )
    nested = F.array("item").alias("item")
    for outer in ("items", "body", "response"):
        nested = F.struct(nested).alias(outer)
    root = stage_path(spark, "landing")
    items.select(nested).write.json(f"{root}/{landed.FORECAST}")
    return district_items(landed.forecast_items(spark, root), district_grid(spark))


QUERIES["landed_forecast"] = landed_forecast
SQL["landed_forecast"] = f"""
WITH grid(gu, nx, ny) AS (VALUES {", ".join(str(row) for row in DISTRICT_GRID)})
SELECT strftime(ts, '%Y%m%d') AS "fcstDate", strftime(ts, '%H%M%S') AS "fcstTime", gu,
       event_type AS category, CAST(event_id AS VARCHAR) AS "fcstValue"
FROM events JOIN grid ON nx = user_id % 5 + 58 AND ny = user_id % 6 + 124
"""


def spoilt_landing(spark, sf_dir):
    """Orders landed by month as ridership, with bad dates and numbers, cut lines, errors and empty answers.

    A response holds the orders of one of 50 customer groups and 4000 order keys, and declares the month's.
    """
    orders = table(spark, sf_dir, "orders")
    month, key = F.date_format("o_orderdate", "yyyyMM"), F.col("o_orderkey")
    row = F.struct(
        F.when(key % 7 == 0, "1997-13-45").when(key % 13 != 0, F.date_format("o_orderdate", "yyyyMMdd")).alias("USE_YMD"),
        F.col("o_orderstatus").alias("SBWY_ROUT_LN_NM"),
        F.col("o_orderpriority").alias("SBWY_STNS_NM"),
        F.when(key % 11 == 0, "n/a").when(key % 17 == 0, " ").otherwise(F.col("o_custkey").cast("string")).alias("GTON_TNOPE"),
        key.alias("GTOFF_TNOPE"),
    )
    totals = orders.groupBy(month.alias("ymd")).agg(F.count("*").alias("list_total_count"))
    pages = orders.groupBy(month.alias("ymd"), (F.col("o_custkey") % 50).alias("group"), F.floor(key / 4000).alias("page"))
    pages = pages.agg(F.collect_list(row).alias("row")).join(totals, "ymd")
    whole = F.to_json(F.struct(F.struct("list_total_count", "row").alias(landed.DAILY_RIDERS)))
    error = F.lit('{"RESULT": {"CODE": "ERROR-500", "MESSAGE": "server"}}')
    nothing = F.lit(f'{{"RESULT": {{"CODE": "{landed.NO_DATA}"}}}}')
    line = F.when(F.col("group") == 3, F.substr(whole, F.lit(1), F.length(whole) - 5)).when(F.col("group") == 5, error)
    line = line.when(F.col("group") == 8, nothing).otherwise(whole)
    root = stage_path(spark, "landing")
    lines = pages.select("ymd", line.alias("value"))
    lines.hint("rebalance", "ymd").write.partitionBy("ymd").text(f"{root}/{landed.DAILY_RIDERS}")
    return root


def spoilt_split(spark, sf_dir):
    rules = {"bad_USE_YMD": quarantine.not_a_date(F.col("USE_YMD"), "yyyyMMdd"), "no_USE_YMD": F.col("USE_YMD").isNull()}
    root = spoilt_landing(spark, sf_dir)
    return quarantine.read_split(spark, root, landed.DAILY_RIDERS, schemas.DAILY_ROW, "ymd", rules=rules)


def landed_quarantine(spark, sf_dir):
    """What a tolerant read puts aside, by month, reasons and station, and how many records each."""
    rejected = spoilt_split(spark, sf_dir).rejected
    station = F.get_json_object("record", "$.SBWY_STNS_NM").alias("station")
    short = F.when(F.array_contains("reasons", "incomplete"), F.col("record")).alias("shortfall")
    return rejected.groupBy("folder", F.array_join("reasons", ",").alias("reasons"), station, short).agg(F.count("*").alias("n"))


SPOILT_SQL = """
orders_landed AS (
  SELECT *, strftime(o_orderdate, '%Y%m') AS folder, o_custkey % 50 AS grp, o_orderkey // 4000 AS page,
         concat_ws(',', CASE WHEN o_orderkey % 11 = 0 THEN 'bad_GTON_TNOPE' END, CASE WHEN o_orderkey % 7 = 0 THEN 'bad_USE_YMD' END,
                   CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 13 = 0 THEN 'no_USE_YMD' END) AS reasons
  FROM orders)
"""
QUERIES["landed_quarantine"] = landed_quarantine
SQL["landed_quarantine"] = f"""
WITH {SPOILT_SQL},
lines AS (SELECT DISTINCT folder, grp, page FROM orders_landed WHERE grp IN (3, 5)),
short AS (
  SELECT folder, count(*) AS declared, count(*) FILTER (grp NOT IN (3, 5, 8)) AS collected FROM orders_landed GROUP BY folder)
SELECT folder, CASE grp WHEN 3 THEN 'malformed' ELSE 'no_envelope' END AS reasons, CAST(NULL AS VARCHAR) AS station,
       CAST(NULL AS VARCHAR) AS shortfall, count(*) AS n
FROM lines GROUP BY ALL
UNION ALL
SELECT folder, reasons, o_orderpriority, NULL, count(*) FROM orders_landed
WHERE reasons <> '' AND grp NOT IN (3, 5, 8) GROUP BY ALL
UNION ALL
SELECT folder, 'incomplete', NULL,
       collected || ' of ' || CASE WHEN collected > 0 THEN CAST(declared AS VARCHAR)
                                   WHEN EXISTS (SELECT * FROM orders_landed o WHERE o.folder = short.folder AND grp = 8) THEN '0'
                                   ELSE 'none declared' END, 1
FROM short
WHERE collected < declared
  AND (collected > 0 OR NOT EXISTS (SELECT * FROM orders_landed o WHERE o.folder = short.folder AND grp = 8))
"""


def landed_accepted(spark, sf_dir):
    """What a tolerant read lets through, as ridership by day."""
    return schemas.conform(ridership.refine_daily(spoilt_split(spark, sf_dir).good), schemas.DAILY)


QUERIES["landed_accepted"] = landed_accepted
SQL["landed_accepted"] = f"""
WITH {SPOILT_SQL}
SELECT strftime(o_orderdate, '%Y%m%d') AS service_date, o_orderstatus AS line, o_orderpriority || '역' AS name,
       CAST(CASE WHEN o_orderkey % 17 <> 0 THEN o_custkey END AS INTEGER) AS get_on_d, CAST(o_orderkey AS INTEGER) AS get_off_d
FROM orders_landed WHERE reasons = '' AND grp NOT IN (3, 5, 8)
"""


def landed_page_gaps(spark, sf_dir):
    """Orders landed by month as pages of up to 50 customers, the month's largest number being its total."""
    orders = table(spark, sf_dir, "orders")
    month = F.date_format("o_orderdate", "yyyyMM")
    totals = orders.groupBy(month.alias("ymd")).agg((F.max("o_custkey") + 20).alias("list_total_count"))
    first = F.col("o_custkey").cast("long")
    pages = orders.select(month.alias("ymd"), F.struct(first.alias("first"), (first + F.col("o_orderkey") % 50).alias("last")).alias("page"))
    answers = pages.join(totals, "ymd").select("ymd", "page", F.struct("list_total_count").alias(landed.DAILY_RIDERS))
    root = stage_path(spark, "landing")
    answers.hint("rebalance", "ymd").write.partitionBy("ymd").json(f"{root}/{landed.DAILY_RIDERS}")
    return landed.page_faults(spark, root, landed.DAILY_RIDERS, "ymd")


QUERIES["landed_page_gaps"] = landed_page_gaps
SQL["landed_page_gaps"] = """
WITH pages AS (
  SELECT strftime(o_orderdate, '%Y%m') AS ymd, CAST(greatest(o_custkey, 1) AS BIGINT) AS a, CAST(o_custkey + o_orderkey % 50 AS BIGINT) AS b
  FROM orders WHERE o_custkey + o_orderkey % 50 >= 1),
ends AS (SELECT ymd, max(a) + 21 AS a, max(a) + 20 AS b FROM pages GROUP BY ymd),
swept AS (
  SELECT *, greatest(0, coalesce(max(b) OVER (PARTITION BY ymd ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS seen
  FROM (SELECT * FROM pages UNION ALL SELECT * FROM ends))
SELECT ymd, 'gap' AS fault, seen + 1 AS first, a - 1 AS last FROM swept WHERE a > seen + 1
UNION ALL
SELECT ymd, 'overlap', a, least(b, seen) FROM swept WHERE a <= seen AND a <= b
"""
