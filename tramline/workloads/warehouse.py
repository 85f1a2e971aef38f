"""Writes and landings read back: every job step that leaves something is run twice."""

from __future__ import annotations

import datetime as dt
import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from tramline import schemas
from tramline.plans import forecast, jobs, ridership
from tramline.session import stage, stage_path
from tramline.sinks.tables import append_table, enter_batches, read_ledger, replace_partitions, replace_table, update_partitions
from tramline.sources import landed
from tramline.sources.tables import load_mode, read_table
from tramline.workloads import ridership as rides
from tramline.workloads.events import BATCH_DATE, SQL as EVENT_SQL, fetched_pages, landed_events
from tramline.workloads.landings import land
from tramline.workloads.tables import table

QUERIES = {}
SQL = {}

BATCH = dt.datetime.combine(BATCH_DATE, dt.time(2)) - dt.timedelta(hours=9)  # 02:00 in the city


@contextmanager
def scratch_schema(spark):
    """A catalog schema for the tables of one query; results are staged before it goes."""
    name, before = f"tramline_{uuid.uuid4().hex[:12]}", spark.catalog.currentDatabase()
    spark.sql(f"CREATE SCHEMA {name}")
    spark.catalog.setCurrentDatabase(name)
    try:
        yield name
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"DROP SCHEMA {name} CASCADE")


def daily_landing(spark, sf_dir):
    """Orders landed as ridership, a folder per order date."""
    raw = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyyMMdd").alias("ymd"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("USE_YMD"),
        F.col("o_orderstatus").alias("SBWY_ROUT_LN_NM"),
        F.concat("o_orderpriority", F.lit(" ("), "o_orderkey", F.lit(")")).alias("SBWY_STNS_NM"),
        F.col("o_custkey").cast("double").alias("GTON_TNOPE"),
        F.col("o_orderkey").cast("double").alias("GTOFF_TNOPE"),
    )
    return land(raw, landed.DAILY_RIDERS, "ymd")


DAILY_SQL = """
SELECT strftime(o_orderdate, '%Y%m%d') AS service_date, o_orderstatus AS line, o_orderpriority || '역' AS name,
       CAST(o_custkey AS INTEGER) AS get_on_d, CAST(o_orderkey AS INTEGER) AS get_off_d
FROM orders WHERE {}
"""


def landed_daily(spark, sf_dir):
    """The day that is published on the batch date, among all days landed."""
    raw = landed.daily_rows(spark, daily_landing(spark, sf_dir), BATCH_DATE)
    return schemas.conform(ridership.refine_daily(raw), schemas.DAILY)


QUERIES["landed_daily"] = landed_daily
SQL["landed_daily"] = DAILY_SQL.format(f"o_orderdate = DATE '{BATCH_DATE - dt.timedelta(days=4)}'")


def landed_month(spark, sf_dir):
    """The month before the batch date, among all days landed."""
    raw = landed.last_month_rows(spark, daily_landing(spark, sf_dir), BATCH_DATE)
    return schemas.conform(ridership.refine_daily(raw), schemas.DAILY)


QUERIES["landed_month"] = landed_month
SQL["landed_month"] = DAILY_SQL.format("o_orderdate BETWEEN DATE '1998-06-01' AND DATE '1998-06-30'")


def landed_stations(spark, sf_dir):
    """Suppliers landed as the station master of the batch date, loaded twice, read back."""
    raw = table(spark, sf_dir, "supplier").select(
        F.lit(BATCH_DATE.strftime("%Y%m%d")).alias("ymd"),
        F.col("s_suppkey").cast("string").alias("BLDN_ID"),
        F.concat("s_name", F.lit("(x)")).alias("BLDN_NM"),
        F.col("s_nationkey").cast("string").alias("ROUTE"),
        F.concat(F.lit("37."), "s_suppkey").alias("LAT"),
        F.concat(F.lit("126."), "s_suppkey").alias("LOT"),
    )
    root = land(raw, landed.STATIONS, "ymd")
    with scratch_schema(spark):
        for _ in range(2):
            jobs.load_stations(spark, root, BATCH)
        return stage(read_table(spark, "subway_station"), "read_back")


QUERIES["landed_stations"] = landed_stations
SQL["landed_stations"] = rides.SQL["station_refine"]


def landed_incomplete(spark, sf_dir):
    """Order lines landed per ship date as responses that declare their line numbers: what falls short."""
    lines = table(spark, sf_dir, "lineitem")
    root = stage_path(spark, "landing")
    body = F.struct(
        F.col("l_linenumber").cast("long").alias("list_total_count"),
        F.array(F.struct(F.col("l_returnflag").alias("SBWY_ROUT_LN_NM"))).alias("row"),
    )
    answers = lines.select(F.date_format("l_shipdate", "yyyyMM").alias("ymd"), body.alias(landed.DAILY_RIDERS))
    answers.hint("rebalance", "ymd").write.partitionBy("ymd").json(f"{root}/{landed.DAILY_RIDERS}")
    raw = landed.read_responses(spark, root, landed.DAILY_RIDERS, schemas.DAILY_ROW, "ymd")
    return landed.incomplete(raw, "ymd")


QUERIES["landed_incomplete"] = landed_incomplete
SQL["landed_incomplete"] = """
SELECT strftime(l_shipdate, '%Y%m') AS ymd, CAST(max(l_linenumber) AS BIGINT) AS declared, count(*) AS collected
FROM lineitem GROUP BY 1 HAVING count(*) < max(l_linenumber)
"""


def partitions_twice(spark, sf_dir):
    """Ridership by day: all days, then twice the second half of 1997 with other counts."""
    days = rides.daily_refine(spark, sf_dir)
    late = days.where(F.col("service_date").between("19970701", "19971231"))
    late = late.withColumn("get_on_d", F.col("get_on_d") + 1)
    with scratch_schema(spark):
        for rows in (days, late, late):
            replace_partitions(rows, "daily", schemas.DAILY, "service_date")
        found = read_table(spark, "daily").select([f.name for f in schemas.DAILY])
        return stage(found, "read_back")


QUERIES["table_partitions_twice"] = partitions_twice
SQL["table_partitions_twice"] = f"""
SELECT * REPLACE (CAST(CASE WHEN service_date BETWEEN '19970701' AND '19971231' THEN get_on_d + 1
                            ELSE get_on_d END AS INTEGER) AS get_on_d)
FROM ({rides.SQL["daily_refine"]})
"""


def replace_and_append(spark, sf_dir):
    """Ridership replaced twice and appended once: each row twice; with the mode before and after."""
    days = rides.daily_refine(spark, sf_dir)
    with scratch_schema(spark):
        before = load_mode(spark, "daily")
        for _ in range(2):
            replace_table(days, "daily", schemas.DAILY)
        append_table(days, "daily", schemas.DAILY)
        found = read_table(spark, "daily").groupBy("line", "name").agg(F.count("*").alias("n"), F.sum("get_on_d").alias("get_on"))
        modes = {"mode_before": F.lit(before), "mode_after": F.lit(load_mode(spark, "daily"))}
        return stage(found.withColumns(modes), "read_back")


QUERIES["table_replace_append"] = replace_and_append
SQL["table_replace_append"] = f"""
SELECT line, name, 2 * count(*) AS n, CAST(2 * sum(get_on_d) AS BIGINT) AS get_on, 'init' AS mode_before, 'sync' AS mode_after
FROM ({rides.SQL["daily_refine"]}) GROUP BY line, name
"""


def update_touched(spark, sf_dir):
    """Daily ridership by month: customers' counts of 1996 are updated in place, and which months were written again."""
    daily = rides.daily_refine(spark, sf_dir).withColumn("month", F.substring("service_date", 1, 6))
    updates = daily.where("service_date BETWEEN '19960101' AND '19961231' AND get_on_d % 3 = 0")
    updates = updates.select("get_off_d", (F.col("get_on_d") + 1000).alias("new_on"))

    def files(name):
        rows = read_table(spark, "daily").select("month", F.input_file_name().alias("file"))
        return stage(rows.groupBy("month").agg(F.array_sort(F.collect_set("file")).alias(name)), "read_back")

    with scratch_schema(spark):
        daily.hint("rebalance", "month").write.partitionBy("month").saveAsTable("daily")
        before = files("before")
        update_partitions("daily", updates, "get_off_d", "get_on_d", "new_on", "month")
        kept = before.join(files("after"), "month").select("month", (F.col("before") != F.col("after")).alias("rewritten"))
        sums = read_table(spark, "daily").groupBy("month").agg(F.count("*").alias("n"), F.sum("get_on_d").alias("get_on"))
        return stage(sums.join(kept, "month"), "read_back")


QUERIES["table_update_touched"] = update_touched
SQL["table_update_touched"] = f"""
WITH daily AS (SELECT *, service_date[:6] AS month, service_date[:4] = '1996' AND get_on_d % 3 = 0 AS hit
               FROM ({rides.SQL["daily_refine"]}))
SELECT month, count(*) AS n, CAST(sum(get_on_d + CASE WHEN hit THEN 1000 ELSE 0 END) AS BIGINT) AS get_on, bool_or(hit) AS rewritten
FROM daily GROUP BY month
"""


def ledger_twice(spark, sf_dir):
    """A ledger with an entry for each day that has orders: first the days of 1995, then all days, then all again."""
    day = F.to_date("o_orderdate")
    seconds = F.make_dt_interval(hours=F.lit(2), secs=F.lit(31))
    times = table(spark, sf_dir, "orders").select((day.cast("timestamp_ntz") + seconds).alias("execute_time"), F.lit(0).alias("status"))
    with scratch_schema(spark):
        for batches in (times.where(F.year("execute_time") == 1995), times, times):
            enter_batches(batches, "batch_status")
        return stage(read_ledger(spark, "batch_status"), "read_back")


QUERIES["ledger_twice"] = ledger_twice
SQL["ledger_twice"] = """
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT row_number() OVER (ORDER BY year(day) <> 1995, day) AS batch_id, CAST(day AS TIMESTAMP) + INTERVAL 2 HOUR AS execute_time,
       CAST(0 AS INTEGER) AS status
FROM days
"""


def replace_reads(spark, sf_dir):
    """Sums of a replaced table: read by a plan made before, after a replacement that fails on the way, and after one that does not."""
    days = rides.daily_refine(spark, sf_dir)
    late = days.withColumn("get_on_d", F.col("get_on_d") + 1)
    some = F.pmod(F.xxhash64("service_date", "get_off_d"), F.lit(10)) == 0  # so tasks fail on their way
    broken = F.when(some, F.raise_error(F.lit("broken row")).cast("int")).otherwise(F.col("get_on_d"))

    def sums(name):
        rows = read_table(spark, "daily").groupBy("line", "name")
        return rows.agg(F.sum("get_on_d").alias(name))

    with scratch_schema(spark):
        replace_table(days, "daily", schemas.DAILY)
        planned = sums("planned_before")
        planned.schema
        try:
            replace_table(late.withColumn("get_on_d", broken), "daily", schemas.DAILY)
        except Exception as error:
            if "broken row" not in str(error):
                raise
        failed = stage(sums("after_failure"), "read_back")
        replace_table(late, "daily", schemas.DAILY)
        found = planned.join(failed, ["line", "name"], "full").join(sums("after"), ["line", "name"], "full")
        return stage(found, "read_back")


QUERIES["table_replace_reads"] = replace_reads
SQL["table_replace_reads"] = f"""
SELECT line, name, CAST(sum(get_on_d) AS BIGINT) AS planned_before, CAST(sum(get_on_d) AS BIGINT) AS after_failure,
       CAST(sum(get_on_d) + count(*) AS BIGINT) AS after
FROM ({rides.SQL["daily_refine"]}) GROUP BY line, name
"""


def publish_twice(spark, sf_dir):
    """The event jobs with their first batch, drafted and published twice, answers being labels."""
    rows = landed_events(spark, sf_dir).drop("ALT").withColumn("ymd", F.lit(BATCH_DATE.strftime("%Y%m%d")))
    root = land(rows, landed.EVENTS, "ymd")
    answers = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("event_id"), F.concat(F.lit("quality "), "quality").alias("answer")
    )
    with scratch_schema(spark):
        fetched_pages(spark, sf_dir).write.saveAsTable("pages")
        answers.write.saveAsTable("answers")
        for _ in range(2):
            jobs.draft_events(spark, root, "pages", BATCH)
            jobs.publish_events(spark, "answers", BATCH)
            jobs.publish_events(spark, "answers", BATCH)
        return stage(read_table(spark, "event"), "read_back")


QUERIES["event_publish_twice"] = publish_twice
SQL["event_publish_twice"] = EVENT_SQL["event_full_load"]


def forest_check(spark, sf_dir):
    """Per pair: the forecast's date and whether it lies within the pair's and the forest's range; and
    whether the forest beats the mean on held-out rows. The model is saved and loaded in between."""
    model = rides.forest(spark, sf_dir)
    path = stage_path(spark, "model")
    model.save(path)
    loaded = forecast.DailyModel.load(spark, path)
    span = model.rows.agg(F.min(forecast.TARGET).alias("low"), F.max(forecast.TARGET).alias("high")).first()
    predicted = forecast.predict_daily(loaded, BATCH_DATE)
    value = F.col(next(c for c in predicted.columns if c not in ("date", "line", "name")))
    return predicted.select(
        "line", "name", "date", value.between(span.low - 1, span.high + 1).alias("in_range"), F.lit(model.r2 > 0).alias("beats_mean")
    )


QUERIES["rf_forecast_check"] = forest_check
SQL["rf_forecast_check"] = f"""
SELECT o_orderstatus AS line, o_orderpriority AS name, DATE '{BATCH_DATE}' AS date, true AS in_range, true AS beats_mean
FROM orders GROUP BY ALL
UNION
SELECT l_linestatus, l_returnflag, DATE '{BATCH_DATE}', true, true FROM lineitem GROUP BY ALL
"""
