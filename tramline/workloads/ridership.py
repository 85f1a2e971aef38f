"""Ridership history, hourly shares, forecast, labels and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline import schemas
from tramline.functions import dates
from tramline.functions.numbers import ordered_pair
from tramline.operators import aggregates, labels, reshape
from tramline.operators.dedup import union_keep_first
from tramline.operators.ids import assign_ids
from tramline.operators.skew import spread_join
from tramline.plans import forecast, ridership
from tramline.session import stage
from tramline.workloads.tables import BATCH_DATE, table

QUERIES = {}
SQL = {}


def history(spark, sf_dir):
    """Ridership of past months: lines of an order are hours, its priority the station."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.month_key(F.col("o_orderdate")).alias("use_month"),
        F.col("o_orderpriority").alias("name"),
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_linenumber").alias("hour"),
        F.col("l_quantity").alias("total"),
    )
    return spread_join(lines, orders, ["o_orderkey"]).drop("o_orderkey")


def daily_forecast(spark, sf_dir):
    """A forecast per date, line and station: a thousand riders per order of that day."""
    orders = table(spark, sf_dir, "orders")
    keys = [
        F.to_date("o_orderdate").alias("date"),
        F.col("o_orderstatus").alias("line"),
        F.col("o_orderpriority").alias("name"),
    ]
    return orders.groupBy(*keys).agg((F.count("*") * 1000).alias("predicted_get_on_d"))


def hourly_disaggregate(spark, sf_dir):
    return forecast.split_by_hour(history(spark, sf_dir), daily_forecast(spark, sf_dir))


def hourly_forecast_rollup(spark, sf_dir):
    return schemas.conform(
        forecast.roll_up_hours(hourly_disaggregate(spark, sf_dir)), schemas.PREDICTION
    )


HOURLY_SQL = """
hourly AS (
  SELECT strftime(o_orderdate, '%Y%m') AS use_month, o_orderpriority AS name,
         l_linenumber AS hour, sum(l_quantity) AS total
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
shares AS (
  SELECT use_month, name, hour,
         total / sum(total) OVER (PARTITION BY use_month, name) AS usage_ratio
  FROM hourly),
daily AS (
  SELECT CAST(o_orderdate AS DATE) AS date, o_orderstatus AS line, o_orderpriority AS name,
         count(*) * 1000 AS predicted_get_on_d
  FROM orders GROUP BY ALL),
split AS (
  SELECT line, name, date, hour,
         CAST(trunc(usage_ratio * predicted_get_on_d) AS INTEGER) AS predicted_total
  FROM (SELECT *, strftime(date - INTERVAL 1 YEAR, '%Y%m') AS use_month FROM daily)
  NATURAL JOIN shares)
"""

QUERIES["hourly_disaggregate"] = hourly_disaggregate
SQL["hourly_disaggregate"] = f"WITH {HOURLY_SQL} SELECT * FROM split"

QUERIES["hourly_forecast_rollup"] = hourly_forecast_rollup
SQL["hourly_forecast_rollup"] = f"""
WITH {HOURLY_SQL}
SELECT row_number() OVER (ORDER BY name, date, hour) AS row_number, name || '역' AS name,
       date AS service_date, hour, CAST(sum(predicted_total) AS BIGINT) AS predicted_total
FROM split GROUP BY name, date, hour
"""


def usage_ratio(spark, sf_dir):
    """Hourly shares of each event type's monthly value, in whole cents."""
    events = table(spark, sf_dir, "events").select(
        dates.month_key(F.col("ts")).alias("use_month"),
        F.col("event_type").alias("name"),
        F.hour("ts").alias("hour"),
        F.round(F.col("value") * 100).cast("long").alias("total"),
    )
    return aggregates.hourly_share(events).withColumn("usage_ratio", F.round("usage_ratio", 9))


QUERIES["usage_ratio"] = usage_ratio
SQL["usage_ratio"] = """
WITH hourly AS (
  SELECT strftime(ts, '%Y%m') AS use_month, event_type AS name,
         CAST(hour(ts) AS INTEGER) AS hour,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total
  FROM events GROUP BY ALL),
both_sums AS (
  SELECT *, CAST(sum(total) OVER (PARTITION BY use_month, name) AS BIGINT) AS total_period
  FROM hourly)
SELECT *, round(CAST(total AS DOUBLE) / total_period, 9) AS usage_ratio FROM both_sums
"""


# Every event boards or alights.
RIDE_SQL = "CASE WHEN event_type IN ('view', 'signup') THEN 'ON' ELSE 'OFF' END"


def wide_hours(spark, sf_dir):
    """Views and signups (ON), all other events (OFF) per user and weekday, a column pair per hour."""
    events = table(spark, sf_dir, "events")
    ids = [
        dates.month_key(F.col("ts")).alias("USE_MM"),
        F.col("user_id").cast("string").alias("STTN"),
        F.date_format("ts", "EEE").alias("SBWY_ROUT_LN_NM"),
    ]
    counts = [
        F.count_if((F.hour("ts") == hour) & (F.expr(RIDE_SQL) == ride)).alias(f"HR_{hour}_GET_{ride}_NOPE")
        for hour in range(24)
        for ride in ("ON", "OFF")
    ]
    return events.groupBy(*ids).agg(*counts)


def hourly_melt(spark, sf_dir):
    return schemas.conform(ridership.refine_hourly(wide_hours(spark, sf_dir)), schemas.HOURLY)


QUERIES["hourly_melt"] = hourly_melt
SQL["hourly_melt"] = f"""
WITH ids AS (
  SELECT DISTINCT strftime(ts, '%Y%m') AS use_month, user_id, strftime(ts, '%a') AS line
  FROM events),
hits AS (
  SELECT strftime(ts, '%Y%m') AS use_month, user_id, strftime(ts, '%a') AS line, hour(ts) AS h,
         count(*) FILTER ({RIDE_SQL} = 'ON') AS get_on,
         count(*) FILTER ({RIDE_SQL} = 'OFF') AS get_off
  FROM events GROUP BY ALL)
SELECT ids.use_month, CAST(ids.user_id AS VARCHAR) || '역' AS name, ids.line,
       CAST(hours.h AS INTEGER) AS hour, coalesce(get_on, 0) AS get_on,
       coalesce(get_off, 0) AS get_off, coalesce(get_on, 0) + coalesce(get_off, 0) AS total
FROM ids CROSS JOIN range(24) AS hours(h)
LEFT JOIN hits ON hits.use_month = ids.use_month AND hits.user_id = ids.user_id
  AND hits.line = ids.line AND hits.h = hours.h
"""


QUERIES["hourly_unpivot"] = lambda spark, sf_dir: reshape.melt_hours(
    wide_hours(spark, sf_dir), ["USE_MM", "STTN", "SBWY_ROUT_LN_NM"]
)
SQL["hourly_unpivot"] = f"""
WITH ids AS (
  SELECT DISTINCT strftime(ts, '%Y%m') AS m, user_id, strftime(ts, '%a') AS line FROM events),
hits AS (
  SELECT strftime(ts, '%Y%m') AS m, user_id, strftime(ts, '%a') AS line, hour(ts) AS h,
         {RIDE_SQL} AS ride, count(*) AS riders
  FROM events GROUP BY ALL)
SELECT ids.m AS "USE_MM", CAST(ids.user_id AS VARCHAR) AS "STTN", ids.line AS "SBWY_ROUT_LN_NM",
       CAST(hours.h AS INTEGER) AS hour, rides.ride, coalesce(riders, 0) AS riders
FROM ids CROSS JOIN range(24) AS hours(h) CROSS JOIN (VALUES ('ON'), ('OFF')) AS rides(ride)
LEFT JOIN hits ON hits.m = ids.m AND hits.user_id = ids.user_id AND hits.line = ids.line
  AND hits.h = hours.h AND hits.ride = rides.ride
"""


def long_rides(spark, sf_dir):
    """All events as ON and OFF rows, folded per user and hour."""
    long = table(spark, sf_dir, "events").select(
        "user_id",
        F.hour("ts").alias("hour"),
        F.expr(RIDE_SQL).alias("ride"),
        F.round(F.col("value") * 100).cast("long").alias("riders"),
    )
    return reshape.fold_rides(long, ["user_id"])


QUERIES["ride_fold"] = long_rides
SQL["ride_fold"] = f"""
SELECT user_id, CAST(hour(ts) AS INTEGER) AS hour,
       CAST(sum(CASE WHEN {RIDE_SQL} = 'ON' THEN CAST(round(value * 100) AS BIGINT) ELSE 0 END)
            AS BIGINT) AS get_on,
       CAST(sum(CASE WHEN {RIDE_SQL} = 'OFF' THEN CAST(round(value * 100) AS BIGINT) ELSE 0 END)
            AS BIGINT) AS get_off
FROM events GROUP BY ALL
"""


def daily_refine(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyyMMdd").alias("USE_YMD"),
        F.col("o_orderstatus").alias("SBWY_ROUT_LN_NM"),
        F.concat("o_orderpriority", F.lit(" ("), "o_orderstatus", F.lit(")")).alias("SBWY_STNS_NM"),
        F.col("o_custkey").alias("GTON_TNOPE"),
        F.col("o_orderkey").alias("GTOFF_TNOPE"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("REG_YMD"),
    )
    return schemas.conform(ridership.refine_daily(raw), schemas.DAILY)


QUERIES["daily_refine"] = daily_refine
SQL["daily_refine"] = """
SELECT strftime(o_orderdate, '%Y%m%d') AS service_date, o_orderstatus AS line,
       o_orderpriority || '역' AS name, CAST(o_custkey AS INTEGER) AS get_on_d,
       CAST(o_orderkey AS INTEGER) AS get_off_d
FROM orders
"""


def station_refine(spark, sf_dir):
    raw = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("BLDN_ID"),
        F.concat("s_name", F.lit("(x) (y)")).alias("BLDN_NM"),
        F.col("s_nationkey").cast("string").alias("ROUTE"),
        F.concat(F.lit("37."), "s_suppkey").alias("LAT"),
        F.concat(F.lit("126."), "s_suppkey").alias("LOT"),
    )
    return schemas.conform(ridership.refine_stations(raw), schemas.STATION)


QUERIES["station_refine"] = station_refine
SQL["station_refine"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS station_id, s_name || '역' AS name,
       CAST(s_nationkey AS VARCHAR) AS line, CAST('37.' || s_suppkey AS DOUBLE) AS latitude,
       CAST('126.' || s_suppkey AS DOUBLE) AS longitude
FROM supplier
"""


def union_dedup_keep_first(spark, sf_dir):
    """Order days as the monthly source, ship days as the daily one."""

    def shaped(df, day, line, on, off, *tie):
        return df.select(
            F.date_format(day, "yyyyMMdd").alias("service_date"),
            F.col(line).alias("line"),
            F.concat(F.lit("day "), F.dayofmonth(day)).alias("name"),
            F.col(on).alias("get_on_d"),
            F.col(off).alias("get_off_d"),
        )

    monthly = shaped(
        table(spark, sf_dir, "orders"), "o_orderdate", "o_orderstatus", "o_orderkey", "o_custkey"
    )
    daily = shaped(
        table(spark, sf_dir, "lineitem"), "l_shipdate", "l_linestatus", "l_orderkey", "l_partkey"
    )
    return union_keep_first([monthly, daily], forecast.KEYS, ["get_on_d", "get_off_d"])


QUERIES["union_dedup_keep_first"] = union_dedup_keep_first
SQL["union_dedup_keep_first"] = """
WITH both_sources AS (
  SELECT 0 AS source, strftime(o_orderdate, '%Y%m%d') AS service_date, o_orderstatus AS line,
         'day ' || day(o_orderdate) AS name, o_orderkey AS get_on_d, o_custkey AS get_off_d
  FROM orders
  UNION ALL
  SELECT 1, strftime(l_shipdate, '%Y%m%d'), l_linestatus, 'day ' || day(l_shipdate),
         l_orderkey, l_partkey
  FROM lineitem)
SELECT service_date, line, name, get_on_d, get_off_d FROM both_sources
QUALIFY row_number() OVER (PARTITION BY service_date, line, name
                           ORDER BY source, get_on_d, get_off_d) = 1
"""

QUERIES["distinct_pairs"] = lambda spark, sf_dir: aggregates.distinct_rows(
    table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"]
)
SQL["distinct_pairs"] = "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem"


def label_encode_decode(spark, sf_dir):
    """Codes of segment and name, and the segment decoded again."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_name")
    segments = labels.fit_labels(customers, "c_mktsegment")
    names = labels.fit_labels(customers, "c_name")
    coded = labels.encode(customers, segments, "c_mktsegment", "segment_code")
    coded = labels.encode(coded, names, "c_name", "name_code")
    return labels.decode(coded, segments, "segment_code", "segment_again")


QUERIES["label_encode_decode"] = label_encode_decode
SQL["label_encode_decode"] = """
SELECT c_custkey, c_mktsegment, c_name,
       dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS segment_code,
       dense_rank() OVER (ORDER BY c_name) - 1 AS name_code, c_mktsegment AS segment_again
FROM customer
"""


def hash_split(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", labels.split_flag(["o_orderkey", "o_custkey"]).alias("is_train")
    )


QUERIES["hash_split"] = hash_split
SQL["hash_split"] = """
SELECT o_orderkey,
       CAST('0x' || substr(md5(o_orderkey || '|' || o_custkey), 1, 8) AS BIGINT) % 100 < 70
         AS is_train
FROM orders
"""


def r2_score(spark, sf_dir):
    """How much of a line's quantity its flag and status explain."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    keys = ["l_returnflag", "l_linestatus"]
    means = stage(lines.groupBy(*keys).agg(F.avg("l_quantity").alias("predicted")), "means")
    scored = aggregates.r2_score(spread_join(lines, means, keys), "l_quantity", "predicted")
    return scored.select(F.round("r2", 9).alias("r2"))


QUERIES["r2_score"] = r2_score
SQL["r2_score"] = """
WITH scored AS (
  SELECT l_quantity AS y,
         avg(l_quantity) OVER (PARTITION BY l_returnflag, l_linestatus) AS predicted
  FROM lineitem)
SELECT round(1 - sum((y - predicted) * (y - predicted)) / (var_pop(y) * count(*)), 9) AS r2
FROM scored
"""


def swap_misordered(spark, sf_dir):
    low, high = ordered_pair(F.col("l_discount"), F.col("l_tax"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", low.alias("low"), high.alias("high")
    )


QUERIES["swap_misordered"] = swap_misordered
SQL["swap_misordered"] = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > l_tax THEN l_tax ELSE l_discount END AS low,
       CASE WHEN l_discount > l_tax THEN l_discount ELSE l_tax END AS high
FROM lineitem
"""

QUERIES["surrogate_id"] = lambda spark, sf_dir: assign_ids(
    table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey", "o_custkey"),
    ["o_orderdate", "o_orderkey"],
)
SQL["surrogate_id"] = """
SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id, o_orderdate, o_orderkey,
       o_custkey
FROM orders
"""


def ride_counts(df, day, line, name):
    return df.groupBy(
        F.date_format(day, "yyyyMMdd").alias("service_date"),
        F.col(line).alias("line"),
        F.col(name).alias("name"),
    ).agg(F.count("*").alias("get_on_d"))


def forest(spark, sf_dir):
    """A model of order and shipment counts per day."""
    monthly = ride_counts(
        table(spark, sf_dir, "orders"), "o_orderdate", "o_orderstatus", "o_orderpriority"
    )
    daily = ride_counts(
        table(spark, sf_dir, "lineitem"), "l_shipdate", "l_linestatus", "l_returnflag"
    )
    return forecast.train_daily(forecast.training_rows(monthly, daily))


def rf_forecast(spark, sf_dir):
    """Train on order and shipment counts per day, then forecast the batch date."""
    return forecast.predict_daily(forest(spark, sf_dir), BATCH_DATE)


QUERIES["rf_forecast"] = rf_forecast
