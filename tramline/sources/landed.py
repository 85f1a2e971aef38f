"""Landed JSON responses, one per line, under ``<root>/<service>[/ymd=…|/ym=…|/base=…]``.

``ymd`` is the day collected (events, stations: each collection is complete) or the day of
service (daily ridership), ``ym`` the month of service, ``base`` a forecast's issue time.

All reads carry an explicit schema. A read of some days or months lists and opens only their
folders; one that has not landed is empty. An answer without the service's envelope fails the
read, unless it says that there is no data, and so do, where rows of a folder are read, folders
with fewer rows than the service declared.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline import schemas
from tramline.functions import dates
from tramline.operators.intervals import coverage_faults

# Names of the services and their envelopes.
EVENTS = "culturalEventInfo"
STATIONS = "subwayStationMaster"
DAILY_RIDERS = "CardSubwayStatsNew"
HOURLY_RIDERS = "CardSubwayTime"
FORECAST = "getUltraSrtFcst"
NO_DATA = "INFO-200"


def read_responses(
    spark: SparkSession,
    root: str,
    service: str,
    row: T.StructType,
    folder: str | None = None,
    multi_line: bool = False,
    values: Sequence[str] | None = None,
) -> DataFrame:
    """Responses as ``list_total_count`` and ``row`` (an array), with the folder column.

    ``values`` are the folders to read, all by default. A line that is not the expected JSON
    fails the read, and so does an answer without the envelope; one that says that there is
    no data counts as an empty response.
    """
    schema = T.StructType([*schemas.envelope(service, row).fields, *schemas.ERROR])
    raw = _read_folders(spark, f"{root}/{service}", schema, folder, values, multi_line)
    code = F.coalesce("RESULT.CODE", F.col(f"{service}.RESULT.CODE"))
    message = F.concat(F.lit(f"{service}: no rows but code "), F.coalesce(code, F.lit("none")))
    known = F.col(f"{service}.list_total_count").isNotNull() | F.col(f"{service}.row").isNotNull()
    checked = F.when(known, F.col(service)).when(code != NO_DATA, F.raise_error(message))
    checked = checked.when(code.isNull(), F.raise_error(message))
    return raw.withColumn("_answer", checked).select(
        F.when(known, F.col("_answer.list_total_count")).otherwise(F.lit(0)).alias("list_total_count"),
        F.col("_answer.row").alias("row"),
        *([folder] if folder else []),
    )


def _read_folders(spark, path, schema, folder, values, multi_line=False):
    options = {"mode": "FAILFAST", "multiLine": str(multi_line).lower()}
    return folders_of(spark, path, schema, folder, values, "json", **options)


def folders_of(
    spark: SparkSession, path: str, schema: T.StructType | str, folder: str | None, values: Sequence[str] | None, source: str, **options: str
) -> DataFrame:
    """Scan of ``path``; with ``values`` of those ``folder=value`` folders only that exist."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if folder:
        schema = T.StructType([*schema.fields, T.StructField(folder, T.StringType())])
    reader = spark.read.format(source).schema(schema).options(**options)
    if values is None:
        return reader.load(path)
    paths = [p for v in values if _exists(spark, p := f"{path}/{folder}={v}")]
    return reader.option("basePath", path).load(paths) if paths else spark.createDataFrame([], schema)


def _exists(spark, path):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def rows_of(responses: DataFrame) -> DataFrame:
    """One row per element of the response arrays."""
    return responses.select(F.inline("row"))


def completeness(responses: DataFrame, folder: str | None = None) -> DataFrame:
    """Declared and collected row counts, per folder where there is one."""
    return responses.groupBy(*([folder] if folder else [])).agg(
        F.max("list_total_count").alias("declared"),
        F.coalesce(F.sum(F.size(F.coalesce("row", F.array()))), F.lit(0)).alias("collected"),
    )


def complete_rows(responses: DataFrame, folder: str) -> DataFrame:
    """``rows_of`` complete folders; fails when one has fewer rows than it declares.

    The counts take one pass over the responses of the folders read, before the rows are used.
    """
    short = incomplete(responses, folder).orderBy(folder).take(5)
    if short:
        found = ", ".join(f"{r[folder]}: {r.collected} of {r.declared}" for r in short)
        raise ValueError(f"incomplete landing ({found})")
    return rows_of(responses)


def incomplete(responses: DataFrame, folder: str | None = None) -> DataFrame:
    """Folders whose collected rows fall short of what the service declared."""
    counts = completeness(responses, folder)
    return counts.where("declared IS NULL OR collected < declared")


def page_faults(spark: SparkSession, root: str, service: str, folder: str, values: Sequence[str] | None = None) -> DataFrame:
    """(folder, fault, first, last): rows that no landed page covers, or several do.

    Collectors write what they asked for beside the answer: ``"page": {"first": 1, "last": 1000}``.
    A missing page with a repeated one has the declared number of rows; it is found here.
    """
    page = T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])
    body = T.StructType([T.StructField("list_total_count", T.LongType())])
    schema = T.StructType([T.StructField(service, body), T.StructField("page", page)])
    pages = _read_folders(spark, f"{root}/{service}", schema, folder, values)
    ranges = pages.select(folder, "page.first", "page.last", F.col(f"{service}.list_total_count").alias("total"))
    return coverage_faults(ranges, folder, "first", "last", "total")


def event_rows(
    spark: SparkSession, root: str, batch_date: dt.date | None = None
) -> DataFrame:
    """All events as landed, with a batch date those of that day's collection."""
    return _collected(spark, root, EVENTS, schemas.EVENT_ROW, batch_date)


def station_rows(
    spark: SparkSession, root: str, batch_date: dt.date | None = None
) -> DataFrame:
    """The station master as landed, with a batch date that day's collection."""
    return _collected(spark, root, STATIONS, schemas.STATION_ROW, batch_date)


def _collected(spark, root, service, row, batch_date):
    if batch_date is None:
        return rows_of(read_responses(spark, root, service, row))
    day = batch_date.strftime("%Y%m%d")
    return complete_rows(read_responses(spark, root, service, row, "ymd", values=[day]), "ymd")


def published_days(batch_date: dt.date, lag_days: int = 4) -> list[str]:
    """Folder of the one day that is published on the batch date."""
    return [(batch_date - dt.timedelta(days=lag_days)).strftime("%Y%m%d")]


def last_month_days(batch_date: dt.date) -> list[str]:
    """Folders of the month before the batch date; January has last December's."""
    last = batch_date.replace(day=1) - dt.timedelta(days=1)
    return [f"{last:%Y%m}{day:02}" for day in range(1, last.day + 1)]


def daily_rows(spark: SparkSession, root: str, batch_date: dt.date, lag_days: int = 4) -> DataFrame:
    """Ridership of the one day that is published on the batch date."""
    return _riders(spark, root, published_days(batch_date, lag_days))


def last_month_rows(spark: SparkSession, root: str, batch_date: dt.date) -> DataFrame:
    """Ridership of every day of the month before the batch date."""
    return _riders(spark, root, last_month_days(batch_date))


def _riders(spark, root, days):
    return complete_rows(read_responses(spark, root, DAILY_RIDERS, schemas.DAILY_ROW, "ymd", values=days), "ymd")


def last_year_rows(
    spark: SparkSession, root: str, batch_date: dt.date, suffix: str = "NOPE"
) -> DataFrame:
    """Hourly station months of the year before the batch date.

    ``suffix`` ends the hour columns' names. A row that has none of them fails the read: its
    columns are named otherwise.
    """
    months = [f"{batch_date.year - 1}{month:02}" for month in range(1, 13)]
    schema = schemas.hourly_row(suffix)
    rows = complete_rows(read_responses(spark, root, HOURLY_RIDERS, schema, "ym", values=months), "ym")
    hours = [c for c in rows.columns if c.startswith("HR_")]
    message = F.lit(f"a row has no HR_…_{suffix} column")
    checked = F.when(F.coalesce(*hours).isNull(), F.raise_error(message)).otherwise(F.col("USE_MM"))
    return rows.withColumn("USE_MM", checked)


def forecast_items(
    spark: SparkSession, root: str, instant: dt.datetime | None = None
) -> DataFrame:
    """Forecast items; with a batch instant (UTC) those of the forecast issued for it.

    Forecasts land under ``base=<yyyyMMddHHmm>``.
    """
    values = None
    if instant:
        at = F.lit(instant.replace(tzinfo=None)).cast("timestamp_ntz")
        values = [spark.range(1).select(F.concat(*dates.forecast_base(at))).first()[0]]
    raw = _read_folders(spark, f"{root}/{FORECAST}", schemas.forecast_envelope(), "base", values)
    items = F.col("response.body.items.item")
    checked = F.when(items.isNull(), F.raise_error(F.lit(f"{FORECAST}: a response without items"))).otherwise(items)
    return raw.select(F.inline(checked))


def json_fields(text: DataFrame, column: str, ddl: str, *paths: str) -> DataFrame:
    """Add the fields at dotted ``paths`` of a JSON text column; ``ddl`` is its schema."""
    parsed = text.withColumn("_json", F.from_json(column, ddl))
    return parsed.select(*text.columns, *[F.col(f"_json.{p}") for p in paths])
