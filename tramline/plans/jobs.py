"""One entry per scheduled job: read landings or tables, run the plan, write the tables.

Every job takes its batch time as an argument and can be run again: tables are replaced as
a whole or by the partitions a run covers. Each returns the number of rows written.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline import schemas
from tramline.functions.dates import CITY_ZONE
from tramline.plans import events, forecast, ridership, weather
from tramline.sinks.tables import append_ledger, replace_covered, replace_key_index, replace_partitions, replace_table
from tramline.sources import landed, quarantine
from tramline.sources.districts import district_grid
from tramline.sources.tables import FULL, load_mode, read_table


# Table properties of a finished draft.
MODE, BATCH = "tramline.mode", "tramline.batch"


def city_batch(instant: dt.datetime) -> dt.datetime:
    """City wall-clock time of a batch instant; an instant without zone is UTC."""
    aware = instant if instant.tzinfo else instant.replace(tzinfo=dt.timezone.utc)
    return aware.astimezone(ZoneInfo(CITY_ZONE)).replace(tzinfo=None)


def load_stations(
    spark: SparkSession, landing: str, instant: dt.datetime, table: str = "subway_station"
) -> int:
    raw = landed.station_rows(spark, landing, city_batch(instant).date())
    return replace_table(ridership.refine_stations(raw), table, schemas.STATION)


def load_daily(
    spark: SparkSession,
    landing: str,
    instant: dt.datetime,
    table: str = "subway_data_daily",
    rejected: str | None = None,
    most_rejected: float = 0.01,
) -> int:
    """The day published on the batch date joins the daily history.

    With ``rejected``, the name of a side table, bad lines and rows go there with their reasons; the
    job then fails only if they are more than ``most_rejected`` of all, after the side table is written.
    """
    day = city_batch(instant).date()
    if rejected:
        raw = accepted_daily(spark, landing, landed.published_days(day), rejected, most_rejected)
    else:
        raw = landed.daily_rows(spark, landing, day)
    return replace_partitions(ridership.refine_daily(raw), table, schemas.DAILY, "service_date")


def load_last_month(
    spark: SparkSession,
    landing: str,
    instant: dt.datetime,
    table: str = "subway_data_prev_month",
    rejected: str | None = None,
    most_rejected: float = 0.01,
) -> int:
    """All days of the month before the batch date; ``rejected`` as in ``load_daily``."""
    day = city_batch(instant).date()
    if rejected:
        raw = accepted_daily(spark, landing, landed.last_month_days(day), rejected, most_rejected)
    else:
        raw = landed.last_month_rows(spark, landing, day)
    return replace_partitions(ridership.refine_daily(raw), table, schemas.DAILY, "service_date")


def accepted_daily(
    spark: SparkSession, landing: str, days: list[str], rejected: str, most_rejected: float
) -> DataFrame:
    """Good ridership rows of some days; the others replace what the side table holds of these days."""
    rules = {"bad_USE_YMD": quarantine.not_a_date(F.col("USE_YMD"), "yyyyMMdd"), "no_USE_YMD": F.col("USE_YMD").isNull()}
    split = quarantine.read_split(spark, landing, landed.DAILY_RIDERS, schemas.DAILY_ROW, "ymd", days, rules)
    replace_covered(split.rejected, rejected, schemas.REJECTED, "folder", days)
    return split.require(most_rejected).good


def load_last_year(
    spark: SparkSession,
    landing: str,
    instant: dt.datetime,
    table: str = "subway_data_prev_year",
    suffix: str = "NOPE",
) -> int:
    """``suffix`` ends the hour columns' names; months that lack them all fail the job."""
    raw = landed.last_year_rows(spark, landing, city_batch(instant).date(), suffix)
    return replace_partitions(ridership.refine_hourly(raw), table, schemas.HOURLY, "use_month")


def load_weather(
    spark: SparkSession, landing: str, instant: dt.datetime, table: str = "weather"
) -> int:
    utc = instant.astimezone(dt.timezone.utc) if instant.tzinfo else instant
    items = landed.forecast_items(spark, landing, utc)
    refined = weather.refine_weather(weather.district_items(items, district_grid(spark)))
    return replace_table(refined, table, schemas.WEATHER)


def predict_hours(
    spark: SparkSession,
    instant: dt.datetime,
    table: str = "subway_predict",
    last_month: str = "subway_data_prev_month",
    daily: str = "subway_data_daily",
    last_year: str = "subway_data_prev_year",
    **model_options,
) -> tuple[int, float | None]:
    """(rows, held-out score) of the hourly forecast of the batch date."""
    predicted, r2 = forecast.forecast_hours(
        read_table(spark, last_month),
        read_table(spark, daily),
        read_table(spark, last_year),
        city_batch(instant).date(),
        **model_options,
    )
    return replace_table(predicted, table, schemas.PREDICTION), r2


def draft_events(
    spark: SparkSession,
    landing: str,
    pages: str,
    instant: dt.datetime,
    table: str = "event",
    rejected: str | None = None,
    most_rejected: float = 0.01,
) -> int:
    """First event job: drafts, page texts and the requests for the summary service.

    ``pages`` is the table of fetched documents (url, html). A full load while ``table``
    is missing, else an incremental one: decided once per batch time and kept with the draft,
    so the batch may be drafted and published again after it has filled ``table``.
    With ``rejected``, events with dates that are none go to that side table, see ``load_daily``.
    """
    batch = city_batch(instant)
    known = _draft_batch(spark, table)
    mode = known[0] if known and known[1] == batch.isoformat() else load_mode(spark, table)
    if rejected:
        raw = accepted_events(spark, landing, batch.date(), rejected, most_rejected)
    else:
        raw = landed.event_rows(spark, landing, batch.date())
    fetched = read_table(spark, pages)
    _, drafts, texts = events.prepare_load(spark, raw, fetched, batch.date(), table, mode=mode)
    replace_table(drafts, f"{table}_draft", schemas.EVENT)
    replace_table(texts, f"{table}_text", schemas.EVENT_TEXT)
    rows = replace_table(events.summary_requests(texts), f"{table}_request", schemas.EVENT_REQUEST)
    spark.sql(
        f"ALTER TABLE {table}_draft SET TBLPROPERTIES ('{MODE}' = '{mode}', '{BATCH}' = '{batch.isoformat()}')"
    )
    return rows


def accepted_events(
    spark: SparkSession, landing: str, day: dt.date, rejected: str, most_rejected: float
) -> DataFrame:
    """Good events of a day's collection; the others replace what the side table holds of that day."""
    rules = {f"bad_{c}": quarantine.not_a_date(F.col(c)) for c in ("STRTDATE", "END_DATE")}
    folder = day.strftime("%Y%m%d")
    split = quarantine.read_split(spark, landing, landed.EVENTS, schemas.EVENT_ROW, "ymd", [folder], rules)
    replace_covered(split.rejected, rejected, schemas.REJECTED, "folder", [folder])
    return split.require(most_rejected).good


def _draft_batch(spark, table):
    """(mode, batch time) of the finished draft, None if there is none."""
    if not spark.catalog.tableExists(f"{table}_draft"):
        return None
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}_draft").collect()}
    return (found[MODE], found[BATCH]) if MODE in found else None


def publish_events(
    spark: SparkSession,
    responses: str,
    instant: dt.datetime,
    table: str = "event",
    ledger: str = "batch_status",
) -> int:
    """Second event job: answers (event_id, answer) go into the drafts.

    A full load fills ``table``; an incremental one the sync table and the ledger. Mode and
    batch time are those of the draft, whatever tables there are by now; a draft of another
    batch time, or one that did not finish, is an error.
    """
    draft = _draft_batch(spark, table)
    if draft is None or draft[1] != city_batch(instant).isoformat():
        raise LookupError(f"{table}_draft is not the finished draft of {city_batch(instant)}")
    final = events.apply_summaries(
        read_table(spark, f"{table}_draft"),
        read_table(spark, f"{table}_text"),
        read_table(spark, responses),
    )
    if draft[0] == FULL:
        rows = replace_table(final, table, schemas.EVENT)
        replace_key_index(spark, table, "homepage")  # for the incremental loads that follow
        return rows
    rows = replace_table(final, f"{table}_sync", schemas.EVENT)
    append_ledger(spark, ledger, city_batch(instant))
    return rows
