"""Cultural events: refine, full and incremental load, descriptions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline import schemas
from tramline.functions import markup, text
from tramline.functions.dates import strict_date
from tramline.functions.numbers import to_number
from tramline.operators.dedup import keep_first
from tramline.operators.filters import still_running, without_value
from tramline.operators.ids import assign_ids
from tramline.operators.joins import keyed_update, new_rows, with_default_lookup
from tramline.operators.key_index import KeyIndex, new_rows_indexed
from tramline.operators.skew import spread_join
from tramline.session import stage
from tramline.sinks.tables import read_key_index
from tramline.sources.tables import FULL, INCREMENTAL, load_mode, read_table

# Landed column → table column. The feed publishes LAT and LOT exchanged.
EVENT_COLUMNS = {
    "TITLE": "title",
    "CODENAME": "category_name",
    "GUNAME": "gu",
    "PLACE": "location",
    "STRTDATE": "start_date",
    "END_DATE": "end_date",
    "USE_FEE": "fee",
    "IS_FREE": "is_free",
    "LAT": "longitude",
    "LOT": "latitude",
    "HMPG_ADDR": "homepage",
    "MAIN_IMG": "image_url",
    "ORG_LINK": "detail_url",
    "USE_TRGT": "target_user",
    "ALT": "event_description",
}
CONTENT_CLASS = "culture-content"
IMAGE_CLASS = "img-box"


def describe_events(events: DataFrame, pages: DataFrame) -> DataFrame:
    """Landed events with ``ALT``, the better image caption of their page.

    ``pages`` holds fetched documents (url, html). A url fetched twice counts once. Pages are
    narrowed to the events' homepages before any is parsed.
    """
    wanted = stage(events.select("HMPG_ADDR").where("HMPG_ADDR IS NOT NULL").distinct(), "homepages")
    fetched = pages.withColumnRenamed("url", "HMPG_ADDR")
    found = spread_join(fetched, wanted, ["HMPG_ADDR"], "left_semi").select(
        "HMPG_ADDR",
        markup.first_captions(F.col("html"), [CONTENT_CLASS, IMAGE_CLASS]).alias("found"),
    )
    alt = text.pick_description(F.get("found", F.lit(0)), F.get("found", F.lit(1)))
    captions = found.select("HMPG_ADDR", alt.alias("ALT"))
    # Staged: pages are parsed once, and wide events move only if captions are too many to
    # broadcast.
    captions = stage(keep_first(captions, ["HMPG_ADDR"], ["ALT"]), "captions")
    return with_default_lookup(events, captions, "HMPG_ADDR", "ALT", text.NO_INFORMATION)


def refine_events(
    raw: DataFrame, batch_date: dt.date, mode: str = FULL, order: Sequence[str] = ()
) -> DataFrame:
    """Typed event rows with ids; an incremental run numbers running events only.

    ``order`` fixes the numbering; by default the homepage and then all other columns.
    """
    events = raw.withColumns(
        {
            "IS_FREE": text.free_flag(F.col("IS_FREE")),
            "STRTDATE": strict_date(F.col("STRTDATE")),
            "END_DATE": strict_date(F.col("END_DATE")),
            "CODENAME": text.collapse_category(F.col("CODENAME")),
            "LAT": to_number(F.col("LAT")),
            "LOT": to_number(F.col("LOT")),
        }
    )
    if mode == INCREMENTAL:
        events = still_running(events, "END_DATE", batch_date)
    rest = [c for c in EVENT_COLUMNS if c != "HMPG_ADDR"]
    numbered = assign_ids(events, order or ["HMPG_ADDR", *rest], "event_id")
    return schemas.conform(numbered.withColumnsRenamed(EVENT_COLUMNS), schemas.EVENT)


def full_load_candidates(events: DataFrame, batch_date: dt.date) -> DataFrame:
    """Running events with a description, null included: (event_id, homepage)."""
    running = still_running(events, "end_date", batch_date)
    described = without_value(running, "event_description", text.NO_INFORMATION)
    return described.select("event_id", "homepage")


def incremental_candidates(events: DataFrame, baseline: DataFrame, index: KeyIndex | None = None) -> DataFrame:
    """Events whose homepage the baseline table lacks: (event_id, homepage).

    With an index of the baseline's homepages, events that it surely lacks are not shuffled.
    """
    events = events.select("event_id", "homepage")
    if index:
        return new_rows_indexed(events, baseline, "homepage", index)
    return new_rows(events, baseline, "homepage")


def page_texts(candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """(event_id, text) for candidates with a fetched page.

    Pages are narrowed to the wanted urls before any page is parsed. The candidates are
    staged for that: found once, and few of them are broadcast in place of moving pages.
    """
    candidates = stage(candidates, "candidates")
    wanted = candidates.select("homepage").distinct()
    fetched = pages.withColumnRenamed("url", "homepage")
    found = spread_join(fetched, wanted, ["homepage"], "left_semi").select(
        "homepage", markup.section_text(F.col("html"), css_class=CONTENT_CLASS).alias("text")
    )
    found = keep_first(found, ["homepage"], ["text"])
    return spread_join(candidates, found, ["homepage"]).select("event_id", "text")


def summary_requests(texts: DataFrame) -> DataFrame:
    """(event_id, role, prompt): what an outside summary service is to be asked."""
    return texts.select(
        "event_id",
        F.lit(text.REQUEST_ROLE).alias("role"),
        text.request_text(F.col("text")).alias("prompt"),
    )


def apply_summaries(events: DataFrame, texts: DataFrame, responses: DataFrame) -> DataFrame:
    """Descriptions from the responses (event_id, answer).

    A request without answer leaves the page text, an event without page text its own
    description. An event answered twice gets the answer that sorts first.
    """
    given = responses.select("event_id", "answer").where(F.col("answer").isNotNull())
    answers = keep_first(given, ["event_id"], ["answer"])
    answered = spread_join(texts, answers, ["event_id"], "left")
    updates = answered.select("event_id", F.coalesce("answer", "text").alias("summary"))
    updates = stage(updates, "summaries")  # of known size, see describe_events
    return keyed_update(events, updates, "event_id", "event_description", "summary")


def prepare_load(
    spark: SparkSession,
    raw: DataFrame,
    pages: DataFrame,
    batch_date: dt.date,
    table: str = "event",
    schema: str | None = None,
    mode: str | None = None,
) -> tuple[str, DataFrame, DataFrame]:
    """(mode, events, texts of the pages to summarise), both frames staged.

    Without ``mode`` the state of ``table`` decides. The texts go out as ``summary_requests``; the answers come back to ``apply_summaries``.
    """
    mode = mode or load_mode(spark, table, schema)
    events = refine_events(describe_events(raw, pages), batch_date, mode)
    if mode == FULL:
        candidates = full_load_candidates(events, batch_date)
    else:
        name = f"{schema}.{table}" if schema else table
        index = read_key_index(spark, name, "homepage")
        candidates = incremental_candidates(events, read_table(spark, table, schema), index)
    return mode, events, stage(page_texts(candidates, pages), "texts")
