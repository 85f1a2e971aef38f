"""Cultural events: refine, candidates, descriptions and page texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.functions import markup, text
from tramline.functions.numbers import to_number
from tramline.operators import aggregates
from tramline.operators.dedup import keep_first
from tramline.operators.filters import still_running, without_value
from tramline.operators.joins import with_default_lookup
from tramline.plans import events
from tramline.sources.tables import FULL, INCREMENTAL
from tramline.workloads.tables import BATCH_DATE, table

QUERIES = {}
SQL = {}

SITE = "https://events.example/"


def landed_events(spark, sf_dir):
    """Orders in the shape of landed events, with bad, blank and missing values."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    day = "yyyy-MM-dd 00:00:00.0"
    end = F.date_format(F.date_add("o_orderdate", 30), day)
    home = F.concat(F.lit(SITE), F.col("o_orderkey"))
    columns = {
        "TITLE": F.concat(F.lit("order "), F.col("o_orderkey")),
        "CODENAME": F.when(priority == "1-URGENT", "전통 축제").when(priority != "5-LOW", priority),
        "GUNAME": status,
        "PLACE": F.concat(F.lit("customer "), F.col("o_custkey")),
        "STRTDATE": F.date_format("o_orderdate", day),
        "END_DATE": F.when((priority != "2-HIGH") | (status != "P"), end),
        "USE_FEE": F.round(F.col("o_totalprice") * 100).cast("long").cast("string"),
        "IS_FREE": F.when(status == "F", "유료").when(status == "O", "무료").otherwise("기타"),
        "LAT": F.when(status == "F", "x").otherwise(F.concat(F.lit(" "), F.col("o_custkey"), F.lit(" "))),
        "LOT": F.when(priority == "5-LOW", "").otherwise(F.concat(F.col("o_custkey"), F.lit(".5"))),
        "HMPG_ADDR": home,
        "MAIN_IMG": F.concat(home, F.lit("/image")),
        "ORG_LINK": home,
        "USE_TRGT": F.lit("all"),
        "ALT": F.when(priority == "4-NOT SPECIFIED", text.NO_INFORMATION).when(
            priority != "5-LOW", F.concat(F.lit("about "), F.col("o_orderkey"))
        ),
    }
    return table(spark, sf_dir, "orders").select(*[c.alias(n) for n, c in columns.items()])


def refined(spark, sf_dir, mode):
    return events.refine_events(landed_events(spark, sf_dir), BATCH_DATE, mode, ["HMPG_ADDR"])


REFINED_SQL = f"""
raw AS (
  SELECT '{SITE}' || o_orderkey AS homepage, *,
         CASE WHEN NOT (o_orderpriority = '2-HIGH' AND o_orderstatus = 'P')
              THEN CAST(o_orderdate + INTERVAL 30 DAY AS DATE) END AS end_date
  FROM orders),
refined AS (
  SELECT 'order ' || o_orderkey AS title,
         CASE o_orderpriority WHEN '1-URGENT' THEN '축제' WHEN '5-LOW' THEN NULL
              ELSE o_orderpriority END AS category_name,
         o_orderstatus AS gu, 'customer ' || o_custkey AS location,
         CAST(o_orderdate AS DATE) AS start_date, end_date,
         CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS fee,
         CASE o_orderstatus WHEN 'F' THEN false WHEN 'O' THEN true END AS is_free,
         CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS DOUBLE) END AS longitude,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey + CAST(0.5 AS DOUBLE) END AS latitude,
         homepage, homepage || '/image' AS image_url, homepage AS detail_url,
         'all' AS target_user,
         CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN '정보없음' WHEN '5-LOW' THEN NULL
              ELSE 'about ' || o_orderkey END AS event_description
  FROM raw)
"""
RUNNING = f"end_date >= DATE '{BATCH_DATE}'"

QUERIES["event_refine"] = lambda spark, sf_dir: refined(spark, sf_dir, FULL)
SQL["event_refine"] = f"""
WITH {REFINED_SQL} SELECT row_number() OVER (ORDER BY homepage) AS event_id, * FROM refined
"""

QUERIES["event_refine_sync"] = lambda spark, sf_dir: refined(spark, sf_dir, INCREMENTAL)
SQL["event_refine_sync"] = f"""
WITH {REFINED_SQL}
SELECT row_number() OVER (ORDER BY homepage) AS event_id, * FROM refined WHERE {RUNNING}
"""

QUERIES["full_load_candidates"] = lambda spark, sf_dir: events.full_load_candidates(
    refined(spark, sf_dir, FULL), BATCH_DATE
)
SQL["full_load_candidates"] = f"""
WITH {REFINED_SQL},
numbered AS (SELECT row_number() OVER (ORDER BY homepage) AS event_id, * FROM refined)
SELECT event_id, homepage FROM numbered
WHERE {RUNNING} AND event_description IS DISTINCT FROM '정보없음'
"""


def known_homepages(spark, sf_dir):
    """The baseline table of an incremental load: orders that have lines."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit(SITE), F.col("l_orderkey")).alias("homepage")
    )


def incremental_candidates(spark, sf_dir):
    drafts = refined(spark, sf_dir, INCREMENTAL)
    return events.incremental_candidates(drafts, known_homepages(spark, sf_dir))


QUERIES["incremental_candidates"] = incremental_candidates
SQL["incremental_candidates"] = f"""
WITH {REFINED_SQL},
numbered AS (
  SELECT row_number() OVER (ORDER BY homepage) AS event_id, * FROM refined WHERE {RUNNING})
SELECT event_id, homepage FROM numbered
WHERE homepage NOT IN (SELECT '{SITE}' || l_orderkey FROM lineitem)
"""

QUERIES["active_filter"] = lambda spark, sf_dir: still_running(
    table(spark, sf_dir, "orders"), "o_orderdate", BATCH_DATE
)
SQL["active_filter"] = f"SELECT * FROM orders WHERE o_orderdate >= DATE '{BATCH_DATE}'"


def sentinel_filter_nullsafe(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority")
    )
    return without_value(orders, "priority", "4-NOT SPECIFIED")


QUERIES["sentinel_filter_nullsafe"] = sentinel_filter_nullsafe
SQL["sentinel_filter_nullsafe"] = """
SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority FROM orders
WHERE nullif(o_orderpriority, '5-LOW') IS DISTINCT FROM '4-NOT SPECIFIED'
"""


TITLE = r"<title>([^<]*)</title>"
AD = r'<div class="ad">([^<]*)</div>'


def section(html, pattern):
    return F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))


def page_alts(spark, sf_dir):
    """Pages with two competing descriptions: the title and the advertisement."""
    html = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        section(html, TITLE).alias("title"),
        section(html, AD).alias("ad"),
    )


ALTS_SQL = f"""
alts AS (
  SELECT page_id, nullif(regexp_extract(html, '{TITLE}', 1), '') AS title,
         nullif(regexp_extract(html, '{AD}', 1), '') AS ad
  FROM pages),
lengths AS (
  SELECT *, coalesce(length(trim(title)), 0) AS n1, coalesce(length(trim(ad)), 0) AS n2 FROM alts),
picked AS (
  SELECT page_id, CASE WHEN greatest(n1, n2) = 0 THEN '정보없음' WHEN n1 >= n2 THEN title
                       ELSE ad END AS description
  FROM lengths)
"""

QUERIES["alt_pick"] = lambda spark, sf_dir: page_alts(spark, sf_dir).select(
    "page_id", text.pick_description(F.col("title"), F.col("ad")).alias("description")
)
SQL["alt_pick"] = f"WITH {ALTS_SQL} SELECT page_id, description FROM picked"


def described_documents(spark, sf_dir):
    """Documents described by the page of the same number; many have no page."""
    alts = page_alts(spark, sf_dir).select(
        F.col("page_id").alias("doc_id"),
        text.pick_description(F.col("title"), F.col("ad")).alias("description"),
    )
    alts = keep_first(alts, ["doc_id"], ["description"])
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return with_default_lookup(documents, alts, "doc_id", "description", text.NO_INFORMATION)


ENRICHED_SQL = f"""
{ALTS_SQL},
enriched AS (
  SELECT doc_id, lang, source, coalesce(description, '정보없음') AS description
  FROM documents LEFT JOIN picked ON doc_id = page_id)
"""

QUERIES["page_enrich"] = described_documents
SQL["page_enrich"] = f"WITH {ENRICHED_SQL} SELECT * FROM enriched"


def undescribed(spark, sf_dir):
    """Rows left without a description, per source."""
    missing = F.col("description") == text.NO_INFORMATION
    return described_documents(spark, sf_dir).groupBy("source").agg(
        aggregates.count_where(missing).alias("undescribed"), F.count("*").alias("rows")
    )


QUERIES["page_enrich_missing"] = undescribed
SQL["page_enrich_missing"] = f"""
WITH {ENRICHED_SQL}
SELECT source, count(*) FILTER (description = '정보없음') AS undescribed, count(*) AS rows
FROM enriched GROUP BY source
"""

QUERIES["page_text_extract"] = lambda spark, sf_dir: table(spark, sf_dir, "pages").select(
    "page_id",
    markup.section_text(F.col("html"), "nav", None, text_tag="a", attribute="href").alias("text"),
)
SQL["page_text_extract"] = """
WITH nav AS (
  SELECT page_id, regexp_extract(html, '<nav>(.*?)</nav>', 1, 's') AS part FROM pages)
SELECT page_id,
       replace(replace(
         array_to_string(regexp_extract_all(part, '<a href="[^"]*">([^<]*)</a>', 1), '')
         || array_to_string(regexp_extract_all(part, '<a href="([^"]*)">', 1), ''),
         '&quot;', '"'), '&amp;', '&') AS text
FROM nav
"""


def request_batch(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("event_id"), "text")
    return events.summary_requests(texts)


_before, _after = (part.replace("'", "''") for part in text.REQUEST_TEMPLATE.split("{text}"))
QUERIES["request_batch"] = request_batch
SQL["request_batch"] = f"""
SELECT doc_id AS event_id, '{text.REQUEST_ROLE}' AS role,
       '{_before}' || text || '{_after}' AS prompt
FROM documents
"""


def apply_summaries(spark, sf_dir):
    """Texts for documents with a page, answers for labelled ones, over all documents."""
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("event_id"), F.col("source").alias("event_description")
    )
    texts = page_alts(spark, sf_dir).select(F.col("page_id").alias("event_id"), F.col("title").alias("text"))
    answers = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("event_id"), F.concat(F.lit("quality "), "quality").alias("answer")
    )
    return events.apply_summaries(documents, texts, answers)


QUERIES["apply_summaries"] = apply_summaries
SQL["apply_summaries"] = f"""
WITH {ALTS_SQL},
updates AS (
  SELECT page_id, coalesce('quality ' || quality, title) AS summary
  FROM alts LEFT JOIN labels ON page_id = doc_id)
SELECT doc_id AS event_id,
       CASE WHEN page_id IS NOT NULL THEN summary ELSE source END AS event_description
FROM documents LEFT JOIN updates ON doc_id = page_id
"""


def fetched_pages(spark, sf_dir):
    """Pages as the documents of the first orders' homepages.

    The advertisement becomes the image caption, the title the text of the content section;
    what the page held comes after.
    """
    caption = F.translate(F.coalesce("ad", F.lit("")), '"', "")
    head = F.concat(
        F.lit('<div class="img-box"><img alt="'), caption, F.lit('"></div>'),
        F.lit('<div class="culture-content"><div><span>'), F.coalesce("title", F.lit("")),
        F.lit("</span></div></div>"),
    )
    pages = table(spark, sf_dir, "pages")
    alts = [section(F.col("html"), TITLE).alias("title"), section(F.col("html"), AD).alias("ad")]
    return pages.select("page_id", "html", *alts).select(
        F.concat(F.lit(SITE), "page_id").alias("url"), F.concat(head, "html").alias("html")
    )


def event_load(mode):
    """The whole event load of one mode, with labels as answers to the requests."""

    def load(spark, sf_dir):
        pages = fetched_pages(spark, sf_dir)
        raw = events.describe_events(landed_events(spark, sf_dir).drop("ALT"), pages)
        drafts = events.refine_events(raw, BATCH_DATE, mode, ["HMPG_ADDR"])
        if mode == FULL:
            candidates = events.full_load_candidates(drafts, BATCH_DATE)
        else:
            candidates = events.incremental_candidates(drafts, known_homepages(spark, sf_dir))
        texts = events.page_texts(candidates, pages)
        answers = table(spark, sf_dir, "labels").select(
            F.col("doc_id").alias("event_id"), F.concat(F.lit("quality "), "quality").alias("answer")
        )
        return events.apply_summaries(drafts, texts, answers)

    return load


def unescaped(column):
    """SQL for text with the entities that occur in the pages resolved."""
    for entity, plain in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        column = f"replace({column}, '{entity}', '{plain}')"
    return column


def event_load_sql(numbered, candidate):
    return f"""
WITH {REFINED_SQL}, {ALTS_SQL},
fetched AS (
  SELECT '{SITE}' || page_id AS homepage,
         {unescaped("replace(coalesce(ad, ''), '\"', '')")} AS caption,
         {unescaped("coalesce(title, '')")} AS title_text
  FROM alts),
described AS (
  SELECT refined.* EXCLUDE (event_description), title_text,
         CASE WHEN length(trim(caption)) > 0 THEN caption ELSE '정보없음' END AS event_description
  FROM refined LEFT JOIN fetched USING (homepage)),
numbered AS (
  SELECT row_number() OVER (ORDER BY homepage) AS event_id, * FROM described WHERE {numbered}),
chosen AS (
  SELECT event_id, title_text FROM numbered WHERE title_text IS NOT NULL AND {candidate})
SELECT n.* EXCLUDE (title_text) REPLACE (
    CASE WHEN c.event_id IS NULL THEN event_description
         ELSE coalesce('quality ' || quality, c.title_text) END AS event_description)
FROM numbered n LEFT JOIN chosen c USING (event_id) LEFT JOIN labels ON doc_id = n.event_id
"""


QUERIES["event_full_load"] = event_load(FULL)
SQL["event_full_load"] = event_load_sql("true", f"{RUNNING} AND event_description <> '정보없음'")

QUERIES["event_incremental_load"] = event_load(INCREMENTAL)
SQL["event_incremental_load"] = event_load_sql(
    RUNNING, f"homepage NOT IN (SELECT '{SITE}' || l_orderkey FROM lineitem)"
)


def name_normalize(spark, sf_dir):
    """Part names as station names: marked, with a note, or plain, by part type."""
    kind = F.col("p_type")
    note = F.concat(F.lit("  ("), F.col("p_brand"), F.lit(") ("), kind, F.lit(")"))
    raw = F.when(kind == "PROMO", F.concat("p_name", F.lit("역"), note)).when(
        kind == "ECONOMY", F.concat("p_name", note)
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.station_name(F.coalesce(raw, "p_name")).alias("name")
    )


QUERIES["name_normalize"] = name_normalize
SQL["name_normalize"] = """
WITH raw AS (
  SELECT p_partkey, CASE p_type
      WHEN 'PROMO' THEN p_name || '역  (' || p_brand || ') (' || p_type || ')'
      WHEN 'ECONOMY' THEN p_name || '  (' || p_brand || ') (' || p_type || ')'
      ELSE p_name END AS name
  FROM part),
bare AS (SELECT p_partkey, regexp_replace(name, '\\s*\\(.*\\)', '', 'g') AS name FROM raw)
SELECT p_partkey, CASE WHEN ends_with(name, '역') THEN name ELSE name || '역' END AS name FROM bare
"""


def numeric_coerce(spark, sf_dir):
    kind = F.col("p_type")
    size = F.col("p_size").cast("string")
    mixed = (
        F.when(kind == "PROMO", F.col("p_name"))
        .when(kind == "ECONOMY", F.concat(F.lit(" "), size, F.lit(" ")))
        .when(kind == "LARGE", F.concat(size, F.lit("e2")))
        .when(kind == "SMALL", F.lit(""))
        .when(kind == "MEDIUM", F.concat(size, F.lit("d")))
        .otherwise(F.concat(F.lit("-"), size, F.lit(".25")))
    )
    return table(spark, sf_dir, "part").select("p_partkey", to_number(mixed).alias("number"))


QUERIES["numeric_coerce"] = numeric_coerce
SQL["numeric_coerce"] = """
SELECT p_partkey, TRY_CAST(CASE p_type
    WHEN 'PROMO' THEN p_name WHEN 'ECONOMY' THEN ' ' || p_size || ' '
    WHEN 'LARGE' THEN p_size || 'e2' WHEN 'SMALL' THEN '' WHEN 'MEDIUM' THEN p_size || 'd'
    ELSE '-' || p_size || '.25' END AS DOUBLE) AS number
FROM part
"""
