"""Not-modified revisits of web captures, resolved to the full response they stand for.

A server that answers 304 sends no body. The capture's content is that of the latest earlier full
response of the same canonical URL, if the validators agree: an as-of join. The stored headers then
take over those that a 304 may update.

The as-of join sorts captures over the cluster by (URL, time), so that a URL with a third of all
captures spans many sorted parts. Inside a part a window carries the last response forward; the last
response of each (URL, part) is carried over the parts, one row each. All with DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tramline.session import stage

# Header fields that a 304 response updates (RFC 9110, 15.4.5), with the modification date.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
# Query parameters that do not change what a URL shows.
TRACKING = r"^(utm_[a-z]*|ref|fbclid|gclid|sessionid)(=.*)?$"


def canonical_url(url: Column) -> Column:
    """Host and path of a URL with its remaining parameters in order; null for what is no URL.

    Scheme, fragment, "www.", default ports, tracking parameters and a trailing slash go; the host
    is lower-cased.
    """
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)([^?#]*)(\?[^#]*)?(#.*)?$"
    host = F.regexp_replace(F.lower(F.regexp_extract(url, pattern, 1)), r"^www[0-9]*\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(url, pattern, 2), "/+$", "")
    query = F.split(F.substring(F.regexp_extract(url, pattern, 3), 2, 1 << 30), "&")
    query = F.array_join(F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.when(url.rlike(pattern), F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def lower_headers(headers: Column) -> Column:
    """Header names in lower case; of names that differ in case alone the first one stays."""
    names = F.transform(F.map_keys(headers), F.lower)
    entries = F.arrays_zip(names.alias("k"), F.map_values(headers).alias("v"))
    first = F.filter(entries, lambda e, i: F.array_position(names, e["k"]) == i + 1)
    return F.coalesce(F.map_from_entries(first), F.create_map().cast("map<string,string>"))


def _strong(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), "^W/", "")


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """(record_id, canonical_url, captured_at, outcome, response_id, headers) of every revisit.

    ``captures`` has record_id, url, captured_at (any sortable type), warc_type ("response" or
    "revisit"), status and headers (a map). A full response has status 200. The latest one with an
    earlier time is taken (of equal times the larger record_id). ``outcome``:

    * "resolved": each validator (ETag, compared weakly, and Last-Modified) that both have agrees,
      and there is one; response_id is set and headers are merged
    * "validator_mismatch": one that both have differs
    * "no_validator": they have none in common
    * "no_earlier_response"
    * "no_url": the URL is null or none, or the time is null

    Unresolved revisits keep their own headers and a null response_id. Null headers are empty. Every
    one of equal rows gets a result; other columns are not read; no rows give no rows.
    """
    rows = captures.select(
        "record_id",
        canonical_url(F.col("url")).alias("canonical_url"),
        "captured_at",
        (F.col("warc_type") == "revisit").alias("revisit"),
        lower_headers(F.col("headers")).alias("headers"),
        "warc_type",
        "status",
    ).where("warc_type = 'revisit' OR (warc_type = 'response' AND status = 200)")
    rows = rows.withColumn("rank", F.when(F.col("revisit"), 0).otherwise(1)).drop("warc_type", "status")
    placed = F.col("canonical_url").isNotNull() & F.col("captured_at").isNotNull()
    order = ["captured_at", "rank", "record_id"]
    parts = rows.where(placed).repartitionByRange("canonical_url", *order)
    parts = stage(parts.withColumn("part", F.spark_partition_id()), "captures")

    response = F.struct("record_id", "headers")
    full = F.when(~F.col("revisit"), response)
    inside = Window.partitionBy("canonical_url", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("canonical_url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    lasts = parts.where("NOT revisit").groupBy("canonical_url", "part")
    lasts = lasts.agg(F.max_by(response, F.struct(*order)).alias("last"))
    every = parts.select("canonical_url", "part").distinct().join(lasts, ["canonical_url", "part"], "left")
    carried = every.select("canonical_url", "part", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    carried = stage(carried.where("carried IS NOT NULL"), "carried")
    found = parts.withColumn("base", F.last(full, ignorenulls=True).over(inside)).where("revisit")
    found = found.join(carried, ["canonical_url", "part"], "left").withColumn("base", F.coalesce("base", "carried"))

    def both(name: str, shape=lambda c: c) -> tuple[Column, Column]:
        mine, theirs = shape(F.col("headers")[name]), shape(F.col("base.headers")[name])
        return mine.isNotNull() & theirs.isNotNull(), mine == theirs

    (tags, same_tag), (dates, same_date) = both("etag", _strong), both("last-modified", F.trim)
    outcome = (
        F.when(F.col("base").isNull(), "no_earlier_response")
        .when((tags & ~same_tag) | (dates & ~same_date), "validator_mismatch")
        .when(tags | dates, "resolved")
        .otherwise("no_validator")
    )
    update = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED))
    kept = F.map_filter(F.col("base.headers"), lambda k, v: ~F.map_contains_key(update, k))
    resolved = F.col("outcome") == "resolved"
    result = found.withColumn("outcome", outcome).select(
        "record_id",
        "canonical_url",
        "captured_at",
        "outcome",
        F.when(resolved, F.col("base.record_id")).alias("response_id"),
        F.when(resolved, F.map_concat(kept, update)).otherwise(F.col("headers")).alias("headers"),
    )
    lost = rows.where(F.col("revisit") & ~placed).select(
        "record_id", "canonical_url", "captured_at", F.lit("no_url").alias("outcome"),
        F.lit(None).cast(dict(rows.dtypes)["record_id"]).alias("response_id"), "headers",
    )
    return result.unionByName(lost)


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures derived from crawled pages (page_id, url, html): a full response and a later revisit each.

    Every fifth response has no ETag, every seventh revisit another one, and every eleventh revisit
    precedes its response.
    """
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit("")).cast("binary")), F.lit('"'))
    at = F.col("page_id") * 60
    changed = F.date_format(F.timestamp_seconds(at - 86400), "yyyy-MM-dd HH:mm:ss")

    def headers(*pairs: tuple[str, Column]) -> Column:
        entries = F.array(*(F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in pairs))
        return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))

    response = headers(
        ("Content-Type", F.lit("text/html")),
        ("Content-Length", F.octet_length(F.coalesce("html", F.lit("")))),
        ("ETag", F.when(F.col("page_id") % 5 != 0, tag)),
        ("Last-Modified", changed),
        ("Cache-Control", F.lit("max-age=3600")),
    )
    again = F.when(F.col("page_id") % 11 == 0, at - 30).otherwise(at + 30 + F.col("page_id") * 37 % 1000)
    revisit = headers(
        ("ETAG", F.when(F.col("page_id") % 7 == 0, F.lit('"changed"')).otherwise(F.concat(F.lit("W/"), tag))),
        ("Cache-Control", F.lit("no-cache")),
        ("Content-Length", F.lit("0")),
        ("Last-Modified", F.when(F.col("page_id") % 3 == 0, changed)),
    )
    schema = "record_id", "url", "captured_at", "warc_type", "status", "headers"
    first = pages.select(F.col("page_id") * 2, "url", at, F.lit("response"), F.lit(200), response).toDF(*schema)
    second = pages.select(F.col("page_id") * 2 + 1, "url", again, F.lit("revisit"), F.lit(304), revisit).toDF(*schema)
    return first.unionByName(second)


SQL = r"""
WITH urls AS (
  SELECT page_id, url, coalesce(html, '') AS html,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)([^?#]*)(\?[^#]*)?(#.*)?$', ['host', 'path', 'query', 'rest']) AS u,
         regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)([^?#]*)(\?[^#]*)?(#.*)?$') AS is_url
  FROM pages),
parts AS (
  SELECT page_id, html, is_url, regexp_replace(lower(u.host), '^www[0-9]*\.|:(80|443)$', '', 'g')
             || regexp_replace(u.path, '/+$', '') AS base,
         array_to_string(list_sort(list_filter(string_split(substr(u.query, 2), '&'),
             lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]*|ref|fbclid|gclid|sessionid)(=.*)?$'))), '&') AS query
  FROM urls),
canon AS (
  SELECT page_id, html, CASE WHEN is_url THEN base || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS canonical_url,
         '"' || md5(html) || '"' AS tag, page_id * 60 AS seen,
         strftime(to_timestamp(page_id * 60 - 86400) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS changed
  FROM parts),
responses AS (
  SELECT page_id * 2 AS record_id, canonical_url, seen AS captured_at, CASE WHEN page_id % 5 <> 0 THEN tag END AS etag, changed,
         strlen(html) AS content_length
  FROM canon WHERE canonical_url IS NOT NULL),
revisits AS (
  SELECT page_id * 2 + 1 AS record_id, canonical_url,
         CASE WHEN page_id % 11 = 0 THEN seen - 30 ELSE seen + 30 + page_id * 37 % 1000 END AS captured_at,
         CASE WHEN page_id % 7 = 0 THEN '"changed"' ELSE 'W/' || tag END AS etag,
         CASE WHEN page_id % 3 = 0 THEN changed END AS changed
  FROM canon),
matched AS (
  SELECT v.record_id, v.canonical_url, v.captured_at, v.etag, v.changed, r.record_id AS response_id, r.etag AS base_etag,
         r.changed AS base_changed, r.content_length,
         row_number() OVER (PARTITION BY v.record_id ORDER BY r.captured_at DESC NULLS LAST, r.record_id DESC NULLS LAST) AS n
  FROM revisits v LEFT JOIN responses r ON v.canonical_url = r.canonical_url AND r.captured_at < v.captured_at),
judged AS (
  SELECT *, CASE WHEN canonical_url IS NULL THEN 'no_url'
                 WHEN response_id IS NULL THEN 'no_earlier_response'
                 WHEN (base_etag IS NOT NULL AND regexp_replace(etag, '^W/', '') <> base_etag)
                      OR (changed IS NOT NULL AND changed <> base_changed) THEN 'validator_mismatch'
                 WHEN base_etag IS NOT NULL OR changed IS NOT NULL THEN 'resolved'
                 ELSE 'no_validator' END AS outcome
  FROM matched WHERE n = 1)
SELECT record_id, canonical_url, CAST(captured_at AS BIGINT) AS captured_at, outcome,
       CASE WHEN outcome = 'resolved' THEN response_id END AS response_id,
       etag, 'no-cache' AS cache_control,
       CASE WHEN outcome = 'resolved' THEN CAST(content_length AS VARCHAR) ELSE '0' END AS content_length,
       CASE WHEN outcome = 'resolved' THEN 'text/html' END AS content_type,
       CASE WHEN outcome = 'resolved' THEN coalesce(changed, base_changed) ELSE changed END AS last_modified
FROM judged
"""
