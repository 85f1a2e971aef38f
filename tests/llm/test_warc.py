import random

import pytest
from compare import connect, differences

from tramline.llm import warc
from tramline.llm.queries import QUERIES, SQL
from pyspark.sql import functions as F


def test_query_equals_sql(spark, sf_dir):
    df = QUERIES["op6_warc_revisits"](spark, sf_dir)
    assert differences(df, connect(sf_dir), SQL["op6_warc_revisits"]) is None
    outcomes = {r.outcome for r in df.collect()}
    assert {"resolved", "validator_mismatch", "no_earlier_response", "no_validator"} <= outcomes


@pytest.mark.parametrize("url,want", [
    ("HTTP://WWW.Example.COM:80/a/b/?utm_source=x&b=2&a=1#top", "example.com/a/b?a=1&b=2"),
    ("https://m.x.org", "m.x.org"), ("https://x.org/", "x.org"), ("https://x.org:8080/p?ref=y", "x.org:8080/p"),
    ("not a url", None), ("", None), (None, None), ("ftp://www2.h/%20?a&&b", "h/%20?a&b"),
])
def test_canonical_url(spark, url, want):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(warc.canonical_url(F.col("u"))).first()[0] == want


SCHEMA = "record_id long, url string, captured_at long, warc_type string, status int, headers map<string,string>"


def brute(rows):
    out = {}
    for i, url, at, kind, _, headers in rows:
        if kind != "revisit":
            continue
        low = lambda h: {k.lower(): v for k, v in reversed((h or {}).items())}
        mine = low(headers)
        full = [(t, j, low(h)) for j, u, t, k, s, h in rows if k == "response" and s == 200 and u == url and t is not None and at is not None and t < at]
        if url is None or at is None:
            out[i] = ("no_url", None, mine)
            continue
        if not full:
            out[i] = ("no_earlier_response", None, mine)
            continue
        _, j, base = max(full, key=lambda x: x[:2])
        strip = lambda k, v: v.removeprefix("W/") if k == "etag" else v
        shared = [k for k in ("etag", "last-modified") if mine.get(k) is not None and base.get(k) is not None]
        if any(strip(k, mine[k]) != strip(k, base[k]) for k in shared):
            out[i] = ("validator_mismatch", None, mine)
        elif not shared:
            out[i] = ("no_validator", None, mine)
        else:
            out[i] = ("resolved", j, base | {k: v for k, v in mine.items() if k in warc.PERMITTED})
    return out


def test_hot_url_over_many_parts(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        revisit = rng.random() < 0.6
        names = [k for k in ("ETag", "Last-Modified", "Content-Length", "Date", "X-A") if rng.random() < 0.6]
        headers = {k: rng.choice(("a", "W/a", "b")) if k == "ETag" else rng.choice("xxy") for k in names}
        url = "hot/a" if rng.random() < 0.5 else f"h{rng.randrange(40)}/b"
        rows.append((i, url, rng.randrange(200), "revisit" if revisit else "response", 304 if revisit else rng.choice((200, 200, 404)), headers))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([(i, "http://" + u, *r) for i, u, *r in rows], SCHEMA).repartition(7)
        got = {r.record_id: (r.outcome, r.response_id, r.headers) for r in warc.resolve_revisits(df).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute(rows)


def test_edge_rows(spark):
    rows = [
        (1, "http://x/", 1, "response", 200, None), (2, "http://x/", 2, "revisit", 304, {"ETag": "a", "etag": "b"}),
        (3, None, 2, "revisit", 304, None), (4, "http://x/", None, "revisit", 304, {}), (5, "http://y/", 1, "response", 200, {"etag": None}),
        (6, "http://y/", 5, "revisit", 304, {"etag": "a"}), (6, "http://y/", 5, "revisit", 304, {"etag": "a"}), (None, "http://z/", 5, "revisit", None, {}),
        (8, "http://y/", 5, None, 200, {}),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS part", "'r' AS rank", "2 AS base", "3 AS outcome")
    got = sorted(((r.record_id or 0), r.outcome, r.response_id, len(r.headers)) for r in warc.resolve_revisits(df).collect())
    assert got == [
        (0, "no_earlier_response", None, 0), (2, "no_validator", None, 1), (3, "no_url", None, 0), (4, "no_url", None, 0),
        (6, "no_validator", None, 1), (6, "no_validator", None, 1),
    ]
    assert warc.resolve_revisits(df.where("false")).count() == 0
