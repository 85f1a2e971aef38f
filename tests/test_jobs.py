"""Event load and ridership forecast, end to end on small frames."""

import datetime as dt
import json
from zoneinfo import ZoneInfo

import pytest
from compare import physical_plan
from pyspark.sql import functions as F

from tramline import schemas
from tramline.plans import events, forecast, jobs
from tramline.sources import landed

BATCH = dt.date(2025, 4, 17)
NO = "정보없음"


def raw_events(spark, *rows):
    """(homepage, category, fee, lat, end date) → landed events."""
    given = spark.createDataFrame(
        rows, "HMPG_ADDR string, CODENAME string, IS_FREE string, LAT string, END_DATE string"
    )
    rest = [f.name for f in schemas.EVENT_ROW if f.name not in given.columns]
    filled = given.withColumns({c: F.lit(None).cast("string") for c in rest})
    return filled.withColumns({"TITLE": F.concat(F.lit("t "), "HMPG_ADDR"), "LOT": F.lit("37.5")})


def end(day):
    return f"2025-04-{day} 00:00:00.0"


def page(url, alt, span):
    html = (f'<div class="img-box"><img alt="{alt}"></div>'
            f'<div class="culture-content"><span>{span}</span></div>')
    return (url, html)


@pytest.fixture
def raw(spark):
    return raw_events(
        spark,
        ("a", "축제-전통", "무료", "126.9", end(17)),
        ("b", "연극", "유료", "x", end(16)),
        ("c", None, "기타", " 2 ", end(30)),
        ("d", "연극", None, "", None),
        ("e", "연극", "무료", "1", end(20)),
    )


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(
        [page("a", "alt a", "text a"), page("b", "alt b", "text b"), page("c", " ", "text c"),
         page("f", "alt f", "text f"), page("f", "alt f", "text f")],
        "url string, html string",
    )


def by_home(df):
    return {r.homepage: r for r in df.collect()}


def test_refine(spark, raw):
    described = raw.withColumn("ALT", F.lit("x"))
    found = by_home(events.refine_events(described, BATCH))
    assert [found[h].event_id for h in "abcde"] == [1, 2, 3, 4, 5]
    assert [found[h].category_name for h in "abcd"] == ["축제", "연극", None, "연극"]
    assert [found[h].is_free for h in "abcd"] == [True, False, None, None]
    assert [found[h].longitude for h in "abcd"] == [126.9, None, 2.0, None]
    assert found["a"].latitude == 37.5 and found["a"].end_date == BATCH
    synced = by_home(events.refine_events(described, BATCH, "sync"))
    assert {h: r.event_id for h, r in synced.items()} == {"a": 1, "c": 2, "e": 3}


def test_bad_date_fails(spark):
    bad = raw_events(spark, ("a", "x", "무료", "1", "soon")).withColumn("ALT", F.lit("x"))
    with pytest.raises(Exception, match="not a date: soon"):
        events.refine_events(bad, BATCH).collect()


def test_describe(spark, raw, pages):
    found = {r.HMPG_ADDR: r.ALT for r in events.describe_events(raw, pages).collect()}
    assert found == {"a": "alt a", "b": "alt b", "c": NO, "d": NO, "e": NO}


def test_candidates(spark):
    rows = [(1, "a", BATCH, "x"), (2, "b", BATCH, NO), (3, "c", BATCH, None),
            (4, "d", BATCH - dt.timedelta(days=1), "x"), (5, "e", None, "x")]
    df = spark.createDataFrame(
        rows, "event_id long, homepage string, end_date date, event_description string"
    )
    assert {tuple(r) for r in events.full_load_candidates(df, BATCH).collect()} == {(1, "a"), (3, "c")}
    baseline = spark.createDataFrame([("a",), ("e",)], "homepage string")
    found = {r.event_id for r in events.incremental_candidates(df, baseline).collect()}
    assert found == {2, 3, 4}


def test_answers_go_before_page_texts(spark):
    drafts = spark.createDataFrame([(i, f"old {i}") for i in range(1, 5)], "event_id long, event_description string")
    texts = spark.createDataFrame([(1, "page 1"), (2, "page 2"), (3, "page 3")], "event_id long, text string")
    answers = spark.createDataFrame(
        [(1, "new 1"), (1, "new 1 again"), (1, None), (2, None), (9, "lost")], "event_id long, answer string"
    )
    found = events.apply_summaries(drafts, texts, answers)
    assert {r.event_id: r.event_description for r in found.collect()} == {
        1: "new 1", 2: "page 2", 3: "page 3", 4: "old 4"
    }


def test_few_candidates_leave_pages_in_place(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("url", "html")
    few = pages.select(F.xxhash64("url").alias("event_id"), F.col("url").alias("homepage")).limit(3)
    plan = physical_plan(events.page_texts(few, pages))
    assert "LeftSemi, BuildRight" in plan and plan.count("SortMergeJoin") == 0


@pytest.fixture
def warehouse(spark, schema_name):
    spark.catalog.setCurrentDatabase(schema_name)
    yield schema_name
    spark.catalog.setCurrentDatabase("default")


def land(root, service, folder, *rows):
    path = root / service / folder
    path.mkdir(parents=True, exist_ok=True)
    docs = [json.dumps({service: {"list_total_count": 1, "row": [r]}}, ensure_ascii=False) for r in rows]
    (path / "rows.json").write_text("\n".join(docs), encoding="utf-8")


def test_full_then_incremental_load(spark, raw, pages, warehouse, tmp_path):
    pages.write.saveAsTable("pages")
    spark.createDataFrame([(1, "summary a")], "event_id long, answer string").write.saveAsTable("answers")
    spark.createDataFrame([], "event_id long, answer string").write.saveAsTable("no_answers")
    night = dt.datetime(2025, 4, 16, 17)  # 02:00 in the city on the 17th

    land(tmp_path, landed.EVENTS, "ymd=20250417", *[r.asDict() for r in raw.collect()])
    with pytest.raises(LookupError, match="event_draft"):
        jobs.publish_events(spark, "answers", night)
    assert jobs.draft_events(spark, str(tmp_path), "pages", night) == 1
    # b has ended; c and e have no description
    (request,) = spark.table("event_request").collect()
    assert request.event_id == 1 and request.prompt.endswith("\n\ntext a")
    assert jobs.publish_events(spark, "answers", night) == 5
    saved = by_home(spark.table("event"))
    assert {h: r.event_description for h, r in saved.items()} == {
        "a": "summary a", "b": "alt b", "c": NO, "d": NO, "e": NO
    }
    assert not spark.catalog.tableExists("batch_status")
    # the same batch again, from either job, is still a full load and changes nothing
    assert jobs.publish_events(spark, "answers", night) == 5
    assert jobs.draft_events(spark, str(tmp_path), "pages", night) == 1
    assert jobs.publish_events(spark, "answers", night) == 5
    assert by_home(spark.table("event")) == saved
    assert not spark.catalog.tableExists("batch_status") and not spark.catalog.tableExists("event_sync")

    more = raw_events(spark, ("f", "연극", "무료", "1", end(21)), ("g", "연극", "무료", "1", end(21)))
    next_night = dt.datetime(2025, 4, 17, 17)
    later = raw.where("HMPG_ADDR <> 'a'").unionByName(more)
    land(tmp_path, landed.EVENTS, "ymd=20250418", *[r.asDict() for r in later.collect()])
    assert jobs.draft_events(spark, str(tmp_path), "pages", next_night) == 1
    with pytest.raises(LookupError, match="event_draft"):
        jobs.publish_events(spark, "no_answers", night)
    for _ in range(2):
        assert jobs.publish_events(spark, "no_answers", next_night) == 4
    assert jobs.draft_events(spark, str(tmp_path), "pages", next_night) == 1
    assert jobs.publish_events(spark, "no_answers", next_night) == 4
    synced = by_home(spark.table("event_sync"))
    assert {h: r.event_description for h, r in synced.items()} == {
        "c": NO, "e": NO, "f": "text f", "g": NO
    }
    assert len(by_home(spark.table("event"))) == 5
    (entry,) = spark.table("batch_status").collect()
    assert tuple(entry)[:3] == (1, dt.datetime(2025, 4, 18, 2), 0)


def test_ridership_and_forecast_jobs(spark, month, warehouse, tmp_path):
    root = str(tmp_path)
    spark_rows = month.collect()
    for day in {r.service_date for r in spark_rows}:
        land(tmp_path, landed.DAILY_RIDERS, f"ymd={day}", *[
            {"USE_YMD": day, "SBWY_ROUT_LN_NM": r.line, "SBWY_STNS_NM": r.name + "(x)",
             "GTON_TNOPE": r.get_on_d, "GTOFF_TNOPE": 0}
            for r in spark_rows if r.service_date == day
        ])
    for ym in ("202404", "202405"):
        land(tmp_path, landed.HOURLY_RIDERS, f"ym={ym}", *[
            {"USE_MM": ym, "SBWY_ROUT_LN_NM": line, "STTN": name, "HR_8_GET_ON_NOPE": 30, "HR_9_GET_OFF_NOPE": 70}
            for line, name in (("L1", "A"), ("L1", "B"))
        ])
    land(tmp_path, landed.STATIONS, "ymd=20250417", {"BLDN_ID": "1", "BLDN_NM": "A", "ROUTE": "L1", "LAT": "37", "LOT": "127"})

    at = dt.datetime(2025, 4, 16, 16, 30, tzinfo=dt.timezone.utc)
    for _ in range(2):  # running a job again changes nothing
        assert jobs.load_stations(spark, root, at) == 1
        assert jobs.load_last_month(spark, root, at) == 93
        assert jobs.load_last_year(spark, root, at) == 96
        assert jobs.load_daily(spark, root, dt.datetime(2025, 4, 3, 17)) == 3
    assert spark.table("subway_data_prev_month").count() == 93
    assert spark.table("subway_data_prev_year").count() == 96
    assert {r.service_date for r in spark.table("subway_data_daily").collect()} == {"20250331"}

    written, r2 = jobs.predict_hours(spark, at, trees=10, depth=5)
    assert r2 > 0.8
    rows = sorted(tuple(r) for r in spark.table("subway_predict").collect())
    assert written == len(rows) == 48
    busy = {(r[1], r[3]): r[4] for r in rows if r[4]}
    assert set(busy) == {("A역", 8), ("A역", 9), ("B역", 8), ("B역", 9)}
    assert {r[2] for r in rows} == {BATCH}


def test_jobs_without_input_write_nothing(spark, warehouse, tmp_path):
    root = str(tmp_path)
    land(tmp_path, landed.DAILY_RIDERS, "ymd=20250101", {"USE_YMD": "20250101"})
    land(tmp_path, landed.STATIONS, "ymd=20250101", {"BLDN_ID": "1"})
    (tmp_path / landed.FORECAST / "base=202501010030").mkdir(parents=True)
    at = dt.datetime(2025, 4, 16, 17)
    assert jobs.load_daily(spark, root, at) == 0
    assert jobs.load_stations(spark, root, at) == 0
    assert jobs.load_weather(spark, root, at) == 0
    assert spark.table("subway_data_daily").count() == 0


def test_command_line(spark, warehouse, tmp_path, capsys):
    from tramline.__main__ import main

    row = {"BLDN_ID": "1", "BLDN_NM": "A", "ROUTE": "L1", "LAT": "37", "LOT": "127"}
    land(tmp_path, landed.STATIONS, "ymd=20250417", row)
    args = ["--landing", str(tmp_path), "--instant", "2025-04-16T17:00", "--schema", warehouse]
    main(["stations", *args])
    assert capsys.readouterr().out == "stations: 1\n"
    assert spark.table("subway_station").first()["name"] == "A역"
    with pytest.raises(SystemExit):
        main(["stations"])


def test_weather_job_reads_the_issued_forecast(spark, warehouse, tmp_path):
    for base, value in (("202504162330", "1"), ("202504170030", "4")):
        path = tmp_path / landed.FORECAST / f"base={base}"
        path.mkdir(parents=True)
        item = {"category": "SKY", "fcstDate": "20250417", "fcstTime": "0000", "fcstValue": value,
                "nx": 61, "ny": 126}
        doc = {"response": {"body": {"items": {"item": [item]}}}}
        (path / "a.json").write_text(json.dumps(doc))
    at = dt.datetime(2025, 4, 17, 0, 0, tzinfo=ZoneInfo("Asia/Seoul"))
    assert jobs.load_weather(spark, str(tmp_path), at) == 1
    assert tuple(spark.table("weather").first()) == (1, "20250417", "0000", "강남구", "맑음", None)


HISTORY = "use_month string, line string, name string, hour int, total int"
DAILY = "date date, line string, name string, predicted_get_on_d int"


@pytest.fixture
def history(spark):
    rows = [("202404", "L1", "A역", 8, 10), ("202404", "L2", "A역", 8, 20), ("202404", "L1", "A역", 9, 70),
            ("202405", "L1", "A역", 8, 1), ("202404", "L1", "Z역", 8, 0)]
    return spark.createDataFrame(rows, HISTORY)


def test_split_by_hour_and_roll_up(spark, history):
    day = dt.date(2025, 4, 17)
    daily = spark.createDataFrame(
        [(day, "L1", "A역", 101), (day, "L2", "A역", 55), (day, "L1", "new", 9)], DAILY
    )
    hourly = forecast.split_by_hour(history, daily, month="202404")
    assert sorted((r.line, r.hour, r.predicted_total) for r in hourly.collect()) == [
        ("L1", 8, 30), ("L1", 9, 70), ("L2", 8, 16), ("L2", 9, 38)
    ]
    assert hourly.exceptAll(forecast.split_by_hour(history, daily)).count() == 0
    rolled = sorted(tuple(r) for r in forecast.roll_up_hours(hourly).collect())
    assert rolled == [(1, "A역", day, 8, 46), (2, "A역", day, 9, 108)]


def test_leap_day_uses_february(spark):
    history = spark.createDataFrame([("202302", "L1", "A역", 8, 1)], HISTORY)
    daily = spark.createDataFrame([(dt.date(2024, 2, 29), "L1", "A역", 7)], DAILY)
    assert [r.predicted_total for r in forecast.split_by_hour(history, daily).collect()] == [7]


@pytest.fixture
def month(spark):
    start = dt.date(2025, 3, 1)
    rows = []
    for i in range(31):
        day = start + dt.timedelta(days=i)
        for line, name, base in (("L1", "A역", 1000), ("L2", "A역", 500), ("L1", "B역", 200)):
            rows.append((day.strftime("%Y%m%d"), line, name, base // (4 if day.weekday() > 4 else 1) + i, 0))
    return spark.createDataFrame(
        rows, "service_date string, line string, name string, get_on_d int, get_off_d int"
    )


def test_training_rows_prefer_last_month(spark, month):
    daily = spark.createDataFrame(
        [("20250301", "L1", "A역", 9, 9), ("20250405", "L1", "A역", 7, 7)], month.schema
    )
    rows = forecast.training_rows(month, daily)
    assert rows.columns == [*forecast.KEYS, "day_of_week", "is_weekend", "get_on_d"]
    assert rows.count() == 94
    assert rows.where("service_date = '20250301' and line = 'L1' and name = 'A역'").first()["get_on_d"] == 250
    assert rows.where("service_date = '20250405'").first()[3:5] == (5, 1)


def test_train_predict_save_load(spark, month, tmp_path):
    rows = forecast.training_rows(month, month)
    model = forecast.train_daily(rows, trees=20, depth=6)
    assert model.r2 > 0.9
    again = forecast.train_daily(rows.repartition(7), trees=20, depth=6)
    saturday = dt.date(2025, 4, 19)

    def predicted(m, day=saturday):
        return sorted((r.line, r.name, r.predicted_get_on_d) for r in forecast.predict_daily(m, day).collect())

    found = predicted(model)
    assert found == predicted(again)
    assert [(line, name) for line, name, _ in found] == [("L1", "A역"), ("L1", "B역"), ("L2", "A역")]
    assert 240 < found[0][2] < 300 and 1000 <= predicted(model, dt.date(2025, 4, 21))[0][2] < 1040
    model.save(str(tmp_path / "model"))
    assert predicted(forecast.DailyModel.load(spark, str(tmp_path / "model"))) == found


def test_unseen_weekday_fails(spark, month):
    weekdays = forecast.training_rows(month, month).where("day_of_week < 5")
    model = forecast.train_daily(weekdays, trees=2, depth=2)
    with pytest.raises(LookupError, match="unknown day_of_week: 5"):
        forecast.predict_daily(model, dt.date(2025, 4, 19))


def test_rank_target_predicts_codes(spark, month):
    model = forecast.train_daily(forecast.training_rows(month, month), target="rank", trees=5, depth=4)
    codes = model.rows.select("get_on_d").distinct().count()
    assert all(0 <= r.predicted_get_on_d < codes for r in forecast.predict_daily(model, BATCH).collect())
    with pytest.raises(ValueError):
        forecast.train_daily(model.rows, target="other")


def test_forecast_job(spark, month, history):
    history = history.where("name = 'A역'").unionByName(
        spark.createDataFrame([("202404", "L1", "B역", 8, 5)], HISTORY)
    )
    rolled, r2 = forecast.forecast_hours(month, month, history, BATCH, trees=10, depth=5)
    rows = sorted(tuple(r) for r in schemas.conform(rolled, schemas.PREDICTION).collect())
    assert [r[:4] for r in rows] == [
        (1, "A역", BATCH, 8), (2, "A역", BATCH, 9), (3, "B역", BATCH, 8)
    ]
    assert r2 > 0.8 and 400 < rows[0][4] < 500
