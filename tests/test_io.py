"""Landed responses, tables and the landing stream."""

import datetime as dt
import json
import re
import shutil
from concurrent.futures import ThreadPoolExecutor

import pytest
from compare import physical_plan
from pyspark.sql import functions as F

from tramline import schemas
from tramline.plans import ridership
from tramline.plans.weather import district_items, refine_weather
from tramline.sinks import tables as sinks
from tramline.sinks import versions
from tramline.sources import landed, tables
from tramline.sources.districts import DISTRICT_GRID, district_grid
from tramline.streaming.landings import append_landings


def land(root, service, name, *docs):
    folder = root / service if "/" not in name else root / service / name.rsplit("/", 1)[0]
    folder.mkdir(parents=True, exist_ok=True)
    lines = "\n".join(json.dumps(d, ensure_ascii=False) for d in docs)
    (root / service / name).write_text(lines, encoding="utf-8")


def response(service, rows, total=None):
    return {service: {"list_total_count": total or len(rows), "row": rows}}


def ride(day, line="1호선", name="시청", on=10.0, off=5):
    return {"USE_YMD": day, "SBWY_ROUT_LN_NM": line, "SBWY_STNS_NM": name, "GTON_TNOPE": on,
            "GTOFF_TNOPE": off, "REG_YMD": "x", "EXTRA": 1}


def test_event_rows_and_completeness(spark, tmp_path):
    pages = [response(landed.EVENTS, [{"TITLE": f"t{i}", "IS_FREE": "무료"}], 3) for i in range(2)]
    land(tmp_path, landed.EVENTS, "a.json", *pages)
    assert sorted(r.TITLE for r in landed.event_rows(spark, str(tmp_path)).collect()) == ["t0", "t1"]
    raw = landed.read_responses(spark, str(tmp_path), landed.EVENTS, schemas.EVENT_ROW)
    assert landed.completeness(raw).first().asDict() == {"declared": 3, "collected": 2}


def test_incomplete_days_are_found(spark, tmp_path):
    land(tmp_path, landed.DAILY_RIDERS, "ymd=20250101/a.json",
         response(landed.DAILY_RIDERS, [ride("20250101")], 2), response(landed.DAILY_RIDERS, [ride("20250101")], 2))
    land(tmp_path, landed.DAILY_RIDERS, "ymd=20250102/a.json", response(landed.DAILY_RIDERS, [ride("20250102")], 2))
    land(tmp_path, landed.DAILY_RIDERS, "ymd=20250103/a.json", {"RESULT": {"CODE": "INFO-200"}})
    land(tmp_path, landed.DAILY_RIDERS, "ymd=20250104/a.json", {landed.DAILY_RIDERS: {"row": [ride("20250104")]}})
    raw = landed.read_responses(spark, str(tmp_path), landed.DAILY_RIDERS, schemas.DAILY_ROW, "ymd")
    found = sorted(tuple(r) for r in landed.incomplete(raw, "ymd").collect())
    assert found == [("20250102", 2, 1), ("20250104", None, 1)]
    for day, ok in (("20250101", True), ("20250102", False), ("20250103", True), ("20250109", True)):
        read = lambda day=day: landed.daily_rows(spark, str(tmp_path), dt.datetime.strptime(day, "%Y%m%d").date(), 0)
        if ok:
            assert read().count() == 2 * (day == "20250101")
        else:
            with pytest.raises(ValueError, match="20250102: 1 of 2"):
                read()


@pytest.mark.parametrize("answer", [
    {"RESULT": {"CODE": "ERROR-500", "MESSAGE": "server"}}, {}, {"other": 1}, {landed.STATIONS: {"RESULT": {"CODE": "ERROR-336"}}},
])
def test_answers_without_rows_fail(spark, tmp_path, answer):
    land(tmp_path, landed.STATIONS, "ymd=20250101/a.json", response(landed.STATIONS, [{"BLDN_ID": "1"}]), answer)
    with pytest.raises(Exception, match=f"{landed.STATIONS}: no rows but code"):
        landed.station_rows(spark, str(tmp_path), dt.date(2025, 1, 1)).collect()


def test_forecast_without_items_fails(spark, tmp_path):
    land(tmp_path, landed.FORECAST, "base=202504170130/a.json", {"response": {"header": {"resultCode": "03"}}})
    with pytest.raises(Exception, match="without items"):
        landed.forecast_items(spark, str(tmp_path)).collect()


def test_renamed_hour_columns_fail(spark, tmp_path):
    row = {"USE_MM": "202404", "SBWY_ROUT_LN_NM": "1", "STTN": "a", "HR_4_GET_ON_TNOPE": 10.0}
    land(tmp_path, landed.HOURLY_RIDERS, "ym=202404/a.json", response(landed.HOURLY_RIDERS, [row]))
    with pytest.raises(Exception, match="HR_…_NOPE"):
        landed.last_year_rows(spark, str(tmp_path), dt.date(2025, 2, 1)).collect()
    found = landed.last_year_rows(spark, str(tmp_path), dt.date(2025, 2, 1), "TNOPE").collect()
    assert [r.HR_4_GET_ON_TNOPE for r in found] == [10.0]


def test_malformed_response_fails(spark, tmp_path):
    folder = tmp_path / landed.STATIONS
    folder.mkdir()
    (folder / "a.json").write_text("{broken")
    with pytest.raises(Exception, match="(?i)malformed"):
        landed.station_rows(spark, str(tmp_path)).collect()


def test_pretty_printed_response(spark, tmp_path):
    folder = tmp_path / landed.STATIONS
    folder.mkdir()
    doc = response(landed.STATIONS, [{"BLDN_ID": "1", "BLDN_NM": "시청"}])
    (folder / "a.json").write_text(json.dumps(doc, indent=2, ensure_ascii=False))
    raw = landed.read_responses(spark, str(tmp_path), landed.STATIONS, schemas.STATION_ROW, multi_line=True)
    assert [r.BLDN_NM for r in landed.rows_of(raw).collect()] == ["시청"]


def test_station_master(spark, tmp_path):
    row = {"BLDN_ID": "0150", "BLDN_NM": "서울대입구(관악구청)", "ROUTE": "2호선", "LAT": "37.5", "LOT": "126.9"}
    land(tmp_path, landed.STATIONS, "a.json", response(landed.STATIONS, [row]))
    refined = ridership.refine_stations(landed.station_rows(spark, str(tmp_path)))
    found = schemas.conform(refined, schemas.STATION).first()
    assert tuple(found) == ("0150", "서울대입구역", "2호선", 37.5, 126.9)


@pytest.fixture
def rides(tmp_path):
    for day in ("20241130", "20241201", "20241231", "20250103", "20250104"):
        land(tmp_path, landed.DAILY_RIDERS, f"ymd={day}/a.json",
             response(landed.DAILY_RIDERS, [ride(day), ride(day, "2호선")]))
    return str(tmp_path)


def test_daily_rows_reads_one_folder(spark, rides):
    df = landed.daily_rows(spark, rides, dt.date(2025, 1, 7))
    assert [r.USE_YMD for r in df.collect()] == ["20250103", "20250103"]
    assert {re.search("ymd=[0-9]+", f)[0] for f in df.inputFiles()} == {"ymd=20250103"}
    assert landed.daily_rows(spark, rides, dt.date(2025, 9, 1)).count() == 0


def test_last_month_of_january_is_december(spark, rides):
    df = landed.last_month_rows(spark, rides, dt.date(2025, 1, 7))
    assert {re.search("ymd=[0-9]+", f)[0] for f in df.inputFiles()} == {"ymd=20241201", "ymd=20241231"}
    assert sorted({r.USE_YMD for r in df.collect()}) == ["20241201", "20241231"]


def test_daily_refine(spark, rides):
    df = schemas.conform(
        ridership.refine_daily(landed.daily_rows(spark, rides, dt.date(2025, 1, 8))), schemas.DAILY
    )
    assert sorted(tuple(r) for r in df.collect()) == [
        ("20250104", "1호선", "시청역", 10, 5), ("20250104", "2호선", "시청역", 10, 5)
    ]


def test_hourly_rows(spark, tmp_path):
    row = {"USE_MM": "202404", "SBWY_ROUT_LN_NM": "1호선", "STTN": "시청(x)",
           "HR_4_GET_ON_NOPE": 10.0, "HR_4_GET_OFF_NOPE": 3, "JOB_YMD": "x"}
    for month in ("202312", "202404", "202501"):
        land(tmp_path, landed.HOURLY_RIDERS, f"ym={month}/a.json",
             response(landed.HOURLY_RIDERS, [{**row, "USE_MM": month}]))
    df = ridership.refine_hourly(landed.last_year_rows(spark, str(tmp_path), dt.date(2025, 2, 1)))
    rows = {r.hour: tuple(r) for r in schemas.conform(df, schemas.HOURLY).collect()}
    assert len(rows) == 24
    assert rows[4] == ("202404", "시청역", "1호선", 4, 10, 3, 13)
    assert rows[5] == ("202404", "시청역", "1호선", 5, 0, 0, 0)


def item(category, value, time="0600", nx=59, ny=127):
    return {"category": category, "fcstDate": "20250417", "fcstTime": time, "fcstValue": value,
            "nx": nx, "ny": ny}


def test_weather_job(spark, tmp_path):
    items = [item("T1H", "17"), item("SKY", "1"), item("PTY", "1"), item("PTY", "0"), item("LGT", "1"),
             item("SKY", "4", "0700"), item("REH", "50"), item("SKY", "3", nx=61, ny=126)]
    land(tmp_path, landed.FORECAST, "a.json", {"response": {"body": {"items": {"item": items}}}})
    tagged = district_items(landed.forecast_items(spark, str(tmp_path)), district_grid(spark))
    rows = sorted(tuple(r) for r in refine_weather(tagged).collect())
    assert [r[0] for r in rows] == list(range(1, 8))
    slots = [("0600", "맑음", 17), ("0600", "비", 17), ("0700", "흐림", None)]
    expected = {(t, gu, s, k) for gu in ("마포구", "서대문구") for t, s, k in slots}
    assert {r[2:] for r in rows} == expected | {("0600", "강남구", "구름많음", None)}


@pytest.mark.parametrize("value, want", [("23", 23), ("23.5", 24), ("-0.4", 0), ("-", None), (None, None), ("1e99", None)])
def test_temperatures_are_rounded(spark, value, want):
    items = spark.createDataFrame(
        [("20250417", "0600", "g", "T1H", value), ("20250417", "0600", "g", "PTY", "1")],
        "fcstDate string, fcstTime string, gu string, category string, fcstValue string",
    )
    assert [r.temperture for r in refine_weather(items).collect()] == [want]


def test_weather_slots_without_key_match_each_other(spark):
    ddl = "fcstDate string, fcstTime string, gu string, category string, fcstValue string"
    rows = [(None, "0600", "a", "SKY", "1"), (None, "0600", "a", "T1H", "9"), (None, "0600", "a", "T1H", "8")]
    found = refine_weather(spark.createDataFrame(rows, ddl)).collect()
    assert sorted(r.temperture for r in found) == [8, 9]


def test_grid():
    assert len(DISTRICT_GRID) == len({gu for gu, _, _ in DISTRICT_GRID}) == 25


def test_load_mode_and_read(spark, schema_name):
    with pytest.raises(LookupError):
        tables.load_mode(spark, "event", "no_such_schema")
    assert tables.load_mode(spark, "event", schema_name) == "init"
    with pytest.raises(LookupError):
        tables.read_table(spark, "event", schema_name)
    sinks.replace_table(spark.createDataFrame([(1,)], "event_id long").select(
        "event_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.EVENT if f.name != "event_id"]
    ), f"{schema_name}.event", schemas.EVENT)
    assert tables.load_mode(spark, "event", schema_name) == "sync"
    df = tables.read_table(spark, "event", schema_name)
    assert [f.dataType for f in df.schema] == [f.dataType for f in schemas.EVENT]
    observed, seen = tables.counted(df)
    observed.collect()
    assert seen.get == {"rows": 1}


def daily(spark, *rows):
    return spark.createDataFrame(rows, "service_date string, line string, name string, get_on_d int, get_off_d int")


def test_replace_append_and_partition_replace(spark, schema_name):
    first = daily(spark, ("20250101", "1", "a", 1, 1), ("20250102", "1", "a", 2, 2))
    plain = f"{schema_name}.plain"
    sinks.replace_table(first, plain, schemas.DAILY)
    sinks.append_table(first, plain, schemas.DAILY)
    assert spark.table(plain).count() == 4
    sinks.replace_table(first, plain, schemas.DAILY)
    assert spark.table(plain).count() == 2

    parts = f"{schema_name}.parts"
    again = daily(spark, ("20250102", "1", "a", 3, 3), ("20250103", "1", "a", 4, 4))
    for rows in (first, again, again):
        sinks.replace_partitions(rows, parts, schemas.DAILY, "service_date")
    found = sorted((r.service_date, r.get_on_d) for r in spark.table(parts).collect())
    assert found == [("20250101", 1), ("20250102", 3), ("20250103", 4)]
    assert spark.conf.get(sinks.OVERWRITE_MODE).lower() == "static"


class Recorder:
    """Stands in for a reader or writer and keeps what it is told."""

    def __init__(self):
        self.told, self.done = {}, None

    def format(self, name):
        self.told["format"] = name
        return self

    def mode(self, mode):
        self.told["mode"] = mode
        return self

    def options(self, **options):
        self.told.update(options)
        return self

    def load(self):
        return self.told

    def save(self):
        self.done = True


def test_jdbc_read_is_split_by_the_bounds():
    session = type("Session", (), {"read": Recorder()})()
    told = tables.read_jdbc(session, "jdbc:x", "event", "event_id", (1, 900), 8, fetchsize="1000")
    assert told == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "event", "partitionColumn": "event_id",
        "lowerBound": "1", "upperBound": "900", "numPartitions": "8", "fetchsize": "1000",
    }


@pytest.mark.parametrize("given", [{"bounds": (1, 2)}, {"partition_column": "id"}, {"partitions": 4}])
def test_jdbc_read_with_half_a_split_is_an_error(given):
    with pytest.raises(ValueError, match="split"):
        tables.read_jdbc(None, "jdbc:x", "event", **given)


def test_jdbc_write_pins_the_schema(spark, monkeypatch):
    writer, written = Recorder(), []
    frame = type(spark.range(1))
    monkeypatch.setattr(frame, "write", property(lambda df: written.append(df.dtypes) or writer))
    df = spark.createDataFrame(
        [(1, "a", dt.date(2025, 4, 17), 8, 5, "extra")],
        "row_number int, name string, service_date date, hour int, predicted_total int, more string",
    )
    sinks.write_jdbc(df, "jdbc:x", "subway_predict", schemas.PREDICTION, "overwrite")
    assert dict(written[0])["service_date"] == "timestamp_ntz" and "more" not in dict(written[0])
    assert writer.told["mode"] == "overwrite" and writer.done


def test_ledger(spark, schema_name):
    table = f"{schema_name}.batch_status"
    when = dt.datetime(2025, 4, 17, 2, 0, 31)
    sinks.append_ledger(spark, table, when)
    sinks.append_ledger(spark, table, when, status=1)
    sinks.append_ledger(spark, table, when)  # already entered
    found = sorted(tuple(r) for r in sinks.read_ledger(spark, table).collect())
    assert found == [(1, dt.datetime(2025, 4, 17, 2, 0), 0), (2, dt.datetime(2025, 4, 17, 2, 0), 1)]


def times(spark, *minutes):
    day = dt.datetime(2025, 4, 17)
    return spark.createDataFrame([(day + dt.timedelta(minutes=m), 0) for m in minutes], "execute_time timestamp_ntz, status int")


def test_batches_are_numbered_without_gaps(spark, schema_name):
    table = f"{schema_name}.batch_status"
    assert sinks.enter_batches(times(spark, 5, 3, 3, 4.5), table) == 3
    assert sinks.enter_batches(times(spark, 1, 3, 9, 4), table) == 2
    assert sinks.enter_batches(times(spark, 1, 3), table) == 0
    assert sinks.enter_batches(times(spark), table) == 0
    found = sorted((r.batch_id, r.execute_time.minute) for r in sinks.read_ledger(spark, table).collect())
    assert found == [(1, 3), (2, 4), (3, 5), (4, 1), (5, 9)]
    assert versions.last_version(spark, table) == 2


def test_concurrent_runs_share_a_ledger(spark, schema_name):
    table = f"{schema_name}.batch_status"
    with ThreadPoolExecutor(4) as pool:
        runs = [pool.submit(sinks.enter_batches, times(spark, *range(i, i + 6)), table) for i in (0, 2, 4, 4)]
        assert sum(r.result() for r in runs) == 10
    found = sorted((r.batch_id, r.execute_time.minute) for r in sinks.read_ledger(spark, table).collect())
    assert [i for i, _ in found] == list(range(1, 11)) and {m for _, m in found} == set(range(10))


def test_a_version_is_committed_once(spark, schema_name):
    table = f"{schema_name}.batch_status"
    sinks.enter_batches(times(spark, 1), table)
    rows = spark.createDataFrame([(2, dt.datetime(2025, 4, 17), 0)], schemas.BATCH_STATUS)
    first, second = (versions.write_aside(rows, table)[0] for _ in range(2))
    assert versions.commit_version(spark, table, 2, first)
    assert not versions.commit_version(spark, table, 2, second)
    assert sinks.read_ledger(spark, table).count() == 2


def test_a_failed_replace_leaves_the_old_rows(spark, schema_name):
    table = f"{schema_name}.daily"
    old, new = daily(spark, ("20250101", "1", "a", 1, 1)), daily(spark, *[("20250102", "1", "b", i, i) for i in range(100)])
    failing = new.withColumn("get_on_d", F.when(F.col("get_on_d") == 77, F.raise_error(F.lit("half way")).cast("int")).otherwise(F.col("get_on_d")))
    with pytest.raises(Exception, match="half way"):
        sinks.replace_table(failing.repartition(8), table, schemas.DAILY)
    assert tables.load_mode(spark, "daily", schema_name) == "init"  # a first load that failed is no load
    assert sinks.replace_table(old, table, schemas.DAILY) == 1
    with pytest.raises(Exception, match="half way"):
        sinks.replace_table(failing.repartition(8), table, schemas.DAILY)
    assert [r.name for r in spark.table(table).collect()] == ["a"]


def test_readers_keep_what_they_planned(spark, schema_name):
    table = f"{schema_name}.daily"
    sinks.replace_table(daily(spark, ("20250101", "1", "a", 1, 1)), table, schemas.DAILY)
    planned = spark.table(table)
    planned.schema
    sinks.replace_table(daily(spark, ("20250101", "1", "b", 1, 1)), table, schemas.DAILY)
    assert [r.name for r in planned.collect()] == ["a"]
    assert [r.name for r in spark.table(table).collect()] == ["b"]
    first = versions.properties(spark, table)[versions.PREVIOUS]
    # a table may be replaced by what is read from it
    sinks.replace_table(spark.table(table).withColumn("name", F.lit("c")), table, schemas.DAILY)
    assert [r.name for r in spark.table(table).collect()] == ["c"]
    gone = spark._jvm.org.apache.hadoop.fs.Path(first)
    assert not gone.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(gone)


def test_replace_of_other_tables(spark, schema_name):
    table = f"{schema_name}.daily"
    sinks.replace_partitions(daily(spark, ("20250101", "1", "a", 1, 1)), table, schemas.DAILY, "service_date")
    sinks.replace_table(daily(spark, ("20250102", "1", "b", 1, 1)), table, schemas.DAILY)
    assert [tuple(r) for r in spark.table(table).collect()] == [("20250102", "1", "b", 1, 1)]
    sinks.replace_table(daily(spark), table, schemas.DAILY)
    assert spark.table(table).count() == 0 and spark.table(table).columns == [f.name for f in schemas.DAILY]


def test_landing_stream_reads_each_file_once(spark, rides, tmp_path):
    table, name = str(tmp_path / "table"), f"test-{tmp_path.name}-{dt.datetime.now().timestamp()}"
    append_landings(spark, rides, table, name)
    assert spark.read.parquet(table).count() == 10
    append_landings(spark, rides, table, name)
    assert spark.read.parquet(table).count() == 10
    late = tmp_path / "late.json"
    late.write_text(json.dumps(response(landed.DAILY_RIDERS, [ride("20250104", "9호선")])))
    shutil.move(late, tmp_path / landed.DAILY_RIDERS / "ymd=20250104" / "b.json")
    append_landings(spark, rides, table, name)
    found = spark.read.parquet(table)
    assert found.count() == 11 and found.where("line = '9호선'").first()["name"] == "시청역"
