import datetime as dt

import pytest
from pyspark.sql import functions as F

from tramline.functions import dates, numbers, text, weather


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("서울대입구(관악구청)", "서울대입구역"),
        ("서울역", "서울역"),
        ("시청", "시청역"),
        ("총신대입구 (이수)", "총신대입구역"),
        ("a　(b) c (d)e", "ae역"),
        ("a (b\nc)", "a (b\nc)역"),
        ("", "역"),
        (None, None),
    ],
)
def test_station_name(one, raw, clean):
    assert one(text.station_name(F.col("n")), [(raw,)], "n string") == [clean]


def test_station_name_is_idempotent(one):
    once = text.station_name(F.col("n"))
    rows = [("시청(x)",), ("서울역",), ("a (b) 역",)]
    assert one(text.station_name(once), rows, "n string") == one(once, rows, "n string")


@pytest.mark.parametrize(
    "first, second, expected",
    [
        ("abc", "ab", "abc"),
        ("ab", "abc", "abc"),
        ("ab ", "cd", "ab "),
        (" ", "", "정보없음"),
        (None, "x", "x"),
        ("x", None, "x"),
        ("  ", None, "정보없음"),
        (None, "　 \x1f", "정보없음"),
        (None, None, "정보없음"),
        ("  a  ", "bc", "bc"),
    ],
)
def test_pick_description(one, first, second, expected):
    picked = text.pick_description(F.col("a"), F.col("b"))
    assert one(picked, [(first, second)], "a string, b string") == [expected]


def test_fee_and_category(one):
    fees = [("무료",), ("유료",), ("기타",), (None,)]
    assert one(text.free_flag(F.col("x")), fees, "x string") == [True, False, None, None]
    kinds = [("축제-전통",), ("연극",), (None,)]
    assert one(text.collapse_category(F.col("x")), kinds, "x string") == ["축제", "연극", None]
    assert one(text.contains(F.col("x"), "축"), kinds, "x string") == [True, False, False]


def test_request_text_keeps_the_whole_text(one):
    long = "x{y}" * 50_000
    (prompt,) = one(text.request_text(F.col("t"), "before {text} after"), [(long,)], "t string")
    assert prompt == f"before {long} after"


@pytest.mark.parametrize(
    "raw, number",
    [
        ("126.9", 126.9),
        ("x", None),
        ("", None),
        (" 2 ", 2.0),
        ("1e3", 1000.0),
        ("-.5", -0.5),
        ("NaN", None),
        ("1d", None),
        ("1.5f", None),
        ("1.D", None),
        ("0x1p3", None),
        ("+1.", 1.0),
        ("1,5", None),
        ("-inf", float("-inf")),
        (None, None),
    ],
)
def test_to_number(one, raw, number):
    assert one(numbers.to_number(F.col("x")), [(raw,)], "x string") == [number]


def test_ratio_truncation_and_order(one):
    pairs = [(1.0, 4.0), (1.0, 0.0), (None, 2.0)]
    assert one(numbers.ratio(F.col("a"), F.col("b")), pairs, "a double, b double") == [0.25, None, None]
    assert one(numbers.truncated(F.col("a")), [(2.9,), (-2.9,)], "a double") == [2, -2]
    low, high = numbers.ordered_pair(F.col("a"), F.col("b"))
    rows = [(2.0, 1.0), (1.0, 2.0), (None, 2.0), (3.0, None)]
    assert one(low, rows, "a double, b double") == [1.0, 1.0, None, 3.0]
    assert one(high, rows, "a double, b double") == [2.0, 2.0, 2.0, None]


def test_calendar(one):
    days = [(dt.date(2025, 4, 19),), (dt.date(2025, 4, 21),), (dt.date(2025, 4, 20),)]
    assert one(dates.day_of_week(F.col("d")), days, "d date") == [5, 0, 6]
    assert one(dates.is_weekend(F.col("d")), days, "d date") == [1, 0, 1]
    leap = [(dt.date(2024, 2, 29),), (dt.date(2025, 1, 31),)]
    assert one(dates.previous_year_month(F.col("d")), leap, "d date") == ["202302", "202401"]
    assert one(F.add_months(F.col("d"), -12), leap, "d date")[0] == dt.date(2023, 2, 28)


def test_strict_date(one):
    day = dt.date(2025, 5, 1)
    texts = [("2025-05-01 00:00:00.0",), ("2025-05-01",), ("",), (None,)]
    assert one(dates.strict_date(F.col("t")), texts, "t string") == [day, day, None, None]
    assert one(dates.strict_date(F.col("t"), "yyyyMMdd"), [("20250501",)], "t string") == [day]
    for bad, pattern in (("soon", None), ("2025-02-30", None), ("20250230", "yyyyMMdd")):
        with pytest.raises(Exception, match="not a date"):
            one(dates.strict_date(F.col("t"), pattern), [(bad,)], "t string")


def test_batch_times(one):
    instant = [(dt.datetime(2025, 4, 16, 15, 10, 42, 7),)]
    ddl = "t timestamp_ntz"
    assert one(dates.city_date(F.col("t")), instant, ddl) == [dt.date(2025, 4, 17)]
    assert one(dates.city_minute(F.col("t")), instant, ddl) == [dt.datetime(2025, 4, 17, 0, 10)]
    base_date, base_time = dates.forecast_base(F.col("t"))
    assert one(base_date, instant, ddl) == ["20250416"]
    assert one(base_time, instant, ddl) == ["2330"]
    day = dates.ridership_date(dates.city_date(F.col("t")))
    assert one(day, instant, ddl) == [dt.date(2025, 4, 13)]


def test_date_lists(one):
    january = [(dt.date(2025, 1, 7),)]
    (days,) = one(dates.previous_month_dates(F.col("d")), january, "d date")
    assert (days[0], days[-1], len(days)) == (dt.date(2024, 12, 1), dt.date(2024, 12, 31), 31)
    (days,) = one(dates.month_dates(F.col("d")), [(dt.date(2024, 2, 10),)], "d date")
    assert len(days) == 29
    months = F.transform(dates.previous_year_months(F.col("d")), dates.month_key)
    assert one(months, january, "d date") == [[f"2024{m:02d}" for m in range(1, 13)]]


@pytest.mark.parametrize(
    "category, value, status",
    [("LGT", v, "plain") for v in ("0", "1", "x", None)]
    + [("LGT", "2", "낙뢰"), ("LGT", " 3", "낙뢰")]
    + [("PTY", v, "비") for v in "12456"]
    + [("PTY", v, "눈") for v in "37"]
    + [("PTY", "0", "plain"), ("SKY", "2", "plain"), ("T1H", "1", "plain"), (None, "1", "plain")]
    + [("SKY", "1", "맑음"), ("SKY", "3", "구름많음"), ("SKY", "4", "흐림")],
)
def test_weather_status(one, category, value, status):
    result = weather.weather_status(F.col("c"), F.col("v"))
    assert one(result, [(category, value)], "c string, v string") == [status]
