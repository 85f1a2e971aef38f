"""Column functions against their plain Python meaning, on random input."""

import datetime as dt
import math
import random
import re

import pandas as pd
import pytest
from dateutil.relativedelta import relativedelta
from pyspark.sql import functions as F

from tramline.functions import dates, numbers, text

BLANKS = [" ", "\t", "\n", "\r", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", " ", " ", "　"]


def strings(alphabet, count=3000, longest=9, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randrange(longest))) for _ in range(count)]


def test_station_name(one):
    values = strings(["(", ")", "역", "a", "시"] + BLANKS)

    def expected(x):
        bare = re.sub(r"\s*\(.*\)", "", x)
        return bare if bare.endswith("역") else bare + "역"

    found = one(text.station_name(F.col("x")), [(v,) for v in values], "x string")
    assert [(v, f) for v, f in zip(values, found) if f != expected(v)] == []


def test_pick_description(one):
    values = strings(["a", "字"] + BLANKS, longest=5)
    pairs = list(zip(values, reversed(values)))

    def expected(first, second):
        if not first.strip() and not second.strip():
            return "정보없음"
        return first if len(first.strip()) >= len(second.strip()) else second

    found = one(text.pick_description(F.col("a"), F.col("b")), pairs, "a string, b string")
    assert [(p, f) for p, f in zip(pairs, found) if f != expected(*p)] == []


def test_to_number(one):
    values = strings(list("0123456789") + list("..+-eEdfxX_, \tinfa"), longest=7)
    values += ["inf", "-Infinity", "nan", "NaN", "1e5", "1e400", " 7", "00012", "+.5e-3"]
    expected = pd.to_numeric(pd.Series(values, dtype=object), errors="coerce")
    found = one(numbers.to_number(F.col("x")), [(v,) for v in values], "x string")
    same = [
        (v, f, e) for v, f, e in zip(values, found, expected)
        if not ((f is None and math.isnan(e)) or (f is not None and f == pytest.approx(e, rel=1e-15)))
    ]
    assert same == []


def test_calendar(one):
    days = [dt.date(2019, 1, 1) + dt.timedelta(days=i) for i in range(0, 2600)]
    rows = [(d,) for d in days]
    assert one(dates.day_of_week(F.col("d")), rows, "d date") == [d.weekday() for d in days]
    assert one(dates.previous_year_month(F.col("d")), rows, "d date") == [
        (d - relativedelta(years=1)).strftime("%Y%m") for d in days
    ]
    months = one(F.size(dates.month_dates(F.col("d"))), rows, "d date")
    assert months == [pd.Timestamp(d).days_in_month for d in days]
