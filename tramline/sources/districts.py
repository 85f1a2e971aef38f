"""The district grid, a literal dimension."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# District and forecast grid cell (nx, ny).
DISTRICT_GRID = [
    ("강남구", 61, 126),
    ("강동구", 62, 126),
    ("강북구", 61, 128),
    ("강서구", 58, 126),
    ("관악구", 59, 125),
    ("광진구", 62, 127),
    ("구로구", 58, 125),
    ("금천구", 59, 124),
    ("노원구", 62, 129),
    ("도봉구", 61, 129),
    ("동대문구", 61, 127),
    ("동작구", 59, 125),
    ("마포구", 59, 127),
    ("서대문구", 59, 127),
    ("서초구", 60, 125),
    ("성동구", 61, 127),
    ("성북구", 61, 128),
    ("송파구", 62, 126),
    ("양천구", 58, 126),
    ("영등포구", 58, 125),
    ("용산구", 60, 126),
    ("은평구", 59, 128),
    ("종로구", 60, 127),
    ("중구", 60, 127),
    ("중랑구", 62, 128),
]


def district_grid(spark: SparkSession) -> DataFrame:
    """The grid as a literal in the plan; as an Arrow table no task has to make it."""
    gu, nx, ny = zip(*DISTRICT_GRID, strict=True)
    columns = {"gu": gu, "nx": pa.array(nx, pa.int32()), "ny": pa.array(ny, pa.int32())}
    return spark.createDataFrame(pa.table(columns))
