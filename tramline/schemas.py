"""Explicit schemas: landed JSON responses and warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(columns: str) -> T.StructType:
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


# Column names of the landed responses and the warehouse tables. Landed counts
# are read as doubles, since a service may write 10 or 10.0; tables hold whole numbers.
EVENT_ROW = _struct(
    "TITLE string, CODENAME string, GUNAME string, PLACE string, STRTDATE string, END_DATE string,"
    "USE_FEE string, IS_FREE string, LAT string, LOT string, HMPG_ADDR string, MAIN_IMG string,"
    "ORG_LINK string, USE_TRGT string"
)
STATION_ROW = _struct(
    "BLDN_ID string, BLDN_NM string, ROUTE string, LAT string, LOT string"
)
DAILY_ROW = _struct(
    "USE_YMD string, SBWY_ROUT_LN_NM string, SBWY_STNS_NM string, GTON_TNOPE double,"
    "GTOFF_TNOPE double, REG_YMD string"
)
FORECAST_ITEM = _struct(
    "baseDate string, baseTime string, category string, fcstDate string, fcstTime string,"
    "fcstValue string, nx int, ny int"
)

EVENT = _struct(
    "event_id long, title string, category_name string, gu string, location string,"
    "start_date date, end_date date, fee string, is_free boolean, longitude double,"
    "latitude double, homepage string, image_url string, detail_url string,"
    "target_user string, event_description string"
)
EVENT_TEXT = _struct("event_id long, text string")
EVENT_REQUEST = _struct("event_id long, role string, prompt string")
WEATHER = _struct(
    "id long, fcst_date string, time string, gu string, weather_status string, temperture int"
)
STATION = _struct(
    "station_id string, name string, line string, latitude double, longitude double"
)
DAILY = _struct(
    "service_date string, line string, name string, get_on_d int, get_off_d int"
)
HOURLY = _struct(
    "use_month string, name string, line string, hour int, get_on long, get_off long, total long"
)
PREDICTION = _struct(
    "row_number long, name string, service_date date, hour int, predicted_total long"
)
BATCH_STATUS = _struct("batch_id long, execute_time timestamp_ntz, status int")

# A record that a tolerant read has put aside: its reasons, and the record as it came.
REJECTED = T.StructType(
    [
        *_struct("folder string, service string, file string").fields,
        T.StructField("reasons", T.ArrayType(T.StringType())),
        *_struct("record string").fields,
    ]
)


def hourly_row(suffix: str = "NOPE") -> T.StructType:
    """One month of one station, boardings and alightings side by side for all 24 hours."""
    fields = [T.StructField(c, T.StringType()) for c in ("USE_MM", "SBWY_ROUT_LN_NM", "STTN")]
    fields += [
        T.StructField(f"HR_{hour}_GET_{ride}_{suffix}", T.DoubleType())
        for hour in range(24)
        for ride in ("ON", "OFF")
    ]
    return T.StructType(fields)


# What an answer without data has in place of, or inside, the service's envelope.
ERROR = [T.StructField("RESULT", _struct("CODE string, MESSAGE string"))]


def envelope(service: str, row: T.StructType) -> T.StructType:
    """``{service: {list_total_count, row: [...]}}``, the shape of one landed response."""
    body = T.StructType(
        [
            T.StructField("list_total_count", T.LongType()),
            T.StructField("row", T.ArrayType(row)),
            *ERROR,
        ]
    )
    return T.StructType([T.StructField(service, body)])


def forecast_envelope() -> T.StructType:
    """``response.body.items.item[]``, the shape of one landed forecast response."""
    schema = T.ArrayType(FORECAST_ITEM)
    for name in ("item", "items", "body", "response"):
        schema = T.StructType([T.StructField(name, schema)])
    return schema


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast to exactly the columns of ``schema``."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
