"""Station master and ridership history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.text import station_name
from tramline.operators.reshape import hourly_profile

# Landed column → table column.
STATION_COLUMNS = {
    "BLDN_ID": "station_id",
    "BLDN_NM": "name",
    "ROUTE": "line",
    "LAT": "latitude",
    "LOT": "longitude",
}
DAILY_COLUMNS = {
    "USE_YMD": "service_date",
    "SBWY_ROUT_LN_NM": "line",
    "SBWY_STNS_NM": "name",
    "GTON_TNOPE": "get_on_d",
    "GTOFF_TNOPE": "get_off_d",
}
HOURLY_COLUMNS = {"USE_MM": "use_month", "STTN": "name", "SBWY_ROUT_LN_NM": "line"}


def clean_names(df: DataFrame) -> DataFrame:
    return df.withColumn("name", station_name(F.col("name")))


def refine_stations(raw: DataFrame) -> DataFrame:
    return clean_names(raw.withColumnsRenamed(STATION_COLUMNS))


def refine_daily(raw: DataFrame) -> DataFrame:
    return clean_names(raw.withColumnsRenamed(DAILY_COLUMNS).drop("REG_YMD"))


def refine_hourly(raw: DataFrame) -> DataFrame:
    """Boardings and alightings per month, station, line and hour.

    Names are cleaned after the sums: raw names that clean to one name stay apart here.
    """
    profile = hourly_profile(raw, list(HOURLY_COLUMNS)).withColumnsRenamed(HOURLY_COLUMNS)
    return clean_names(profile).withColumn("total", F.col("get_on") + F.col("get_off"))
