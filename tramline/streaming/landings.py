"""Append landings to ridership history, each landed file exactly once.

The scheduled daily load re-expressed as a stream that drains what has landed and stops.
The checkpoint remembers the files already read, so a re-run after a failure neither loses
nor repeats rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline import schemas
from tramline.plans.ridership import refine_daily
from tramline.session import shared_folder
from tramline.sources.landed import DAILY_RIDERS


def daily_stream(spark: SparkSession, root: str, files_per_batch: int = 10_000) -> DataFrame:
    """Refined daily ridership of files landed under ``<root>/CardSubwayStatsNew/ymd=…``."""
    raw = (
        spark.readStream.schema(schemas.envelope(DAILY_RIDERS, schemas.DAILY_ROW))
        .options(mode="FAILFAST", maxFilesPerTrigger=str(files_per_batch))
        .json(f"{root}/{DAILY_RIDERS}/*")
    )
    rows = raw.select(F.inline(f"{DAILY_RIDERS}.row"))
    return schemas.conform(refine_daily(rows), schemas.DAILY)


def append_landings(spark: SparkSession, root: str, table_path: str, name: str) -> None:
    """Drain all new files into the parquet table at ``table_path``, by service date.

    ``name`` and ``table_path`` key the checkpoint in the shared folder; keep both for the life
    of the table.
    """
    place = hashlib.sha256(table_path.rstrip("/").encode()).hexdigest()[:16]
    query = (
        daily_stream(spark, root)
        .writeStream.format("parquet")
        .partitionBy("service_date")
        .option("path", table_path)
        .option("checkpointLocation", f"{shared_folder(spark).rstrip('/')}/landings-{name}-{place}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
