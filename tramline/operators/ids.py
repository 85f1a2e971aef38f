"""Dense row numbers over a whole table, without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.session import stage

# monotonically_increasing_id() keeps the place within a partition in its low 33 bits.
PLACE_BITS = 33


def assign_ids(
    df: DataFrame, order: Sequence, id_column: str = "id", start: int = 1
) -> DataFrame:
    """Number the rows ``start, start + 1, …`` in ``order``.

    The rows are range-partitioned and sorted once and written to the shared folder
    together with their place, so range bounds cannot differ between the two reads that
    follow: one sums up rows per partition (only the place column is read), the other adds
    those offsets. The offset table has one row per partition, which bounds the broadcast.

    The input partition closes the range key, so even a large group of equal rows is cut
    into pieces. ``order`` should tell unequal rows apart; among ties any order may result.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in order]
    placed = stage(
        df.repartitionByRange(*keys, F.spark_partition_id())
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id()),
        "ids",
    )
    part = F.shiftright("_place", PLACE_BITS)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    local = F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    number = (local + F.col("_before") + F.lit(start)).cast("long")
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(number.alias(id_column), *df.columns)
    )
