"""First row per key and unions that prefer one source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row per key that comes first in ``order``; null key parts equal each other.

    Ties go on to the remaining columns, so the result never depends on row order. As a
    minimum over rows it has a map-side half: each task sends one row per key, and a hot
    key stays small, where a ranking window would pull all its rows together. The hash of the
    key leads the grouping because the aggregate sorts, and a number sorts faster than text.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    columns = [c for c in order if c not in keys] + rest
    if not columns:
        return df.distinct()
    grouped = df.groupBy(F.xxhash64(*keys).alias("_hash"), *keys)
    first = grouped.agg(F.min(F.struct(*columns)).alias("_first"))
    return first.select(*keys, "_first.*").select(*df.columns)


def union_keep_first(
    frames: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Union by name; per key the row of the earliest frame, then the first in ``order``."""
    merged = None
    for priority, frame in enumerate(frames):
        tagged = frame.withColumn("_source", F.lit(priority))
        merged = tagged if merged is None else merged.unionByName(tagged, allowMissingColumns=True)
    return keep_first(merged, keys, ["_source", *order]).drop("_source")
