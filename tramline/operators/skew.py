"""Equi-joins that stay balanced when a few keys hold much of the left side."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH_GROUPS = 256
KINDS = ("inner", "left", "left_semi", "left_anti")


def half_partition(spark) -> float:
    """The share of the rows that fills half a shuffle partition: from there on a key is hot."""
    return 0.5 / int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_key_shares(df: DataFrame, keys: Sequence[str], share: float | None = None) -> dict[int, float]:
    """Hash → share of the rows, for the keys that hold at least ``share`` of them.

    ``share`` is half a shuffle partition by default, so it follows the cluster.

    One pass over the key columns with frequent-items sketches, merged in two steps. There
    are at most ``1 / share`` entries; a wrong pick only costs some copies, never rows.
    """
    share = share or half_partition(df.sparkSession)
    limit = math.ceil(1 / share)
    tracked = 8 * limit
    hashed = df.select(
        F.xxhash64(*keys).alias("h"), F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("g")
    )
    parts = hashed.groupBy("g").agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("sketch")
    )
    # A group rather than a plain aggregate: combining fails on tasks without any sketch.
    merged = parts.groupBy(F.lit(0).alias("all")).agg(
        F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch")
    )
    estimate = F.expr(f"approx_top_k_estimate(sketch, {limit})")
    found = merged.select("n", F.inline(estimate)).where(F.col("count") >= share * F.col("n"))
    return {row["item"]: row["count"] / row["n"] for row in found.collect()}


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    null_safe: bool = False,
    slices: bool = False,
) -> DataFrame:
    """``left`` joined to ``right`` on equal columns; ``how`` is one of ``KINDS``.

    With ``null_safe`` null keys match each other. By default skew is left to adaptive
    execution, which splits partitions by their measured size. ``slices`` is for plans it
    cannot split, or sessions without it: the left side is read once for hot keys, the rows of
    each are dealt out over slices of half a usual partition, and its right rows are copied to
    those slices. The result equals the plain join; a join of small sides is not worth it.
    """
    if how not in KINDS:
        raise ValueError(f"cannot spread a {how} join")
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    match = [
        F.col(k).eqNullSafe(F.col(f"_r_{k}")) if null_safe else F.col(k) == F.col(f"_r_{k}")
        for k in on
    ]
    hot = {}
    if slices:
        hot = hot_key_shares(left, on)
    if hot:
        dealt = _slice_table(left.sparkSession, hot)
        # The input partition deals out equal rows too, and a retried task deals alike.
        deal = F.pmod(F.xxhash64(*left.columns), F.col("_slices")) + F.spark_partition_id()
        left = _with_slices(left, on, dealt).withColumn(
            "_slice", F.coalesce(F.pmod(deal, F.col("_slices")), F.lit(0))
        )
        copies = F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1)
        renamed = _with_slices(renamed, [f"_r_{k}" for k in on], dealt)
        renamed = renamed.withColumn("_r_slice", F.explode(copies)).drop("_slices")
        match.append(F.col("_slice") == F.col("_r_slice"))
    joined = left.join(renamed, match, how)
    return joined.drop("_slices", "_slice", "_r_slice", *[f"_r_{k}" for k in on])


def _slice_table(spark, hot):
    """(hash, slices): as many slices as the key fills half partitions.

    At most two rows for each shuffle partition, and the slices add up to at most twice the
    number of shuffle partitions plus one per key, which bounds the copies on the right.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = [max(2, math.ceil(2 * part * partitions)) for part in hot.values()]
    return spark.createDataFrame(pa.table({"_hash": list(hot), "_slices": pa.array(counts, pa.int64())}))


def _with_slices(df, keys, slices):
    hashed = df.withColumn("_hash", F.xxhash64(*keys))
    return hashed.join(F.broadcast(slices), "_hash", "left").drop("_hash")

