"""Dense label codes and keyed train/test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.operators.ids import assign_ids
from tramline.operators.skew import spread_join


def fit_labels(df: DataFrame, column: str) -> DataFrame:
    """``(column, code)``: the sorted distinct values numbered 0 … k−1.

    The values are staged while they are numbered, so joins know their size and broadcast
    them only while they are few.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    return assign_ids(values, [column], "code", start=0).select(column, "code")


def encode(df: DataFrame, labels: DataFrame, column: str, code: str | None = None) -> DataFrame:
    """``code`` (default: the column itself) := the label code; an unknown value fails."""
    return _lookup(df, labels, column, "code", code or column)


def decode(df: DataFrame, labels: DataFrame, code: str, value: str | None = None) -> DataFrame:
    """``value`` (default: the code column itself) := the label; an unknown code fails."""
    (name,) = [c for c in labels.columns if c != "code"]
    known = labels.select(F.col("code").alias(code), F.col(name).alias("_label"))
    return _lookup(df, known, code, "_label", value or code)


def code_of(labels: DataFrame, value) -> int:
    """The code of one value, for a constant that needs no join; an unknown value fails."""
    (name,) = [c for c in labels.columns if c != "code"]
    found = labels.where(F.col(name) == F.lit(value)).first()
    if found is None:
        raise LookupError(f"unknown {name}: {value}")
    return found["code"]


def _lookup(df, table, key, found, target):
    found_side = table.select(key, F.col(found).alias("_found"))
    message = F.concat(F.lit(f"unknown {key}: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    checked = F.when(F.col("_found").isNull(), F.raise_error(message)).otherwise(F.col("_found"))
    joined = spread_join(df, found_side, [key], "left")
    return joined.withColumn(target, checked).drop("_found")


def split_flag(keys: Sequence[str], train_percent: int = 70):
    """True for the training part: a hash of the key decides, whatever the partitioning."""
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100
    return bucket < train_percent
