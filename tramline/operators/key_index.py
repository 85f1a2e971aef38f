"""Bitmaps of a table's keys, and the anti-join that moves only rows whose key may be known.

A key's hash sets one bit; 32,768 bits make a row of the index, ``BITS`` bits for each key it was built
for. An incoming key whose bit is not set is surely new and is passed on where it is read. The rest, some
one in ``BITS`` of the new keys and all known ones, is joined exactly, against those baseline rows only whose
keys such rows may have. Bitmaps of two tables with as many rows are merged by an or.

The index is broadcast only below ``MOST_BYTES``, counted from its rows; beyond that the join is the plain one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.operators.joins import new_rows
from tramline.session import stage

BITS = 16
ROW_BITS = 32768  # of a bitmap that Spark's aggregate makes
MOST_BYTES = 64 << 20


@dataclass(frozen=True)
class KeyIndex:
    """``bitmaps`` (bucket int, bits binary) with the bits of all keys, over so many ``buckets``."""

    bitmaps: DataFrame
    buckets: int

    @property
    def most_bytes(self) -> int:
        return self.buckets * (ROW_BITS // 8 + 32)

    def merged(self, other: KeyIndex) -> KeyIndex:
        """The index of both tables' keys."""
        if self.buckets != other.buckets:
            raise ValueError(f"indexes of {self.buckets} and {other.buckets} buckets")
        both = self.bitmaps.unionByName(other.bitmaps)
        return KeyIndex(both.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits")), self.buckets)


def buckets_for(keys: int) -> int:
    return max(-(-keys * BITS // ROW_BITS), 1)


def key_index(df: DataFrame, key: str, buckets: int) -> KeyIndex:
    """Index of the keys of ``df``, a null key included. Each task sends a bitmap per bucket it has seen."""
    hashed = df.select(_bucket(F.col(key), buckets).alias("bucket"), _bit(F.col(key), buckets).alias("bit"))
    return KeyIndex(hashed.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")), buckets)


def split_by_index(df: DataFrame, key: str, index: KeyIndex) -> tuple[DataFrame, DataFrame]:
    """(rows whose key the index surely lacks, rows whose key it may have); neither is shuffled."""
    bitmaps = index.bitmaps.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    probed = df.join(F.broadcast(bitmaps), _bucket(F.col(key), index.buckets) == F.col("_bucket"), "left")
    bit = _bit(F.col(key), index.buckets)
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    # byte is null where no key fell into the bucket
    known = F.coalesce(F.call_function("shiftright", byte, bit.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return tuple(probed.where(c).select(*(df[c] for c in df.columns)) for c in (~known, known))


def new_rows_indexed(incoming: DataFrame, baseline: DataFrame, key: str, index: KeyIndex) -> DataFrame:
    """``joins.new_rows`` with an index of (at least) the baseline's keys: incoming rows whose key it lacks."""
    if index.most_bytes > MOST_BYTES:
        return new_rows(incoming, baseline, key)
    sure, maybe = split_by_index(incoming, key, index)
    asked = key_index(maybe, key, index.buckets)
    asked = KeyIndex(stage(asked.bitmaps, "asked_keys"), index.buckets)
    _, possible = split_by_index(baseline.select(key), key, asked)
    return sure.unionByName(new_rows(maybe, possible, key))


def _hash(key: Column, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets * ROW_BITS))


def _bucket(key: Column, buckets: int) -> Column:
    return F.floor(_hash(key, buckets) / ROW_BITS).cast("int")


def _bit(key: Column, buckets: int) -> Column:
    return F.pmod(_hash(key, buckets), F.lit(ROW_BITS))
