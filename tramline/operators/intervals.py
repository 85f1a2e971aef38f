"""Gaps and overlaps of number ranges that should cover 1 to a total exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def coverage_faults(ranges: DataFrame, group: str, first: str, last: str, total: str) -> DataFrame:
    """(group, fault, first, last): what no range covers (``gap``) and what more than one does (``overlap``).

    A sweep over the ranges of a group by their beginning: what lies between the furthest end so far and
    the next beginning is a gap, what the next range has before that end an overlap (once for each range
    that repeats it). ``total`` is the group's declared count, the largest if they differ; what is missing
    at the end is a gap too. Ranges without a beginning or an end, or that end before they begin, cover nothing.
    A group is the requests of one folder, each of which stands for a page of rows; its sweep is one task's.
    """
    order = Window.partitionBy("g").orderBy("a", "b")
    rows = ranges.select(F.col(group).alias("g"), F.col(first).alias("a"), F.col(last).alias("b"), F.col(total).alias("n"))
    declared = rows.groupBy("g").agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"))
    given = rows.where("a <= b AND b >= 1").select("g", F.greatest("a", F.lit(1)).alias("a"), "b")
    # a range of nothing after the declared total closes the sweep
    ends = declared.select("g", (F.col("n") + 1).alias("a"), F.col("n").alias("b"))
    seen = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    swept = given.unionByName(ends).withColumn("seen", F.greatest(F.coalesce(seen, F.lit(0)), F.lit(0)))
    gap = F.when(F.col("a") > F.col("seen") + 1, F.struct(F.lit("gap").alias("fault"), (F.col("seen") + 1).alias("first"), (F.col("a") - 1).alias("last")))
    twice = F.struct(F.lit("overlap").alias("fault"), F.col("a").alias("first"), F.least("b", "seen").alias("last"))
    overlap = F.when((F.col("a") <= F.col("seen")) & (F.col("a") <= F.col("b")), twice)
    return swept.select("g", F.inline(F.array_compact(F.array(gap, overlap)))).withColumnRenamed("g", group)
