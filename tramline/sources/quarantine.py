"""Landed responses read tolerantly: what cannot be used goes aside with the reasons.

The strict reads of ``landed`` fail a load for one bad line. Here every response line is parsed by
itself with all fields as text; a line or a row that does not hold what the table needs is rejected
with reason codes, and the rest is typed. Both are staged in one pass, apart from each other.

Reasons of lines: ``malformed`` (no JSON of that shape), ``no_envelope`` (an answer without rows that
does not say there is no data). Of rows: ``empty_row``, ``bad_<column>`` for a text that is not
of the column's type, and the names of the caller's rules. Of folders: ``incomplete``, if less rows
were found, good or not, than the service declared.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline import schemas
from tramline.functions.numbers import to_number
from tramline.session import stage_path
from tramline.sources.landed import NO_DATA, folders_of

READ = {"columnNameOfCorruptRecord": "_corrupt"}


class TooManyRejected(ValueError):
    """More of a landing was rejected than the job allows."""


@dataclass(frozen=True)
class Split:
    """Typed ``good`` rows, ``rejected`` records (schemas.REJECTED), and how many of each there are."""

    good: DataFrame
    rejected: DataFrame
    n_good: int
    n_rejected: int

    def require(self, most: float) -> Split:
        """Itself, if at most that share of all records was rejected."""
        share = self.n_rejected / max(self.n_good + self.n_rejected, 1)
        if share > most:
            raise TooManyRejected(f"{self.n_rejected} of {self.n_good + self.n_rejected} records rejected, {most:.1%} allowed")
        return self


def not_a_date(text: Column, pattern: str | None = None) -> Column:
    """True for a text that is no date; empty and null are none to be judged."""
    given = F.nullif(F.trim(text), F.lit(""))
    day = F.try_to_date(given, pattern) if pattern else given.try_cast("date")
    return given.isNotNull() & day.isNull()


def read_split(
    spark: SparkSession,
    root: str,
    service: str,
    row: T.StructType,
    folder: str,
    values: Sequence[str] | None = None,
    rules: Mapping[str, Column] | None = None,
) -> Split:
    """The landing of a service, one response a line, in folders ``folder=value`` (all by default).

    ``rules`` maps reason codes to conditions over the row's columns as text that reject the row.
    Folders that have not landed are empty. An empty text counts as null in columns of other types.
    """
    lines = folders_of(spark, f"{root}/{service}", "value string", folder, values, "text")
    parsed = F.from_json("value", _text_envelope(service, row), READ)
    code = F.coalesce(F.col("p.RESULT.CODE"), F.col(f"p.{service}.RESULT.CODE"))
    body = F.col(f"p.{service}")
    has_rows = body["list_total_count"].isNotNull() | body["row"].isNotNull()
    reason = F.when(F.col("p").isNull() | F.col("p._corrupt").isNotNull(), "malformed")
    reason = reason.when(~F.coalesce(has_rows, F.lit(False)) & ~F.coalesce(code == NO_DATA, F.lit(False)), "no_envelope")
    answers = lines.where(F.trim("value") != "").select(
        folder, "value", F.input_file_name().alias("file"), parsed.alias("p")
    ).withColumn("reason", reason)
    empty = F.array().cast(T.ArrayType(_as_text(row)))
    # a rejected line is one record without rows
    records = F.when(F.col("reason").isNotNull(), F.array(F.lit(None).cast(_as_text(row)))).otherwise(F.coalesce(body["row"], empty))
    declared = F.coalesce(body["list_total_count"].try_cast("long"), F.lit(0))
    rows = answers.select(
        folder, "file", "reason", F.when(F.col("reason").isNull(), declared).alias("declared"),
        F.when(F.col("reason").isNotNull(), F.col("value")).alias("line"), F.explode_outer(records).alias("r"),
        (F.size(records) > 0).alias("given"),
    )
    texts = rows.select("*", *(F.col(f"r.{f.name}").alias(f.name) for f in row))
    found = [F.when(_unreadable(f), f"bad_{f.name}") for f in row if f.dataType != T.StringType()]
    found += [F.when(condition, code) for code, condition in (rules or {}).items()]
    found = [F.when(F.col("r").isNull(), "empty_row"), *found]
    reasons = F.when(F.col("reason").isNotNull(), F.array("reason")).otherwise(F.array_compact(F.array(*found)))
    judged = texts.select(
        folder, "file", "declared", "given", reasons.alias("reasons"),
        F.coalesce("line", F.to_json("r")).alias("record"), *(_typed(f).alias(f"t_{f.name}") for f in row),
    )
    judged = judged.withColumn("bad", F.col("given") & (F.size("reasons") > 0))
    return _staged(spark, judged, service, row, folder)


def _staged(spark, judged, service, row, folder):
    path = stage_path(spark, "quarantine")
    seen = Observation()
    counts = (F.count_if("bad").alias("bad"), F.count_if(F.col("given") & ~F.col("bad")).alias("good"))
    judged.observe(seen, *counts).write.partitionBy("bad").parquet(path)
    found = spark.read.schema(T.StructType([*(f for f in judged.schema if f.name != "bad"), judged.schema["bad"]])).parquet(path)
    good = found.where("NOT bad AND given").select(*(F.col(f"t_{f.name}").alias(f.name) for f in row))
    rejected = found.where("bad").select(F.col(folder).alias("folder"), "file", "reasons", "record")
    sums = found.groupBy(folder).agg(
        F.max("declared").alias("declared"), F.count_if(F.col("given") & F.col("declared").isNotNull()).alias("collected")
    )
    short = sums.where("declared IS NULL OR collected < declared").select(
        F.col(folder).alias("folder"),
        F.lit(None).cast("string").alias("file"),
        F.array(F.lit("incomplete")).alias("reasons"),
        F.concat("collected", F.lit(" of "), F.coalesce(F.col("declared").cast("string"), F.lit("none declared"))).alias("record"),
    )
    rejected = rejected.unionByName(short).withColumn("service", F.lit(service))
    return Split(good, schemas.conform(rejected, schemas.REJECTED), seen.get["good"], seen.get["bad"])


def _as_text(row):
    return T.StructType([T.StructField(f.name, T.StringType()) for f in row])


def _text_envelope(service, row):
    error = [T.StructField(f.name, f.dataType) for f in schemas.ERROR]
    count = T.StructField("list_total_count", T.StringType())
    body = T.StructType([count, T.StructField("row", T.ArrayType(_as_text(row))), *error])
    return T.StructType([T.StructField(service, body), *error, T.StructField("_corrupt", T.StringType())])


def _typed(field):
    text = F.nullif(F.trim(F.col(field.name)), F.lit(""))
    if field.dataType == T.StringType():
        return F.col(field.name)
    if field.dataType in (T.DoubleType(), T.IntegerType(), T.LongType()):
        return to_number(text).try_cast(field.dataType)
    return text.try_cast(field.dataType)


def _unreadable(field):
    return (F.trim(F.col(field.name)) != "") & _typed(field).isNull()
