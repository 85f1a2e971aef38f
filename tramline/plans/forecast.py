"""Daily ridership model and its split into hours."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions import dates
from tramline.functions.numbers import truncated
from tramline.operators.aggregates import distinct_rows, hourly_share, r2_score, sum_by
from tramline.operators.dedup import union_keep_first
from tramline.operators.ids import assign_ids
from tramline.operators.joins import common_join
from tramline.operators.labels import code_of, encode, fit_labels, split_flag
from tramline.plans.ridership import clean_names
from tramline.session import stage

KEYS = ["service_date", "line", "name"]
FEATURES = ["line", "name", "day_of_week", "is_weekend"]
TARGET = "get_on_d"


def with_calendar(df: DataFrame, day) -> DataFrame:
    """Add weekday (Monday = 0) and weekend flag of ``day``."""
    return df.withColumns(
        {"day_of_week": dates.day_of_week(day), "is_weekend": dates.is_weekend(day)}
    )


def training_rows(
    last_month: DataFrame, daily: DataFrame, tie: Sequence[str] = (TARGET,)
) -> DataFrame:
    """Both histories, one row per date, line and station, last month's row first."""
    rows = union_keep_first([last_month, daily], KEYS, list(tie))
    day = dates.strict_date(F.col("service_date"), "yyyyMMdd")
    return with_calendar(rows, day).select(*KEYS, *FEATURES[2:], TARGET)


def _assembled(coded: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(coded)


@dataclass
class DailyModel:
    """A fitted forest with the label tables of its features and its held-out score."""

    forest: RandomForestRegressionModel
    labels: dict[str, DataFrame]
    rows: DataFrame
    r2: float | None

    def save(self, path: str) -> None:
        self.forest.write().overwrite().save(f"{path}/forest")
        self.rows.write.mode("overwrite").parquet(f"{path}/rows")
        for column, table in self.labels.items():
            table.write.mode("overwrite").parquet(f"{path}/labels/{column}")

    @classmethod
    def load(cls, spark, path: str) -> DailyModel:
        labels = {c: spark.read.parquet(f"{path}/labels/{c}") for c in FEATURES}
        forest = RandomForestRegressionModel.load(f"{path}/forest")
        return cls(forest, labels, spark.read.parquet(f"{path}/rows"), None)


def train_daily(
    rows: DataFrame,
    target: str = "count",
    trees: int = 100,
    depth: int = 20,
    max_bins: int | None = None,
    seed: int = 2025,
    tasks: int = 64,
) -> DailyModel:
    """Fit the forest on a hash-chosen 70 % of the rows and score it on the rest.

    ``target="rank"`` learns the dense code of the count instead of the count itself.
    Codes enter as plain numbers, so ``max_bins`` bounds split candidates only; by default
    every code can be one. A seed gives one forest as long as ``tasks``, the number of parts
    that the rows are placed in by key, stays the same; layout, files and cores do not matter.
    """
    if target not in ("count", "rank"):
        raise ValueError(f"unknown target {target}")
    rows = stage(rows, "rows")
    labels = {c: fit_labels(rows, c) for c in FEATURES}
    coded = rows.withColumn("_train", split_flag(KEYS))
    coded = coded.withColumn("_key", F.xxhash64(*KEYS))
    for column, table in labels.items():
        coded = encode(coded, table, column)
    if target == "rank":
        coded = encode(coded, fit_labels(rows, TARGET), TARGET)
    if max_bins is None:
        max_bins = max(32, *(table.count() for table in labels.values()))
    # The learner reads its input once per tree level: the joins above run once and compact rows
    # are kept, each task's in one file, which is one partition again when they are read.
    coded = stage(_assembled(coded).select("_key", "_train", "features", F.col(TARGET).cast("double")), "features")
    coded = coded.repartition(tasks, "_key").sortWithinPartitions("_key")
    forest = RandomForestRegressor(
        labelCol=TARGET,
        numTrees=trees,
        maxDepth=depth,
        maxBins=max_bins,
        featureSubsetStrategy="all",
        maxMemoryInMB=512,
        seed=seed,
    ).fit(coded.where("_train"))
    held_out = forest.transform(coded.where("NOT _train"))
    return DailyModel(forest, labels, rows, r2_score(held_out, TARGET, "prediction").first()["r2"])


def predict_daily(model: DailyModel, batch_date: dt.date) -> DataFrame:
    """Forecast of the batch date for every line and station seen in training."""
    pairs = distinct_rows(model.rows, ["line", "name"])
    coded = pairs.withColumns({"_line": F.col("line"), "_name": F.col("name")})
    for column in ("line", "name"):
        coded = encode(coded, model.labels[column], column)
    weekday = batch_date.weekday()
    for column, value in (("day_of_week", weekday), ("is_weekend", int(weekday >= 5))):
        coded = coded.withColumn(column, F.lit(code_of(model.labels[column], value)))
    scored = model.forest.transform(_assembled(coded))
    return scored.select(
        F.lit(batch_date).alias("date"),
        F.col("_line").alias("line"),
        F.col("_name").alias("name"),
        truncated(F.col("prediction")).alias("predicted_get_on_d"),
    )


def split_by_hour(history: DataFrame, daily: DataFrame, month: str | None = None) -> DataFrame:
    """Daily forecasts split by the station's hourly shares of the same month last year.

    ``history``: use_month, name, hour, total, over all lines. ``daily``: date, line, name,
    predicted_get_on_d. A station without history drops out. Each line's share is cut to a
    whole number before anything is added up. With ``month`` (all dates in one month) the
    history scan is limited to the one month that is needed.
    """
    if month:
        history = history.where(F.col("use_month") == month)
    shares = hourly_share(history).select("use_month", "name", "hour", "usage_ratio")
    dated = daily.withColumn("use_month", dates.previous_year_month(F.col("date")))
    predicted = truncated(F.col("usage_ratio") * F.col("predicted_get_on_d"))
    return common_join(dated, shares).select(
        "line", "name", "date", "hour", predicted.alias("predicted_total")
    )


def roll_up_hours(hourly: DataFrame) -> DataFrame:
    """Numbered forecast per station, date and hour over all lines."""
    keys = ["name", "date", "hour"]
    numbered = assign_ids(sum_by(hourly, keys, ["predicted_total"]), keys, "row_number")
    return clean_names(numbered.withColumnRenamed("date", "service_date"))


def forecast_hours(
    last_month: DataFrame,
    daily: DataFrame,
    last_year: DataFrame,
    batch_date: dt.date,
    **model_options,
) -> tuple[DataFrame, float | None]:
    """The whole forecast job: (numbered hourly forecast, held-out score)."""
    model = train_daily(training_rows(last_month, daily), **model_options)
    predicted = predict_daily(model, batch_date)
    # One batch date needs one month of history: a literal the scan can prune by.
    before = batch_date.replace(year=batch_date.year - 1, day=1)
    month = before.strftime("%Y%m")
    return roll_up_hours(split_by_hour(last_year, predicted, month)), model.r2
