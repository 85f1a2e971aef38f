"""Session settings and the shared-folder staging every job relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a running session may still change. They are only filled in where the
# session does not set them, so a cluster's own tuning always wins.
RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_folder: str | None = None


def build_session(
    app_name: str = "tramline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the engine's defaults; dotted settings go in ``conf`` as a dict splat."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    defaults = {**RUNTIME_DEFAULTS, "spark.sql.session.timeZone": "UTC"}
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Fill in the runtime settings that a session handed to us leaves open."""
    explicit = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for key, value in RUNTIME_DEFAULTS.items():
        if key not in explicit and spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a master that runs all tasks in this process (``local[…]``) may do without; its
    stages then go to a temporary folder. Any other master fails.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="tramline-")
    return _local_folder


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage on storage that outlives executors. It also gives Catalyst the
    true size of the result, so a later join broadcasts it only when it really is below
    ``spark.sql.autoBroadcastJoinThreshold``, and lets each reader prune columns.
    """
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path in this application's part of the shared folder."""
    return f"{_stage_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_stages(spark: SparkSession) -> None:
    """Delete everything this application staged; call it when its results are written."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(_stage_root(spark))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def _stage_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/tramline-{spark.sparkContext.applicationId}"


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for the result, the one it picks broadcast joins by."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def scanned_bytes(df: DataFrame) -> int:
    """Size of all inputs the result is read from; joins do not inflate it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
