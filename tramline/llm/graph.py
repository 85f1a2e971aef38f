"""Connected groups of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.session import stage

BROADCAST_EDGES = 500_000  # whose minima, of two longs a node, are broadcast
EDGES_A_TASK = 1 << 15  # of so few edges; four tasks at least


def release(df: DataFrame) -> None:
    """Let Spark drop shuffle files that only finished, already staged work refers to."""
    import gc

    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def discard(*staged: DataFrame) -> None:
    """Delete staged tables that only finished, already staged work has read; empty ones without files stay."""
    for df in staged:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as no column of ``df`` has (names differ in more than case)."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long) that has a neighbour.

    ``component`` is the smallest node that can be reached. Large-star and small-star rounds: each
    node hands its larger neighbours, then its smaller ones, over to its smallest neighbour, until
    nothing changes (a logarithmic number of rounds in practice). Minima are pre-aggregated before the shuffle
    and staged, so the join back to the edges of a hub can be split by adaptive execution; those of few edges are
    broadcast and dealt to few tasks. A round's tables go when the next one is staged. Edges
    with a null end and loops are ignored; no edges give no rows.
    """
    edges = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return _result(edges)
        before, old = state, edges
        small_enough = state[0] <= BROADCAST_EDGES
        tasks = 4 + state[0] // EDGES_A_TASK

        def dealt(df):
            return df.coalesce(tasks) if small_enough else df

        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = stage(dealt(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))), "least")
        large = both.join(F.broadcast(nearest) if small_enough else nearest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(dealt(large.distinct()), "large")
        least = stage(dealt(large.groupBy("u").agg(F.min("v").alias("m"))), "least")
        small = large.join(F.broadcast(least) if small_enough else least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(dealt(small.unionByName(least.withColumnRenamed("m", "v")).distinct()), "edges")
        discard(old, nearest, large, least)


def merged(groups: DataFrame, edges: DataFrame) -> DataFrame:
    """``groups`` (node, component), as ``components`` gives them, after further edges (a, b), staged.

    Only groups and single nodes that the edges join go through rounds again.
    """
    small_enough = groups.count() <= 2 * BROADCAST_EDGES
    of = F.broadcast(groups) if small_enough else groups
    ends = edges
    for end in ("a", "b"):
        ends = ends.join(of.toDF(end, f"g{end}"), end, "left").withColumn(end, F.coalesce(f"g{end}", end)).drop(f"g{end}")
    joined = stage(components(ends), "joined_groups")
    moved = groups.join(joined.toDF("component", "to"), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return stage(moved.unionByName(joined.join(of, "node", "left_anti")), "merged_groups")


def _result(edges: DataFrame) -> DataFrame:
    """Edges are stars now: every u has one v, the smallest of its group."""
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return members.unionByName(centres)
