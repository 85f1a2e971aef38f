import contextlib
import math
import os
import threading

import numpy as np
import pytest
from compare import connect, differences

from tramline.llm import embeddings
from tramline.llm.queries import QUERIES, SQL


def brute(rows, cosine):
    """rows: [(id, vector or None)] -> {id: (n_links, component)}."""
    ok = [
        (i, np.array(v, float))
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    near = {i: set() for i, _ in rows}
    for n, (i, u) in enumerate(ok):
        for j, v in ok[n + 1 :]:
            if len(u) == len(v) and (u @ v) / (math.sqrt(u @ u) * math.sqrt(v @ v)) >= cosine:
                near[i].add(j)
                near[j].add(i)
    group = {}
    for i in sorted(near):
        todo = [i]
        while todo:
            k = todo.pop()
            if k not in group:
                group[k] = group.get(i, i)
                todo += near[k]
    return {i: (len(near[i]), group[i]) for i in near}


def result(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


def test_query_equals_sql(spark, sf_dir):
    assert differences(QUERIES["op4_embedding_near_dedup"](spark, sf_dir), connect(sf_dir), SQL["op4_embedding_near_dedup"]) is None


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    df = QUERIES["op4_embedding_near_dedup"](spark, sf_dir)
    assert df.dtypes == [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    assert result(df) == brute(rows, 0.95)
    assert all(r.kept == (r.vec_id == r.component_id) for r in df.collect())


@pytest.mark.parametrize("unit,cosine", [(16, 0.9), (64, 0.95), (7, 0.5), (40, 0.999)])
def test_clusters_over_many_units(spark, unit, cosine, monkeypatch):
    monkeypatch.setattr(embeddings, "UNIT", unit)
    rng = np.random.default_rng(unit)
    rows = []
    for c in range(8):
        centre = rng.normal(size=5)
        for _ in range(40):
            rows.append((len(rows), [float(x) for x in centre * rng.uniform(0.1, 9) + rng.normal(size=5) * 0.2 * (c + 1) / 4]))
    rows += [(len(rows) + k, rows[k][1]) for k in range(30)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert result(embeddings.near_duplicates(df, cosine=cosine, max_cells=6, sample_rows=50)) == brute(rows, cosine)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [1.0, None]), (6, [inf, 1.0]),
        (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [1e30, 0.0]), (11, [1e-30, 1e-38]),
        (None, [1.0, 0.0]), (12, [-1.0, 0.0]), (13, [0.0, -0.0]), (14, [1.0, 0.0]), (14, [1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS id", "'v' AS v", "2 AS kept")
    got = {}
    for r in embeddings.near_duplicates(df).collect():
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    near = [7, 8, 10, 11]
    want = {i: [(0, i, True)] for i in range(1, 14)} | {i: [(5, 7, i == 7)] for i in near}
    assert got == want | {14: [(5, 7, False)] * 2, None: [(0, None, False)]}
    assert embeddings.near_duplicates(df.where("false")).count() == 0
    assert embeddings.near_duplicates(df.where("vec_id < 4")).count() == 3


def test_disk_grows_with_the_input_only(spark, monkeypatch):
    """Unrelated vectors, all of which go to all blocks, in several rounds."""
    monkeypatch.setattr(embeddings, "UNIT", 50)
    monkeypatch.setattr(embeddings, "BLOCK", 200, raising=False)
    monkeypatch.setattr(embeddings, "ROUND_BYTES", 0, raising=False)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 64))
    vectors[2900:] = vectors[:100] + rng.normal(size=(100, 64)) * 0.1
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    folders = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def size():
        found = [os.path.join(d, f) for folder in folders for d, _, files in os.walk(folder) for f in files]
        return sum(os.stat(f).st_size for f in found if os.path.exists(f))

    sizes, over = [size()], threading.Event()

    def watch():
        while not over.wait(0.05):
            with contextlib.suppress(OSError):  # a file may go meanwhile
                sizes.append(size())

    watching = threading.Thread(target=watch)
    watching.start()
    try:
        got = result(embeddings.near_duplicates(df))
    finally:
        over.set()
        watching.join()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    assert [got[i][0] for i in range(3000)] == (near.sum(axis=1) - 1).tolist()
    assert got[2950] == (1, 50)
    assert max(sizes) - sizes[0] < 10 * 4 * vectors.size


def test_rounds_hold_each_pair_of_blocks_once():
    sent = np.random.default_rng(0).integers(0, 4, (9, 9)) + np.eye(9, dtype=int)
    met = np.minimum(sent, sent.T) > 0
    turns = list(embeddings.rounds(sent, 20))
    assert (sum(w.astype(int) for w in turns) == met).all() and len(turns) > 2
    both = np.triu(sent + sent.T, 1) + np.diag(np.diag(sent))
    assert all(both[np.triu(w)].sum() <= 20 for w in turns)
    assert (sum(w.astype(int) for w in embeddings.rounds(sent, 0)) == met).all()


@pytest.mark.parametrize("dim", [1, 3, 70])
def test_shortened_vectors_bound_the_cosine(dim):
    points = np.random.default_rng(dim).normal(size=(300, dim)) + 1
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    axes = embeddings.leading_axes(points, 0.95)
    assert np.allclose(axes.T @ axes, np.eye(axes.shape[1]))
    low = embeddings.shortened(points, axes).astype(float)
    assert (low @ low.T >= points @ points.T - 1e-6).all()


@pytest.mark.parametrize("spread", [0.02, 0.1])
def test_dense_groups_and_close_calls(spark, spread, monkeypatch):
    """Most pairs link, all by whole blocks of nodes; some cosines are the threshold itself."""
    monkeypatch.setattr(embeddings, "SIDE", 32)
    rng = np.random.default_rng(7)
    vectors = [np.array([3.0, 4.0, 0, 0]), np.array([1.0, 0, 0, 0])] * 2
    vectors = [v * k for k, v in enumerate(vectors, 1)] + [np.array([3.0, 4.0, 0, 0]) + rng.normal(size=4) * spread * 5 for _ in range(400)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for cosine in (0.6, 0.99):
        assert result(embeddings.near_duplicates(df, cosine=cosine)) == brute(rows, cosine)
