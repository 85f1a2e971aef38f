import os
import random

import numpy as np
import pytest
import xxhash
from conftest_llm import lower, words

from tramline.llm import simhash
from tramline.llm.queries import QUERIES


def brute_fingerprint(text, size=3):
    w = words(lower(text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, most=3):
    """prints: {id: fingerprint}."""
    ids = sorted(prints)
    f = np.array([prints[i] for i in ids], np.uint64)
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= most
    label = {}
    for i, a in enumerate(ids):
        if a in label:
            continue
        todo = [i]
        while todo:
            k = todo.pop()
            if ids[k] in label:
                continue
            label[ids[k]] = a
            todo += [j for j in np.flatnonzero(near[k]) if ids[j] not in label]
    return label


def test_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    prints = {r.doc_id: brute_fingerprint(r.text) for r in rows}
    groups = brute_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op2_simhash_near_dedup"](spark, sf_dir).collect()}
    assert got == {i: (f"{f:016x}", groups[i]) for i, f in prints.items()}


@pytest.mark.parametrize("distance", [0, 1, 3])
def test_links_of_clustered_fingerprints(spark, distance, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 16)
    rng = random.Random(distance)
    prints = {}
    for c in range(12):
        centre = rng.getrandbits(64)
        for _ in range(60 if c else 200):
            f = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                f ^= 1 << b
            prints.setdefault(f, len(prints))
    rows = [(i, f - (1 << 64) if f >> 63 else f) for f, i in prints.items()]
    from tramline.llm.graph import components

    links = simhash.near_links(spark.createDataFrame(rows, "id long, fp long"), distance)
    got = {r.node: r.component for r in components(links).collect()}
    want = brute_components({i: f for f, i in prints.items()}, distance)
    assert {i: got.get(i, i) for i in want} == want


@pytest.mark.parametrize("parts", [1, 2])
def test_unequal_thresholds_find_every_pair(spark, parts, monkeypatch):
    """Allotments with fewer partitions probe neighbouring values."""
    real = simhash.plan

    def forced(rows, n, most):
        groups = simhash.bit_groups(rows, n, parts)
        left, out = most - parts + 1, []
        for i, g in enumerate(groups):
            t = left if i == len(groups) - 1 else min(1, left)
            left -= t
            out.append((g, t))
        return out

    assert real
    monkeypatch.setattr(simhash, "plan", forced)
    rng = random.Random(parts)
    base = [rng.getrandbits(64) for _ in range(10)]
    prints = {}
    for f in base:
        for k in range(5):
            g = f
            for b in rng.sample(range(64), k):
                g ^= 1 << b
            prints.setdefault(g, len(prints))
    most = 2
    rows = [(i, f - (1 << 64) if f >> 63 else f) for f, i in prints.items()]
    from tramline.llm.graph import components

    got = {r.node: r.component for r in components(simhash.near_links(spark.createDataFrame(rows, "id long, fp long"), most)).collect()}
    want = brute_components({i: f for f, i in prints.items()}, most)
    assert {i: got.get(i, i) for i in want} == want


def test_allotment_is_the_cheapest():
    costs = [[0, 5, 9, 20], [0, 1, 2, 30], [0, 7, 8, 9]]
    want = min(
        (costs[0][a] + costs[1][b] + costs[2][c], [a - 1, b - 1, c - 1])
        for a in range(4)
        for b in range(4)
        for c in range(4)
        if a + b + c - 3 == 1
    )
    assert simhash.allot(costs, 1)[0] == want[0]


def test_edge_rows(spark, docs):
    rows = [
        (5, None, None, None, None),
        (3, "", "en", "s", 0),
        (None, "a b c d", "en", "s", 7),
        (7, "A b  c\td", None, "s", 7),
        (9, "a b c d", "en", None, 7),
        (9, "a b c d", "en", None, 7),
        (11, "x", "en", "s", 1),
        (12, " ".join(f"w{i}" for i in range(30000)), "en", "s", 1),
    ]
    table = docs(rows).selectExpr("*", "1 AS component_id", "'x' AS fingerprint", "2 AS id", "3 AS fp")
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash.near_duplicates(table).collect())
    assert got == [(-1, None), (3, 3), (5, 3), (7, 7), (9, 7), (9, 7), (11, 11), (12, 12)]
    kept = simhash.keep_one(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 3, 7, 11, 12]
    assert simhash.near_duplicates(table.where("false")).count() == 0
    assert simhash.keep_one(table.where("false")).count() == 0


def test_rounds_of_components_leave_one_table(spark, monkeypatch):
    """Staged tables of a round go with it; further edges only join groups."""
    from tramline.llm import graph

    staged, stage = [], graph.stage

    def keep(df, name):
        staged.append(stage(df, name))
        return staged[-1]

    monkeypatch.setattr(graph, "stage", keep)
    rows = [(i, i + 1) for i in range(1, 40) if i % 10] + [(90, 91)]
    edges = spark.createDataFrame(rows, "a long, b long").coalesce(2)
    groups = stage(graph.components(edges), "groups")

    def left(df):
        return all(os.path.exists(f.removeprefix("file:")) for f in df.inputFiles())

    assert len(staged) > 4 and sum(map(left, staged)) == 1
    assert len(staged[-1].inputFiles()) <= 5  # few edges, few tasks
    more = spark.createDataFrame([(5, 15), (38, 95), (91, 94)], "a long, b long")
    got = {r.node: r.component for r in graph.merged(groups, more).collect()}
    assert got == {i: 1 if i <= 20 else 21 if i <= 30 else 31 for i in range(1, 41)} | {95: 31, 90: 90, 91: 90, 94: 90}
