import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from compare import connect, differences

from tramline.llm import codes
from tramline.llm.queries import QUERIES, SQL


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Plain rounds over Python integers: ([(codes, error)], codebooks) for (id, vector) rows in id order."""
    whole = [[math.floor(x) * scale if abs(x) >= 2**53 else math.floor(x * scale) for x in v] for _, v in rows]
    w = len(whole[0]) // parts
    cut = [[v[k * w : k * w + w] for k in range(parts)] for v in whole]
    books = [[cut[i][k] for i in range(min(entries, len(cut)))] for k in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for k, book in enumerate(books):
            mine = defaultdict(list)
            for v in cut:
                mine[nearest(v[k], book)[1]].append(v[k])
            books[k] = [[sum(col) // len(mine[e]) for col in zip(*mine[e])] if e in mine else c for e, c in enumerate(book)]
    out = []
    for v in cut:
        found = [nearest(v[k], books[k]) for k in range(parts)]
        out.append(([e for _, e in found], sum(d for d, _ in found)))
    return out, [[tuple(c) for c in book] for book in books]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def compare(spark, rows, **how):
    found, books = codes.compress(frame(spark, rows), **how)
    kept = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want, want_books = brute(kept, **how)
    assert books == want_books
    got = sorted((r.vec_id is None, r.vec_id or 0, r.codes, r.error) for r in found.collect())
    assert got == sorted((i is None, i or 0, c, e if e < 2**63 else None) for (i, _), (c, e) in zip(kept, want))


def test_query_equals_sql(spark, sf_dir):
    assert differences(QUERIES["op12_vector_codes"](spark, sf_dir), connect(sf_dir), SQL["op12_vector_codes"]) is None


def test_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    want, books = brute([(r.vec_id, r.embedding) for r in rows])
    label = defaultdict(int)
    for r, (_, e) in zip(rows, want):
        label[r.label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    df = QUERIES["op12_vector_codes"](spark, sf_dir)
    assert df.dtypes == [("vec_id", "bigint"), ("code", "string"), ("error", "bigint"), ("label_error", "bigint"), ("codebooks_sha256", "string")]
    got = sorted(tuple(r) for r in df.collect())
    assert got == [(r.vec_id, "".join(f"{e:02x}" for e in c), d, label[r.label], digest) for r, (c, d) in zip(rows, want)]


@pytest.mark.parametrize("block,leaf", [(4096, 64), (50, 3), (7, 1)])
def test_any_trees_give_the_same(spark, block, leaf, monkeypatch):
    monkeypatch.setattr(codes, "BLOCK", block)
    monkeypatch.setattr(codes, "LEAF", leaf)
    rng = random.Random(block)
    centres = [[rng.uniform(-1, 1) for _ in range(8)] for _ in range(5)]
    rows = []
    for i in range(300):
        if i % 3:
            v = [c + rng.gauss(0, 0.01) for c in rng.choice(centres)]
        else:  # ties: few distinct values
            v = [rng.choice((-0.5, 0.0, 0.5)) for _ in range(8)]
        rows.append((i, v))
    compare(spark, rows + rows[:40], parts=4, entries=6, rounds=4)


def test_owned_balls_are_not_opened(monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 1000, (8, 4))
    points = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(0, 2, (800, 4))).astype(np.int64)
    monkeypatch.setattr(codes, "LEAF", 4)
    tree = codes.Tree(points)
    assert sorted(tree.order.tolist()) == list(range(800))
    sums, counts, chosen = codes.assign(tree, points, np.floor(centres).astype(np.int64))
    assert (chosen == -1).all() and counts.tolist() == [100] * 8
    assert (sums.astype(np.int64) == points.reshape(8, 100, 4).sum(axis=1)).all()
    balls = sum(len(b) for b, _ in codes.walk(tree, np.floor(centres).astype(np.int64)))
    assert balls < 60  # of over 200 leaves


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    good = [(None, [0.5] * 4), (3, [0.1, -0.2, 0.3, 1e-9]), (3, [0.1, -0.2, 0.3, 1e-9]), (3, [9.0, 0.0, -0.0, 1.0]), (-7, [0.0] * 4)]
    bad = [(1, None), (2, [1.0, None, 0.0, 0.0]), (4, [inf, 0.0, 0.0, 0.0]), (5, [nan] * 4), (6, []), (8, [1.0] * 8), (9, [1.0])]
    table = frame(spark, good + bad).selectExpr("*", "1 AS id", "2 AS v", "'t' AS tree", "3 AS codes", "4 AS k0")
    found, books = codes.compress(table, parts=2, entries=3, rounds=2)
    assert found.columns == ["vec_id", "codes", "error"]
    kept = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want, want_books = brute(kept, 2, 3, 2)
    assert books == want_books and found.count() == len(good)
    assert sorted(r.error for r in found.collect()) == sorted(e for _, e in want)
    found, books = codes.compress(table.where("false"), parts=2)
    assert found.count() == 0 and books == [[], []]


def test_huge_components(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice((-1, 1)) * 10.0 ** rng.choice((0, 9, 30, 200, 308)) * rng.random() for _ in range(4)]) for i in range(40)]
    compare(spark, rows, parts=2, entries=4, rounds=3)
    compare(spark, [(i, [x * 1e9 for x in (i, -i, i % 3, 7)]) for i in range(30)], parts=2, entries=4, rounds=3)
