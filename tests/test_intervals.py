"""Gaps and overlaps against a count of every number."""

import random

from tramline.operators.intervals import coverage_faults


def faults(spark, ranges):
    df = spark.createDataFrame(ranges, "folder string, first long, last long, total long")
    return sorted(tuple(r) for r in coverage_faults(df, "folder", "first", "last", "total").collect())


def test_a_missing_page_with_a_repeated_one(spark):
    pages = [("d", 1, 10, 30), ("d", 11, 20, 30), ("d", 11, 20, 30)]
    assert faults(spark, pages) == [("d", "gap", 21, 30), ("d", "overlap", 11, 20)]


def test_edge_ranges(spark):
    pages = [("a", 1, 5, 5), ("b", None, None, 3), ("c", 5, 4, 2), ("d", 2, 9, 4), ("e", 1, 1, None), ("f", None, None, None), ("f", 0, 0, 0)]
    assert faults(spark, pages) == [("b", "gap", 1, 3), ("c", "gap", 1, 2), ("d", "gap", 1, 1)]


def test_random_ranges(spark):
    rng = random.Random(1)
    pages, want = [], []
    for folder in range(40):
        total, covered, seen = rng.randint(1, 30), [], 0
        for a in sorted(rng.sample(range(1, 31), rng.randint(0, 6))):
            covered.append((a, a + rng.randint(0, 6)))
        pages += [(str(folder), a, b, total) for a, b in covered] or [(str(folder), None, None, total)]
        numbers = {n for a, b in covered for n in range(a, b + 1)}
        want.append({n for n in range(1, max([total, *(a for a, _ in covered)]) + 1)} - numbers)
    got = [set() for _ in want]
    for folder, fault, a, b in faults(spark, pages):
        if fault == "gap":
            got[int(folder)] |= set(range(a, b + 1))
    assert got == want
