import hashlib
import random
import zlib

import numpy as np
import pytest
from conftest_llm import words

from tramline.llm import periods
from tramline.llm.queries import QUERIES


def brute(w, least=12):
    """[(start, length, period)]: for every period all stretches that agree with themselves that much later."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        t = 0
        while t + q < len(w):
            s = t
            while t + q < len(w) and w[t] == w[t + q]:
                t += 1
            if t - s >= q and t - s + q >= least:
                found.setdefault((s, t - s + q), q)
            t += t == s
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def changed(i, text):
    w, h = words(text), zlib.crc32(str(i).encode())
    if h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (j - a) % p] for j in range(a, n)]
    return w


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    df = QUERIES["op13_periodic_runs"](spark, sf_dir)
    assert dict(df.dtypes) == {
        "doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
        "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string",
    }
    want = set()
    for r in rows:
        w = changed(r.doc_id, r.text)
        numbers = {}
        codes = [numbers.setdefault(x, len(numbers)) for x in w]
        runs = brute_numpy(np.array(codes, np.int64))
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        milli = 1000 * best[1] // best[2] if runs else None
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.add((r.doc_id, len(runs), *best, milli, sha(listed), sha(collapsed(w, runs))))
    assert {tuple(r) for r in df.collect()} == want
    assert sum(x[1] > 0 for x in want) > len(rows) // 20


def brute_numpy(w, least=12):
    """As ``brute``, a period at a time."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        same = np.concatenate([[False], w[q:] == w[:-q], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for s, t in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if t - s >= q and t - s + q >= least:
                found.setdefault((s, t - s + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def some_words(rng):
    kind = rng.randrange(5)
    if kind == 0:
        return [rng.randint(0, rng.choice((0, 1, 2))) for _ in range(rng.randint(0, 60))]
    if kind == 1:
        return fibonacci(rng.randint(1, 120))
    if kind == 2:  # one alternation against another, shifted
        return [0, 1] * rng.randint(1, 20) + [0] * rng.randint(1, 3) + [0, 1] * rng.randint(1, 20) + [1, 0] * rng.randint(0, 9)
    if kind == 3:
        base = [rng.randint(0, 50) for _ in range(rng.randint(1, 40))]
        w = (base * 4)[: rng.randint(1, 150)]
        w[rng.randrange(len(w))] = rng.choice((99, w[0]))
        return w
    w = []
    for _ in range(rng.randint(1, 4)):
        w += [rng.randint(0, 1) for _ in range(rng.randint(1, 9))] * rng.randint(1, 8)
        w = w[: len(w) - rng.randint(0, 3)]
    return w


@pytest.mark.parametrize("least", [2, 4, 12])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(500):
        texts = [some_words(rng) for _ in range(rng.randint(1, 4))]
        flat = np.array([x for t in texts for x in t], np.int64)
        row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        start, end, period = periods.find_runs(flat, row, least)
        begin, want = 0, []
        for t in texts:
            want += [(s + begin, n, q) for s, n, q in brute(t, least)]
            begin += len(t)
        assert list(zip(start.tolist(), (end - start).tolist(), period.tolist())) == want


def test_proposals_stay_few():
    n = 1 << 16
    for w in ([0] * n, [0, 1] * (n // 4) + [0] + [0, 1] * (n // 4), fibonacci(n)):
        w = np.array(w, np.int64)
        for k, (_, places, named) in enumerate(periods.factors(w, np.zeros(len(w), np.int64))):
            assert len(periods.proposals(places, named, 1 << k)[0]) <= 3 * len(w)


def test_edge_rows(spark, docs):
    cycle = " ".join(["a", "b", "c"] * 5)
    long = " ".join(f"w{i % 1000}" for i in range(100_000))
    rows = [
        (None, cycle, None, None, None), (1, None, "en", "s", 1), (2, " \n\t", "en", "s", 1), (3, "x\n" + cycle + "\ty é", "en", "s", 1),
        (3, "x\n" + cycle + "\ty é", "en", "s", 1), (4, "é " * 12, "en", "s", 1), (5, "é " * 11, "en", "s", 1), (6, long, "en", "s", 1),
    ]
    table = docs(rows).selectExpr("*", "1 AS id", "2 AS t", "3 AS runs", "4 AS collapsed", "5 AS n_words")
    out = periods.periodic_runs(table)
    assert out.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect())
    three = (3, 18, [(1, 15, 3)], "x a b c y é")
    first = " ".join(f"w{i}" for i in range(1000))
    assert got == [
        (0, 15, [(0, 15, 3)], "a b c"), (1, 0, [], ""), (2, 0, [], ""), three, three,
        (4, 12, [(0, 12, 1)], "é"), (5, 11, [], " ".join(["é"] * 11)), (6, 100_000, [(0, 100_000, 1000)], first),
    ]
    assert periods.periodic_runs(table.where("false")).count() == 0
