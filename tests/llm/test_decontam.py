import random
from collections import Counter

import numpy as np
import pytest
from conftest_llm import lower, words

from tramline.llm import decontam
from tramline.llm.queries import QUERIES


def parts(w, size):
    """Weighted multiset of shingles."""
    return Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def weight(s):
    return sum(len(x.encode()) for x in s)


def similarity(a, b):
    common = sum(min(n, b[s]) * weight(s) for s, n in a.items())
    return common / (sum(n * weight(s) for s, n in a.items()) + sum(n * weight(s) for s, n in b.items()) - common)


def brute(docs, items, shingle=5, least=0.8):
    """{(doc, item): (start, n_words, similarity)}; all windows of all documents."""
    out = {}
    split = {i: words(lower(t or "")) for i, t in items}
    for d, t in docs:
        w = words(lower(t or ""))
        for i, v in split.items():
            size = min(shingle, len(v))
            n = min(len(w), len(v))
            if not size or n < size:
                continue
            target = parts(v, size)
            if not any(tuple(w[k : k + size]) in target for k in range(len(w) - size + 1)):
                continue
            for k in range(len(w) - n + 1):
                s = similarity(parts(w[k : k + n], size), target)
                if s >= least and s > out.get((d, i), (0, 0, 0))[2]:
                    out[d, i] = (k, n, s)
    return out


def result(df):
    return {(r[0], r[1]): (r.start, r.n_words, pytest.approx(r.similarity)) for r in df.collect()}


def test_query_equals_brute_force(spark, sf_dir):
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()
    want = brute([(r.doc_id, r.text) for r in read("documents")], [(r.item_id, r.text) for r in read("benchmark")])
    df = QUERIES["op5_benchmark_decontamination"](spark, sf_dir)
    assert df.dtypes[:2] == [("doc_id", "bigint"), ("item_id", "bigint")]
    assert result(df) == want and want


@pytest.mark.parametrize("edits,radius", [(0, 20), (1, 20), (3, 24)])
def test_edited_passages(spark, docs, edits, radius, monkeypatch):
    rng = random.Random(edits)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice((1, 3, 4, 5, 8, 20, 60))))) for i in range(20)]
    rows = []
    for d in range(60):
        out = rng.choices(vocabulary, k=rng.randint(0, 80))
        if rng.random() < 0.6:
            passage = rng.choice(items)[1].upper().split()
            for _ in range(edits):
                passage[rng.randrange(len(passage))] = "edit"
            at = rng.randrange(len(out) + 1)
            out[at:at] = passage
        if d % 10 == 0:
            out = rng.choice(items)[1].split()[: rng.choice((7, 55))]
        rows.append((d, "  ".join(out), "en", "s", 1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute([r[:2] for r in rows], items)
    assert result(decontam.matches(docs(rows), bench, radius=radius)) == want
    monkeypatch.setattr(decontam, "INDEX_SHINGLES", 40)
    assert result(decontam.matches(docs(rows), bench, radius=radius)) == want


def test_index_finds_every_fingerprint_within_the_radius():
    """The blocks alone: values within radius // BLOCKS bits of some block."""
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = int(rng.integers(0, 2**63))
        b = a
        for bit in rng.choice(64, 20, replace=False):
            b ^= 1 << int(bit)
        width = 64 // decontam.BLOCKS
        off = [((a ^ b) >> i * width & (1 << width) - 1).bit_count() for i in range(decontam.BLOCKS)]
        assert min(off) <= 20 // decontam.BLOCKS


def test_edge_rows(spark, docs):
    text = "the quick brown fox jumps over the lazy dog and runs away from all of them"
    rows = [
        (None, text, None, None, None), (1, None, "en", "s", 1), (2, "", "en", "s", 1), (3, "x " + text, None, None, None),
        (3, "x " + text, None, None, None), (4, "clean words only here", "en", "s", 1), (5, ("filler " * 50000) + text, "en", "s", 1),
        (6, text[:20], "en", "s", 1),
    ]
    table = docs(rows).selectExpr("*", "1 AS id", "'i' AS item", "2 AS start", "3 AS size")
    bench = spark.createDataFrame([(1, text, 5), (2, None, 5), (3, "", 5), (None, text.upper(), 5)], "item_id int, text string, doc_id int")
    got = result(decontam.matches(table, bench))
    assert got == {(d, i): (s, 16, 1.0) for d, s in ((3, 1), (5, 50000)) for i in (1, None)}
    left = decontam.decontaminate(table, bench)
    assert left.columns == table.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 4, 6]
    assert decontam.matches(table.where("false"), bench).count() == 0
    assert decontam.matches(table, bench.where("false")).count() == 0
    assert decontam.decontaminate(table, bench.where("false")).count() == len(rows)
