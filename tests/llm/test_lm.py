import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import lower, words
from pyspark.sql import functions as F

from tramline.llm import lm
from tramline.llm.queries import QUERIES

END = "</s>"


def tokens(text):
    return [*words(lower(text or "")), END]


class Brute:
    """The same model, from its definition."""

    def __init__(self, texts, order, share, word_share):
        self.order = order
        lists = [tokens(t) for t in texts]
        self.one = Counter(w for x in lists for w in x)
        self.n, self.v = sum(self.one.values()), len(self.one)
        self.c = Counter(tuple(x[i : i + k]) for x in lists for k in range(2, order + 1) for i in range(len(x) - k + 1))
        self.c = {g: c for g, c in self.c.items() if c >= max(share, word_share) * self.n}
        self.after = {}
        for g in self.c:
            self.after.setdefault(g[:-1], []).append(g[-1])

    def unigram(self, w):
        return (self.one[w] + 1) / (self.n + self.v + 1)

    def count(self, h):
        return self.one[h[0]] if len(h) == 1 else self.c[h]

    def p(self, w, h):
        if not h:
            return self.unigram(w)
        if (*h, w) in self.c:
            return (self.c[(*h, w)] - lm.DISCOUNT) / self.count(h)
        if h not in self.after:
            return self.p(w, h[1:])
        direct = sum((self.c[(*h, x)] - lm.DISCOUNT) / self.count(h) for x in self.after[h])
        lower_ = sum(self.p(x, h[1:]) for x in self.after[h])
        return (1 - direct) / (1 - lower_) * self.p(w, h[1:])

    def score(self, text):
        x = tokens(text)
        return sum(math.log10(self.p(w, tuple(x[max(0, i - self.order + 1) : i]))) for i, w in enumerate(x))

    def base(self, text):
        return sum(math.log10(self.unigram(w)) for w in tokens(text))


def test_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows}
    model = Brute([r.text for r in rows if not held[r.doc_id]], 3, 4e-6, 1e-6)
    got = {r.doc_id: r for r in QUERIES["op7_lm_scoring"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for r in rows:
        g, x = got[r.doc_id], tokens(r.text)
        assert (g.held_out, g.n_tokens, g.train_tokens) == (held[r.doc_id], len(x), model.n)
        assert g.n_known == sum(model.one[w] > 0 for w in x)
        assert g.base_score == pytest.approx(model.base(r.text), rel=1e-9)
    for r in rows[:40]:
        assert got[r.doc_id].score == pytest.approx(model.score(r.text), rel=1e-7)
    out = [g for g in got.values() if g.held_out]
    assert sum(g.score for g in out) > sum(g.base_score for g in out)


@pytest.mark.parametrize("order,share,word_share", [(1, 1, 0.001), (2, 0.004, 0.002), (3, 0.004, 0.001), (3, 0.02, 0.02), (4, 0.003, 0.001)])
def test_small_models(spark, docs, order, share, word_share):
    rng = np.random.default_rng(order)
    texts = [" ".join(rng.choice(list("abcdefgh"), p=[0.3, 0.2, 0.2, 0.1, 0.1, 0.05, 0.03, 0.02], size=rng.integers(0, 30))) for _ in range(60)]
    texts += ["A b C d", "zz yy a b", None, ""]
    df = docs([(i, t, None, None, None) for i, t in enumerate(texts)])
    part = df.where("doc_id % 3 <> 0")
    model = lm.train(part, order=order, share=share, word_share=word_share)
    brute = Brute([t for i, t in enumerate(texts) if i % 3], order, share, word_share)
    assert (model.n, model.v) == (brute.n, brute.v)
    for r in lm.score(model, df).collect():
        assert r.score == pytest.approx(brute.score(texts[r.doc_id]), rel=1e-9)
        assert r.base_score == pytest.approx(brute.base(texts[r.doc_id]), rel=1e-9)
    known = list(brute.one)
    for h in [(), *brute.after]:  # weights of a state add up to one
        assert sum(brute.p(w, h) for w in known) + brute.p("\0", h) == pytest.approx(1)


def test_edge_rows(spark, docs):
    table = docs([(None, "a b", None, None, None), (1, None, "en", None, 1), (2, "a b", None, "s", 1), (2, "a b", None, "s", 1), (3, "é" * 50000 + " a", "x", "s", 1)])
    table = table.selectExpr("*", "1 AS id", "2 AS h", "3 AS k", "4 AS score", "5 AS m")
    model = lm.train(table)
    got = sorted((r.doc_id or 0, r.n_tokens, r.n_known) for r in lm.score(model, table).collect())
    assert got == [(0, 3, 3), (1, 1, 1), (2, 3, 3), (2, 3, 3), (3, 3, 3)]
    assert lm.score(model, table.where("false")).count() == 0
    empty = lm.train(table.where("false"))
    assert [r.score for r in lm.score(empty, table.where("doc_id = 1")).collect()] == [0.0]

@pytest.mark.parametrize("common,positions", [(4e-6, 1 << 20), (0.02, 1 << 20), (1.0, 50)])
def test_every_ngram_is_kept(spark, docs, common, positions, monkeypatch):
    """Also rare ones in a long corpus; whether counts are broadcast or joined, scores are those of the whole model."""
    rng = np.random.default_rng(5)
    p = 1 / np.arange(1, 401)
    texts = [" ".join(f"w{x}" for x in rng.choice(400, p=p / p.sum(), size=rng.integers(0, 60))) for _ in range(120)]
    texts += ["W1 w2 zz", "zz yy w1 w2", None, "", "w7", texts[0], texts[3]]
    df = docs([(i, t, None, None, None) for i, t in enumerate(texts)] + [(3, texts[3], None, None, None), (None, "w1 w2 w3", None, None, None)])
    monkeypatch.setattr(lm, "COMMON", common)
    monkeypatch.setattr(lm, "POSITIONS", positions)
    got, model = lm.score_corpus(df, F.col("doc_id") % 3 != 0)
    brute = Brute([t for i, t in enumerate(texts) if i % 3], 3, 0, 0)
    assert (model.n, model.v) == (brute.n, brute.v)
    rows = got.collect()
    assert sorted(r.doc_id or 0 for r in rows) == sorted([*range(len(texts)), 3, 0])
    for r in rows:
        text = "w1 w2 w3" if r.doc_id is None else texts[r.doc_id]
        assert r.score == pytest.approx(brute.score(text), rel=1e-9)
        assert r.base_score == pytest.approx(brute.base(text), rel=1e-9)
        assert r.n_known == sum(brute.one[w] > 0 for w in tokens(text))
    for empty in (df.where("false"), df.where("doc_id = 0")):
        found, model = lm.score_corpus(empty, F.col("doc_id") % 3 != 0)
        assert model.n == 0 and all(r.score == 0 for r in found.collect())


def test_the_model_of_the_query_grows_with_the_corpus(spark, tmp_path):
    """An n-gram that occurs twice in 600,000 tokens, below any share of them that was kept before, has its arc."""
    rng = np.random.default_rng(6)
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 7 != 2][:601]
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 900, 1000))) for i in ids[:600]]
    held = next(i for i in range(3000, 9000) if zlib.crc32(str(i).encode()) % 7 == 2)
    rows += [(ids[600], "w1 w2 w3 w4 w5 w6 w7 w8"), (held, "w1 w2 w3 w4 w5 w6 w7 w8")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op7_lm_scoring"](spark, str(tmp_path)).collect()}
    brute = Brute([t for i, t in rows if i != held], 3, 0, 0)
    assert got[held].score == pytest.approx(brute.score(rows[-1][1]), rel=1e-9)


def test_dealing_places_takes_little_memory():
    """Twice as much text as a slice of the automaton, in one batch."""
    import tracemalloc

    rng = np.random.default_rng(1)
    words = np.array([f"w{i}" for i in range(5000)])
    texts = [" ".join(words[rng.integers(0, 5000, 1000)]) for _ in range(2800)]
    n = len(texts)
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(n)), "t": texts, "learn": [True] * n, "h": pa.array(range(n))})
    assert batch.column("t").nbytes > 16_000_000
    none = lm.Counts.of(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    tracemalloc.start()
    places = sum(len(w) for b in lm._places(iter([batch]), {"pairs": none, "triples": none}, 8, 0) for w in b.column("w"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0 < places < 2 * n * 1001 / lm.PASSES
    assert peak < 150_000_000


def test_each_turn_settles_its_histories():
    """Places of a word before are all of one turn, so nothing of a turn need wait for another one."""
    texts = ["a b c a b d", "b a", "c", None, "d d d a b c"]
    column = {"id": pa.array(range(5)), "t": pa.array(texts), "learn": [True] * 5, "h": pa.array(range(5))}
    none = lm.Counts.of(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    before, places = [], 0
    for turn in range(lm.PASSES):
        out = list(lm._places(iter([pa.RecordBatch.from_pydict(column)]), {"pairs": none, "triples": none}, 8, turn))
        places += sum(len(w) for r in out for w in r.column("w"))
        before.append({int(b) for r in out for b in r.column("b").values.to_pylist()} - {0})
    assert places == sum(len(tokens(t)) for t in texts)
    assert sum(map(len, before)) == len(set.union(*before)) == 4


def _one_group(texts, learn, hot=()):
    """Kinds of rows that all groups of all turns hand on when one group has all places, and the rows with sums."""
    column = {"id": pa.array(range(len(texts))), "t": pa.array(texts, pa.string()), "learn": learn, "h": pa.array(range(len(texts)))}
    batch = pa.RecordBatch.from_pydict(column)
    h, first = lm.tokens(batch.column("t"))
    taught = np.repeat(learn, np.diff(first))
    of = lm.Counts.of(*np.unique(h[taught], return_counts=True))
    none = lm.Counts.of(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    is_hot = np.isin(of.keys, [int(h[x]) for x in hot])
    common = {"words": of, "hot": lm.Counts(of.keys[is_hot], of.counts[is_hot]), "pairs": none, "triples": none, "all": float(sum(taught) + len(of.keys) + 1)}
    kinds, sums = [], []
    for turn in range(lm.PASSES):
        table = pa.Table.from_batches(lm._packed(lm._places(iter([batch]), common, 1, turn)))
        found = lm._arcs(table, common).to_pylist()
        kinds += [r["kind"] for r in found]
        sums += [r for r in found if r["kind"] == lm.SUMS and r["ts"]]
    return kinds, sums


def test_a_group_settles_its_words():
    """Arcs and failure arcs after a word that is not hot leave its group as one row of sums a slice, not as rows of places or histories."""
    texts = ["a b c a b d", "b a c", "a b a c d", "d d d a b c", "a c b zz a b a", None]
    learn = [True, True, True, True, False, False]
    kinds, sums = _one_group(texts, learn)
    assert set(kinds) == {lm.SUMS, lm.NAMES, lm.ASK_W}  # ASK_W: places of words that no training text has
    assert len(sums) <= lm.PASSES
    kinds, _ = _one_group(texts, learn, hot=(0, 1))
    assert {lm.STATE, lm.HOT_FOLLOWERS, lm.ASK_P} <= set(kinds)


@pytest.mark.parametrize("common,positions", [(0.02, 50), (0.002, 400), (4e-6, 1)])
def test_hot_words_have_the_same_scores(spark, docs, common, positions, monkeypatch):
    """Words that fill groups, common bigrams and trigrams of such words, rare followers, and words of held-out texts alone."""
    rng = np.random.default_rng(8)
    p = 1 / np.arange(1, 301)
    texts = [" ".join(f"w{x}" for x in rng.choice(300, p=p / p.sum(), size=rng.integers(0, 50))) for _ in range(120)]
    texts += ["w0 w1 w2 w0 w1 w2", "zz w0 zz w1 w0", "zz zz zz", None, "", texts[0], texts[3]]
    df = docs([(i, t, None, None, None) for i, t in enumerate(texts)] + [(3, texts[3], None, None, None), (None, "w1 w2 w3", None, None, None)])
    monkeypatch.setattr(lm, "COMMON", common)
    monkeypatch.setattr(lm, "POSITIONS", positions)
    got, model = lm.score_corpus(df, F.col("doc_id") % 3 != 0)
    brute = Brute([t for i, t in enumerate(texts) if i % 3], 3, 0, 0)
    rows = got.collect()
    assert sorted(r.doc_id or 0 for r in rows) == sorted([*range(len(texts)), 3, 0])
    for r in rows:
        text = "w1 w2 w3" if r.doc_id is None else texts[r.doc_id]
        assert r.score == pytest.approx(brute.score(text), rel=1e-9)
        assert r.base_score == pytest.approx(brute.base(text), rel=1e-9)
        assert (r.n_tokens, r.n_known) == (len(tokens(text)), sum(brute.one[w] > 0 for w in tokens(text)))
