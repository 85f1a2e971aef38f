import zlib

import numpy as np
import pytest

from tramline.llm import langid
from tramline.llm.queries import QUERIES


def grams(text, degree, alphabet):
    """Distinct n-grams over letters of the alphabet and breaks, but the break alone."""
    s = ["".join(c if c in alphabet else "?" if c.isalpha() else " ") for c in text.lower()]
    out = {"".join(s[i : i + n]) for n in range(1, degree + 1) for i in range(len(s) - n + 1)}
    return {g for g in out if "?" not in g and g != " "}


def brute(texts, labels, degree, landmarks, ridge, asked):
    """Predictions of the same model by sets and full matrices."""
    languages = sorted(set(labels))
    seen, order = {}, []
    for i, label in enumerate(labels):
        order.append((seen.get(label, 0), label, i))
        seen[label] = seen.get(label, 0) + 1
    marks = [texts[i] for *_, i in sorted(order)[:landmarks]]
    alphabet = {c for t in marks for c in t.lower() if c.isalpha()}
    basis = [grams(t, degree, alphabet) for t in marks]
    every = set().union(*basis)

    def row(t):
        g = grams(t, degree, alphabet) & every
        return np.array([len(g & b) / np.sqrt(max(len(g), 1) * len(b)) for b in basis])

    k = np.array([row(t) for t in marks])
    value, vector = np.linalg.eigh(k)
    half = vector[:, value > 1e-8] / np.sqrt(value[value > 1e-8])
    phi = np.hstack([np.array([row(t) for t in texts]) @ half, np.ones((len(texts), 1))])
    y = np.array([[1.0 if a == b else -1.0 for b in languages] for a in labels])
    d = np.diag([1 / (len(languages) * labels.count(a)) for a in labels])
    penalty = ridge * np.eye(phi.shape[1])
    penalty[-1, -1] = 1e-9
    w = np.linalg.solve(phi.T @ d @ phi + penalty, phi.T @ d @ y)
    score = np.hstack([np.array([row(t) for t in asked]) @ half, np.ones((len(asked), 1))]) @ w
    return [languages[i] for i in score.argmax(axis=1)], np.clip((score.max(axis=1) + 1) / 2, 0, 1)


def test_query_on_held_out_rows(spark, sf_dir):
    rows = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    df = QUERIES["op3_language_id"](spark, sf_dir)
    assert df.dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    got = {r.doc_id: r for r in df.collect()}
    assert got.keys() == rows.keys()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1
    asked = [r for i, r in got.items() if r.held_out and rows[i].lang and any(c.isalpha() for c in rows[i].text or "")]
    assert sum(r.lang_pred == rows[r.doc_id].lang for r in asked) >= 0.95 * len(asked)


@pytest.mark.parametrize("degree,landmarks", [(1, 4), (2, 6), (3, 10), (4, 100)])
def test_model_equals_sets(degree, landmarks):
    rng = np.random.default_rng(degree)
    source = {"x": list("abcdé "), "y": list("bcdeß. "), "z": list("xyzabÄ7")}
    labels = [str(rng.choice(list(source))) for _ in range(60)]
    texts = ["".join(rng.choice(source[a], size=rng.integers(5, 40))) + "a" for a in labels]
    asked = texts[:20] + ["abc ÄÖ 日本 xyz", "a", "q"]
    model = langid.fit(texts, labels, degree, landmarks, 0.01)
    found, score = model.predict(asked)
    want, want_score = brute(texts, labels, degree, landmarks, 0.01, asked)
    assert score == pytest.approx(want_score, abs=1e-4)
    assert [a for a, s in zip(found, score, strict=True) if s > 0.501] == [a for a, s in zip(want, score, strict=True) if s > 0.501]


def test_edge_rows(spark, docs):
    rows = [(i, t, a, "s", 1) for i, (t, a) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 5)]
    rows += [
        (None, "the dog", None, None, None), (20, None, "en", "s", 1), (21, "", "de", "s", 1), (22, "12 ... !", "en", "s", 1),
        (23, "the cat " * 30000, "en", "s", 1), (24, "日本語", None, "s", 1), (25, "und die", None, "s", 1), (25, "und die", None, "s", 1),
    ]
    table = docs(rows).selectExpr("*", "1 AS t", "2 AS h", "3 AS i", "'q' AS score0", "array(1) AS c0")
    model = langid.train(table)
    out = langid.classify(table, model)
    assert out.columns == [*table.columns, "lang_pred", "score"]
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert [x for x, _ in got[None]] == ["en"] and [x for x, _ in got[25]] == ["de", "de"]
    assert got[20] == got[21] == got[22] == [("und", 0.0)]
    assert got[23][0][0] == "en" and got[24][0][0] in ("en", "de")
    none = langid.train(table.where("false"))
    assert {r.lang_pred for r in langid.classify(table, none).collect()} == {"und"}
    assert langid.classify(table.where("false"), model).count() == 0


def test_pipeline_rejects_junk_and_unlearned_scripts(spark, sf_dir, docs):
    import corpus_pipeline

    rng = np.random.default_rng(5)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    junk = [" ".join("".join(rng.choice(list("qxzjkvwpy"), size=7)) for _ in range(40)), "日本語の文章 " * 20, "это русский текст " * 20]
    planted = table.union(docs([(-1 - i, t, None, "s", len(t)) for i, t in enumerate(junk)]))
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, planted, sf_dir).collect()}
    assert not kept & {-1, -2, -3}
    assert kept == {r.doc_id for r in table.collect() if any(c.isalpha() for c in r.text or "")}
