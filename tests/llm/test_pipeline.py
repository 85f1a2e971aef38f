"""The pipeline against brute force, stage by stage, each on its own input."""

import pytest
from test_decontam import brute as brute_matches
from test_lines import brute as brute_lines
from test_packing import check as check_packing
from test_simhash import brute_components, brute_fingerprint

import corpus_pipeline
from __spark_entry__ import queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """Input and output rows of each stage, written and read in between."""
    from tramline.session import stage

    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, function in corpus_pipeline.STAGES:
        result = stage(function(spark, docs, sf_dir), name)
        out[name] = (docs.collect(), result.collect(), result.columns)
        docs = result
    return out


def test_stages(steps):
    assert list(steps) == ["language_id", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    assert all(steps[name][2] == COLUMNS for name in list(steps)[:-1])


def test_language_id_keeps_documents_with_a_language(steps):
    before, after, _ = steps["language_id"]
    kept = {r.doc_id for r in after}
    assert kept == {r.doc_id for r in before if any(c.isalpha() for c in r.text or "")}


def test_line_dedup(spark, steps):
    before, after, _ = steps["line_dedup"]
    want = brute_lines(spark, [(r.doc_id, r.text) for r in before])
    assert {r.doc_id: r.text for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after)


def test_one_document_of_each_group(steps):
    before, after, _ = steps["simhash_near_dedup"]
    groups = brute_components({r.doc_id: brute_fingerprint(r.text) for r in before})
    assert sorted(after) == sorted(r for r in before if groups[r.doc_id] == r.doc_id)


def test_decontamination(spark, sf_dir, steps):
    before, after, _ = steps["benchmark_decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hit = {d for d, _ in brute_matches([(r.doc_id, r.text) for r in before], items)}
    assert sorted(after) == sorted(r for r in before if r.doc_id not in hit)


def test_packing(steps):
    before, after, _ = steps["best_fit_packing"]
    n = check_packing(after, {r.doc_id: r.text for r in before})
    assert n <= sum(r.length for r in after) / 1024 * 1.02 + 2


def test_run_is_the_registered_query(spark, sf_dir, steps):
    got = queries()["pipeline"](spark, sf_dir)
    assert sorted(r[:5] for r in got.collect()) == sorted(r[:5] for r in steps["best_fit_packing"][1])


def test_odd_rows_go_through(spark, sf_dir, docs):
    rows = [
        (None, "alpha beta gamma delta", None, None, None), (1, None, "en", "s", 1), (2, "", "en", "s", 1),
        (3, "the cat sat on the mat", "en", "s", 1), (3, "the cat sat on the mat", "en", "s", 1),
        (4, "der hund liegt auf der matte", "de", None, None), (5, "word " * 20000, "en", "s", 1), (6, "123 456", None, "s", 1),
    ]
    odd = docs(rows).selectExpr("*", "1 AS id", "'x' AS node", "2 AS __language0", "7 AS language", "8 AS __language", "9 AS known", "10 AS __score", "11 AS gone", "3 AS piece", "4 AS fp", "5 AS t")
    for table in (odd, odd.where("false")):
        current = table
        for name, function in corpus_pipeline.STAGES:
            current = function(spark, current, sf_dir)
            if name != "best_fit_packing":
                assert current.columns == odd.columns
        ids = {r.doc_id for r in current.collect()}
        assert ids == ({None, 3, 4, 5} if table is odd else set())
