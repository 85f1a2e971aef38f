"""Physical plans and properties of the registered queries."""

import pytest
from compare import physical_plan
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tramline import workloads

QUERIES = {name: query for name, query in queries().items() if name in workloads.QUERIES}


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    built = {}

    def plan(name):
        if name not in built:
            built[name] = physical_plan(QUERIES[name](spark, sf_dir))
        return built[name]

    return plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_rows_without_a_key(plans, name):
    assert "NestedLoopJoin" not in plans(name) and "CartesianProduct" not in plans(name)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"page_text_extract", "event_full_load", "event_incremental_load"}))
def test_only_page_texts_use_python(plans, name):
    assert "Python" not in plans(name) and "Pandas" not in plans(name)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("hourly_disaggregate", "l_orderkey:bigint,l_linenumber:int,l_quantity:double>"),
        ("distinct_pairs", "l_partkey:bigint,l_suppkey:bigint>"),
        ("keyed_update", "doc_id:bigint,lang:string,source:string>"),
        ("page_enrich", "doc_id:bigint,lang:string,source:string>"),
        ("load_completeness", "l_orderkey:bigint,"),
    ],
)
def test_scans_read_only_what_is_used(plans, name, columns):
    assert f"ReadSchema: struct<{columns}" in plans(name)


def test_date_filter_reaches_the_scan(plans):
    assert "GreaterThanOrEqual(o_orderdate,1998-07-15" in plans("active_filter")


def test_one_shuffle_for_the_hourly_profile(plans):
    assert plans("hourly_melt").count("Exchange") == 1


def test_narrow_queries_do_not_shuffle(plans):
    for name in ("calendar_features", "batch_calendar", "name_normalize", "numeric_coerce", "alt_pick",
                 "request_batch", "json_extract", "daily_refine", "hash_split", "page_text_extract"):
        assert "Exchange" not in plans(name), name


def test_anti_join_is_an_equi_join(plans):
    assert "LeftAnti" in plans("new_rows_anti")


def test_hourly_shares_add_up(spark, sf_dir):
    shares = QUERIES["usage_ratio"](spark, sf_dir)
    sums = shares.groupBy("use_month", "name").agg(F.sum("usage_ratio").alias("s"))
    assert sums.where("abs(s - 1) > 1e-6").count() == 0


def test_candidates_are_not_in_the_baseline(spark, sf_dir):
    new = QUERIES["incremental_candidates"](spark, sf_dir)
    known = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.concat(F.lit("https://events.example/"), "l_orderkey").alias("homepage")
    )
    assert new.join(known, "homepage").count() == 0
