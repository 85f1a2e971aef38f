"""The anti-join by an index of keys."""

import pytest
from pyspark.sql import functions as F

from tramline import schemas
from tramline.operators import key_index as ki
from tramline.operators.joins import new_rows
from tramline.sinks import tables as sinks
from tramline.sinks.versions import location


def staged(index):
    from tramline.session import stage

    return ki.KeyIndex(stage(index.bitmaps, "index"), index.buckets)


@pytest.mark.parametrize("buckets", [1, 7])
@pytest.mark.parametrize("unkeyed", [True, False])
def test_equal_to_the_plain_join(spark, buckets, unkeyed):
    baseline = spark.range(0, 50_000, 2).select(F.concat(F.lit("k"), "id").alias("key"))
    if unkeyed:
        baseline = baseline.unionByName(spark.sql("SELECT cast(null AS string) AS key"))
    incoming = spark.range(0, 3000).select(F.when(F.col("id") % 50 != 0, F.concat(F.lit("k"), F.col("id") * 7)).alias("key"), (F.col("id") % 3).alias("v"))
    index = staged(ki.key_index(baseline, "key", buckets))
    found = ki.new_rows_indexed(incoming, baseline, "key", index)
    assert found.columns == ["key", "v"]
    assert sorted(map(str, found.collect())) == sorted(map(str, new_rows(incoming, baseline, "key").collect()))


def test_surely_new_rows_are_not_shuffled(spark):
    baseline = spark.range(0, 100_000)
    index = staged(ki.key_index(baseline, "id", ki.buckets_for(100_000)))
    incoming = spark.range(50_000, 250_000)
    sure, maybe = ki.split_by_index(incoming, "id", index)
    plan = sure._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert sure.where("id < 100000").isEmpty()
    new = maybe.where("id >= 100000").count()
    assert 0 < new < 150_000 / ki.BITS * 1.2


def test_beyond_the_bound_the_join_is_plain(spark, monkeypatch):
    monkeypatch.setattr(ki, "MOST_BYTES", 1)
    baseline, incoming = spark.range(10), spark.range(5, 15)
    found = ki.new_rows_indexed(incoming, baseline, "id", ki.key_index(baseline, "id", 1))
    assert sorted(r.id for r in found.collect()) == list(range(10, 15))


def test_merged_indexes(spark):
    one, two = (ki.key_index(spark.range(a, a + 100), "id", 2) for a in (0, 100))
    sure, maybe = ki.split_by_index(spark.range(200), "id", staged(one.merged(two)))
    assert sure.isEmpty() and maybe.count() == 200
    empty = staged(ki.key_index(spark.range(0), "id", 2))
    sure, maybe = ki.split_by_index(spark.range(200), "id", empty)
    assert sure.count() == 200 and maybe.isEmpty()
    with pytest.raises(ValueError):
        one.merged(ki.key_index(spark.range(5), "id", 3))


def test_kept_index_is_of_the_current_content(spark, schema_name):
    table = f"{schema_name}.daily"
    rows = spark.createDataFrame([("20250101", "1", "a", 1, 1)], "service_date string, line string, name string, get_on_d int, get_off_d int")
    sinks.replace_table(rows, table, schemas.DAILY)
    assert sinks.read_key_index(spark, table, "name") is None
    sinks.replace_key_index(spark, table, "name")
    index = sinks.read_key_index(spark, table, "name")
    assert index.buckets == 1 and index.bitmaps.count() == 1
    sinks.replace_table(rows, table, schemas.DAILY)
    assert sinks.read_key_index(spark, table, "name") is None
    sinks.replace_key_index(spark, table, "name")
    assert sinks.read_key_index(spark, table, "name") is not None and location(spark, table)
