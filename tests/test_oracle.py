"""Every registered query against its SQL twin."""

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from tramline import workloads

# The training-data operators have tests of their own.
QUERIES = {name: query for name, query in queries().items() if name in workloads.QUERIES}
SQL = {name: sql for name, sql in oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_only_the_model_lacks_a_twin():
    assert set(QUERIES) - set(SQL) == {"rf_forecast"}
    assert not set(SQL) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["line", "name", "date", "hour", "predicted_total"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["hourly_forecast_rollup", "weather_refine", "new_rows_anti", "hash_split"])
def test_result_does_not_depend_on_partitions(spark, con, sf_dir, name):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert differences(QUERIES[name](spark, sf_dir), con, SQL[name]) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_joins_give_the_same_results(spark, sf_dir, monkeypatch, how):
    """A third of all orders on one customer: its rows are dealt over slices, and the join is the plain one."""
    from tramline.operators import skew

    found = []
    shares = skew.hot_key_shares
    monkeypatch.setattr(skew, "hot_key_shares", lambda *a: found.append(shares(*a)) or found[-1])
    key = F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", key.alias("c_custkey"))
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name").where("c_custkey % 2 = 1")
    salted = skew.spread_join(orders, customers, ["c_custkey"], how, slices=True)
    plain = skew.spread_join(orders, customers, ["c_custkey"], how)
    assert salted.columns == plain.columns
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))
    assert len(found) == 1 and len(found[0]) == 1 and 0.3 < next(iter(found[0].values())) < 0.4
    assert "_slice" in salted._jdf.queryExecution().analyzed().toString()
