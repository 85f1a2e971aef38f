import datetime as dt
import random

import pytest
from compare import physical_plan
from pyspark.sql import functions as F

from tramline.operators import aggregates, ids, joins, labels, reshape, skew
from tramline.operators.dedup import keep_first, union_keep_first
from tramline.operators.filters import still_running, without_value
from tramline.operators.ids import assign_ids


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])


def test_filters(spark):
    day = dt.date(2025, 4, 17)
    df = spark.createDataFrame(
        [(1, dt.date(2025, 4, 16)), (2, day), (3, dt.date(2025, 4, 18)), (4, None)], "i int, e date"
    )
    assert [r.i for r in still_running(df, "e", day).collect()] == [2, 3]
    df = spark.createDataFrame([("a",), (None,), ("정보없음",)], "x string")
    assert rows(without_value(df, "x", "정보없음")) == [("a",), (None,)]


def test_sum_by_drops_null_keys_and_sums_nothing_to_zero(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", None), ("b", None), (None, 5)], "k string, v int"
    )
    assert rows(aggregates.sum_by(df, ["k"], ["v"])) == [("a", 1), ("b", 0)]


def test_hourly_share(spark):
    df = spark.createDataFrame(
        [("202404", "A역", 8, 10), ("202404", "A역", 8, 20), ("202404", "A역", 9, 70),
         ("202404", "B역", 8, 0), ("202405", "A역", 8, 5)],
        "use_month string, name string, hour int, total int",
    )
    shares = {(r.use_month, r.name, r.hour): r.usage_ratio for r in aggregates.hourly_share(df).collect()}
    assert shares == {
        ("202404", "A역", 8): 0.3, ("202404", "A역", 9): 0.7,
        ("202404", "B역", 8): None, ("202405", "A역", 8): 1.0,
    }


def test_next_number(spark):
    assert aggregates.next_number(spark.createDataFrame([(3,), (7,)], "b long"), "b").first()[0] == 8
    assert aggregates.next_number(spark.createDataFrame([], "b long"), "b").first()[0] == 1


def test_r2(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.5), (3.0, 2.5), (None, 1.0)], "y double, p double")
    assert aggregates.r2_score(df, "y", "p").first()[0] == pytest.approx(0.75)
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, p double")
    assert aggregates.r2_score(flat, "y", "p").first()[0] is None


def test_union_keep_first(spark):
    ddl = "service_date string, line string, name string, get_on_d int"
    monthly = spark.createDataFrame(
        [("20250401", "1", "A", 9), ("20250401", "1", "A", 8), (None, "1", "A", 5)], ddl
    )
    daily = spark.createDataFrame(
        [("20250401", "1", "A", 1), ("20250402", "1", "A", 2), (None, "1", "A", 1)], ddl
    )
    keys = ["service_date", "line", "name"]
    merged = union_keep_first([monthly, daily], keys, ["get_on_d"])
    expected = [("20250401", "1", "A", 8), ("20250402", "1", "A", 2), (None, "1", "A", 5)]
    assert rows(merged) == expected
    assert rows(union_keep_first([merged], keys, ["get_on_d"])) == expected


def test_union_fills_missing_columns(spark):
    left = spark.createDataFrame([(1, "a")], "k int, x string")
    right = spark.createDataFrame([(2, "b")], "k int, y string")
    merged = union_keep_first([left, right], ["k"], []).collect()
    assert {(r.k, r.x, r.y) for r in merged} == {(1, "a", None), (2, None, "b")}


def test_keep_first_shrinks_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    first = keep_first(df, ["k"], ["id"])
    assert rows(first) == [(0, 0), (1, 1), (2, 2)]
    plan = physical_plan(first)
    assert plan.index("Exchange") < plan.index("partial_min")


def test_keep_first_breaks_ties_by_the_rest(spark):
    df = spark.createDataFrame([("a", 1, "y"), ("a", 1, "x"), ("a", 2, "w")], "k string, o int, v string")
    assert rows(keep_first(df, ["k"], ["o"])) == [("a", 1, "x")]
    assert rows(keep_first(df.select("k"), ["k"], [])) == [("a",)]


@pytest.mark.parametrize("partitions", [1, 8])
def test_assign_ids_counts_from_one_in_order(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        values = list(range(5000))
        random.Random(1).shuffle(values)
        df = spark.createDataFrame([(v, v // 7) for v in values], "v int, g int").repartition(5)
        found = assign_ids(df, ["g", F.desc("v")], "n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected = sorted(values, key=lambda v: (v // 7, -v))
    assert [r.v for r in sorted(found, key=lambda r: r.n)] == expected
    assert sorted(r.n for r in found) == list(range(1, 5001))


def test_assign_ids_splits_a_group_of_equal_rows(spark, monkeypatch):
    placed = []
    stage = ids.stage
    monkeypatch.setattr(ids, "stage", lambda *a: placed.append(stage(*a)) or placed[0])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        key = F.when(F.col("id") % 10 < 7, 1).otherwise(F.col("id"))
        found = assign_ids(spark.range(0, 20_000, 1, 20).select(key.alias("k")), ["k"], "n").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(r.n for r in found) == list(range(1, 20_001))
    part = F.shiftright("_place", ids.PLACE_BITS)
    sizes = [r["count"] for r in placed[0].where("k = 1").groupBy(part).count().collect()]
    assert sum(sizes) == 14_000 and len(sizes) >= 4 and max(sizes) < 7_000


def test_assign_ids_of_nothing(spark):
    assert assign_ids(spark.createDataFrame([], "k int"), ["k"]).collect() == []


def test_new_rows_null_safe(spark):
    incoming = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "homepage string, i int")
    with_null = spark.createDataFrame([("a",), ("a",), (None,)], "homepage string")
    without = spark.createDataFrame([("a",)], "homepage string")
    assert rows(joins.new_rows(incoming, with_null, "homepage")) == [("b", 2)]
    assert rows(joins.new_rows(incoming, without, "homepage")) == [("b", 2), (None, 3)]
    assert joins.new_rows(incoming, incoming, "homepage").count() == 0


def test_keyed_update(spark):
    df = spark.createDataFrame([(1, "x", "o1"), (2, "y", "o2"), (3, "z", "o3")], "k long, a string, d string")
    updates = spark.createDataFrame([(1, "new"), (2, None), (9, "lost")], "k long, t string")
    changed = joins.keyed_update(df, updates, "k", "d", "t")
    assert changed.columns == ["k", "a", "d"]
    assert rows(changed) == [(1, "x", "new"), (2, "y", None), (3, "z", "o3")]


def test_lookup_with_default(spark):
    df = spark.createDataFrame([("u",), ("v",), (None,)], "url string")
    table = spark.createDataFrame([("u", "text"), ("w", "other")], "url string, alt string")
    found = joins.with_default_lookup(df, table, "url", "alt", "정보없음")
    assert rows(found) == [("u", "text"), ("v", "정보없음"), (None, "정보없음")]


def test_common_join_uses_all_shared_columns(spark):
    left = spark.createDataFrame([("m", "a", 1), ("n", "a", 2)], "month string, name string, x int")
    right = spark.createDataFrame([("m", "a", 9), ("m", "b", 8)], "month string, name string, y int")
    assert rows(joins.common_join(left, right)) == [("m", "a", 1, 9)]


def test_grid_expansion_is_one_to_many(spark):
    items = spark.createDataFrame([(61, 126, "a"), (59, 127, "b"), (0, 0, "c")], "nx int, ny int, v string")
    from tramline.sources.districts import district_grid

    found = joins.expand_by_grid(items, district_grid(spark))
    assert {(r.gu, r.v) for r in found.collect()} == {("강남구", "a"), ("마포구", "b"), ("서대문구", "b")}
    assert "BroadcastHashJoin" in physical_plan(found)


def skewed(spark):
    """A third of the rows on one key, a third without key."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(-1))
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id") % 500)
    )
    return spark.range(0, 60_000, 1, 12).select(key.alias("k"), (F.col("id") % 4).alias("v"))


def test_hot_keys_are_found(spark):
    hot = skew.hot_key_shares(skewed(spark), ["k"], share=0.1)
    expected = spark.createDataFrame([(-1,), (None,)], "k long").select(F.xxhash64("k")).collect()
    assert sorted(hot) == sorted(r[0] for r in expected)
    assert all(part == pytest.approx(1 / 3, abs=0.01) for part in hot.values())
    assert skew.hot_key_shares(skewed(spark).where("false"), ["k"]) == {}
    even = spark.range(50_000).select((F.col("id") % 25_000).alias("k"))
    assert skew.hot_key_shares(even, ["k"]) == {}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_the_plain_one(spark, how, null_safe):
    left = skewed(spark)
    right = spark.createDataFrame(
        [(k, f"r{k}") for k in (*range(0, 400), -1, -1, None)], "k long, w string"
    )
    if how.startswith("left_"):
        right = right.where("k is null or k > 10")

    def counted(slices):
        joined = skew.spread_join(left, right, ["k"], how, null_safe, slices)
        assert joined.columns == (["k", "v"] if how.startswith("left_") else ["k", "v", "w"])
        return rows(joined.groupBy(*joined.columns).count())

    plain, salted = counted(False), counted(True)
    assert plain == salted and plain


def test_salted_join_levels_the_partitions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        right = spark.range(-1, 500).select(F.col("id").alias("k"), F.lit(1).alias("w"))

        def largest(slices):
            joined = skew.spread_join(skewed(spark), right, ["k"], "left", True, slices)
            sizes = joined.groupBy(F.spark_partition_id()).count().collect()
            return max(r["count"] for r in sizes)

        plain, salted = largest(False), largest(True)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert plain >= 20_000 and salted < 12_000


def test_unknown_join_kind(spark):
    with pytest.raises(ValueError):
        skew.spread_join(spark.range(1), spark.range(1), ["id"], "full")


def test_labels_round_trip(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "x string")
    table = labels.fit_labels(df, "x")
    assert rows(table) == [("a", 0), ("b", 1), ("c", 2)]
    coded = labels.encode(df, table, "x", "code")
    again = labels.decode(coded, table, "code", "y")
    assert all(r.x == r.y for r in again.collect())
    numbers = labels.fit_labels(spark.createDataFrame([(10,), (9,), (100,)], "n int"), "n")
    assert rows(numbers) == [(10, 1), (100, 2), (9, 0)]


@pytest.mark.parametrize("value", ["z", None])
def test_unknown_label_fails(spark, value):
    table = labels.fit_labels(spark.createDataFrame([("a",)], "x string"), "x")
    bad = spark.createDataFrame([("a",), (value,)], "x string")
    with pytest.raises(Exception, match="unknown x"):
        labels.encode(bad, table, "x").collect()


def test_split_flag_ignores_partitioning(spark):
    df = spark.range(10_000).select("id", F.lit("a").alias("n"))
    flag = labels.split_flag(["id", "n"]).alias("train")
    first = {r.id: r.train for r in df.select("id", flag).collect()}
    second = {r.id: r.train for r in df.repartition(13).select("id", flag).collect()}
    assert first == second
    assert 0.68 < sum(first.values()) / len(first) < 0.72


WIDE = "USE_MM string, STTN string, L string, HR_4_GET_ON_NOPE int, HR_4_GET_OFF_NOPE int, HR_5_GET_ON_X int, HR_5_GET_OFF_X int, JOB string"


def test_hourly_profile(spark):
    wide = spark.createDataFrame(
        [("202404", "A", "1", 10, 3, None, None, "j"), ("202404", None, "1", 1, 1, 1, 1, "j")], WIDE
    )
    profile = reshape.hourly_profile(wide, ["USE_MM", "STTN", "L"])
    assert rows(profile) == [("202404", "A", "1", 4, 10, 3), ("202404", "A", "1", 5, 0, 0)]


def test_hourly_profile_equals_melt_and_fold(spark):
    rng = random.Random(3)
    data = [
        (rng.choice(["202401", "202402"]), rng.choice("ABC"), rng.choice("12"),
         *[rng.choice([None, rng.randrange(50)]) for _ in range(4)], "j")
        for _ in range(300)
    ]
    wide, keys = spark.createDataFrame(data, WIDE), ["USE_MM", "STTN", "L"]
    folded = reshape.fold_rides(reshape.melt_hours(wide, keys), keys)
    profile = reshape.hourly_profile(wide, keys)
    assert rows(folded.select(profile.columns)) == rows(profile)
    assert physical_plan(profile).count("Exchange") == 1


def test_hourly_profile_mixes_whole_and_decimal_columns(spark):
    wide = spark.createDataFrame(
        [("m", 1, 2.5)], "USE_MM string, HR_1_GET_ON_X int, HR_2_GET_OFF_X double"
    )
    assert rows(reshape.hourly_profile(wide, ["USE_MM"])) == [("m", 1, 1.0, 0.0), ("m", 2, 0.0, 2.5)]
