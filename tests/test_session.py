import pytest

from tramline import session


class Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class Fake:
    """Stands in for a session on a given master."""

    def __init__(self, master, **conf):
        self.conf = Conf(conf)
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})()


def test_shared_folder_comes_from_the_session():
    cluster = Fake("spark://host:7077", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert session.shared_folder(cluster) == "hdfs:///shared/"
    assert session.stage_path(cluster, "x").startswith("hdfs:///shared/tramline-app-1/x-")


def test_a_cluster_without_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Fake("yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Fake("local-cluster[2,1,1024]"))


def test_a_local_master_may_use_its_own_folder():
    assert session.shared_folder(Fake("local[2]")) == session.shared_folder(Fake("local[2]"))


def test_stage_keeps_schema_and_rows_and_knows_its_size(spark):
    df = spark.range(1000).selectExpr("id", "cast(null as string) AS s", "timestamp_ntz'2025-01-01' AS t")
    staged = session.stage(df, "t")
    assert staged.schema.simpleString() == df.schema.simpleString()
    assert staged.exceptAll(df).count() == 0
    joined = staged.join(staged.withColumnRenamed("s", "s2"), "id")
    assert session.planned_bytes(joined) > session.scanned_bytes(joined) > 0
    assert session.stage(df.limit(0), "t").count() == 0


def test_prepare_keeps_what_the_session_sets(spark):
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "false")
    session.prepare(spark)
    # the test session was built with the defaults, so they count as its own choice
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "false"
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
