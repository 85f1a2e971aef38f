import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tramline.session import build_session

    session = build_session(
        "tramline-tests",
        master="local[8]",
        shuffle_partitions=8,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    from tramline.session import drop_stages

    drop_stages(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def one(spark):
    """Value of a column expression over literal inputs, row by row."""

    def values(expression, rows, schema):
        df = spark.createDataFrame(rows, schema)
        return [r[0] for r in df.coalesce(1).select(expression).collect()]

    return values


@pytest.fixture
def schema_name(spark):
    """A fresh catalog schema."""
    import uuid

    name = f"wh_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {name}")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")
