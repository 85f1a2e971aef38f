"""Tables whose content changes in one step of the catalog.

What is written goes to a folder of its own first, where no reader looks. One catalog command then makes
it visible: a new location for a table that is replaced, a new partition for one that is
added to. So a run that fails, however late, leaves the old rows, and no reader finds the table empty.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tramline.sources.tables import counted

PREVIOUS = "tramline.previous"  # table property: the location before the current one
VERSION = "version"


def write_aside(df: DataFrame, table: str) -> tuple[str, int]:
    """(folder, rows) of ``df`` written beside the table; a failed write removes its folder."""
    spark = df.sparkSession
    rows, seen = counted(df)
    folder = f"{_home(spark, table)}/{uuid.uuid4().hex}"
    try:
        rows.write.parquet(folder)
    except BaseException:
        remove(spark, folder)
        raise
    return folder, seen.get["rows"]


def replace_location(df: DataFrame, table: str) -> int:
    """The table holds exactly ``df`` afterwards; returns the rows written.

    The files of the content just replaced stay for readers that have already planned, those of the
    one before go. Of two runs at a time the later switch wins whole. A table of other columns or with
    partitions is dropped and created anew, the one case that is not a single step. The tables are
    external: dropping one leaves its last folder.
    """
    spark = df.sparkSession
    folder, rows = write_aside(df, table)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    if spark.catalog.tableExists(table):
        found = spark.catalog.listColumns(table)
        same = [(c.name, c.dataType) for c in found] == [(f.name, f.dataType.simpleString()) for f in df.schema]
        if same and not any(c.isPartition for c in found):
            switch(spark, table, folder)
            return rows
        spark.sql(f"DROP TABLE {table}")
    try:
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{folder}'")
    except AnalysisException:
        if not spark.catalog.tableExists(table):
            raise
        switch(spark, table, folder)  # another run created it meanwhile
    return rows


def switch(spark: SparkSession, table: str, folder: str) -> None:
    before, older = location(spark, table), properties(spark, table).get(PREVIOUS)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PREVIOUS}' = '{before}')")
    if older and older not in (before, folder):
        remove(spark, older)


def commit_version(spark: SparkSession, table: str, version: int, folder: str) -> bool:
    """Make ``folder`` version ``version`` of the table; False if that version is already there.

    The catalog takes a partition name once, so of several runs that saw the same last version exactly
    one gets to add to it.
    """
    try:
        spark.sql(f"ALTER TABLE {table} ADD PARTITION ({VERSION} = {version}) LOCATION '{folder}'")
    except AnalysisException as error:
        if error.getCondition() != "PARTITIONS_ALREADY_EXIST":
            raise
        return False
    spark.catalog.refreshTable(table)
    return True


def last_version(spark: SparkSession, table: str) -> int:
    """Number of the newest version, 0 for none; read from the catalog alone."""
    names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return max((int(n.split("=")[1]) for n in names), default=0)


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[-1]["data_type"]


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def remove(spark: SparkSession, folder: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def _home(spark, table):
    """Folder of the table's versions, in that of its schema."""
    schema, _, name = table.rpartition(".")
    database = spark.catalog.getDatabase(schema or spark.catalog.currentDatabase())
    return f"{database.locationUri.rstrip('/')}/{name}.versions"
