"""New-row detection, keyed update, ledger and completeness."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.operators import key_index
from tramline.operators.aggregates import next_number
from tramline.operators.joins import keyed_update, new_rows
from tramline.session import stage
from tramline.sources.landed import completeness
from tramline.workloads.tables import table

QUERIES = {}
SQL = {}


def order_keys(spark, sf_dir):
    """(incoming, baseline): orders without key where their status is P, lines without key where they were returned."""
    incoming = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("key"),
        "o_orderstatus",
        "o_orderpriority",
    )
    baseline = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.col("l_orderkey")).alias("key")
    )
    return incoming, baseline


def new_rows_anti(spark, sf_dir):
    """Orders without lines, orders of status P and returned lines having no key.

    As the baseline has rows without key, incoming rows without key are not new.
    """
    return new_rows(*order_keys(spark, sf_dir), "key")


QUERIES["new_rows_anti"] = new_rows_anti
SQL["new_rows_anti"] = """
WITH incoming AS (
  SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS key, o_orderstatus, o_orderpriority
  FROM orders),
baseline AS (
  SELECT DISTINCT CASE WHEN l_returnflag <> 'R' THEN l_orderkey END AS key FROM lineitem)
SELECT i.* FROM incoming i
WHERE NOT EXISTS (SELECT 1 FROM baseline b WHERE b.key IS NOT DISTINCT FROM i.key)
"""


def new_rows_indexed_anti(spark, sf_dir):
    """The same by an index of the baseline's keys, made of two parts that are merged."""
    incoming, baseline = order_keys(spark, sf_dir)
    buckets = key_index.buckets_for(baseline.count())
    early, late = (key_index.key_index(baseline.where(c), "key", buckets) for c in ("key % 3 = 0", "key IS NULL OR key % 3 <> 0"))
    merged = early.merged(late)
    index = key_index.KeyIndex(stage(merged.bitmaps, "key_index"), buckets)
    return key_index.new_rows_indexed(incoming, baseline, "key", index)


QUERIES["new_rows_indexed"] = new_rows_indexed_anti
SQL["new_rows_indexed"] = SQL["new_rows_anti"]


def new_rows_all_keyed(spark, sf_dir):
    """The same against a baseline without null keys: unkeyed rows are new."""
    incoming = table(spark, sf_dir, "documents").select(
        F.when(F.col("lang") != "en", F.col("doc_id")).alias("doc_id"), "lang", "source", "n_chars"
    )
    return new_rows(incoming, table(spark, sf_dir, "labels"), "doc_id")


QUERIES["new_rows_anti_unkeyed"] = new_rows_all_keyed
SQL["new_rows_anti_unkeyed"] = """
SELECT CASE WHEN lang <> 'en' THEN doc_id END AS doc_id, lang, source, n_chars FROM documents
WHERE lang = 'en' OR doc_id NOT IN (SELECT doc_id FROM labels)
"""


def source_update(spark, sf_dir):
    """Document sources replaced by their label; a toxic label empties the source."""
    updates = table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("toxic") == 0, F.concat(F.lit("quality "), "quality")).alias("new")
    )
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return keyed_update(documents, updates, "doc_id", "source", "new")


QUERIES["keyed_update"] = source_update
SQL["keyed_update"] = """
SELECT d.doc_id, lang,
       CASE WHEN l.doc_id IS NULL THEN source WHEN toxic = 0 THEN 'quality ' || quality END AS source
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def batch_ledger_next(spark, sf_dir):
    """Next batch number of a filled ledger and of an empty one."""
    ledger = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("batch_id"))
    filled = next_number(ledger, "batch_id").withColumn("ledger", F.lit("filled"))
    empty = next_number(ledger.where("batch_id < 0"), "batch_id").withColumn("ledger", F.lit("empty"))
    return filled.unionByName(empty)


QUERIES["batch_ledger_next"] = batch_ledger_next
SQL["batch_ledger_next"] = """
SELECT coalesce(max(o_orderkey), 0) + 1 AS next_batch_id, 'filled' AS ledger FROM orders
UNION ALL
SELECT coalesce(max(o_orderkey), 0) + 1, 'empty' FROM orders WHERE o_orderkey < 0
"""


def load_completeness(spark, sf_dir):
    """Lines as responses of one row that declare their number, per order."""
    responses = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_linenumber").cast("long").alias("list_total_count"),
        F.array(F.struct("l_partkey", "l_suppkey")).alias("row"),
    )
    return completeness(responses, "l_orderkey")


QUERIES["load_completeness"] = load_completeness
SQL["load_completeness"] = """
SELECT l_orderkey, CAST(max(l_linenumber) AS BIGINT) AS declared, count(*) AS collected
FROM lineitem GROUP BY l_orderkey
"""
