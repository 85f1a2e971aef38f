"""Training corpus from raw documents: five stages over whole tables, each the next one's input.

Every stage takes (spark, docs, sf_dir) and returns the columns of ``docs``, but the last, which
returns the pieces of all kept documents and their places in sequences.

* language_id: a model of the labelled rows; a document goes if it has no letter, or if few of
  its n-grams occur in the model's landmarks: less than three quarters of the share that
  99 of 100 labelled texts reach which are no landmarks. Without such texts none goes for that.
* line_dedup: repeated and nearly repeated lines go, documents stay; ``n_chars``, if there is one,
  follows the text.
* simhash_near_dedup: the document with the smallest id of each group stays.
* benchmark_decontamination: documents that hold a near copy of a benchmark item go.
* best_fit_packing: sequences of 1024 tokens.

Rows with a null ``doc_id`` go through all filters but language identification unchanged. Empty
tables give empty results. The operators' docstrings state the other cases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm import decontam, langid, lines, packing, simhash
from tramline.llm.graph import fresh
from tramline.llm.queries import tokenizer_path
from tramline.session import prepare, stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs)
    language, score, known = (fresh(docs, name) for name in ("language", "score", "known"))
    found = langid.classify(docs, model, language_col=language, score_col=score, known_col=known)
    return found.where((F.col(language) != "und") & (F.col(known) >= model.least_known)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, max_distance=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path(), end_id=2, size=1024)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Kernel regression, SimHash groups and byte-pair tokens are not expressible; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
