"""Registered queries: each operator over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.llm import bpe, codes, decontam, embeddings, langid, lines, lm, packing, periods, secrets, simhash, substring, warc
from tramline.session import stage
from tramline.workloads.tables import table

SQL: dict[str, str] = {
    "op4_embedding_near_dedup": embeddings.SQL,
    "op6_warc_revisits": warc.SQL,
    "op9_substring_dedup": substring.SQL,
    "op12_vector_codes": codes.SQL,
}


def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_best_fit_packing(spark, sf_dir):
    """All documents in sequences of 1024 tokens."""
    found = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2, size=1024)
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_simhash_near_dedup(spark, sf_dir):
    """Fingerprint and group of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=3)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op3_language_id(spark, sf_dir):
    """Language of every document by a model of those whose fold is not 2."""
    docs = table(spark, sf_dir, "documents")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    model = langid.train(docs.where(fold != 2))
    found = langid.classify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op4_embedding_near_dedup(spark, sf_dir):
    """Links and group of every vector."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op5_benchmark_decontamination(spark, sf_dir):
    """Best window of every document for every benchmark item that it holds."""
    found = decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnsRenamed({"id": "doc_id", "item": "item_id"})


def op6_warc_revisits(spark, sf_dir):
    """Outcome and merged headers of the revisits derived from all pages."""
    found = warc.resolve_revisits(warc.captures_of(table(spark, sf_dir, "pages")))
    names = ("etag", "cache-control", "content-length", "content-type", "last-modified")
    fields = [F.col("headers")[name].alias(name.replace("-", "_")) for name in names]
    return found.select("record_id", "canonical_url", "captured_at", "outcome", "response_id", *fields)


def op7_lm_scoring(spark, sf_dir):
    """Scores of every document by a model of those whose fold is not 2."""
    docs = table(spark, sf_dir, "documents")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7))
    found, model = lm.score_corpus(docs, fold != 2)
    return found.select(
        "doc_id",
        F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.n).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op8_secret_scan(spark, sf_dir):
    """Base and entropy spans of every document."""
    found = secrets.scan(table(spark, sf_dir, "documents"))

    def joined(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["rank"] < len(secrets.BASE))
    return found.select(
        "doc_id",
        *(count(kind) for kind, *_ in secrets.BASE),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op9_substring_dedup(spark, sf_dir):
    """What is left of every document when repeated passages of 20 words go."""
    found = substring.remove_duplicates(table(spark, sf_dir, "documents"), window=20)
    digest = F.sha2(F.col("kept_text").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


def op10_line_dedup(spark, sf_dir):
    """Every document without lines that occur, or nearly occur, earlier."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = lines.removed_lines(docs)
    found = lines.keep_lines(docs, gone, "doc_id", "text", counts=True)
    return found.select("doc_id", "n_lines", "n_removed", "text")


def rank_file():
    """Place of the rank file and its split pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op11_byte_bpe(spark, sf_dir):
    """Token ids of every document and the bytes they decode to, as digests."""
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), *rank_file()), *rank_file())
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_vector_codes(spark, sf_dir):
    """Codes of every vector, with the error of its label's vectors together."""
    found, books = codes.compress(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, keep=("label",))
    sums = found.groupBy("label").agg(F.sum("error").alias("label_error"))
    sums = stage(sums.withColumnRenamed("label", "sum_label"), "label_errors")
    text = ",".join(str(x) for part in books for entry in part for x in entry)
    return found.join(sums, F.col("label").eqNullSafe(F.col("sum_label"))).select(
        "vec_id",
        F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "").alias("code"),
        "error",
        "label_error",
        F.sha2(F.lit(text).cast("binary"), 256).alias("codebooks_sha256"),
    )


def periodic_documents(docs):
    """``docs`` (doc_id, text) with a tenth of them, by the hash of the id, made periodic from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    rows = rows.withColumn("p", F.when(F.col("n") > 0, period).cast("int"))
    tail = F.transform(
        F.sequence(F.lit(0), F.col("n") - F.col("a") - 1), lambda i: F.get("words", F.col("a") + i % F.col("p"))
    )
    changed = F.array_join(F.concat(F.slice("words", 1, F.col("a")), tail), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark, sf_dir):
    """Number of runs of every document, its longest, and digests of all runs and of the text without repeats."""
    docs = periodic_documents(table(spark, sf_dir, "documents"))
    found = periods.periodic_runs(docs, least=12)
    best = F.reduce(
        "runs",
        F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda m, r: F.when(m.isNull() | (r["length"] > m["length"]), r).otherwise(m),
    )
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("op")}
