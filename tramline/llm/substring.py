"""Substring dedup by relative Lempel-Ziv parsing.

Every run of ``window`` words that also starts earlier (in a document with a smaller id, or earlier
in the same one) is a duplicate; its words go. Documents are parsed against an index of reference
blocks, which covers the whole corpus:

* Content cuts each document into blocks of about ``BLOCK`` words. A block is indexed by the hash of
  its words and the ``window - 1`` words that follow, so that every run that starts in the block is
  inside. The first occurrence of a block is the reference; all others are factors, copied whole,
  and consecutive ones join to longer factors.
* What is not covered by such factors lies in first occurrences, and shorter factors may begin or
  end there, at the boundaries of blocks. Each run of ``window`` words there is looked up by its own
  hash, unless its anchor, its least hashed part of ``PART`` words, occurs only once in the corpus,
  which rules out a second occurrence.
* Runs that begin at consecutive words make up one span. Nothing is judged on a text that was cut.

Hash tables hold (hash, place) rows and are reduced to the first place of each hash, with map-side
halves, so frequent passages do not gather in one task. Only first places go back to the documents:
a document's runs that are not among them are the duplicates. Equality is that of 64-bit hashes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.graph import release
from tramline.llm.words import Words, mix, text_slices, windows, within_rows
from tramline.session import stage

BLOCK = 64
PART = 8
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
PLACE = pa.decimal128(38, 0)  # id, checksum of the text (30 bits), word number (31 bits): sorts by place, fits any long
CHECK, WORD = 30, 31


@functools.cache
def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors)


class Parsed:
    """Words, runs, blocks and anchors of a text column. A run is known by its place in ``runs``."""

    def __init__(self, column: pa.Array, window: int):
        w = self.words = Words(column, lower=False)
        self.first, self.window = w.first, window
        h = w.hashes()
        self.runs = within_rows(w.first, window)  # first word of each run
        n = np.maximum(w.counts - window + 1, 0)
        self.row = np.repeat(np.arange(len(n)), n)
        # blocks: from run blocks[i] to the next
        cut = np.ones(len(self.runs), bool)
        cut[1:] = (self.row[1:] != self.row[:-1]) | (windows(h, 4)[self.runs[1:]] % np.uint64(BLOCK) == 0)
        self.blocks = np.flatnonzero(cut)
        self.block_runs = np.diff(np.append(self.blocks, len(self.runs)))
        size = 1 << max(1, len(h)).bit_length()
        sums = np.append(np.uint64(0), np.cumsum(h * _powers(_ODD, size)[: len(h)]))
        begin = self.runs[self.blocks]
        end = begin + self.block_runs + window - 1
        body = (sums[end] - sums[begin]) * _powers(_INVERSE, size)[begin]
        self.block_keys = mix(body + mix((end - begin).astype(np.uint64))) & ~np.uint64(1)
        # anchor of each run: the first of its least hashed parts
        part = min(PART, window)
        parts = windows(h, part)
        self.run_keys = windows(h, window)[self.runs]
        least, off = parts[self.runs], np.zeros(len(self.runs), np.int64)
        for o in range(1, window - part + 1):
            other = parts[self.runs + o]
            less = other < least
            least = np.where(less, other, least)
            off[less] = o
        self.anchors = self.runs + off  # word numbers; never falling within a row
        new = np.ones(len(off), bool)
        new[1:] = self.anchors[1:] != self.anchors[:-1]
        self.distinct_anchors = np.flatnonzero(new)
        self.anchor_keys = least[new] | np.uint64(1)

    def places(self, batch: pa.RecordBatch, row: np.ndarray, word: np.ndarray) -> pa.Array:
        """Sortable places of words (numbers in the slice) of rows."""
        ids, checks = (batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("id", "check"))
        return _places(ids, checks, word - self.first[row])

    def marked(self, batch: pa.RecordBatch, name: str) -> np.ndarray:
        """True at the words that the list column ``name`` has (numbers in their text)."""
        mark = np.zeros(len(self.words) + 1, bool)
        lists = batch.column(name)
        n = np.diff(lists.offsets.to_numpy())
        mark[np.repeat(self.first[:-1], n) + lists.flatten().to_numpy(zero_copy_only=False)] = True
        return mark


def _table(key: np.ndarray, places: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), places], ["key", "place"])


def _places(ids: np.ndarray, checks: np.ndarray, words: np.ndarray) -> pa.Array:
    """id * 2^61 + check * 2^31 + word as 128-bit numbers, the lower 64 bits first."""
    buffer = np.empty((len(ids), 2), np.int64)
    buffer[:, 0] = (ids << CHECK + WORD) | (checks << WORD) | words
    buffer[:, 1] = ids >> 64 - CHECK - WORD
    return pa.Array.from_buffers(PLACE, len(ids), [None, pa.py_buffer(buffer)])


def _parts(places: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, checks, words) of ``_places``."""
    low, high = np.frombuffer(places.buffers()[1], np.int64).reshape(-1, 2)[places.offset : places.offset + len(places)].T
    ids = (high << 64 - CHECK - WORD) | (low.view(np.uint64) >> np.uint64(CHECK + WORD)).view(np.int64)
    return ids, low >> WORD & (1 << CHECK) - 1, low & (1 << WORD) - 1


def _back(firsts: DataFrame, names: list[str]) -> DataFrame:
    """(id, check, one list of word numbers for each name) from (key, place, kind)."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, checks, words = _parts(batch.column("place"))
            arrays = [pa.array(ids), pa.array(checks), pa.array(words.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*arrays, batch.column("kind")], ["id", "check", "at", "kind"])

    rows = firsts.select("place", "kind").mapInArrow(split, "id long, check long, at int, kind int")
    lists = [F.collect_list(F.when(F.col("kind") == i, F.col("at"))).alias(c) for i, c in enumerate(names)]
    return rows.groupBy("id", "check").agg(*lists)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    return rows.withColumn("check", F.crc32(F.col("t").cast("binary")).bitwiseAND(F.lit((1 << CHECK) - 1)))


def _with_lists(rows: DataFrame, lists: DataFrame, names: list[str]) -> DataFrame:
    lists = lists.withColumnsRenamed({"id": "lid", "check": "lcheck"})
    joined = rows.join(lists, (rows.id == lists.lid) & (rows.check == lists.lcheck), "left").drop("lid", "lcheck")
    return joined.withColumns({c: F.coalesce(c, F.array().cast("array<int>")) for c in names})


def duplicate_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """(id, check, n_words, spans array<struct<start int, end int>>) for every row of ``docs``.

    ``spans`` are the maximal runs of words, numbered from 0 in the text, that duplicate windows
    cover. Words are unchanged runs of non-space characters. Null and empty texts have no words.
    Rows with a null id have no spans and are no reference for others. Equal rows with one id are
    one document; rows that repeat an id with other texts come in the order of a checksum. Other
    columns are not read; an empty table gives no rows.
    """
    texts = _texts(docs, id_col, text_col)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "t"):
            p = Parsed(batch.column("t"), window)
            full = p.block_runs > 0
            yield _table(p.block_keys[full], p.places(batch, p.row[p.blocks[full]], p.runs[p.blocks[full]]))
            yield _table(p.anchor_keys, p.places(batch, p.row[p.distinct_anchors], p.anchors[p.distinct_anchors]))

    known = texts.where("id IS NOT NULL")
    rows = known.mapInArrow(index, "key long, place decimal(38,0)")
    firsts = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("place").alias("place"))
    firsts = firsts.withColumn("kind", F.col("key").bitwiseAND(F.lit(1)).cast("int")).where("kind = 0 OR n = 1")
    lists = stage(_back(firsts, ["references", "single"]), "references")
    release(lists)

    def parse(batches):
        for batch in text_slices(batches, "t"):
            p = Parsed(batch.column("t"), window)
            reference, single = p.marked(batch, "references"), p.marked(batch, "single")
            copied = ~np.repeat(reference[p.runs[p.blocks]], p.block_runs)
            asked = ~copied & ~single[p.anchors]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("check"),
                    pa.array(p.words.counts.astype(np.int32)),
                    _per_row(p, copied, p.runs - p.first[p.row]),
                    _per_row(p, asked, p.runs - p.first[p.row]),
                    _per_row(p, asked, p.run_keys.view(np.int64), pa.int64()),
                ],
                ["id", "check", "n_words", "copied", "asked", "keys"],
            )

    schema = "id long, check long, n_words int, copied array<int>, asked array<int>, keys array<long>"
    parsed = _with_lists(known, lists, ["references", "single"]).mapInArrow(parse, schema)
    parsed = stage(parsed, "parsed")
    release(parsed)

    def look_up(batches):
        for batch in batches:
            lists = batch.column("asked")
            n = np.diff(lists.offsets.to_numpy())
            ids, checks = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False), n) for c in ("id", "check"))
            places = _places(ids, checks, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            yield _table(batch.column("keys").flatten().to_numpy(zero_copy_only=False), places)

    asked = parsed.where(F.size("asked") > 0).select("id", "check", "asked", "keys")
    firsts = asked.mapInArrow(look_up, "key long, place decimal(38,0)").groupBy("key").agg(F.min("place").alias("place"))
    kept = stage(_back(firsts.withColumn("kind", F.lit(0)), ["kept"]), "first_runs")
    release(kept)

    def spans(batches):
        for batch in batches:
            out, n_rows = [], []
            columns = [batch.column(c) for c in ("copied", "asked", "kept")]
            offsets = [c.offsets.to_numpy() - c.offsets[0].as_py() for c in columns]
            values = [c.flatten().to_numpy(zero_copy_only=False) for c in columns]
            for i in range(batch.num_rows):
                copied, asked, kept = (v[o[i] : o[i + 1]] for v, o in zip(values, offsets, strict=True))
                runs = np.union1d(copied, np.setdiff1d(asked, kept))
                new = np.flatnonzero(np.diff(runs, prepend=-window - 1) > window)
                ends = np.append(runs[new[1:] - 1], runs[-1:]) + window
                out += [{"start": int(s), "end": int(e)} for s, e in zip(runs[new], ends, strict=True)]
                n_rows.append(len(new))
            flat = pa.array(out, pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_rows)).astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "check", "n_words")), lists], ["id", "check", "n_words", "spans"])

    light = parsed.select("id", "check", "n_words", "copied", "asked")
    span_type = "array<struct<start:int,end:int>>"
    found = _with_lists(light, kept, ["kept"]).mapInArrow(spans, f"id long, check long, n_words int, spans {span_type}")

    def count(batches):
        for batch in text_slices(batches, "t"):
            n = Words(batch.column("t"), lower=False).counts.astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("check"), pa.array(n)], ["id", "check", "n_words"])

    nameless = texts.where("id IS NULL").mapInArrow(count, "id long, check long, n_words int")
    return found.unionByName(nameless.withColumn("spans", F.array().cast(span_type)))


def _per_row(p: Parsed, mask: np.ndarray, values: np.ndarray, kind: pa.DataType = pa.int32()) -> pa.ListArray:
    n = np.bincount(p.row[mask], minlength=len(p.first) - 1)
    offsets = pa.array(np.append(0, np.cumsum(n)).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(values[mask]).cast(kind))


def remove_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """(id_col, n_words, n_removed, spans, kept_text) for every row of ``docs``.

    ``kept_text`` has the words outside the spans, joined by one space. See ``duplicate_spans``.
    """
    found = stage(duplicate_spans(docs, id_col, text_col, window), "spans").where("id IS NOT NULL")
    release(found)
    # Equal rows have equal spans: one is enough for the join.
    cut = found.where(F.size("spans") > 0).dropDuplicates(["id", "check"])
    cut = cut.select(F.col("id").alias("lid"), F.col("check").alias("lcheck"), "spans")
    rows = _texts(docs, id_col, text_col)
    rows = rows.join(cut, (rows.id == cut.lid) & (rows.check == cut.lcheck), "left").select("id", "t", "spans")
    rows = rows.withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")))

    def keep(batches):
        for batch in text_slices(batches, "t"):
            w = Words(batch.column("t"), lower=False)
            lists = batch.column("spans")
            n = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            base = np.repeat(w.first[:-1], n)
            edge = np.zeros(len(w) + 1, np.int64)
            np.add.at(edge, base + flat.field("start").to_numpy(zero_copy_only=False), 1)
            np.add.at(edge, base + flat.field("end").to_numpy(zero_copy_only=False), -1)
            keep = np.cumsum(edge)[:-1] == 0
            length = (w.ends - w.starts + 1)[keep]  # with a space after each word
            out = np.cumsum(length) - length
            at = np.arange(int(length.sum())) + np.repeat(w.starts[keep] - out, length)
            text = w.bytes[at]
            text[out + length - 1] = 0x20
            kept_words = np.append(0, np.cumsum(keep))[w.first]
            where = np.append(out, len(text))[kept_words]
            data = text.tobytes()
            texts = [data[a : b - 1].decode() if b > a else "" for a, b in zip(where[:-1].tolist(), where[1:].tolist(), strict=True)]
            kept = np.diff(kept_words)
            columns = [pa.array(w.counts.astype(np.int64)), pa.array((w.counts - kept).astype(np.int64)), lists, pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "n_words", "n_removed", "spans", "kept_text"])

    schema = "id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept_text string"
    return rows.mapInArrow(keep, schema).withColumnRenamed("id", id_col)


SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
word AS (
  SELECT doc_id, len(words) AS n, unnest(range(1, len(words) + 1)) AS pos, unnest(words) AS word FROM split),
run AS (
  SELECT doc_id, n, pos, word,
         string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS run
  FROM word),
judged AS (
  SELECT doc_id, n, pos, word, pos + 19 <= n
         AND row_number() OVER (PARTITION BY run, pos + 19 <= n ORDER BY doc_id, pos) > 1 AS again
  FROM run),
covered AS (
  SELECT doc_id, pos, word, coalesce(bool_or(again) OVER (
           PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone
  FROM judged),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone), '') AS kept_text
  FROM covered GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept_text, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""
