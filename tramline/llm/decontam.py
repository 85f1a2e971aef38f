"""Benchmark decontamination: item-sized windows of documents that nearly equal a benchmark item.

A text is its multiset of word shingles (ASCII letters lower-cased); a shingle weighs as many
characters as its words have. A document is contaminated by an item if a window of as many words as
the item has (the whole document, if that is shorter) has a weighted-shingle similarity, the weight
of the shared shingles over that of all shingles of both, of at least ``similarity``.

* Windows without any shingle of an item have similarity 0. Documents are scanned once for the
  items' shingles, and only windows that hold one get a weighted SimHash fingerprint.
* Multi-index: fingerprints are cut into ``BLOCKS`` blocks. Within ``radius`` bits overall, two
  fingerprints lie within radius // BLOCKS bits in some block; items are indexed by all values that
  near to theirs, windows look up their own, and every fingerprint within the radius is found.
* Windows of one content are looked up once, so a passage that many documents share is no hot key.
* The exact similarity of each candidate decides.

The default radius of 20 of 64 bits loses fewer than 1 of 1000 windows at a similarity of just 0.8,
and fewer above it. The items' shingles are broadcast in blocks of at most ``INDEX_SHINGLES``;
a larger benchmark takes more scans of the documents.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.words import Words, mix, text_slices, windows
from tramline.session import stage

BLOCKS = 8
INDEX_SHINGLES = 1 << 20  # of 16 bytes each
FILTER_BITS = 22
WINDOW_ROWS = 2048  # fingerprints made at a time


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and weight of the shingle at each word; those that run over a row's end are void."""
    h = windows(w.hashes(), size)
    length = np.append(0, np.cumsum(w.ends - w.starts))
    return mix(h + np.uint64(size)), (length[size:] - length[: len(length) - size])[: len(h)]


def fingerprint(h: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted SimHash of each row of shingle hashes."""
    bits = np.unpackbits(h.astype("<u8")[..., None].view(np.uint8), axis=-1, bitorder="little")
    ones = np.einsum("ijk,ij->ik", bits.astype(np.float32), weight.astype(np.float32))
    return np.packbits(2 * ones > weight.sum(axis=1, keepdims=True), axis=1, bitorder="little").view("<u8")[:, 0]


class Index:
    """The shingles of some items, for tasks; items are numbered from 0."""

    def __init__(self, texts: list[str], shingle: int):
        w = Words(pa.array(texts, pa.string()), lower=True)
        self.n_words = w.counts
        self.size = np.minimum(self.n_words, shingle)  # shingle size of each item
        self.by_size: dict[int, dict] = {}
        self.fingerprints = np.zeros(len(texts), np.uint64)
        self.weight = np.zeros(len(texts), np.int64)
        self.items: list[dict[int, tuple[int, int]]] = [{} for _ in texts]  # hash -> times, weight
        for size in sorted({int(s) for s in self.size if s}):
            h, weight = shingles(w, size)
            lengths: dict[int, set[int]] = {}
            for i in np.flatnonzero(self.size == size):
                at = slice(w.first[i], w.first[i + 1] - size + 1)
                self.fingerprints[i] = fingerprint(h[None, at], weight[None, at])[0]
                self.weight[i] = weight[at].sum()
                for s, x in zip(h[at].tolist(), weight[at].tolist(), strict=True):
                    self.items[i][s] = (self.items[i].get(s, (0, 0))[0] + 1, x)
                    lengths.setdefault(s, set()).add(int(self.n_words[i]))
            keys = np.array(sorted(lengths), np.uint64)
            each = [sorted(lengths[k]) for k in keys.tolist()]
            filter_ = np.zeros(1 << FILTER_BITS, bool)
            filter_[keys >> np.uint64(64 - FILTER_BITS)] = True
            self.by_size[size] = {
                "keys": keys,
                "first": np.append(0, np.cumsum([len(x) for x in each])),
                "lengths": np.array([n for x in each for n in x], np.int64),
                "filter": np.packbits(filter_),
            }


def candidate_windows(w: Words, size: int, index: dict) -> tuple[np.ndarray, ...]:
    """(start, words) of every window that holds a shingle of an item of that many words."""
    h, _ = shingles(w, size)
    place = np.flatnonzero(np.unpackbits(index["filter"])[h >> np.uint64(64 - FILTER_BITS)])
    key = np.minimum(np.searchsorted(index["keys"], h[place]), len(index["keys"]) - 1)
    row = np.searchsorted(w.first, place, "right") - 1
    hit = (index["keys"][key] == h[place]) & (place + size <= w.first[row + 1])
    place, key, row = place[hit], key[hit], row[hit]
    times = index["first"][key + 1] - index["first"][key]
    which = np.repeat(np.arange(len(place)), times)
    words = index["lengths"][np.repeat(index["first"][key], times) + np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)]
    begin, end = w.first[row[which]], w.first[row[which] + 1]
    words = np.minimum(words, end - begin)
    low = np.maximum(place[which] - words + size, begin)
    high = np.minimum(place[which], end - words)
    n = np.maximum(high - low + 1, 0)
    # Runs of starts overlap from hit to hit: keep only what the one before has not.
    order = np.lexsort((low, words))
    low, high, words = low[order], low[order] + n[order] - 1, words[order]
    if len(low):
        group = np.append(True, words[1:] != words[:-1])
        top = np.maximum.accumulate(high + (np.cumsum(group) - 1) * (len(w) + 1)) - (np.cumsum(group) - 1) * (len(w) + 1)
        low[1:] = np.where(group[1:], low[1:], np.maximum(low[1:], top[:-1] + 1))
    n = np.maximum(high - low + 1, 0)
    start = np.repeat(low, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return start, np.repeat(words, n)


def matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", shingle: int = 5, similarity: float = 0.8, radius: int = 20,
) -> DataFrame:
    """(id, item, start, n_words, similarity): the best, then first, window of each document and item.

    ``start`` counts words from 0. Items of fewer words than ``shingle`` are one shingle; items and
    documents without words match nothing. Rows with a null document id cannot be named and are
    left out; null item ids stay. Equal rows, and rows that repeat an id, give one result an item.
    Other columns are not read; an empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("t"))
    kind = dict(benchmark.select(F.col(item_col).alias("item")).dtypes)["item"]
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    texts = texts.where("id IS NOT NULL")
    found, block, room = None, [], INDEX_SHINGLES

    def run_block():
        part = stage(_block_matches(spark, texts, block, shingle, similarity, radius), "item_matches")
        return part if found is None else found.unionByName(part)

    for r in items.toLocalIterator():
        room -= r.t.count(" ") + 1
        block.append((r.item, r.t))
        if room <= 0:
            found, block, room = run_block(), [], INDEX_SHINGLES
    if block or found is None:
        found = run_block()
    best = found.groupBy("id", "item").agg(F.min(F.struct(-F.col("similarity"), "start", "n_words")).alias("b"))
    return best.select(
        "id", F.col("item").cast(kind).alias("item"), "b.start", "b.n_words", (-F.col("b.col1")).alias("similarity")
    )


def _block_matches(spark, texts, block, shingle, similarity, radius):
    """Matches with the items of one block, which fit a task's memory."""
    names = [item for item, _ in block]
    local = Index([t for _, t in block], shingle)
    index = spark.sparkContext.broadcast(local)
    schema = "id long, start int, n_words int, size int, short boolean, content long, fp long, weight long, shared array<long>, shared_weight array<int>"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "t"):
            w = Words(batch.column("t"), lower=True)
            for size, part in index.value.by_size.items():
                if len(w) < size:
                    continue
                h, weight = shingles(w, size)
                start, words = candidate_windows(w, size, part)
                key = np.searchsorted(part["keys"], h)
                known = part["keys"][np.minimum(key, len(part["keys"]) - 1)] == h
                for n in np.unique(words):
                    every = start[words == n]
                    for at in np.split(every, range(WINDOW_ROWS, len(every), WINDOW_ROWS)):
                        place = at[:, None] + np.arange(n - size + 1)
                        yield _window_rows(batch, w, at, int(n), size, h[place], weight[place], known[place])

    rows = stage(texts.mapInArrow(scan, schema), "windows")
    contents = rows.select("n_words", "size", "content", "fp", "weight", "shared", "shared_weight")
    contents = stage(contents.dropDuplicates(["n_words", "size", "content"]), "window_contents")

    near = [sum(1 << b for b in flip) for d in range(radius // BLOCKS + 1) for flip in itertools.combinations(range(64 // BLOCKS), d)]
    width = 64 // BLOCKS
    cut = lambda column, i: F.shiftrightunsigned(column, i * width).bitwiseAND(F.lit((1 << width) - 1))
    table = [(i, int(local.size[i]), int(local.fingerprints[i].astype(np.int64))) for i in range(len(block)) if local.size[i]]
    indexed = spark.createDataFrame(table, "number int, size int, item_fp long")
    indexed = indexed.select("*", F.explode(F.array(*(F.struct(F.lit(i).alias("i"), cut("item_fp", i).alias("own")) for i in range(BLOCKS)))).alias("b"))
    indexed = indexed.select("number", "size", "item_fp", "b.i", F.explode(F.array(*(F.col("b.own").bitwiseXOR(F.lit(m)) for m in near))).alias("value"))
    probes = contents.select("n_words", "size", "content", "fp", F.explode(F.array(*(F.struct(F.lit(i).alias("i"), cut("fp", i).alias("value")) for i in range(BLOCKS)))).alias("b"))
    probes = probes.select("n_words", "size", "content", "fp", "b.i", "b.value")
    pairs = probes.join(indexed, ["size", "i", "value"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
    pairs = pairs.select("n_words", "size", "content", "number").distinct()

    def verify(batches):
        items, lengths = index.value.items, index.value.n_words
        for batch in batches:
            content, shared, weights, number, whole, n = (
                batch.column(c).to_pylist() for c in ("content", "shared", "shared_weight", "number", "weight", "n_words")
            )
            value = []
            for s, x, i, total, words in zip(shared, weights, number, whole, n, strict=True):
                own: dict[int, int] = {}
                common = 0
                for k, weight in zip(s, x, strict=True):
                    k &= (1 << 64) - 1
                    own[k] = own.get(k, 0) + 1
                    if own[k] <= items[i].get(k, (0, 0))[0]:
                        common += weight
                # only a document shorter than the item may have fewer words than it
                value.append(common / (total + int(index.value.weight[i]) - common) if words <= lengths[i] else 0.0)
            keep = [k for k, v in enumerate(value) if v >= similarity]
            picked = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [picked.column("n_words"), picked.column("size"), picked.column("content"), pa.array([names[number[k]] for k in keep], pa.string()),
                 pa.array([int(lengths[number[k]]) for k in keep], pa.int32()), pa.array([value[k] for k in keep], pa.float64())],
                ["n_words", "size", "content", "item", "item_words", "similarity"],
            )
            del content

    both = contents.join(pairs, ["n_words", "size", "content"]).select("n_words", "size", "content", "weight", "shared", "shared_weight", "number")
    sure = stage(both.mapInArrow(verify, "n_words int, size int, content long, item string, item_words int, similarity double"), "verified")
    whole = rows.select("id", "start", "n_words", "size", "content", "short")
    hits = whole.join(sure, ["n_words", "size", "content"]).where("n_words = item_words OR short")
    return hits.select("id", "item", "start", "n_words", "similarity")


def _window_rows(batch, w, at, n, size, h, weight, known):
    """Rows of the windows of ``n`` words at ``at``."""
    row = np.searchsorted(w.first, at, "right") - 1
    order = np.arange(h.shape[1], dtype=np.uint64)
    content = mix((mix(h + mix(order)) + np.uint64(1)).sum(axis=1, dtype=np.uint64))
    counts = known.sum(axis=1)
    offsets = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
    m = len(at)
    arrays = [
        batch.column("id").take(pa.array(row)),
        pa.array((at - w.first[row]).astype(np.int32)),
        pa.array(np.full(m, n, np.int32)),
        pa.array(np.full(m, size, np.int32)),
        pa.array(n == np.diff(w.first)[row]),
        pa.array(content.view(np.int64)),
        pa.array(fingerprint(h, weight).view(np.int64)),
        pa.array(weight.sum(axis=1).astype(np.int64)),
        pa.ListArray.from_arrays(offsets, pa.array(h[known].view(np.int64))),
        pa.ListArray.from_arrays(offsets, pa.array(weight[known].astype(np.int32))),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["id", "start", "n_words", "size", "short", "content", "fp", "weight", "shared", "shared_weight"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The rows of ``docs`` that match no item, in the columns of ``docs``; rows with a null id stay."""
    hit = stage(matches(docs, benchmark, id_col, **how).select(F.col("id").alias("__id")).distinct(), "contaminated")
    return docs.join(hit, docs[id_col] == hit["__id"], "left_anti")
