"""Best-fit packing of tokenised documents into sequences of one size.

The configuration linear program: a pattern is a multiset of lengths that fits one sequence; choose
how often to use each pattern so that all pieces are covered with the fewest sequences. Its dual
prices a length; the best pattern for given prices is an unbounded knapsack, solved by dynamic
programming. Multiplicative weights lower the price of a length as it gets covered, and the patterns
they use, rounded down, pack nearly everything; a best-fit search over what is left does the rest.

The program sees only the histogram of lengths, at most ``size`` counts at any input size. Its result
says which places of which sequences the k-th piece of each length takes. Pieces are numbered per
length and salt with offsets of counts, so a length that most pieces have is no single task's work,
and each piece looks up its place by its number.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tramline.llm.words import text_slices
from tramline.session import stage

SALTS = 256  # parts that the pieces of one length are numbered in
STEP = 0.25  # share of a length's pieces that one round of the linear program may cover
RATE = 4.0  # how fast a covered length loses weight

# Fixed split pattern of byte-level BPE vocabularies.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Characters that all Unicode versions in use class alike; other texts take the slower way.
_SETTLED = re.compile("[^\x00-\x1b\x20-ɏͰ-ͳΑ-ΡΣ-ϿЀ-ӿ‐-‧‰-⁞€]")


class Encoder:
    """Token ids of texts by a ``tokenizers`` file, special strings taken as ordinary text.

    For plain byte-level BPE files the same merges run in a faster library; ``tokenizers`` stays in
    charge of all other files and of texts with unusual characters.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        self.fast = _byte_level(path)

    def __call__(self, text: str) -> np.ndarray:
        if self.fast and not _SETTLED.search(text):
            return np.array(self.fast.encode_ordinary(text), "<u4")
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")


@functools.cache
def loaded(path: str) -> Encoder:
    """One encoder for all tasks of a worker."""
    return Encoder(path)


def _byte_level(path: str):
    """The vocabulary as merge ranks, if the file is byte-level BPE with ids in merge order."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type", "BPE") == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True)
        and not split.get("add_prefix_space") and not spec.get("normalizer") and not spec.get("post_processor")
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    )
    merged = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", [])]
    vocabulary = model["vocab"] if isinstance(model["vocab"], dict) else {}
    in_order = all(vocabulary.get(m.replace(" ", "")) == i + 256 for i, m in enumerate(merged))
    if not plain or not in_order or len(vocabulary) != len(merged) + 256:
        return None
    # Byte-level files write each byte as a visible character: itself if visible, else from 256 on.
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}
    ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items()}
    return tiktoken.Encoding("byte_level", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})


def pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int, size: int = 1024, id_col: str = "doc_id",
    text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every row of ``docs``.

    A document is its token ids and ``end_id``. Only longer ones than ``size`` are cut, so that all
    pieces but the first are full. Null texts are empty: one piece with the end alone. Null ids are
    kept; every one of equal rows has its pieces. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(tokenizer_path)
        end = np.array([end_id], "<u4")
        for batch in text_slices(batches, "t"):
            rows, out, ids = [], [], []
            for i, text in enumerate(batch.column("t").to_pylist()):
                tokens = np.append(encoder(text) if text else end[:0], end)
                at = 0
                for piece in range(-(-len(tokens) // size)):
                    length = (len(tokens) - 1) % size + 1 if not piece else size
                    data = tokens[at : at + length].tobytes()
                    rows.append(i)
                    out.append((piece, at, length, zlib.crc32(data)))
                    if with_ids:
                        ids.append(tokens[at : at + length].astype(np.int32))
                    at += length
            piece, start, length, crc = zip(*out, strict=True) if out else ((), (), (), ())
            arrays = [
                batch.column("id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ]
            arrays += [pa.array(ids, pa.list_(pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays(arrays, ["id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    schema = "id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return rows.mapInArrow(run, schema)


def best_pattern(price: np.ndarray, size: int) -> np.ndarray:
    """How often each length occurs in a multiset of the highest total price that fits ``size``."""
    worth, last = np.zeros(size + 1), np.zeros(size + 1, np.int64)
    for room in range(1, size + 1):
        with_each = price[1 : room + 1] + worth[room - 1 :: -1][:room]
        best = int(with_each.argmax())
        if with_each[best] > worth[room - 1]:
            worth[room], last[room] = with_each[best], best + 1
        else:
            worth[room] = worth[room - 1]
    times, room = np.zeros(size + 1, np.int64), size
    while room:
        if last[room]:
            times[last[room]] += 1
            room -= last[room]
        else:
            room -= 1
    return times


def fractional(counts: np.ndarray, size: int) -> list[tuple[dict[int, int], float]]:
    """Patterns and how often to use them, covering all ``counts`` (by length) at least once."""
    active = np.flatnonzero(counts)
    covered = np.zeros(size + 1)
    used: dict[tuple, float] = {}
    while len(active) and covered[active].min() < 1:
        price = np.full(size + 1, -1.0)
        price[active] = np.exp(-RATE * covered[active]) / counts[active]
        times = best_pattern(price, size)
        at = np.flatnonzero(times)
        # within the shares that are open, so that lengths are not covered in excess
        step = STEP * (counts[at] / times[at]).min()
        covered[at] += step * times[at] / counts[at]
        key = tuple(zip(at.tolist(), times[at].tolist(), strict=True))
        used[key] = used.get(key, 0.0) + step
    return [(dict(key), x) for key, x in used.items()]


def best_fit(counts: np.ndarray, size: int) -> list[tuple[dict[int, int], int]]:
    """Whole patterns for all of ``counts``: the longest piece and the fullest possible rest."""
    counts, patterns = counts.copy(), []
    while counts.any():
        first = int(np.flatnonzero(counts)[-1])
        left = counts.copy()
        left[first] -= 1
        room = size - first
        # reach[r]: the length that last made up r, 0 if r cannot be made up
        reach, used = np.full(room + 1, -1, np.int64), np.zeros(room + 1, np.int64)
        reach[0] = 0
        for length in np.flatnonzero(left[: room + 1])[::-1]:
            used[:] = 0
            for r in range(int(length), room + 1):
                if reach[r] < 0 and reach[r - length] >= 0 and used[r - length] < left[length]:
                    reach[r], used[r] = length, used[r - length] + 1
            if reach[room] >= 0:
                break
        r = int(np.flatnonzero(reach >= 0)[-1])
        pattern = {first: 1}
        while r:
            length = int(reach[r])
            pattern[length] = pattern.get(length, 0) + 1
            r -= length
        n = min(int(counts[x]) // m for x, m in pattern.items())
        for x, m in pattern.items():
            counts[x] -= n * m
        patterns.append((pattern, n))
    return patterns


@dataclass
class Plan:
    """Which sequence and offset the k-th piece of a length takes; rows sorted by (length, begin)."""

    length: np.ndarray
    begin: np.ndarray  # first piece number of the row
    times: np.ndarray  # pieces of this length in one sequence
    sequence: np.ndarray  # first sequence of the row's pattern
    offset: np.ndarray  # of the first of them
    sequences: int

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # lengths are small, numbers below 2^52
        key = (self.length << 52) + self.begin
        row = np.searchsorted(key, (length << 52) + number, "right") - 1
        at = number - self.begin[row]
        return self.sequence[row] + at // self.times[row], self.offset[row] + at % self.times[row] * length


def plan(histogram: dict[int, int], size: int) -> Plan:
    """Pack ``histogram[length]`` pieces of each length."""
    left = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    taken, rows, sequences = np.zeros(size + 1, np.int64), [], 0

    def use(pattern: dict[int, int], n: int) -> None:
        nonlocal sequences
        offset = 0
        for length, times in sorted(pattern.items(), reverse=True):
            rows.append((length, int(taken[length]), times, sequences, offset))
            taken[length] += times * n
            left[length] -= times * n
            offset += times * length
        sequences += n

    for pattern, x in sorted(fractional(left, size), key=lambda p: -sum(k * m for k, m in p[0].items())):
        if n := min(int(x), *(int(left[k]) // m for k, m in pattern.items())):
            use(pattern, n)
    for pattern, n in best_fit(left, size):
        use(pattern, n)
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return Plan(*table.T, sequences)


def pack(items: DataFrame, order: list[str], size: int = 1024) -> DataFrame:
    """``items`` (with ``length`` from 1 to ``size``) and their sequence_id and offset.

    ``order`` names columns that tell the items apart; equal items are interchangeable. Sequences
    are numbered from 0 and filled without gaps. No items give no rows.
    """
    items = stage(items, "pieces")
    salt = F.pmod(F.xxhash64(*order), F.lit(SALTS)).cast("int")
    salted = items.withColumn("__salt", salt)
    sizes = stage(salted.groupBy("length", "__salt").agg(F.count("*").alias("__n")), "length_counts")
    histogram = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    if not histogram:
        return items.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    placed = items.sparkSession.sparkContext.broadcast(plan(histogram, size))
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    each = Window.partitionBy("length", "__salt").orderBy(*order)
    numbered = salted.withColumn("__number", F.row_number().over(each)).join(sizes, ["length", "__salt"])
    numbered = numbered.withColumn("__number", F.col("__number") - 1 + F.col("__before")).select(*items.columns, "__number")

    names = [*items.columns, "sequence_id", "offset"]

    def run(batches):
        for batch in batches:
            length, number = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "__number"))
            sequence, offset = placed.value.place(length, number)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names)

    schema = T.StructType([*items.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return numbered.mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int = 2, size: int = 1024, id_col: str = "doc_id",
    text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """The pieces of all documents and their places; see ``pieces`` and ``pack``."""
    found = pieces(docs, tokenizer_path, end_id, size, id_col, text_col, with_ids)
    return pack(found, ["id", "piece", "start", "ids_crc32"], size).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, from pieces packed ``with_ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rows = packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
    return rows.select("sequence_id", "ids")
