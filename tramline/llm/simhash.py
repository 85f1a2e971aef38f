"""Near-duplicate documents by SimHash and the generalised pigeonhole principle.

A fingerprint is the bitwise majority of the XXH64 values of a text's word shingles. Two
fingerprints link at ``max_distance`` or fewer differing bits. With the 64 bits grouped into m
partitions and thresholds t_1..t_m >= -1 that add up to ``max_distance - m + 1``, every such pair
differs by at most t_i bits in at least one partition i (a partition with t_i = -1 is left out).

* Bits are grouped by correlation, measured on all distinct fingerprints, so that correlated bits
  share a partition and the other partitions stay selective.
* Candidate pairs per partition and threshold are estimated from exact histograms of 8-bit slices
  of all distinct fingerprints (256 counts a slice, whatever the input size). Dynamic programming
  over the partitions allots the thresholds; m is the number with the cheapest allotment.
* Each fingerprint is indexed by its partition values and probes every value within the threshold.
  Buckets over ``CELL`` rows are cut into chunks, and each pair of chunks is a cell of its own, so
  no task holds a whole bucket. A cell verifies the full distance and hands on only a spanning
  forest of its links, at most one edge for each of its fingerprints, never all pairs of a group.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.graph import components
from tramline.llm.words import Words, text_slices
from tramline.session import stage

BITS = 64
CELL = 512  # rows of a chunk of a large bucket
PAIR_COST = 0.01  # one comparison, in units of one indexed or probing row


def fingerprint(words: list[bytes], size: int, seed: int = 42) -> int:
    """SimHash of the ``size``-word shingles; of the whole sequence if it is shorter, 0 if empty."""
    if not words:
        return 0
    n = max(len(words) - size + 1, 1)
    if len(words) < size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    h = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        part = np.ascontiguousarray(h[at : at + (1 << 16)]).astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id_col, fingerprint long) for every row. Null text counts as empty: fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "t"):
            w = Words(batch.column("t"), lower=True)
            text, starts, ends = w.bytes.tobytes(), w.starts.tolist(), w.ends.tolist()
            words = [text[s:e] for s, e in zip(starts, ends, strict=True)]
            found = [fingerprint(words[a:b], shingle) for a, b in itertools.pairwise(w.first.tolist())]
            signed = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), signed], ["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(run, "id long, fp long").select(F.col("id").alias(id_col), F.col("fp").alias("fingerprint"))


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _total(rows: DataFrame, counts) -> np.ndarray:
    """Sum of ``counts(values) -> 1-d int array`` over all batches; one row per task reaches the shuffle."""

    def run(batches):
        total = None
        for batch in batches:
            part = counts(batch.column("fp").to_numpy(zero_copy_only=False))
            total = part if total is None else total + part
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"k": at.astype(np.int64), "n": total[at].astype(np.int64)})

    sums = rows.select("fp").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
    return {r.k: r.n for r in sums.collect()}


def bit_groups(rows: DataFrame, n: int, parts: int) -> list[list[int]]:
    """64 bits in ``parts`` groups of about equal size, most correlated bits together."""

    def pairs(values):
        total = np.zeros(BITS * BITS, np.int64)
        for at in range(0, len(values), 1 << 16):
            b = _bits(values[at : at + (1 << 16)]).astype(np.float32)
            total += np.rint(b.T @ b).astype(np.int64).ravel()
        return total

    both = np.zeros(BITS * BITS)
    for k, v in _total(rows, pairs).items():
        both[k] = v
    both = both.reshape(BITS, BITS) / max(n, 1)
    p = both.diagonal()
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    left, groups = set(range(BITS)), []
    for i in range(parts):
        size = len(left) // (parts - i)
        first = max(sorted(left), key=lambda b: corr[b, sorted(left)].sum())
        group = [first]
        left.discard(first)
        while len(group) < size:
            nxt = max(sorted(left), key=lambda b: corr[b, group].sum())
            group.append(nxt)
            left.discard(nxt)
        groups.append(sorted(group))
    return groups


def slice_histograms(rows: DataFrame, groups: list[list[int]]) -> list[list[np.ndarray]]:
    """For each group, the value counts of its slices of 8 bits or fewer."""
    slices = [[g[i : i + 8] for i in range(0, len(g), 8)] for g in groups]
    flat = [s for g in slices for s in g]

    def counts(values):
        b = _bits(values)
        return np.concatenate([np.bincount(_pack(b, s).astype(np.int64), minlength=256) for s in flat])

    total = np.zeros(256 * len(flat), np.int64)
    for k, v in _total(rows, counts).items():
        total[k] = v
    parts = iter(total.reshape(-1, 256))
    return [[next(parts) for _ in g] for g in slices]


def _pack(bits: np.ndarray, at: list[int]) -> np.ndarray:
    return (bits[:, at].astype(np.uint64) << np.arange(len(at), dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def distance_shares(histograms: list[np.ndarray], most: int) -> np.ndarray:
    """Estimated share of pairs at distance 0..most in one partition, slices taken as independent."""
    weight = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8))
    share = np.array([1.0])
    for h in histograms:
        p = h / max(h.sum(), 1)
        share = np.convolve(share, np.bincount(weight.ravel(), np.outer(p, p).ravel(), 9))
    return np.pad(share, (0, most + 1))[: most + 1]


def allot(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 that add up to ``total`` at the least cost; costs[i][t + 1] is that of t."""
    best = {0: (0.0, [])}
    for row in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for k, c in enumerate(row):
                if (old := after.get(used + k)) is None or cost + c < old[0]:
                    after[used + k] = (cost + c, [*chosen, k - 1])
        best = after
    return best[total + len(costs)]


def plan(rows: DataFrame, n: int, max_distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition in use, the cheapest over all numbers of partitions."""
    found = []
    for parts in range(1, max_distance + 2):
        groups = bit_groups(rows, n, parts)
        costs = []
        for g, h in zip(groups, slice_histograms(rows, groups), strict=True):
            near = np.cumsum(distance_shares(h, max_distance)) * n * n / 2
            probes = np.cumsum([math.comb(len(g), t) for t in range(max_distance + 1)])
            costs.append([0.0, *(n * p * (1 if not t else 2) + PAIR_COST * c for t, (p, c) in enumerate(zip(probes, near, strict=True)))])
        cost, thresholds = allot(costs, max_distance - parts + 1)
        found.append((cost, [(g, t) for g, t in zip(groups, thresholds, strict=True) if t >= 0]))
    return min(found, key=lambda x: x[0])[1]


def near_links(prints: DataFrame, max_distance: int = 3) -> DataFrame:
    """Edges (a, b) between ids of ``prints`` (id, fp; one row per fp) that connect every pair
    of fingerprints at ``max_distance`` or fewer differing bits, as spanning forests of the cells."""
    n = prints.count()
    if n < 2:
        return prints.selectExpr("id AS a", "id AS b").where("false")
    parts = plan(prints, n, max_distance)

    def keys(batches):
        for batch in batches:
            ids, fps = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "fp"))
            for at in range(0, len(fps), 2048):
                bits = _bits(fps[at : at + 2048])
                for i, (group, t) in enumerate(parts):
                    own = _pack(bits, group)
                    for d in range(t + 1):
                        for flip in itertools.combinations(range(len(group)), d):
                            # role 0: compared with all; 1: is probed by; 2: probes
                            role = 0 if not t else 1 + (d > 0)
                            value = own ^ np.uint64(sum(1 << b for b in flip))
                            yield _rows(i, value, role, ids[at : at + 2048], fps[at : at + 2048])
                    if t:  # its own value too: equal partition values meet
                        yield _rows(i, own, 2, ids[at : at + 2048], fps[at : at + 2048])

    keyed = stage(prints.select("id", "fp").mapInArrow(keys, "p int, k long, role int, id long, fp long"), "keys")
    sizes = keyed.groupBy("p", "k").agg(F.count("*").alias("n")).where(F.col("n") > CELL)
    sizes = stage(sizes.select("p", "k", F.ceil(F.col("n") / CELL).cast("int").alias("chunks")), "hot_buckets")
    dealt = keyed.join(sizes, ["p", "k"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.select(
        "p", "k", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "role", "id", "fp"
    )
    cells = dealt.repartition("p", "k", "x", "y").sortWithinPartitions("p", "k", "x", "y")

    def verify(batches):
        held = None
        for batch in batches:
            rows = batch.to_pandas()
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            cell = rows[["p", "k", "x", "y"]].to_numpy()
            new = np.ones(len(cell), bool)
            new[1:] = (cell[1:] != cell[:-1]).any(axis=1)
            last = int(np.flatnonzero(new)[-1]) if len(new) else 0
            held = rows.iloc[last:]
            if last:
                yield _forest(rows.iloc[:last], new[:last], max_distance)
        if held is not None and len(held):
            yield _forest(held, None, max_distance)

    return cells.mapInArrow(verify, "a long, b long").distinct()


def _rows(part, keys, role, ids, fps):
    n = len(ids)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, part, np.int32)),
            pa.array(keys.view(np.int64)),
            pa.array(np.full(n, role, np.int32)),
            pa.array(ids),
            pa.array(fps),
        ],
        ["p", "k", "role", "id", "fp"],
    )


def _forest(rows: pd.DataFrame, new: np.ndarray | None, most: int) -> pa.RecordBatch:
    """Verified links of whole cells, each node tied to the smallest node of its group in the cell."""
    ids, fps, role, own = (rows[c].to_numpy() for c in ("id", "fp", "role", "own"))
    fps = fps.view(np.uint64)  # bitwise_count takes absolute values of signed numbers
    starts = np.array([0]) if new is None else np.flatnonzero(new)
    ends = np.append(starts[1:], len(ids))
    edges = []
    small = (ends - starts) <= 64
    # Small cells at once: compare each row with the one d places on.
    size = np.repeat(np.where(small, ends - starts, 0), ends - starts)
    place = np.arange(len(ids)) - np.repeat(starts, ends - starts)
    same_cell_chunk = rows["x"].to_numpy() == rows["y"].to_numpy()
    for d in range(1, int(size.max(initial=0))):
        i = np.flatnonzero(place + d < size)
        j = i + d
        near = np.bitwise_count(fps[i] ^ fps[j]) <= most
        meets = ((role[i] == 0) | (role[i] + role[j] == 3)) & (same_cell_chunk[i] | (own[i] != own[j]))
        hit = near & meets
        edges.append((ids[i[hit]], ids[j[hit]]))
    for s, e in zip(starts[~small], ends[~small], strict=True):
        f, r, o = fps[s:e], role[s:e], own[s:e]
        near = np.bitwise_count(f[:, None] ^ f[None, :]) <= most
        meets = (r[:, None] == 0) | (r[:, None] + r[None, :] == 3)
        near &= meets & (same_cell_chunk[s] | (o[:, None] != o[None, :]))
        np.fill_diagonal(near, True)
        label = np.arange(e - s)
        while True:
            lower = np.where(near, label[None, :], e).min(axis=1)
            lower = np.minimum(label, lower)[np.minimum(label, lower)]
            if (lower == label).all():
                break
            label = lower
        edges.append((ids[s:e][label], ids[s:e]))
    a, b = (np.concatenate([x[k] for x in edges]) if edges else np.zeros(0, np.int64) for k in (0, 1))
    keep = a != b
    return pa.RecordBatch.from_arrays([pa.array(a[keep].astype(np.int64)), pa.array(b[keep].astype(np.int64))], ["a", "b"])


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 3
) -> DataFrame:
    """(id_col, fingerprint long, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id that links reach. Null or empty texts have fingerprint
    zero and link like any other. Rows with a null id get their fingerprint and a null component
    and link nothing. A repeated id with different texts ties their fingerprints together. Other
    columns of ``docs`` are not read; an empty table gives no rows.
    """
    prints = stage(fingerprints(docs, id_col, text_col, shingle).toDF("id", "fp"), "fingerprints")
    classes = stage(prints.where("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("id")), "classes")
    links = near_links(classes, max_distance)
    repeated = prints.where("id IS NOT NULL").groupBy("id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).where("x <> y")
    several = prints.join(repeated.select("id"), "id", "left_semi").join(classes.withColumnRenamed("id", "rep"), "fp")
    links = links.unionByName(several.select(F.col("id").alias("a"), F.col("rep").alias("b")))
    groups = components(links)
    classes = classes.join(groups, classes.id == groups.node, "left").select(
        "fp", F.coalesce("component", "id").alias("component_id")
    )
    classes = stage(classes, "fingerprint_groups")
    return prints.join(classes, "fp", "left").select(
        F.col("id").alias(id_col),
        F.col("fp").alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group, in the columns of ``docs``.

    A repeated id keeps one row. Rows with a null id stay.
    """
    groups = near_duplicates(docs, id_col, text_col, **how)
    kept = groups.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("__id")).distinct()
    rows = docs.join(kept, docs[id_col] == kept["__id"], "left_semi").dropDuplicates([id_col])
    return rows.unionByName(docs.where(F.col(id_col).isNull()))
