"""Vector codes by codebooks per part, learned exactly with anchors-hierarchy metric trees.

Vectors become integers, floor(``scale`` x), cut into equal parts. Each part position has a codebook
that rounds of assigning all parts to the nearest entry (ties to the lower index) and replacing each
entry by the floor of its parts' mean improve.

Each block of up to ``BLOCK`` vectors has a metric tree per part position, built once, from the middle
out: anchors are chosen one by one, each new one the point farthest from its anchor, stealing the
points nearer to it (only those beyond half the distance of the two anchors can be); anchors with many
points are divided again the same way; balls are then merged upwards, always the two with the
smallest common ball. A ball caches its points' sum and count.

A round walks the trees from their roots with the list of entries that may be nearest to some point of
the ball, inherited from the ball above. An entry leaves the list if the entry nearest to the centre
is nearer for the whole ball: |x - c|^2 - |x - b|^2 is linear in x, so it is at least its value at the
centre less 2 radius |c - b|. A ball with one entry left is wholly owned: its cached sum and
count are taken and no point is looked at. In leaves, the points choose among the entries that
are left. Bounds are in floating point with a margin; sums, distances and means are exact integers.

Only sums per entry leave a task: at most parts x entries x width numbers, whatever the input.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.session import stage

BLOCK = 4096  # vectors of a tree
LEAF = 64  # points of a ball that is not divided
LIMB = 32  # bits of a part of a sum


def safe_integers(values: np.ndarray, width: int) -> np.ndarray:
    """Integers of 64 bits where all squared distances of that width fit in, else Python's."""
    if values.dtype != object:
        return values
    small = 1 << ((61 - width.bit_length()) // 2 - 1)
    if not values.size or max(abs(values.min()), abs(values.max())) < small:
        return values.astype(np.int64)
    return values


def to_integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as exact integers."""
    with np.errstate(over="ignore"):
        product = np.floor(vectors * scale)
    if not product.size or np.abs(product).max() < 1 << 62:
        whole = product.astype(np.int64)
        small = 1 << ((61 - vectors.shape[1].bit_length()) // 2 - 1)
        return whole if not whole.size or np.abs(whole).max() < small else whole.astype(object)
    # 2^53 and beyond have no fraction left to lose
    rows = [[int(x) * scale if abs(x) >= 2.0**53 else int(np.floor(x * scale)) for x in v] for v in vectors.tolist()]
    return np.array(rows, object).reshape(vectors.shape)


def as_floats(values: np.ndarray) -> np.ndarray:
    """Nearest floats; infinite beyond their range, where bounds then decide nothing."""
    if values.dtype != object:
        return values.astype(float)
    most = int(np.finfo(float).max)
    flat = [float(x) if -most <= x <= most else np.copysign(np.inf, 1 if x > 0 else -1) for x in values.ravel().tolist()]
    return np.array(flat, float).reshape(values.shape)


def anchors(points: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner of each point, anchor of each owner); fewer than ``most`` if all points lie on anchors."""
    chosen = [0]
    owner = np.zeros(len(points), np.int64)
    far = np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < most:
        new = int(far.argmax())
        if not far[new] > 0:
            break
        between = np.linalg.norm(points[chosen] - points[new], axis=1)
        open_ = np.flatnonzero(far > between[owner] / 2)
        distance = np.linalg.norm(points[open_] - points[new], axis=1)
        stolen = distance < far[open_]
        owner[open_[stolen]] = len(chosen)
        far[open_[stolen]] = distance[stolen]
        chosen.append(new)
    return owner, np.array(chosen)


class Tree:
    """Balls over points: a ball's points are a slice of ``order``, its children two later balls."""

    def __init__(self, points: np.ndarray):
        floats = as_floats(points)
        self.order, ranges, children = [], [], []

        def lay(node) -> int:
            """Number of the ball of ``node``: an array of points, or a pair of nodes."""
            at, first = len(ranges), len(self.order)
            ranges.append(None)
            children.append((-1, -1))
            if isinstance(node, tuple):
                children[at] = (lay(node[0]), lay(node[1]))
            else:
                self.order.extend(node.tolist())
            ranges[at] = (first, len(self.order))
            return at

        lay(self._grown(floats, np.arange(len(points))))
        self.order = np.array(self.order, np.int32)
        self.children = np.array(children, np.int32)
        self.ranges = np.array(ranges, np.int32)
        first, end = self.ranges.T
        total = np.cumsum(np.vstack([points[:0].sum(axis=0)[None], points[self.order]]), axis=0)
        self.sums = total[end] - total[first]
        self.counts = (end - first).astype(np.int64)
        self.centres = as_floats(self.sums) / self.counts[:, None]
        with np.errstate(over="ignore", invalid="ignore"):
            laid = floats[self.order]
            self.radii = np.array([
                np.linalg.norm(laid[a:b] - c, axis=1).max() for (a, b), c in zip(self.ranges.tolist(), self.centres)
            ])
        self.radii = self.radii * (1 + 1e-9) + 1e-9

    def _grown(self, points, at):
        if len(at) <= LEAF:
            return at
        with np.errstate(over="ignore", invalid="ignore"):
            owner, chosen = anchors(points[at], max(int(np.sqrt(len(at))), 2))
        if len(chosen) < 2:
            return at
        groups = [at[owner == k] for k in range(len(chosen))]
        nodes = [self._grown(points, g) for g in groups]
        return merged(nodes, [points[g] for g in groups])


def merged(nodes: list, groups: list[np.ndarray]):
    """One node of all, the two with the smallest common ball joined first."""
    with np.errstate(over="ignore", invalid="ignore"):
        centres = np.array([g.mean(axis=0) for g in groups])
        radii = np.array([np.linalg.norm(g - c, axis=1).max() for g, c in zip(groups, centres)])
        counts = np.array([len(g) for g in groups], float)
        apart = np.linalg.norm(centres[:, None] - centres[None], axis=2)
        common = np.maximum(apart + radii[:, None] + radii[None], 0) / 2
        np.fill_diagonal(common, np.inf)
        common[np.isnan(common)] = np.finfo(float).max
        for _ in range(len(nodes) - 1):
            i, j = divmod(int(common.argmin()), len(nodes))
            if i == j:  # all distances overflow: any two will do
                i, j = [k for k, n in enumerate(nodes) if n is not None][:2]
            i, j = min(i, j), max(i, j)
            nodes[i], nodes[j] = (nodes[i], nodes[j]), None
            centre = (centres[i] * counts[i] + centres[j] * counts[j]) / (counts[i] + counts[j])
            radii[i] = max(np.linalg.norm(centres[k] - centre) + radii[k] for k in (i, j))
            centres[i], counts[i] = centre, counts[i] + counts[j]
            row = (np.linalg.norm(centres - centre, axis=1) + radii + radii[i]) / 2
            row[np.isnan(row)] = np.finfo(float).max
            row[[n is None for n in nodes]] = np.inf
            row[i] = np.inf
            common[i], common[:, i] = row, row
            common[j], common[:, j] = np.inf, np.inf
    return nodes[0]


def walk(tree: Tree, book: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(balls, lists) of all balls that are wholly owned, or leaves; lists[b, e] is True if entry e is left."""
    entries = as_floats(book)
    balls, lists = np.zeros(1, np.int64), np.ones((1, len(book)), bool)
    size = max(np.abs(entries).max(), np.abs(tree.centres).max())
    with np.errstate(over="ignore", invalid="ignore"):
        between = np.sqrt(((entries[:, None] - entries[None]) ** 2).sum(axis=2))
        while len(balls):
            distance = ((tree.centres[balls][:, None] - entries[None]) ** 2).sum(axis=2)
            best = np.where(lists, distance, np.inf).argmin(axis=1)
            least = distance[np.arange(len(balls)), best][:, None]
            reach = 2 * tree.radii[balls][:, None] * between[best]
            margin = 1e-9 * (distance + least + reach) + 1e-12 * size * size
            lists = lists & ~(distance - least > reach + margin)
            done = (lists.sum(axis=1) == 1) | (tree.children[balls, 0] < 0)
            yield balls[done], lists[done]
            balls, lists = np.concatenate(tree.children[balls[~done]].T), np.concatenate([lists[~done]] * 2)


def assign(tree: Tree, points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sums, counts, entry of each point in tree order, -1 in a wholly owned ball) of one round."""
    sums, counts = np.zeros(book.shape, object), np.zeros(len(book), np.int64)
    chosen = np.full(len(points), -1, np.int64)
    for balls, lists in walk(tree, book):
        one = lists.sum(axis=1) == 1
        for entry in np.unique(lists[one].argmax(axis=1)):
            mine = balls[one][lists[one].argmax(axis=1) == entry]
            sums[entry] += tree.sums[mine].sum(axis=0)
            counts[entry] += tree.counts[mine].sum()
        balls, lists = balls[~one], lists[~one]
        at, n = spread(tree.ranges[balls])
        if not len(at):
            continue
        x = points[tree.order[at]]
        distance = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        distance[~np.repeat(lists, n, axis=0)] = distance.max() + 1
        entry = distance.argmin(axis=1)
        chosen[at] = entry
        for e in np.unique(entry):
            sums[e] += x[entry == e].sum(axis=0)
            counts[e] += (entry == e).sum()
    return sums, counts, chosen


def spread(ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges, and the length of each."""
    n = (ranges[:, 1] - ranges[:, 0]).astype(np.int64)
    return np.repeat(ranges[:, 0] - np.cumsum(n) + n, n) + np.arange(int(n.sum())), n


def codes_of(tree: Tree, points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Entry of every point, in the order of ``points``."""
    _, _, chosen = assign(tree, points, book)
    for balls, lists in walk(tree, book):
        one = lists.sum(axis=1) == 1
        at, n = spread(tree.ranges[balls[one]])
        chosen[at] = np.repeat(lists[one].argmax(axis=1), n)
    out = np.empty(len(points), np.int64)
    out[tree.order] = chosen
    return out


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """(number, part) of an integer: parts of ``LIMB`` bits, the last one with the sign."""
    k = 0
    while not -(1 << 62) < value < 1 << 62:
        yield k, value & (1 << LIMB) - 1
        value >>= LIMB
        k += 1
    yield k, value


def blocks(rows: DataFrame, parts: int, scale: int) -> DataFrame:
    """(rows, tree) per block of vectors: its rows without the vector, and integers with a tree per part."""
    others = [f for f in rows.schema if f.name != "v"]

    def run(batches):
        held = []
        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= BLOCK:
                table = pa.Table.from_batches(held).combine_chunks()
                held = table.slice(BLOCK).to_batches()
                yield built(table.slice(0, BLOCK))
        if any(b.num_rows for b in held):
            yield built(pa.Table.from_batches(held).combine_chunks())

    def built(table):
        n = table.num_rows
        vectors = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, -1)
        whole = to_integers(vectors, scale)
        cut = np.split(whole, parts, axis=1)
        if whole.dtype != object and np.abs(whole).max(initial=0) < 1 << 30:
            whole = whole.astype(np.int32)  # half the size on disk
        blob = pickle.dumps((whole, [Tree(points) for points in cut]), protocol=5)
        columns = [table.column(f.name).combine_chunks() for f in others]
        columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
        kept = pa.StructArray.from_arrays(columns, [f.name for f in others])
        lists = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), kept)
        return pa.RecordBatch.from_arrays([lists, pa.array([blob], pa.binary())], ["rows", "tree"])

    kind = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in others)
    return rows.mapInArrow(run, f"rows array<struct<{kind}>>, tree binary")


def opened(blob: bytes) -> tuple[list[np.ndarray], list[Tree]]:
    whole, trees = pickle.loads(blob)
    whole = whole.astype(np.int64) if whole.dtype == np.int32 else whole
    return np.split(whole, len(trees), axis=1), trees


def round_sums(trees: DataFrame, books: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sums, counts) of each part position's entries over all blocks."""

    def run(batches):
        total = [(np.zeros(b.shape, object), np.zeros(len(b), np.int64)) for b in books]
        for batch in batches:
            for blob in batch.column("tree"):
                cut, forest = opened(blob.as_py())
                for k, (points, tree) in enumerate(zip(cut, forest, strict=True)):
                    sums, counts, _ = assign(tree, points, books[k])
                    total[k][0][:] += sums
                    total[k][1][:] += counts
        out = []
        for k, (sums, counts) in enumerate(total):
            for e in np.flatnonzero(counts).tolist():
                out.append((k, e, -1, 0, int(counts[e])))
                out += [(k, e, j, at, part) for j, x in enumerate(sums[e]) for at, part in limbs(int(x))]
        names = ["part", "entry", "place", "limb", "value"]
        kinds = [pa.int32()] * 4 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, kinds)], names)

    rows = trees.select("tree").mapInArrow(run, "part int, entry int, place int, limb int, value long")
    found = rows.groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value")).collect()
    total = [(np.zeros(b.shape, object), np.zeros(len(b), object)) for b in books]
    for r in found:
        if r.place < 0:
            total[r.part][1][r.entry] += r.value
        else:
            total[r.part][0][r.entry, r.place] += r.value << LIMB * r.limb
    return total


def compress(
    vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
    id_col: str = "vec_id", vector_col: str = "embedding", keep: Sequence[str] = (),
) -> tuple[DataFrame, list[list[tuple[int, ...]]]]:
    """(id_col, *keep, codes array<int>, error long) of every kept vector, and the codebooks.

    ``codes`` are the entries' indexes by part, ``error`` the sum of the squared distances (null beyond a
    long). Vectors that are null or hold a null or non-finite component are left out, and so are those
    of another length than the first by id whose length is a multiple of ``parts`` and not 0. Codebooks
    start with the vectors of the smallest ids, null ids last, equal ids by vector; fewer vectors than
    ``entries`` make smaller codebooks, none an empty result. Repeated rows count as often as
    they occur; null ids take part. Other columns than the named are not read.
    """
    vector = F.col(vector_col).cast("array<double>")
    names = [f"k{i}" for i in range(len(keep))]
    rows = vectors.select(F.col(id_col).alias("id"), *(F.col(c).alias(n) for c, n in zip(keep, names)), vector.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & (F.size("v") % parts == 0) & finite)
    by_id = (F.asc_nulls_last("id"), "v")
    first = rows.orderBy(*by_id).select("v").head(1)
    width = len(first[0].v) if first else parts
    rows = rows.where(F.size("v") == width)
    start = [r.v for r in rows.orderBy(*by_id).select("v").head(entries)]
    whole = to_integers(np.array(start, float).reshape(-1, width), scale)
    books = np.split(whole, parts, axis=1)
    trees = stage(blocks(rows, parts, scale), "vector_trees")
    for _ in range(rounds if start else 0):
        for k, (sums, counts) in enumerate(round_sums(trees, books)):
            # Python's integers, so floors go down and nothing overflows
            means = [[x // n for x in s] if n else old for s, n, old in zip(sums.tolist(), counts.tolist(), books[k].tolist())]
            books[k] = safe_integers(np.array(means, object).reshape(books[k].shape), width)

    def run(batches):
        for batch in batches:
            for lists, blob in zip(batch.column("rows"), batch.column("tree")):
                cut, forest = opened(blob.as_py())
                codes = np.stack([codes_of(t, x, b) for t, x, b in zip(forest, cut, books, strict=True)], axis=1)
                error = sum(((x - b[c]) ** 2).sum(axis=1) for x, b, c in zip(cut, books, codes.T, strict=True))
                error = [e if e < 1 << 63 else None for e in error.tolist()]
                flat = pa.array(codes.ravel(), pa.int32())
                coded = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1) * parts, pa.int32()), flat)
                columns = [*lists.values.flatten(), coded, pa.array(error, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["id", *names, "codes", "error"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "v")
    found = trees.mapInArrow(run, f"{kinds}, codes array<int>, error long")
    found = stage(found.toDF(id_col, *keep, "codes", "error"), "vector_codes")
    return found, [[tuple(int(x) for x in entry) for entry in book] for book in books]


# The same codes in DuckDB, a chain of tables for each round.
def _sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    assigned = """
    d{r} AS MATERIALIZED (
      SELECT row, part, entry, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS d
      FROM parts v JOIN c{r} c USING (part, pos) GROUP BY ALL),
    a{r} AS MATERIALIZED (SELECT row, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM d{r} GROUP BY ALL),"""
    updated = """
    c{n} AS MATERIALIZED (
      SELECT part, entry, pos, coalesce((s - ((s % n) + n) % n) // n, x) AS x
      FROM c{r} LEFT JOIN (SELECT part, entry, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
                           FROM parts JOIN a{r} USING (row, part) GROUP BY ALL) USING (part, entry, pos)),"""
    chain = "".join(assigned.format(r=r) + (updated.format(r=r, n=r + 1) if r < rounds else "") for r in range(rounds + 1))
    return f"""
    WITH kept AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row, vec_id, label, embedding FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (
      SELECT row, (i - 1) // (len(embedding) // {parts}) AS part, (i - 1) % (len(embedding) // {parts}) AS pos,
             CAST(floor({scale} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
      FROM (SELECT row, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
    c0 AS MATERIALIZED (SELECT part, row AS entry, pos, x FROM parts WHERE row < {entries}),{chain}
    digest AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM c{rounds}),
    coded AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY row),
    whole AS (SELECT kept.vec_id, kept.label, code, error FROM kept JOIN coded USING (row))
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM whole, digest
    """


SQL = _sql()
