"""Near-duplicate vectors: exact cosine threshold pairs by dual traversal of cover trees.

Unit vectors with cosine >= c lie within t = sqrt(2 - 2c) of each other. A cover tree has nested
levels whose radii halve; a pair of nodes is dropped when the distance of their centres exceeds
the sum of their covering radii by more than t, else their children are compared.

* Equal vectors are one weighted point, so copies are never compared with each other.
* The top level (at most ``max_cells`` centres) is built from a bounded sample of ``sample_rows``
  vectors; every vector is then assigned to its nearest centre and the true covering radii are
  measured. The sample decides only where the cells lie, never what is found.
* Cells over ``UNIT`` vectors are cut into units, each with its own cover tree, and units of
  neighbouring cells make up blocks of at most ``BLOCK`` vectors. A pair of blocks is a task's work; a vector
  goes only to blocks with a cell that is within t of it and whose bisector is. Many vectors are sent as
  one row. Tasks are run in rounds, and a round sends no more bytes than the trees have twice, so
  that what lies on disk grows with the input only, whatever the number of pairs.
* Inside a pair of blocks, the trees are traversed together. Nodes are first compared by a few
  leading axes of a sample and the lengths of what these leave out: a dot product and a product of
  lengths that bound the cosine from above. The leaves compute cosines in double precision, and a task
  hands on link counts and a spanning forest, one row for each linked vector, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.llm.graph import components, discard, release
from tramline.session import stage, stage_path

UNIT = 2048  # vectors of one unit
BLOCK = 1 << 15  # vectors of one block at most, of no more than BLOCK_BYTES (one unit at least)
BLOCK_BYTES = 1 << 24
ROW_BYTES = 1 << 20  # of the vectors sent as one row (one vector at least)
ROUND_BYTES = 1 << 28  # sent in one round, or twice the bytes of all trees if these are more
SIDE = 1024  # nodes of two trees that are compared at once
DENSE = 64  # all pairs of children are compared at once if one of so many is wanted
SLACK = 1e-9  # for rounding, in distances and cosines; such pairs are computed once more


def nested_centres(points: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` points of the nested levels with radii 1, 1/2, 1/4, ..."""
    chosen, radius = [0], 1.0
    nearest = _distances(points[:1], points)[0]
    while len(chosen) < most and nearest.max() > SLACK:
        for i in np.flatnonzero(nearest > radius):
            if nearest[i] > radius and len(chosen) < most:
                chosen.append(int(i))
                nearest = np.minimum(nearest, _distances(points[i : i + 1], points)[0])
        radius /= 2
    return points[chosen]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Between unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def chain(gap: np.ndarray) -> list[int]:
    """The centres in an order in which each is followed by the nearest one left."""
    order, left = [0], np.arange(1, len(gap))
    while len(left):
        k = gap[order[-1], left].argmin()
        order.append(int(left[k]))
        left = np.delete(left, k)
    return order


def leading_axes(points: np.ndarray, cosine: float) -> np.ndarray:
    """As many leading axes (columns) of ``points`` as make comparisons cheapest; any axes keep the bound."""
    dim = points.shape[1]
    most = min(dim, 64)
    centred = points - points.mean(axis=0)
    start = np.random.default_rng(0).normal(size=(dim, most)) if most < dim else np.eye(dim)
    basis = np.linalg.qr(centred.T @ (centred @ start) if most < dim else start)[0]
    spread = centred @ basis
    axes = basis @ np.linalg.eigh(spread.T @ spread)[1][:, ::-1]
    axes = np.linalg.qr(axes)[0]
    best, least = axes, math.inf
    for k in range(4, most + 1, 4):
        low = shortened(points[:SIDE], axes[:, :k])
        left = (low @ low.T >= cosine).mean()
        cost = 20 + k + 20000 * left  # what passes is computed again, one by one
        if cost < least:
            best, least = axes[:, :k], cost
    return best


def shortened(points: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Unit vectors along ``axes``, and the length that these leave out; dot products are at least the cosines."""
    along = points @ axes
    rest = np.sqrt(np.maximum(1 - (along * along).sum(axis=1), 0))
    return np.column_stack([along, rest]).astype(np.float32)


def levels(reach: float) -> list[float]:
    """Halving radii of the levels below a cell."""
    radii = [1.0]
    while radii[-1] > reach / 2:
        radii.append(radii[-1] / 2)
    return radii


def cover(points: np.ndarray, radii: list[float]) -> np.ndarray:
    """For each vector the index of its centre on each level; a centre stays one on all levels below."""
    label = np.zeros((len(points), len(radii)), np.int32)
    groups = [np.arange(len(points))]
    for k, radius in enumerate(radii):
        below = []
        for group in groups:
            far = _distances(points[group], points[group]) > radius
            left = np.ones(len(group), bool)
            for i in range(len(group)):
                if left[i]:
                    own = left & ~far[i]
                    own[i] = True
                    left &= ~own
                    members = group[own]
                    label[members, k] = group[i]
                    if len(members) > 1:
                        below.append(members)
                    else:
                        label[members, k:] = group[i]
        groups = below
    return label


class Tree:
    """Nodes of all levels of the units of one block; the vectors of a node are neighbours in the order kept here."""

    def __init__(self, rows: np.ndarray, points: np.ndarray, low: np.ndarray, unit: np.ndarray, labels: np.ndarray):
        """rows: places of the block's vectors; labels: the level centres of each in its unit, as ``cover`` gives them.

        Where only some vectors of a unit are at hand, a node's first vector stands in as its
        centre; radii are measured on the vectors at hand, so the bounds hold all the same.
        """
        order = np.lexsort((*labels.T[::-1], unit))
        self.rows = rows[order]
        self.points = points[self.rows]
        self.low = low[self.rows]
        self.starts, self.centres, self.radii = [], [], []
        new = np.append(True, np.diff(unit[order]) != 0)
        for label in labels[order].T:
            new = new | np.append(True, label[1:] != label[:-1])
            starts = np.flatnonzero(new)
            centre = starts
            size = np.diff(np.append(starts, len(order)))
            off = self.points - np.repeat(self.points[centre], size, axis=0)
            far = np.sqrt((off * off).sum(axis=1))
            self.starts.append(starts)
            self.centres.append(centre)
            self.radii.append(np.maximum.reduceat(far, starts))
        every = np.arange(len(order))
        self.starts.append(every)
        self.centres.append(every)
        self.radii.append(np.zeros(len(order)))

    def bounds(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """First and past-last vector of each node."""
        starts = self.starts[level]
        return starts, np.append(starts[1:], len(self.rows))

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = (x[nodes] for x in self.bounds(level))
        below = self.starts[level + 1]
        return np.searchsorted(below, lo), np.searchsorted(below, hi)


class Links:
    """Link counts and groups of the vectors of one task."""

    def __init__(self, raw: np.ndarray, weight: np.ndarray, cosine: float):
        self.raw, self.weight, self.cosine = raw, weight, cosine
        self.count = np.zeros(len(raw), np.int64)
        self.label = np.arange(len(raw))

    def verify(self, a: np.ndarray, b: np.ndarray, cos: np.ndarray) -> None:
        """Keep the pairs at the threshold or above it; close calls use the vectors as given."""
        near = cos >= self.cosine
        for k in np.flatnonzero(np.abs(cos - self.cosine) < SLACK):
            u, v = self.raw[a[k]].astype(np.float64), self.raw[b[k]].astype(np.float64)
            near[k] = (u @ v) / (math.sqrt(u @ u) * math.sqrt(v @ v)) >= self.cosine
        a, b = a[near], b[near]
        np.add.at(self.count, a, self.weight[b])
        np.add.at(self.count, b, self.weight[a])
        self.join(a, b)

    def verify_all(self, a: np.ndarray, b: np.ndarray, cos: np.ndarray, once: bool) -> None:
        """The same for all pairs of ``a`` and ``b``; ``once``: these are the same, and each pair counts once."""
        near = cos >= self.cosine
        for i, j in zip(*np.nonzero(np.abs(cos - self.cosine) < SLACK)):
            u, v = self.raw[a[i]].astype(np.float64), self.raw[b[j]].astype(np.float64)
            near[i, j] = (u @ v) / (math.sqrt(u @ u) * math.sqrt(v @ v)) >= self.cosine
        if once:
            near = np.triu(near, 1)
        self.count[a] += near @ self.weight[b]
        self.count[b] += self.weight[a] @ near
        if (self.label[a] != self.label[a[0]]).any() or (self.label[b] != self.label[a[0]]).any():
            i, j = np.nonzero(near)
            self.join(a[i], b[j])

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.label[a], self.label[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while (self.label[self.label] != self.label).any():
                self.label = self.label[self.label]


def traverse(a: Tree, b: Tree, reach: float, links: Links) -> None:
    """Verify all pairs that no covering-radius bound rules out; ``a is b`` compares within."""
    last = len(a.starts) - 1
    room = np.empty(SIDE * SIDE, np.float32), np.empty(SIDE * SIDE + 8, bool)
    # where vectors are mostly alone in their nodes, the levels above rule out nothing
    sizes = [len(x) * len(y) for x, y in zip(a.starts, b.starts)]
    first = max(k for k, size in enumerate(sizes) if size <= 4 * sizes[0])
    todo = [(first, (0, len(a.starts[first])), (0, len(b.starts[first])))]
    while todo:
        level, nodes_a, nodes_b = todo.pop()
        for i in range(*nodes_a, SIDE):
            for j in range(*nodes_b, SIDE):
                p, q = (i, min(i + SIDE, nodes_a[1])), (j, min(j + SIDE, nodes_b[1]))
                if a is b and q[1] <= p[0]:
                    continue  # compared as (q, p)
                x, y = _near_nodes(a, b, level, p, q, reach, room)
                if a is b:
                    x, y = x[x <= y], y[x <= y]
                area = (p[1] - p[0]) * (q[1] - q[0])
                if level == last:
                    if len(x) * DENSE > area:
                        s, t = slice(*p), slice(*q)
                        links.verify_all(a.rows[s], b.rows[t], a.points[s] @ b.points[t].T, a is b and p == q)
                        continue
                elif len(x):
                    (alo, ahi), (blo, bhi) = a.children(level, x), b.children(level, y)
                    below_a, below_b = (alo.min(), ahi.max()), (blo.min(), bhi.max())
                    wanted, area = (ahi - alo) @ (bhi - blo), (below_a[1] - below_a[0]) * (below_b[1] - below_b[0])
                    if wanted > SIDE and wanted * DENSE > area:
                        if a is b and p == q:  # the same children on both sides
                            below_a = below_b = (min(below_a[0], below_b[0]), max(below_a[1], below_b[1]))
                        todo.append((level + 1, below_a, below_b))
                        continue
                _descend(a, b, level, x, y, reach, links)


def _near_nodes(a, b, level, p, q, reach, room):
    """Pairs of nodes within reach. Single precision and few axes, with room for the error, rule out most."""
    u, v = (t.low[t.centres[level][slice(*r)]] for t, r in ((a, p), (b, q)))
    rough = 2e-7 * (u.shape[1] + 8)
    shape, size = (len(u), len(v)), len(u) * len(v)
    cos = np.dot(u, v.T, out=room[0][:size].reshape(shape))
    ra, rb = a.radii[level][slice(*p)], b.radii[level][slice(*q)]

    def least(far):
        return np.where(far < 2, 1 - far * far / 2 - rough, -2).astype(np.float32)

    near = np.greater_equal(cos, least(reach), out=room[1][:size].reshape(shape))
    if ra.any() or rb.any():
        wide = np.flatnonzero(ra)
        near[wide] = cos[wide] >= least(ra[wide, None] + rb + reach)
        wide = np.flatnonzero(rb)
        near[:, wide] = cos[:, wide] >= least(ra[:, None] + rb[wide] + reach)
    flat = room[1][: -(-size // 8) * 8]
    flat[size:] = False
    at = (np.flatnonzero(flat.view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()  # words first, most are 0
    at = at[flat[at]]
    return at // len(v) + p[0], at % len(v) + q[0]


def _descend(a, b, level, x, y, reach, links):
    last = len(a.starts) - 1
    todo = [(level, x, y)]
    while todo:
        level, x, y = todo.pop()
        if len(x) > 1 << 16:
            half = len(x) // 2
            todo += [(level, x[:half], y[:half]), (level, x[half:], y[half:])]
            continue
        cos = np.einsum("ij,ij->i", a.points[a.centres[level][x]], b.points[b.centres[level][y]])
        if level == last:
            real = x != y if a is b else np.ones(len(x), bool)
            links.verify(a.rows[x[real]], b.rows[y[real]], cos[real])
            continue
        near = np.sqrt(np.maximum(2 - 2 * cos, 0)) <= a.radii[level][x] + b.radii[level][y] + reach
        x, y = x[near], y[near]
        (alo, ahi), (blo, bhi) = a.children(level, x), b.children(level, y)
        size = (ahi - alo) * (bhi - blo)
        # children of as many pairs as make up one step
        cut = np.searchsorted(np.cumsum(size), 1 << 18, "right")
        if cut < len(x):
            cut = max(cut, 1)
            todo.append((level, x[cut:], y[cut:]))
            x, y, alo, blo, bhi, size = x[:cut], y[:cut], alo[:cut], blo[:cut], bhi[:cut], size[:cut]
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        wide = np.repeat(bhi - blo, size)
        u, v = np.repeat(alo, size) + at // np.maximum(wide, 1), np.repeat(blo, size) + at % np.maximum(wide, 1)
        if a is b:  # a node with itself: each pair of children once
            once = (np.repeat(x != y, size)) | (u <= v)
            u, v = u[once], v[once]
        if len(u):
            todo.append((level + 1, u, v))


def _matrix(column: pa.Array, kind: str, dim: int) -> np.ndarray:
    """Values packed as bytes, ``dim`` in a row."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim)


def _unit(raw: np.ndarray) -> np.ndarray:
    """In double precision."""
    scaled = raw.astype(np.float64)
    scaled /= np.abs(scaled).max(axis=1, keepdims=True)  # squares of very large or small values stay finite
    scaled /= np.linalg.norm(scaled, axis=1, keepdims=True)
    return scaled


def _valid(vector: str):
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def link_counts(
    classes: DataFrame, dim: int, cosine: float, max_cells: int = 256, sample_rows: int = 2048, spent: bool = False
) -> DataFrame:
    """(id, n, root) partial link counts and spanning edges of ``classes`` (id, w, v array) of one length.

    spent: the staged table that ``classes`` reads is deleted as soon as it is not needed any more.
    """
    spark = classes.sparkSession
    reach = math.sqrt(max(2 - 2 * cosine, 0)) + SLACK
    single = classes.schema["v"].dataType.elementType == T.FloatType()
    kind = "<f4" if single else "<f8"
    radii = levels(reach)
    bytes_each = dim * np.dtype(kind).itemsize + 4 * len(radii) + 20

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v").flatten().cast(pa.float32() if single else pa.float64()).to_numpy(zero_copy_only=False)
            packed = pa.array([r.tobytes() for r in np.ascontiguousarray(v, kind).reshape(-1, dim)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("w"), batch.column("h"), packed], ["id", "w", "h", "v"])

    def packed(df):
        return df.select("id", "w", "h", "v").mapInArrow(pack, "id long, w long, h long, v binary")

    hashed = classes.withColumn("h", F.xxhash64("v"))
    total = classes.count()
    drawn = packed(hashed.orderBy("h", "id").limit(sample_rows)).select("v").collect()
    sample = _unit(np.frombuffer(b"".join(r.v for r in drawn), kind).reshape(-1, dim))
    centres = nested_centres(sample, max(1, min(max_cells, total // UNIT * 2)))
    axes = leading_axes(sample, cosine)
    gap = _distances(centres, centres)
    order = chain(gap)

    def nearest(batch):
        return _distances(_unit(_matrix(batch.column("v"), kind, dim)), centres).argmin(axis=1)

    def tally(batches):
        for batch in batches:
            cell, n = np.unique(nearest(batch), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(n)], ["cell", "n"])

    rows = np.zeros(len(centres), np.int64)
    for r in packed(hashed).mapInArrow(tally, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        rows[r.cell] = r.n
    units = np.maximum(-(-rows // UNIT), 1)
    base = np.zeros(len(centres), np.int64)
    base[order] = np.cumsum(units[order]) - units[order]
    # units one after the other, in blocks of about as many vectors each
    full = min(max(BLOCK_BYTES // bytes_each, 1), BLOCK, max(UNIT, total // 8))
    each = np.repeat((rows / units)[order], units[order])
    blocks = max(1, min(-(-total // full), len(each)))
    block_of = np.minimum((np.cumsum(each) - each / 2) * blocks / max(total, 1), blocks - 1).astype(np.int64)

    def number(batches):
        for batch in batches:
            cell = nearest(batch)
            unit = base[cell] + (batch.column("h").to_numpy().view(np.uint64) % units[cell].astype(np.uint64)).astype(np.int64)
            arrays = [batch.column(c) for c in ("id", "w", "v")] + [pa.array(x.astype(np.int32)) for x in (cell, unit)]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "w", "v", "cell", "unit"])

    def plant(table: pa.Table) -> pa.Table:
        """The lower levels of one unit, built once."""
        table = table.combine_chunks()
        points = _unit(_matrix(table["v"], kind, dim))
        off = points - centres[table["cell"].to_numpy()]
        path = pa.array([r.tobytes() for r in cover(points, radii)], pa.binary())
        return table.append_column("d", pa.array(np.sqrt((off * off).sum(axis=1)))).append_column("path", path)

    fields = "id long, w long, v binary, cell int, unit int"
    numbered = packed(hashed).mapInArrow(number, fields)
    planted = stage(numbered.groupBy("unit").applyInArrow(plant, f"{fields}, d double, path binary"), "cover_trees")
    if spent:
        discard(classes)
    release(planted)
    radius = np.zeros(len(centres))
    for r in planted.groupBy("cell").agg(F.max("d").alias("r")).collect():
        radius[r.cell] = r.r
    cells_of = np.zeros((len(centres), blocks), np.float32)
    for c in range(len(centres)):
        cells_of[c, block_of[base[c] : base[c] + units[c]]] = 1

    def targets(batch):
        """The block of each vector, and all blocks that can hold partners."""
        cell, mine = batch.column("cell").to_numpy(), batch.column("d").to_numpy()
        d = _distances(_unit(_matrix(batch.column("v"), kind, dim)), centres)
        # a pair across two cells lies within reach of the cells' bisector
        edge = d**2 - mine[:, None] ** 2 <= 2 * gap[cell] * reach + SLACK
        meets = edge & (d <= radius + reach + SLACK)
        meets[np.arange(len(d)), cell] = True
        return block_of[batch.column("unit").to_numpy()], meets.astype(np.float32) @ cells_of > 0

    def volume(batches):
        for batch in batches:
            own, goes = targets(batch)
            sent = np.zeros((blocks, blocks), np.int64)
            np.add.at(sent, own, goes)
            a, b = np.nonzero(sent)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(sent[a, b])], ["a", "b", "n"])

    sent = np.zeros((blocks, blocks), np.int64)
    for r in planted.mapInArrow(volume, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
        sent[r.a, r.b] = r.n

    def deal(wanted):
        def dealt(batches):
            for batch in batches:
                own, goes = targets(batch)
                goes &= wanted[own]
                v, path = _matrix(batch.column("v"), kind, dim), _matrix(batch.column("path"), "<i4", len(radii))
                values = [*(batch.column(c).to_numpy() for c in ("unit", "id", "w")), v, path]
                for a in np.unique(own):
                    for b in np.flatnonzero(goes[own == a].any(axis=0)):
                        at = np.flatnonzero((own == a) & goes[:, b])
                        for part in np.array_split(at, -(-len(at) * bytes_each // ROW_BYTES)):
                            key = [pa.array([int(x)]) for x in (min(a, b), max(a, b), a)]
                            many = [pa.array([x[part].tobytes()], pa.binary()) for x in values]
                            yield pa.RecordBatch.from_arrays([*key, *many], ["a", "b", "own", "unit", "id", "w", "v", "path"])

        return dealt

    def pairs(table: pa.Table) -> pa.Table:
        own = table["own"].to_numpy()
        unit, ids, w = (_matrix(table[c], x, 1)[:, 0] for c, x in (("unit", "<i4"), ("id", "<i8"), ("w", "<i8")))
        raw, path = _matrix(table["v"], kind, dim), _matrix(table["path"], "<i4", len(radii))
        own = np.repeat(own, [len(x) // 8 for x in table["id"].to_pylist()])
        points = _unit(raw)
        low = shortened(points, axes)
        links = Links(raw, w, cosine)
        trees = {}
        for u in np.unique(own):
            at = np.flatnonzero(own == u)
            trees[u] = Tree(at, points, low, unit[at], path[at])
        a, b = (trees.get(table[c][0].as_py()) for c in ("a", "b"))
        if a is not None and b is not None:
            traverse(a, b, reach, links)
        at = np.flatnonzero(links.count)
        return pa.table({"id": ids[at], "n": links.count[at], "root": ids[links.label[at]]})

    path = stage_path(spark, "links")
    shape = "id long, n long, root long"
    spark.createDataFrame([], shape).write.parquet(path)
    for wanted in rounds(sent, max(ROUND_BYTES // bytes_each, 2 * total)):
        tasks = int(np.triu(wanted).sum())
        dealt = planted.mapInArrow(deal(wanted), "a long, b long, own long, unit binary, id binary, w binary, v binary, path binary")
        # more partitions than tasks, so that few hold two
        found = dealt.repartition(tasks + min(3 * tasks, 64), "a", "b").groupBy("a", "b").applyInArrow(pairs, shape)
        found.write.mode("append").parquet(path)
        del dealt, found
        release(planted)
    discard(planted)
    return spark.read.schema(shape).parquet(path)


def rounds(sent: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """The pairs of blocks that vectors go between, both ways, in turns of about ``most`` vectors (one pair at least)."""
    both = np.minimum(sent, sent.T) > 0
    wanted, n = np.zeros_like(both), 0
    for off in range(len(sent)):
        for a in range(len(sent) - off):
            b = a + off
            if not both[a, b]:
                continue
            more = sent[a, b] + (sent[b, a] if off else 0)
            if n and n + more > most:
                yield wanted
                wanted, n = np.zeros_like(both), 0
            wanted[a, b] = wanted[b, a] = True
            n += more
    if n:
        yield wanted


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95, **how
) -> DataFrame:
    """(id_col, n_links, component_id, kept) for every row of ``vectors``.

    Two vectors of one length link at a cosine of ``cosine`` or more. Vectors that are null, empty,
    all zero, or hold null or non-finite values link with nothing and are their own component, as are
    rows with a null id (null component, not kept). Equal rows link with each other; rows that
    repeat an id with different vectors share the sum of their links. Other columns are not read;
    an empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    rows = rows.withColumn("v", F.when(F.col("id").isNotNull() & _valid("v"), F.col("v")))
    classes = rows.where("v IS NOT NULL").groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("w"))
    classes = stage(classes, "vector_classes")
    release(classes)
    # a vector without copies is its own class
    copies = stage(classes.where("w > 1").select(F.col("v").alias("cv"), "rep", "w"), "vector_copies")
    dims = [r.dim for r in classes.groupBy(F.size("v").alias("dim")).count().orderBy("dim").collect()]
    parts = None
    for dim in dims:
        own = classes.where(F.size("v") == dim).select(F.col("rep").alias("id"), "w", "v")
        found = link_counts(own, dim, cosine, **how, spent=dim == dims[-1])
        parts = found if parts is None else parts.unionByName(found)
    if parts is None:
        return rows.select(
            F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
            F.col("id").isNotNull().alias("kept"),
        )
    counts = parts.groupBy("id").agg(F.sum("n").alias("n"))
    groups = components(parts.select(F.col("id").alias("a"), F.col("root").alias("b")))
    settled = counts.join(groups, counts.id == groups.node, "left")
    settled = stage(settled.select(F.col("id").alias("node"), "n", F.coalesce("component", "id").alias("component")), "vector_groups")
    discard(parts)
    release(settled)
    found = (
        rows.join(copies, rows.v == copies.cv, "left")
        .select("id", F.when(F.col("v").isNotNull(), F.coalesce("rep", "id")).alias("rep"), "w")
        .join(settled, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("id").alias(id_col),
            (F.coalesce("n", F.lit(0)) + F.coalesce("w", F.lit(1)) - 1).cast("long").alias("n_links"),
            F.coalesce("component", "rep", "id").alias("component_id"),
        )
    )
    return found.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))


SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.95),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
groups AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM groups LEFT JOIN counts USING (vec_id)
"""
