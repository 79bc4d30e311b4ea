"""Embedding near-duplicates: exact cosine-threshold pairs by dual traversal of cover trees.

On unit vectors cosine >= t means a distance of at most sqrt(2 - 2t).  Vectors
are dealt to cells around sampled centres, and each cell is cut into blocks of a
bounded number of rows.  A block's task builds its cover tree: nested levels of
centres with halving radii, each node with its own covering radius.  Cell pairs
too far apart for their covering radii are pruned, and the rest of the block
pairs are traversed together: a node pair is dropped when its centres are
farther apart than both covering radii plus the threshold, counted as a whole
when even its farthest points link, and split otherwise.

Equal vectors are one point with a weight.  Tasks return link counts and a
spanning forest of the links, never the pairs.

Blocks are dealt to groups and exchanged once; the task of two groups reads both,
so that the bytes on disk grow with the rows though the block pairs grow with their square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.session import reliable_checkpoint, run_scratch, shuffles_removed

from .graph import components

THRESHOLD = 0.9
BLOCK_ROWS = 4096
MOST_CELLS = 1024
GROUP_BLOCKS = 8                     # blocks that a task reads of either side, more beyond MOST_GROUPS
MOST_GROUPS = 256
RADII = (0.25, 0.5, 1.0)             # of the nested levels, finest first; the root covers all
SLACK = 1e-7                         # kept on distances so that rounding never prunes a link
GATHER = 1 << 16                     # node pairs compared at once outside dense blocks


# ---- one block's tree -----------------------------------------------------------

def _nets(points: np.ndarray) -> list[np.ndarray]:
    """For each radius the members' owners: ``owner[i]`` is the number of the
    centre (a member of the level below) that covers member i."""
    owners, members = [], points
    for radius in RADII:
        owner = np.full(len(members), -1)
        centres = []
        floor = 1 - radius * radius / 2
        open_rows = np.arange(len(members))
        while len(open_rows):
            near = members[open_rows] @ members[open_rows[0]] >= floor
            near[0] = True
            owner[open_rows[near]] = len(centres)
            centres.append(open_rows[0])
            open_rows = open_rows[~near]
        owners.append((owner, np.array(centres, int)))
        members = members[centres]
    return owners


class Tree:
    """Nodes in arrays: centre point, covering radius, range of points, range of
    children.  Points stand in the order of the leaves; the first nodes are the points."""

    def __init__(self, points: np.ndarray):
        n = len(points)
        labels, top = [], np.arange(n)                 # per level: each point's node, and its centre point
        label = np.arange(n)
        for owner, centres in _nets(points):
            label = owner[label]
            top = top[centres]
            # a level that hardly merges nodes of the one below only adds work
            if 2 * len(centres) <= (labels[-1][1].size if labels else n) or (not labels and len(centres) < n):
                labels.append((label, top))
        order = np.lexsort([lab for lab, _ in labels]) if labels else np.arange(n)
        self.order = order
        place = np.empty(n, int)
        place[order] = np.arange(n)
        ordered = points[order]
        centre, radius = [np.arange(n)], [np.zeros(n)]
        begin, end, child, child_end = [np.arange(n)], [np.arange(1, n + 1)], [np.zeros(n, int)], [np.zeros(n, int)]
        below = np.arange(n)                           # start points of the level below
        first_below, total = 0, n
        for lab, tops in [*labels, (np.zeros(n, int), np.zeros(1, int))]:
            mine = lab[order]
            starts = np.flatnonzero(np.concatenate(([True], mine[1:] != mine[:-1])))
            ends = np.append(starts[1:], n)
            c = place[tops[mine[starts]]]
            cosine = np.einsum("ij,ij->i", ordered, ordered[np.repeat(c, ends - starts)])
            r = np.maximum.reduceat(np.sqrt(np.maximum(0, 2 - 2 * cosine)), starts)
            r[ends - starts == 1] = 0.0
            centre.append(c)
            radius.append(r)
            begin.append(starts)
            end.append(ends)
            child.append(first_below + np.searchsorted(below, starts))
            child_end.append(first_below + np.searchsorted(below, ends))
            first_below, below = total, starts
            total += len(starts)
        self.centre, self.radius = np.concatenate(centre), np.concatenate(radius)
        self.begin, self.end = np.concatenate(begin), np.concatenate(end)
        self.child, self.child_end = np.concatenate(child), np.concatenate(child_end)
        self.root = total - 1


_NODE_ARRAYS = ("centre", "radius", "begin", "end", "child", "child_end")


class Block:
    """A tree with its points: raw vectors, norms, class ids and weights, in leaf order."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, raw: np.ndarray):
        self.kind = raw.dtype                          # packed as they came: floats widen exactly
        raw = raw.astype(float)
        norm = np.sqrt(np.einsum("ij,ij->i", raw, raw))
        tree = Tree(raw / norm[:, None])
        self.ids, self.weights, self.raw = ids[tree.order], weights[tree.order], raw[tree.order]
        self.root = tree.root
        for name in _NODE_ARRAYS:
            setattr(self, name, getattr(tree, name))
        self._prepare()

    def _prepare(self) -> None:
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.raw, self.raw))
        self.unit = self.raw / self.norm[:, None]
        self.below = np.concatenate(([0], np.cumsum(self.weights)))

    def weight_of(self, nodes: np.ndarray) -> np.ndarray:
        return self.below[self.end[nodes]] - self.below[self.begin[nodes]]

    def pack(self) -> bytes:
        sink = pa.BufferOutputStream()
        arrays = [self.ids, self.weights, self.raw.reshape(-1).astype(self.kind), *(getattr(self, n) for n in _NODE_ARRAYS)]
        with pa.ipc.new_stream(sink, pa.schema([(f"a{i}", pa.list_(pa.from_numpy_dtype(a.dtype))) for i, a in enumerate(arrays)])) as out:
            out.write_batch(pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), pa.array(a)) for a in arrays],
                names=[f"a{i}" for i in range(len(arrays))]))
        return sink.getvalue().to_pybytes()

    @classmethod
    def unpack(cls, data: bytes) -> "Block":
        row = pa.ipc.open_stream(data).read_all().to_batches()[0]
        arrays = [c.values.to_numpy() for c in row.columns]
        block = cls.__new__(cls)
        block.ids, block.weights = arrays[0], arrays[1]
        block.kind, block.raw = arrays[2].dtype, arrays[2].reshape(len(block.ids), -1).astype(float)
        for name, a in zip(_NODE_ARRAYS, arrays[3:], strict=True):
            setattr(block, name, a)
        block.root = len(block.centre) - 1
        block._prepare()
        return block


# ---- dual traversal -------------------------------------------------------------

def _ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of every value in the ranges begin[row] .. end[row] - 1."""
    n = end - begin
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + begin[row]


class Traversal:
    """Links between block a and block b (or within a), as counts and a forest."""

    def __init__(self, a: Block, b: Block, threshold: float):
        self.a, self.b, self.same = a, b, a is b
        self.threshold = threshold
        self.reach = np.sqrt(max(0.0, 2 - 2 * threshold))
        self.count = [np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)]
        self.offset = 0 if self.same else len(a.ids)
        self.label = np.arange(len(a.ids) + (0 if self.same else len(b.ids)))

    def run(self) -> "Traversal":
        a, b = self.a, self.b
        if self.same:
            self._within(np.array([a.root]))
        else:
            self._dense(np.arange(a.child[a.root], a.child_end[a.root]), np.arange(b.child[b.root], b.child_end[b.root]))
        return self

    def _within(self, nodes: np.ndarray) -> None:
        """Links inside nodes of the one block."""
        a = self.a
        while len(nodes):
            nodes = nodes[a.child_end[nodes] > a.child[nodes]]
            whole = 2 * a.radius[nodes] <= self.reach - SLACK
            for i in nodes[whole].tolist():
                s, e = a.begin[i], a.end[i]
                self.count[0][s:e] += a.below[e] - a.below[s] - a.weights[s:e]
                self._unite(np.arange(s, e - 1), np.arange(s + 1, e))
            nodes = nodes[~whole]
            for i in nodes.tolist():
                children = np.arange(a.child[i], a.child_end[i])
                self._dense(children, children, upper=True)
            _, nodes = _ranges(a.child[nodes], a.child_end[nodes])

    def _dense(self, xs: np.ndarray, ys: np.ndarray, upper: bool = False) -> None:
        """Node pairs of xs and ys, a block of rows at a time."""
        a, b = self.a, self.b
        if not len(xs) or not len(ys):
            return
        theirs = b.unit[b.centre[ys]]
        widest = b.radius[ys].max()
        for s in range(0, len(xs), 512):
            rows = xs[s:s + 512]
            first = s if upper else 0
            cosine = a.unit[a.centre[rows]] @ theirs[first:].T
            bound = np.minimum(2.0, a.radius[rows] + widest + self.reach + SLACK)
            i, j = np.nonzero(cosine >= (1 - bound * bound / 2)[:, None])
            if upper:
                keep = j > i
                i, j = i[keep], j[keep]
            for at in range(0, len(i), GATHER):
                self._pairs(rows[i[at:at + GATHER]], ys[first + j[at:at + GATHER]], cosine[i[at:at + GATHER], j[at:at + GATHER]])

    def _pairs(self, x: np.ndarray, y: np.ndarray, cosine: np.ndarray) -> None:
        a, b = self.a, self.b
        stack = [(x, y, cosine)]
        while stack:
            x, y, cosine = stack.pop()
            distance = np.sqrt(np.maximum(0, 2 - 2 * cosine))
            spread = a.radius[x] + b.radius[y]
            near = distance <= spread + self.reach + SLACK
            x, y, distance, spread = x[near], y[near], distance[near], spread[near]
            points = (a.end[x] - a.begin[x] == 1) & (b.end[y] - b.begin[y] == 1)
            self._points(a.begin[x[points]], b.begin[y[points]])
            whole = ~points & (distance + spread <= self.reach - SLACK)
            self._whole(x[whole], y[whole])
            rest = ~points & ~whole
            x, y = x[rest], y[rest]
            left = a.radius[x] >= b.radius[y]
            left &= a.end[x] - a.begin[x] > 1
            left |= b.end[y] - b.begin[y] == 1
            # split the node that covers more
            for side in (True, False):
                u, v = x[left == side], y[left == side]
                for at in range(0, len(u), 256):
                    p, q = u[at:at + 256], v[at:at + 256]
                    row, child = _ranges(a.child[p], a.child_end[p]) if side else _ranges(b.child[q], b.child_end[q])
                    nx, ny = (child, q[row]) if side else (p[row], child)
                    for g in range(0, len(nx), GATHER):
                        gx, gy = nx[g:g + GATHER], ny[g:g + GATHER]
                        stack.append((gx, gy, np.einsum("ij,ij->i", a.unit[a.centre[gx]], b.unit[b.centre[gy]])))

    def _points(self, p: np.ndarray, q: np.ndarray) -> None:
        """Point pairs, decided by their own cosine."""
        a, b = self.a, self.b
        for at in range(0, len(p), GATHER):
            u, v = p[at:at + GATHER], q[at:at + GATHER]
            linked = np.einsum("ij,ij->i", a.raw[u], b.raw[v]) / (a.norm[u] * b.norm[v]) >= self.threshold
            u, v = u[linked], v[linked]
            self.count[0] += np.bincount(u, weights=b.weights[v], minlength=len(a.ids)).astype(np.int64)
            target = 0 if self.same else 1
            self.count[target] += np.bincount(v, weights=a.weights[u], minlength=len(b.ids)).astype(np.int64)
            self._unite(u, v + self.offset)

    def _whole(self, x: np.ndarray, y: np.ndarray) -> None:
        """Node pairs all of whose point pairs link."""
        a, b = self.a, self.b
        for ours, theirs, mine, other, target, offset, far in ((a, b, x, y, 0, 0, self.offset), (b, a, y, x, 0 if self.same else 1, self.offset, 0)):
            steps = np.zeros(len(ours.ids) + 1, np.int64)
            weight = theirs.weight_of(other)
            np.add.at(steps, ours.begin[mine], weight)
            np.add.at(steps, ours.end[mine], -weight)
            self.count[target] += np.cumsum(steps)[:-1]
            row, point = _ranges(ours.begin[mine], ours.end[mine])
            self._unite(point + offset, theirs.begin[other][row] + far)

    def _unite(self, u: np.ndarray, v: np.ndarray) -> None:
        """Joins the components of each pair: least labels first, then shortcuts."""
        while len(u):
            lu, lv = self.label[u], self.label[v]
            apart = lu != lv
            u, v, lu, lv = u[apart], v[apart], lu[apart], lv[apart]
            np.minimum.at(self.label, np.maximum(lu, lv), np.minimum(lu, lv))
            while True:
                short = self.label[self.label]
                if (short == self.label).all():
                    break
                self.label = short

    def result(self) -> pa.Table:
        """(id, links, other): link counts, and edges to a member of the component."""
        ids = self.a.ids if self.same else np.concatenate((self.a.ids, self.b.ids))
        count = self.count[0] if self.same else np.concatenate(self.count)
        some = np.flatnonzero((count > 0) | (self.label != np.arange(len(ids))))
        return pa.table({"id": ids[some], "links": count[some], "other": ids[self.label[some]]})


# ---- the job --------------------------------------------------------------------

def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _cells(points: DataFrame, centres: np.ndarray) -> DataFrame:
    """Adds each point's nearest centre and its distance."""
    shared = points.sparkSession.sparkContext.broadcast(centres)

    @F.arrow_udf("struct<cell:int,distance:double>")
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            cell, far = np.zeros(len(column), np.int32), np.zeros(len(column))
            for at in range(0, len(column), 1024):
                x = _matrix(column.slice(at, 1024)).astype(float)
                x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
                cosine = x @ shared.value.T
                cell[at:at + len(x)] = cosine.argmax(axis=1)
                far[at:at + len(x)] = np.sqrt(np.maximum(0, 2 - 2 * cosine.max(axis=1)))
            yield pa.StructArray.from_arrays([pa.array(cell), pa.array(far)], names=["cell", "distance"])
    return points.withColumn("near", nearest(F.col("embedding"))).select("id", "embedding", "weight", "near.cell", "near.distance")


def _block_pairs(cells: DataFrame, centres: np.ndarray, reach: float) -> DataFrame:
    """(low, high): cell pairs that covering radii do not keep apart."""
    shared = cells.sparkSession.sparkContext.broadcast(
        (centres, dict(cells.groupBy("cell").agg(F.max("distance")).collect())))     # a row for each of MOST_CELLS cells at most

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, radii = shared.value
        radius = np.array([radii.get(i, -np.inf) for i in range(len(centres))])
        for batch in batches:
            for i in batch.column(0).to_pylist():
                distance = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres[i]))
                others = np.flatnonzero(distance <= radius + radius[i] + reach + SLACK)
                others = others[others >= i]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(others), i, np.int32)), pa.array(others.astype(np.int32))], names=["low", "high"])
    return cells.select("cell").distinct().mapInArrow(near, "low int, high int")


def _links(points: DataFrame, threshold: float, block_rows: int) -> DataFrame:
    """(id, links, other) of the points (id, embedding, weight) of one dimension.  Its cells and
    blocks are removed when the links are written."""
    with run_scratch(points.sparkSession):
        return reliable_checkpoint(_block_links(points, threshold, block_rows), outlive=True)


def _block_links(points: DataFrame, threshold: float, block_rows: int) -> DataFrame:
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    n = points.count()
    wanted = min(MOST_CELLS, -(-n // block_rows))
    sample = points.select("embedding").orderBy(F.xxhash64("embedding"), "embedding").limit(wanted).toArrow()
    centres = _matrix(sample.column(0).combine_chunks()).astype(float)
    centres /= np.sqrt(np.einsum("ij,ij->i", centres, centres))[:, None]
    cells = reliable_checkpoint(_cells(points, centres))
    cuts = cells.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("k"))   # MOST_CELLS rows at most
    dealt = cells.join(F.broadcast(cuts), "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("k")).cast("int"))

    def build(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("id").to_numpy())
        block = Block(table.column("id").to_numpy()[order], table.column("weight").to_numpy()[order],
                      _matrix(table.column("embedding").combine_chunks())[order])
        return pa.table({"cell": table.column("cell")[:1], "part": table.column("part")[:1], "data": pa.array([block.pack()], pa.binary())})

    blocks = reliable_checkpoint(dealt.groupBy("cell", "part").applyInArrow(build, "cell int, part int, data binary"))
    partners = _block_pairs(cells, centres, reach).groupBy("low").agg(F.collect_set("high").alias("partners"))   # MOST_CELLS rows at most
    dealt_blocks = blocks.repartition(min(MOST_GROUPS, -(-blocks.count() // GROUP_BLOCKS)))
    low = dealt_blocks.join(F.broadcast(partners), F.col("cell") == F.col("low")).select("partners", "low", F.col("part").alias("low_part"), F.col("data").alias("a"))
    high = dealt_blocks.select(F.col("cell").alias("high"), F.col("part").alias("high_part"), F.col("data").alias("b"))
    # every task reads one group of either side from the one exchange
    pairs = low.join(high.hint("shuffle_replicate_nl"), F.expr("array_contains(partners, high) AND (low < high OR low_part <= high_part)"))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, a = None, None
        for batch in batches:
            for at, (c, p, d, q) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)):
                if key != (c, p):                      # successive rows share it
                    key, a = (c, p), Block.unpack(batch.column(4)[at].as_buffer())
                b = a if key == (d, q) else Block.unpack(batch.column(5)[at].as_buffer())
                yield from Traversal(a, b, threshold).run().result().to_batches()

    return pairs.select("low", "low_part", "high", "high_part", "a", "b").mapInArrow(solve, "id bigint, links bigint, other bigint")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding).

    Vectors link at a cosine (in double precision) of at least ``threshold`` >= 0;
    only vectors of one length do.  Vectors that are null, empty or zero or
    hold a null or non-finite component link with nothing and are components of
    their own.  Equal vectors, repeated rows included, link with each other.
    component_id is the least vec_id reachable (null if none has an id), kept
    whether it is the row's own.  Other columns are ignored.
    """
    rows = vectors.select("vec_id", "embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.coalesce(F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x * x.cast("double") > 0), F.lit(False))
    rows = rows.withColumn("valid", valid)
    alone = rows.where(~F.col("valid")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    with shuffles_removed(vectors.sparkSession):
        points = reliable_checkpoint(
            rows.where("valid").groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"))
            .withColumn("id", F.monotonically_increasing_id()))
        dims = [r[0] for r in points.select(F.size("embedding")).distinct().collect()]
        found = [_links(points.where(F.size("embedding") == d).select("id", "embedding", "weight"), threshold, block_rows) for d in dims]
        if not found:
            return _kept(alone)
        links = found[0]
        for f in found[1:]:
            links = links.unionByName(f)
        counts = links.groupBy("id").agg(F.sum("links").alias("links"))
        named = components(links.select(F.col("id").alias("a"), F.col("other").alias("b")))
        of = (points.select("id", "least", "weight").join(counts, "id", "left").join(named, F.col("id") == F.col("node"), "left")
              .select("id", "least", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                      F.coalesce("component", "id").alias("component")))
        least = of.groupBy("component").agg(F.min("least").alias("component_id"))
        of = reliable_checkpoint(of.join(least, "component").select("id", "n_links", "component_id"))
    linked = rows.where("valid").join(points.select("embedding", "id"), "embedding").join(of, "id").select("vec_id", "n_links", "component_id")
    return _kept(linked.unionByName(alone))


def _kept(found: DataFrame) -> DataFrame:
    return found.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
