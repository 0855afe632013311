"""Product quantisation with k-means over metric trees (anchors hierarchy).

Vectors are floored to integers and cut into parts. Blocks of vectors get one metric
tree per part: anchors take points from each other where the triangle inequality allows,
are merged pairwise from the middle up and divided from the middle down, and every ball
keeps the count and sum of its points. A round hands each ball the codebook entries its
parent could not rule out; a ball with one entry left is added to it whole. All sums are
integers, so the result does not depend on how the rows are dealt over blocks.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import null_safe_join, staged
from .runs import first_of, ranges

#: Vectors in a block, and points a ball may hold undivided.
BLOCK_ROWS, LEAF = 4096, 12
#: (point, entry) distances computed at once.
AT_ONCE = 1 << 20


# --- trees ------------------------------------------------------------------


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(axis=-1)


def anchors(x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Divide groups of points, laid end to end, among about sqrt(size) anchors each.

    Returns for every point its anchor's place in the group, and the squared distance to
    it. A new anchor is the point farthest from its own; it looks only at points farther
    from their anchor than half the way between the two anchors.
    """
    starts, wanted = np.cumsum(sizes) - sizes, np.ceil(np.sqrt(sizes)).astype(int)
    group = np.repeat(np.arange(len(sizes)), sizes)
    most = int(wanted.max())
    pivots = np.zeros((len(sizes), most, x.shape[1]), x.dtype)
    pivots[:, 0] = x[starts]
    owner, far = np.zeros(len(x), np.int64), _squares(x, x[starts][group])
    for step in range(1, most):
        radius = np.maximum.reduceat(far, starts)
        growing = (radius > 0) & (step < wanted)
        if not growing.any():
            break
        at = np.flatnonzero(far == radius[group])
        pivot = x[at[np.searchsorted(at, starts)]]
        pivots[:, step] = pivot
        apart = _squares(pivots[:, :step], pivot[:, None])
        near = np.flatnonzero(growing[group] & (4 * far > apart[group, owner]))
        distance = _squares(x[near], pivot[group[near]])
        taken = distance < far[near]
        near = near[taken]
        owner[near], far[near] = step, distance[taken]
    return owner, far


class Trees:
    """Metric trees of one block, one per part; nodes are rows of arrays."""

    FIELDS = ("left", "right", "part", "count", "start", "total", "center", "radius", "roots")

    def __init__(self, x: np.ndarray):
        """``x``: (parts, rows, width) integers."""
        parts, rows, width = x.shape
        self.node: dict[str, list] = {f: [] for f in self.FIELDS[:-1]}
        self.size = 0
        flat = x.reshape(-1, width)
        order = np.arange(len(flat))
        sizes, part = np.full(parts, rows), np.arange(parts)
        begin = np.arange(parts) * rows
        todo = roots = self._leaves(flat, order, sizes, part, begin)
        while len(todo):
            count, radius = self._column("count")[todo], self._column("radius")[todo]
            split = (count > LEAF) & (radius > 0)
            todo, begin, count = todo[split], begin[split], count[split]
            if not len(todo):
                break
            inside = ranges(begin, count)
            group = np.repeat(np.arange(len(todo)), count)
            owner, _ = anchors(flat[order[inside]], count)
            key = group * (int(owner.max()) + 1) + owner
            ranked = np.argsort(key, kind="stable")
            order[inside] = order[inside][ranked]
            cut = first_of(key[ranked])
            children = np.diff(np.append(cut, len(key)))
            at = inside[cut]
            made = self._leaves(flat, order, children, self._column("part")[todo][group[ranked[cut]]], at)
            self._merge(todo, made, group[ranked[cut]])
            todo, begin = made, at
        self.roots = roots
        self._close(parts, rows, order)
        self.order = (order % rows).reshape(parts, rows)

    def _column(self, name: str) -> np.ndarray:
        if len(self.node[name]) > 1:
            self.node[name] = [np.concatenate(self.node[name])]
        return self.node[name][0]

    def _add(self, **columns: np.ndarray) -> np.ndarray:
        for name, values in columns.items():
            self.node[name].append(values)
        made = np.arange(self.size, self.size + len(columns["count"]))
        self.size += len(made)
        return made

    def _leaves(self, flat, order, sizes, part, at) -> np.ndarray:
        """Balls around groups of points: centre is the mean, the radius exact."""
        inside = ranges(at, sizes)
        points, cut = flat[order[inside]], np.cumsum(sizes) - sizes
        total = np.add.reduceat(points, cut, axis=0)
        center = total / sizes[:, None]
        radius = np.sqrt(np.maximum.reduceat(_squares(points, np.repeat(center, sizes, axis=0)), cut))
        same = (np.maximum.reduceat(points, cut, axis=0) == np.minimum.reduceat(points, cut, axis=0)).all(axis=1)
        none = np.full(len(sizes), -1)
        return self._add(left=none, right=none, part=part, count=sizes, start=at, total=total, center=center, radius=np.where(same, 0.0, radius))

    def _merge(self, parents: np.ndarray, made: np.ndarray, group: np.ndarray) -> None:
        """Join the balls of each group pairwise, the pair with the smallest common ball first, up to its parent."""
        count = np.bincount(group, minlength=len(parents))
        width = int(count.max())
        held = np.full((len(parents), width), -1)
        held[group, np.arange(len(made)) - (np.cumsum(count) - count)[group]] = made
        alive = held >= 0
        center, radius = self._column("center")[held], self._column("radius")[held]
        weight, total = self._column("count")[held], self._column("total")[held]
        norm = (center**2).sum(axis=2)
        apart = norm[:, :, None] + norm[:, None] - 2 * center @ center.transpose(0, 2, 1)
        cost = np.sqrt(np.maximum(apart, 0)) + radius[:, :, None] + radius[:, None]
        cost[~(alive[:, :, None] & alive[:, None])] = np.inf
        cost[:, np.arange(width), np.arange(width)] = np.inf
        for _ in range(width - 1):
            now = np.flatnonzero(alive.sum(axis=1) > 1)
            if not len(now):
                break
            i, j = np.divmod(cost[now].reshape(len(now), -1).argmin(axis=1), width)
            n = weight[now, i] + weight[now, j]
            t = total[now, i] + total[now, j]
            c = t / n[:, None]
            r = np.maximum(*[np.sqrt(_squares(c, center[now, k])) + radius[now, k] for k in (i, j)])
            last = alive[now].sum(axis=1) == 2
            left, right = held[now, i], held[now, j]
            inner = ~last
            node = self._add(left=left[inner], right=right[inner], part=self._column("part")[left[inner]], count=n[inner], start=np.zeros(inner.sum(), np.int64), total=t[inner], center=c[inner], radius=r[inner])
            ends = parents[now[last]]
            self._column("left")[ends], self._column("right")[ends] = left[last], right[last]
            fresh = held[now, i]
            fresh[inner] = node
            held[now, i], weight[now, i], total[now, i], center[now, i], radius[now, i] = fresh, n, t, c, r
            alive[now, j] = False
            cost[now, j, :], cost[now, :, j] = np.inf, np.inf
            renewed = np.sqrt(_squares(center[now], c[:, None])) + radius[now] + r[:, None]
            renewed[~alive[now]] = np.inf
            renewed[np.arange(len(now)), i] = np.inf
            cost[now, i, :], cost[now, :, i] = renewed, renewed

    def _close(self, parts: int, rows: int, order: np.ndarray) -> None:
        """Lay the points of every ball side by side and fix the columns as arrays."""
        for name in self.FIELDS[:-1]:
            setattr(self, name, self._column(name))
        source = self.start.copy()
        self.start = np.zeros(self.size, np.int64)
        self.start[self.roots] = np.arange(parts) * rows
        level = self.roots
        while len(level):
            level = level[self.left[level] >= 0]
            left, right = self.left[level], self.right[level]
            self.start[left] = self.start[level]
            self.start[right] = self.start[level] + self.count[left]
            level = np.concatenate([left, right])
        leaf = np.flatnonzero(self.left < 0)
        laid = np.empty_like(order)
        laid[ranges(self.start[leaf], self.count[leaf])] = order[ranges(source[leaf], self.count[leaf])]
        order[:] = laid

    def write(self, x: np.ndarray) -> bytes:
        out = io.BytesIO()
        np.savez(out, x=x, order=self.order, **{f: getattr(self, f) for f in self.FIELDS})
        return out.getvalue()

    @classmethod
    def read(cls, payload: bytes) -> tuple[Trees, np.ndarray]:
        stored = np.load(io.BytesIO(payload))
        trees = cls.__new__(cls)
        for name in (*cls.FIELDS, "order"):
            setattr(trees, name, stored[name])
        return trees, stored["x"]

    def assign(self, x: np.ndarray, codebooks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """Pairs (ball, entry) owned whole, and pairs (place of a point, entry), as (what, entry, is ball).

        Places number the points in the order of the trees' leaves.
        """
        parts, rows, width = x.shape
        points = np.take_along_axis(x, self.order[:, :, None], axis=1).reshape(-1, width)
        node = np.repeat(self.roots, codebooks.shape[1])
        entry = np.tile(np.arange(codebooks.shape[1]), parts)
        while len(node):
            cut = first_of(node)
            sizes = np.diff(np.append(cut, len(node)))
            distance = np.sqrt(_squares(self.center[node], codebooks[self.part[node], entry]))
            nearest = np.repeat(np.minimum.reduceat(distance, cut), sizes)
            # An entry farther than this from the centre is farther from every point of the ball than the nearest one.
            reach = nearest + 2 * self.radius[node]
            keep = distance <= reach * (1 + 1e-9) + 1e-6
            node, entry = node[keep], entry[keep]
            cut = first_of(node)
            sizes = np.diff(np.append(cut, len(node)))
            alone, leaf = sizes == 1, self.left[node[cut]] < 0
            yield node[cut][alone], entry[cut][alone], True
            yield from self._settle(points, codebooks, node[cut], cut, sizes, entry, leaf & ~alone)
            inner = np.repeat(~leaf & ~alone, sizes)
            node, entry = node[inner], entry[inner]
            # Both children inherit the list; a list stays together.
            node = np.concatenate([self.left[node], self.right[node]])
            entry = np.tile(entry, 2)

    def _settle(self, points, codebooks, node, cut, sizes, entry, chosen):
        """Leaves with several entries left: every point against the leaf's list; a leaf of equal points once."""
        node, cut, sizes = node[chosen], cut[chosen], sizes[chosen]
        same = self.radius[node] == 0
        members = np.where(same, 1, self.count[node])
        work = np.cumsum(members * sizes)
        for low, high in _slices(work, AT_ONCE):
            n, k, m = node[low:high], sizes[low:high], members[low:high]
            at = ranges(self.start[n], m)
            k_of = np.repeat(k, m)
            pair = ranges(np.repeat(cut[low:high], m), k_of)
            place = np.repeat(at, k_of)
            part = np.repeat(np.repeat(self.part[n], m), k_of)
            squared = _squares(points[place], codebooks[part, entry[pair]])
            begin = np.cumsum(k_of) - k_of
            least = np.flatnonzero(squared == np.repeat(np.minimum.reduceat(squared, begin), k_of))
            best = entry[pair[least[np.searchsorted(least, begin)]]]
            whole = np.repeat(same[low:high], m)
            if whole.any():
                yield np.repeat(n, m)[whole], best[whole], True
            yield at[~whole], best[~whole], False


def _slices(work: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    low = 0
    while low < len(work):
        done = work[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(work, done + most, side="right")))
        yield low, high
        low = high


# --- rounds -----------------------------------------------------------------


def _finite(vector: Column) -> Column:
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _integers(column: pa.Array, length: int, parts: int) -> np.ndarray:
    """(parts, rows, width); a length that parts do not divide is filled up with zeros."""
    floats = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), length)
    floored = np.floor(floats * 256)
    if floored.size and np.abs(floored).max() >= 2**26:
        raise ValueError("components of 2^18 and more are not supported")
    width = max(1, -(-length // parts))
    filled = np.zeros((len(column), parts * width), np.int64)
    filled[:, :length] = floored
    return np.ascontiguousarray(filled.reshape(len(column), parts, width).transpose(1, 0, 2))


def _blocks(kept: DataFrame, length: int, parts: int) -> DataFrame:
    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                block = batch.slice(at, BLOCK_ROWS)
                x = _integers(block.column("vector"), length, parts)
                narrow = x.astype(np.int16) if np.abs(x).max() < 2**15 else x.astype(np.int32)
                columns = [pa.array([block.column(c).to_pylist()], pa.list_(block.schema.field(c).type)) for c in ("vec_id", "label")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([Trees(x).write(narrow)], pa.binary())], ["vec_id", "label", "trees"])

    kinds = dict(kept.dtypes)
    schema = f"vec_id array<{kinds['vec_id']}>, label array<{kinds['label']}>, trees binary"
    return staged(kept.mapInArrow(built, schema), "vector-trees")


def _round(blocks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after one round; sums are added up by Spark and only they reach the driver."""
    parts, size, width = codebooks.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, size, width + 1), np.int64)
        for batch in batches:
            for payload in batch.column("trees"):
                trees, x = Trees.read(payload.as_py())
                x = x.astype(np.int64)
                points = np.take_along_axis(x, trees.order[:, :, None], axis=1).reshape(-1, width)
                for what, entry, ball in trees.assign(x, codebooks):
                    part = trees.part[what] if ball else what // x.shape[1]
                    np.add.at(total, (part, entry), np.column_stack([trees.total[what], trees.count[what]] if ball else [points[what], np.ones(len(what), np.int64)]))
        at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([*[pa.array(a.astype(np.int32)) for a in at], pa.array(total[at])], ["part", "entry", "place", "amount"])

    sums = blocks.select("trees").mapInArrow(summed, "part int, entry int, place int, amount bigint")
    found = np.zeros((parts, size, width + 1), dtype=object)
    # At most parts x entries x (width + 1) rows, whatever the table.
    for part, entry, place, amount in sums.groupBy("part", "entry", "place").agg(F.sum("amount").alias("amount")).collect():
        found[part, entry, place] = amount
    moved = codebooks.copy()
    used = found[:, :, width] > 0
    moved[used] = (found[used][:, :width] // found[used][:, width:]).astype(np.int64)
    return moved


def _coded(blocks: DataFrame, codebooks: np.ndarray, kinds: dict[str, str]) -> DataFrame:
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in range(batch.num_rows):
                trees, x = Trees.read(batch.column("trees")[number].as_py())
                x = x.astype(np.int64)
                parts, rows, _ = x.shape
                laid = np.zeros(parts * rows, np.int64)
                for what, entry, ball in trees.assign(x, codebooks):
                    if ball:
                        laid[ranges(trees.start[what], trees.count[what])] = np.repeat(entry, trees.count[what])
                    else:
                        laid[what] = entry
                codes = np.empty((parts, rows), np.int64)
                np.put_along_axis(codes, trees.order, laid.reshape(parts, rows), axis=1)
                error = _squares(x, codebooks[np.arange(parts)[:, None], codes]).sum(axis=0)
                text = [bytes(c).hex() for c in codes.T.astype(np.uint8)]
                ids, labels = (batch.column(c)[number].values for c in ("vec_id", "label"))
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text), pa.array(error)], ["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(coded, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint")


def codebook_digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.reshape(-1).tolist())).encode()).hexdigest()


def vector_codes(embeddings: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> DataFrame:
    """Per kept vector: vec_id, code, error, label_error, codebooks_sha256, label.

    Left out are null vectors and those with null, NaN or infinite components, and, as there
    is one codebook, vectors of another length than the one with the smallest vec_id has.
    A length that ``parts`` does not divide is filled up with zeros. Rows without a vec_id
    are coded like others but open no codebook unless too few rows have one; ties in vec_id
    go by the vector. Repeated rows count as often as they are there; null labels form one
    group. With fewer rows than ``entries`` the codebooks are that short (at most 256
    entries fit a code). An empty table gives an empty result; components of 2^18 and more
    raise an error. Other columns are not read.

    A block of ``BLOCK_ROWS`` vectors and its trees is one staged row; all that is shared by
    tasks or reaches the driver is the codebooks and their sums.
    """
    if not 0 < entries <= 256:
        raise ValueError("1 to 256 entries")
    vectors = embeddings.select("vec_id", "label", F.col("embedding").alias("vector")).filter(_finite(F.col("vector")))
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(1).collect()
    length = len(first[0].vector) if first else 0
    kept = vectors.filter(F.size("vector") == length)
    kinds = dict(kept.dtypes)
    seeds = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    if not seeds:
        nothing = kept.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"), F.lit(0).cast("bigint").alias("label_error"), F.lit("").alias("codebooks_sha256"), "label")
        return nothing.limit(0)
    codebooks = _integers(pa.array([s.vector for s in seeds], pa.list_(pa.float64())), length, parts)
    blocks = _blocks(kept, length, parts)
    for _ in range(rounds):
        codebooks = _round(blocks, codebooks)
    coded = _coded(blocks, codebooks, kinds)
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    digest = F.lit(codebook_digest(codebooks)).alias("codebooks_sha256")
    return null_safe_join(coded, by_label, ["label"]).select("vec_id", "code", "error", "label_error", digest, "label")
