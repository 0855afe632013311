"""Random forests for two classes on many rows: a task grows whole trees from binned rows.

Spark's forest sends a histogram of every open node of every tree from each partition in
each pass, which grows with nodes times partitions. Here a row becomes about 25 bytes (the
bin of each number, the set 0/1 columns, label, draws) and is dealt once to each of a
bounded number of tasks; which rows a tree draws is computed where they are. A task keeps a
tree's rows sorted by node, so a level is one pass over them, and beyond ``HELD`` rows they
lie in files of the task that are split until a part fits. Draws are
seeded by tree and block and histograms are whole numbers, so the trees do not depend on
the number of tasks nor on the order in which blocks arrive.

A tree has at most 2^(depth + 1) nodes of seven bytes however many rows there are; the model
is these arrays, and rows are scored where they are.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed

BINS = 32
#: Rows of a tree that a task holds in memory; more lie in files.
HELD = 1_000_000
#: Tasks that grow trees, each of which is sent all binned rows.
UNITS = 64
#: Values of a column that a partition reports; of more, these quantiles.
REPORTED = 2_048
#: Rows whose indices are made at a time, to stay in the processor's cache.
STEP = 1 << 15
LEAF = 0xFFFF


@dataclass(frozen=True)
class Layout:
    """Where the vector's columns are: ``place`` numbers the numeric ones first, then those of 0 and 1."""

    place: np.ndarray
    numeric: int
    hot: int
    edges: tuple[np.ndarray, ...] = ()
    set_at_once: int = 1

    @property
    def width(self) -> int:
        return self.numeric + self.hot

    @property
    def record(self) -> np.dtype:
        kind = "u1" if self.hot < 0xFF else "u2"
        return np.dtype([("x", "u1", (max(self.numeric, 1),)), ("h", kind, (self.set_at_once,)), ("y", "u1"), ("w", "u1")])


def layout_of(frame: DataFrame, column: str) -> Layout:
    attributes = frame.schema[column].metadata.get("ml_attr", {})
    size = attributes.get("num_attrs") or len(frame.select(column).first()[0])
    hot = np.zeros(size, bool)
    hot[[a["idx"] for a in attributes.get("attrs", {}).get("binary", [])]] = True
    place = np.empty(size, np.int64)
    place[~hot], place[hot] = np.arange(size - hot.sum()), size - hot.sum() + np.arange(hot.sum())
    return Layout(place, int(size - hot.sum()), int(hot.sum()))


def parsed(vectors: pa.StructArray, layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers (rows, numeric), and row and number of each column that is set."""
    n = len(vectors)
    dense = vectors.field("type").to_numpy(zero_copy_only=False) == 1
    lengths = pc.list_value_length(vectors.field("values")).to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.field("values").flatten().to_numpy()
    row = np.repeat(np.arange(n), lengths)
    index = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    sparse = ~dense[row]
    index[sparse] = vectors.field("indices").flatten().to_numpy()
    column = layout.place[index]
    number = column < layout.numeric
    x = np.zeros((n, layout.numeric))
    x[row[number], column[number]] = values[number]
    is_set = ~number & (values != 0)
    return x, row[is_set], column[is_set] - layout.numeric


# --- bins ------------------------------------------------------------------------


def _reported(layout: Layout):
    """Of each number the weighted values of a partition, at most ``REPORTED`` of them; at -1 the most set columns of a row."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, weights, most = [], [], 0
        for batch in batches:
            x, row, _ = parsed(batch.column("v"), layout)
            parts.append(x)
            weights.append(batch.column("w").to_numpy())
            most = max(most, int(np.bincount(row, minlength=1).max()))
        if not parts:
            return
        x, weight = np.concatenate(parts), np.concatenate(weights)
        found = [(np.array([-1]), np.array([float(most)]), np.array([0.0]))]
        for f in range(layout.numeric):
            values, at = np.unique(x[:, f], return_inverse=True)
            counts = np.bincount(at, weights=weight)
            if len(values) > REPORTED:
                upto = np.cumsum(counts)
                group = np.minimum(upto * REPORTED / upto[-1], REPORTED - 1).astype(np.int64)
                last = np.flatnonzero(np.diff(group, append=REPORTED))
                values, counts = values[last], np.diff(upto[last], prepend=0.0)
            found.append((np.full(len(values), f), values, counts))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=["f", "value", "weight"])

    return report


def _cut(table: pa.Table) -> pa.Table:
    f = table.column("f")[0].as_py()
    values, at = np.unique(table.column("value").to_numpy(), return_inverse=True)
    edges = values[-1:] if f < 0 else bin_edges(values, np.bincount(at, weights=table.column("weight").to_numpy()))
    return pa.table({"f": pa.array([f], pa.int64()), "edges": pa.array([edges.tolist()], pa.list_(pa.float64()))})


def bin_edges(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Thresholds half way between neighbouring values: all, or with more than ``BINS`` values those that part the weight evenly."""
    middles = (values[1:] + values[:-1]) / 2
    if len(values) <= BINS:
        return middles
    upto = np.cumsum(weights)
    wanted = upto[-1] * np.arange(1, BINS) / BINS
    after = np.clip(np.searchsorted(upto, wanted), 1, len(values) - 2)
    nearest = np.where(wanted - upto[after - 1] < upto[after] - wanted, after - 1, after)
    return middles[np.unique(nearest)]


def binned(x: np.ndarray, layout: Layout) -> np.ndarray:
    codes = np.zeros((len(x), max(layout.numeric, 1)), np.uint8)
    for f, edges in enumerate(layout.edges):
        codes[:, f] = np.searchsorted(edges, x[:, f], side="left")
    return codes


def _blocks(layout: Layout):
    """Records of the rows, a batch each, numbered by partition and place."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for i, batch in enumerate(b for b in batches if b.num_rows):
            x, row, hot = parsed(batch.column("v"), layout)
            label = batch.column("y").to_numpy(zero_copy_only=False)
            if not np.isin(label, (0, 1)).all():
                raise ValueError("labels must be 0 or 1")
            records = np.zeros(batch.num_rows, layout.record)
            records["x"], records["y"], records["h"] = binned(x, layout), label, layout.hot
            places = np.arange(len(row)) - np.searchsorted(row, row)
            records["h"][row, places] = hot
            yield pa.RecordBatch.from_arrays([pa.array([first + i], pa.int64()), pa.array([records.tobytes()], pa.binary())], names=["block", "records"])

    return made


# --- growing -------------------------------------------------------------------


class Nodes:
    """A tree in the making: a leaf has the feature ``LEAF``; else ``link`` is the left child, the right one follows it,
    and a row goes left if its bin is at most ``bin``. ``value`` is the share of class 1."""

    def __init__(self) -> None:
        self.feature, self.bin = np.empty(0, np.uint16), np.empty(0, np.uint8)
        self.link, self.value = np.empty(0, np.int32), np.empty(0, np.float32)
        self.size = 0

    def add(self, values: np.ndarray) -> np.ndarray:
        """Leaves of these values; their numbers."""
        first, self.size = self.size, self.size + len(values)
        if self.size > len(self.feature):
            more = max(1024, 2 * self.size) - first
            for name in ("feature", "bin", "link", "value"):
                kept = getattr(self, name)[:first]
                setattr(self, name, np.concatenate([kept, np.zeros(more, kept.dtype)]))
        self.feature[first : self.size], self.bin[first : self.size] = LEAF, 0xFF
        self.value[first : self.size] = values
        return np.arange(first, self.size)

    def split(self, nodes: np.ndarray, feature: np.ndarray, at: np.ndarray, left: np.ndarray) -> None:
        self.feature[nodes], self.bin[nodes], self.link[nodes] = feature, at, left

    def packed(self) -> tuple[bytes, bytes, bytes]:
        """Feature, bin and link of the tree; a leaf's link has the bits of its value. As in Spark's trees, sibling
        leaves of one predicted class are one leaf."""
        feature, link, value = (a[: self.size] for a in (self.feature, self.link, self.value))
        leaf = feature == LEAF
        while True:
            inner = np.flatnonzero(~leaf)
            left = link[inner]
            alike = leaf[left] & leaf[left + 1] & ((value[left] > 0.5) == (value[left + 1] > 0.5))
            if not alike.any():
                break
            leaf[inner[alike]] = True
        kept = np.zeros(self.size, bool)
        kept[0] = True
        kept[link[~leaf]] = kept[link[~leaf] + 1] = True
        number = np.cumsum(kept, dtype=np.int32) - 1
        links = np.where(leaf, value.view(np.int32), number[np.where(leaf, 0, link)])[kept]
        features, bins = np.where(leaf, LEAF, feature)[kept], np.where(leaf, 0xFF, self.bin[: self.size])[kept]
        return features.astype(np.uint16).tobytes(), bins.astype(np.uint8).tobytes(), links.astype(np.int32).tobytes()


@dataclass(frozen=True)
class Forest:
    """What trees are grown by."""

    layout: Layout
    weights: tuple[float, float]
    depth: int
    least: int
    seed: int

    @property
    def tried(self) -> int:
        return int(np.ceil(np.sqrt(self.layout.width)))

    def share(self, counts: np.ndarray) -> np.ndarray:
        """Weighted share of class 1, of counts (nodes, 2)."""
        weighted = counts * self.weights
        return weighted[:, 1] / np.maximum(weighted.sum(axis=1), 1e-300)

    def is_open(self, counts: np.ndarray, depth: int) -> np.ndarray:
        return (counts.sum(axis=1) >= 2 * self.least) & (counts > 0).all(axis=1) & (depth < self.depth)


def subsets(generator: np.random.Generator, n: int, of: int, size: int) -> np.ndarray:
    """``n`` sorted random subsets of range(``of``)."""
    kind = np.int16 if of < 1 << 15 else np.int32
    out = np.sort(generator.integers(0, of, (n, size), dtype=kind), axis=1)
    again = np.flatnonzero((out[:, 1:] == out[:, :-1]).any(axis=1))
    while len(again):
        drawn = np.sort(generator.integers(0, of, (len(again), size), dtype=kind), axis=1)
        out[again] = drawn
        again = again[(drawn[:, 1:] == drawn[:, :-1]).any(axis=1)]
    return out.astype(np.int64)


class Histograms:
    """Draws by class in the bins of the features that each open node tries.

    ``one`` counts rows in which a 0/1 column is set, by the column's place among the node's features (0: not among
    them); ``many`` has the bins of each (node, numeric feature).
    """

    def __init__(self, chosen: np.ndarray, layout: Layout):
        k, tried = chosen.shape
        self.layout, self.chosen = layout, chosen
        self.slot = np.zeros((k, layout.hot + 1), np.uint8 if tried < 0xFF else np.uint16)
        node, place = np.nonzero(chosen >= layout.numeric)
        self.slot[node, chosen[node, place] - layout.numeric] = place + 1
        self.pair_node, self.pair_place = np.nonzero(chosen < layout.numeric)
        self.pair_feature = chosen[self.pair_node, self.pair_place]
        self.one = np.zeros((k, tried + 1, 2))
        self.many = np.zeros((len(self.pair_node), BINS, 2))

    def count(self, records: np.ndarray, begins: np.ndarray) -> None:
        """Adds rows sorted by node; node i has the rows from ``begins[i]`` to ``begins[i + 1]``."""
        layout, wide, full = self.layout, self.slot.shape[1], self.one.shape[1]
        for s in range(0, len(records), STEP):
            part = records[s : s + STEP]
            e = s + len(part)
            a, b = np.searchsorted(begins, s, side="right") - 1, np.searchsorted(begins, e, side="left")
            own = np.clip(begins[a : b + 1], s, e)
            lengths = np.diff(own)
            offset = np.repeat(np.arange(b - a) * wide, lengths)
            label, draws = part["y"].astype(np.int64), part["w"].astype(float)
            if layout.hot:
                table, rows, cells = self.slot[a:b].ravel(), [], []
                for set_column in part["h"].T:
                    slot = table[offset + set_column]
                    rows.append(np.flatnonzero(slot))  # few of the set columns are tried
                    cells.append(slot[rows[-1]])
                row, slot = np.concatenate(rows), np.concatenate(cells).astype(np.int64)
                cell = (offset[row] // wide * full + slot) * 2 + label[row]
                self.one[a:b] += np.bincount(cell, draws[row], (b - a) * full * 2).reshape(-1, full, 2)
            p, q = np.searchsorted(self.pair_node, (a, b))
            if q > p:
                at = self.pair_node[p:q] - a
                lengths = lengths[at]
                ends = np.cumsum(lengths)
                row = np.repeat(own[at] - s - ends + lengths, lengths) + np.arange(ends[-1])
                code = part.view(np.uint8)[row * part.itemsize + np.repeat(self.pair_feature[p:q], lengths)]
                cell = (np.repeat(np.arange(q - p) * BINS, lengths) + code) * 2 + label[row]
                self.many[p:q] += np.bincount(cell, draws[row], (q - p) * BINS * 2).reshape(-1, BINS, 2)

    def best(self, counts: np.ndarray, forest: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature (-1: no split), bin and draws on the left of each node's split of largest gain."""
        weights, least = np.array(forest.weights), forest.least

        def purity(c: np.ndarray) -> np.ndarray:
            w0, w1 = c[..., 0] * weights[0], c[..., 1] * weights[1]
            return (w0 * w0 + w1 * w1) / np.maximum(w0 + w1, 1e-300)

        def gains(left: np.ndarray, right: np.ndarray) -> np.ndarray:
            enough = (left.sum(axis=-1) >= least) & (right.sum(axis=-1) >= least)
            return np.where(enough, purity(left) + purity(right), -1.0)

        k, tried = self.chosen.shape
        right = self.one[:, 1:]
        left = counts[:, None] - right
        gain = gains(left, right)
        at = np.zeros((k, tried), np.int64)
        if len(self.pair_node):
            upto = self.many.cumsum(axis=1)[:, :-1]
            gained = gains(upto, counts[self.pair_node][:, None] - upto)
            top = gained.argmax(axis=1)
            pair = np.arange(len(top))
            gain[self.pair_node, self.pair_place] = gained[pair, top]
            at[self.pair_node, self.pair_place] = top
            left[self.pair_node, self.pair_place] = upto[pair, top]
        node, place = np.arange(k), gain.argmax(axis=1)
        enough = gain[node, place] > purity(counts) + 1e-9 * (counts * weights).sum(axis=1)
        return np.where(enough, self.chosen[node, place], -1), at[node, place], left[node, place]


def goes_left(records: np.ndarray, feature: np.ndarray, at: np.ndarray, layout: Layout) -> np.ndarray:
    """Of rows with the feature and bin of their node's split."""
    bins = records.view(np.uint8)  # a record begins with its bins
    low = bins[np.arange(len(records)) * records.itemsize + np.minimum(feature, max(layout.numeric, 1) - 1)] <= at
    if not layout.hot:
        return low
    wanted = (feature - layout.numeric).astype(np.int32)
    is_set = np.zeros(len(records), bool)
    for set_column in records["h"].T:
        is_set |= set_column == wanted
    return np.where(feature < layout.numeric, low, ~is_set)


def grow_levels(nodes: Nodes, records: np.ndarray, root: int, counts: np.ndarray, depth: int, forest: Forest, generator: np.random.Generator) -> None:
    """All below one node, a level at a time; ``records`` are its rows."""
    layout = forest.layout
    ids, sizes, counts = np.array([root]), np.array([len(records)]), counts[None, :]
    if not forest.is_open(counts, depth)[0]:
        return
    while len(ids):
        begins = np.concatenate([[0], np.cumsum(sizes)])
        sums = Histograms(subsets(generator, len(ids), layout.width, forest.tried), layout)
        sums.count(records, begins)
        feature, at, left = sums.best(counts, forest)
        found = feature >= 0
        if not found.any():
            return
        depth += 1
        both = np.stack([left, counts - left], axis=1)[found].reshape(-1, 2)
        made = nodes.add(forest.share(both))
        nodes.split(ids[found], feature[found], at[found], made[::2])
        stays = forest.is_open(both, depth)
        if not stays.any():
            return
        side = np.empty(len(records), bool)
        for s in range(0, len(records), STEP):
            e = min(s + STEP, len(records))
            a, b = np.searchsorted(begins, s, side="right") - 1, np.searchsorted(begins, e, side="left")
            lengths = np.diff(np.clip(begins[a : b + 1], s, e))
            side[s:e] = goes_left(records[s:e], np.repeat(feature[a:b], lengths), np.repeat(at[a:b], lengths), layout)
        # All left children come first, then all right ones; rows of leaves are left out.
        before = np.concatenate([[0], np.cumsum(side)])
        lefts = (before[begins[1:]] - before[begins[:-1]])[found]
        following = np.concatenate([lefts, sizes[found] - lefts])
        stays, made, both = (np.concatenate([v[::2], v[1::2]]) for v in (stays, made, both))
        goes_on = np.zeros((2, len(ids)), bool)
        goes_on[:, found] = stays.reshape(2, -1)
        plain = records.view(np.dtype((np.void, records.itemsize)))
        moved = [plain[side & np.repeat(goes_on[0], sizes)], plain[~side & np.repeat(goes_on[1], sizes)]]
        records = np.concatenate(moved).view(records.dtype)
        ids, sizes, counts = made[stays], following[stays], both[stays]


def counted(records: np.ndarray) -> np.ndarray:
    return np.bincount(records["y"], records["w"].astype(float), 2)


def grow_tree(parts: Iterable[np.ndarray], forest: Forest, number: int, folder: str) -> Nodes:
    """A tree from its drawn rows. Up to ``HELD`` rows are held; of more, files are split in two, node by node."""
    nodes, generator = Nodes(), np.random.default_rng([forest.seed, number])
    held, rows, counts = [], 0, np.zeros(2)
    path = Path(folder, f"{number}.0")
    with path.open("wb") as file:
        for part in parts:
            counts += counted(part)
            held.append(part)
            rows += len(part)
            if rows > HELD:
                file.writelines(p.tobytes() for p in held)
                held.clear()
        if rows > HELD:
            file.writelines(p.tobytes() for p in held)
            held.clear()
    root = int(nodes.add(forest.share(counts[None, :]))[0])
    if rows <= HELD:
        path.unlink()
        grow_levels(nodes, np.concatenate(held), root, counts, 0, forest, generator)
        return nodes
    waiting = [(path, rows, root, counts, 0)]
    while waiting:
        path, rows, node, counts, depth = waiting.pop()
        if rows <= HELD:
            records = np.fromfile(path, forest.layout.record)
            path.unlink()
            grow_levels(nodes, records, node, counts, depth, forest, generator)
            continue
        lies = np.memmap(path, forest.layout.record, "r")
        found = [-1]
        if forest.is_open(counts[None, :], depth)[0]:
            sums = Histograms(subsets(generator, 1, forest.layout.width, forest.tried), forest.layout)
            for s in range(0, rows, STEP):
                part = np.array(lies[s : s + STEP])
                sums.count(part, np.array([0, len(part)]))
            found, at, left = sums.best(counts[None, :], forest)
        if found[0] >= 0:
            both = np.concatenate([left, counts - left])
            made = nodes.add(forest.share(both))
            nodes.split(np.array([node]), found, at, made[:1])
            paths, sizes = [Path(folder, f"{number}.{i}") for i in made], [0, 0]
            with paths[0].open("wb") as first, paths[1].open("wb") as second:
                for s in range(0, rows, STEP):
                    part = np.array(lies[s : s + STEP])
                    here = goes_left(part, np.repeat(found, len(part)), np.repeat(at, len(part)), forest.layout)
                    for i, (file, own) in enumerate(((first, part[here]), (second, part[~here]))):
                        file.write(own.tobytes())
                        sizes[i] += len(own)
            waiting += [(paths[i], sizes[i], int(made[i]), both[i], depth + 1) for i in (1, 0)]
        del lies
        path.unlink()
    return nodes


def drawn(pieces: Iterable[tuple[int, np.ndarray]], seed: int, tree: int) -> Iterator[np.ndarray]:
    """The rows a tree draws, each with how often: Poisson of mean 1, seeded by tree and block."""
    for block, records in pieces:
        draws = np.random.default_rng([seed, tree, block]).poisson(1.0, len(records))
        some = np.flatnonzero(draws)
        own = np.ascontiguousarray(records).view(np.dtype((np.void, records.itemsize)))[some].view(records.dtype)
        own["w"] = np.minimum(draws[some], 0xFF)
        yield own


def _grown(forest: Forest, trees: int, units: int):
    """Trees of a unit; its partition holds all blocks."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:
            blocks, pieces, rows, unit, lies = [], [], 0, None, Path(folder, "rows")
            with lies.open("wb") as file:
                for batch in batches:
                    for number, block, data in zip(*(batch.column(c) for c in ("unit", "block", "records"))):
                        if unit is not None and unit != number.as_py():
                            raise RuntimeError("a partition holds blocks of two units")
                        unit = number.as_py()
                        records = np.frombuffer(data.as_buffer(), forest.layout.record)
                        blocks.append((block.as_py(), len(records)))
                        rows += len(records)
                        if rows <= HELD:
                            pieces.append(records.copy())
                        else:
                            file.writelines(p.tobytes() for p in pieces)
                            pieces.clear()
                            file.write(records.tobytes())
            if not rows:
                return
            if not pieces:
                whole = np.memmap(lies, forest.layout.record, "r")
                pieces = np.split(whole, np.cumsum([n for _, n in blocks])[:-1])
            for tree in range(unit, trees, units):
                grown = grow_tree(drawn(zip((b for b, _ in blocks), pieces), forest.seed, tree), forest, tree, folder)
                yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), *(pa.array([a], pa.binary()) for a in grown.packed())], names=["tree", "feature", "bin", "link"])

    return grow


# --- scoring -------------------------------------------------------------------


def shares(trees: Iterable[tuple[bytes, bytes, bytes]], codes: np.ndarray, depth: int) -> np.ndarray:
    """Mean over trees of the leaf values, of rows of bins (rows, features)."""
    flat, base = codes.ravel(), np.arange(len(codes)) * codes.shape[1]
    total, n = np.zeros(len(codes)), 0
    for feature, at, link in trees:
        feature, at, link = np.frombuffer(feature, np.uint16), np.frombuffer(at, np.uint8), np.frombuffer(link, np.int32)
        leaf = feature == LEAF
        # Leaves lead to themselves: no bin is above 255.
        to = np.where(leaf, np.arange(len(leaf)), link).astype(np.int64)
        packed = to << 32 | at.astype(np.int64) << 16 | np.where(leaf, 0, feature)
        node = np.zeros(len(codes), np.int64)
        for _ in range(depth):
            step = packed[node]
            node = (step >> 32) + (flat[base + (step & 0xFFFF)] > (step >> 16 & 0xFF))
        total += link.view(np.float32)[node]
        n += 1
    return total / max(n, 1)


def all_codes(vectors: pa.StructArray, layout: Layout) -> np.ndarray:
    x, row, hot = parsed(vectors, layout)
    codes = np.zeros((len(x), layout.width), np.uint8)
    codes[:, : layout.numeric] = binned(x, layout)[:, : layout.numeric]
    codes[row, layout.numeric + hot] = 1
    return codes


class DealtForest(Estimator):
    """A random forest like Spark's (bootstrap by Poisson draws, 32 bins, Gini, the root of the number of features tried
    at each node, at least so many draws on each side); rows of a class have one weight."""

    def __init__(self, featuresCol: str, labelCol: str, weightCol: str, numTrees: int, maxDepth: int, minInstancesPerNode: int, seed: int):
        super().__init__()
        self.columns = featuresCol, labelCol, weightCol
        self.trees, self.depth, self.least, self.seed = numTrees, maxDepth, minInstancesPerNode, seed

    def _fit(self, frame: DataFrame) -> DealtForestModel:
        features, label, weight = self.columns
        spark = frame.sparkSession
        found = {r[0]: (r[1], r[2]) for r in frame.groupBy(label).agg(F.min(weight), F.max(weight)).collect()}
        if any(low != high for low, high in found.values()):
            raise ValueError("rows of a class must have one weight")
        layout = layout_of(frame, features)
        if layout.width >= LEAF:
            raise ValueError(f"more than {LEAF - 1} features")
        rows = frame.select(F.unwrap_udt(features).alias("v"), F.col(label).cast("int").alias("y"), F.col(weight).cast("double").alias("w"))
        reported = rows.mapInArrow(_reported(layout), "f long, value double, weight double")
        cuts = {r["f"]: np.array(r["edges"]) for r in reported.groupBy("f").applyInArrow(_cut, "f long, edges array<double>").collect()}
        layout = Layout(layout.place, layout.numeric, layout.hot, tuple(cuts[f] for f in range(layout.numeric)), max(1, int(cuts[-1][0])))
        blocks = checkpointed(rows.mapInArrow(_blocks(layout), "block long, records binary"))
        forest = Forest(layout, tuple(float(found[c][0]) if c in found else 0.0 for c in (0, 1)), self.depth, self.least, self.seed)
        units = min(self.trees, UNITS, max(12, 2 * spark.sparkContext.defaultParallelism))
        dealt = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(units - 1))).alias("unit"), "block", "records").repartitionById(units, "unit")
        grown = dealt.mapInArrow(_grown(forest, self.trees, units), "tree int, feature binary, bin binary, link binary").collect()
        trees = [(bytes(r["feature"]), bytes(r["bin"]), bytes(r["link"])) for r in sorted(grown, key=lambda r: r["tree"])]
        return DealtForestModel(features, layout, self.depth, trees)


class DealtForestModel(Model, MLWritable, MLReadable):
    """Adds ``probability``, the mean of the trees' leaf shares, and ``prediction``."""

    def __init__(self, features: str, layout: Layout, depth: int, trees: list[tuple[bytes, bytes, bytes]]):
        super().__init__()
        self.features, self.layout, self.depth, self.trees = features, layout, depth, trees
        self._shared = None

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self._shared is None:
            self._shared = dataset.sparkSession.sparkContext.broadcast(self.trees)
        shared, layout, depth = self._shared, self.layout, self.depth

        @F.arrow_udf("double")
        def share(v: pa.Array) -> pa.Array:
            return pa.array(shares(shared.value, all_codes(v, layout), depth))

        p = share(F.unwrap_udt(self.features))
        scored = dataset.withColumn("_share", p)
        return scored.withColumns(
            {"probability": array_to_vector(F.array(1 - F.col("_share"), F.col("_share"))), "prediction": (F.col("_share") > 0.5).cast("double")}
        ).drop("_share")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: DealtForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        spark = self.sparkSession
        kept = {"features": m.features, "depth": m.depth, "place": m.layout.place.tolist(), "numeric": m.layout.numeric, "hot": m.layout.hot, "set_at_once": m.layout.set_at_once, "edges": [e.tolist() for e in m.layout.edges]}
        DefaultParamsWriter.saveMetadata(m, path, spark, extraMetadata={"forest": kept})
        trees = [(i, *map(bytearray, t)) for i, t in enumerate(m.trees)]
        spark.createDataFrame(trees, "tree int, feature binary, bin binary, link binary").write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> DealtForestModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        kept = metadata["forest"]
        layout = Layout(np.array(kept["place"]), kept["numeric"], kept["hot"], tuple(np.array(e) for e in kept["edges"]), kept["set_at_once"])
        rows = spark.read.parquet(f"{path}/trees").orderBy("tree").collect()
        model = self.cls(kept["features"], layout, kept["depth"], [(bytes(r["feature"]), bytes(r["bin"]), bytes(r["link"])) for r in rows])
        model._resetUid(metadata["uid"])
        return model
