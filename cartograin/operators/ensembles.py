"""Many small regressions at once: linear models, random forests and boosted trees per group.

A group is a dense daily series (or a fold of one), so it is bounded by the calendar. Spark
deals the groups, and parts of the forests within them, over the tasks of one job; a fit
comes back as rows: one per tree, its nodes as flat arrays.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINEAR, FOREST, BOOSTED = "LinearRegression", "RandomForestRegressor", "GBTRegressor"
#: Trees of a forest that one task grows side by side.
TREES_PER_TASK = 25
#: Bins of a feature for boosting.
BINS = 255

NODES = "feature array<int>, threshold array<double>, left array<int>, right array<int>, value array<double>, rows array<bigint>"


@dataclass
class Tree:
    """Nodes as arrays; the root is node 0, a leaf has feature -1. A row goes left at x[feature] <= threshold."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    rows: np.ndarray

    def row(self) -> dict[str, list]:
        return {k: v.tolist() for k, v in self.__dict__.items()}


def stacked(trees: Sequence[dict]) -> tuple[np.ndarray, ...]:
    """Trees end to end: roots, feature, threshold, left, right, value."""
    sizes = [len(t["feature"]) for t in trees]
    roots = np.cumsum([0, *sizes[:-1]])
    shift = np.repeat(roots, sizes)
    feature, threshold, left, right, value = (np.concatenate([t[c] for t in trees]) for c in ("feature", "threshold", "left", "right", "value"))
    return roots, feature.astype(np.int64), threshold.astype(float), left.astype(np.int64) + shift, right.astype(np.int64) + shift, value.astype(float)


def walked(trees: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """Leaf values, (rows, trees)."""
    roots, feature, threshold, left, right, value = trees
    node = np.tile(roots, (len(x), 1))
    rows = np.arange(len(x))[:, None]
    while True:
        tested = feature[node]
        if (tested < 0).all():
            return value[node]
        down = np.where(x[rows, np.maximum(tested, 0)] <= threshold[node], left[node], right[node])
        node = np.where(tested < 0, node, down)


# --- growing -------------------------------------------------------------------


def grow_forest(x: np.ndarray, y: np.ndarray, draws: np.ndarray, depth: int, least: int) -> list[Tree]:
    """Squared-error trees, one per row of ``draws`` (how often each row is drawn), all grown level by level.

    Every split between neighbouring distinct values is tried. ``least`` drawn rows stay on each side.
    """
    trees, n = draws.shape
    codes, values = zip(*[(c, v) for v, c in (np.unique(column, return_inverse=True) for column in x.T)])
    tree, row = np.nonzero(draws)
    weight = draws[tree, row].astype(float)
    target = y[row]
    node = tree.copy()
    feature, threshold, left, right = (np.full(trees, v, t) for v, t in ((-1, np.int64), (np.nan, float), (-1, np.int64), (-1, np.int64)))
    owner = np.arange(trees)
    count = np.bincount(node, weights=weight, minlength=trees)
    total = np.bincount(node, weights=weight * target, minlength=trees)
    active = np.ones(len(node), bool)
    for _ in range(depth):
        at = np.flatnonzero(active)
        if not len(at):
            break
        open_nodes, local = np.unique(node[at], return_inverse=True)
        n_all, s_all = count[open_nodes], total[open_nodes]
        best_gain, best_feature, best_code = np.full(len(open_nodes), 1e-12), np.full(len(open_nodes), -1), np.zeros(len(open_nodes), np.int64)
        for f, code in enumerate(codes):
            here = code[row[at]]
            order = np.argsort(local * (len(values[f]) + 1) + here, kind="stable")
            group, c = local[order], here[order]
            w, s = np.cumsum(weight[at][order]), np.cumsum((weight * target)[at][order])
            begins = np.searchsorted(group, np.arange(len(open_nodes)))
            w0, s0 = (np.where(begins > 0, v[begins - 1], 0.0)[group] for v in (w, s))
            n_left, s_left = w - w0, s - s0
            n_right, s_right = n_all[group] - n_left, s_all[group] - s_left
            splits = np.zeros(len(order), bool)
            splits[:-1] = (group[1:] == group[:-1]) & (c[1:] != c[:-1])
            splits &= (n_left >= least) & (n_right >= least)
            spot = np.flatnonzero(splits)
            if not len(spot):
                continue
            gain = s_left[spot] ** 2 / n_left[spot] + s_right[spot] ** 2 / n_right[spot] - (s_all**2 / n_all)[group[spot]]
            ranked = np.lexsort((-gain, group[spot]))
            first = ranked[np.concatenate([[True], np.diff(group[spot][ranked]) != 0])]
            g = group[spot][first]
            better = gain[first] > best_gain[g]
            g, first = g[better], first[better]
            best_gain[g], best_feature[g], best_code[g] = gain[first], f, c[spot[first]]
        split = best_feature >= 0
        made = int(split.sum())
        if not made:
            break
        parents = open_nodes[split]
        f, k = best_feature[split], best_code[split]
        feature[parents] = f
        following = np.array([values[i][j + 1] for i, j in zip(f, k)])
        threshold[parents] = (np.array([values[i][j] for i, j in zip(f, k)]) + following) / 2
        left[parents] = len(feature) + 2 * np.arange(made)
        right[parents] = left[parents] + 1
        grown = 2 * made
        feature, left, right = (np.concatenate([v, np.full(grown, -1)]) for v in (feature, left, right))
        threshold = np.concatenate([threshold, np.full(grown, np.nan)])
        owner = np.concatenate([owner, np.repeat(owner[parents], 2)])
        active[at] = split[local]
        moving = at[split[local]]
        table = np.stack(codes)
        goes_left = table[best_feature[local], row[at]][split[local]] <= best_code[local][split[local]]
        node[moving] = np.where(goes_left, left[node[moving]], right[node[moving]])
        # Rows have left the nodes that were split; these keep what they had.
        inner = feature >= 0
        count = np.bincount(node, weights=weight, minlength=len(feature)) + np.pad(count, (0, grown)) * inner
        total = np.bincount(node, weights=weight * target, minlength=len(feature)) + np.pad(total, (0, grown)) * inner
    value = total / np.maximum(count, 1)
    out = []
    for t in range(trees):
        own = np.flatnonzero(owner == t)
        place = np.full(len(owner), -1)
        place[own] = np.arange(len(own))
        out.append(Tree(feature[own], threshold[own], np.where(left[own] >= 0, place[left[own]], -1), np.where(right[own] >= 0, place[right[own]], -1), value[own], count[own].astype(np.int64)))
    return out


def bin_edges(column: np.ndarray) -> np.ndarray:
    """Thresholds between bins: half way between distinct values, or, with more than ``BINS`` of
    them, the values at ranks floor(n * b / BINS) of the sorted column."""
    distinct = np.unique(column)
    if len(distinct) <= BINS:
        return (distinct[1:] + distinct[:-1]) / 2
    ranked = np.sort(column)
    return np.unique(ranked[len(column) * np.arange(1, BINS) // BINS])


def grow_best_first(binned: np.ndarray, edges: list[np.ndarray], gradient: np.ndarray, leaves: int, l2: float, least: int) -> tuple[Tree, np.ndarray]:
    """One tree, the leaf with the largest gain split first, until there are ``leaves``; and each row's leaf.

    Gain is G²/(n + l2) of both sides less that of the leaf, a leaf's value -G/(n + l2).
    A child's histogram comes from its rows if it is the smaller one, else by subtraction.
    """
    n_rows, n_features = binned.shape
    width = BINS + 1
    flat = binned + width * np.arange(n_features)
    usable = np.arange(width)[None, :] < np.array([len(e) for e in edges])[:, None]

    def histogram(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = flat[rows].ravel()
        counts = np.bincount(at, minlength=n_features * width).reshape(n_features, width)
        sums = np.bincount(at, weights=np.repeat(gradient[rows], n_features), minlength=n_features * width).reshape(n_features, width)
        return counts, sums

    def best(counts: np.ndarray, sums: np.ndarray, n: int, g: float) -> tuple[float, int, int]:
        n_left, g_left = counts.cumsum(axis=1), sums.cumsum(axis=1)
        n_right, g_right = n - n_left, g - g_left
        fine = usable & (n_left >= least) & (n_right >= least)
        gain = np.where(fine, g_left**2 / (n_left + l2) + g_right**2 / (n_right + l2) - g**2 / (n + l2), -np.inf)
        place = int(gain.argmax())
        return float(gain.flat[place]), place // width, place % width

    feature, threshold, left, right, value, rows_in = [-1], [np.nan], [-1], [-1], [], []
    member = [np.arange(n_rows)]
    held = [histogram(member[0])]
    queue: list[tuple[float, int, int, int]] = []

    def consider(node: int) -> None:
        g, n = float(gradient[member[node]].sum()), len(member[node])
        value.append(-g / (n + l2))
        rows_in.append(n)
        if n >= 2 * least:
            gain, f, b = best(*held[node], n, g)
            if gain > 1e-12:
                heapq.heappush(queue, (-gain, node, f, b))

    consider(0)
    open_leaves = 1
    while queue and open_leaves < leaves:
        _, node, f, b = heapq.heappop(queue)
        goes_left = binned[member[node], f] <= b
        parts = member[node][goes_left], member[node][~goes_left]
        small = int(len(parts[1]) < len(parts[0]))
        own = histogram(parts[small])
        other = tuple(h - o for h, o in zip(held[node], own))
        feature[node], threshold[node], left[node], right[node] = f, float(edges[f][b]), len(feature), len(feature) + 1
        held[node], member[node] = None, None
        for side in (0, 1):
            feature.append(-1)
            threshold.append(np.nan)
            left.append(-1)
            right.append(-1)
            member.append(parts[side])
            held.append(own if side == small else other)
            consider(len(feature) - 1)
        open_leaves += 1
    leaf = np.zeros(n_rows, np.int64)
    for node, rows in enumerate(member):
        if rows is not None:
            leaf[rows] = node
    return Tree(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), np.array(rows_in)), leaf


def grow_boosted(x: np.ndarray, y: np.ndarray, rounds: int, rate: float, leaves: int, l2: float, least: int) -> list[Tree]:
    """Boosting of squared error from the mean (tree 0, a single leaf); leaf values hold the rate."""
    edges = [bin_edges(c) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
    start = float(y.mean())
    none = np.array([-1])
    trees = [Tree(none, np.array([np.nan]), none, none, np.array([start]), np.array([len(y)]))]
    predicted = np.full(len(y), start)
    for _ in range(rounds):
        tree, leaf = grow_best_first(binned, edges, predicted - y, leaves, l2, least)
        tree.value *= rate
        predicted += tree.value[leaf]
        trees.append(tree)
    return trees


# --- fitting groups ----------------------------------------------------------------


@dataclass(frozen=True)
class EnsembleSettings:
    """Sizes of the candidate models."""

    trees: int = 250
    tree_depth: int = 14
    tree_min_rows: int = 3
    boosting_rounds: int = 200
    boosting_rate: float = 0.06
    boosting_leaves: int = 31
    boosting_l2: float = 1.0
    boosting_min_rows: int = 20
    seed: int = 42


def _grown(name: str, part: int, x: np.ndarray, y: np.ndarray, s: EnsembleSettings) -> Iterator[tuple[int, dict]]:
    """(tree, nodes) of one part of a fit; rows come in a fixed order."""
    none: list = []
    if name == LINEAR:
        solved = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)[0]
        yield 0, {"feature": none, "threshold": none, "left": none, "right": none, "value": solved.tolist(), "rows": [len(x)]}
    elif name == FOREST:
        numbers = range(part * TREES_PER_TASK, min((part + 1) * TREES_PER_TASK, s.trees))
        draws = np.stack([np.bincount(np.random.default_rng([s.seed, t]).integers(0, len(x), len(x)), minlength=len(x)) for t in numbers])
        yield from zip(numbers, (t.row() for t in grow_forest(x, y, draws, s.tree_depth, s.tree_min_rows)))
    elif name == BOOSTED:
        grown = grow_boosted(x, y, s.boosting_rounds, s.boosting_rate, s.boosting_leaves, s.boosting_l2, s.boosting_min_rows)
        yield from enumerate(t.row() for t in grown)
    else:
        raise ValueError(f"unknown model: {name}")


def fit_groups(rows: DataFrame, by: Sequence[str], order: str, features: Sequence[str], target: str, names: Sequence[str], settings: EnsembleSettings) -> DataFrame:
    """Every named model for every group: one row per tree, (by…, model, tree, nodes).

    A linear model is one row whose ``value`` holds the intercept and the coefficients
    (least squares of smallest norm). ``order`` names the column that puts a group's rows
    in a fixed order.
    """
    parts = [(n, p) for n in names for p in range(-(-settings.trees // TREES_PER_TASK) if n == FOREST else 1)]
    for name in names:
        if name not in (LINEAR, FOREST, BOOSTED):
            raise ValueError(f"unknown model: {name}")
    work = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.lit(p).alias("part")) for n, p in parts]))
    spread = rows.select(*by, order, F.array(*[F.col(f).cast("double") for f in features]).alias("_x"), F.col(target).cast("double").alias("_y"), work.alias("_w"))
    spread = spread.select("*", F.col("_w.model").alias("model"), F.col("_w.part").alias("_part")).drop("_w")
    kinds = dict(rows.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in by), "model string, tree int", NODES])

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by(order)
        x = np.array(table.column("_x").to_pylist(), float)
        y = table.column("_y").to_numpy()
        name = table.column("model")[0].as_py()
        grown = list(_grown(name, table.column("_part")[0].as_py(), x, y, settings))
        first = {c: [table.column(c)[0].as_py()] * len(grown) for c in (*by, "model")}
        nodes = {c: [g[c] for _, g in grown] for c in ("feature", "threshold", "left", "right", "value", "rows")}
        return pa.table({**first, "tree": [t for t, _ in grown], **nodes}, schema=_arrow_schema(table, by))

    # The rows are few and the work on them is much: partitions that would be merged by size stay apart.
    partitions = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8 * len(parts))
    return spread.repartition(partitions, *by, "model", "_part").groupBy(*by, "model", "_part").applyInArrow(fit, schema)


def _arrow_schema(table: pa.Table, by: Sequence[str]) -> pa.Schema:
    ints, doubles = pa.list_(pa.int32()), pa.list_(pa.float64())
    nodes = [("feature", ints), ("threshold", doubles), ("left", ints), ("right", ints), ("value", doubles), ("rows", pa.list_(pa.int64()))]
    return pa.schema([*(table.schema.field(c) for c in by), ("model", pa.string()), ("tree", pa.int32()), *nodes])


class Predictor:
    """All models of a group as arrays: {model: predictions} for rows of features."""

    def __init__(self, fits: pa.Table):
        self.models: dict[str, tuple] = {}
        for name in sorted(set(fits.column("model").to_pylist())):
            own = sorted((r for r in fits.to_pylist() if r["model"] == name), key=lambda r: r["tree"])
            self.models[name] = (np.array(own[0]["value"]),) if name == LINEAR else stacked(own)

    def __call__(self, name: str, x: np.ndarray) -> np.ndarray:
        held = self.models[name]
        if name == LINEAR:
            return held[0][0] + x @ held[0][1:]
        leaves = np.concatenate([walked(held, x[i : i + 2000]) for i in range(0, len(x), 2000)])
        return leaves.mean(axis=1) if name == FOREST else leaves.sum(axis=1)
