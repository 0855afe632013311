import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from test_late_delivery import SMALL, dataset  # noqa: F401

from cartograin.operators import forests as T
from cartograin.plans import late_delivery as K

LAYOUT = T.Layout(np.arange(7), 3, 4, set_at_once=2)


def drawn_rows(n, seed=0):
    generator = np.random.default_rng(seed)
    records = np.zeros(n, LAYOUT.record)
    records["x"] = generator.integers(0, 8, (n, 3))
    records["h"] = np.sort(generator.integers(0, 5, (n, 2)), axis=1)
    records["h"][records["h"][:, 0] == records["h"][:, 1], 1] = LAYOUT.hot
    records["y"] = generator.random(n) < 0.1 + 0.08 * records["x"][:, 1] + 0.2 * (records["h"] == 2).any(axis=1)
    records["w"] = generator.integers(1, 4, n)
    return records


def codes(records):
    out = np.zeros((len(records), 7), np.uint8)
    out[:, :3] = records["x"]
    for h in records["h"].T:
        some = np.flatnonzero(h < LAYOUT.hot)
        out[some, 3 + h[some]] = 1
    return out


def grown(records, tmp_path, depth=6, least=5, number=0):
    forest = T.Forest(LAYOUT, (0.5, 2.0), depth, least, 42)
    return T.grow_tree(np.array_split(records, 3), forest, number, str(tmp_path)), forest


def leaves(nodes, x):
    node = np.zeros(len(x), int)
    while (inner := nodes.feature[node] != T.LEAF).any():
        n = node[inner]
        node[inner] = nodes.link[n] + (x[inner, nodes.feature[n]] > nodes.bin[n])
    return node


@pytest.mark.parametrize("held", [T.HELD, 40])
def test_leaves_hold_the_shares_of_their_rows(tmp_path, monkeypatch, held):
    """rows in memory and rows in files; the root's rows reach the leaves, each with enough draws."""
    monkeypatch.setattr(T, "HELD", held)
    monkeypatch.setattr(T, "STEP", 64)
    records = drawn_rows(1500)
    nodes, forest = grown(records, tmp_path)
    leaf = leaves(nodes, codes(records))
    counts = np.zeros((nodes.size, 2))
    np.add.at(counts, (leaf, records["y"]), records["w"])
    ends = np.unique(leaf)
    assert len(ends) > 10 and (counts[ends].sum(axis=1) >= 5).all()
    assert set(ends) == set(np.flatnonzero(nodes.feature[: nodes.size] == T.LEAF))
    assert np.allclose(nodes.value[ends], forest.share(counts[ends]))
    assert not list(tmp_path.iterdir())


def test_a_split_has_the_largest_gain(tmp_path, monkeypatch):
    monkeypatch.setattr(T.Forest, "tried", property(lambda self: self.layout.width))
    records = drawn_rows(600)
    nodes, forest = grown(records, tmp_path, depth=1)
    x, best = codes(records), {}

    def purity(rows):
        w = [rows["w"][rows["y"] == c].sum() * forest.weights[c] for c in (0, 1)]
        return (w[0] ** 2 + w[1] ** 2) / sum(w)

    for f in range(7):
        for b in range(7 if f < 3 else 1):
            low, high = records[x[:, f] <= b], records[x[:, f] > b]
            if min(low["w"].sum(), high["w"].sum()) >= 5:
                best[f, b] = purity(low) + purity(high)
    assert (nodes.feature[0], nodes.bin[0]) == max(best, key=best.get)


def test_alike_siblings_are_one_leaf_and_scores_are_means(tmp_path):
    records = drawn_rows(900)
    trees = [grown(records, tmp_path, number=i)[0] for i in range(3)]
    x = codes(records)
    found = T.shares([t.packed() for t in trees], x, 6)

    def value(t, node, row):
        def merged(n):
            if t.feature[n] == T.LEAF:
                return True
            low, high = int(t.link[n]), int(t.link[n]) + 1
            return merged(low) and merged(high) and (t.value[low] > 0.5) == (t.value[high] > 0.5)

        return t.value[node] if merged(node) else value(t, int(t.link[node] + (row[t.feature[node]] > t.bin[node])), row)

    assert np.allclose(found, [np.mean([value(t, 0, row) for t in trees]) for row in x])


def test_edges_part_the_weight():
    assert T.bin_edges(np.array([1.0, 2.0, 4.0]), np.ones(3)).tolist() == [1.5, 3.0]
    edges = T.bin_edges(np.arange(1000.0), np.ones(1000))
    assert len(edges) == 31 and np.abs(np.diff(edges) - 1000 / 32).max() <= 1
    heavy = T.bin_edges(np.arange(100.0), np.where(np.arange(100) == 7, 1000.0, 1.0))
    assert len(heavy) < 31 and (np.diff(heavy) > 0).all()


def test_subsets_have_no_feature_twice():
    found = T.subsets(np.random.default_rng(0), 2000, 9, 3)
    assert (np.diff(found, axis=1) > 0).all() and np.abs(np.bincount(found.ravel()) / 2000 - 1 / 3).max() < 0.05


def test_many_rows_are_fitted_by_dealt_trees(dataset, tmp_path, monkeypatch):  # noqa: F811
    """above a few rows the forest is grown in whole trees; the number of tasks does not change it."""
    monkeypatch.setattr(K, "FEW_ROWS", 100)
    name = "RandomForestClassifier"
    spark = dataset.sparkSession
    assert isinstance(K._estimators(SMALL, 400)[name][1], T.DealtForest)
    model = K.fit_candidates(dataset, SMALL, (name,))[name]
    scores = dict(K.score(model, dataset, "p").select("order_id", "p").collect())
    labels = dict(dataset.select("order_id", K.TARGET).collect())
    late, other = ([scores[k] for k in scores if labels[k] == c] for c in (1, 0))
    assert np.mean([a > b for a in late for b in other]) > 0.7
    monkeypatch.setattr(T, "UNITS", 2)
    again = K.fit_candidates(dataset, SMALL, (name,))[name]
    assert again.stages[-1].trees == model.stages[-1].trees
    model.write().overwrite().save(str(tmp_path / "model"))
    stored = type(model).load(str(tmp_path / "model"))
    assert dict(K.score(stored, dataset, "p").select("order_id", "p").collect()) == scores
    vectors = model.transform(dataset).select(vector_to_array("probability").alias("v"), "prediction")
    assert vectors.filter((F.abs(F.col("v")[0] + F.col("v")[1] - 1) > 1e-9) | ((F.col("v")[1] > 0.5) != (F.col("prediction") == 1))).count() == 0
    trained = K.train(dataset, SMALL)
    assert trained.comparison.count() == 8 and spark is trained.comparison.sparkSession
