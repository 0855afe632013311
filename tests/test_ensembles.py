import numpy as np

from cartograin.operators import ensembles as E


def data(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=(n, 3)), rng.integers(0, 7, (n, 2))]).astype(float)
    return x, np.sin(2 * x[:, 0]) * 3 + x[:, 3] + rng.normal(size=n) * 0.3


def best_split(x, y, rows, least, l2=0.0):
    found = []
    for f in range(x.shape[1]):
        for v in np.unique(x[rows, f])[:-1]:
            left = rows[x[rows, f] <= v]
            right = rows[x[rows, f] > v]
            if min(len(left), len(right)) >= least:
                found.append((y[left].sum() ** 2 / (len(left) + l2) + y[right].sum() ** 2 / (len(right) + l2), f, v))
    return max(found)


def test_a_tree_takes_the_best_split_at_every_node():
    x, y = data()
    tree = E.grow_forest(x, y, np.ones((1, len(x)), int), 3, 5)[0]
    rows = {0: np.arange(len(x))}
    for node in range(len(tree.feature)):
        own = rows[node]
        assert tree.rows[node] == len(own) and np.isclose(tree.value[node], y[own].mean())
        if tree.feature[node] >= 0:
            gain, f, v = best_split(x, y, own, 5)
            left = own[x[own, tree.feature[node]] <= tree.threshold[node]]
            right = np.setdiff1d(own, left)
            assert np.isclose(y[left].sum() ** 2 / len(left) + y[right].sum() ** 2 / len(right), gain)
            rows[tree.left[node]], rows[tree.right[node]] = left, right


def test_draws_weigh_rows_and_trees_do_not_mix():
    x, y = data(120)
    draws = np.random.default_rng(3).integers(0, 3, (4, len(x)))
    for tree, drawn in zip(E.grow_forest(x, y, draws, 6, 3), draws):
        repeated = np.repeat(np.arange(len(x)), drawn)
        alone = E.grow_forest(x[repeated], y[repeated], np.ones((1, len(repeated)), int), 6, 3)[0]
        assert tree.rows[0] == drawn.sum()
        # Splits of equal gain may differ in feature, not in the drawn rows they part.
        assert np.allclose(E.walked(E.stacked([tree.row()]), x[repeated]), E.walked(E.stacked([alone.row()]), x[repeated]))
        assert (tree.rows[tree.feature < 0] >= 3).all()


def test_boosted_trees_keep_the_leaf_limit_and_regularise():
    x, y = data()
    trees = E.grow_boosted(x, y, 20, 0.1, 7, 1.0, 20)
    assert np.isclose(trees[0].value[0], y.mean()) and all((t.feature < 0).sum() <= 7 for t in trees)
    predicted = np.full(len(y), y.mean())
    for tree in trees[1:]:
        gradient = predicted - y
        one = E.stacked([tree.row()])
        leaf_value = E.walked(one, x)[:, 0]
        for v in np.unique(leaf_value):
            own = leaf_value == v
            assert np.isclose(v, -0.1 * gradient[own].sum() / (own.sum() + 1.0)) and own.sum() >= 20
        gain, f, _ = best_split(x, -gradient, np.arange(len(x)), 20, 1.0)
        assert tree.feature[0] == f or np.isclose(gain, best_split(x[:, [tree.feature[0]]], -gradient, np.arange(len(x)), 20, 1.0)[0], rtol=1e-2)
        predicted += leaf_value
    assert ((predicted - y) ** 2).mean() < 0.4 * y.var()


def test_with_many_values_bins_are_ranks():
    column = np.arange(1000.0)
    edges = E.bin_edges(column)
    assert len(edges) == E.BINS - 1 and (np.bincount(np.searchsorted(edges, column)) <= 5).all()
    assert E.bin_edges(np.array([1.0, 1.0, 3.0])).tolist() == [2.0]


def test_every_model_of_every_group_in_one_frame(spark):
    rows = [(g, i, float(i % 5), float(i), float(3 * i + g)) for g in (1, 2) for i in range(60)]
    frame = spark.createDataFrame(rows, "g int, day int, a double, b double, y double")
    small = E.EnsembleSettings(trees=30, tree_depth=3, boosting_rounds=5)
    fits = E.fit_groups(frame, ["g"], "day", ["a", "b"], "y", (E.LINEAR, E.FOREST, E.BOOSTED), small)
    counts = {(r.g, r.model): r["count"] for r in fits.groupBy("g", "model").count().collect()}
    assert counts == {(g, m): n for g in (1, 2) for m, n in ((E.LINEAR, 1), (E.FOREST, 30), (E.BOOSTED, 6))}
    predict = E.Predictor(fits.filter("g = 2").toArrow())
    assert np.allclose(predict(E.LINEAR, np.array([[1.0, 7.0]])), [23.0])
    assert 0 < predict(E.FOREST, np.array([[1.0, 7.0]]))[0] < 90 and 0 < predict(E.BOOSTED, np.array([[1.0, 7.0]]))[0] < 90
