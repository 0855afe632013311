import math

import numpy as np
import pytest
from hypothesis import given
from hypothesis import settings as examples
from hypothesis import strategies as st

from cartograin.llm import vector_codes as V


def plain(rows, parts=16, entries=64, rounds=2):
    """Definition, with Python integers: (code, error) by row, and the codebooks."""
    width = len(rows[0][1]) // parts
    cut = [[[math.floor(256 * v) for v in x[p * width : (p + 1) * width]] for p in range(parts)] for _, x in rows]
    books = [[cut[i][p] for i in sorted(range(len(rows)), key=lambda i: rows[i][0])[:entries]] for p in range(parts)]

    def assigned(p):
        return [min((sum((a - b) ** 2 for a, b in zip(x[p], e)), i) for i, e in enumerate(books[p])) for x in cut]

    for _ in range(rounds):
        for p in range(parts):
            near = assigned(p)
            for e in range(len(books[p])):
                own = [x[p] for x, (_, i) in zip(cut, near) if i == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    final = [assigned(p) for p in range(parts)]
    return [("".join(f"{final[p][i][1]:02x}" for p in range(parts)), sum(final[p][i][0] for p in range(parts))) for i in range(len(rows))], books


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, code string, error int, part string")


def test_codes_equal_the_definition(spark, spread, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(0, 0.2, 32)]) for i in range(150)]
    rows += [(150 + i, rows[7][1]) for i in range(60)]  # a third of the rows are one vector
    labels = [None if i % 3 == 0 else i % 2 for i in range(len(rows))]
    got = V.vector_codes(frame(spark, [(i, x, lab, "c", 1, "p") for (i, x), lab in zip(rows, labels)]).repartition(5)).collect()
    want, books = plain(rows)
    assert {r.vec_id: (r.code, r.error) for r in got} == {i: w for (i, _), w in zip(rows, want)}
    for lab in (None, 0, 1):
        total = sum(w[1] for w, x in zip(want, labels) if x == lab)
        assert {r.label_error for r in got if r.label == lab} == {total}
    assert {r.codebooks_sha256 for r in got} == {V.codebook_digest(np.array(books))}


def test_what_is_left_out(spark):
    fine = [0.5] * 16
    rows = [(1, fine), (2, None), (3, [None] + fine[1:]), (4, [float("nan")] + fine[1:]), (5, [float("inf")] * 16), (6, fine[:8]), (6, []), (None, fine), (1, fine)]
    got = V.vector_codes(frame(spark, [(i, x, None, None, None, None) for i, x in rows]))
    assert sorted(str(r.vec_id) for r in got.collect()) == ["1", "1", "None"]
    assert {(r.code, r.error, r.label_error) for r in got.collect()} == {("00" * 16, 0, 0)}
    assert V.vector_codes(frame(spark, [])).count() == 0
    assert V.vector_codes(frame(spark, [(2, None, 1, None, None, None)])).columns == got.columns


def test_a_length_that_parts_do_not_divide(spark):
    rows = [(i, [i / 10] * 5, 0, None, None, None) for i in range(4)]
    got = V.vector_codes(frame(spark, rows), parts=2, entries=2).collect()
    assert {r.vec_id: r.code for r in got} == {0: "0000", 1: "0000", 2: "0101", 3: "0101"}


def test_large_components_are_refused(spark):
    with pytest.raises(Exception, match="2\\^18"):
        V.vector_codes(frame(spark, [(1, [1e9] * 16, 0, None, None, None)])).collect()


@examples(max_examples=40, deadline=None)
@given(st.integers(1, 400), st.integers(1, 4), st.integers(1, 40), st.integers(0, 2**31))
def test_trees_assign_like_a_scan(rows, width, reach, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-reach, reach, (3, rows, width))
    books = rng.integers(-reach, reach, (3, 9, width))
    trees, kept = V.Trees.read(V.Trees(x).write(x))
    assert (trees.total[trees.roots] == x.sum(axis=1)).all()
    laid = np.full(3 * rows, -1)
    for what, entry, ball in trees.assign(kept, books):
        if ball:
            assert (trees.left[what] >= -1).all()
            laid[V.ranges(trees.start[what], trees.count[what])] = np.repeat(entry, trees.count[what])
        else:
            laid[what] = entry
    codes = np.empty((3, rows), int)
    np.put_along_axis(codes, trees.order, laid.reshape(3, rows), axis=1)
    assert (codes == ((x[:, :, None] - books[:, None]) ** 2).sum(axis=3).argmin(axis=2)).all()
