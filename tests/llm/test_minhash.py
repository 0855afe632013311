import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartograin.llm.components import components, merged
from cartograin.llm.minhash_dedup import Banding, minhash_dedup, near_sketches, odd_sketches, shingle_sets, without_near_copies

from .conftest import HARD


def shingles(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(((d, len(sets[i]), least.get(root(i)), d == least.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


def found(frame):
    return sorted(map(tuple, frame.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"edit{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize("pivots", [1, 4])
def test_agrees_with_brute_force(documents, pivots):
    rng = random.Random(pivots)
    vocabulary = [f"Word{i}" for i in range(60)]
    passage = rng.choices(vocabulary, k=30)
    rows = []
    for group in range(12):
        base = rng.choices(vocabulary, k=rng.randrange(20, 120))
        for _ in range(rng.randrange(1, 9)):
            rows.append(" ".join(edited(rng, base, rng.randrange(0, 4))))
    rows += [" ".join(rng.choices(vocabulary, k=20) + passage) for _ in range(25)]
    rows += [" ".join(passage)] * 3 + ["a b c", "A b C", "a b c d"]
    rng.shuffle(rows)
    numbered = list(enumerate(rows))
    assert found(minhash_dedup(documents(numbered), Banding(pivots=pivots))) == brute(numbered)


def test_chains_of_copies_are_one_component(documents):
    """Neighbours in the chain link, its ends don't."""
    words = [f"c{i}" for i in range(160)]
    rows = [(i, " ".join(words[2 * i : 2 * i + 90])) for i in range(30)]
    got = {r.component_id for r in minhash_dedup(documents(rows)).collect()}
    assert got == {0}


def test_hard_texts(documents):
    got = found(minhash_dedup(documents([r for r in HARD if r[0] is not None])))
    by_id = {}
    for row in got:
        by_id.setdefault(row[0], []).append(row)
    assert by_id[1] == [(1, 0, 1, True)] and by_id[8] == [(8, 0, 8, True)]
    assert by_id[7] == [(7, 1, 7, True)] * 2
    assert by_id[6] == [(6, 1, 6, True)]


def test_null_ids_come_last(documents):
    rows = [(None, "one two three four five six"), (9, "one two three four five six"), (None, "quite another text of seven words here")]
    assert found(minhash_dedup(documents(rows))) == sorted([(9, 2, 9, True), (None, 2, 9, False), (None, 3, None, True)], key=str)


def test_one_row_of_a_group_stays(documents):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (3, text), (3, text), (4, text + " more"), (8, None), (9, "")]
    kept = without_near_copies(documents(rows))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(3, text), (8, None), (9, "")]
    assert kept.columns == documents(rows).columns


def test_empty_table(documents):
    assert minhash_dedup(documents([]).limit(0)).count() == 0


def test_shingles_of_short_and_empty_texts():
    text, _ = shingle_sets([b"", b"a b", b"a b c d e f", b"a b", b"  "], 5)
    assert text.tolist() == [1, 2, 2, 3]


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(1, 41)} == {1} and {got[i] for i in range(100, 130)} == {100} and {got[i] for i in (200, 201, 202)} == {200}
    more = merged(spark.createDataFrame(list(got.items()), "node bigint, component bigint"), spark.createDataFrame([(40, 129), (500, 202)], "a bigint, b bigint"))
    got = {r.node: r.component for r in more.collect()}
    assert got[129] == got[1] == 1 and got[500] == got[201] == 200


def test_groups_that_meet_in_buckets_without_linking(documents):
    """Two groups of edited copies at half their words, one document between that links with both, and one with neither."""
    rng = random.Random(4)
    words = [f"t{i}" for i in range(120)]
    other = words[:80] + [f"o{i}" for i in range(40)]

    middle = words[:100] + [f"o{i}" for i in range(20, 40)]
    rows = [(i, " ".join(edited(rng, words, 1))) for i in range(1, 60)] + [(100 + i, " ".join(edited(rng, other, 1))) for i in range(60)]
    rows += [(300, " ".join(middle)), (301, " ".join(words[:60] + [f"z{i}" for i in range(60)]))]
    assert found(minhash_dedup(documents(rows))) == brute(rows)


@pytest.mark.parametrize("size", [7, 70, 700, 7000])
def test_sketches_keep_links_and_rule_out_others(spark, size):
    """Sets of ``size`` elements that differ in exactly as many as a link allows stay, half-alike ones of middle size go."""
    rng = np.random.default_rng(size)

    def kept(differing):
        rows = []
        for _ in range(300):
            pool = rng.integers(0, 1 << 63, size + differing).astype(np.uint64)
            text, hashed = np.repeat([0, 1], size), np.concatenate([pool[:size], pool[differing:]])
            rows.append(tuple(x.view(np.int64).tolist() for x in odd_sketches(text, hashed, 2, 16)))
        frame = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>")
        return frame.filter(near_sketches("a", "b", F.lit(2 * size), Banding())).count()

    assert kept(size // 7) == 300
    assert size not in (70, 700) or kept(size // 3) == 0


def test_links_at_the_limit_are_found(documents):
    """1,000 pairs at a similarity of exactly 0.75 (72 of 96 shingles), in one group that shares a passage."""
    shared = [f"s{i}" for i in range(30)]
    rows = []
    for pair in range(1000):
        common = shared + [f"p{pair}x{i}" for i in range(46)]
        rows += [(2 * pair, " ".join([f"a{pair}y{i}" for i in range(12)] + common)), (2 * pair + 1, " ".join([f"b{pair}y{i}" for i in range(12)] + common))]
    got = {r.doc_id: r.component_id for r in minhash_dedup(documents(rows)).collect()}
    assert sum(got[2 * p + 1] == 2 * p for p in range(1000)) >= 990
    assert all(component in (doc, doc - 1) for doc, component in got.items())
