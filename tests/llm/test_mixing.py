from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartograin.llm.mixing import Mix, mix_report, mix_sources, mixed, shard_quotas, sized, targets, write_shards

from .conftest import HARD


def corpus(sources, n=60):
    rng = np.random.default_rng(4)
    rows = []
    for source in sources:
        for _ in range(n):
            i = len(rows)
            rows.append((i, " ".join(f"w{i}_{j}" for j in range(int(rng.integers(1, 80)))), source))
    return rows


def expected_targets(sizes, weights=(1, 2, 3), most=3):
    """Share, cap, share the excess again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**capped, **share}
        capped |= {s: most * sizes[s] for s in over}


def test_targets_and_taken_words(documents):
    rows = corpus(["b", "a", None, "é", "small"]) + [(9_000, "tiny", "tiny"), (9_001, "", "void"), (9_002, None, "void")]
    report = mix_report(documents(rows)).collect()
    assert len(report) == len(rows)
    source = {i: s for i, _, s in rows}
    sizes, taken, target = Counter(), Counter(), {}
    for r in report:
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert r.taken % r.size == 0 if r.size else r.taken == 0
        assert r.taken <= 3 * r.size
    want = expected_targets(sizes)
    assert target == pytest.approx(want) and sum(target.values()) == pytest.approx(sum(sizes.values()))
    assert taken["tiny"] == 3
    for s in ("a", "b", None, "é", "small"):
        assert abs(taken[s] - want[s]) <= 8


def test_reruns_agree_whatever_the_layout(documents):
    rows = corpus(["x", "y"], 40)
    first = sorted((r.doc_id, r.taken, tuple(r.shards)) for r in mix_report(documents(rows)).collect())
    second = sorted((r.doc_id, r.taken, tuple(r.shards)) for r in mix_report(documents(rows[::-1]).repartition(7)).collect())
    assert first == second


def test_quotas_of_the_tree_are_exact_and_disjoint(documents):
    mix = Mix(shards=7, blocks_per_shard=11)
    goals = targets(sized(documents(corpus(["a", "b", "c", None], 20))), mix)
    leaves = shard_quotas(goals, mix).collect()
    per_shard, per_source = Counter(), {}
    for r in leaves:
        per_shard[r.shard] += r.last - r.first
        per_source.setdefault(r.source, []).append((r.first, r.last, r.blocks))
    total = sum(per_shard.values())
    assert all(abs(n - total / 7) < 1 for n in per_shard.values())
    for ranges in per_source.values():
        ranges.sort()
        assert ranges[0][0] == 0 and ranges[-1][1] == ranges[0][2]
        assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))


def test_splits_follow_the_hypergeometric_mean(documents):
    """Over many seeds, half of a source's blocks go left on average, with the right variance."""
    goals = targets(sized(documents(corpus(["a", "b"], 20))))
    left = []
    for seed in range(12):
        rows = shard_quotas(goals, Mix(shards=2, blocks_per_shard=100, seed=seed)).filter("shard = 0 AND source = 'a'").collect()
        left.append((sum(r.last - r.first for r in rows), rows[0].blocks if rows else 0))
    k, n = left[0][1], 200
    sd = np.sqrt(100 * (k / n) * (1 - k / n) * (n - 100) / (n - 1))
    assert abs(np.mean([x for x, _ in left]) - k / 2) < 4 * sd / np.sqrt(len(left))
    assert 0 < np.std([x for x, _ in left]) < 3 * sd


def test_copies_are_placed_once_and_rows_come_back(documents):
    rows = corpus(["a", "b"], 30)
    rows += [rows[0], rows[0]]
    sizes, _, copies = mix_sources(documents(rows), Mix(shards=4, blocks_per_shard=8))
    placed = copies.collect()
    assert len({(r.row, r.epoch) for r in placed}) == len(placed) and {r.shard for r in placed} == {0, 1, 2, 3}
    out = mixed(documents(rows))
    assert out.columns == documents(rows).columns
    counts = Counter(r.doc_id for r in out.collect())
    report = Counter()
    for r in mix_report(documents(rows)).collect():
        report[r.doc_id] += r.taken // r.size
    assert counts == +report


def test_hard_texts(documents):
    got = mix_report(documents([(i, t, None if i == 4 else "s") for i, t in HARD])).collect()
    assert len(got) == len(HARD) and sum(r.size for r in got) == 60_010
    empty = mix_report(documents([]).limit(0))
    assert empty.count() == 0
    assert [r.taken for r in mix_report(documents([(1, None), (2, "")])).collect()] == [0, 0]


def test_shards_are_written_disjoint_whole_and_shuffled(spark, documents, tmp_path):
    """What the tree and the permutation decide is what the files hold."""
    rows = documents(corpus(["a", "b", "c"], 40)).drop("document")
    mix = Mix(shards=5, blocks_per_shard=8)
    write_shards(rows, str(tmp_path / "mix"), mix)
    written = spark.read.parquet(str(tmp_path / "mix"))
    assert sorted(map(str, written.select(*rows.columns).collect())) == sorted(map(str, mixed(rows, mix).collect()))
    wanted = mix_sources(rows, mix)[2].groupBy("doc_id", "shard").count().collect()
    assert {(r.doc_id, r.mix_shard, r["count"]) for r in written.groupBy("doc_id", "mix_shard").count().collect()} == {tuple(r) for r in wanted}
    for shard in range(5):
        order = [r.doc_id for f in sorted((tmp_path / "mix" / f"mix_shard={shard}").glob("*.parquet")) for r in spark.read.parquet(str(f)).select("doc_id").collect()]
        assert len(order) > 20 and order != sorted(order) and order != sorted(order, reverse=True)
    with pytest.raises(ValueError):
        write_shards(rows.withColumn("mix_shard", F.lit(1)), str(tmp_path / "other"), mix)
