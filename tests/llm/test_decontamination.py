import random

import numpy as np

from cartograin.llm.decontamination import Matching, align, leaks, reachable, without_leaks

from .conftest import HARD


def smith_waterman(a, b, m=Matching()):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            step = table[i - 1, j - 1] + (m.match if x == y else m.mismatch)
            table[i, j] = max(0, step, table[i - 1, j] + m.gap, table[i, j - 1] + m.gap)
    return table.max()


def test_alignment_is_smith_waterman():
    rng = random.Random(5)
    pairs = [([rng.choice("abcd") for _ in range(rng.randrange(1, 12))], [rng.choice("abcde") for _ in range(rng.randrange(1, 25))]) for _ in range(300)]
    score, ends = align([" ".join(a) for a, _ in pairs], [" ".join(b) for _, b in pairs], Matching())
    assert score.tolist() == [smith_waterman(a, b) for a, b in pairs]
    assert all(0 <= e < len(b) for e, (_, b) in zip(ends, pairs))


def words(tag, n):
    return [f"{tag}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(n)]


def benchmark(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id bigint, text string, seeds string")


def test_exact_edited_and_clean(spark, documents):
    item = words("q", 40)
    edited = [w if i % 5 else "changed" for i, w in enumerate(item)]
    longer = [w for i, w in enumerate(item) for w in ([w, "extra"] if i % 6 == 0 else [w])]
    shorter = [w for i, w in enumerate(item) if i % 7]
    prose = " ".join(words("z", 100))
    rows = [
        (1, f"{prose}\n{' '.join(item).upper()}! {prose}"),
        (2, f"{prose} {' '.join(edited)} {prose}"),
        (3, " ".join(longer)),
        (4, f"{prose}, {', '.join(shorter)}"),
        (5, prose),
        (6, f"{prose} {' '.join(item[:8])} {prose}"),
        (7, f"{' '.join(reversed(item))}"),
    ]
    got = {(r.doc_id, r.item_id): r for r in leaks(documents(rows), benchmark(spark, [(10, " ".join(item)), (11, " ".join(words("other", 30))), (12, None), (13, "")])).collect()}
    assert sorted(got) == [(1, 10), (2, 10), (3, 10), (4, 10)]
    assert got[1, 10].score == 80 and got[1, 10].ends_at == 139
    kept = without_leaks(documents(rows), benchmark(spark, [(10, " ".join(item))]))
    assert sorted(r.doc_id for r in kept.collect()) == [5, 6, 7] and kept.columns == documents(rows).columns


def test_frequent_leaks_are_found_by_their_rarest_seeds(spark, documents):
    item = words("q", 30)
    rows = [(i, f"p{i} r{i} {' '.join(item)} s{i}") for i in range(60)]
    found = leaks(documents(rows), benchmark(spark, [(1, " ".join(item))]), Matching(rare=5, always=3)).collect()
    assert len(found) == 60 and {r.seeds for r in found} == {3}


def test_parts_of_a_frequent_leak_are_found(spark, documents):
    item = words("q", 59)
    rows = [(i, f"p{i} r{i} {' '.join(item)} s{i}") for i in range(15)]
    rows += [(100 + i, f"p{i} r{i} {' '.join(item[:35])} s{i}") for i in range(6)]
    found = leaks(documents(rows), benchmark(spark, [(1, " ".join(item))]), Matching(rare=10)).collect()
    assert {r.doc_id: (r.score, r.seeds) for r in found} == {**dict.fromkeys(range(15), (118, 16)), **dict.fromkeys(range(100, 106), (70, 0))}
    assert without_leaks(documents(rows), benchmark(spark, [(1, " ".join(item))]), Matching(rare=10)).count() == 0


def test_no_alignment_exceeds_what_is_reachable():
    rng = random.Random(6)
    pairs = [([rng.choice("abcdef") for _ in range(rng.randrange(0, 14))], [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 20))]) for _ in range(2000)]
    items, passages = [" ".join(a) for a, _ in pairs], [" ".join(b) for _, b in pairs]
    for m in (Matching(), Matching(mismatch=-3, gap=-2)):
        bound, (score, _) = reachable(items, passages, m), align(items, passages, m)
        assert (bound >= score).all() and (bound < [m.match * len(a) for a, _ in pairs]).mean() > 0.5
    assert reachable(["a b c d"], ["x a b y c d"], Matching()).tolist() == [7]


def test_several_items_and_passages_in_one_long_text(spark, documents):
    a, b = words("a", 20), words("b", 25)
    filler = " ".join(words("f", 600))
    text = f"{filler} {' '.join(a)} {filler} {' '.join(b)} {filler} {' '.join(a)}"
    got = leaks(documents([(1, text)]), benchmark(spark, [(1, " ".join(a)), (2, " ".join(b)), (2, " ".join(b))])).collect()
    assert sorted((r.doc_id, r.item_id, r.score) for r in got) == [(1, 1, 40), (1, 2, 50)]
    assert {r.item_id: r.ends_at for r in got} == {1: 619, 2: 1244}


def test_hard_texts_and_empty_tables(spark, documents):
    items = benchmark(spark, [(1, "word " * 20), (2, "too short"), (None, "no number at all here and some more words")])
    got = sorted((r.doc_id, r.item_id) for r in leaks(documents([*HARD, (9, "no number at all here and some more words")]), items).collect() if r.doc_id != 7)
    assert got == [(9, None)]
    assert {r.item_id for r in leaks(documents(HARD), items).collect() if r.doc_id == 7} == {1}
    assert leaks(documents([]).limit(0), items).count() == 0
    assert leaks(documents(HARD), items.limit(0)).count() == 0
