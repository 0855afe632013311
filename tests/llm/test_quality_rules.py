from cartograin.llm.quality_rules import Limits, cleaned, frequent_lines, features, quality_rules, without_rejected

from .conftest import HARD


def letters(i):
    return "".join(chr(ord("a") + int(d)) for d in str(i))


def prose(i, n=40):
    """Words of their own for every i; digits would be folded."""
    return " ".join(f"d{letters(i)}w{letters(j)}" for j in range(n))


def verdicts(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_base_measures(documents):
    text = "a#b $x <y>\nsame line\nsame line\n\n  \n" + "one two three four five six seven eight " * 2
    r = verdicts(quality_rules(documents([(1, text)])))[1]
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (23, 3 + 2 + 3 + 16 + 64, 4, 1, 16)
    assert r.base_failed and not r.kept


def test_lines_above_the_limits_are_removed_and_depleted_documents_go(documents):
    menu = "Home | About | Contact us now today please friend"
    rows = [(i, f"{prose(i)}\n{menu}", "a") for i in range(30)]
    rows += [(100 + i, f"{menu.upper()}!\n{menu} \nfew d{i} words x1 x2 x3 x4 x5 x6 x7 x8", "a") for i in range(3)]
    rows += [(200 + i, prose(200 + i), "a") for i in range(20)] + [(300, f"{prose(300)}\n{menu}", "b")]
    got = verdicts(quality_rules(documents(rows)))
    assert all(got[i].kept and got[i].n_removed_words == 10 for i in range(30))
    assert all(not got[100 + i].kept and not got[100 + i].base_failed and got[100 + i].n_removed_words == 20 for i in range(3))
    assert got[300].kept and got[300].n_removed_words == 0
    kept = without_rejected(documents(rows))
    assert kept.columns == documents(rows).columns and kept.count() == 51


def test_cleaned_texts_hold_no_line_above_the_limits(documents):
    menu = "Home | About | Contact us now today please friend"
    rows = [(i, f"{menu.upper()}!\n{prose(i)}\n\n {menu}\nÉnd {letters(i)} x", "a") for i in range(30)]
    rows += [(50, f"{menu}\n{prose(50)}", "b"), (51, prose(51), "a"), (51, prose(51), "a"), (52, f"{menu}\nfew words", "a"), (53, None, "a")]
    rows += [(54, f"{prose(54)}\n{menu}\n", None)]
    docs = documents(rows)
    got, said = cleaned(docs), verdicts(quality_rules(docs))
    assert got.columns == docs.columns
    texts = sorted((r.doc_id, r.text) for r in got.collect())
    assert texts == sorted([(i, f"{prose(i)}\n\nÉnd {letters(i)} x") for i in range(30)] + [(r[0], r[1]) for r in rows[30:33]] + [rows[-1][:2]])
    assert all(len(t.split()) == said[i].n_words - said[i].n_removed_words for i, t in texts)
    assert cleaned(docs.limit(0)).count() == 0


def test_exact_copies_count_once(documents):
    rows = [(i, prose(0), "a") for i in range(50)]
    assert all(r.kept for r in quality_rules(documents(rows)).collect())


def test_the_number_of_documents_decides_whatever_the_host(documents):
    rows = [(i, f"{prose(i)}\na common line", "a") for i in range(11)] + [(50 + i, prose(50 + i), "a") for i in range(120)]
    measured = features(documents(rows))
    assert [r.documents for r in frequent_lines(measured).collect()] == [11]
    assert frequent_lines(measured, Limits(line_documents=11)).count() == 0
    assert frequent_lines(measured, Limits(line_percent=10)).count() == 0


def test_hard_texts_and_null_hosts(documents):
    rows = [(i, t, None) for i, t in HARD] + [(20, prose(20), None)]
    got = quality_rules(documents(rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].n_words == 0 and by_id[1].base_failed and by_id[20].kept
    assert [r.n_repeat_words for r in got if r.doc_id == 7] == [30_000] * 2 and by_id[6].word_chars == 200_000
    assert by_id[None].n_words == 5 and by_id[5].word_chars == 21
    assert quality_rules(documents([]).limit(0)).count() == 0
