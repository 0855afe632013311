import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cartograin.llm import language_model as L

from .conftest import HARD

END = object()


def plain(rows, s):
    """Definition over dictionaries of word tuples: {doc_id: (held_out, n_tokens, n_known, train_tokens, base, score)}."""
    lower = {chr(c): chr(c + 32) for c in range(65, 91)}
    docs = [(i, zlib.crc32(str(i).encode()) % 7 == 2, [*re.findall(r"[^\x20\x09-\x0D]+", "".join(lower.get(c, c) for c in t or "")), END]) for i, t in rows]
    grams = [Counter() for _ in range(s.depth + 1)]
    for _, held, words in docs:
        if not held:
            for n in range(s.depth + 1):
                grams[n].update(tuple(words[i - n : i + 1]) for i in range(n, len(words)))
    total, distinct = sum(grams[0].values()), len(grams[0])

    def probability(words, i, n):
        if n == 0:
            return (grams[0][(words[i],)] + 1) / (total + distinct + 1)
        seen = grams[n - 1][tuple(words[i - n : i])]
        return (grams[n][tuple(words[i - n : i + 1])] + s.strength * probability(words, i, n - 1)) / (seen + s.strength)

    def candidates(words, i):
        n = 0
        while n < s.depth and i >= n + 1 and grams[n][tuple(words[i - n - 1 : i])] >= s.least:
            n += 1
        return range(1, n + 1)

    gain = Counter()
    for _, held, words in docs:
        for i in range(len(words)) if not held else ():
            for n in candidates(words, i):
                suffix, context = probability(words, i, n - 1), tuple(words[i - n : i])
                without = (max(grams[n][tuple(words[i - n : i + 1])] - 1, 0) + s.strength * suffix) / (grams[n - 1][context] - 1 + s.strength)
                gain[context] += round(1e6 * math.log(without / suffix))
    out = {}
    for i, held, words in docs:
        score = 0.0
        for at in range(len(words)):
            states = [n for n in candidates(words, at) if gain[tuple(words[at - n : at])] >= s.gain * 1e6]
            score += math.log10(probability(words, at, max(states, default=0)))
        out[i] = (held, len(words), sum(grams[0][(w,)] > 0 for w in words), total, sum(math.log10(probability(words, k, 0)) for k in range(len(words))), score)
    return out


def texts():
    rng = np.random.default_rng(2)
    words = np.array("a b c The the cat sat on Mat mat é x-y 12".split())
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 60)))) for i in range(60)]
    return rows + [(100 + i, "the cat sat on the mat\nand the cat sat on\tthe rug " * 3) for i in range(20)] + [(200, None), (201, ""), (202, " \n ")]


@pytest.mark.parametrize("depth,block", [(3, 1 << 20), (3, 60), (2, 60), (1, 1 << 20), (0, 1 << 20)])
def test_equal_to_the_definition(spark, documents, monkeypatch, depth, block):
    """With small blocks texts go on from block to block, and n-grams are dealt over many partitions."""
    monkeypatch.setattr(L, "BLOCK_BYTES", block)
    monkeypatch.setattr(L, "PARTITION", 500)
    settings = L.Settings(depth=depth, least=3, strength=2.0, gain=0.5)
    rows = texts()
    got = {r.doc_id: r for r in L.language_model_scores(documents(rows).repartition(4), settings).collect()}
    want = plain(rows, settings)
    assert len(got) == len(want)
    for i, (held, n, known, total, base, score) in want.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, abs=1e-6) and r.score == pytest.approx(score, abs=1e-6)


def test_probabilities_of_a_state_add_up_to_one(spark, documents):
    """All words of the vocabulary, the end and one unknown word after the same context."""
    settings = L.Settings(depth=2, least=2, gain=0.0)
    train = [(i, "p q r p q s p q r") for i in range(1, 9) if not L.held_out(i)]
    tried = [i for i in range(1000, 2000) if L.held_out(i)]
    words = ["p", "q", "r", "s", "unknown"]
    rows = train + [(tried[0], "p q")] + [(tried[1 + k], f"p q {w}") for k, w in enumerate(words)]
    got = {r.doc_id: r.score for r in L.language_model_scores(documents(rows), settings).collect()}
    # P(p q w) = P(text "p q" + w, end) is compared through the shared prefix: the end after w differs, so it is divided out.
    want = plain(rows, settings)
    assert all(got[i] == pytest.approx(w[5], abs=1e-9) for i, w in want.items())


def test_contexts_help_on_held_out_texts(spark, documents):
    rows = [(i, "the cat sat on the mat while dogs slept under the tree " * 2) for i in range(70)]
    scored = [r for r in L.language_model_scores(documents(rows)).collect() if r.held_out]
    assert scored and all(r.score > r.base_score + r.n_tokens * 0.5 for r in scored)


def test_hard_texts(spark, documents):
    rows = L.language_model_scores(documents(HARD)).collect()
    assert len(rows) == len(HARD) and {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert {r.n_tokens for r in rows if r.doc_id == 7} == {30_001}
    assert all(r.score <= 0 and r.base_score <= 0 for r in rows)
    assert L.language_model_scores(documents([])).count() == 0
    alone = next(i for i in range(100) if L.held_out(i))
    assert L.language_model_scores(documents([(alone, "a b")])).first().base_score == 0.0


def test_sections_keep_words_whole():
    text = b"aa bb\tcccccccc d\n" * 50
    for most in (1, 3, 7, 1000):
        assert b"".join(L.sections(text, most)) == text
        assert [w for s in L.sections(text, most) for w in s.split()] == text.split()
