"""Substring and suffix dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cartograin.llm import repeats
from cartograin.llm.substring_dedup import substring_dedup
from cartograin.llm.suffix_dedup import suffix_dedup

from .conftest import HARD


def marked(sequences, length):
    seen = Counter()
    for s in sequences:
        seen.update(s[i : i + length] for i in range(len(s) - length + 1))
    out = []
    for s in sequences:
        mask = [False] * len(s)
        for i in range(len(s) - length + 1):
            if seen[s[i : i + length]] > 1:
                mask[i : i + length] = [True] * length
        out.append(mask)
    return out


def runs(mask):
    return sum(1 for a, b in zip([False, *mask], mask) if b and not a)


def by_words(rows, length):
    words = [tuple((t or "").encode().split()) for _, t in rows]
    out = []
    for (i, _), w, m in zip(rows, words, marked(words, length)):
        kept = b" ".join(x for x, gone in zip(w, m) if not gone)
        out.append((i, len(w), sum(m), runs(m), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def by_bytes(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (i, _), t, m in zip(rows, texts, marked(texts, length)):
        kept = bytes(x for x, gone in zip(t, m) if not gone)
        out.append((i, len(t), sum(m), runs(m), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(25)]
    shared = [" ".join(rng.choices(vocabulary, k=40)) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randrange(0, 30)))]
        for _ in range(rng.randrange(3)):
            cut = rng.choice(shared).split()
            a = rng.randrange(20)
            parts.append(" ".join(cut[a : a + rng.randrange(5, 40)]))
            parts.append(" ".join(rng.choices(vocabulary, k=rng.randrange(6))))
        rows.append((i, "\n".join(parts)))
    return rows + [(n, "ab " * 50), (n + 1, "a" * 90), (n + 2, rows[0][1]), (n + 2, rows[0][1]), (n + 3, None), (n + 4, "")]


@pytest.mark.parametrize("hot", [5_000, 2])
def test_words(documents, hot):
    rows = corpus(1)
    got = substring_dedup(documents(rows), threshold=9, anchor=4, hot=hot).select("doc_id", "n_words", "n_removed", "n_spans", "kept_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == by_words(rows, 9)


@pytest.mark.parametrize("hot", [5_000, 2])
def test_bytes(documents, hot):
    rows = corpus(2)
    got = suffix_dedup(documents(rows), threshold=30, sample=9, hot=hot).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == by_bytes(rows, 30)


def test_kept_texts_are_returned(documents):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(1, f"start here {passage} end"), (2, f"{passage} other"), (3, "short")]
    got = {r.doc_id: r.kept for r in substring_dedup(documents(rows)).collect()}
    assert got == {1: "start here end", 2: "other", 3: "short"}


def test_hard_texts(documents):
    rows = [r for r in HARD if r[0] != 6] + [(6, "x" * 2_000)]
    got = {(r.doc_id, r.n_words, r.n_removed) for r in substring_dedup(documents(rows)).collect()}
    assert (7, 30_000, 30_000) in got and (1, 0, 0) in got and (6, 1, 0) in got
    got = {(r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup(documents(rows)).collect()}
    assert (6, 2_000, 2_000) in got and (7, 150_000, 150_000) in got and (2, 0, 0) in got


def test_empty_table(documents):
    assert substring_dedup(documents([]).limit(0)).count() == 0
    assert suffix_dedup(documents([]).limit(0)).count() == 0


def test_long_texts_are_cut_into_sections_without_loss(monkeypatch):
    monkeypatch.setattr(repeats, "SECTION", 64)
    rng = random.Random(3)
    text = bytes(rng.choices(b"abc", k=1_000))
    shape = repeats.Windows(20, 6, words=False)
    whole, parts = [], []
    for size, out in ((1 << 20, whole), (64, parts)):
        monkeypatch.setattr(repeats, "SECTION", size)
        for block in repeats.unit_blocks([text], shape):
            found = repeats.find_runs(block.prefix, block.bounds, shape)
            for start, count, anchor in zip(found.start, found.count, found.anchor):
                out += [(int(start) + block.offset + k, int(anchor)) for k in range(count)]
    assert sorted(parts) == sorted(whole) and len(whole) == 981


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(5)
    text = bytes(rng.integers(97, 100, 3_000, dtype=np.uint8))
    shape = repeats.Windows(12, 5, words=False)
    anchors = {}
    for block in repeats.unit_blocks([text], shape):
        found = repeats.find_runs(block.prefix, block.bounds, shape)
        for start, count, anchor in zip(found.start, found.count, found.anchor):
            for k in range(count):
                assert anchors.setdefault(text[start + k : start + k + 12], anchor) == anchor


def test_threshold_and_anchor_must_fit(documents):
    with pytest.raises(ValueError):
        substring_dedup(documents([]), threshold=5, anchor=6)
