import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cartograin.llm.token_counts import PieceCounts, Vocabulary, token_counts

from .conftest import HARD

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def counts():
    return PieceCounts(Vocabulary.read(PATH))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def size(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_random_texts(counts, library):
    rng = random.Random(8)
    parts = ["the", " a", "  ", "\n", "é", "<|endoftext|>", "'s", " 12", "　", "x" * 9, "!!", "\U0001f600", "\t", "\x1c", " Ǆ", "٣", "́", "a'LL"]
    for _ in range(2_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(40)))
        assert counts.count(text) == size(library, text), repr(text)


def test_every_character_class(counts, library):
    for code in [*range(0x3100), *range(0xA000, 0xB000), *range(0x1F300, 0x1F400)]:
        text = f"a{chr(code)}b 1{chr(code)} {chr(code)}{chr(code)}!"
        assert counts.count(text) == size(library, text), hex(code)


def test_long_pieces(counts, library):
    rng = random.Random(9)
    for text in ("a" * 20_000, "".join(rng.choices("abcde", k=20_000)), " " * 5_000 + "x", "é" * 3_000):
        assert counts.count(text) == size(library, text)


def test_memory_is_bounded(monkeypatch, library):
    monkeypatch.setattr("cartograin.llm.token_counts.MEMO", 3)
    counts = PieceCounts(Vocabulary.read(PATH))
    text = "one two three four five six seven one two three"
    assert counts.count(text) == size(library, text) and len(counts) == 3


def test_documents(documents, library):
    got = token_counts(documents(HARD), Vocabulary.read(PATH), limit=100).collect()
    want = [(i, len((t or "").encode()), size(library, t or "")) for i, t in HARD]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == sorted(want, key=str)
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)
    assert token_counts(documents([]).limit(0), Vocabulary.read(PATH)).count() == 0


def test_very_long_texts_take_the_same_path_piece_by_piece(monkeypatch, counts, library):
    monkeypatch.setattr("cartograin.llm.token_counts.LONG_TEXT", 10)
    text = "some words, more words <|endoftext|> and the rest"
    assert counts.count(text) == size(library, text)
