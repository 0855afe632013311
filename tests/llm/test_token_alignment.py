import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

from cartograin.llm import token_alignment as T
from cartograin.llm.token_counts import byte_symbols

from .conftest import HARD

NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def files():
    return T.Tokenizers.read(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))


def plain(files, texts):
    """Definition, with the two libraries and loops over groups."""
    import sentencepiece
    import tokenizers

    ta = tokenizers.Tokenizer.from_str(files.a)
    ta.encode_special_tokens = True
    tb = sentencepiece.SentencePieceProcessor(model_proto=files.b)
    value = {s: b for b, s in enumerate(byte_symbols())}
    documents = []
    for text in texts:
        a = ta.encode(" " + text, add_special_tokens=False).ids if text else []
        b = tb.encode(text) if text else []
        bytes_a = [bytes(value[c] for c in ta.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(tb.id_to_piece(i)[3:5], 16)]) if tb.is_byte(i) else tb.id_to_piece(i).replace("▁", " ").encode() for i in b]
        raw = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            documents.append([])
            continue
        ends_a, ends_b = (np.cumsum([len(t) for t in x]).tolist() for x in (bytes_a, bytes_b))
        groups, low = [], 0
        for end in sorted(set(ends_a) & set(ends_b)):
            groups.append(tuple([i for i, e in zip(ids, ends) if low < e <= end] for ids, ends in ((a, ends_a), (b, ends_b))))
            low = end
        documents.append(groups)
    links = [Counter((x, y) for left, right in g for x in left for y in right) for g in documents]
    counts = Counter(pair for c in links for pair in c)
    highest = Counter()
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    out = []
    for groups, found in zip(documents, links):
        text = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
        out.append((
            sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(found.values()),
            sum(n for p, n in found.items() if counts[p] == highest[p[0]]), sum(n * counts[p] for p, n in found.items()),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return out


TEXTS = [
    None, "", " ", "a", " two  spaces\n\nand\ttabs ", "<|endoftext|> <s> </s>", "the cat and the cat", "the cat and the cat", "naïve café ﬁ ＡＢ", "日本語の文章 и кириллица",
    "Unbelievable tokenisation of thinwh erorhe", "a▁b", "nul\0byte", "x" * 3000, "é ⅷ 🙂🙃", "​ wide", "1234567 89.01",
]


@pytest.mark.parametrize("fan", [256, 2])
def test_equal_to_the_definition(spark, documents, files, monkeypatch, fan):
    monkeypatch.setattr(T, "FAN", fan)
    monkeypatch.setattr(T, "BLOCK_BYTES", 400)
    rng = np.random.default_rng(5)
    texts = TEXTS + [" ".join(rng.choice(["the", "thing", "erstwh", "ndly", "Anblewh,", "of."], 30)) for _ in range(30)]
    frame = documents([(i, t) for i, t in enumerate(texts)]).repartition(5)
    got = {r.doc_id: tuple(r[n] for n in NAMES) for r in T.token_alignment(frame, files).collect()}
    assert got == dict(enumerate(plain(files, texts)))


def test_hard_texts(spark, documents, files):
    rows = T.token_alignment(documents(HARD), files).collect()
    assert len(rows) == len(HARD)
    assert [r.n_a for r in rows if r.doc_id == 1] == [0] and len({tuple(r) for r in rows if r.doc_id == 7}) == 1
    assert T.token_alignment(documents([]), files).count() == 0


def test_wide_groups_count_by_distinct_ids(files, monkeypatch):
    pair = T._pair(files)
    encoded = [pair.encode(t) for t in TEXTS if t]
    narrow = T.align(pair, encoded)
    monkeypatch.setattr(T, "WIDE_GROUP", 2)
    wide = T.align(pair, encoded)
    assert all((getattr(narrow, f) == getattr(wide, f)).all() for f in ("key", "doc", "times"))
    assert narrow.digest == wide.digest


def test_the_ranked_encoder_gives_the_same_ids(files):
    pair = T._pair(files)
    for text in ["It's  the\n\n 1st café: straße, Ελλάδα!\r\n\tЖизнь", "a" * 500 + " " * 50 + "b", "ひらがな 漢字 x\xa1ɏ"]:
        assert T._SETTLED.fullmatch(text)
        assert pair._fast.encode_ordinary(" " + text) == pair._a.encode(" " + text, add_special_tokens=False).ids
