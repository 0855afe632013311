"""Benchmark decontamination: shared n-grams, then Smith-Waterman alignment.

N-grams of the test items are looked for in every training text; around hits a passage is
cut out. Every n-gram, however frequent, joins passages to items; each pair that can reach
the score is aligned word by word, so edited and paraphrased copies score as well.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import lexing
from .common import row_key, staged

_PUNCTUATION = bytes(32 if chr(b) in string.punctuation else b for b in range(256))


@dataclass(frozen=True)
class Matching:
    """``n`` words per n-gram. A pair is a leak when its alignment reaches ``percent`` of the item's own score and
    ``min_words`` words (or all of a shorter item). ``rare`` and ``always`` only say which n-grams the result counts
    as seeds: those that at most ``rare`` passages hold, and the ``always`` rarest of each item."""

    n: int = 3
    rare: int = 1_000
    always: int = 16
    percent: int = 50
    min_words: int = 8
    match: int = 2
    mismatch: int = -1
    gap: int = -1
    filter_bits: int = 26


def normal(text: bytes) -> bytes:
    """Lower case, ASCII punctuation as spaces."""
    return text.decode().lower().encode().translate(_PUNCTUATION)


def _grams(texts: list[bytes], n: int) -> tuple[lexing.Pieces, np.ndarray, np.ndarray, np.ndarray]:
    """Words, and first word, text and hash of every n-gram."""
    data, bounds = lexing.layout(texts)
    word = lexing.words(data, bounds)
    hashed, whole = lexing.windows(word, n)
    at = np.flatnonzero(whole)
    return word, at, word.text[at], hashed[at]


_ITEMS = "item bigint, item_id bigint, n_words int, words string, grams array<bigint>"


def _item_rows(n: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [normal(t) for t in lexing.encoded(batch.column("text"))]
            _, _, text, hashed = _grams(texts, n)
            grams = [np.unique(hashed[text == i]).view(np.int64) for i in range(len(texts))]
            words = [b" ".join(t.split()).decode() for t in texts]
            counts = [len(t.split()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), batch.column("item_id"), pa.array(counts, pa.int32()), pa.array(words, pa.string()), pa.array(grams, pa.list_(pa.int64()))],
                names=["item", "item_id", "n_words", "words", "grams"],
            )

    return rows


_PASSAGES = "doc_id bigint, key struct<a:bigint,b:int>, at int, words string, grams array<bigint>"


def _passage_rows(n: int, reach: int, marks: bytes, bits: int):
    """Passages around n-grams whose filter bit is set: from ``reach`` words before to ``reach`` after, joined where they meet."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(np.frombuffer(marks, np.uint8))
        shift = np.uint64(64 - bits)
        for batch in batches:
            texts = lexing.encoded(batch.column("text"))
            for begin, end in lexing.blocks(texts):
                part = [normal(t) for t in texts[begin:end]]
                word, first, text, hashed = _grams(part, n)
                hit = np.flatnonzero(marked[(hashed >> shift).astype(np.int64)])
                if not len(hit):
                    continue
                first, text, hashed = first[hit], text[hit], hashed[hit]
                new = np.ones(len(hit), bool)
                new[1:] = (text[1:] != text[:-1]) | (first[1:] > first[:-1] + n + 2 * reach)
                heads = np.flatnonzero(new)
                tails = np.append(heads[1:], len(hit)) - 1
                edges = np.searchsorted(word.text, np.arange(end - begin + 1))
                data = b"".join(part)
                origin, at, words, grams = [], [], [], []
                for h, t in zip(heads, tails):
                    i = text[h]
                    lo, hi = max(edges[i], first[h] - reach), min(edges[i + 1], first[t] + n + reach)
                    origin.append(begin + i)
                    at.append(lo - edges[i])
                    words.append(b" ".join(data[word.start[lo] : word.end[hi - 1]].split()).decode())
                    grams.append(np.unique(hashed[h : t + 1]).view(np.int64))
                taken = batch.take(pa.array(origin, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [taken.column("doc_id"), taken.column("key"), pa.array(at, pa.int32()), pa.array(words, pa.string()), pa.array(grams, pa.list_(pa.int64()))],
                    names=["doc_id", "key", "at", "words", "grams"],
                )

    return rows


def align(items: list[str], passages: list[str], matching: Matching) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman over words: best local score of each pair, and where in the passage it ends.

    All pairs advance together, one item word at a time; a row of the matrix is one
    vector operation, with gaps along it by a running maximum.
    """
    number: dict[str, int] = {}
    left = [[number.setdefault(w, len(number)) for w in t.split()] for t in items]
    right = [[number.setdefault(w, len(number)) for w in t.split()] for t in passages]
    rows, width = len(items), max(map(len, right), default=0)
    a = np.full((rows, max(map(len, left), default=0)), -1, np.int32)
    b = np.full((rows, width), -2, np.int32)
    for i in range(rows):
        a[i, : len(left[i])] = left[i]
        b[i, : len(right[i])] = right[i]
    slope = -matching.gap * np.arange(width, dtype=np.int32)
    above = np.zeros((rows, width), np.int32)
    best, place = np.zeros(rows, np.int32), np.zeros(rows, np.int32)
    for k in range(a.shape[1]):
        diagonal = np.zeros_like(above)
        diagonal[:, 1:] = above[:, :-1]
        step = diagonal + np.where(b == a[:, k, None], np.int32(matching.match), np.int32(matching.mismatch))
        row = np.maximum(np.maximum(step, above + matching.gap), 0)
        above = np.maximum.accumulate(row + slope, axis=1) - slope
        top = above.argmax(axis=1)
        score = above[np.arange(rows), top]
        place = np.where(score > best, top, place)
        best = np.maximum(best, score)
    return best, place


def reachable(items: list[str], passages: list[str], matching: Matching) -> np.ndarray:
    """For each pair a score that its alignment cannot exceed, without the alignment.

    An item word can match only if the passage holds it, an item word left out costs an
    error, and so do two successive matches whose words are nowhere neighbours in the passage.
    """
    number: dict[str, int] = {}
    left = [[number.setdefault(w, len(number)) for w in t.split()] for t in items]
    right = [[number.setdefault(w, len(number)) for w in t.split()] for t in passages]
    rows, size = len(items), max(len(number), 1)
    a = np.full((rows, max(map(len, left), default=0)), -1, np.int64)
    for i in range(rows):
        a[i, : len(left[i])] = left[i]
    pair = np.repeat(np.arange(rows), [len(r) for r in right])
    word = pair * size + np.array([w for r in right for w in r], np.int64)
    near = np.flatnonzero(pair[1:] == pair[:-1])
    held = np.isin(np.arange(rows)[:, None] * size + a, word) & (a >= 0)
    next_to = np.zeros_like(held)
    couples = word[near] * size + word[near + 1] % size
    next_to[:, 1:] = np.isin((np.arange(rows)[:, None] * size + a[:, :-1]) * size + a[:, 1:], couples)
    error = max(0, -max(matching.mismatch, matching.gap))
    # Best up to the last item word: if it matched, and if it was left out.
    matched, passed, best = np.zeros((3, rows), np.int64)
    for k in range(a.shape[1]):
        on = np.maximum(matched - np.where(next_to[:, k], 0, error), passed)
        passed = np.maximum(np.maximum(matched, passed) - error, 0)
        matched = np.where(held[:, k], matching.match + np.maximum(on, 0), 0)
        best = np.maximum(best, matched)
    return best


_SCORED = "doc_id bigint, key struct<a:bigint,b:int>, item_id bigint, item_words int, score int, ends_at int, seeds bigint"
#: Cells of the alignment matrices held at once.
CELLS = 1 << 21


def _aligned_rows(matching: Matching):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, passages = batch.column("item_text").to_pylist(), batch.column("words").to_pylist()
            full = batch.column("item_words").to_numpy()
            needed = np.maximum(np.minimum(matching.min_words, full) * matching.match, 1)

            def leak(score: np.ndarray, rows: np.ndarray) -> np.ndarray:
                return (score * 100 >= matching.percent * matching.match * full[rows]) & (score >= needed[rows])

            widths = np.array([p.count(" ") + 1 for p in passages])
            order = np.argsort(widths, kind="stable")
            begin = 0
            while begin < len(order):
                end = begin + 1
                while end < len(order) and widths[order[end]] * (end + 1 - begin) <= CELLS:
                    end += 1
                chosen = order[begin:end]
                begin = end
                chosen = chosen[leak(reachable([items[i] for i in chosen], [passages[i] for i in chosen], matching), chosen)]
                if not len(chosen):
                    continue
                score, ends = align([items[i] for i in chosen], [passages[i] for i in chosen], matching)
                part = batch.take(pa.array(chosen))
                ends_at = part.column("at").to_numpy() + ends
                out = pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("doc_id", "key", "item_id", "item_words")] + [pa.array(score, pa.int32()), pa.array(ends_at, pa.int32()), part.column("seeds")],
                    names=["doc_id", "key", "item_id", "item_words", "score", "ends_at", "seeds"],
                )
                yield out.filter(pa.array(leak(score, chosen)))

    return rows


def leaks(documents: DataFrame, benchmark: DataFrame, matching: Matching = Matching()) -> DataFrame:
    """One row per document row and item it leaks: doc_id, key, item_id, item_words, score, ends_at, seeds.

    ``score`` is the best alignment of the item with a passage of the document (``match``
    per word at most), ``ends_at`` the word at which it ends, ``seeds`` the seeds in that
    passage, 0 if it shares frequent n-grams only. Null texts hold nothing; items without ``n`` words in a row have no seeds and
    are not looked for; repeated rows give repeated results; repeated items are items of
    their own; other columns are not read.

    The filter on n-grams is a bit table of fixed size; it only spares work, and joins on
    the n-grams themselves decide. A pair that shares one n-gram is aligned at any corpus
    size, unless the words it shares cannot reach the score (``reachable``).
    """
    numbered = benchmark.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    items = staged(numbered.mapInArrow(_item_rows(matching.n), _ITEMS), "leak-items")
    grams = items.select("item", F.explode("grams").alias("gram"))
    # At most 2^filter_bits distinct positions, whatever the benchmark's size.
    positions = grams.select(F.shiftrightunsigned("gram", 64 - matching.filter_bits).alias("p")).distinct()
    marks = np.zeros(1 << matching.filter_bits, bool)
    for row in positions.toLocalIterator():
        marks[row.p] = True
    reach = int((items.agg(F.max("n_words")).first()[0] or 0) * 1.25) + matching.n
    source = documents.select("doc_id", row_key("doc_id", "text").alias("key"), "text")
    search = _passage_rows(matching.n, reach, np.packbits(marks).tobytes(), matching.filter_bits)
    passages = source.mapInArrow(search, _PASSAGES).withColumn("passage", F.monotonically_increasing_id())
    passages = staged(passages, "leak-passages")

    found = passages.select("passage", F.explode("grams").alias("gram"))
    often = found.groupBy("gram").agg(F.count(F.lit(1)).alias("passages"))
    known = grams.join(often, "gram")
    place = F.row_number().over(Window.partitionBy("item").orderBy("passages", "gram"))
    seed = ((F.col("passages") <= matching.rare) | (F.col("place") <= matching.always)).cast("bigint")
    shared = known.withColumn("place", place).select("item", "gram", seed.alias("seed"))
    pairs = found.join(shared, "gram").groupBy("passage", "item").agg(F.sum("seed").alias("seeds"))
    texts = items.select("item", "item_id", F.col("n_words").alias("item_words"), F.col("words").alias("item_text"))
    read = pairs.join(texts, "item").join(passages.select("passage", "doc_id", "key", "at", "words"), "passage")
    scored = read.select("doc_id", "key", "item_id", "item", "item_words", "item_text", "at", "words", "seeds", "passage")
    scored = scored.drop("item", "passage").mapInArrow(_aligned_rows(matching), _SCORED)
    best = F.max(F.struct("score", "seeds", (-F.col("ends_at")).alias("e"))).alias("best")
    return scored.groupBy("doc_id", "key", "item_id", "item_words").agg(best).select(
        "doc_id", "key", "item_id", "item_words", F.col("best.score").alias("score"), (-F.col("best.e")).alias("ends_at"), F.col("best.seeds").alias("seeds")
    )


def without_leaks(documents: DataFrame, benchmark: DataFrame, matching: Matching = Matching()) -> DataFrame:
    """The rows of ``documents`` that leak no item, columns unchanged."""
    found = leaks(documents, benchmark, matching).select(F.col("key").alias("_leak_key")).distinct()
    return documents.withColumn("_leak_key", row_key("doc_id", "text")).join(found, "_leak_key", "left_anti").select(*documents.columns)
