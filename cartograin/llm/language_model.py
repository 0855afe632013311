"""Scores of texts by a probabilistic suffix tree over words.

A context (the last one to ``depth`` words) enters the tree when its next-word distribution
diverges from that of its suffix, judged by the gain in log-likelihood on its own occurrences,
each left out in turn. Distributions are smoothed towards the suffix's, down to single words,
and a word is predicted from the longest suffix of its past that is a state of the tree.

Occurrences stay in blocks of documents. A block sends each of its n-grams once, with its
number of training occurrences, to a partition of the n-gram's hash; totals go back to the
block in the order of its n-grams. Contexts too rare to enter the tree are not extended, so
each further length of context moves less.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lexing
from .common import staged
from .runs import first_of, pack, pack_sorted, ranges, unpack, unpack_sorted

#: Text bytes in a block, bytes lexed at once, and n-grams (about) that one partition adds up.
BLOCK_BYTES, LEXED, PARTITION = 8 << 20, 1 << 20, 3_000_000
#: The symbol after the last word; any odd constant serves.
END = np.uint64(0x5851F42D4C957F2D)
#: Gains are added up as whole millionths, so that their sum does not depend on the order.
GAIN_UNIT = 1e6
#: Rounds of gains are numbered after the lengths of n-grams.
GAINS = 1000


@dataclass(frozen=True)
class Settings:
    """Longest context; training occurrences a context needs; weight of the suffix's
    distribution, as a number of words; log-likelihood (nats) a context has to gain."""

    depth: int = 3
    least: int = 20
    strength: float = 100.0
    gain: float = 3.0


def held_out(doc_id: int | None) -> bool:
    """Whether a document is kept out of training; a null id counts as an empty one."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def sections(text: bytes, most: int) -> Iterator[bytes]:
    """The text cut at white space into parts of about ``most`` bytes (a longer word stays whole)."""
    low = 0
    while len(text) - low > most:
        high = low + most
        while high < len(text) and text[high] not in b" \t\n\v\f\r":
            high += 1
        yield text[low:high]
        low = high
    yield text[low:]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of the texts, and the text of each."""
    hashes, owner = [], []
    for low, high in lexing.blocks(texts, LEXED):
        found = lexing.words(*lexing.layout(texts[low:high]), lower=True)
        hashes.append(found.hash)
        owner.append(found.text + low)
    return np.concatenate(hashes), np.concatenate(owner)


def _combined(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return lexing.mix(before * np.uint64(0x9E3779B97F4A7C15) + word)


# --- blocks -------------------------------------------------------------------


FIELDS = ("uid", "held", "lead", "length", "words", "tokens")
BLOCKS = "block bigint, doc_id array<{kind}>, uid array<bigint>, " + ", ".join(f"{f} binary" for f in FIELDS[1:]) + ", n_train bigint, n_tokens bigint"


def _blocks(documents: DataFrame, depth: int) -> DataFrame:
    """Documents in blocks: a dictionary of word hashes and the words as places in it.

    A text longer than a block goes on in the next one, with its last ``depth`` words
    repeated in front as context.
    """
    kind = dict(documents.dtypes)["doc_id"]

    def written(number: int, pieces: list[tuple], id_type: pa.DataType) -> tuple[pa.RecordBatch, np.ndarray]:
        """``pieces``: (uid, doc_id, held, text, leading hashes, last piece of its document)."""
        hashes, owner = word_hashes([p[3] for p in pieces])
        count = np.bincount(owner, minlength=len(pieces))
        lead = np.array([len(p[4]) for p in pieces], np.int64)
        closing = np.array([p[5] for p in pieces], np.int64)
        length = lead + count + closing
        begin = np.cumsum(length) - length
        tokens = np.full(int(length.sum()), END, np.uint64)
        tokens[ranges(begin, lead)] = np.concatenate([np.zeros(0, np.uint64), *[p[4] for p in pieces]])
        tokens[ranges(begin + lead, count)] = hashes
        words, place, times = np.unique(tokens, return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")
        rank = np.empty(len(order), np.uint64)
        rank[order] = np.arange(len(order), dtype=np.uint64)
        held = np.array([p[2] for p in pieces], bool)
        scored = count + closing
        columns = [
            pa.array([number]),
            pa.array([[p[1] for p in pieces]], pa.list_(id_type)),
            pa.array([[p[0] for p in pieces]], pa.list_(pa.int64())),
            *[pa.array([pack(v)], pa.binary()) for v in (held.astype(np.uint64), lead.astype(np.uint64), length.astype(np.uint64), words[order], rank[place])],
            pa.array([int(scored[~held].sum())]),
            pa.array([int(scored.sum())]),
        ]
        names = ["block", "doc_id", *FIELDS, "n_train", "n_tokens"]
        return pa.RecordBatch.from_arrays(columns, names), tokens[-depth:] if depth and not pieces[-1][5] else tokens[:0]

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        uid, pieces, size, id_type = number, [], 0, pa.int64()
        none = np.zeros(0, np.uint64)
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                raw = text.cast(pa.binary()).as_py() or b""
                parts, lead = list(sections(raw, BLOCK_BYTES)), none
                for k, part in enumerate(parts):
                    if pieces and size + len(part) > BLOCK_BYTES:
                        row, lead = written(number, pieces, id_type)
                        yield row
                        number, pieces, size = number + 1, [], 0
                    pieces.append((uid, doc_id, held_out(doc_id), part, lead if k else none, k == len(parts) - 1))
                    size += len(part)
                uid += 1
        if pieces:
            yield written(number, pieces, id_type)[0]

    return staged(documents.select("doc_id", "text").mapInArrow(built, BLOCKS.format(kind=kind)), "lm-blocks")


class Block:
    """A block's tokens with what is known of their n-grams so far."""

    def __init__(self, row: dict, returned: dict[int, np.ndarray], settings: Settings):
        """``returned``: per round the totals of this block's n-grams, in ascending order of their hashes."""
        self.settings, self.returned = settings, returned
        self.held, self.lead, self.length = (unpack(row[f]).astype(np.int64) for f in ("held", "lead", "length"))
        words = unpack(row["words"]).astype(np.uint64)
        self.word = words[unpack(row["tokens"]).astype(np.int64)]
        self.piece = np.repeat(np.arange(len(self.length)), self.length)
        self.place = ranges(np.zeros_like(self.length), self.length)
        self.scored = self.place >= self.lead[self.piece]
        self.train = self.scored & (self.held[self.piece] == 0)
        self.gram = [self.word]
        self.count: list[np.ndarray] = []

    def _extend(self, n: int) -> None:
        while len(self.gram) <= n:
            longer = np.zeros_like(self.word)
            longer[1:] = _combined(self.gram[-1][:-1], self.word[1:])
            self.gram.append(longer)

    def _totals(self, kind: int) -> np.ndarray:
        """A block without n-grams of a length has no totals of it."""
        return self.returned.get(kind, np.zeros(0, np.int64))

    def _within(self, n: int) -> np.ndarray:
        """Tokens with a context of n words that is frequent enough to be counted."""
        ready = np.flatnonzero(self.place >= n)
        if n >= 2:
            ready = ready[self.count[n - 1][ready - 1] >= self.settings.least]
        return ready

    def entries(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The block's n-grams (n + 1 words), ascending, and how often training holds them."""
        self._extend(n)
        at = self._within(n)
        grams, which = np.unique(self.gram[n][at], return_inverse=True)
        return grams, np.bincount(which, weights=self.train[at], minlength=len(grams)).astype(np.int64)

    def learn(self, n: int) -> None:
        """Give every token the total of its n-gram."""
        self._extend(n)
        at = self._within(n)
        _, which = np.unique(self.gram[n][at], return_inverse=True)
        count = np.zeros(len(self.word), np.int64)
        count[at] = self._totals(n)[which]
        self.count.append(count)

    def contexts(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens whose context of n words may be a state, and the context's occurrences."""
        at = self._within(n)
        seen = self.count[n - 1][at - 1]
        frequent = seen >= self.settings.least
        return at[frequent], seen[frequent]

    def predicted(self, total: int, distinct: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per length of context: (n, tokens, context's occurrences, P by the suffix, P by the context)."""
        p = (self.count[0] + 1) / (total + distinct + 1)
        yield 0, np.arange(len(p)), np.zeros(0), p, p
        strength = self.settings.strength
        for n in range(1, len(self.count)):
            at, seen = self.contexts(n)
            suffix = p[at]
            p = p.copy()
            p[at] = (self.count[n][at] + strength * suffix) / (seen + strength)
            yield n, at, seen, suffix, p[at]

    def gains(self, total: int, distinct: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per length: contexts, ascending, and what each gains here over its suffix, an occurrence left out at a time."""
        strength = self.settings.strength
        for n, at, seen, suffix, _ in self.predicted(total, distinct):
            if n:
                contexts, which = np.unique(self.gram[n - 1][at - 1], return_inverse=True)
                own = self.train[at]
                without = (np.maximum(self.count[n][at] - 1, 0) + strength * suffix) / (np.maximum(seen - 1, 0) + strength)
                gain = np.where(own, np.rint(GAIN_UNIT * np.log(without / suffix)), 0)
                yield n, contexts, np.bincount(which, weights=gain, minlength=len(contexts)).astype(np.int64)

    def scores(self, total: int, distinct: int) -> dict[str, np.ndarray]:
        """Sums per piece: tokens, known tokens, base and score."""
        best = np.zeros(0)
        for n, at, _, _, p in self.predicted(total, distinct):
            if n == 0:
                base, best = p, p.copy()
            else:
                _, which = np.unique(self.gram[n - 1][at - 1], return_inverse=True)
                state = self._totals(GAINS + n)[which] >= self.settings.gain * GAIN_UNIT
                best[at[state]] = p[state]

        def summed(values: np.ndarray) -> np.ndarray:
            return np.bincount(self.piece[self.scored], weights=values[self.scored], minlength=len(self.length))

        return {
            "n_tokens": summed(np.ones(len(self.word))).astype(np.int64),
            "n_known": summed(self.count[0] > 0).astype(np.int64),
            "base_score": summed(np.log10(base)),
            "score": summed(np.log10(best)),
        }


def _read(blocks: pa.Table, returned: pa.Table | None, settings: Settings, known: int) -> Iterator[tuple[dict, Block]]:
    """The blocks of a table with their totals; the first ``known`` lengths of n-grams are already learned."""
    names = [n for n in ("block", "doc_id", *FIELDS) if n in blocks.schema.names]
    for number in range(blocks.num_rows):
        row = {n: blocks.column(n)[number] if n in ("doc_id", "uid") else blocks.column(n)[number].as_py() for n in names}
        totals: dict[int, list] = {}
        if returned is not None:
            found = zip(*(returned.column(c).to_pylist() for c in ("round", "radix", "totals")))
            for kind, _, blob in sorted(found):
                totals.setdefault(kind, []).append(unpack(blob))
        block = Block(row, {k: np.concatenate(v).astype(np.int64) for k, v in totals.items()}, settings)
        for n in range(known):
            block.learn(n)
        yield row, block


# --- totals ----------------------------------------------------------------------


ENTRIES = "round int, radix int, block bigint, grams binary, amounts binary"
TOTALS = "round int, radix int, block bigint, totals binary, known bigint"


def _sent(kind: int, radix: int, block: int, grams: np.ndarray, amounts: np.ndarray) -> Iterator[tuple]:
    """Entries cut into ``radix`` ranges of the hash."""
    part = ((grams >> np.uint64(32)) * np.uint64(radix) >> np.uint64(32)).astype(np.int64)
    cuts = np.append(first_of(part), len(part))
    for low, high in zip(cuts[:-1], cuts[1:]):
        signed = amounts[low:high]
        yield kind, int(part[low]), block, pack_sorted(grams[low:high]), pack(signed if kind >= GAINS else signed.astype(np.uint64))


def _entries(rows: Iterator[tuple]) -> pa.Table:
    types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) or [()] * 5
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("round", "radix", "block", "grams", "amounts"), columns, types)})


def _total(table: pa.Table) -> pa.Table:
    """Add up the entries of a partition; every block gets the totals of its own."""
    grams = [unpack_sorted(g.as_py()) for g in table.column("grams")]
    distinct, which = np.unique(np.concatenate(grams), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, which, np.concatenate([unpack(a.as_py()).astype(np.int64) for a in table.column("amounts")]))
    signed = table.column("round")[0].as_py() >= GAINS
    bounds = np.concatenate([[0], np.cumsum([len(g) for g in grams])])
    own = [total[which[low:high]] for low, high in zip(bounds[:-1], bounds[1:])]
    return pa.table({
        "round": table.column("round"), "radix": table.column("radix"), "block": table.column("block"),
        "totals": pa.array([pack(t if signed else t.astype(np.uint64)) for t in own], pa.binary()),
        "known": pa.array([int((total > 0).sum())] * len(own), pa.int64()),
    })


def _totals(entries: DataFrame) -> DataFrame:
    return staged(entries.groupBy("round", "radix").applyInArrow(_total, TOTALS), "lm-totals")


# --- model -------------------------------------------------------------------------


def language_model_scores(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per document row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Documents for whose id ``held_out`` holds are scored but not learned from. A text's
    tokens are its lower-cased words and one end; null and empty texts have the end alone.
    ``base_score`` is the log10 probability by single words (add one, with room for one
    unknown word), ``score`` the one by the suffix tree; contexts do not reach beyond a text.
    Rows with the same doc_id, or none, are documents of their own, and repeated texts
    count each time. An empty table gives an empty result, a table without training rows
    equal probabilities. Other columns are not read; texts of any length are read in
    sections.

    The whole corpus is counted, and the number of contexts is not limited. Words and
    contexts are told apart by 64-bit hashes.
    """
    depth = settings.depth
    blocks = _blocks(documents, depth)
    sums = blocks.agg(F.sum("n_train").alias("train"), F.sum("n_tokens").alias("tokens")).first()
    train_tokens, radix = sums.train or 0, max(1, -(-(sums.tokens or 0) // PARTITION))
    kind = dict(documents.dtypes)["doc_id"]

    def first_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, block in _read(pa.Table.from_batches([batch]), None, settings, 0):
                for n in range(min(depth, 1) + 1):
                    yield from _entries(_sent(n, radix, row["block"], *block.entries(n))).to_batches()

    returned = _totals(blocks.drop("doc_id", "uid").mapInArrow(first_counts, ENTRIES))
    distinct = returned.filter("round = 0").groupBy("radix").agg(F.max("known").alias("known")).agg(F.sum("known")).first()[0] or 0

    def again(function, schema: str, columns: list[str]) -> DataFrame:
        left = blocks.select("block", *columns).groupBy("block")
        return left.cogroup(returned.groupBy("block")).applyInArrow(function, schema)

    arrays = list(FIELDS[1:])

    def counts_of(n: int):
        def counts(left: pa.Table, right: pa.Table) -> pa.Table:
            return _entries(e for row, block in _read(left, right, settings, n) for e in _sent(n, radix, row["block"], *block.entries(n)))

        return counts

    for n in range(2, depth + 1):
        returned = returned.unionByName(_totals(again(counts_of(n), ENTRIES, arrays)))

    def gains(left: pa.Table, right: pa.Table) -> pa.Table:
        found = ((row, g) for row, block in _read(left, right, settings, depth + 1) for g in block.gains(train_tokens, distinct))
        return _entries(e for row, (n, contexts, gain) in found for e in _sent(GAINS + n, radix, row["block"], contexts, gain))

    if depth:
        returned = returned.unionByName(_totals(again(gains, ENTRIES, arrays)))

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        (row, block), *_ = _read(left, right, settings, depth + 1)
        sums = block.scores(train_tokens, distinct)
        return pa.table({"uid": row["uid"].values, "doc_id": row["doc_id"].values, "held_out": pa.array(block.held != 0), **{n: pa.array(v) for n, v in sums.items()}})

    pieces = again(scored, f"uid bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double", ["doc_id", "uid", *arrays])
    summed = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    whole = pieces.groupBy("uid").agg(F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), *summed)
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
