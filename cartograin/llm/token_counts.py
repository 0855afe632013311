"""Token counts by byte-pair merging with a heap and a linked list.

A text is cut into pieces; a piece's bytes are the first symbols; the adjacent pair of
lowest rank is merged until none is left. The count is symbols minus merges, so no
token identifier is ever made.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Fixed value: the pattern that cuts text before byte-level merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pieces whose counts a worker remembers.
MEMO = 400_000
#: Characters above which pieces are counted one by one rather than listed first.
LONG_TEXT = 1 << 20


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the others, in order, for the
    characters from 256 on.
    """
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    """Merges in rank order, as pairs of symbol strings, and tokens that texts may name outright."""

    merges: tuple[tuple[str, str], ...]
    added: tuple[str, ...]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From a tokenizer file (``.json``, byte-level BPE)."""
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        if content["pre_tokenizer"]["type"] != "ByteLevel" or content["model"]["type"] != "BPE":
            raise ValueError("byte-level BPE vocabularies only")
        pairs = (m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"])
        return cls(tuple((a, b) for a, b in pairs), tuple(t["content"] for t in content["added_tokens"]))


class PieceCounts(dict):
    """Tokens of a piece, computed when first asked for; remembers at most ``MEMO`` pieces."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        names = {s: i for i, s in enumerate(byte_symbols())}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(vocabulary.merges):
            merged = names.setdefault(left + right, len(names))
            self.pairs.setdefault((names.setdefault(left, len(names)), names.setdefault(right, len(names))), (rank, merged))
        self.cut = regex.compile(PATTERN)
        longest_first = sorted(vocabulary.added, key=len, reverse=True)
        self.named = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None

    def __missing__(self, piece: str) -> int:
        count = self.merged(piece.encode())
        if len(self) < MEMO:
            self[piece] = count
        return count

    def merged(self, piece: bytes) -> int:
        """Symbols left after all merges."""
        symbols = list(piece)
        n = len(symbols)
        pairs = self.pairs
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = []
        for i in range(n - 1):
            found = pairs.get((symbols[i], symbols[i + 1]))
            if found:
                queue.append((found[0], i, found[1]))
        heapq.heapify(queue)
        merges = 0
        while queue:
            rank, i, merged = heapq.heappop(queue)
            j = after[i] if symbols[i] >= 0 else n
            # An entry is stale when one of its symbols has changed since.
            if j >= n or pairs.get((symbols[i], symbols[j])) != (rank, merged):
                continue
            symbols[i], symbols[j] = merged, -1
            merges += 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                found = pairs.get((merged, symbols[k]))
                if found:
                    heapq.heappush(queue, (found[0], i, found[1]))
            h = before[i]
            if h >= 0:
                found = pairs.get((symbols[h], merged))
                if found:
                    heapq.heappush(queue, (found[0], h, found[1]))
        return n - merges

    def count(self, text: str) -> int:
        if self.named is None:
            return self._plain(text)
        parts = self.named.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1

    def _plain(self, text: str) -> int:
        if len(text) > LONG_TEXT:
            return sum(self[m.group()] for m in self.cut.finditer(text))
        return sum(map(self.__getitem__, self.cut.findall(text)))


_LOADED: dict[int, PieceCounts] = {}


def _counts(vocabulary: Vocabulary) -> PieceCounts:
    """One table per worker process, kept between tasks."""
    key = hash(vocabulary)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = PieceCounts(vocabulary)
    return _LOADED[key]


COUNTED = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


def token_counts(documents: DataFrame, vocabulary: Vocabulary, limit: int = 1024) -> DataFrame:
    """Per document row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens).

    Tokens that the vocabulary adds count as one where a text spells them. Null texts
    count as empty; rows that repeat are counted one by one; other columns are not read.
    Tasks share nothing and nothing is shuffled.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(vocabulary)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                n_bytes.append(len(text.encode()))
                n_tokens.append(counts.count(text))
            tokens = pa.array(n_tokens, pa.int64())
            over = pa.array([n > limit for n in n_tokens], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_bytes, pa.int64()), tokens, over], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return documents.select("doc_id", "text").mapInArrow(counted, COUNTED)
