"""Substring dedup on words: winnowed anchors, window hashes sorted by bucket.

Winnowed anchors that occur again deal the windows of the threshold length around them to
buckets; equal window hashes in a bucket are repeats. No match is extended and no pair of
documents joined; adjoining repeated windows merge, and the words they cover are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import lexing
from .common import null_safe_join
from .repeats import HOT, Windows, keyed, repeated_ranges

#: Words of a window, and of a winnowed anchor (every window of 35 words holds one of 18).
THRESHOLD, ANCHOR = 35, 18

DEDUPED = "doc_id bigint, n_words bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string"


def covered(ranges: list[dict], length: int, units: int) -> np.ndarray:
    """Units covered by windows that start in the ranges."""
    change = np.zeros(units + 1, np.int64)
    for r in ranges:
        begins = np.asarray(r["begins"], np.int64)
        np.add.at(change, begins, 1)
        np.add.at(change, np.minimum(units, begins + r["n"] - 1 + length), -1)
    return np.cumsum(change[:units]) > 0


def spans(mask: np.ndarray) -> int:
    """Number of maximal runs of marked units."""
    return int(mask[0]) + int(np.count_nonzero(mask[1:] & ~mask[:-1])) if len(mask) else 0


def substring_dedup(documents: DataFrame, threshold: int = THRESHOLD, anchor: int = ANCHOR, hot: int = HOT, texts: bool = True) -> DataFrame:
    """Per document row: doc_id, n_words, n_removed, n_spans, kept_sha256, kept.

    A word goes if a window of ``threshold`` words that covers it also starts anywhere
    else; all copies go, the first too. Kept words are joined by one space (``kept`` is
    null with ``texts=False``). Null texts have no words and the digest of the empty
    text; rows that repeat are repeats of each other; texts shorter than a window keep
    all; other columns are not read.
    """
    if not 1 <= anchor <= threshold:
        raise ValueError("an anchor fits into a window")
    source = keyed(documents)
    found = repeated_ranges(source, Windows(threshold, anchor, words=True), hot)
    joined = null_safe_join(source, found, ["ka", "kb"], "left").select("doc_id", "text", "ranges")

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, ranges in zip(lexing.encoded(batch.column("text")), batch.column("ranges")):
                words = text.split()
                mask = covered(ranges.as_py() or [], threshold, len(words))
                kept = b" ".join(w for w, gone in zip(words, mask) if not gone) if mask.any() else b" ".join(words)
                rows.append((len(words), int(mask.sum()), spans(mask), hashlib.sha256(kept).hexdigest(), kept.decode() if texts else None))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")] + [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "n_words", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return joined.mapInArrow(rest, DEDUPED)
