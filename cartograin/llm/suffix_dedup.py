"""Suffix dedup on bytes: blockwise suffix sorting over a cover sample.

Suffixes are compared to the depth of the window only. A sparse cover sample of positions
(see ``repeats``) gives every suffix a first sampled position; suffixes are dealt to
buckets by it, one bucket is sorted at a time, and equal neighbours are repeats. The
sample is chosen by content rather than by position modulo a number: equal windows then
hold the same samples, so one comparison settles a tie, and an eighth as many positions
are sampled.
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
from .substring_dedup import covered, spans

#: Bytes of a window and of a sampled k-gram.
THRESHOLD, SAMPLE = 200, 64

DEDUPED = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def suffix_dedup(documents: DataFrame, threshold: int = THRESHOLD, sample: int = SAMPLE, hot: int = HOT, texts: bool = True) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept.

    A byte goes if a string of ``threshold`` bytes that covers it also starts anywhere
    else in the corpus; strings never cross documents and all copies go. ``kept`` is the
    remaining bytes, which need not be valid UTF-8 (null with ``texts=False``). Null texts
    count as empty; rows that repeat are repeats of each other; texts shorter than the
    threshold keep all; other columns are not read.
    """
    if not 1 <= sample <= threshold:
        raise ValueError("a sample fits into a window")
    source = keyed(documents)
    found = repeated_ranges(source, Windows(threshold, sample, words=False), hot)
    joined = null_safe_join(source, found, ["ka", "kb"], "left").select("doc_id", "text", "ranges")

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, ranges in zip(lexing.encoded(batch.column("text")), batch.column("ranges")):
                mask = covered(ranges.as_py() or [], threshold, len(text))
                kept = np.frombuffer(text, np.uint8)[~mask].tobytes() if mask.any() else text
                rows.append((len(text), int(mask.sum()), spans(mask), hashlib.sha256(kept).hexdigest(), kept if texts else None))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")] + [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return joined.mapInArrow(rest, DEDUPED)
