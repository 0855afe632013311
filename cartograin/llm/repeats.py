"""Exact search for repeated windows: which stretches of a fixed length start twice or more in a corpus.

A text is a row of units (bytes or words); a window is ``length`` consecutive units of one
text. Of the k-grams in a window, the one of smallest hash (the last of equals) is its
anchor: equal windows have equal anchors at equal offsets, so anchors are a sparse cover
of all windows, one in (length - k) / 2 positions, and windows with different anchors need
not be compared. Steps, each a Spark job over rows that can be dealt anew:

1. anchors per text; those that occur once in the corpus are out;
2. for the others, the run of windows around each anchor goes to the anchor's bucket;
3. each bucket is sorted by itself, a bounded number of rows at a time; equal neighbours
   are repeats;
4. anchors with more than ``HOT`` occurrences have no bucket: their windows are counted
   by hash with partial aggregation, so no task sees them all.

The answer is, per text, ranges of window starts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lexing
from .common import row_key, staged

#: Occurrences above which an anchor's windows are counted by hash instead of sorted in a bucket:
#: a bucket of this many runs (up to 6 MB of text, 1.4 million windows) sorts in about 100 MB.
HOT = 20_000
#: Bytes of payload that a task sorts at once (one bucket is never cut).
SORTED_BYTES = 2 << 20
#: Units of a text looked at in one go; longer texts are cut into overlapping sections.
SECTION = 1 << 20
_POSITION_BITS = np.uint64(22)
_POSITION = np.uint64((1 << 22) - 1)

_P = int(lexing._MULTIPLIER)
_INVERSE = np.uint64(pow(_P, -1, 1 << 64))


@dataclass(frozen=True)
class Windows:
    """``length`` units per window, ``k`` per anchor; ``words`` says what the units are."""

    length: int
    k: int
    words: bool


class Prefix:
    """Hashes of any stretch of a block of unit hashes, from one running sum."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * _table(_P, n), out=self.sums[1:])
        self.inverse = _table(int(_INVERSE), n + 1)

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        return lexing.mix((self.sums[starts + length] - self.sums[starts]) * self.inverse[starts])

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return lexing.mix((self.sums[length:] - self.sums[:n]) * self.inverse[:n])


_TABLES: dict[int, np.ndarray] = {}


def _table(base: int, n: int) -> np.ndarray:
    """Powers of an odd number modulo 2^64."""
    known = _TABLES.get(base)
    if known is None or len(known) < n:
        size = max(n, 1 << 16)
        known = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, np.uint64(base)))])
        _TABLES[base] = known
    return known[:n]


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


@dataclass
class Runs:
    """Maximal rows of consecutive window starts with one anchor: text, first start (in the block), windows, anchor's hash."""

    text: np.ndarray
    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray


_NO_RUNS = Runs(*(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, np.uint64))


def find_runs(prefix: Prefix, bounds: np.ndarray, shape: Windows) -> Runs:
    """All windows of the block's texts, by run. ``bounds`` are in units."""
    n = len(prefix.sums) - 1
    if n < shape.length:
        return _NO_RUNS
    grams = prefix.all(shape.k)
    places = np.arange(len(grams), dtype=np.uint64)
    ranked = (grams & ~_POSITION) | (_POSITION - places)
    least = _sliding_min(ranked, shape.length - shape.k + 1)
    anchor_at = (_POSITION - (least & _POSITION)).astype(np.int64)
    last = np.repeat(bounds[1:], np.diff(bounds))[: len(least)]
    starts = np.flatnonzero(np.arange(len(least)) + shape.length <= last)
    if not len(starts):
        return _NO_RUNS
    at = anchor_at[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    heads = np.flatnonzero(new)
    counts = np.diff(np.append(heads, len(starts)))
    first = starts[heads]
    return Runs(np.searchsorted(bounds, first, side="right") - 1, first, counts, grams[at[heads]])


@dataclass
class Block:
    """Units of several texts, or of a section of one; ``offset`` is the section's first unit within its text."""

    begin: int
    end: int
    offset: int
    bounds: np.ndarray
    prefix: Prefix
    data: np.ndarray


def unit_blocks(texts: list[bytes], shape: Windows) -> Iterator[Block]:
    """Blocks that hold every window of every text exactly once."""
    for begin, end in lexing.blocks(texts):
        data, bounds = lexing.layout(texts[begin:end])
        if shape.words:
            found = lexing.words(data, bounds)
            values = found.hash
            bounds = np.searchsorted(found.text, np.arange(end - begin + 1))
        else:
            values = lexing._BYTE[data]
        step = SECTION - shape.length + 1
        if len(values) <= 2 * SECTION:
            yield Block(begin, end, 0, bounds, Prefix(values), data)
            continue
        for at in range(0, max(1, len(values) - shape.length + 1), step):
            part = values[at : at + SECTION]
            yield Block(begin, end, at, np.array([0, len(part)]), Prefix(part), data[at : at + SECTION])


# --- step 1: anchors --------------------------------------------------------------------------------


def _anchor_rows(shape: Windows) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("ka", "kb"))
            for block in unit_blocks(lexing.encoded(batch.column("text")), shape):
                runs = find_runs(block.prefix, block.bounds, shape)
                order = np.lexsort((runs.anchor, runs.text))
                anchor, text = runs.anchor[order], runs.text[order]
                new = np.ones(len(anchor), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
                heads = np.flatnonzero(new)
                text = text[heads] + block.begin
                times = np.diff(np.append(heads, len(anchor)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[heads].view(np.int64)), pa.array(a[text]), pa.array(b[text]), pa.array(times, pa.int64())], names=["anchor", "ka", "kb", "times"]
                )

    return rows


# --- step 2: runs to buckets ------------------------------------------------------------------------


def _payload(block: Block, start: int, count: int, shape: Windows) -> bytes:
    """What a bucket needs to compare a run: the bytes it spans, or the hashes of its windows."""
    if shape.words:
        return block.prefix.at(np.arange(start, start + count), shape.length).tobytes()
    return block.data[start : start + count + shape.length - 1].tobytes()


_RUNS = "anchor bigint, ka bigint, kb int, hot boolean, starts array<int>, n int, payload binary"
_RUNS_ARROW = pa.schema(
    [("anchor", pa.int64()), ("ka", pa.int64()), ("kb", pa.int32()), ("hot", pa.bool_()), ("starts", pa.list_(pa.int32())), ("n", pa.int32()), ("payload", pa.binary())]
)


def _run_rows(shape: Windows) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = lexing.encoded(batch.column("text"))
            keys = list(zip(batch.column("ka").to_pylist(), batch.column("kb").to_pylist()))
            seeds, hot = batch.column("seeds"), batch.column("hot")
            for block in unit_blocks(texts, shape):
                runs = find_runs(block.prefix, block.bounds, shape)
                gathered: dict[tuple, list[int]] = {}
                edges = np.searchsorted(runs.text, np.arange(block.end - block.begin + 1))
                for i in range(block.end - block.begin):
                    own = slice(edges[i], edges[i + 1])
                    base = int(block.bounds[i]) - block.offset
                    anchors = runs.anchor[own]
                    often = hot[block.begin + i].values.to_numpy().view(np.uint64)
                    once = seeds[block.begin + i].values.to_numpy().view(np.uint64)
                    for j in np.flatnonzero(np.isin(anchors, once)) + own.start:
                        start, count = int(runs.start[j]), int(runs.count[j])
                        entry = (i, int(runs.anchor[j].view(np.int64)), False, count, _payload(block, start, count, shape))
                        gathered.setdefault(entry, []).append(start - base)
                    for j in np.flatnonzero(np.isin(anchors, often)) + own.start:
                        start, count = int(runs.start[j]), int(runs.count[j])
                        hashes = block.prefix.at(np.arange(start, start + count), shape.length).view(np.int64)
                        for shift, value in enumerate(hashes.tolist()):
                            gathered.setdefault((i, value, True, 1, b""), []).append(start - base + shift)
                if gathered:
                    yield _run_batch(gathered, keys, block.begin)

    return rows


def _run_batch(gathered: dict[tuple, list[int]], keys: list[tuple], begin: int) -> pa.RecordBatch:
    text, anchor, hot, n, payload = zip(*gathered)
    ka, kb = zip(*(keys[begin + i] for i in text))
    columns = (anchor, ka, kb, hot, list(gathered.values()), n, payload)
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _RUNS_ARROW)], schema=_RUNS_ARROW)


# --- step 3: buckets --------------------------------------------------------------------------------

_RANGES = "ka bigint, kb int, begins array<int>, n int"


def _sorted_buckets(shape: Windows) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows come ordered by anchor; whole buckets are gathered up to ``SORTED_BYTES`` and sorted."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.get_total_buffer_size()
            if size > SORTED_BYTES:
                joined = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                anchors = joined.column("anchor").to_numpy()
                last = int(np.argmax(anchors == anchors[-1]))
                if last:
                    yield from _bucket_repeats(joined.slice(0, last), shape)
                held = [joined.slice(last)]
                size = held[0].nbytes
        if held:
            yield from _bucket_repeats(pa.Table.from_batches(held).combine_chunks().to_batches()[0], shape)

    return rows


def _bucket_repeats(batch: pa.RecordBatch, shape: Windows) -> Iterator[pa.RecordBatch]:
    anchor = batch.column("anchor").to_numpy()
    count = batch.column("n").to_numpy().astype(np.int64)
    payloads = batch.column("payload").to_pylist()
    starts = batch.column("starts").to_pylist()
    row = np.repeat(np.arange(len(count)), count)
    firsts = np.concatenate([np.zeros(1, np.int64), np.cumsum(count)])
    place = np.arange(len(row)) - firsts[row]
    if shape.words:
        hashes = np.frombuffer(b"".join(payloads), np.uint64)
    else:
        data, bounds = lexing.layout(payloads)
        hashes = Prefix(lexing._BYTE[data]).at(bounds[row] + place, shape.length)
    bucket = np.concatenate([np.zeros(1, np.int64), np.cumsum(anchor[1:] != anchor[:-1])])[row]
    order = np.lexsort((hashes, bucket))
    same = np.zeros(len(row), bool)
    equal = (hashes[order[1:]] == hashes[order[:-1]]) & (bucket[order[1:]] == bucket[order[:-1]])
    same[order[1:]] |= equal
    same[order[:-1]] |= equal
    same |= np.array([len(s) > 1 for s in starts])[row]
    at = np.flatnonzero(same)
    if not len(at):
        return
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])
    heads = np.flatnonzero(new)
    lengths = np.diff(np.append(heads, len(at)))
    owner, first = row[at[heads]], place[at[heads]]
    begins = [[s + int(f) for s in starts[o]] for o, f in zip(owner, first)]
    a, b = (batch.column(c).to_numpy()[owner] for c in ("ka", "kb"))
    yield pa.RecordBatch.from_arrays(
        [pa.array(a), pa.array(b), pa.array(begins, pa.list_(pa.int32())), pa.array(lengths, pa.int32())], names=["ka", "kb", "begins", "n"]
    )


# --- the search -------------------------------------------------------------------------------------


def keyed(documents: DataFrame) -> DataFrame:
    """doc_id, ka, kb (96 bits of identity of doc_id and text), text. Identical rows share all of it, and so their answer."""
    key = row_key("doc_id", "text")
    return documents.select("doc_id", key["a"].alias("ka"), key["b"].alias("kb"), "text")


def repeated_ranges(texts: DataFrame, shape: Windows, hot: int = HOT) -> DataFrame:
    """ka, kb, ranges: per text with a repeated window, ranges (begins, n): n starts of repeated windows from each of begins on. Written to the shared folder."""
    source = texts.select("ka", "kb", "text")
    anchors = source.mapInArrow(_anchor_rows(shape), "anchor bigint, ka bigint, kb int, times bigint")
    seeds = anchors.groupBy("anchor").agg(F.sum("times").alias("occurrences")).filter("occurrences > 1")
    marked = anchors.join(seeds, "anchor")
    often = F.col("occurrences") > hot
    per_text = marked.groupBy("ka", "kb").agg(
        F.collect_set(F.when(~often, F.col("anchor"))).alias("seeds"), F.collect_set(F.when(often, F.col("anchor"))).alias("hot")
    )
    chosen = source.join(per_text, ["ka", "kb"])
    runs = staged(chosen.mapInArrow(_run_rows(shape), _RUNS), "repeat-runs")

    plain = runs.filter("NOT hot").repartition("anchor").sortWithinPartitions("anchor")
    sorted_out = plain.mapInArrow(_sorted_buckets(shape), _RANGES)

    counted = runs.filter("hot").select("anchor", "ka", "kb", "starts")
    repeated = counted.groupBy("anchor").agg(F.sum(F.size("starts")).alias("times")).filter("times > 1").select("anchor")
    by_hash = counted.join(repeated, "anchor").select("ka", "kb", F.col("starts").alias("begins"), F.lit(1).alias("n"))

    ranges = sorted_out.unionByName(by_hash).groupBy("ka", "kb").agg(F.collect_list(F.struct("begins", "n")).alias("ranges"))
    return staged(ranges, "repeat-ranges")
