"""Alignment of two tokenizers by external counting of pair-document records.

Texts are encoded by a byte-level BPE (A) and a sentencepiece model (B). Byte offsets where
tokens of both end cut them into groups; all A-B pairs of a group are linked. Each block of
documents sorts its (A id, B id, document) records, deals them to radix partitions by A id
and writes them as zstd runs. Runs of a partition are merged with a heap, one A id at a
time: that yields each pair's number of documents and the highest of each A id, and every
run gets back the figures of its own pairs, in its own order.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .runs import first_of, pack, pack_sorted, ranges, unpack, unpack_sorted
from .token_counts import byte_symbols

#: Text bytes in a block, partitions by A id, runs that one merge reads at most (about).
BLOCK_BYTES, RADIX, FAN = 2 << 20, 64, 512
#: Links above which a group's pairs are counted by distinct ids.
WIDE_GROUP = 1 << 20
#: Scripts in which both readers of the pattern that cuts A's words agree on letters, digits and space.
_SETTLED = re.compile("[\t\n\r -~\xa1-ɏΑ-ΡΣ-ώЀ-ҁぁ-ゖ一-龥]*")


# --- tokenizers ---------------------------------------------------------------


@dataclass(frozen=True)
class Tokenizers:
    """Contents of the two vocabulary files, read on the driver."""

    a: str
    b: bytes

    @classmethod
    def read(cls, path_a: str, path_b: str) -> Tokenizers:
        with open(path_a, encoding="utf-8") as file, open(path_b, "rb") as model:
            return cls(file.read(), model.read())


class _Pair:
    """Both tokenizers, and the bytes of their entries by id."""

    def __init__(self, files: Tokenizers):
        import sentencepiece
        import tiktoken
        import tokenizers

        content = json.loads(files.a)
        self._a = tokenizers.Tokenizer.from_str(files.a)
        self._a.encode_special_tokens = True
        self._a.no_truncation()
        self._a.no_padding()
        value = {s: b for b, s in enumerate(byte_symbols())}
        vocabulary = {t: i for t, i in content["model"]["vocab"].items()}
        special = {t["content"] for t in content["added_tokens"]}
        entries = {i: bytes(value[c] for c in t) for t, i in vocabulary.items() if t not in special}
        self.bytes_a = [entries.get(i, b"") for i in range(self._a.get_vocab_size())]
        # Where ids follow the order of merges, the ranked encoder gives the same ids in a quarter of the time.
        pairs = (m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"])
        ranked = all(vocabulary.get(x + y) == 256 + i for i, (x, y) in enumerate(pairs))
        from .token_counts import PATTERN

        ranks = {t: i for i, t in entries.items()}
        self._fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if ranked else None
        self._b = sentencepiece.SentencePieceProcessor(model_proto=files.b)
        size = self._b.get_piece_size()
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, self._b.id_to_piece(i)) for i in range(size))]
        self.length_a, self.length_b = (np.array([len(t) for t in e], np.int64) for e in (self.bytes_a, self.bytes_b))
        first, other = ([s + str(i).encode() for i in range(len(e))] for s, e in ((b";", self.bytes_a), (b",", self.bytes_a)))
        first_b, other_b = ([s + str(i).encode() for i in range(size)] for s in (b"|", b","))
        #: Separator and number of a token, by its place in a group.
        self.written = [*first, *other, *first_b, *other_b]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and B; none for a text whose bytes either does not give back."""
        none = np.zeros(0, np.int32)
        if not text:
            return none, none
        spaced = " " + text
        if self._fast is not None and _SETTLED.fullmatch(text):
            a = self._fast.encode_ordinary(spaced)
        else:
            a = self._a.encode(spaced, add_special_tokens=False).ids
        b = self._b.encode(text)
        raw = spaced.encode()
        whole = all(b"".join(map(table.__getitem__, ids)) == raw for table, ids in ((self.bytes_a, a), (self.bytes_b, b)))
        return (np.array(a, np.int32), np.array(b, np.int32)) if whole else (none, none)


@functools.lru_cache(maxsize=1)
def _pair(files: Tokenizers) -> _Pair:
    return _Pair(files)


# --- links of a block -----------------------------------------------------------


@dataclass
class Aligned:
    """Groups and links of the documents of a block; records are sorted by key, then document."""

    figures: dict[str, np.ndarray]
    digest: list[str]
    key: np.ndarray
    doc: np.ndarray
    times: np.ndarray


def _order(a: np.ndarray, size_a: int) -> np.ndarray:
    """A ids numbered partition by partition."""
    return (a % RADIX) * -(-size_a // RADIX) + a // RADIX


def align(pair: _Pair, encoded: list[tuple[np.ndarray, np.ndarray]]) -> Aligned:
    docs, size_b = len(encoded), len(pair.bytes_b)
    n_a, n_b = (np.array([len(e[k]) for e in encoded], np.int64) for k in (0, 1))
    a, b = (np.concatenate([np.zeros(0, np.int64), *[e[k] for e in encoded]]) for k in (0, 1))
    end_a, end_b = np.cumsum(pair.length_a[a]), np.cumsum(pair.length_b[b])
    # Documents give as many bytes on both sides, so their ends are common ends.
    common_a = np.isin(end_a, end_b, assume_unique=True)
    common_b = np.isin(end_b, end_a, assume_unique=True)
    group_a, group_b = (np.cumsum(c) - c for c in (common_a, common_b))
    groups = int(common_a.sum())
    wide_a, wide_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    doc_a = np.repeat(np.arange(docs), n_a)
    group_doc = doc_a[common_a]
    links = wide_a * wide_b
    figures = {
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": np.bincount(group_doc, minlength=docs),
        "n_links": np.bincount(group_doc, weights=links, minlength=docs).astype(np.int64),
    }
    begin_b = np.cumsum(wide_b) - wide_b
    few = links <= WIDE_GROUP
    other = np.where(few[group_a], wide_b[group_a], 0)
    keys = [(np.repeat(_order(a, len(pair.bytes_a)), other) * size_b + b[ranges(begin_b[group_a], other)]) * docs + np.repeat(doc_a, other)]
    times = [np.ones(len(keys[0]), np.int64)]
    begin_a = np.cumsum(wide_a) - wide_a
    for g in np.flatnonzero(~few):
        left, n_left = np.unique(a[begin_a[g] : begin_a[g] + wide_a[g]], return_counts=True)
        right, n_right = np.unique(b[begin_b[g] : begin_b[g] + wide_b[g]], return_counts=True)
        keys.append(((_order(left, len(pair.bytes_a))[:, None] * size_b + right) * docs + group_doc[g]).ravel())
        times.append((n_left[:, None] * n_right).ravel())
    if len(keys) == 1:
        record, count = np.unique(keys[0], return_counts=True)
    else:
        joined, weight = np.concatenate(keys), np.concatenate(times)
        ranked = np.argsort(joined, kind="stable")
        cut = first_of(joined[ranked])
        record, count = joined[ranked][cut], np.add.reduceat(weight[ranked], cut)
    # The written form: A's tokens of a group, then B's, groups after each other.
    place = np.cumsum(wide_a + wide_b) - wide_a - wide_b
    within_a, within_b = np.arange(len(a)) - begin_a[group_a], np.arange(len(b)) - begin_b[group_b]
    item = np.empty(len(a) + len(b), np.int64)
    item[place[group_a] + within_a] = a + np.where(within_a == 0, 0, len(pair.bytes_a))
    item[place[group_b] + wide_a[group_b] + within_b] = b + 2 * len(pair.bytes_a) + np.where(within_b == 0, 0, size_b)
    bounds = np.concatenate([[0], np.cumsum(n_a + n_b)])
    written = pair.written.__getitem__
    digest = []
    for low, high in zip(bounds[:-1], bounds[1:]):
        text = b"".join(map(written, item[low:high].tolist()))[1:]
        digest.append(hashlib.sha256(text).hexdigest() if text else "")
    return Aligned(figures, digest, (record // max(docs, 1)).astype(np.uint64), record % max(docs, 1), count)


def _blocks(documents: DataFrame, files: Tokenizers) -> DataFrame:
    """Rows of a block: its documents (radix -1), and a run for each radix it has records of."""
    kind = dict(documents.dtypes)["doc_id"]
    figures = ("n_a", "n_b", "n_groups", "n_links")
    names = ["block", "radix", "doc_id", *figures, "groups_sha256", "keys", "n_docs", "docs", "times"]
    schema = f"block bigint, radix int, doc_id array<{kind}>, {', '.join(f'{f} binary' for f in figures)}, groups_sha256 array<string>, keys binary, n_docs binary, docs binary, times binary"

    def written(number: int, ids: list, texts: list[str], id_type: pa.DataType) -> pa.RecordBatch:
        pair = _pair(files)
        found = align(pair, [pair.encode(t) for t in texts])
        partition_size = -(-len(pair.bytes_a) // RADIX) * len(pair.bytes_b)
        rows = {n: [] for n in names}
        radix = (found.key // np.uint64(partition_size)).astype(np.int64)
        cuts = np.append(first_of(radix), len(radix))
        rows["block"] += [number] * len(cuts)
        rows["radix"] += [-1, *radix[cuts[:-1]].tolist()]
        rows["doc_id"] += [ids] + [None] * (len(cuts) - 1)
        rows["groups_sha256"] += [found.digest] + [None] * (len(cuts) - 1)
        for f in figures:
            rows[f] += [pack(found.figures[f].astype(np.uint64))] + [None] * (len(cuts) - 1)
        for c in ("keys", "n_docs", "docs", "times"):
            rows[c].append(None)
        for low, high in zip(cuts[:-1], cuts[1:]):
            at = first_of(found.key[low:high])
            rows["keys"].append(pack_sorted(found.key[low:high][at]))
            rows["n_docs"].append(pack(np.diff(np.append(at, high - low)).astype(np.uint64)))
            rows["docs"].append(pack(found.doc[low:high].astype(np.uint64)))
            rows["times"].append(pack(found.times[low:high].astype(np.uint64)))
        types = [pa.int64(), pa.int32(), pa.list_(id_type), *[pa.binary()] * 4, pa.list_(pa.string()), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(rows[n], t) for n, t in zip(names, types)], names)

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, size, id_type = TaskContext.get().partitionId() << 32, [], [], 0, pa.int64()
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                value = text.as_py() or ""
                if texts and size + len(value) > BLOCK_BYTES:
                    yield written(number, ids, texts, id_type)
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(doc_id)
                texts.append(value)
                size += len(value)
        if texts:
            yield written(number, ids, texts, id_type)

    return staged(documents.select("doc_id", "text").mapInArrow(built, schema), "alignment-runs")


# --- merging ---------------------------------------------------------------------


def merged(keys: list[np.ndarray], size_b: int) -> Iterator[list[tuple[int, int, int]]]:
    """For each A id in order, the runs that hold it and where: (run, from, to)."""
    sides = [k // np.uint64(size_b) for k in keys]
    cuts = [np.append(first_of(s), len(s)).tolist() for s in sides]
    heads = [s[c[:-1]].tolist() for s, c in zip(sides, cuts)]
    queue = [(h[0], run, 0) for run, h in enumerate(heads) if h]
    heapq.heapify(queue)
    while queue:
        side, held = queue[0][0], []
        while queue and queue[0][0] == side:
            _, run, at = queue[0]
            held.append((run, cuts[run][at], cuts[run][at + 1]))
            if at + 1 < len(heads[run]):
                heapq.heapreplace(queue, (heads[run][at + 1], run, at + 1))
            else:
                heapq.heappop(queue)
        yield held


def _side_totals(keys, counts, size_b: int) -> Iterator[tuple[list[tuple[int, int, int]], np.ndarray, np.ndarray, np.ndarray]]:
    """As ``merged``, with the side's distinct keys, their totals, and which of them each entry is."""
    for held in merged(keys, size_b):
        joined = np.concatenate([keys[r][low:high] for r, low, high in held])
        distinct, which = np.unique(joined, return_inverse=True)
        amount = np.concatenate([counts[r][low:high] for r, low, high in held])
        yield held, distinct, np.bincount(which, weights=amount).astype(np.uint64), which


def _runs(table: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    return [unpack_sorted(k.as_py()) for k in table.column("keys")], [unpack(c.as_py()) for c in table.column("n_docs")]


RETURNED = "radix int, run bigint, total binary, best binary"


def _returned(table: pa.Table, totals: list[np.ndarray], best: list[np.ndarray]) -> pa.Table:
    return pa.table({
        "radix": table.column("radix").cast(pa.int32()),
        "run": table.column("run"),
        "total": pa.array([pack(t) for t in totals], pa.binary()),
        "best": pa.array([pack(b.astype(np.uint64)) for b in best], pa.binary()),
    })


def _finish(size_b: int) -> Callable[[pa.Table], pa.Table]:
    """Count all pairs of a partition and give every run the figures of its own."""

    def finish(table: pa.Table) -> pa.Table:
        keys, counts = _runs(table)
        totals, best = [np.zeros(len(k), np.uint64) for k in keys], [np.zeros(len(k), bool) for k in keys]
        for held, _, total, which in _side_totals(keys, counts, size_b):
            highest, at = total == total.max(), 0
            for run, low, high in held:
                own = which[at : at + high - low]
                totals[run][low:high], best[run][low:high] = total[own], highest[own]
                at += high - low
        return _returned(table, totals, best)

    return finish


def _merge(size_b: int) -> Callable[[pa.Table], pa.Table]:
    """Several runs of a partition as one, named by the group they share."""

    def merge(table: pa.Table) -> pa.Table:
        sides = [(distinct, total) for _, distinct, total, _ in _side_totals(*_runs(table), size_b)]
        keys, totals = (np.concatenate(c) for c in zip(*sides))
        first = table.slice(0, 1)
        return pa.table({"radix": first.column("radix"), "run": first.column("parent"), "keys": pa.array([pack_sorted(keys)], pa.binary()), "n_docs": pa.array([pack(totals)], pa.binary())})

    return merge


def _pass_down(children: pa.Table, parents: pa.Table, below: pa.Table) -> pa.Table:
    """A merged run's figures, taken apart for the runs it was made of."""
    keys, total, best = unpack_sorted(parents.column("keys")[0].as_py()), unpack(below.column("total")[0].as_py()), unpack(below.column("best")[0].as_py())
    at = [np.searchsorted(keys, unpack_sorted(k.as_py())) for k in children.column("keys")]
    return _returned(children, [total[p] for p in at], [best[p] for p in at])


def _contributions(runs: DataFrame, n_runs: int, size_b: int) -> DataFrame:
    """For every run of (radix, run, keys, n_docs) its pairs' totals and whether they are their side's highest.

    A merge reads about ``FAN`` runs: with more, groups of runs are merged first, over as
    many levels as it takes, and figures come back down the same way.
    """
    levels = [runs]
    while n_runs > FAN:
        n_runs = -(-n_runs // FAN)
        parent = F.pmod(F.xxhash64("run", F.lit(len(levels))), F.lit(n_runs))
        levels[-1] = levels[-1].withColumn("parent", parent)
        above = levels[-1].groupBy("radix", "parent").applyInArrow(_merge(size_b), "radix int, run bigint, keys binary, n_docs binary")
        levels.append(staged(above, "alignment-merged"))
    back = staged(levels[-1].groupBy("radix").applyInArrow(_finish(size_b), RETURNED), "alignment-figures")
    for children, parents in zip(levels[-2::-1], levels[:0:-1]):
        above = parents.select("radix", F.col("run").alias("parent"), "keys").join(back.withColumnRenamed("run", "parent"), ["radix", "parent"])

        def down(left: pa.Table, right: pa.Table) -> pa.Table:
            return _pass_down(left, right, right)

        grouped = children.groupBy("radix", "parent").cogroup(above.groupBy("radix", "parent"))
        back = staged(grouped.applyInArrow(down, RETURNED), "alignment-figures")
    return back


def _documents(block: pa.Table, figures: pa.Table) -> pa.Table:
    """One row per document of a block, with what its links add up to."""
    shape = block.schema.field("doc_id").type.value_type
    by_radix = {r: (unpack(t), unpack(b)) for r, t, b in zip(*(figures.column(c).to_pylist() for c in ("radix", "total", "best")))}
    head = next(r for r in range(block.num_rows) if block.column("radix")[r].as_py() == -1)
    ids = block.column("doc_id")[head].values
    n_best, count_sum = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    for row in range(block.num_rows):
        radix = block.column("radix")[row].as_py()
        if radix >= 0:
            total, best = by_radix[radix]
            n_docs, docs, times = (unpack(block.column(c)[row].as_py()).astype(np.int64) for c in ("n_docs", "docs", "times"))
            np.add.at(count_sum, docs, times * np.repeat(total.astype(np.int64), n_docs))
            np.add.at(n_best, docs, times * np.repeat(best.astype(np.int64), n_docs))
    plain = {f: pa.array(unpack(block.column(f)[head].as_py()).astype(np.int64)) for f in ("n_a", "n_b", "n_groups", "n_links")}
    return pa.table({"doc_id": ids.cast(shape), **plain, "n_best": pa.array(n_best), "count_sum": pa.array(count_sum), "groups_sha256": block.column("groups_sha256")[head].values})


def token_alignment(documents: DataFrame, files: Tokenizers) -> DataFrame:
    """Per document row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A encodes a space and the text, B the text; both without special tokens. n_links is the
    number of A-B token pairs that share a group; count_sum adds up, over these links, the
    number of documents that hold the pair of ids; n_best counts the links whose pair is the
    most frequent of its A id, ties included. Texts that are null, empty, or whose bytes
    either tokenizer does not give back have zeros and an empty digest and add to no pair.
    Rows with the same doc_id, or none, are documents of their own; other columns are not
    read. A text is encoded in one piece, so a task holds the tokens of its longest text.

    A block is about ``BLOCK_BYTES`` of text; a partition holds the pairs of one A id in
    ``RADIX``, and a run has a pair once, so a merge reads at most runs x pairs of the
    vocabularies, however often a pair occurs.
    """
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_proto=files.b).get_piece_size()
    blocks = _blocks(documents, files)
    runs = blocks.filter("radix >= 0").select("radix", F.col("block").alias("run"), "keys", "n_docs")
    figures = _contributions(runs, blocks.filter("radix = -1").count(), size_b)
    kind = dict(documents.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    grouped = blocks.drop("keys").groupBy("block").cogroup(figures.withColumnRenamed("run", "block").groupBy("block"))
    return grouped.applyInArrow(_documents, schema)
