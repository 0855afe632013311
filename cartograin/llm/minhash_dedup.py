"""MinHash near-dedup with tensored banding.

Two collections of ``m`` short MinHash tuples are computed, u and v. A table's key joins
one tuple of each, so the m * m tables of a banding scheme cost 2 * m tuples, about the
square root of the hash computations. Pairs that share a key are candidates; every link
is confirmed on the full shingle sets.

Documents of equal sets are one node. Rows are dealt by the u half of the keys; the v half
is compared where two rows meet, so a node has m rows and not m * m. A bucket compares its
members with a pivot; buckets whose members are all in one component are done; what is left
is compared with ever more pivots until no bucket holds two components, so no link between
components is lost. A pair that shares several keys is formed at the first alone. Pairs of
one component, and pairs that set sizes or odd sketches rule out, are not formed. A bucket
of similar texts that do not link is compared pair by pair in the end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import lexing
from .common import row_key, staged
from .components import merged


@dataclass(frozen=True)
class Banding:
    """A pair of similarity s shares a tuple of one side with probability 1 - (1 - s^size)^tuples, and
    is found with the square of it: 0.9992 at s = 0.75, 0.9999 at 0.78, 0.22 at 0.5, 0.02 at 0.4.

    A bucket has ``pivots`` pivots at first, ``growth`` times as many in each round after.
    ``sketch`` is the number of 64-bit words of a node's odd sketch; pairs are ruled out that differ in
    more bits than a linked pair does on average plus ``deviations`` standard deviations, which a linked
    pair does with a chance below one in a million."""

    words: int = 5
    percent: int = 75
    tuples: int = 40
    size: int = 6
    pivots: int = 4
    growth: int = 16
    sketch: int = 16
    deviations: float = 5.0

    @property
    def hashes(self) -> int:
        return 2 * self.tuples * self.size


def shingle_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct n-word shingles, by text; shorter texts are one shingle, those without words have none."""
    data, bounds = lexing.layout(texts)
    word = lexing.words(data, bounds, lower=True)
    window, whole = lexing.windows(word, n)
    at = np.flatnonzero(whole)
    text, hashed = word.text[at], window[at]
    counts = np.bincount(word.text, minlength=len(texts))
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        ends = np.cumsum(counts)
        power = lexing.powers(n)
        extra = [lexing.mix((word.hash[ends[i] - counts[i] : ends[i]] * power[: counts[i]]).sum(keepdims=True) + np.uint64(counts[i])) for i in short]
        text, hashed = np.concatenate([text, short]), np.concatenate([hashed, *extra])
    order = np.lexsort((hashed, text))
    text, hashed = text[order], hashed[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashed[1:] != hashed[:-1])
    return text[new], hashed[new]


_SIGNED = "doc_id bigint, key struct<a:bigint,b:int>, n_shingles bigint, fa bigint, fb bigint, us array<bigint>, vs array<bigint>, sketch array<bigint>"
_SIGNED_NAMES = ["doc_id", "key", "n_shingles", "fa", "fb", "us", "vs", "sketch"]


def _signer(banding: Banding):
    multiply = _permutation_numbers(banding.hashes) | np.uint32(1)
    add = _permutation_numbers(banding.hashes, 1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = lexing.encoded(batch.column("text"))
            for begin, end in lexing.blocks(texts):
                part = batch.slice(begin, end - begin)
                columns = _signatures(texts[begin:end], banding, multiply, add)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("key"), *columns], names=_SIGNED_NAMES)

    return rows


def _permutation_numbers(n: int, stream: int = 0) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([20240301, stream])).integers(0, 1 << 32, n, dtype=np.uint32)


def _signatures(texts: list[bytes], banding: Banding, multiply: np.ndarray, add: np.ndarray) -> list[pa.Array]:
    n = len(texts)
    text, hashed = shingle_sets(texts, banding.words)
    count = np.bincount(text, minlength=n)
    filled = np.flatnonzero(count)
    fa, fb = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    keys = np.zeros((2 * banding.tuples, n), np.uint64)
    if len(filled):
        starts = np.searchsorted(text, filled)
        fa[filled] = np.add.reduceat(lexing.mix(hashed), starts)
        fb[filled] = np.add.reduceat(lexing.mix(hashed ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts)
        folded = (hashed >> np.uint64(32)).astype(np.uint32)
        scratch = np.empty_like(folded)
        for t in range(2 * banding.tuples):
            key = np.full(len(filled), t + 1, np.uint64)
            for k in range(t * banding.size, (t + 1) * banding.size):
                np.multiply(folded, multiply[k], out=scratch)
                np.add(scratch, add[k], out=scratch)
                key = lexing.mix(key + np.minimum.reduceat(scratch, starts).astype(np.uint64))
            keys[t, filled] = key
    filled_offsets = np.concatenate([[0], np.cumsum((count > 0) * banding.tuples)]).astype(np.int32)

    def listed(side: np.ndarray) -> pa.Array:
        flat = np.ascontiguousarray(side[:, filled].T).ravel().view(np.int64)
        return pa.ListArray.from_arrays(pa.array(filled_offsets), pa.array(flat))

    plain = [pa.array(count, pa.int64()), pa.array(fa.view(np.int64)), pa.array(fb.view(np.int64))]
    sketches = odd_sketches(text, hashed, n, banding.sketch)
    sketch_offsets = (np.arange(n + 1) * banding.sketch).astype(np.int32)
    sketch = pa.ListArray.from_arrays(pa.array(sketch_offsets), pa.array(sketches.ravel().view(np.int64)))
    return [*plain, listed(keys[: banding.tuples]), listed(keys[banding.tuples :]), sketch]


def odd_sketches(text: np.ndarray, hashed: np.ndarray, n: int, words: int) -> np.ndarray:
    """Of each text ``64 * words`` bits: which of so many cells hold an odd number of the set's hashes.

    Bits in which two sketches differ are the odd cells of the sets' symmetric difference.
    """
    cell = ((lexing.mix(hashed ^ np.uint64(0x5BD1E9955BD1E995)) >> np.uint64(32)) * np.uint64(64 * words)) >> np.uint64(32)
    sketches = np.zeros(n * words, np.uint64)
    np.bitwise_xor.at(sketches, text * words + (cell >> np.uint64(6)).astype(np.int64), np.uint64(1) << (cell & np.uint64(63)))
    return sketches.reshape(n, words)


def near_sketches(a: str, b: str, both: Column, banding: Banding) -> Column:
    """Whether sketches a and b of two sets, ``both`` elements together, may belong to a linked pair.

    Linked sets differ in at most (100 - percent) / (100 + percent) of ``both`` elements. So many elements
    thrown into the cells leave a known mean and variance of odd cells. Sets much larger than the sketch
    fill it whatever they hold; the limit is then above all cells and rules nothing out.
    """
    cells = 64 * banding.sketch
    unlike = both * F.lit((100 - banding.percent) / (100 + banding.percent))
    even = F.exp(unlike * F.lit(math.log1p(-2 / cells)))
    variance = F.greatest(F.lit(cells / 4) * (1 - even * even) - unlike * even * even, F.lit(0.0))
    limit = F.lit(cells / 2) * (1 - even) + F.lit(banding.deviations) * F.sqrt(variance) + 1
    differing = sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(1, banding.sketch)), F.bit_count(F.col(a)[0].bitwiseXOR(F.col(b)[0])))
    return differing <= limit


def _verifier(banding: Banding):
    """Keeps the pairs whose shingle sets are similar enough."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = lexing.encoded(batch.column("text_a")), lexing.encoded(batch.column("text_b"))
            both = [t for pair in zip(a, b) for t in pair]
            for begin, end in lexing.blocks([x + y for x, y in zip(a, b)]):
                part = batch.slice(begin, end - begin)
                text, hashed = shingle_sets(both[2 * begin : 2 * end], banding.words)
                size = np.bincount(text >> 1, minlength=end - begin)
                order = np.lexsort((hashed, text >> 1))
                pair, ranked = text[order] >> 1, hashed[order]
                shared = np.bincount(pair[1:][(ranked[1:] == ranked[:-1]) & (pair[1:] == pair[:-1])], minlength=end - begin)
                linked = pa.array((shared > 0) & (100 * shared >= banding.percent * (size - shared)))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(linked)

    return rows


class _Links:
    """Verified links so far and the components they make."""

    def __init__(self, texts: DataFrame, banding: Banding):
        self.texts, self.banding = texts, banding
        self.labels: DataFrame | None = None
        self.tested: DataFrame | None = None

    def labeled(self, rows: DataFrame, node: str, label: str) -> DataFrame:
        if self.labels is None:
            return rows.withColumn(label, F.col(node))
        known = self.labels.select(F.col("node").alias(node), F.col("component").alias("_component"))
        return rows.join(known, node, "left").withColumn(label, F.coalesce("_component", node)).drop("_component")

    def _possible(self) -> Column:
        """Of two components and near enough in size to link."""
        most = F.greatest("n_shingles", "size")
        return (F.col("label") != F.col("pivot_label")) & (100 * F.least("n_shingles", "size") >= self.banding.percent * most)

    def apart(self, bucketed: DataFrame, heads: DataFrame, bucket: str) -> DataFrame:
        """Pairs (a, b) of a bucket's members (node, n_shingles, label) with its heads
        (pivot, size, pivot_label) that may link."""
        joined = bucketed.alias("m").join(heads.alias("h"), (F.col(f"m.{bucket}") == F.col(f"h.{bucket}")) & self._possible())
        return joined.select(F.col("node").alias("a"), F.col("pivot").alias("b"))

    def keyed(self, bucketed: DataFrame, heads: DataFrame, traits: DataFrame) -> DataFrame:
        """Of the pairs of ``apart`` those that share a key (u, v) and whose sketches are near, each at
        the first u they share only. ``traits`` gives us, vs and sketch of a node."""
        members = bucketed.join(traits, "node").alias("m")
        ahead = traits.select(F.col("node").alias("pivot"), *[F.col(c).alias(f"pivot_{c}") for c in ("us", "vs", "sketch")])
        ahead = heads.join(ahead, "pivot").alias("h")
        near = near_sketches("sketch", "pivot_sketch", F.col("n_shingles") + F.col("size"), self.banding)
        first = F.array_intersect("us", "pivot_us")[0] == F.col("m.u")
        joined = members.join(ahead, (F.col("m.u") == F.col("h.u")) & self._possible() & near & F.arrays_overlap("vs", "pivot_vs") & first)
        return joined.select(F.col("m.node").alias("a"), F.col("h.pivot").alias("b"))

    def test(self, pairs: DataFrame) -> None:
        """Verify the pairs (a, b) that were not tested before."""
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b").distinct()
        if self.tested is not None:
            ordered = ordered.join(self.tested, ["a", "b"], "left_anti")
        ordered = staged(ordered, "near-pairs")
        if ordered.isEmpty():
            return
        self.tested = ordered if self.tested is None else self.tested.unionByName(ordered)
        left = self.texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        right = self.texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        read = ordered.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
        edges = staged(read.mapInArrow(_verifier(self.banding), "a bigint, b bigint"), "near-links")
        if not edges.isEmpty():
            self.labels = merged(self.labels, edges)


def near_components(documents: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """Per document row: doc_id, key, n_shingles, least (smallest doc_id of the component), first (the row to stay).

    Of a component's rows the one of smallest doc_id stays, nulls last, then the first.
    Rows without words are components of their own.
    """
    source = documents.select("doc_id", row_key("doc_id", "text").alias("key"), "text")
    signed = source.mapInArrow(_signer(banding), _SIGNED)
    signed = staged(signed.withColumn("row", F.monotonically_increasing_id()), "near-signatures")
    full = signed.filter("n_shingles > 0")
    sets = full.groupBy("fa", "fb", "n_shingles").agg(F.min("row").alias("node"))
    members = staged(full.select("row", "doc_id", "key", "n_shingles", "fa", "fb").join(sets, ["fa", "fb", "n_shingles"]).drop("fa", "fb"), "near-members")
    nodes = members.filter("row = node").select("node", "key", "doc_id", "n_shingles")
    tuples = signed.select(F.col("row").alias("node"), "us").join(nodes.select("node"), "node", "left_semi")

    # Buckets by u alone: a star per bucket settles the clear groups. Its centre is the member
    # that meets most others over all its buckets, as the origin of a group of edited copies does.
    by_u = tuples.select("node", F.explode("us").alias("u"))
    shared = by_u.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    by_u = staged(by_u.join(shared, "u"), "near-buckets")
    weights = by_u.groupBy("node").agg(F.sum("n").alias("weight")).join(nodes.select("node", "n_shingles"), "node")
    weights = staged(weights, "near-weights")
    by_u = by_u.select("node", "u").join(weights, "node")
    wanted = weights.select("node").join(nodes, "node")
    links = _Links(_texts(source, wanted), banding)
    star = by_u.join(_centres(by_u.withColumn("label", F.col("node")), "u"), "u").filter("node != pivot")
    counted = star.groupBy("node", "pivot").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("node").agg(F.max(F.struct("n", (-F.col("pivot")).alias("p"))).alias("best"))
    links.test(best.select(F.col("node").alias("a"), (-F.col("best.p")).alias("b")))
    open_u = staged(_open(links.labeled(by_u, "node", "label"), "u"), "near-open")
    links.test(links.apart(open_u, _centres(open_u, "u"), "u"))

    # Keys of a u and a v, for members of u-buckets that still hold two components. Buckets close
    # as a whole, so places given once stay in order.
    def still(rows: DataFrame) -> DataFrame:
        """Members of the buckets that hold two components, with label."""
        return staged(_open(links.labeled(rows, "node", "label"), "u"), "near-open")

    traits = signed.select(F.col("row").alias("node"), "us", "vs", "sketch")
    traits = staged(traits.join(open_u.select("node").distinct(), "node"), "near-traits")
    place = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("weight"), "node"))
    buckets = still(open_u.select("node", "u", "n_shingles", place.alias("place")))
    pivots, upto = banding.pivots, banding.pivots
    while not buckets.isEmpty():
        heads = buckets.filter(F.col("place") <= upto)
        links.test(links.keyed(buckets, heads.select("u", F.col("node").alias("pivot"), F.col("n_shingles").alias("size"), F.col("label").alias("pivot_label")), traits))
        # A pivot has met all of its bucket; the others go on while they are of two components.
        buckets = still(buckets.filter(F.col("place") > upto).drop("label"))
        pivots *= banding.growth
        upto += pivots

    grouped = links.labeled(members, "node", "component")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    least = grouped.groupBy("component").agg(F.min("doc_id").alias("least"), F.min(order).alias("one"))
    grouped = grouped.join(least, "component").select("doc_id", "key", "n_shingles", "least", (F.col("row") == F.col("one.row")).alias("first"))
    alone = signed.filter("n_shingles = 0").select("doc_id", "key", "n_shingles", F.col("doc_id").alias("least"), F.lit(True).alias("first"))
    return grouped.unionByName(alone)


def _open(rows: DataFrame, bucket: str) -> DataFrame:
    """Rows (with ``label``) of buckets that hold two labels or more."""
    mixed = rows.groupBy(bucket).agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).filter("_lo != _hi").select(bucket)
    return rows.join(mixed, bucket)


def _centres(rows: DataFrame, bucket: str) -> DataFrame:
    """Of each bucket the member of most weight: pivot, size and label."""
    most = F.max(F.struct("weight", (-F.col("node")).alias("m"), "n_shingles", "label")).alias("c")
    found = rows.groupBy(bucket).agg(most)
    return found.select(bucket, (-F.col("c.m")).alias("pivot"), F.col("c.n_shingles").alias("size"), F.col("c.label").alias("pivot_label"))


def _texts(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, text of the wanted nodes; rows that are alike in doc_id and text give one."""
    keys = wanted.select("node", F.col("key.a").alias("ka"), F.col("key.b").alias("kb"))
    read = source.select(F.col("key.a").alias("ka"), F.col("key.b").alias("kb"), "text").join(keys, ["ka", "kb"])
    return staged(read.select("node", "text"), "near-texts").dropDuplicates(["node"])


def minhash_dedup(documents: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id, kept.

    A set is the distinct lower-case (A-Z) ``words``-word shingles; with fewer words the
    whole sequence is the one shingle. Documents link at ``percent`` similarity;
    component_id is the smallest doc_id reachable, kept says doc_id = component_id.
    Null texts and texts without words have empty sets and link with nothing. Rows that
    repeat a doc_id are documents of their own; a null doc_id counts as larger than any
    other. Other columns are not read; an empty table gives no rows.
    """
    found = near_components(documents, banding)
    return found.select("doc_id", "n_shingles", F.col("least").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("least")).alias("kept"))


def without_near_copies(documents: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """``documents`` with one row of each component (smallest doc_id, then first row), columns unchanged."""
    found = near_components(documents.select("doc_id", "text"), banding)
    chosen = found.filter("first").groupBy("key").agg(F.count(F.lit(1)).alias("_near_rows")).withColumnRenamed("key", "_near_key")
    # Rows alike in doc_id and text are told apart by number; texts without words may stay several times.
    keyed = documents.withColumn("_near_key", row_key("doc_id", "text")).join(chosen, "_near_key")
    twin = F.row_number().over(Window.partitionBy("_near_key").orderBy(F.xxhash64(*documents.columns)))
    return keyed.withColumn("_near_twin", twin).filter("_near_twin <= _near_rows").select(*documents.columns)
