"""Resharding by minimum-cost flow.

Old shards supply bytes, new shards have capacities; staying in place costs nothing and
a moved byte costs one. The cheapest flow says how many bytes each old shard keeps and
sends where; blocks of documents realise it; only shards that change are rewritten.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import boxed, null_safe_join, row_key, running_before, staged, unit_hash

#: Bytes a document takes beside its text.
OVERHEAD = 16


@dataclass(frozen=True)
class Layout:
    """``repairs`` passes move small documents (at most 1 / ``grain`` of what a shard has too much)
    to even out what whole documents left over."""

    shards: int = 40
    old_shards: int = 32
    repairs: int = 3
    grain: int = 2
    seed: int = 29


class FlowNetwork:
    """Directed edges with capacities and costs; ``solve`` sends all it can at least cost.

    Successive shortest paths with potentials. Networks here have a node per shard and
    a few edges per node, whatever the size of the data.
    """

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.head: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def edge(self, tail: int, head: int, room: int, cost: int) -> int:
        self.out[tail].append(len(self.head))
        self.out[head].append(len(self.head) + 1)
        self.head += [head, tail]
        self.room += [room, 0]
        self.cost += [cost, -cost]
        return len(self.head) - 2

    def flow(self, edge: int) -> int:
        return self.room[edge ^ 1]

    def solve(self, source: int, sink: int) -> int:
        potential = [0] * len(self.out)
        spent = 0
        while True:
            distance: dict[int, int] = {source: 0}
            via: dict[int, int] = {}
            done: set[int] = set()
            queue = [(0, source)]
            while queue:
                d, node = heapq.heappop(queue)
                if node in done:
                    continue
                done.add(node)
                for e in self.out[node]:
                    to = self.head[e]
                    through = d + self.cost[e] + potential[node] - potential[to]
                    if self.room[e] > 0 and through < distance.get(to, through + 1):
                        distance[to], via[to] = through, e
                        heapq.heappush(queue, (through, to))
            if sink not in done:
                return spent
            far = max(distance.values())
            for node in range(len(potential)):
                potential[node] += distance.get(node, far)
            path, node = [], sink
            while node != source:
                path.append(via[node])
                node = self.head[via[node] ^ 1]
            amount = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= amount
                self.room[e ^ 1] += amount
                spent += amount * self.cost[e]


def block_transfers(old_sizes: dict[int, int], capacities: list[int]) -> list[tuple[int, int, int]]:
    """(old shard, new shard, bytes) of a flow that moves the fewest bytes; capacities must hold all.

    Old shard i and new shard i are the same place. Moves cost the same whatever their
    ends, so they pass through one hub and are paired up in order of shard number.
    """
    if sum(capacities) < sum(old_sizes.values()):
        raise ValueError("the capacities are smaller than what there is to place")
    old, n = sorted(old_sizes), len(capacities)
    source, hub, sink = len(old) + n, len(old) + n + 1, len(old) + n + 2
    network = FlowNetwork(sink + 1)
    stays, leaves, arrives = {}, {}, {}
    for i, shard in enumerate(old):
        network.edge(source, i, old_sizes[shard], 0)
        if shard < n:
            stays[shard] = network.edge(i, len(old) + shard, old_sizes[shard], 0)
        leaves[shard] = network.edge(i, hub, old_sizes[shard], 1)
    for j, room in enumerate(capacities):
        arrives[j] = network.edge(hub, len(old) + j, room, 0)
        network.edge(len(old) + j, sink, room, 0)
    network.solve(source, sink)
    transfers = [(s, s, network.flow(e)) for s, e in stays.items() if network.flow(e)]
    wants = [[j, network.flow(e)] for j, e in arrives.items() if network.flow(e)]
    for shard in old:
        left = network.flow(leaves[shard])
        while left:
            amount = min(left, wants[0][1])
            transfers.append((shard, wants[0][0], amount))
            left -= amount
            wants[0][1] -= amount
            if not wants[0][1]:
                wants.pop(0)
    return transfers


def even_capacities(total: int, shards: int) -> list[int]:
    return [(j + 1) * total // shards - j * total // shards for j in range(shards)]


def file_shards(rows: DataFrame, old_shards: int) -> DataFrame:
    """``rows`` with ``old_shard`` for ``file``: the files, in order of name, dealt over the old shards.

    The numbering runs over one row per file. Rows that come from no file share an empty
    name and so a shard.
    """
    number = (F.row_number().over(Window.orderBy("file")) - 1) % old_shards
    files = rows.select("file").distinct().select("file", number.cast("int").alias("old_shard"))
    return null_safe_join(rows, files, ["file"])


def _sizes(rows: DataFrame) -> dict[int, int]:
    """Bytes by shard: one row per shard comes to the driver."""
    return {r[0]: r[1] for r in rows.groupBy("shard").agg(F.sum("size")).collect()}


def _moved(rows: DataFrame, transfers: list[tuple[int, int, int]], limits: dict[int, int] | None, seed: int) -> DataFrame:
    """Rows with ``shard`` changed as the transfers say.

    A shard's rows (those of at most its limit, if there are limits) in hashed order lie on
    a line of bytes; ranges of the line go to the targets, a row with its middle; what lies
    beyond the ranges stays. The table of ranges has one row per shard.
    """
    routes: dict[int, tuple[list[int], list[int]]] = {}
    ends: dict[int, int] = {}
    for old, new, amount in sorted(transfers, key=lambda t: (t[0], t[0] != t[1], t[1])):
        starts, targets = routes.setdefault(old, ([], []))
        starts.append(ends.get(old, 0))
        targets.append(new)
        ends[old] = starts[-1] + amount
    listed = [(old, starts, targets, ends[old], limits[old] if limits else None) for old, (starts, targets) in routes.items()]
    table = rows.sparkSession.createDataFrame(listed, "shard int, starts array<bigint>, targets array<int>, until bigint, limit bigint")
    chosen = rows.join(F.broadcast(table), "shard").filter("limit IS NULL OR size <= limit")
    chosen = chosen.withColumn("u", unit_hash(F.lit(seed), F.col("key"), F.col("row")))
    placed = running_before(chosen, ["shard"], [F.col("u"), F.col("row")], "size", "before")
    middle = F.col("before") + F.col("size") / 2
    place = F.size(F.filter("starts", lambda s: s <= middle))
    moves = placed.filter(middle < F.col("until")).select("row", F.element_at("targets", place).alias("to"))
    return rows.join(moves, "row", "left").withColumn("shard", F.coalesce("to", "shard")).drop("to")


def reshard(
    documents: DataFrame, layout: Layout = Layout(), old_shard: Column | None = None, row: Column | None = None, file: Column | None = None
) -> DataFrame:
    """New place of every document row: row, doc_id, key, size, text_crc32, old_shard, shard, slot.

    Law ``bytes``: shards get near equal bytes (UTF-8 bytes of the text plus ``OVERHEAD``
    per document) and the fewest bytes move. ``old_shard`` gives the old shard of a row;
    where it is null or not given, that follows from ``file``, by default the file the row
    was read from. ``row`` is the caller's number of a row. Null texts count as
    empty; rows that repeat are placed one by one; other columns are not read. An empty
    table gives no rows.
    """
    old = F.lit(None).cast("int") if old_shard is None else old_shard.cast("int")
    file = F.input_file_name() if file is None else file
    number = F.monotonically_increasing_id() if row is None else row
    rows = documents.select(
        number.alias("row"),
        "doc_id",
        row_key("doc_id", "text").alias("key"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        old.alias("given"),
        file.alias("file"),
    )
    rows = file_shards(staged(rows, "shard-rows"), layout.old_shards)
    rows = rows.withColumn("old_shard", F.coalesce("given", "old_shard")).drop("given", "file")
    rows = rows.withColumn("shard", F.col("old_shard"))
    sizes = _sizes(rows)
    rooms = even_capacities(sum(sizes.values()), layout.shards)
    rows = staged(_moved(rows, block_transfers(sizes, rooms), None, layout.seed), "shard-moved")
    for turn in range(layout.repairs):
        sizes = _sizes(rows)
        over = [sizes.get(j, 0) - room for j, room in enumerate(rooms)]
        surplus = {j: x for j, x in enumerate(over) if x > 0}
        if not surplus:
            break
        moves = block_transfers(surplus, [max(0, -x) for x in over])
        limits = {j: x // layout.grain for j, x in surplus.items()}
        rows = staged(_moved(rows, moves, limits, layout.seed + 1 + turn), f"shard-repaired-{turn}")
    order = unit_hash(F.lit(layout.seed), F.col("shard"), F.col("key"), F.col("row"))
    counted = rows.withColumn("u", order).withColumn("one", F.lit(1).cast("bigint"))
    return running_before(counted, ["shard"], [F.col("u"), F.col("row")], "one", "slot").drop("u", "one")


def shard_report(documents: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """Per document row: doc_id, size, text_crc32, law, shard, slot, grown_shard (null), old_shard."""
    return reshard(documents, layout).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard"
    )


def _numbered(documents: DataFrame, label: str, old_shard: Column | None) -> DataFrame:
    """document, row, the file it was read from and its old shard, if given; written once."""
    given = F.lit(None) if old_shard is None else old_shard
    return staged(boxed(documents, row=F.monotonically_increasing_id(), file=F.input_file_name(), given=given.cast("int")), label)


def _places(base: DataFrame, layout: Layout) -> DataFrame:
    inner = base.select("row", "file", "given", "document.doc_id", "document.text")
    return reshard(inner, layout, F.col("given"), F.col("row"), F.col("file")).select("row", "shard", "slot", "old_shard")


def _with_places(joined: DataFrame, columns: list[str]) -> DataFrame:
    kept = [F.col(f"document.`{c}`").alias(c) for c in columns if c.lower() not in ("shard", "slot")]
    return joined.select(*kept, F.col("shard"), F.col("slot"))


def sharded(documents: DataFrame, layout: Layout = Layout(), old_shard: Column | None = None) -> DataFrame:
    """``documents`` with their shard and slot; columns of these names are replaced."""
    base = _numbered(documents, "shard-documents", old_shard)
    return _with_places(base.join(_places(base, layout), "row"), documents.columns)


def rewrite(documents: DataFrame, path: str, layout: Layout = Layout(), old_shard: Column | None = None) -> list[int]:
    """Write the shards that gain or lose documents below ``path`` as ``shard=N``; their numbers.

    Shards whose rows all stay are not written.
    """
    base = _numbered(documents, "rewrite-documents", old_shard)
    places = staged(_places(base, layout), "rewrite-places")
    moved = places.filter("old_shard != shard").select(F.explode(F.array("old_shard", "shard")).alias("shard")).distinct()
    affected = sorted(r[0] for r in moved.collect() if r[0] < layout.shards)
    rows = places.filter(F.col("shard").isin(affected)).select("row", "shard", "slot")
    out = _with_places(base.join(rows, "row"), documents.columns)
    out.repartitionByRange(F.col("shard"), F.col("slot")).sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("overwrite").parquet(path)
    return affected
