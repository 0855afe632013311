"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source has a stream: its documents in a repeatable random order, once per epoch.
A prefix of the stream reaches the source's target and is cut into equal blocks. The
exact block quotas of all sources are split recursively between the halves of the
shard range, each split a multivariate-hypergeometric draw; a leaf is the make-up of
one shard. Shards draw disjoint ranges of each source's permuted blocks and shuffle
locally. Everything is a DataFrame expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import boxed, null_safe_join, ranges_for, row_key, running_before, staged, unit_hash, WORD


@dataclass(frozen=True)
class Mix:
    """``weights`` repeat over the sources in code point order; a source gives at most
    ``most_repeats`` times its size; ``blocks_per_shard`` is the mean number of blocks."""

    weights: tuple[int, ...] = (1, 2, 3)
    most_repeats: int = 3
    shards: int = 64
    blocks_per_shard: int = 64
    closing_rounds: int = 2
    seed: int = 17


def sized(documents: DataFrame, row: Column | None = None) -> DataFrame:
    """row (unique), doc_id, key, source, size (words); written once, so row numbers are fixed.

    ``row`` is the caller's number of a row; by default rows are numbered here.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    number = F.monotonically_increasing_id() if row is None else row
    rows = documents.select(number.alias("row"), "doc_id", row_key("doc_id", "source", "text").alias("key"), "source", size.alias("size"))
    return staged(rows, "mix-sizes")


def targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per source: source, source_size, documents, target.

    Targets share the total by weight; those above ``most_repeats`` times their source's
    size stop there and the rest is shared again. The fixed point is target =
    min(level * weight, cap) with one level for all; with sources in order of cap /
    weight, the level is the first that its own source doesn't cap. Windows here run
    over one row per source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    position = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in mix.weights]), (position % len(mix.weights) + 1).cast("int"))
    capped = by_source.withColumn("weight", weight).withColumn("cap", F.col("source_size").cast("double") * mix.most_repeats)
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    leveled = (
        capped.withColumn("place", F.row_number().over(by_ratio))
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weights_left", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("level", (F.col("total") - F.col("caps_before")) / F.col("weights_left"))
    )
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("place", "level"))
    leveled = leveled.withColumn("chosen", F.min(fits).over(everything)["level"])
    target = F.coalesce(F.least(F.col("chosen") * F.col("weight"), F.col("cap")), F.col("cap"))
    return leveled.select("source", "source_size", "documents", target.alias("target"))


def take(sizes: DataFrame, goals: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per document copy in the mix: row, doc_id, key, source, size, epoch, middle.

    A copy is in while the middle of its words lies within the target; then, in a few
    rounds, the copy of each source that best closes the remaining gap is added or taken away.
    """
    wanted = goals.filter("source_size > 0").withColumn("epochs", F.ceil(F.col("target") / F.col("source_size")).cast("int"))
    wanted = wanted.withColumn("ranges", ranges_for(F.col("documents"))).drop("documents")
    held = null_safe_join(sizes.filter("size > 0"), wanted, ["source"])
    copies = held.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)))
    copies = copies.withColumn("u", unit_hash(F.lit(mix.seed), F.col("epoch"), F.col("key")))
    placed = running_before(copies, ["source", "epoch"], [F.col("u"), F.col("key"), F.col("row")], "size", "before", "ranges")
    middle = F.col("epoch") * F.col("source_size") + F.col("before") + F.col("size") / 2
    placed = placed.withColumn("middle", middle).withColumn("inside", F.col("middle") <= F.col("target"))
    placed = placed.withColumn("edge", F.col("epoch") == F.col("epochs") - 1)
    placed = staged(placed.select("row", "doc_id", "key", "source", "size", "epoch", "u", "middle", "inside", "edge", "target"), "mix-copies")

    for _ in range(mix.closing_rounds):
        placed = _closer(placed)
    return placed.filter("inside").select("row", "doc_id", "key", "source", "size", "epoch", "middle")


def _closer(placed: DataFrame) -> DataFrame:
    """Flip, in each source, the copy whose size is nearest the gap, if that narrows the gap."""
    gap = F.first("target") - F.sum(F.when(F.col("inside"), F.col("size")).otherwise(0))
    gaps = placed.groupBy("source").agg(gap.alias("gap"))
    near = null_safe_join(placed, gaps, ["source"]).filter("edge AND inside = (gap < 0)")
    miss = F.abs(F.col("size") - F.abs("gap"))
    best = near.filter(miss < F.abs("gap")).groupBy("source").agg(F.min(F.struct(miss.alias("miss"), "u", "key", "row", "epoch")).alias("best"))
    flips = best.select("source", F.col("best.row").alias("row"), F.col("best.epoch").alias("epoch"), F.lit(True).alias("flip"))
    decided = null_safe_join(placed, flips, ["source", "row", "epoch"], "left")
    return decided.withColumn("inside", F.col("inside") != F.coalesce("flip", F.lit(False))).drop("flip")


def shard_quotas(goals: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Leaves of the splitting tree: source, blocks (of the source in all), shard, first, last (ranks of permuted blocks).

    A row of the tree is a range of shards with one array of quotas, one number per
    source. Each level halves every range at once.
    """
    total = F.sum("target").over(Window.partitionBy())
    blocks = F.greatest(F.lit(1), F.round(F.col("target") * (mix.shards * mix.blocks_per_shard) / total)).cast("bigint")
    listed = goals.filter("target > 0").withColumn("blocks", blocks)
    root = listed.agg(F.array_sort(F.collect_list(F.struct(F.col("source").isNull().alias("last"), "source", "blocks"))).alias("sources"))
    nodes = root.select(
        "sources",
        F.transform("sources", lambda s: s["blocks"]).alias("quota"),
        F.aggregate("sources", F.lit(0).cast("bigint"), lambda a, s: a + s["blocks"]).alias("all_blocks"),
        F.lit(0).alias("lo"),
        F.lit(mix.shards).alias("hi"),
    )
    for _ in range(max(mix.shards - 1, 0).bit_length()):
        nodes = _halved(nodes, mix)
    leaves = nodes.select(F.col("lo").alias("shard"), F.posexplode(F.arrays_zip("sources", "quota")).alias("at", "s"))
    leaves = leaves.select("shard", F.col("s.sources.source").alias("source"), F.col("s.sources.blocks").alias("blocks"), F.col("s.quota").alias("quota"))
    before = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    last = F.sum("quota").over(before)
    return leaves.withColumn("last", last).withColumn("first", F.col("last") - F.col("quota")).filter("quota > 0").drop("quota")


def _halved(nodes: DataFrame, mix: Mix) -> DataFrame:
    """Every range of two shards or more becomes its two halves; a single shard stays."""
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")

    def slots(until: Column) -> Column:
        return F.floor(until * F.col("all_blocks") / mix.shards)

    split = nodes.withColumn("mid", middle).withColumn("room", (slots(F.col("mid")) - slots(F.col("lo"))).cast("bigint"))
    start = F.struct(
        F.col("room").alias("room"),
        F.aggregate("quota", F.lit(0).cast("bigint"), lambda a, q: a + q).alias("urn"),
        F.array().cast("array<bigint>").alias("drawn"),
    )

    def draw(state: Column, item: Column) -> Column:
        got = _hypergeometric(state["urn"], state["room"], item["quota"], [F.lit(mix.seed), F.col("lo"), F.col("hi"), item["at"]])
        return F.struct(
            (state["room"] - got).alias("room"), (state["urn"] - item["quota"]).alias("urn"), F.concat(state["drawn"], F.array(got)).alias("drawn")
        )

    numbered = F.transform("quota", lambda q, i: F.struct(q.alias("quota"), i.alias("at")))
    split = split.withColumn("left", F.aggregate(numbered, start, draw, lambda s: s["drawn"]))
    half = F.struct(F.col("lo"), F.col("mid").alias("hi"), F.col("left").alias("quota"))
    rest = F.struct(F.col("mid").alias("lo"), F.col("hi"), F.zip_with("quota", "left", lambda q, d: q - d).alias("quota"))
    whole = F.struct("lo", "hi", "quota")
    children = F.when(F.col("hi") - F.col("lo") > 1, F.array(half, rest)).otherwise(F.array(whole))
    return split.select("sources", "all_blocks", F.explode(children).alias("n")).select("sources", "all_blocks", "n.*")


def _hypergeometric(urn: Column, room: Column, quota: Column, seed: list[Column]) -> Column:
    """How many of ``quota`` blocks fall among the ``room`` places drawn out of ``urn``: one exact draw per block."""
    turns = F.when(quota > 0, F.sequence(F.lit(1).cast("bigint"), quota)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(
        turns,
        F.lit(0).cast("bigint"),
        lambda got, i: got + F.when(unit_hash(*seed, i) * (urn - i + 1) < room - got, 1).otherwise(0),
    )


def mix_sources(documents: DataFrame, mix: Mix = Mix(), row: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes, goals, copies): all rows with their words, targets by source, and one row per document copy taken.

    ``copies`` has row, doc_id, key, source, size, epoch, shard and shuffle_key; reading a
    shard in the order of shuffle_key is the local shuffle. Null text has size 0 and is
    never taken; a null source is a source of its own, last in order; rows that repeat a
    doc_id or a text are documents of their own; other columns are not read. An empty
    table, or one without words, gives no copies. Reruns agree, however rows are stored:
    choices follow hashes of the contents, and only identical rows are interchangeable.
    """
    sizes = sized(documents, row)
    goals = staged(targets(sizes, mix), "mix-targets")
    quotas = staged(shard_quotas(goals, mix), "mix-quotas")
    ranked = Window.partitionBy("source").orderBy(unit_hash(F.lit(mix.seed + 1), F.col("source"), F.col("block")), "block")
    totals = quotas.select("source", "blocks").dropDuplicates(["source"])
    permuted = totals.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).withColumn("rank", F.row_number().over(ranked) - 1)
    owned = quotas.withColumn("rank", F.explode(F.sequence("first", F.col("last") - 1))).select("source", "rank", "shard")
    blocks = null_safe_join(permuted.select("source", "block", "rank"), owned, ["source", "rank"]).select("source", "block", "shard")
    copies = take(sizes, goals, mix)
    widths = null_safe_join(totals, goals.select("source", "target"), ["source"])
    placed = null_safe_join(copies, widths, ["source"])
    block = F.least(F.floor(F.col("middle") * F.col("blocks") / F.col("target")), F.col("blocks") - 1)
    placed = null_safe_join(placed.withColumn("block", block), blocks, ["source", "block"])
    copies = placed.select(
        "row", "doc_id", "key", "source", "size", "epoch", "shard", F.xxhash64(F.lit(mix.seed + 2), "shard", "key", "epoch").alias("shuffle_key")
    )
    return sizes, goals, copies


def mix_report(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per document row: doc_id, size, source_size, target, taken (words, repeats counted), shards (in which it occurs)."""
    sizes, goals, copies = mix_sources(documents, mix)
    per_row = copies.groupBy("row").agg(F.sum("size").alias("taken"), F.array_sort(F.collect_set("shard")).alias("shards"))
    rows = null_safe_join(sizes, goals, ["source"]).join(per_row, "row", "left")
    taken = F.coalesce("taken", F.lit(0)).cast("bigint")
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"), F.coalesce("shards", F.array().cast("array<int>")).alias("shards"))


def _placed(documents: DataFrame, mix: Mix) -> DataFrame:
    """document, shard and shuffle_key of every copy taken."""
    base = staged(boxed(documents, row=F.monotonically_increasing_id()), "mix-documents")
    copies = mix_sources(base.select("row", "document.doc_id", "document.source", "document.text"), mix, F.col("row"))[2]
    return base.join(copies.select("row", "shard", "shuffle_key", "epoch"), "row")


def mixed(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The rows of ``documents`` the mix takes, once per copy, columns unchanged."""
    return _placed(documents, mix).select("document.*")


def write_shards(documents: DataFrame, path: str, mix: Mix = Mix()) -> None:
    """Write the mix below ``path``, a folder ``mix_shard=N`` for each output shard.

    Shards hold disjoint blocks of every source by its quota; a shard's files, in order of
    their names, hold its copies in shuffled order.
    """
    copies = _placed(documents, mix)
    clash = [c for c in documents.columns if c.lower() == "mix_shard"]
    if clash:
        raise ValueError(f"a column {clash[0]} would be taken for the shard")
    dealt = copies.repartitionByRange(F.col("shard"), F.col("shuffle_key")).sortWithinPartitions("shard", "shuffle_key", "row", "epoch")
    dealt.select("document.*", F.col("shard").alias("mix_shard")).write.partitionBy("mix_shard").mode("overwrite").parquet(path)
