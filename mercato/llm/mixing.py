"""Mixing sources to target weights, in whole epochs and permuted blocks.

Rows of a source are dealt by hash into blocks of about ``block_docs`` rows. A source's
target is a number of whole passes over its blocks and a partial pass; each pass visits
the blocks in a permutation of its own, so a source is a line of numbered block draws.
A tree over the output shards splits the sources' draw counts by the multivariate
hypergeometric law: every shard walks from the root to its leaf and so knows, without any
shuffle, which stretch of each line is its own. Stretches are disjoint and add up
exactly. Within a shard rows are ordered by hash.

Sources stay in tables, however many they are: their numbers come from a sort, their targets
from rounds of sums, and the tree splits them in groups, whose totals it splits first. Equal
documents are one class with a count until the end.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.shared import WORD, read, shuffle_partitions, stored, text_of

# Sources whose draws one walk through the tree splits.
GROUP = 10_000
# Blocks of a source whose words one task adds up.
CHUNK = 4096


def numbered_sources(classes: DataFrame) -> DataFrame:
    """(number, source, docs, source_size) from (source, n, size), numbered by code point, null last."""
    spark = classes.sparkSession
    found = classes.groupBy("source").agg(
        F.sum("n").alias("docs"), F.sum(F.col("n") * F.col("size")).alias("source_size")
    )
    missing = F.col("source").isNull()
    ranged = (
        found.repartitionByRange(shuffle_partitions(spark), missing, "source")
        .sortWithinPartitions(missing, "source")
        .select(
            "*",
            F.spark_partition_id().alias("part"),
            # within a task these grow by one
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at"),
        )
    )
    ranged = stored(ranged, "mix-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each task.
    parts = ranged.groupBy("part").agg(F.count("*").alias("in_part"))
    parts = parts.select("part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("first"))
    return ranged.join(parts, "part").select(
        (F.col("first") + F.col("at")).alias("number"), "source", "docs", "source_size"
    )


def with_targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``sources`` with the column target: shares of the total size by cyclic weights.

    None is above ``most`` times the source's size; what a capped source can't take is
    reshared by weight until none is above. Each round finds the share of a unit of weight
    from two sums over the sources and caps those that it would lift above; shares only grow,
    so a capped source stays capped, and the last round caps none. Sums are exact.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    exact = lambda column: column.cast("decimal(38,0)")
    rows = sources.withColumn("weight", weight.cast("long")).withColumn("cap", most * F.col("source_size"))
    total = rows.agg(F.coalesce(F.sum(exact(F.col("source_size"))), F.lit(0))).first()[0]
    left, unit = int(total), None
    while True:
        # A source is capped where the share of the round before would lift it above.
        capped = (
            F.lit(False)
            if unit is None
            else exact(F.lit(str(left))) * F.col("weight") > exact(F.col("cap")) * unit
        )
        sums = rows.agg(
            F.coalesce(F.sum(F.when(capped, exact(F.col("cap")))), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("unit"),
        ).first()
        now = int(total) - int(sums["taken"]), int(sums["unit"])
        if now == (left, unit) or not now[1]:
            break
        left, unit = now
    share = F.lit(float(left)) * F.col("weight") / F.lit(float(unit or 1))
    return rows.select(
        *sources.columns,
        F.when(capped, F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def _shuffles(blocks: int, passes: int, seed: str) -> tuple[list[int], list[int]]:
    """Factor and shift of an affine permutation of the blocks for each pass."""
    draw = random.Random(seed)
    factors, shifts = [], []
    for _ in range(passes):
        factor = draw.randrange(1, blocks + 1)
        while math.gcd(factor, blocks) != 1:
            factor = draw.randrange(1, blocks + 1)
        factors.append(factor)
        shifts.append(draw.randrange(blocks))
    return factors, shifts


def split_draws(
    counts: np.ndarray, shards: int, shard: int, seed: int, group: int = 0, totals: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """First draw and number of draws of each source of a group for one shard.

    A node of the tree covers the shards [low, high) and holds counts by source; its
    left half gets a multivariate hypergeometric sample in proportion to its shards. The
    sample is drawn of the ``totals`` of all groups first and then, with the size that the
    group got, of the group's own counts, which is the same law. Nodes draw from seeds of
    their own, so all shards see the same tree.
    """
    totals = np.array([counts.sum()]) if totals is None else totals
    low, high, first, own = 0, shards, np.zeros_like(counts), counts
    while high - low > 1:
        mid = (low + high) // 2
        size = int(totals.sum()) * (mid - low) // (high - low)
        law = np.random.default_rng([seed, low, high])
        of_group = law.multivariate_hypergeometric(totals, size, method="marginals")
        law = np.random.default_rng([seed, low, high, group + 1])
        left = law.multivariate_hypergeometric(own, int(of_group[group]), method="marginals")
        if shard < mid:
            high, own, totals = mid, left, of_group
        else:
            low, first, own, totals = mid, first + left, own - left, totals - of_group
    return first, own


def _position(epoch: Column, block: str = "block") -> Column:
    """Where the pass ``epoch`` visits the block."""
    factor = F.element_at("factors", (epoch + 1).cast("int"))
    shift = F.element_at("shifts", (epoch + 1).cast("int"))
    return F.pmod(F.col(block) * factor + shift, F.col("blocks"))


def _planned(sources: DataFrame, block_docs: int, seed: int) -> DataFrame:
    """``sources`` with blocks, whole epochs, the rest, and each epoch's permutation."""

    def permuted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [
                _shuffles(int(blocks), int(epochs) + 1, f"{seed}/{number}")
                for number, blocks, epochs in zip(batch["number"], batch["blocks"], batch["epochs"])
            ]
            yield batch.assign(factors=[f for f, _ in made], shifts=[h for _, h in made])

    whole = F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))).cast("int")
    planned = (
        sources.withColumn("blocks", F.ceil(F.col("docs") / block_docs))
        .withColumn("epochs", F.coalesce(whole, F.lit(0)))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
        .select("number", "source", "source_size", "target", "blocks", "epochs", "rest")
    )
    return planned.mapInPandas(
        permuted,
        "number long, source string, source_size long, target double, blocks long, epochs int, "
        "rest double, factors array<long>, shifts array<long>",
    )


def _blocks(dealt: DataFrame) -> DataFrame:
    """Each block's words, place in the partial pass, and whether that takes all or a part of it."""
    placed = (
        dealt.groupBy("number", "block", "blocks", "epochs", "rest", "factors", "shifts")
        .agg(F.sum(F.col("n") * F.col("size")).alias("words"))
        .withColumn("position", _position(F.col("epochs")))
        .withColumn("chunk", F.floor(F.col("position") / CHUNK))
    )
    placed = stored(placed, "mix-block-words")
    in_chunk = Window.partitionBy("number", "chunk").orderBy("position")
    of_source = Window.partitionBy("number").orderBy("chunk")
    chunks = (
        placed.groupBy("number", "chunk")
        .agg(F.sum("words").alias("in_chunk"))
        .withColumn("earlier", F.sum("in_chunk").over(of_source) - F.col("in_chunk"))
        .drop("in_chunk")
    )
    before = F.col("earlier") + F.sum("words").over(in_chunk) - F.col("words")
    return (
        placed.join(chunks, ["number", "chunk"])
        .withColumn("before", before)
        # whole: taken in the partial pass; cut: taken in part
        .withColumn("whole", F.col("before") + F.col("words") <= F.col("rest"))
        .withColumn("cut", ~F.col("whole") & (F.col("before") < F.col("rest")))
        .drop("chunk", "earlier")
    )


def class_draws(
    classes: DataFrame,
    *,
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
    shards: int = 64,
    block_docs: int = 1024,
    seed: int = 0,
) -> DataFrame:
    """What the mix takes of each class (key, source, size, n) of equal documents.

    Rows (key, source, size, n, source_size, target, draws, fits); ``draws`` lists (epoch,
    shard) of each copy of a document. The last of them, in the cut block, goes to ``fits`` of
    the n documents only; elsewhere ``fits`` is null.
    """
    spark = classes.sparkSession
    sources = stored(
        _planned(with_targets(numbered_sources(classes), weights, most), block_docs, seed), "mix-plan"
    )
    of_source = sources.withColumnRenamed("source", "of_source")
    dealt = classes.join(of_source, F.col("source").eqNullSafe(F.col("of_source"))).withColumn(
        "block", F.pmod("key", F.col("blocks"))
    )
    by_block = stored(_blocks(dealt), "mix-blocks")
    partial = F.col("whole") | F.col("cut")
    passes = F.col("epochs") + partial.cast("int")

    group = F.floor(F.col("number") / GROUP).alias("group")
    grouped = stored(
        by_block.groupBy("number")
        # the places of the line, also those of blocks that no document fell into
        .agg(
            (F.max(F.col("epochs") * F.col("blocks")) + F.max(F.when(partial, F.col("position") + 1).otherwise(0))).alias("n")
        )
        .groupBy(group)
        .agg(F.sort_array(F.collect_list(F.struct("number", "n"))).alias("sources"), F.sum("n").alias("total")),
        "mix-draws",
    )
    # A row for every GROUP sources.
    totals = [r["total"] for r in grouped.select("group", "total").orderBy("group").collect()]
    groups = np.array(totals, dtype=np.int64)
    order = grouped.select((F.row_number().over(Window.orderBy("group")) - 1).alias("at"), "sources")

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at, of_group, shard in zip(batch["at"], batch["sources"], batch["shard"]):
                numbers = np.array([r["number"] for r in of_group], np.int64)
                counts = np.array([r["n"] for r in of_group], np.int64)
                first, own = split_draws(counts, shards, int(shard), seed, int(at), groups)
                some = np.flatnonzero(own)
                yield pd.DataFrame(
                    {"number": numbers[some], "shard": int(shard), "first": first[some], "n": own[some]}
                )

    stretches = (
        order.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .repartition("at", "shard")
        .mapInPandas(leaves, "number long, shard int, first long, n long")
    )
    by_draw = stretches.select(
        "number", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("draw")
    )
    drawn = (
        by_block.filter(passes > 0)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), passes - 1)))
        .withColumn("draw", F.col("epoch") * F.col("blocks") + _position(F.col("epoch")))
        .join(by_draw, ["number", "draw"])
        .groupBy("number", "block")
        .agg(F.sort_array(F.collect_list(F.struct("epoch", "shard"))).alias("draws"))
    )

    def fill(of_block: pd.DataFrame) -> pd.DataFrame:
        """The documents of the cut block that fit, in hash order."""
        ordered = of_block.sort_values("key")
        left, fits = float(ordered["room"].iloc[0]), []
        for n, size in zip(ordered["n"].tolist(), ordered["size"].tolist()):
            fits.append(min(n, int(left // size)) if size else n)
            left -= size * fits[-1]
        return ordered[["number", "key"]].assign(fits=fits)

    room = by_block.filter("cut").select("number", "block", (F.col("rest") - F.col("before")).alias("room"))
    kept = (
        dealt.select("number", "block", "key", "n", "size")
        .join(room, ["number", "block"])
        .groupBy("number", "block")
        .applyInPandas(fill, "number long, key long, fits long")
    )
    return (
        dealt.join(drawn, ["number", "block"], "left")
        .join(kept, ["number", "key"], "left")
        .select(
            "key", "source", "size", "n", "source_size", "target",
            F.coalesce("draws", F.array()).alias("draws"), "fits",
        )
    )


def _ranked(rows: DataFrame) -> DataFrame:
    """``rank`` of each (key, id) of a stored table among the rows of its key, from 0.

    Rows are numbered in buckets, whose counts shift the numbers, so no key meets in one task.
    """
    buckets = shuffle_partitions(rows.sparkSession)
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)))
    earlier = Window.partitionBy("key").orderBy("bucket")
    shifts = (
        dealt.groupBy("key", "bucket")
        .agg(F.count("*").alias("rows"))
        .select("key", "bucket", (F.sum("rows").over(earlier) - F.col("rows")).alias("shift"))
    )
    at = F.row_number().over(Window.partitionBy("key", "bucket").orderBy("id"))
    return (
        dealt.withColumn("at", at)
        .join(shifts, ["key", "bucket"])
        .select("key", "id", (F.col("shift") + F.col("at") - 1).alias("rank"))
    )


def _own_draws(rank: Column) -> Column:
    """The draws of the document with that rank in its class."""
    last = F.array_max(F.transform("draws", lambda d: d["epoch"]))
    return F.when(
        F.col("fits").isNotNull() & (rank >= F.col("fits")), F.filter("draws", lambda d: d["epoch"] < last)
    ).otherwise(F.col("draws"))


# Classes of which the cut block takes some documents and leaves others.
PARTLY = "coalesce(fits > 0 AND fits < n, false)"


def row_key(seed: int = 0) -> Column:
    return F.xxhash64(
        F.lit(seed), F.col("doc_id").cast("long"), F.col("source").cast("string"), text_of()
    )


def _rows(docs: DataFrame, seed: int) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"),
        row_key(seed).alias("key"),
        F.monotonically_increasing_id().alias("id"),
    )


def _classes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source", "key").agg(F.max("size").alias("size"), F.count("*").alias("n"))


def draws(docs: DataFrame, *, seed: int = 0, **options) -> DataFrame:
    """What the mix takes of each document.

    Rows (doc_id, size, source, source_size, target, key, draws); ``draws`` lists
    (epoch, shard) of each copy. Size is the number of words (null text: 0). Sources go
    by code point, a null source last and a source like any other. ``key`` is a hash of
    id, source and text, and rows that share it are alike for the mix. The partial pass takes
    whole blocks while they fit, then documents of the next block while they fit, so it
    misses the target by less than a document that it left there. Nothing depends on the
    partitioning, so reruns agree. An empty table gives no rows; other columns are not read.
    Options as in ``class_draws``.
    """
    rows = stored(_rows(docs, seed), "mix-rows")
    taken = stored(class_draws(_classes(rows), seed=seed, **options), "mix-classes")
    of_class = taken.select("key", F.col("source").alias("of_source"), "source_size", "target", "draws", "fits", "n")
    joined = rows.join(
        of_class.withColumnRenamed("key", "of_key"),
        (F.col("key") == F.col("of_key")) & F.col("source").eqNullSafe(F.col("of_source")),
    )
    columns = ("doc_id", "size", "source", "source_size", "target", "key")
    none = F.lit(0)
    out = joined.filter(f"NOT {PARTLY}").select(*columns, _own_draws(none).alias("draws"))
    partly = joined.filter(PARTLY)
    ranks = _ranked(stored(partly.select("key", "id"), "mix-partly"))
    ranked = partly.join(ranks.withColumnRenamed("key", "rank_key"), "id")
    return out.unionByName(ranked.select(*columns, _own_draws(F.col("rank")).alias("draws")))


def mixed(docs: DataFrame, *, seed: int = 0, shard: str | None = None, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row per copy.

    Texts are shuffled once, when they meet what is taken of them. Each task holds its
    copies by shard, shuffled within by hash; with ``shard`` a column of that name tells the
    shard, so that a partitioned write deals them out without another shuffle. Columns of any
    name may come along. Documents that repeat and are taken in part, at the target's edge,
    are told apart by a stored number.
    """
    rows = stored(_rows(docs, seed).drop("id"), "mix-rows")
    taken = stored(class_draws(_classes(rows), seed=seed, **options).drop("source"), "mix-classes")
    wanted = taken.filter(F.size("draws") > 0).select("key", "draws", "fits", "n")
    joined = docs.select(F.struct("*").alias("doc"), row_key(seed).alias("key")).join(wanted, "key")
    copies = joined.filter(f"NOT {PARTLY}").select("doc", "key", _own_draws(F.lit(0)).alias("draws"))
    edge = taken.filter(PARTLY).select("key")
    if not edge.isEmpty():
        partly = stored(
            docs.select(F.struct("*").alias("doc"), row_key(seed).alias("key"))
            .join(edge, "key", "left_semi")
            .withColumn("id", F.monotonically_increasing_id()),
            "mix-partly",
        )
        ranked = partly.join(_ranked(partly.select("key", "id")).drop("key"), "id").join(wanted, "key")
        copies = copies.unionByName(ranked.select("doc", "key", _own_draws(F.col("rank")).alias("draws")))
    dealt = copies.select("doc", "key", F.explode("draws").alias("draw"))
    dealt = dealt.sortWithinPartitions("draw.shard", F.xxhash64("key", "draw.epoch"))
    own = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    return dealt.select(*own, *([F.col("draw.shard").alias(shard)] if shard else []))


def op3_mixing_sources(spark, sf_dir: str) -> DataFrame:
    taken = draws(read(spark, sf_dir, "documents"))
    return taken.select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.size("draws")).cast("long").alias("taken"),
    )
