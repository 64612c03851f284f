"""Exact n-gram Jaccard self-join of documents with a token-group matrix.

1. Equal shingle sets are one class, counted once from here on.
2. Classes that share a token of their prefixes meet in that token's list; each takes its
   most frequent list head of about its own size, and verified pairs form groups of
   similar documents.
3. Each group stores the union of its tokens as a row of bits. A class q of one group
   that shares a prefix token with another group can only have a partner there if its
   overlap with the union may reach 0.8 |q|; only such groups are opened, and only their
   members with the same bound are verified, the most promising one first.

A pair with Jaccard similarity of t or more shares a token of the first
n - ceil(t n) + 1 tokens of both sets in any common order. Of the two, the smaller set has
it among its first n - ceil(2 t / (1 + t) n) + 1 ones, its early tokens, for the pair must
share at least as much as two sets of the smaller size. So two classes that both have a token
late don't ask each other: texts that a common passage fills by four fifths, too little for a
link, share its lists in great numbers. Tokens found frequent come last in the order, so that
common passages make few lists. The order only decides how much work there is, never the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.components import components
from mercato.llm.shared import arrow_batches, read, shuffle_partitions, small, stored, text_of, tidy
from mercato.llm.shingles import class_id, shingles

THRESHOLD = 80  # percent
# Tokens seen in LOCAL of the classes counted together are reported, and those with so many reports
# in all come last in the order, up to MAX_FREQUENT of them (8 bytes each, broadcast).
LOCAL, FREQUENT, MAX_FREQUENT = 3, 12, 1 << 18
SALTS = 32  # parts of a frequent token's list
TOGETHER = 3_000_000  # tokens counted together
STAR_ROUNDS = 2  # at most so many rounds of growing groups before the rest is opened
BLOCK = 64  # classes that share a union
BITS = 2  # bits per token in the unions


def least_overlap(n: int) -> int:
    """Tokens that a set of n tokens must share with any partner."""
    return -(-THRESHOLD * n // 100)


def least_of_smaller(n: int) -> int:
    """Tokens that a set of n tokens must share with any partner of its size or larger."""
    return -(-2 * THRESHOLD * n // (100 + THRESHOLD))


def reaches(common: Column, a: Column, b: Column) -> Column:
    return (100 + THRESHOLD) * common >= THRESHOLD * (a + b)


def promise() -> Column:
    """How similar a pair within bounds may be."""
    return F.col("bound") / (F.col("n_a") + F.col("n_b"))


def linkable(a: Column, b: Column) -> Column:
    """Sizes alone allow a link."""
    return 100 * F.least(a, b) >= THRESHOLD * F.greatest(a, b)


# Bits


def bit_row(tokens: np.ndarray) -> bytes:
    """A power of two of bits, at least BITS per token; token t sets the bit t mod size."""
    size = max(64, 1 << int(BITS * len(tokens) - 1).bit_length())
    row = np.zeros(size, bool)
    row[(tokens & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(row, bitorder="little").tobytes()


def folded(row: np.ndarray, size: int) -> np.ndarray:
    """The bits that the same tokens set in a row of ``size`` bytes."""
    return np.bitwise_or.reduce(row.reshape(-1, size), axis=0) if len(row) > size else row


def outside(row: bytes, union: bytes) -> int:
    """A lower bound of the tokens of ``row`` that the union lacks."""
    a, b = np.frombuffer(row, np.uint8), np.frombuffer(union, np.uint8)
    size = min(len(a), len(b))
    a, b = folded(a, size), folded(b, size)
    return int(np.bitwise_count(a & ~b).sum())


# Steps


def features(docs: DataFrame, words: int) -> DataFrame:
    """A row (doc_id, cls, n, bits) per document; rows (token, count) of frequent tokens."""

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        new: list[np.ndarray] = []
        for batch in small(batches):
            ids, sizes, classes, bits = batch.column(0).to_pylist(), [], [], []
            for text in batch.column(1).to_pylist():
                tokens = shingles(text, words)
                cls = class_id(tokens)
                sizes.append(len(tokens))
                classes.append(cls)
                first = cls not in seen
                bits.append(bit_row(tokens) if first and len(tokens) else None)
                if first:
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(cls)
                    new.append(tokens)
            yield _feature_rows(ids, classes, sizes, bits, [], [])
            if sum(map(len, new)) > TOGETHER:
                yield _frequent_rows(new)
        yield _frequent_rows(new)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        tidy(shingle), "doc_id long, cls long, n long, bits binary, token long, count long"
    )


def _frequent_rows(sets: list[np.ndarray]) -> pa.RecordBatch:
    """The tokens that at least LOCAL of the sets have. The sets are given up, to save memory."""
    tokens = np.concatenate([*sets, np.zeros(0, np.uint64)])
    sets.clear()
    tokens.sort()
    found = np.unique(tokens[LOCAL - 1 :][tokens[LOCAL - 1 :] == tokens[: len(tokens) - LOCAL + 1]])
    counts = np.searchsorted(tokens, found, "right") - np.searchsorted(tokens, found)
    none = [None] * len(found)
    return _feature_rows(none, none, none, none, found.view(np.int64), counts)


def _feature_rows(ids, classes, sizes, bits, tokens, counts) -> pa.RecordBatch:
    n = len(ids)
    columns = (ids, classes, sizes, bits, tokens if len(tokens) else [None] * n, counts if len(counts) else [None] * n)
    names = ("doc_id", "cls", "n", "bits", "token", "count")
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.binary() if k == "bits" else pa.int64()) for c, k in zip(columns, names)],
        names=list(names),
    )


def frequent_tokens(found: DataFrame) -> np.ndarray:
    """The most frequent tokens, sorted; at most MAX_FREQUENT of them reach the driver."""
    tokens = (
        found.filter("token IS NOT NULL")
        .groupBy("token")
        .agg(F.sum("count").alias("n"))
        .filter(F.col("n") >= FREQUENT)
        .orderBy(F.desc("n"), "token")
        .limit(MAX_FREQUENT)
        .select("token")
        .toArrow()
    )
    return np.sort(tokens["token"].to_numpy().astype(np.int64).view(np.uint64))


def postings(docs: DataFrame, words: int, frequent: np.ndarray) -> DataFrame:
    """(token, salt, n, cls, early) for the prefix tokens of every class; salt -1: not frequent."""
    late = docs.sparkSession.sparkContext.broadcast(frequent)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        often = late.value
        for batch in small(batches):
            out: list[tuple[np.ndarray, ...]] = []
            for text in batch.column(0).to_pylist():
                tokens = shingles(text, words)
                n, cls = len(tokens), class_id(tokens)
                if not n or cls in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(cls)
                keep = n - least_overlap(n) + 1
                is_late = np.zeros(n, bool)
                if len(often):
                    at = np.minimum(np.searchsorted(often, tokens), len(often) - 1)
                    is_late = often[at] == tokens
                order = np.concatenate([np.flatnonzero(~is_late), np.flatnonzero(is_late)])[:keep]
                salt = np.where(is_late[order], cls % SALTS, -1)
                early = np.arange(keep) <= n - least_of_smaller(n)
                out.append(
                    (tokens[order].view(np.int64), salt, np.full(keep, n), np.full(keep, cls), early)
                )
            if out:
                token, salt, n, cls, early = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token, pa.int64()), pa.array(salt, pa.int32()),
                     pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(early)],
                    names=["token", "salt", "n", "cls", "early"],
                )

    return docs.select(text_of().alias("text")).mapInArrow(
        tidy(prefixes), "token long, salt int, n long, cls long, early boolean"
    )


def lists(entries: DataFrame) -> DataFrame:
    """Lists of tokens that more than one class has: (token, cls, n, early, head).

    Entries come sorted by token, salt and size and are read as a stream. The head is the
    first class of about the member's size, so the two may be similar by size. Each part
    of a frequent token's list is listed, also where it holds a single class.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows of the last list that the next batch may go on with, and whether it was given out
        kept = np.zeros((0, 5), np.int64)
        given = False
        for batch in batches:
            rows = np.stack(
                [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)], axis=1
            )
            yield from lists_of(np.concatenate([kept, rows]), len(kept) if given else 0)
            rows = np.concatenate([kept, rows])
            last = rows[-1]
            run = (rows[:, 0] == last[0]) & (rows[:, 1] == last[1])
            start = int(np.flatnonzero(~run)[-1]) + 1 if not run.all() else 0
            given = last[1] >= 0 or len(np.unique(rows[start:, 3])) > 1 or (given and start == 0)
            own = rows[start:]
            # the head of the last size and the last row
            heads = _size_class(own[:, 2]) == _size_class(own[-1:, 2])
            kept = np.unique(np.stack([own[heads][0], own[-1]]), axis=0)
            kept = kept[np.lexsort((kept[:, 3], kept[:, 2]))]

    def lists_of(rows: np.ndarray, told: int) -> Iterator[pa.RecordBatch]:
        """``told`` rows at the front were given out before."""
        token, salt, n, cls, early = rows.T
        if not len(token):
            return
        same = (token[1:] == token[:-1]) & (salt[1:] == salt[:-1])
        repeat = np.concatenate([[False], same & (cls[1:] == cls[:-1])])
        new_list = np.concatenate([[True], ~same])
        list_no = np.cumsum(new_list) - 1
        members = np.bincount(list_no, weights=~repeat)
        if told:
            members[0] += 1
        wanted = ((members[list_no] > 1) | (salt >= 0)) & ~repeat
        size = _size_class(n)
        new_head = new_list | np.concatenate([[True], size[1:] != size[:-1]])
        head = cls[np.maximum.accumulate(np.where(new_head, np.arange(len(cls)), 0))]
        wanted[:told] = False
        if wanted.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[wanted]) for x in (token, cls, n, early > 0, head)],
                names=["token", "cls", "n", "early", "head"],
            )

    spark = entries.sparkSession
    return (
        entries.repartition(shuffle_partitions(spark), "token", "salt")
        .sortWithinPartitions("token", "salt", "n", "cls")
        .mapInArrow(tidy(stream), "token long, cls long, n long, early boolean, head long")
    )


def size_class(n: Column) -> Column:
    """Sizes of sets that may link are in one class or in neighbouring ones."""
    return F.floor(F.log(F.greatest(n, F.lit(1)).cast("double")) / math.log(100 / THRESHOLD) + 1e-9)


def _size_class(n: np.ndarray) -> np.ndarray:
    """Sizes of one class may be of similar sets."""
    return np.floor(np.log(np.maximum(n, 1)) / np.log(100 / THRESHOLD) + 1e-9)


def within_bound(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and bits allow a link, with ``bound``, the most they can share."""
    left = bits.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    right = bits.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            most = [
                min(n_a - outside(x, y), n_b - outside(y, x))
                for n_a, n_b, x, y in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)))
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), pa.array(most, pa.int64())],
                names=["a", "b", "n_a", "n_b", "bound"],
            )

    sized = (
        pairs.select("a", "b")
        .join(left, "a")
        .join(right, "b")
        .filter(linkable(F.col("n_a"), F.col("n_b")))
        .select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    )
    return sized.mapInArrow(tidy(bound), "a long, b long, n_a long, n_b long, bound long").filter(
        reaches(F.col("bound"), F.col("n_a"), F.col("n_b"))
    )


def verified(pairs: DataFrame, docs: DataFrame, owners: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b) that link, by their whole shingle sets.

    The sets are made again from the texts of one document per class.
    """
    pairs = stored(pairs.select("a", "b").distinct(), "pairs")
    wanted = (
        pairs.select(F.col("a").alias("cls"))
        .unionByName(pairs.select(F.col("b").alias("cls")))
        .distinct()
        .join(owners, "cls")
        .select("cls", F.col("owner").alias("of"))
    )

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found, tokens = [], []
            for cls, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = shingles(text, words)
                if class_id(own) == cls:
                    found.append(cls)
                    tokens.append(own.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int64()), pa.array(tokens, pa.binary())], names=["cls", "tokens"]
            )

    sets = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
        .join(wanted, F.col("doc_id").eqNullSafe(F.col("of")))
        .select("cls", "text")
        .mapInArrow(tidy(sets_of), "cls long, tokens binary")
        .dropDuplicates(["cls"]),
        "sets",
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append((100 + THRESHOLD) * common >= THRESHOLD * len(both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], names=["a", "b"]
            ).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("y"))
    return stored(
        pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(tidy(compare), "a long, b long"),
        "verified",
    )


def with_members(groups: DataFrame) -> DataFrame:
    """A row (grp, cls, members) per class, joined here where rows are few."""
    return groups.join(groups.groupBy("grp").agg(F.count("*").alias("members")), "grp")


def towards_largest(listed: DataFrame, groups: DataFrame, bits: DataFrame) -> DataFrame:
    """For each group the most promising pairs with the largest groups on its lists."""
    in_list = stored(listed.select("token", "cls").join(with_members(groups), "cls"), "matrix")
    largest = in_list.groupBy("token").agg(F.max(F.struct("members", "grp", "cls")).alias("top"))
    pairs = (
        in_list.join(largest, "token")
        .filter(F.col("grp") != F.col("top.grp"))
        .select(F.col("cls").alias("a"), F.col("top.cls").alias("b"))
        .distinct()
    )
    of_a = groups.select(F.col("cls").alias("a"), F.col("grp").alias("of_a"))
    of_b = groups.select(F.col("cls").alias("b"), F.col("grp").alias("of_b"))
    best = Window.partitionBy("of_a", "of_b").orderBy(promise().desc(), "a", "b")
    return (
        within_bound(pairs, bits)
        .join(of_a, "a")
        .join(of_b, "b")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= 2)
    )


def open_groups(listed: DataFrame, groups: DataFrame, bits: DataFrame) -> DataFrame:
    """Pairs (a, b) to verify between groups, with ``other``, the group of b, and the bound.

    The smaller group asks the larger, of equals the one with the smaller number. A list
    holds each group once for each class of sizes, so lists of similar documents don't pair
    up. A class asks only for members of its own class of sizes and the two beside it, for
    a partner is in the same list and in one of these. With a late token it asks only for
    members that have the token early and aren't larger, with an early one for late members
    that aren't smaller: ``early`` is part of the join's key, so late ones never meet.
    """
    sized = with_members(groups)
    in_list = stored(
        listed.select("token", "cls", "n", "early", size_class(F.col("n")).alias("of_size")).join(sized, "cls"),
        "matrix",
    )
    columns = in_list.groupBy(
        "token", F.col("of_size").alias("size"), "early", F.col("grp").alias("other")
    ).agg(F.max("members").alias("others"), F.min("n").alias("least"), F.max("n").alias("most"))
    both = F.array(F.lit(True), F.lit(False))
    asked = (
        in_list.withColumnRenamed("early", "own_early")
        .withColumn("size", F.explode(F.array(*[F.col("of_size") + i for i in (-1, 0, 1)])))
        .withColumn("early", F.explode(F.when(F.col("own_early"), both).otherwise(F.array(F.lit(True)))))
        .join(columns, ["token", "size", "early"])
        .filter(F.col("own_early") | (F.col("least") <= F.col("n")))
        .filter(F.col("early") | (F.col("most") >= F.col("n")))
        .filter(
            (F.col("others") > F.col("members"))
            | ((F.col("others") == F.col("members")) & (F.col("other") > F.col("grp")))
        )
        .filter((100 * F.col("n") >= THRESHOLD * F.col("least")) & (100 * F.col("most") >= THRESHOLD * F.col("n")))
        .select("cls", "other", "size")
        .distinct()
    )
    matrix = blocks(sized.join(bits, "cls"))

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            out: list[tuple] = []
            for a, other, n, row, union, members in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if n - outside(row, union) < least_overlap(n):
                    continue
                for m in members:
                    b, size = m["cls"], m["n"]
                    if 100 * min(n, size) < THRESHOLD * max(n, size):
                        continue
                    most = min(n - outside(row, m["bits"]), size - outside(m["bits"], row))
                    if (100 + THRESHOLD) * most >= THRESHOLD * (n + size):
                        out.append((a, b, n, size, most, other))
            columns = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["a", "b", "n_a", "n_b", "bound", "other"]
            )

    return (
        asked.join(bits, "cls")
        .join(matrix, ["other", "size"])
        .select("cls", "other", "n", "bits", "union", "members")
        .mapInArrow(tidy(opened), "a long, b long, n_a long, n_b long, bound long, other long")
    )


def blocks(members: DataFrame) -> DataFrame:
    """(other, size, union, members): groups in blocks of at most about BLOCK classes of like size.

    ``union`` has the bits of all of a block's members.
    """

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            unions = []
            for found in batch.column(1).to_pylist():
                rows = [np.frombuffer(m["bits"], np.uint8) for m in found]
                size = min(map(len, rows))
                unions.append(np.bitwise_or.reduce([folded(r, size) for r in rows]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(unions, pa.binary()), batch.column(1)],
                names=["other", "size", "union", "members"],
            )

    parts = F.ceil(F.col("members") / BLOCK)
    return (
        members.withColumn("part", F.pmod(F.xxhash64("cls"), parts))
        .groupBy(F.col("grp").alias("other"), size_class(F.col("n")).alias("size"), "part")
        .agg(F.collect_list(F.struct("cls", "n", "bits")).alias("members"))
        .select("other", "members", "size")
        .mapInArrow(
            unite, "other long, size long, union binary, members array<struct<cls:long,n:long,bits:binary>>"
        )
    )


def similar_classes(docs: DataFrame, *, words: int = 5) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, cls, n) and pairs (a, b) that connect what is connected.

    The pairs hold a chain for every two classes that any chain of links joins, not each
    pair of a group: a group that is already connected isn't paired up. A group found so
    far is a star around its least class, so that later rounds don't connect it anew.
    """
    with arrow_batches(docs.sparkSession):
        return _similar_classes(docs, words)


def _similar_classes(docs: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    found = stored(features(docs, words), "features")
    rows = found.filter("cls IS NOT NULL").select("doc_id", "cls", "n")
    owners = rows.groupBy("cls").agg(F.min("doc_id").alias("owner"))
    bits = stored(
        found.filter("bits IS NOT NULL").groupBy("cls", "n").agg(F.min("bits").alias("bits")), "bits"
    )
    listed = stored(lists(postings(docs, words, frequent_tokens(found))), "lists")

    # Groups of similar documents. First each class and, of the heads of its lists, the one
    # that leads most classes; then, round by round, each group and the largest groups
    # that it meets. A round takes a row per class or list entry, never a pair of them.
    led = listed.filter("cls <> head").select("cls", "head").distinct()
    heads = (
        led.join(led.groupBy("head").agg(F.count("*").alias("led")), "head")
        .groupBy("cls")
        .agg(F.max(F.struct("led", "head")).alias("best"))
        .select(F.col("cls").alias("a"), F.col("best.head").alias("b"))
    )
    alone = stored(listed.select("cls").distinct(), "listed")

    def groups(links: DataFrame) -> DataFrame:
        return stored(
            alone.join(components(links), F.col("cls") == F.col("node"), "left").select(
                "cls", F.coalesce("component", "cls").alias("grp")
            ),
            "groups",
        )

    def stars(grouped: DataFrame) -> DataFrame:
        return grouped.filter("cls <> grp").select(F.col("cls").alias("a"), F.col("grp").alias("b"))

    grouped = groups(verified(within_bound(heads, bits), docs, owners, words))
    for _ in range(STAR_ROUNDS):
        new = verified(towards_largest(listed, grouped, bits), docs, owners, words)
        if new.isEmpty():
            break
        grouped = groups(stars(grouped).unionByName(new))
    pairs = stored(open_groups(listed, grouped, bits), "opened")
    # The best member of each opened group first, the others only where that didn't connect.
    best = Window.partitionBy("a", "other").orderBy(promise().desc(), "b")
    first = pairs.withColumn("rank", F.row_number().over(best)).filter("rank = 1")
    grouped = groups(stars(grouped).unionByName(verified(first, docs, owners, words)))
    rest = (
        pairs.join(grouped.select(F.col("cls").alias("a"), F.col("grp").alias("of_a")), "a")
        .join(grouped.select(F.col("cls").alias("b"), F.col("grp").alias("of_b")), "b")
        .filter("of_a <> of_b")
    )
    return rows, stars(grouped).unionByName(verified(rest, docs, owners, words))


def joined(docs: DataFrame, *, words: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, cls), one row per row of ``docs``.

    A null or empty text, or one of white space, has no shingles and links with nothing:
    its component is its own id. The component of others is the smallest id reachable
    by links. Null ids can't be smallest; where no document has an id, it is null.
    Repeated rows are copies of one another.
    """
    rows, links = similar_classes(docs, words=words)
    ids = rows.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"))
    parts = ids.join(components(links), F.col("cls") == F.col("node"), "left").select(
        "cls", "least", F.coalesce("component", "cls").alias("component")
    )
    least = parts.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = parts.join(least, "component").select("cls", "component_id")
    return rows.join(of_class, "cls", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "cls",
    )


def class_of(text: Column) -> Column:
    """The class of a text's shingle set."""

    @F.pandas_udf("long")
    def classes(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: class_id(shingles(t))).astype("int64")

    return classes(text)


def op6_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return joined(read(spark, sf_dir, "documents")).drop("cls")
