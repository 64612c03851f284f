"""Removal of repeated byte stretches with a logarithmic family of suffix arrays.

A stretch of ``length`` bytes that starts in two places is removed in both. Every
stretch has an anchor: the leftmost of its least k-byte substrings, by hash. Equal
stretches have equal anchors at equal offsets, so only the surroundings of anchors that
occur more than once need be compared, and those of one anchor meet in one partition.

There, surroundings arrive in batches. The suffixes of a batch that are long enough make
a suffix array, ordered by a fingerprint of their first ``length`` bytes, for only equal
stretches have to become neighbours. It is merge-scanned against the arrays of the levels
so far; what is met twice is reported on both sides, what is new becomes a level, and
levels of about equal size are merged, so there are logarithmically many.

Equal texts are one class, and equal surroundings are one entry with its count, so that
many copies cost no more than a few.

With ``words`` the units are words, hashed, in place of bytes: a stretch is ``length`` words,
whatever white space is between them. Places and spans count words then.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.shingles import mix
from mercato.llm.shared import broadcast_if_small, read, shuffle_partitions, small, stored, text_of, tidy

_U = np.uint64
SEED = 32  # k, bytes of an anchor
WORD_SEED = 12  # words of an anchor
BASE = _U(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(400).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
BUFFER = 1 << 18  # bytes hashed at a time
ENTRIES = 10_000  # surroundings of an anchor that one task compares
_SPACE = np.isin(np.arange(256), [*range(9, 14), 32])


def power(n: int) -> np.uint64:
    return _U(pow(int(BASE), n, 1 << 64))


def rolling(data: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all substrings of ``length`` bytes or hashed words, from powers of two."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    part, size, done = _BYTE[data] if data.dtype == np.uint8 else data, 1, 0
    out = None
    left = length
    while True:
        if left & size:
            # the stretch's bytes done .. done + size, read from the right end
            at = length - done - size
            piece = part[at : at + n] * power(done)
            out = piece if out is None else out + piece
            done += size
        if done == length:
            break
        part = part[:-size] * power(size) + part[size:]
        size *= 2
    return mix(out)


def split_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end in bytes of each word."""
    edges = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[data], [True]])))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    longest = int((ends - starts).max())
    powers = np.multiply.accumulate(np.full(longest, BASE))
    inside = np.flatnonzero(~_SPACE[data])
    sizes = ends - starts
    begin = np.cumsum(sizes) - sizes
    terms = _BYTE[data[inside]] * powers[np.arange(len(inside)) - np.repeat(begin, sizes)]
    return mix(np.add.reduceat(terms, begin)), starts, ends


def units(texts: list[bytes], words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Bytes or hashed words of all texts, and where each text ends among them."""
    if not words:
        return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    data, starts, _ = split_words(np.frombuffer(b" ".join(texts), np.uint8))
    return data, np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))


def anchors(data: np.ndarray, ends: np.ndarray, length: int, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """Anchors of the stretches of concatenated texts that end at ``ends``.

    Returns for each anchor the text's number, the first and the last stretch start that
    it stands for (in ``data``), and its hash.
    """
    window = length - seed + 1
    hashes = rolling(data, seed)
    n = len(data) - length + 1
    empty = np.zeros(0, np.int64)
    if n <= 0:
        return empty, empty, empty, empty
    keys = (hashes >> _U(32) << _U(32)) | np.arange(len(hashes), dtype=np.uint64)
    full = -(-len(keys) // window) * window
    padded = np.full(full, ~_U(0))
    padded[: len(keys)] = keys
    grid = padded.reshape(-1, window)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(after[:n], before[window - 1 : window - 1 + n]) & _U(0xFFFFFFFF)
    starts = np.arange(n)
    text = np.searchsorted(ends, starts, side="right")
    inside = starts + length <= ends[text]
    starts, text, place = starts[inside], text[inside], least[inside].astype(np.int64)
    if not len(starts):
        return empty, empty, empty, empty
    new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([new[1:], [len(starts)]]) - 1
    return text[new], starts[new], starts[last], hashes[place[new]].view(np.int64)


def content_class(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of the intervals as maximal runs."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    first = np.flatnonzero(new)
    return starts[first], ends[np.concatenate([first[1:], [len(starts)]]) - 1]


class SuffixLevels:
    """The logarithmic family: sorted arrays of distinct suffix fingerprints.

    Each entry keeps the surroundings and offset of its first appearance and whether
    that one has been reported.
    """

    def __init__(self) -> None:
        self.levels: list[list[np.ndarray]] = []

    def add(
        self, keys: np.ndarray, owner: np.ndarray, offset: np.ndarray, told: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Scan a batch against the family, then take it in.

        ``told`` marks suffixes that need no report. Returns (owner, offset) of suffixes
        found repeated: of the batch, and of earlier ones that hadn't been reported.
        """
        order = np.argsort(keys, kind="stable")
        keys, owner, offset, told = keys[order], owner[order], offset[order], told[order]
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
        group = np.cumsum(first) - 1
        repeated = np.bincount(group) > 1
        heads = np.flatnonzero(first)
        distinct = keys[heads]
        fresh = np.ones(len(heads), bool)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for level in self.levels:
            at = np.minimum(np.searchsorted(level[0], distinct), len(level[0]) - 1)
            hit = level[0][at] == distinct
            repeated |= hit
            fresh &= ~hit
            late = at[hit][~level[3][at[hit]]]
            found.append((level[1][late], level[2][late]))
            level[3][late] = True
        tell = repeated[group] & ~told
        found.append((owner[tell], offset[tell]))
        new = heads[fresh]
        if len(new):
            # a repeated suffix of the batch has been reported everywhere it is
            self.levels.append([keys[new], owner[new], offset[new], told[new] | repeated[fresh]])
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            b, a = self.levels.pop(), self.levels.pop()
            both = [np.concatenate(c) for c in zip(a, b)]
            order = np.argsort(both[0], kind="stable")
            self.levels.append([c[order] for c in both])
        return tuple(np.concatenate(c) for c in zip(*found))


# Steps


def profiles(docs: DataFrame, length: int, words: bool) -> DataFrame:
    """A row (doc_id, cls, size, sha256) per document, rows (cls, first, last, hash) per anchor."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in small(batches):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            classes, sizes, digests = [], [], []
            waiting: list[tuple[int, bytes]] = []
            held = 0
            for text in texts:
                data = text.encode()
                cls = content_class(data)
                classes.append(cls)
                sizes.append(len(data.split()) if words else len(data))
                digests.append(hashlib.sha256(data).hexdigest())
                if sizes[-1] >= length and cls not in seen:
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(cls)
                    waiting.append((cls, data))
                    held += len(data)
                    if held >= BUFFER:
                        yield _anchor_rows(waiting, length, words)
                        waiting, held = [], 0
            if waiting:
                yield _anchor_rows(waiting, length, words)
            none = [None] * len(ids)
            yield _profile_rows(ids, classes, sizes, digests, none, none, none)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        tidy(scan),
        "doc_id long, cls long, size long, sha256 string, first long, last long, hash long",
    )


def _profile_rows(*columns) -> pa.RecordBatch:
    names = ("doc_id", "cls", "size", "sha256", "first", "last", "hash")
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.string() if k == "sha256" else pa.int64()) for c, k in zip(columns, names)],
        names=list(names),
    )


def _anchor_rows(texts: list[tuple[int, bytes]], length: int, words: bool) -> pa.RecordBatch:
    data, ends = units([t for _, t in texts], words)
    text, first, last, hashes = anchors(data, ends, length, WORD_SEED if words else SEED)
    base = np.concatenate([[0], ends[:-1]])[text]
    classes = np.array([c for c, _ in texts], np.int64)[text]
    none = [None] * len(text)
    return _profile_rows(none, classes, none, none, first - base, last - base, hashes)


def surroundings(docs: DataFrame, found: DataFrame, owners: DataFrame, length: int, words: bool) -> DataFrame:
    """(cls, first, last, hash, entry, bytes) of anchors that occur more than once.

    ``entry`` is a hash of the surroundings, whose bytes each task gives once.
    """
    marks = found.filter("hash IS NOT NULL").select("cls", "first", "last", "hash")
    place = F.struct("cls", "first")
    often = marks.groupBy("hash").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter("a <> b").select("hash")
    # Stored, so that both sides of the join come straight out of a shuffle, which Spark
    # splits where an anchor is very frequent.
    often = stored(often, "often")
    wanted = (
        marks.join(often, "hash")
        .distinct()
        .groupBy("cls")
        .agg(F.sort_array(F.collect_list(F.struct("first", "last", "hash"))).alias("marks"))
        .join(owners, "cls")
    )
    wanted = stored(wanted.select("cls", "marks", F.col("owner").alias("of")), "anchors")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in small(batches):
            out: list[tuple] = []
            for cls, marks, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                data = text.encode()
                if content_class(data) != cls:
                    continue
                if words:
                    _, starts, ends = split_words(np.frombuffer(data, np.uint8))
                for mark in marks:
                    at, to = mark["first"], mark["last"] + length
                    around = data[starts[at] : ends[to - 1]] if words else data[at:to]
                    entry = xxhash.xxh3_64_intdigest(around) - (1 << 63)
                    new = entry not in seen
                    if new:
                        if len(seen) > 1_000_000:
                            seen.clear()
                        seen.add(entry)
                    out.append((cls, at, mark["last"], mark["hash"], entry, around if new else None))
                if len(out) > 20_000:
                    yield _cut_rows(out)
                    out = []
            yield _cut_rows(out)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return (
        texts.join(broadcast_if_small(wanted), F.col("doc_id").eqNullSafe(F.col("of")))
        .select("cls", "marks", "text")
        .mapInArrow(tidy(cut), "cls long, first long, last long, hash long, entry long, bytes binary")
    )


def _cut_rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ("cls", "first", "last", "hash", "entry", "bytes")
    columns = list(zip(*rows)) if rows else [()] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.binary() if k == "bytes" else pa.int64()) for c, k in zip(columns, names)],
        names=list(names),
    )


def repeats(entries: DataFrame, length: int, words: bool) -> DataFrame:
    """(entry, low, high): stretch starts of an entry that also occur in another entry.

    ``entries`` has (hash, entry, n, bytes); entries with n > 1 are repeated as a whole
    and only serve as what others are compared with. An anchor with very many entries is
    dealt to several tasks, each of which compares a share of the stretches, by fingerprint.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = SuffixLevels()
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                around = part.column(2).to_pylist()
                data, ends = units(around, words)
                sizes = np.diff(ends, prepend=0)
                count = sizes - length + 1
                begin = np.cumsum(sizes) - sizes
                own = np.repeat(np.arange(len(around)), count)
                offset = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
                keys = rolling(data, length)[begin[own] + offset]
                entry = part.column(0).to_numpy()
                whole = part.column(1).to_numpy() > 1
                shares = part.column(3).to_numpy()
                if shares.max() > 1:
                    mine = keys % shares[own].astype(_U) == part.column(4).to_numpy()[own].astype(_U)
                    keys, own, offset = keys[mine], own[mine], offset[mine]
                    if not len(keys):
                        continue
                owner, offset = family.add(
                    keys, entry[own], offset.astype(np.int32), whole[own]
                )
                if len(owner):
                    yield _repeat_rows(owner, offset)

    spark = entries.sparkSession
    many = entries.groupBy("hash").agg(F.ceil(F.count("*") / ENTRIES).alias("shares")).filter("shares > 1")
    dealt = (
        entries.join(stored(many, "many"), "hash", "left")
        .withColumn("shares", F.coalesce("shares", F.lit(1)))
        .withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))
    )
    return (
        dealt.repartition(shuffle_partitions(spark), "hash", "share")
        .select("entry", "n", "bytes", "shares", "share")
        .mapInArrow(tidy(compare), "entry long, low long, high long")
    )


def _repeat_rows(owner: np.ndarray, offset: np.ndarray) -> pa.RecordBatch:
    """Runs of neighbouring offsets of an entry."""
    order = np.lexsort((offset, owner))
    owner, offset = owner[order], offset[order].astype(np.int64)
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (offset[1:] > offset[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(owner)]]) - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(owner[first]), pa.array(offset[first]), pa.array(offset[last])],
        names=["entry", "low", "high"],
    )


def repeated_spans(
    docs: DataFrame, *, length: int = 400, words: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, cls, size, sha256) and (cls, spans) of classes with repeats.

    ``spans`` are intervals of bytes or words that may overlap; a class of several documents is
    repeated as a whole if it is long enough.
    """
    found = stored(profiles(docs, length, words), "profiles")
    rows = found.filter("size IS NOT NULL").select("doc_id", "cls", "size", "sha256")
    by_class = rows.groupBy("cls").agg(
        F.min("doc_id").alias("owner"), F.count("*").alias("copies"), F.max("size").alias("size")
    )
    cut = stored(surroundings(docs, found, by_class.select("cls", "owner"), length, words), "surroundings")
    entries = (
        cut.select("hash", "entry", "cls", "first", "last", "bytes")
        .groupBy("entry", "hash")
        .agg(
            # different places, not rows: a document may come more than once
            F.when(F.min(F.struct("cls", "first")) != F.max(F.struct("cls", "first")), 2).otherwise(1).alias("n"),
            F.max("bytes").alias("bytes"),
            F.max(F.col("last") - F.col("first")).alias("high"),
        )
    )
    entries = stored(entries, "entries")
    partial = repeats(entries.select("hash", "entry", "n", "bytes"), length, words)
    whole = entries.filter("n > 1").select("entry", F.lit(0).cast("long").alias("low"), "high")
    spans = (
        cut.select("cls", "first", "entry")
        .join(whole.unionByName(partial), "entry")
        .select(
            "cls",
            (F.col("first") + F.col("low")).alias("low"),
            (F.col("first") + F.col("high") + length).alias("high"),
        )
        .distinct()
        .groupBy("cls")
        .agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    )
    copied = by_class.filter((F.col("copies") > 1) & (F.col("size") >= length)).select(
        "cls", F.col("size").alias("all_units")
    )
    spans = (
        spans.join(copied, "cls", "full")
        .select(
            "cls",
            F.when(
                F.col("all_units").isNotNull(),
                F.array(F.struct(F.lit(0).cast("long").alias("low"), F.col("all_units").alias("high"))),
            )
            .otherwise(F.col("spans"))
            .alias("spans"),
        )
    )
    return rows, stored(spans, "spans")


def _kept(data: bytes, spans: list[dict]) -> tuple[bytes, int, int]:
    """The bytes outside the spans, the number removed, and of maximal runs removed."""
    low, high = runs(np.array([s["low"] for s in spans]), np.array([s["high"] for s in spans]))
    at, out = 0, []
    for a, b in zip(low.tolist(), high.tolist()):
        out.append(data[at:a])
        at = b
    out.append(data[at:])
    return b"".join(out), int((high - low).sum()), len(low)


def digest(docs: DataFrame, *, length: int = 400, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row of ``docs``.

    ``carry`` may name ``cls``, the hash of the text, which then comes first.

    Null texts are empty. Repeated rows are copies and so remove each other, if they are
    long enough. Texts shorter than ``length`` bytes are kept as they are.
    """
    rows, spans = repeated_spans(docs, length=length)
    owners = rows.groupBy("cls").agg(F.min("doc_id").alias("of"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            out = []
            for cls, spans, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                data = text.encode()
                if content_class(data) == cls:
                    kept, removed, n = _kept(data, spans)
                    out.append((cls, removed, n, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                names=["cls", "n_removed", "n_spans", "kept"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    changed = (
        texts.join(broadcast_if_small(stored(spans.join(owners, "cls"), "changed")), F.col("doc_id").eqNullSafe(F.col("of")))
        .select("cls", "spans", "text")
        .mapInArrow(tidy(cut), "cls long, n_removed long, n_spans long, kept string")
        .dropDuplicates(["cls"])
    )
    return rows.join(changed, "cls", "left").select(
        *carry,
        "doc_id",
        F.col("size").alias("n_bytes"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept", "sha256").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, *, length: int = 400, words: int | None = None) -> DataFrame:
    """``docs`` with the repeated stretches taken out of ``text``, n_chars counted anew.

    Stretches are those of ``length`` bytes and, where ``words`` is given, those of so many
    words, both looked for in the whole texts. A character cut in two goes with the stretch.
    Rows stay, also those left without text or with a null one, and an empty table gives none.
    Rows that repeat are copies and lose what they share. Other columns keep their values,
    whatever their names.
    """
    of_class = repeated_spans(docs, length=length)[1]
    if words is None:
        of_class = of_class.withColumn("in_words", F.lit(None).cast(of_class.schema["spans"].dataType))
    else:
        in_words = repeated_spans(docs, length=words, words=True)[1]
        of_class = of_class.join(in_words.withColumnRenamed("spans", "in_words"), "cls", "full")

    @F.udf("string", useArrow=True)
    def cut(text, spans, in_words):
        if text is None:
            return None
        data = text.encode()
        found = [{"low": s["low"], "high": s["high"]} for s in spans or ()]
        if in_words:
            _, starts, ends = split_words(np.frombuffer(data, np.uint8))
            found += [{"low": starts[s["low"]], "high": ends[s["high"] - 1]} for s in in_words]
        return _kept(data, found)[0].decode(errors="ignore")

    # The row travels as one value, so its columns may have any names.
    keyed = docs.select(F.struct("*").alias("doc"), content_class_of(text_of()).alias("cls"))
    joined = keyed.join(of_class, "cls", "left")
    changed = F.col("doc.text").isNotNull() & (F.col("spans").isNotNull() | F.col("in_words").isNotNull())
    # Only texts with something to cut go to Python.
    joined = joined.withColumn("cut", cut(F.when(changed, F.col("doc.text")), "spans", "in_words"))
    new = {"text": F.when(changed, F.col("cut")).otherwise(F.col("doc.text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(changed, F.length("cut").cast(kind)).otherwise(F.col("doc.n_chars"))
    return joined.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def content_class_of(text: Column) -> Column:
    @F.pandas_udf("long")
    def classes(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: content_class(t.encode())).astype("int64")

    return classes(text)


def repeated_words(docs: DataFrame, *, words: int = 51) -> DataFrame:
    """(cls, n_repeated_words): words of a text class within repeated stretches of so many words."""
    _, spans = repeated_spans(docs, length=words, words=True)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for spans in batch.column(1).to_pylist():
                low, high = runs(np.array([s["low"] for s in spans]), np.array([s["high"] for s in spans]))
                found.append(int((high - low).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], names=["cls", "n_repeated_words"]
            )

    return spans.mapInArrow(count, "cls long, n_repeated_words long")


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """``digest``, and behind it the words in passages of 51 words and more that repeat.

    Those have often fewer than 400 bytes; they are counted, not removed.
    """
    docs = read(spark, sf_dir, "documents")
    in_words = repeated_words(docs)
    return (
        digest(docs, carry=("cls",))
        .join(in_words, "cls", "left")
        .drop("cls")
        .withColumn("n_repeated_words", F.coalesce("n_repeated_words", F.lit(0).cast("long")))
    )
