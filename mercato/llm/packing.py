"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Only the lengths decide a best-fit-decreasing packing, and there are at most
``capacity`` of them, however many documents there are. So Spark counts pieces per
length, the driver packs the counts (longest first, each piece into the tightest open
bin, found in a segment tree over remaining capacities), and the plan, a list of rank
intervals per length, is joined back to the pieces. Bins of equal remaining capacity are
alike, which lets one step place a whole run of equal pieces.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator
from string import ascii_letters, punctuation

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.shingles import break_mask, runs_of
from mercato.llm.shared import read, shuffle_partitions, small, stored, text_of, tidy, tokenizer_path

BREAKS = break_mask(b" \n")
TOGETHER = 1 << 19  # bytes of texts whose words are looked up together
LONGEST = 64  # bytes of a part that is kept

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_PUNCTUATION = break_mask(punctuation.encode())
_ODD = ~break_mask(ascii_letters.encode() + bytes([0xC3, *range(0x80, 0xC0)]))
_SIGNS = break_mask(bytes([0x97, 0xB7]))  # the multiplication and the division sign, after 0xC3

PIECES = (
    "row long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
)


class _Cache(dict):
    """Packed token ids of parts of texts, learned when first asked for."""

    def __init__(self, learn: Callable[[str], bytes], most: int):
        super().__init__()
        self._learn, self._most = learn, most

    def __missing__(self, part: bytes) -> bytes:
        ids = self._learn(part.decode())
        if len(part) <= LONGEST:
            if len(self) >= self._most:
                self.clear()
            self[part] = ids
        return ids


class _WordIds:
    """Packed token ids of texts, given by the tokenizer.

    No token spans a space or a line feed, so the ids of a text are those of the runs
    between them. A run of Latin letters with ASCII punctuation behind is two parts for
    the tokenizer, the letters in lower case and the rest; the letters go straight to
    its model. Any other run goes through all of it. Runs are cut and lower-cased in the
    bytes of many texts at once, so that the spellings of a word meet before they are looked
    up, each once.
    """

    def __init__(self, file: str, most: int = 100_000, most_letters: int = 200_000):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path(file))
        encode, model = tokenizer.encode, tokenizer.model.tokenize

        def whole(run: str) -> bytes:
            return array("I", encode(run, add_special_tokens=False).ids).tobytes()

        def letters(word: str) -> bytes:
            word = word.lower()
            symbols = word if word.isascii() else word.encode().decode("latin1").translate(BYTES)
            return array("I", [token.id for token in model(symbols)]).tobytes()

        self._letters, self._runs = _Cache(letters, most_letters), _Cache(whole, most)
        # Strings that the tokenizer finds before it lower-cases the text around them.
        added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        self._added = sorted({c.lower().encode() for c in added if c})

    def of(self, texts: list[str]) -> Iterator[bytes]:
        """The packed ids of each text."""
        waiting: list[bytes] = []
        held = 0
        for text in texts:
            waiting.append(text.encode())
            held += len(waiting[-1]) + 1
            if held >= TOGETHER:
                yield from self._together(waiting)
                waiting, held = [], 0
        yield from self._together(waiting)

    def _together(self, texts: list[bytes]) -> Iterator[bytes]:
        """Look up each distinct part of the texts once, then spread the ids."""
        data = b"\n".join(texts)
        low = data.translate(_LOWER)
        if not any(added in low for added in self._added):
            data = low
        codes = np.frombuffer(data, np.uint8)
        run, run_end, sums = runs_of(data, BREAKS)
        # Where the punctuation behind a run begins.
        place = np.arange(1, len(codes) + 1, dtype=np.int32)
        place[_PUNCTUATION[codes]] = 0
        tail = np.maximum(np.maximum.accumulate(place)[run_end - 1], run) if len(run) else run
        # Bytes of anything but ASCII letters and the letters from U+00C0 to U+00FF.
        odd = _ODD[codes]
        odd[1:] |= _SIGNS[codes[1:]] & (codes[:-1] == 0xC3)
        odds = np.concatenate([np.zeros(1, np.int32), np.cumsum(odd, dtype=np.int32)])
        plain = (tail > run) & (odds[tail] == odds[run]) & (run_end - run <= LONGEST)
        cut = plain & (tail < run_end)
        start = np.concatenate([run, tail[cut]])
        end = np.concatenate([np.where(plain, tail, run_end), run_end[cut]])
        kind = np.concatenate([plain, np.zeros(int(cut.sum()), bool)])
        order = np.argsort(start, kind="stable")
        start, end, kind = start[order], end[order], kind[order]
        which, distinct = pd.factorize(sums(start, end))
        first = np.empty(len(distinct), np.int64)
        first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
        letters, runs = self._letters, self._runs
        found = [
            letters[data[a:b]] if k else runs[data[a:b]]
            for a, b, k in zip(start[first].tolist(), end[first].tolist(), kind[first].tolist())
        ]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), "<u4")
        begin = np.cumsum(size) - size
        n = size[which]
        upto = np.cumsum(n)
        at = np.arange(int(n.sum())) + np.repeat(begin[which] - (upto - n), n)
        spread = ids[at].tobytes()
        # ids before the first part of each text
        ends = np.cumsum([len(t) + 1 for t in texts])
        parts = np.searchsorted(start, ends)
        last = 0
        for upper in np.concatenate([[0], upto])[parts].tolist():
            yield spread[4 * last : 4 * upper]
            last = upper


def _byte_symbols() -> dict[int, str]:
    """The characters by which a byte-level vocabulary writes bytes.

    Printable bytes stand for themselves, the others for characters from 256 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


BYTES = _byte_symbols()
_WORDS: dict[str, _WordIds] = {}


def pieces(
    docs: DataFrame,
    *,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 1,
    with_ids: bool = False,
) -> DataFrame:
    """Documents as token pieces of at most ``capacity``: see ``PIECES``.

    A null text is empty. Each document ends with ``end_id``, so it has a piece. Only a
    document longer than ``capacity`` is cut. Repeated rows and null ids are documents
    like any other; ``row`` tells them apart.
    """

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WORDS.setdefault(tokenizer, None) or _WordIds(tokenizer)
        _WORDS[tokenizer] = words
        end = np.array([end_id], "<u4").tobytes()
        step = 4 * capacity
        for batch in small(batches, 250):
            out: list[tuple] = []
            rows, doc_ids, texts = (batch.column(i).to_pylist() for i in range(3))
            for row, doc_id, ids in zip(rows, doc_ids, words.of(texts)):
                ids += end
                for n, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    out.append(
                        (row, doc_id, n, at // 4, len(part) // 4, zlib.crc32(part),
                         part if with_ids else None)
                    )
            yield _batch(out)

    narrow = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_of().alias("text"),
    )
    out = narrow.mapInArrow(tidy(tokenise), PIECES)
    return out if with_ids else out.drop("ids")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()),
         ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
         ("ids", pa.binary())]
    )
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


class Capacities:
    """Segment tree over the remaining capacities 0..top, counting open bins."""

    def __init__(self, top: int):
        self._leaves = 1 << top.bit_length()
        self._open = [0] * (2 * self._leaves)

    def add(self, capacity: int, bins: int) -> None:
        at = self._leaves + capacity
        while at:
            self._open[at] += bins
            at >>= 1

    def tightest(self, need: int) -> int | None:
        """The least capacity of at least ``need`` with an open bin, in logarithmic time."""
        at = self._leaves + need
        if self._open[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self._open[at + 1]:
                at += 1
                while at < self._leaves:
                    at = 2 * at if self._open[2 * at] else 2 * at + 1
                return at - self._leaves
            at >>= 1
        return None


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, ...]]:
    """Best-fit-decreasing over ``counts`` (pieces by length).

    Rows (length, first, n, bin, per_bin, offset): the n pieces of that length from rank
    ``first`` on fill bins from ``bin`` on, ``per_bin`` in each, the first of each at
    ``offset``. The work depends on the number of lengths, not of pieces.
    """
    tree = Capacities(capacity)
    bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    plan: list[tuple[int, ...]] = []
    opened = 0

    def leave(first: int, n: int, room: int) -> None:
        if n and room:
            if bins[room] and sum(bins[room][-1]) == first:
                start, before = bins[room].pop()
                bins[room].append((start, before + n))
            else:
                bins[room].append((first, n))
            tree.add(room, n)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                first, n = opened, -(-left // (capacity // length))
                opened += n
            else:
                first, n = bins[room].pop()
                tree.add(room, -n)
            # The bin just filled is the tightest again until it has no room.
            per_bin = room // length
            full = min(n, left // per_bin)
            rest = min(left - full * per_bin, per_bin - 1) if full < n else 0
            for at, used, each in ((first, full, per_bin), (first + full, int(rest > 0), rest)):
                if used:
                    plan.append((length, rank, used * each, at, each, capacity - room))
                    rank += used * each
                    left -= used * each
                    leave(at, used, room - each * length)
            used = full + (rest > 0)
            leave(first + used, n - used, room)
    return plan


def pack(tokens: DataFrame, *, capacity: int = 4096) -> DataFrame:
    """``pieces()`` with sequence_id and offset, by best-fit decreasing.

    ``tokens`` should be stored, as it is read three times. Equal lengths may be a third
    of all rows: pieces are ranked within (length, bucket), with as many buckets as there
    are shuffle partitions, and the buckets' counts shift the ranks. At most ``capacity``
    counts reach the driver. The plan it sends back has the size of a few rows per
    length, whatever the data.
    """
    spark = tokens.sparkSession
    buckets = shuffle_partitions(spark)
    salted = tokens.withColumn("bucket", F.pmod(F.xxhash64("row", "piece"), F.lit(buckets)))
    sizes = salted.groupBy("length", "bucket").count()
    shifts = sizes.select(
        F.col("length").alias("of_length"),
        F.col("bucket").alias("of_bucket"),
        (
            F.sum("count").over(Window.partitionBy("length").orderBy("bucket")) - F.col("count")
        ).alias("shift"),
    )
    counts = {r["length"]: r["n"] for r in tokens.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # From Arrow, for rows of a list go through Python workers of a kind of their own, which
    # stand on every executor beside the others.
    names = ("of_length", "first", "n", "bin", "per_bin", "base")
    columns = list(zip(*best_fit_plan(counts, capacity))) or [()] * len(names)
    plan = spark.createDataFrame(
        pa.table({name: pa.array(c, pa.int64()) for name, c in zip(names, columns)})
    )
    within = Window.partitionBy("length", "bucket").orderBy("row", "piece")
    ranked = (
        salted.withColumn("at", F.row_number().over(within) - 1)
        .join(shifts, (F.col("length") == F.col("of_length")) & (F.col("bucket") == F.col("of_bucket")))
        .withColumn("rank", F.col("at") + F.col("shift"))
        .drop("of_length", "of_bucket", "at", "shift", "bucket")
    )
    place = F.col("rank") - F.col("first")
    return (
        ranked.join(
            F.broadcast(plan),
            (F.col("length") == F.col("of_length"))
            & (F.col("rank") >= F.col("first"))
            & (F.col("rank") < F.col("first") + F.col("n")),
        )
        .withColumn("sequence_id", F.col("bin") + F.floor(place / F.col("per_bin")))
        .withColumn("offset", F.col("base") + F.pmod(place, F.col("per_bin")) * F.col("length"))
        .drop("of_length", "first", "n", "bin", "per_bin", "base", "rank")
    )


def pack_documents(
    docs: DataFrame, *, tokenizer: str = "word_bpe_49k.json", capacity: int = 4096,
    with_ids: bool = False,
) -> DataFrame:
    """Tokenise, store, pack. An empty table gives no rows."""
    tokens = pieces(docs, tokenizer=tokenizer, capacity=capacity, with_ids=with_ids)
    return pack(stored(tokens, "pieces"), capacity=capacity)


def op2_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents")).drop("row")
