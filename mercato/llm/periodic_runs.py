"""Periodic runs of words, found in the grammar that Re-Pair makes of each text.

A run is a stretch of words in which words ``period`` apart are equal, at least four periods
and six words long, that no neighbouring word extends. Re-Pair replaces pairs of symbols that
repeat by new ones, the most frequent first, until none repeats; what is left is halved into
further symbols. Every run lies within the symbol that covers it whole, across the boundary of
that symbol's halves. So each distinct symbol is searched once, at its boundary, and what it
holds is translated to all places where the symbol stands. Stretches with the same period that
overlap are one run.

Words and pairs of words that are too rare to lie in a run cut a text into blocks before that,
and most prose leaves none. Texts are independent rows, so Spark deals them to tasks as they
are read, and nothing is shuffled.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.shared import CRC_SQL, SPACES, WORD, crc_sql, read, small, text_of

PERIODS, WORDS = 4, 6

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _stretches(held: bytes, low: int, least: int) -> Iterator[tuple[int, int]]:
    """Maximal stretches of ones, at least so long, shifted by ``low``."""
    at = held.find(b"\1" * least)
    while at >= 0:
        end = held.find(b"\0", at)
        end = len(held) if end < 0 else end
        yield low + at, low + end
        at = held.find(b"\1" * least, end)


def blocks(words: list[str], passes: int = 3) -> list[tuple[int, int]]:
    """Stretches [low, high) outside of which no run can lie.

    Within a run every word stands at least four times and every pair of words three times.
    Passes steer only how much is left to the grammar, which is exact by itself.
    """
    found = [(0, len(words))]
    for _ in range(passes):
        before, found_now = found, []
        for low, high in found:
            part = words[low:high]
            often = {w for w, n in Counter(part).items() if n >= PERIODS}
            for a, b in _stretches(bytes(map(often.__contains__, part)), low, WORDS):
                part = words[a:b]
                pairs = list(zip(part, part[1:]))
                often = {w for w, n in Counter(pairs).items() if n >= PERIODS - 1}
                held = bytes(map(often.__contains__, pairs))
                found_now += [(x, y + 1) for x, y in _stretches(held, a, WORDS - 1)]
        found = found_now
        if found == before:
            break
    return found


def repair(ids: list[int], rounds: int = 100) -> tuple[list[tuple[int, int]], list[int]]:
    """Re-Pair: the rules (left, right) of new symbols, numbered on from the words, and the rest.

    A round takes pairs that repeat by falling count (ties: the earlier first), as long as
    their places can't overlap those of a pair taken before, and replaces them from left to
    right. Rounds steer only how much is left unpaired.
    """
    words = max(ids) + 1
    rules: list[tuple[int, int]] = []
    for _ in range(rounds):
        lefts: set[int] = set()
        rights: set[int] = set()
        new: dict[tuple[int, int], int] = {}
        for pair, n in Counter(zip(ids, ids[1:])).most_common():
            if n < 2:
                break
            left, right = pair
            if left not in rights and right not in lefts:
                lefts.add(left)
                rights.add(right)
                new[pair] = words + len(rules)
                rules.append(pair)
        if not new:
            break
        out, at, end = [], 0, len(ids)
        while at < end:
            made = new.get((ids[at], ids[at + 1])) if at + 1 < end else None
            out.append(ids[at] if made is None else made)
            at += 1 if made is None else 2
        ids = out
    return rules, ids


def _forward(ids: list[int], i: int, j: int, end: int) -> int:
    """How many words from i on equal those from j > i on, before ``end``."""
    k, step = 0, 8
    while step:
        if j + k + step <= end and ids[i + k : i + k + step] == ids[j + k : j + k + step]:
            k += step
            step *= 2
        else:
            step //= 2
    return k


def _backward(ids: list[int], i: int, j: int, start: int) -> int:
    """How many words before i equal those before j > i, from ``start`` on."""
    k, step = 0, 8
    while step:
        if i - k - step >= start and ids[i - k - step : i - k] == ids[j - k - step : j - k]:
            k += step
            step *= 2
        else:
            step //= 2
    return k


def crossing(
    ids: list[int], places: dict[tuple[int, int], list[int]], low: int, middle: int, high: int
) -> list[tuple[int, int, int]]:
    """Runs (start, end, period) of [low, high) with words on both sides of ``middle``.

    The two words at the boundary stand again one period before or after, so the places of
    that pair give all periods there can be. They are tried by size; a stretch within a run
    of a smaller period is no run of its own. Two runs overlap by less than both periods
    together, so a period too small to reach beyond a known run is passed over.
    """
    own, most = middle - 1, (high - low) // PERIODS
    at = places[ids[own], ids[middle]]
    a, b = bisect_left(at, max(low, own - most)), bisect_right(at, min(high - 2, own + most))
    if b - a < 2:
        return []
    found: list[tuple[int, int, int]] = []
    for period, i in sorted((abs(x - own), min(x, own)) for x in at[a:b] if x != own):
        j = i + period
        if any(period <= min(e - middle, middle - s) - q for s, e, q in found):
            continue
        if any(e - middle <= middle - s for s, e, _ in found):
            end = j + _forward(ids, i, j, high)
            if any(end <= e and period <= middle - s - q for s, e, q in found):
                continue
            start = i - _backward(ids, i, j, low)
        else:
            start = i - _backward(ids, i, j, low)
            if any(start >= s and period <= e - middle - q for s, e, q in found):
                continue
            end = j + _forward(ids, i, j, high)
        if end - start >= max(WORDS, PERIODS * period) and not any(
            s <= start and end <= e for s, e, _ in found
        ):
            found.append((start, end, period))
    return found


def block_runs(ids: list[int]) -> list[tuple[int, int, int]]:
    """All runs (start, end, period) of a block."""
    rules, rest = repair(ids)
    words = max(ids) + 1
    while len(rest) > 1:
        halved = range(0, len(rest) - 1, 2)
        made = [words + len(rules) + k for k in range(len(halved))]
        rules += [(rest[k], rest[k + 1]) for k in halved]
        rest = made + rest[len(halved) * 2 :]
    lengths = [1] * words
    for left, right in rules:
        lengths.append(lengths[left] + lengths[right])
    some = [0] * len(lengths)  # a place of each symbol
    for k in range(len(rules) - 1, -1, -1):
        left, right = rules[k]
        some[left], some[right] = some[words + k], some[words + k] + lengths[left]
    places: dict[tuple[int, int], list[int]] = defaultdict(list)
    for i, pair in enumerate(zip(ids, ids[1:])):
        places[pair].append(i)

    runs: dict[int, list[tuple[int, int, int]]] = {}
    holds = [False] * len(lengths)
    for k, (left, right) in enumerate(rules):
        symbol = words + k
        if lengths[symbol] >= WORDS:
            low = some[symbol]
            found = crossing(ids, places, low, low + lengths[left], low + lengths[symbol])
            if found:
                runs[symbol] = [(s - low, e - low, q) for s, e, q in found]
            holds[symbol] = bool(found) or holds[left] or holds[right]

    at: dict[int, list[int]] = defaultdict(list, {rest[0]: [0]})
    by_period: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for k in range(len(rules) - 1, -1, -1):
        symbol, (left, right) = words + k, rules[k]
        if not holds[symbol]:
            continue
        where = at.pop(symbol, [])
        for s, e, q in runs.get(symbol, ()):
            by_period[q] += [(x + s, x + e) for x in where]
        if holds[left]:
            at[left] += where
        if holds[right]:
            at[right] += [x + lengths[left] for x in where]

    out = []
    for q, stretches in by_period.items():
        start, end = None, -1
        for s, e in sorted(stretches):
            if start is not None and s <= end - q:
                end = max(end, e)
                continue
            if start is not None:
                out.append((start, end, q))
            start, end = s, e
        out.append((start, end, q))
    return out


def runs_of(words: list[str]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    out = []
    for low, high in blocks(words):
        numbers: dict[str, int] = {}
        ids = [numbers.setdefault(w, len(numbers)) for w in words[low:high]]
        out += [(low + s, e - s, q) for s, e, q in block_runs(ids)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words but for those after the first period of a run, joined by spaces."""
    if not runs:
        return " ".join(words)
    keep = bytearray(b"\1") * len(words)
    for start, length, period in runs:
        keep[start + period : start + length] = bytes(length - period)
    return " ".join(w for w, k in zip(words, keep) if k)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, collapsed): a row for each row of ``docs``.

    ``runs`` lists (start, length, period) in words by start, then period; ``collapsed`` is the
    text without what repeats, its words joined by single spaces. Words are runs of anything but
    ASCII white space. A null, empty or blank text has no runs and collapses to nothing; repeated
    rows and null ids are rows like any other; an empty table gives none. Other columns are not
    read.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 200):
            all_runs, texts = [], []
            for text in batch.column("text").to_pylist():
                words = [w for w in text.translate(SPACES).split(" ") if w]
                runs = runs_of(words)
                all_runs.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                texts.append(collapsed(words, runs))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(all_runs, pa.list_(RUN)), pa.array(texts, pa.string())],
                ["doc_id", "runs", "collapsed"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        found,
        "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string",
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs``; where the checksum of the id ends in 0, the tail of the text repeats its start.

    From word a on, a stretch of p words repeats to the end. A null id plants nothing.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.regexp_extract_all(text_of(), F.lit(WORD), F.lit(0))
    n, g = F.size(words), F.floor(h / 10)
    a = (g % n).cast("int")
    p = (F.floor((n - a) / (g % 8 + 3)) + 1).cast("int")
    tail = F.slice(
        F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a
    )
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return docs.withColumn("text", F.when((h % 10 == 0) & (n > 0), planted).otherwise(F.col("text")))


def _line(run: Column) -> Column:
    return F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))


def _order(a: Column, b: Column) -> Column:
    """Greatest length by period first, then the smallest start, then the smallest period."""
    more = b["length"] * a["period"] - a["length"] * b["period"]
    return F.coalesce(
        *[F.when(x != 0, F.signum(x).cast("int")) for x in (more, a["start"] - b["start"])],
        F.signum(a["period"] - b["period"]).cast("int"),
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = F.get(F.array_sort("runs", _order), F.lit(0))
    return (
        periodic_runs(with_planted_runs(read(spark, sf_dir, "documents")))
        .withColumn("best", best)
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            "best.start",
            "best.length",
            "best.period",
            F.expr("1000 * best.length div best.period").alias("exponent_milli"),
            F.sha2(F.array_join(F.transform("runs", _line), ""), 256).alias("runs_sha256"),
            F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
    )


OP13_SQL = f"""
WITH {CRC_SQL},
raw AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, CAST(doc_id AS VARCHAR) AS id,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
hashed AS (
  SELECT r, doc_id, w, len(w) AS n,
    {crc_sql("id")} AS h
  FROM raw, crc_table
),
tails AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM hashed
),
periods AS (
  SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM tails
),
places AS (
  SELECT r, n, w, a, p, unnest(range(n)) AS i FROM periods
),
words AS MATERIALIZED (
  SELECT r, n, i, w[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1] AS word FROM places
),
equal AS (
  SELECT x.r, y.i - x.i AS q, x.i
  FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
),
islands AS (
  SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM equal
),
stretches AS (
  SELECT r, q, min(i) AS s, count(*) + q AS l FROM islands GROUP BY r, q, g
  HAVING count(*) + q >= greatest(6, 4 * q)
),
runs AS MATERIALIZED (
  SELECT * FROM stretches x WHERE NOT EXISTS (
    FROM stretches y WHERE y.r = x.r AND y.q < x.q AND y.s <= x.s AND x.s + x.l <= y.s + y.l)
),
of_doc AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS listed
  FROM runs GROUP BY r
),
best AS (
  SELECT x.* FROM runs x WHERE NOT EXISTS (
    FROM runs y WHERE y.r = x.r AND (y.l * x.q > x.l * y.q
      OR y.l * x.q = x.l * y.q AND (y.s < x.s OR y.s = x.s AND y.q < x.q)))
),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM words w
  WHERE NOT EXISTS (FROM runs x WHERE x.r = w.r AND w.i >= x.s + x.q AND w.i < x.s + x.l)
  GROUP BY r
)
SELECT CAST(doc_id AS BIGINT) AS doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, l AS length, q AS period,
  1000 * l // q AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM hashed d LEFT JOIN of_doc USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""
