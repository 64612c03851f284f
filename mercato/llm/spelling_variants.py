"""Words one edit apart, found as equal pairs of trie nodes, and the form each stands for.

The words' prefixes are the nodes of a trie, their suffixes those of a trie of the reversed
words; both are numbered. Leaving out position i of a word gives the pair (node of the prefix
before i, node of the suffix after i); an insertion between two positions gives the pair around
the gap. Equal pairs are exact neighbours: two words that skip a position differ in it, and a
word that skips one is another with a letter more. Nothing is compared letter by letter.

A pair's group holds one word for each letter that may stand in the gap and one without, so
groups are as small as the alphabet, whatever the corpus. Numbering reads sorted words once,
so a word costs its length, not the square of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.shared import CRC_SQL, crc_sql, read, shuffle_partitions, stored, text_of

LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def slipped(run: Column, doc_id: Column, every: int) -> Column:
    """``run`` without one letter where ``every`` divides the checksum of id and run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    short = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, short).otherwise(run)


def word_counts(
    docs: DataFrame, *, least_length: int = 7, least_count: int = 2, slip: int | None = None
) -> DataFrame:
    """(word, n): maximal runs of letters with A-Z in lower case, counted over all texts.

    Only words of ``least_length`` code points and ``least_count`` occurrences. With ``slip``
    some runs lose a letter first, see ``slipped``. Null texts have no words, a null id counts
    as an empty one, repeated rows count again.
    """
    runs = docs.select(
        F.col("doc_id"),
        F.explode(F.regexp_extract_all(text_of(), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))).alias("run"),
    )
    runs = runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    word = slipped(F.col("run"), F.col("doc_id"), slip) if slip else F.col("run")
    return (
        runs.select(word.alias("word"))
        .filter(F.length("word") >= least_length)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= least_count)
    )


def _shared(a: str, b: str) -> int:
    """How many letters the words have in common from the front."""
    if b.startswith(a):
        return len(a)
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of each word's prefixes, numbered from 1 in this range of sorted words.

    A prefix shared with the word before keeps its number, so the first word has 1, 2, 3 and
    so on by length. ``doubled`` tells for each letter whether it repeats the one before.
    """
    part, last, nodes, count, at = TaskContext.get().partitionId(), "", [], 0, 0
    for batch in batches:
        all_nodes, doubled = [], []
        for word in batch.column("word").to_pylist():
            same = _shared(last, word)
            nodes = [*nodes[:same], *range(count + 1, count + 1 + len(word) - same)]
            count += len(word) - same
            last = word
            all_nodes.append(nodes)
            doubled.append([False] * bool(word) + [x == y for x, y in zip(word, word[1:])])
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("word"),
                pa.array([part] * n, pa.int32()),
                pa.array(range(at, at + n), pa.int64()),
                pa.array(all_nodes, pa.list_(pa.int64())),
                pa.array(doubled, pa.list_(pa.bool_())),
            ],
            ["id", "word", "part", "at", "nodes", "doubled"],
        )
        at += n


def trie_nodes(words: DataFrame) -> DataFrame:
    """(id, word, place, nodes, doubled) for the distinct words of (id, word).

    ``nodes`` numbers the trie nodes of the word's prefixes, shortest first: equal prefixes
    have equal numbers, different ones never. ``place`` grows with the words' code points.

    Words are sorted into ranges and numbered range by range. Only the nodes on the path that
    the last word of a range shares with the first of the next pass from one range to the
    other. One row for each range reaches the driver and comes back as a broadcast.
    """
    spark = words.sparkSession
    ranges = words.select("id", "word").repartitionByRange(shuffle_partitions(spark), "word")
    local = stored(
        ranges.sortWithinPartitions("word").mapInArrow(
            _number,
            "id long, word string, part int, at long, nodes array<long>, doubled array<boolean>",
        ),
        "trie",
    )
    ends = (
        local.groupBy("part")
        .agg(
            F.min("word").alias("first"),
            F.max(F.struct("word", "nodes")).alias("last"),
            F.max(F.array_max("nodes")).alias("count"),
        )
        .orderBy("part")
        .collect()
    )
    shifts, base, before, path = [], 0, "", []
    for end in ends:
        inherited = path[: _shared(before, end["first"])]
        shifts.append((end["part"], base, inherited))
        before = end["last"]["word"]
        path = [inherited[x - 1] if x <= len(inherited) else base + x for x in end["last"]["nodes"]]
        base += end["count"]
    shift = spark.createDataFrame(shifts, "part int, base long, inherited array<long>")
    number = lambda x: F.when(
        x <= F.size("inherited"), F.get("inherited", (x - 1).cast("int"))
    ).otherwise(F.col("base") + x)
    return local.join(F.broadcast(shift), "part").select(
        "id", "word", (F.shiftleft(F.col("part").cast("long"), 40) + F.col("at")).alias("place"),
        F.transform("nodes", number).alias("nodes"), "doubled",
    )


def node_pairs(words: DataFrame) -> DataFrame:
    """The pair dictionary of (place, n, nodes, ends, doubled): (prefix, suffix, entry).

    An entry is (skip, first, less, place): whether the pair skips a letter, whether that
    letter is the first of equal ones, the count negated, and the word.
    """
    front = F.concat(F.array(F.lit(0).cast("long")), "nodes")
    back = F.concat(F.array(F.lit(0).cast("long")), "ends")
    length = F.size("nodes")
    skips = F.transform(
        F.arrays_zip(
            F.slice(front, 1, length).alias("p"), F.reverse(F.slice(back, 1, length)).alias("s"), F.col("doubled").alias("d")
        ),
        lambda x: F.struct(x["p"].alias("p"), x["s"].alias("s"), F.lit(True).alias("skip"), (~x["d"]).alias("first")),
    )
    gaps = F.transform(
        F.arrays_zip(front.alias("p"), F.reverse(back).alias("s")),
        lambda x: F.struct(x["p"].alias("p"), x["s"].alias("s"), F.lit(False).alias("skip"), F.lit(False).alias("first")),
    )
    return words.select("place", "n", F.inline(F.concat(skips, gaps))).select(
        F.col("p").alias("prefix"),
        F.col("s").alias("suffix"),
        F.struct("skip", "first", (-F.col("n")).alias("less"), "place").alias("entry"),
    )


def nearest(pairs: DataFrame) -> DataFrame:
    """(place, n_near, best) of each word that has a neighbour, from the pair dictionary.

    ``best`` is (less, place) of the neighbour with the largest count, ties to the smaller
    word. Dropping either of two equal letters gives the same word, so only the first of
    equal letters meets the shorter word, and each neighbour counts once.
    """
    groups = (
        pairs.groupBy("prefix", "suffix")
        .agg(F.collect_list("entry").alias("entries"))
        .filter(F.size("entries") > 1)
        .select(
            F.array_sort(
                F.transform(
                    F.filter("entries", lambda e: e["skip"]),
                    lambda e: F.struct(e["less"].alias("less"), e["place"].alias("place"), e["first"].alias("first")),
                )
            ).alias("skips"),
            F.get(F.filter("entries", lambda e: ~e["skip"]), F.lit(0)).alias("shorter"),
        )
    )
    groups = groups.withColumn("firsts", F.filter("skips", lambda e: e["first"]))
    key = lambda e: F.struct(e["less"].alias("less"), e["place"].alias("place"))
    top, second = F.get("skips", F.lit(0)), F.get("skips", F.lit(1))
    replaced = F.transform(
        F.when(F.size("skips") > 1, F.col("skips")).otherwise(F.slice("skips", 1, 0)),
        lambda e: F.struct(
            e["place"].alias("place"),
            (F.size("skips") - 1).cast("long").alias("near"),
            F.when(e["place"] == top["place"], key(second)).otherwise(key(top)).alias("best"),
        ),
    )
    dropped = F.transform(
        F.when(F.col("shorter").isNotNull(), F.col("firsts")).otherwise(F.slice("firsts", 1, 0)),
        lambda e: F.struct(
            e["place"].alias("place"), F.lit(1).cast("long").alias("near"), key(F.col("shorter")).alias("best")
        ),
    )
    inserted = F.array(
        F.struct(
            F.col("shorter.place").alias("place"),
            F.size("firsts").cast("long").alias("near"),
            key(F.get("firsts", F.lit(0))).alias("best"),
        )
    )
    inserted = F.when(
        F.col("shorter").isNotNull() & (F.size("firsts") > 0), inserted
    ).otherwise(F.slice(inserted, 1, 0))
    return (
        groups.select(F.inline(F.concat(replaced, dropped, inserted)))
        .groupBy("place")
        .agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    )


def _roots(links: DataFrame) -> DataFrame:
    """(place, root) at the end of the chains (place, root), whose length doubles each round.

    Counts grow along a chain by the ratio at least, so a few rounds reach every end.
    """
    while True:
        further = links.select(F.col("place").alias("root"), F.col("root").alias("next"))
        longer = stored(links.join(further, "root", "left").select("place", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        links = longer.select("place", "root")
        if longer.filter("moved").isEmpty():
            return links


def variants(words: DataFrame, *, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of (word, n), whose words are distinct.

    Near words differ by one inserted, deleted or replaced code point. A word's form is the
    near word of the largest n (ties: the smallest by code points) if that n is at least
    ``ratio`` times its own, else null; its root the last of its forms, or itself. No words
    give no rows. ``ratio`` must be above 1, so that forms can't go in a circle.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1")
    counted = stored(
        words.select("word", F.col("n").cast("long").alias("n"), F.monotonically_increasing_id().alias("id")), "words"
    )
    forward = stored(trie_nodes(counted).join(counted.select("id", "n"), "id"), "prefixes")
    backward = trie_nodes(forward.select(F.col("place").alias("id"), F.reverse("word").alias("word")))
    both = forward.join(
        backward.select(F.col("id").alias("place"), F.col("nodes").alias("ends")), "place"
    )
    of_word = forward.select("place", "word", "n")
    best = nearest(node_pairs(both))
    judged = stored(
        of_word.join(best, "place", "left").select(
            "place", "word", "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best"),
        ),
        "variants",
    )
    roots = _roots(judged.filter("best IS NOT NULL").select("place", F.col("best.place").alias("root")))
    named = lambda place, name: of_word.select(F.col("place").alias(place), F.col("word").alias(name))
    some = (
        judged.filter("best IS NOT NULL")
        .withColumn("form_place", F.col("best.place"))
        .join(roots, "place")
        .join(named("form_place", "form"), "form_place")
        .join(named("root", "root_word"), "root")
    )
    none = judged.filter("best IS NULL").withColumns(
        {"form": F.lit(None).cast("string"), "root_word": F.col("word")}
    )
    columns = (
        "word", "form", F.col("root_word").alias("root"), "n", "n_near", (-F.col("best.less")).alias("form_n"),
    )
    return some.select(*columns).unionByName(none.select(*columns))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(word_counts(read(spark, sf_dir, "documents"), slip=31))


OP12_SQL = f"""
WITH RECURSIVE {CRC_SQL},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    unnest(regexp_extract_all(coalesce(text, ''), '[{LETTERS}]{{7,}}')) AS run
  FROM documents
),
lower_runs AS (
  SELECT id, translate(run, '{UPPER}', '{LOWER}') AS run, count(*) AS n FROM runs GROUP BY ALL
),
hashed AS (
  SELECT *, {crc_sql("id || ':' || run")} AS h FROM lower_runs, crc_table
),
counted AS MATERIALIZED (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY 1
),
words AS MATERIALIZED (
  SELECT * FROM counted WHERE length(word) >= 7 AND n >= 2
),
skips AS MATERIALIZED (
  SELECT word, substr(word, 1, i) AS front, substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
),
near AS (
  SELECT a.word, b.word AS other FROM skips a JOIN skips b USING (front, rest) WHERE a.word <> b.word
  UNION SELECT s.word, w.word FROM skips s JOIN words w ON w.word = s.front || s.rest
  UNION SELECT w.word, s.word FROM skips s JOIN words w ON w.word = s.front || s.rest
),
judged AS MATERIALIZED (
  SELECT w.word, any_value(w.n) AS n, count(o.word) AS n_near,
    first(o.word ORDER BY o.n DESC, o.word) AS best, max(o.n) AS best_n
  FROM words w LEFT JOIN near USING (word) LEFT JOIN words o ON o.word = near.other
  GROUP BY w.word
),
forms AS MATERIALIZED (
  SELECT word, n, n_near, CASE WHEN best_n >= 10 * n THEN best END AS form,
    CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
  FROM judged
),
chains (word, root) AS (
  SELECT word, word FROM forms
  UNION ALL SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM forms f JOIN chains c USING (word) JOIN forms last ON last.word = c.root AND last.form IS NULL
"""
