"""Approximate nearest neighbours by collision counting with query-centred windows.

Every vector is projected on K random lines; a block of vectors keeps the projections
of each line as a sorted array. A query opens a window around its own value in every
array and counts in how many windows a vector lies. Vectors that collide in enough of
them are verified with the exact cosine. Virtual rehashing widens all windows by a
factor and counts only what is newly inside, until more than k verified ids other than the
query's own lie within the distance that the windows cover, or the windows hold the whole
block. An id counts once, by its best vector.

Blocks of queries meet blocks of vectors: the query set is stated (ids divisible by
``query_step``), and each pair of blocks returns k rows a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.shared import read, shuffle_partitions, stored

LINES = 64
# Share of the lines on which a vector must collide before it is verified.
THRESHOLD = 0.9
# First half width of the windows, and the factor between rounds, in unit-vector distance.
WIDTH, GROWTH = 0.1, 1.15
# The windows of a round cover neighbours up to so many half widths away.
REACH = 4.5
BLOCK = "bits int, first long, ids binary, vectors binary, sorted binary, places binary"
_BLOCK = pa.schema(
    [("bits", pa.int32()), ("first", pa.int64()), *((n, pa.binary()) for n in ("ids", "vectors", "sorted", "places"))]
)
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def lines(bits: int) -> np.ndarray:
    """K random directions, orthogonal in groups, the same in every task."""
    law = np.random.default_rng(bits)
    groups = [
        np.linalg.qr(law.standard_normal((bits, bits)))[0].T for _ in range(-(-LINES // bits))
    ]
    return np.concatenate(groups)[:LINES]


def usable(vectors: list) -> list[int]:
    """Places of vectors that take part: no null, no non-finite component, not zero."""
    out = []
    for i, v in enumerate(vectors):
        if v and None not in v:
            a = np.asarray(v, np.float64)
            if np.isfinite(a).all() and a.any():
                out.append(i)
    return out


def blocks(
    vectors: DataFrame, *, id_col: str, vector_col: str, rows: int, index: bool
) -> DataFrame:
    """Blocks of at most ``rows`` vectors of equal dimension, with their sorted arrays."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, tuple[list, list]] = {}

        def close(bits: int) -> pa.RecordBatch:
            ids, vecs = waiting.pop(bits)
            matrix = balanced(np.array(vecs, np.float64))
            sorted_, places = b"", b""
            if index:
                unit = matrix / norms(matrix)[:, None]
                values = lines(bits) @ unit.T
                order = np.argsort(values, axis=1, kind="stable").astype(np.int32)
                sorted_ = np.take_along_axis(values, order, 1).tobytes()
                places = order.tobytes()
            row = (bits, ids[0], np.array(ids, np.int64).tobytes(), matrix.tobytes(), sorted_, places)
            return pa.RecordBatch.from_arrays(
                [pa.array([x], f.type) for x, f in zip(row, _BLOCK)], schema=_BLOCK
            )

        for batch in batches:
            ids, vecs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in usable(vecs):
                own = waiting.setdefault(len(vecs[i]), ([], []))
                own[0].append(ids[i])
                own[1].append(vecs[i])
                if len(own[0]) == rows:
                    yield close(len(vecs[i]))
        for bits in list(waiting):
            yield close(bits)

    return (
        vectors.select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.col(vector_col).cast("array<double>").alias("vector"),
        )
        .filter(F.col("vec_id").isNotNull())
        .mapInArrow(fill, BLOCK)
    )


def balanced(matrix: np.ndarray) -> np.ndarray:
    """The vectors times powers of two that bring their largest components to 0.5 to 1.

    Cosines stay the same to the last bit where products would neither overflow nor vanish,
    and are right where they would.
    """
    return np.ldexp(matrix, -np.frexp(np.abs(matrix).max(axis=1))[1][:, None])


def norms(matrix: np.ndarray) -> np.ndarray:
    """Lengths of balanced vectors."""
    return np.sqrt(np.square(matrix).sum(axis=1))


def search_block(
    queries: np.ndarray,
    query_ids: np.ndarray,
    vectors: np.ndarray,
    ids: np.ndarray,
    sorted_: np.ndarray,
    places: np.ndarray,
    k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the places and cosines of the vectors it has verified.

    A round widens the windows of all queries that aren't done.
    """
    n = len(vectors)
    of_id = np.unique(ids, return_inverse=True)[1]
    n_ids = int(of_id.max()) + 1
    length, q_length = norms(vectors), norms(queries)
    centres = lines(vectors.shape[1]) @ (queries / q_length[:, None]).T
    need = int(np.ceil(THRESHOLD * LINES))
    counts = np.zeros((len(queries), n), np.int16)
    scores = np.full((len(queries), n), -np.inf)
    verified = np.zeros((len(queries), n), bool)
    low = np.stack([np.searchsorted(sorted_[j], centres[j]) for j in range(LINES)], axis=1)
    high = low.copy()
    going = np.arange(len(queries))
    width = WIDTH
    while len(going):
        at = [np.searchsorted(sorted_[j], centres[j, going] - width) for j in range(LINES)]
        to = [np.searchsorted(sorted_[j], centres[j, going] + width, "right") for j in range(LINES)]
        at = np.minimum(np.stack(at, axis=1), low[going])
        to = np.maximum(np.stack(to, axis=1), high[going])
        done = np.zeros(len(going), bool)
        for i, q in enumerate(going.tolist()):
            left = zip(places, at[i].tolist(), low[q].tolist())
            right = zip(places, high[q].tolist(), to[i].tolist())
            entered = [line[x:y] for line, x, y in (*left, *right) if x < y]
            if entered:
                counts[q] += np.bincount(np.concatenate(entered), minlength=n).astype(np.int16)
            new = np.flatnonzero((counts[q] >= need) & ~verified[q])
            verified[q, new] = True
            # row by row the same sum, so that equal vectors have equal scores
            scores[q, new] = (vectors[new] * queries[q]).sum(axis=1) / (length[new] * q_length[q])
            seen = np.flatnonzero(verified[q])
            if len(seen) == n:
                done[i] = True
            elif len(seen) > k:
                others = seen[ids[seen] != query_ids[q]]
                near = scores[q, others]
                if n_ids < n:
                    best = np.full(n_ids, -np.inf)
                    np.maximum.at(best, of_id[others], near)
                    near = best[best > -np.inf]
                if len(near) > k:
                    last = np.partition(near, -(k + 1))[-(k + 1)]
                    # distance of unit vectors with that cosine
                    done[i] = np.sqrt(max(0.0, 2 - 2 * last)) <= REACH * width
            if done[i]:
                yield q, seen, scores[q, seen]
        low[going], high[going] = at, to
        going = going[~done]
        width *= GROWTH


def nearest(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    query_step: int = 50,
    block_rows: int = 4096,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest by cosine, ties to smaller ids.

    Vectors that are null, empty or zero, or hold null or non-finite components, and rows
    without an id take no part; vectors of another dimension never meet. All rows with
    the query's id are its own and no candidates. A repeated id is one result, with its
    best score.
    """
    spark = vectors.sparkSession
    data = stored(
        blocks(vectors, id_col=id_col, vector_col=vector_col, rows=block_rows, index=True), "ann-blocks"
    )
    asked = stored(
        blocks(
            vectors.filter(F.col(id_col).cast("long") % query_step == 0),
            id_col=id_col, vector_col=vector_col, rows=512, index=False,
        ).select("bits", F.col("ids").alias("query_ids"), F.col("vectors").alias("queries")),
        "ann-queries",
    )
    # Every query block goes to every group of data blocks.
    groups = shuffle_partitions(spark)
    dealt = data.withColumn("group", F.pmod(F.xxhash64("first", "ids"), F.lit(groups)))
    spread = asked.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn(
        "group", F.col("group").cast("long")
    )
    # A given number of partitions: few bytes are much work here, so they aren't to be merged.
    pairs = spread.repartition(groups, "bits", "group").join(
        dealt.repartition(groups, "bits", "group").hint("merge"), ["bits", "group"]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                bits = row["bits"]
                ids = np.frombuffer(row["ids"], np.int64)
                query_ids = np.frombuffer(row["query_ids"], np.int64)
                out: list[tuple[np.ndarray, ...]] = []
                for q, seen, scores in search_block(
                    np.frombuffer(row["queries"]).reshape(-1, bits),
                    query_ids,
                    np.frombuffer(row["vectors"]).reshape(-1, bits),
                    ids,
                    np.frombuffer(row["sorted"]).reshape(LINES, -1),
                    np.frombuffer(row["places"], np.int32).reshape(LINES, -1),
                    k,
                ):
                    others = ids[seen] != query_ids[q]
                    found, scores = ids[seen][others], scores[others]
                    order = np.lexsort((found, -scores))
                    _, first = np.unique(found[order], return_index=True)
                    best = order[np.sort(first)[:k]]
                    out.append((np.full(len(best), query_ids[q]), found[best], scores[best]))
                columns = [np.concatenate(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND
                )

    found = (
        pairs.select("bits", "query_ids", "queries", "ids", "vectors", "sorted", "places")
        .mapInArrow(search, "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op4_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"))
