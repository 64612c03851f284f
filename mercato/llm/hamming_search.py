"""Exact top-k search in binary codes by multi-index hashing with growing radii.

A code is cut into m segments. Two codes within Hamming distance m * (r + 1) - 1 agree
in some segment up to r bits, so after all segment values within radius r of a query's
have been looked up, every code within that distance has been met. A query is done when
its k-th verified distance is covered in that sense; the others go on with radius r + 1.

Equal codes are one entry with their k + 1 smallest ids, which is all that a result can
show of them, so a code that a third of all rows share is an ordinary entry. Of an id with
several codes only the nearest to a query counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.shared import read, stored

SEGMENT_BITS = 16


def sign_codes(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, bits, code): one bit per component, set where it is above zero.

    ``code`` holds segments of 16 bits. Vectors that are null or empty or hold a null or
    non-finite component have no code and take no part.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, bits, codes = [], [], []
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not vector or None in vector or not np.isfinite(vector).all():
                    continue
                packed = np.packbits(np.array(vector) > 0)
                packed = np.append(packed, np.zeros(len(packed) % 2, np.uint8))
                ids.append(vec_id)
                bits.append(len(vector))
                codes.append(packed.view(">u2").astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(bits, pa.int32()),
                 pa.array(codes, pa.list_(pa.int32()))],
                names=["vec_id", "bits", "code"],
            )

    return vectors.select(
        F.col(id_col).cast("long"), F.col(vector_col).cast("array<double>")
    ).mapInArrow(encode, "vec_id long, bits int, code array<int>")


def _sorted(df: DataFrame) -> DataFrame:
    """``df``, to be joined by a sort: codes in a broadcast table could outgrow the driver."""
    return df.hint("merge")


def _distance(left: str, right: str) -> Column:
    parts = F.zip_with(left, right, lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(parts, F.lit(0), lambda total, n: total + n)


def _masks(radius: int) -> list[int]:
    """All segment differences of exactly ``radius`` bits."""
    return [sum(1 << b for b in bits) for bits in combinations(range(SEGMENT_BITS), radius)]


def top_k(codes: DataFrame, *, k: int = 10, query_step: int = 100) -> DataFrame:
    """(query_id, rank, vec_id, distance): each query's k nearest, ties to smaller ids.

    Queries are the ids divisible by ``query_step``; candidates all other rows with a
    code of as many bits. Fewer than k candidates are all returned. A repeated id with
    the same code counts once; with different codes each is a candidate, and a query by
    each of its codes is answered with the nearest of all.
    """
    codes = stored(codes.distinct(), "codes")
    of_code = Window.partitionBy("bits", "code").orderBy("vec_id")
    entries = stored(
        codes.filter(F.col("vec_id").isNotNull())
        .withColumn("n", F.row_number().over(of_code))
        .filter(F.col("n") <= k + 1)
        .groupBy("bits", "code")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids")),
        "code-entries",
    )
    queries = codes.filter(F.col("vec_id") % query_step == 0)
    index = entries.select(
        "bits", "code", "ids", F.posexplode("code").alias("segment", "value")
    )
    open_codes = queries.select("bits", F.col("code").alias("wanted")).distinct()
    # ids met so far, of queries that aren't done; done queries
    met: DataFrame | None = None
    done: list[DataFrame] = []
    for radius in range(SEGMENT_BITS + 1):
        masks = F.array(*[F.lit(m) for m in _masks(radius)])
        probes = (
            open_codes.select(
                "bits", "wanted", F.posexplode("wanted").alias("segment", "own")
            )
            .withColumn("mask", F.explode(masks))
            .select("bits", "wanted", "segment", F.col("own").bitwiseXOR(F.col("mask")).alias("value"))
        )
        new = (
            probes.join(_sorted(index), ["bits", "segment", "value"])
            .select("bits", "wanted", "code", "ids")
            .distinct()
            .select("bits", "wanted", _distance("wanted", "code").alias("distance"), F.explode("ids").alias("vec_id"))
        )
        if met is not None:
            new = new.unionByName(met)
        new = new.groupBy("bits", "wanted", "vec_id").agg(F.min("distance").alias("distance"))
        # Only the k + 1 nearest ids can matter: the query's own may be among them.
        nearest = Window.partitionBy("bits", "wanted").orderBy("distance", "vec_id")
        met = stored(
            new.withColumn("n", F.row_number().over(nearest)).filter(F.col("n") <= k + 1).drop("n"),
            "ids-met",
        )
        covered = F.size("wanted") * (radius + 1) - 1
        # k others within the covered distance: k + 1 with the query itself
        state = (
            met.filter(F.col("distance") <= covered)
            .groupBy("bits", "wanted")
            .agg(F.count("*").alias("n"))
            .filter(F.col("n") >= k + 1)
            .select("bits", "wanted")
        )
        if radius == SEGMENT_BITS:
            done.append(met)
            break
        done.append(met.join(_sorted(state), ["bits", "wanted"], "left_semi"))
        open_codes = stored(open_codes.join(_sorted(state), ["bits", "wanted"], "left_anti"), "open-queries")
        if open_codes.isEmpty():
            break
        met = met.join(_sorted(open_codes), ["bits", "wanted"], "left_semi")
    found = (
        reduce(DataFrame.unionByName, done)
        .join(
            _sorted(queries.select("bits", F.col("code").alias("wanted"), F.col("vec_id").alias("query_id"))),
            ["bits", "wanted"],
        )
        .select("query_id", "distance", "vec_id")
        .filter(F.col("query_id") != F.col("vec_id"))
        .groupBy("query_id", "vec_id")
        .agg(F.min("distance").alias("distance"))
    )
    ranked = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "distance")
    )


def op9_exact_hamming_search(spark, sf_dir: str) -> DataFrame:
    return top_k(sign_codes(read(spark, sf_dir, "embeddings")))


OP9_SQL = """
WITH codes AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x > 0 AS INT)) AS code
    FROM embeddings
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.code, c.code),
                                        lambda p: CAST(p[1] <> p[2] AS INT))) AS INT) AS distance
    FROM codes q JOIN codes c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INT) AS rank,
       vec_id, distance
FROM pairs
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) <= 10
"""
