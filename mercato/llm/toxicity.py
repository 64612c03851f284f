"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

A text's features are its distinct words and the first four and five letters of each,
which also catch unseen endings. P(grade > g) = sigmoid(w . x - theta_g): one weight
vector for all grades, increasing thresholds theta. The expected severity is the sum of
these probabilities.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.shared import read, small, text_of, tidy

LETTERS = re.compile(r"[^\W\d_]+")


def features(text: str) -> set[str]:
    words = set(LETTERS.findall(text.lower()))
    return words | {w[:4] + "*" for w in words} | {w[:5] + "*" for w in words}


@dataclass(frozen=True)
class Model:
    """Weights by feature, thresholds of the grades above 0."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def score(self, text: str) -> float:
        words = set(LETTERS.findall(text.lower()))
        found = self.weights.keys() & words
        found |= self.weights.keys() & {w[:4] + "*" for w in words}
        found |= self.weights.keys() & {w[:5] + "*" for w in words}
        return sum(self.weights[f] for f in sorted(found))

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > g) by row and g."""
        return _sigmoid(score[:, None] - np.array(self.thresholds)[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def fit(
    rows: list[list[int]], grades: np.ndarray, n_features: int, n_grades: int,
    *, l2: float = 1e-5, steps: int = 600, rate: float = 0.1,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam on the mean cumulative-link log loss.

    ``rows`` hold the places of each text's features. Graded texts are few and weigh the
    root of the clean ones' number over theirs. The thresholds are a first value and
    positive steps, so they stay in order.
    """
    at = np.concatenate([np.asarray(r, np.int64) for r in rows]) if rows else np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    over = (grades[:, None] > np.arange(n_grades - 1)[None, :]).astype(float)
    graded = max(1, int(over[:, 0].sum()))
    weight = np.where(over[:, 0] > 0, math.sqrt(max(1.0, len(rows) / graded - 1)), 1.0)
    weight = (weight / weight.sum())[:, None]
    params = np.zeros(n_features + n_grades - 1)
    share = np.clip(over.mean(axis=0), 1e-4, 1 - 1e-4)
    start = np.maximum.accumulate(-np.log(share / (1 - share)))
    params[n_features] = start[0]
    params[n_features + 1 :] = np.log(np.maximum(np.diff(start), 0.1))
    m, v = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, steps + 1):
        w, raw = params[:n_features], params[n_features:]
        gaps = np.concatenate([raw[:1], np.exp(raw[1:])])
        theta = np.cumsum(gaps)
        score = np.bincount(of, weights=w[at], minlength=len(rows))
        wrong = (_sigmoid(score[:, None] - theta[None, :]) - over) * weight
        g_theta = -wrong.sum(axis=0)
        g_raw = np.cumsum(g_theta[::-1])[::-1] * np.concatenate([[1.0], gaps[1:]])
        g_w = np.bincount(at, weights=wrong.sum(axis=1)[of], minlength=n_features) + l2 * w
        grad = np.concatenate([g_w, g_raw])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        params = params - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    gaps = np.concatenate([params[n_features : n_features + 1], np.exp(params[n_features + 1 :])])
    return params[:n_features], np.cumsum(gaps)


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    grade: Column,
    grades: int,
    max_labelled: int = 20_000,
    max_features: int = 4096,
    min_docs: int = 5,
    min_z: float = 6.0,
) -> Model:
    """A model from at most ``max_labelled`` labelled documents, taken in hash order of id.

    ``grade`` is an expression over ``labels``, 0 for clean; of several labels of an id
    the highest counts, and labels without id or grade are left out. Features are those
    of at least ``min_docs`` texts whose share among graded texts exceeds that among clean
    ones by at least ``min_z`` standard errors. The driver receives at most
    ``max_features`` of them and, of the sample, the places of features.
    Without labels, without graded or without clean ones there is nothing to tell apart:
    no feature is fit and nothing is toxic.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.cast("int").alias("grade"))
        .filter("doc_id IS NOT NULL AND grade IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("grade").alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_labelled)
    )
    # Two numbers a row, at most max_labelled of them.
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(
        F.broadcast(chosen), "doc_id"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[Counter] = [Counter(), Counter()]

        def rows() -> pa.RecordBatch:
            names = list(seen[0].keys() | seen[1].keys())
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([seen[0][n] for n in names], pa.int64()),
                 pa.array([seen[1][n] for n in names], pa.int64())],
                names=["feature", "clean", "graded"],
            )

        for batch in small(batches, 100):
            texts, found = batch.column("text").to_pylist(), batch.column("grade").to_pylist()
            for text, g in zip(texts, found):
                seen[g > 0].update(features(text))
                seen[g > 0][""] += 1
            if len(seen[0]) + len(seen[1]) > 100_000:
                yield rows()
                seen = [Counter(), Counter()]
        yield rows()

    counts = (
        sample.select("text", "grade")
        .mapInArrow(tidy(count), "feature string, clean long, graded long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("graded").alias("graded"))
        .filter(F.col("clean") + F.col("graded") >= F.when(F.col("feature") == "", 0).otherwise(min_docs))
    )
    from_counts = counts.filter("feature = ''").first()
    n0, n1 = (from_counts["clean"], from_counts["graded"]) if from_counts else (0, 0)
    if not n0 or not n1:
        return Model({}, (math.inf,) * (grades - 1))
    pooled = (F.col("clean") + F.col("graded")) / F.lit(n0 + n1)
    spread = F.sqrt(pooled * (1 - pooled) * F.lit(1 / n0 + 1 / n1))
    best = (
        counts.filter(F.col("feature") != "")
        .select(
            "feature",
            ((F.col("graded") / n1 - F.col("clean") / n0) / F.greatest(spread, F.lit(1e-9))).alias("z"),
        )
        .filter(F.col("z") >= min_z)
        .orderBy(F.desc("z"), "feature")
        .limit(max_features)
        .collect()
    )
    names = [r["feature"] for r in best]
    place = {n: i for i, n in enumerate(names)}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = [
                sorted(place[f] for f in features(text) & place.keys())
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("grade"), pa.array(found, pa.list_(pa.int32()))],
                names=["doc_id", "grade", "at"],
            )

    # limit: a repeated id in docs can't bring more rows than were chosen
    encoded = (
        sample.select("doc_id", "text", "grade")
        .mapInArrow(encode, "doc_id long, grade int, at array<int>")
        .orderBy("doc_id", "at")
        .limit(max_labelled)
        .collect()
    )
    weights, thresholds = fit(
        [r["at"] for r in encoded],
        np.clip([r["grade"] for r in encoded], 0, grades - 1),
        len(names),
        grades,
    )
    return Model(
        {n: float(w) for n, w in zip(names, weights) if w}, tuple(float(t) for t in thresholds)
    )


def severity(docs: DataFrame, model: Model, *, reject: float = 0.5) -> DataFrame:
    """(doc_id, severity, grade, toxic) of every row of ``docs``, in place.

    ``severity`` is the expected grade, ``grade`` the number of thresholds passed with
    probability of at least a half, ``toxic`` whether a grade above 0 has at least the
    probability ``reject``. A null or empty text has no features.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = np.array([model.score(t) for t in batch.column("text").to_pylist()])
            above = model.above(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(above.sum(axis=1)),
                 pa.array((above >= 0.5).sum(axis=1), pa.int32()), pa.array(above[:, 0] >= reject)],
                names=["doc_id", "severity", "grade", "toxic"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")
    ).mapInArrow(tidy(score), "doc_id long, severity double, grade int, toxic boolean")


def without_toxic(docs: DataFrame, model: Model, *, reject: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that aren't toxic, all columns as they were."""

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        found = np.array([model.score(t) for t in texts], float)
        return pd.Series(model.above(found)[:, 0] < reject)

    return docs.filter(clean(text_of()))


# Clean, toxic, toxic in a text that is also of low quality.
GRADES = 3


def label_grade() -> Column:
    return F.col("toxic") * (2 - F.coalesce(F.col("quality"), F.lit(1)))


def trained(spark, docs: DataFrame, sf_dir: str) -> Model:
    return train(docs, read(spark, sf_dir, "labels"), grade=label_grade(), grades=GRADES)


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return severity(docs, trained(spark, docs, sf_dir))
