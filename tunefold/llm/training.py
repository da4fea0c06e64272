"""What the two classifiers share: bounded samples, screening of features, and scoring.

Training runs on a bounded sample of rows, chosen by smallest hash of doc_id.
Features are screened on it by tasks (document counts in two classes, one pair
of count arrays a task; the sample lies in ``PARTS`` partitions, so their number
is bounded); the ``TOP`` buckets of greatest difference are kept, and only those
of each sample row come to the driver, where a numpy model is fitted. Scoring
reads the whole table once, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunefold.llm.common import batches, fresh, utf8, written
from tunefold.llm.features import BUCKETS, Features

#: Partitions of a sample, features that are kept, their least difference in standard errors (of 262,144
#: buckets) and as a ratio of shares (a text's length alone moves the shares of all words a little).
PARTS, TOP, LEAST_Z, RATIO = 8, 4096, 5.0, 3.0


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; such rows' labels are never learned."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sampled(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """Text and target of one row for each of ``ids`` (doc_id, target; bounded by the caller's limit).

    An id of many rows gives its smallest text that is not null, so the bound is one of rows, and a
    hot id is combined map-side.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")
    one = rows.groupBy("doc_id", "target").agg(F.min("text").alias("text"))
    return written(one.select("text", "target").repartition(PARTS), name)


def screened(sample: DataFrame, style: str, top: int = TOP) -> np.ndarray:
    """Buckets whose share of documents differs most between target > 0 and target = 0, in standard errors."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, count, rows = Features(style), np.zeros((2, BUCKETS), np.int32), np.zeros(2, np.int64)
        for b in batches(parts):
            for target, idx in zip(b.column(1).to_pylist(), find.of(utf8(b.column(0)))):
                count[int(target > 0)][idx] += 1
                rows[int(target > 0)] += 1
        yield pa.RecordBatch.from_arrays([pa.array([rows.tobytes()]), pa.array([count.tobytes()])], names=["n", "c"])

    count, rows = np.zeros((2, BUCKETS)), np.zeros(2)
    for r in sample.select("text", "target").mapInArrow(run, "n binary, c binary").toLocalIterator():
        rows += np.frombuffer(r.n, np.int64)
        count += np.frombuffer(r.c, np.int32).reshape(2, -1)
    n0, n1 = np.maximum(rows, 1)
    p = (count.sum(axis=0) + 1) / (n0 + n1 + 2)
    z = np.abs(count[1] / n1 - count[0] / n0) / np.sqrt(p * (1 - p) * (1 / n0 + 1 / n1))
    ratio = np.abs(np.log((count[1] + 0.5) / n1) - np.log((count[0] + 0.5) / n0))
    z[(count.sum(axis=0) < 4) | (ratio < np.log(RATIO))] = 0
    best = np.argsort(-z, kind="stable")[:top]
    return np.sort(best[z[best] > LEAST_Z])


def matrix(sample: DataFrame, style: str, kept: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Kept features (as places in ``kept``) and target of every sample row."""
    place = np.full(BUCKETS, -1, np.int32)
    place[kept] = np.arange(len(kept))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Features(style)
        for b in batches(parts):
            x = [(p := place[idx])[p >= 0].tobytes() for idx in find.of(utf8(b.column(0)))]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), b.column(1)], names=["x", "y"])

    rows = sample.select("text", F.col("target").cast("double")).mapInArrow(run, "x binary, y double").toArrow()
    order = sorted(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()))  # the same fit whatever the order of rows
    return [np.frombuffer(x, np.int32) for x, _ in order], np.array([y for _, y in order])


def dots(x: list[np.ndarray], w: np.ndarray) -> np.ndarray:
    """Sum of the weights of each row's features."""
    at = np.cumsum([0, *map(len, x)])
    sums = np.r_[0.0, np.cumsum(w[np.concatenate(x)])] if len(x) and at[-1] else np.zeros(at[-1] + 1)
    return sums[at[1:]] - sums[at[:-1]]


def back(x: list[np.ndarray], g: np.ndarray, n: int) -> np.ndarray:
    """Gradient of ``n`` weights from a gradient per row."""
    if not len(x):
        return np.zeros(n)
    return np.bincount(np.concatenate(x), np.repeat(g, [len(i) for i in x]), minlength=n)


def full_weights(kept: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weights by bucket."""
    out = np.zeros(BUCKETS, np.float32)
    out[kept] = w
    return out


def scored(docs: DataFrame, style: str, weights: np.ndarray, columns: list[str], schema: str, outputs: Callable) -> DataFrame:
    """``columns`` of ``docs`` and what ``outputs`` (sums of weights -> arrays) makes of every whole text."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Features(style)
        for b in batches(parts):
            s = np.array([float(weights[idx].sum(dtype=np.float64)) for idx in find.of(utf8(b.column(b.num_columns - 1)))])
            found = outputs(s)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *map(pa.array, found.values())], names=[*columns, *found])

    return docs.select(*columns, F.col("text").alias(fresh("text"))).mapInArrow(run, schema)
