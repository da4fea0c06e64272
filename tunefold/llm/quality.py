"""Quality by ordinal cumulative-link regression on graded ratings (operator 3).

One weight vector over hashed features is shared by all grades; ordered
thresholds cut its line: ``P(grade > k) = sigmoid(w.x - threshold[k])``. The
thresholds are a first one and positive gaps (kept so by exponentials), so the
tail probabilities never cross. A text gets its expected grade and the tail
probability of the least grade that is wanted; selection is by the latter.

Ratings of ``documents``: 0 junk (quality 0), 1 sound but toxic, 2 sound and not
toxic. Rows whose crc32 remainder is 1 are held out of the sample. Bound:
``RATED`` rows.

Rows: null or empty text is rated as a text without features, from the
thresholds alone; null and repeated doc_ids are rated row by row; extra columns
stay out of the score; an empty table gives no rows; without ratings every row
is selected (tail probability 1).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunefold.llm.common import fresh
from tunefold.llm.training import back, dots, full_weights, held_out, matrix, sampled, scored, screened

#: Sample bound, steps, step size, weight decay.
RATED, STEPS, RATE, DECAY = 12_000, 400, 0.05, 3e-4


def rating() -> Column:
    """The grade that the label columns give: 0, 1 or 2."""
    return F.expr("case when quality = 0 then 0 when quality = 1 then if(coalesce(toxic, 0) = 1, 1, 2) end")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit(x: list[np.ndarray], y: np.ndarray, n: int, grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds; the loss is the sum of the binary losses of ``grade > k``."""
    cuts = grades - 1
    # w, first threshold, logarithms of the gaps
    w, m, v = np.zeros(n + cuts), np.zeros(n + cuts), np.zeros(n + cuts)
    above = y[:, None] > np.arange(cuts)
    tail = np.clip(above.mean(axis=0), 1e-3, 1 - 1e-3)
    start = -np.log(tail / (1 - tail))
    w[n] = start[0]
    w[n + 1 :] = np.log(np.maximum(np.diff(start), 0.05))
    for t in range(1, STEPS + 1):
        gaps = np.exp(w[n + 1 :])
        at = w[n] + np.r_[0.0, np.cumsum(gaps)]
        r = (_sigmoid(dots(x, w[:n])[:, None] - at) - above) / len(y)
        by_cut = -r.sum(axis=0)
        g_gaps = by_cut[1:][::-1].cumsum()[::-1] * gaps
        full = np.r_[back(x, r.sum(axis=1), n) + DECAY * w[:n], by_cut.sum(), g_gaps]
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full**2
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:n], w[n] + np.r_[0.0, np.cumsum(np.exp(w[n + 1 :]))]


def train(docs: DataFrame, rated: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Weights by bucket and thresholds, from ``rated`` (doc_id, rating 0, 1, ...)."""
    known = rated.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("rating").cast("int").alias("target"))
    known = known.where("doc_id is not null and target is not null").where(~held_out())
    ids = known.groupBy("doc_id").agg(F.min("target").alias("target")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(RATED)
    sample = sampled(docs, ids, "rated-sample")
    # screened at the lowest cut (junk or not) and at the highest (best or not)
    top = sample.agg(F.max("target")).first()[0] or 0
    low = screened(sample, "marks")
    high = screened(sample.withColumn("target", (F.col("target") == top).cast("int")), "marks")
    kept = np.union1d(low, high)
    x, y = matrix(sample, "marks", kept)
    if not top:
        return full_weights(np.zeros(0, np.int64), np.zeros(0)), np.array([-60.0])
    w, at = fit(x, y, len(kept), int(top) + 1)
    return full_weights(kept, w), at


def rate(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], least_grade: int = 1, p: float = 0.5) -> DataFrame:
    """doc_id, expected_grade, tail (probability of ``least_grade`` or better) and selected of every row."""
    weights, at = model

    def outputs(s: np.ndarray) -> dict[str, np.ndarray]:
        tails = _sigmoid(s[:, None] - at)
        tail = tails[:, min(least_grade, len(at)) - 1]
        return {"expected_grade": tails.sum(axis=1), "tail": tail, "selected": tail >= p}

    schema = "doc_id long, expected_grade double, tail double, selected boolean"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return scored(rows, "marks", weights, ["doc_id"], schema, outputs)


def select(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], least_grade: int = 1, p: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose tail probability is at least ``p``; texts are not shuffled."""
    weights, at = model
    names, chosen = docs.columns, fresh("selected")

    def outputs(s: np.ndarray) -> dict[str, np.ndarray]:
        return {chosen: _sigmoid(s - at[min(least_grade, len(at)) - 1]) >= p}

    from pyspark.sql.types import BooleanType, StructField, StructType

    schema = StructType([*docs.schema.fields, StructField(chosen, BooleanType())])
    rows = scored(docs, "marks", weights, names, schema, outputs)
    return rows.where(F.col(chosen)).select(*names)
