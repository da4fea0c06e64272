"""Toxicity by non-negative positive-unlabelled learning (operator 5).

Positives are texts that are labelled toxic; the unlabelled ones are a sample of
all texts, whatever their labels. With the class prior p, the risk of a
classifier is ``p * R+(positives) + max(0, R-(unlabelled) - p * R-(positives))``:
what the unlabelled rows would cost as negatives, less the positives among them,
kept from falling below zero (in that case a step goes the other way, which
stops the model from learning the unlabelled rows by heart). A linear numpy
model on screened hashed features is fitted by gradient steps.

The prior is the share of toxic ones among labelled rows. Rows whose crc32
remainder is 1 are held out of every sample. Labels, lang, source and doc_id are
no features. Bounds: ``POSITIVES`` and ``UNLABELLED`` rows.

Rows: null or empty text scores as a text without features; null and repeated
doc_ids are scored row by row; extra columns are ignored; an empty table gives
no rows; without positives every score is 0.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunefold.llm.training import back, dots, full_weights, held_out, matrix, sampled, scored, screened

#: Sample bounds, steps, step size and weight decay.
POSITIVES, UNLABELLED, STEPS, RATE, DECAY = 4000, 12_000, 400, 0.05, 3e-4


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit(x: list[np.ndarray], y: np.ndarray, n: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias by the non-negative risk (logistic loss, Adam); ``y``: 1 positive, 0 unlabelled."""
    pos, unl = y > 0, y == 0
    w, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    w[n] = np.log(prior / (1 - prior))
    n_pos, n_unl = max(1, pos.sum()), max(1, unl.sum())
    for t in range(1, STEPS + 1):
        s = dots(x, w[:n]) + w[n]
        q = _sigmoid(s)
        negative = (np.logaddexp(0, s[unl]).sum() / n_unl) - prior * (np.logaddexp(0, s[pos]).sum() / n_pos)
        g_plus = np.where(pos, prior * (q - 1) / n_pos, 0.0)
        g_minus = np.where(unl, q / n_unl, -prior * q / n_pos)
        g = g_plus + g_minus if negative >= 0 else -g_minus
        full = np.r_[back(x, g, n) + DECAY * w[:n], g.sum()]
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full**2
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:n], float(w[n])


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Weights by bucket and the bias."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where("doc_id is not null and toxic is not null")
    known = known.where(~held_out())
    ids = known.where("toxic = 1").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(POSITIVES)
    share = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not share:
        return full_weights(np.zeros(0, np.int64), np.zeros(0)), -60.0
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").where(~held_out())
    rest = every.distinct().orderBy(F.xxhash64(F.lit(1), "doc_id"), "doc_id").limit(UNLABELLED)
    chosen = ids.withColumn("target", F.lit(1)).union(rest.withColumn("target", F.lit(0)))
    sample = sampled(docs, chosen, "toxic-sample")
    kept = screened(sample, "words")
    x, y = matrix(sample, "words", kept)
    w, bias = fit(x, y, len(kept), min(0.9, share))
    return full_weights(kept, w), bias


def score(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    weights, bias = model

    def outputs(s: np.ndarray) -> dict[str, np.ndarray]:
        p = _sigmoid(s + bias) if bias > -60 else np.zeros(len(s))
        return {"score": p, "predicted": (p >= threshold).astype(np.int32)}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held_out())
    return scored(rows, "words", weights, ["doc_id", "held_out"], "doc_id long, held_out boolean, score double, predicted int", outputs)
