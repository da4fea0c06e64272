"""Whitening of embeddings from a covariance made by polarisation (operator 13).

Every component c of a vector becomes the integer ``x = floor(64 c) + 1000000``.
The fit list holds each distinct x-vector once. Its covariance comes from
variances alone: for each dimension and for each pair of dimensions the squares
of the centred value, or of the centred sum of the two, are added up exactly, and

    cov(i, j) = (var(i + j) - var(i) - var(j)) / 2

The centre is the integer nearest to the mean, so that the squared values are
small whole numbers; what is left of the mean is taken off as an exact fraction.
Nothing is rounded before V is assembled, so a constant offset of the values
costs no digits. ``eigh`` of V then gives the components.

At scale: the fit list is one shuffle of distinct vectors (combined before it, so
a vector that a third of all rows share is one row per task) and is written once.
Tasks add up their squares with numpy and hand on one number per pair of
dimensions; these are summed as decimals by Spark, and what comes to the driver
is one number per dimension or pair, whatever the row count. The rows are
whitened in a scan without a shuffle.

Rows: a vector that is null, or holds null or non-finite components, is dropped,
and so is one of another length than most (of lengths equally frequent, than the
longest) or with a component beyond +-2^40, whose squares no decimal sum holds. Null and
repeated ids are kept, row by row. Components of no variance can't be whitened
and give no rows: of a table whose remaining vectors are all alike, or of empty
vectors, nothing is left. ``deviation`` is exact; where it exceeds a long it is
null and ``deviation_exact`` (decimal) has it. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunefold.llm.common import fresh, written

#: Fixed values of the grid: steps per unit and offset.
STEPS, OFFSET = 64, 1_000_000
#: Components returned, greatest |component| taken, rows of a numpy block, rounding noise of a variance share.
COMPONENTS, WIDEST, BLOCK, NOISE = 16, float(1 << 40), 4096, 1e-13

ROWS = (
    "vec_id long, component int, n long, deviation long, deviation_exact decimal(38,0), "
    "whitened double, explained double, identity_error double"
)


def gridded(table: DataFrame, vector: str = "embedding", *keep: str) -> tuple[DataFrame, str]:
    """``keep`` columns of the usable rows and their x-vectors, under a name that no kept column has."""
    name = fresh("x")
    v = F.transform(F.col(vector), lambda c: c.cast("double"))
    rows = table.select(*keep, v.alias(name))
    # null vectors and null components make the test null, NaN and infinities make it false
    usable = F.forall(F.col(name), lambda c: F.coalesce(F.abs(c) <= WIDEST, F.lit(False)))
    x = F.transform(F.col(name), lambda c: F.floor(c * F.lit(float(STEPS))).cast("long") + F.lit(OFFSET).cast("long"))
    return rows.where(usable).withColumn(name, x), name


def _block(column: pa.Array) -> np.ndarray:
    """Rows by dimensions of a list column whose lists are equally long."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def pair_squares(z: np.ndarray) -> list[list[int]]:
    """For each dimension i: the sum of squares of z_i, then of z_i + z_j for each j > i; exact."""
    d = z.shape[1]
    widest = int(np.abs(z).max(initial=0))
    if 4 * widest * widest * max(1, len(z)) >= 1 << 62:
        z = z.astype(object)
    out = []
    for i in range(d):
        own = z[:, i : i + 1]
        sums = own + z[:, i + 1 :]
        out.append([int((own * own).sum()), *map(int, (sums * sums).sum(axis=0))])
    return out


@dataclass(frozen=True)
class Whitening:
    """What a fit knows: n vectors, exact sums S per dimension, V's unit eigenvectors by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The integers nearest to the means, and what is left of each sum (S - n * centre)."""
        whole = [round(Fraction(s, self.n)) for s in self.sums]
        return np.array(whole, np.int64), np.array([s - self.n * w for s, w in zip(self.sums, whole)], np.float64)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened components of x-vectors."""
        whole, rest = self.centre()
        return ((x - whole) - rest / self.n) @ self.vectors / np.sqrt(self.values)


def fit(distinct: DataFrame, name: str, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a written table of distinct x-vectors (column ``name``); None if nothing varies."""
    lengths = distinct.groupBy(F.size(name).alias("d")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not most or not most[0]["d"]:
        return None
    d, n = most[0]["d"], most[0]["count"]
    distinct = distinct.where(F.size(name) == d)

    def sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d, object)
        for b in parts:
            if b.num_rows:
                total += _block(b.column(0)).sum(axis=0, dtype=object)
        yield _numbers(list(enumerate(total.tolist())))

    found = _added(distinct, sums)
    total = [found[i] for i in range(d)]
    centre = np.array([round(Fraction(s, n)) for s in total], np.int64)
    place = [sum(d - k for k in range(i)) for i in range(d)]  # where the squares of dimension i begin

    def squares(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[int]] | None = None
        for b in parts:
            for k in range(0, b.num_rows, BLOCK):
                new = pair_squares(_block(b.column(0).slice(k, BLOCK)) - centre)
                held = new if held is None else [[p + q for p, q in zip(r, s)] for r, s in zip(held, new)]
        if held is not None:
            yield _numbers([(place[i] + j, v) for i, row in enumerate(held) for j, v in enumerate(row)])

    found = _added(distinct, squares)
    rest = [s - n * int(c) for s, c in zip(total, centre)]

    def variance(i: int, j: int) -> Fraction:
        """Of z_i (i = j) or z_i + z_j over the fit list."""
        off = rest[i] if i == j else rest[i] + rest[j]
        return Fraction(n * found[place[i] + j - i] - off * off, n * n)

    own = [variance(i, i) for i in range(d)]
    v = np.zeros((d, d))
    for i in range(d):
        v[i, i] = float(own[i])
        for j in range(i + 1, d):
            v[i, j] = v[j, i] = float((variance(i, j) - own[i] - own[j]) / 2)
    trace = float(sum(own))
    values, vectors = np.linalg.eigh(v)
    order = [k for k in np.argsort(-values, kind="stable")[:components] if values[k] > NOISE * trace]
    if not order:
        return None
    vectors = vectors[:, order]
    heads = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))]
    return Whitening(n, total, values[order], vectors * np.sign(heads), trace)


def _numbers(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    """Places and whole numbers, these as text: a task's sums may exceed a long."""
    return pa.RecordBatch.from_arrays([pa.array([p for p, _ in pairs], pa.int32()), pa.array([str(v) for _, v in pairs])], names=["at", "v"])


def _added(table: DataFrame, run) -> dict[int, int]:
    """Exact totals by place of what the tasks hand on; as many rows as places come to the driver."""
    parts = table.mapInArrow(run, "at int, v string")
    totals = parts.groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    return {r["at"]: int(r["v"]) for r in totals.collect()}


def identity_error(distinct: DataFrame, name: str, w: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, measured on its vectors."""
    k = len(w.values)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for b in parts:
            for s in range(0, b.num_rows, BLOCK):
                y = w.project(_block(b.column(0).slice(s, BLOCK)))
                total += np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["at", "v"])

    rows = distinct.where(F.size(name) == w.dimensions).mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(k + k * k)
    for r in rows:
        total[r["at"]] = r["v"] / w.n
    covariance = total[k:].reshape(k, k) - np.outer(total[:k], total[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def deviations(x: np.ndarray, w: Whitening) -> pa.Array:
    """Sum over dimensions of (n x - S)^2, exact, as decimals."""
    whole, _ = w.centre()
    z = x - whole
    rest = [s - w.n * int(c) for s, c in zip(w.sums, whole)]
    widest = w.n * (int(np.abs(z).max(initial=0)) + 1)
    if widest * widest * w.dimensions < 1 << 62:
        y = w.n * z - np.array(rest, np.int64)
        return pa.array((y * y).sum(axis=1)).cast(pa.decimal128(38, 0))
    y = w.n * z.astype(object) - np.array(rest, object)
    return pa.array([Decimal(int(s)) if s < 10**38 else None for s in (y * y).sum(axis=1)], pa.decimal128(38, 0))


def whitened(table: DataFrame, components: int = COMPONENTS, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row per usable row of ``table`` and component: see ``ROWS``."""
    spark = table.sparkSession
    rows, name = gridded(table, vector, key)
    distinct = written(rows.select(name).distinct(), "whitening")
    w = fit(distinct, name, components)
    if w is None:
        return spark.createDataFrame([], ROWS)
    k, explained = len(w.values), w.values / w.trace
    error = identity_error(distinct, name, w)
    most = pa.scalar(Decimal((1 << 63) - 1), pa.decimal128(38, 0))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for s in range(0, batch.num_rows, BLOCK):
                b = batch.slice(s, BLOCK)
                x = _block(b.column(1))
                exact = deviations(x, w)
                fits = pc.if_else(pc.less_equal(exact, most), exact, None).cast(pa.int64())
                again = pa.array(np.repeat(np.arange(len(x)), k))
                size = len(x) * k
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(again),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(size, w.n, np.int64)),
                        fits.take(again),
                        exact.take(again),
                        pa.array(w.project(x).ravel()),
                        pa.array(np.tile(explained, len(x))),
                        pa.array(np.full(size, error)),
                    ],
                    names=[c.split()[0] for c in ROWS.split(", ")],
                )

    usable = rows.where(F.size(name) == w.dimensions).select(F.col(key).cast("long").alias("vec_id"), name)
    return usable.mapInArrow(run, ROWS)
