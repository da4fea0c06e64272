"""Operator 13 against numpy and exact rational arithmetic."""

from fractions import Fraction

import numpy as np
import pytest

from tunefold.llm import whitening
from tunefold.llm.queries import op13_polarised_whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def _x(vectors):
    return np.floor(64 * np.asarray(vectors, float)).astype(np.int64) + 1_000_000


def _compare(rows, vectors):
    """Rows of the operator for vectors (by vec_id) against V made with exact fractions."""
    ids = sorted(vectors)
    x = _x([vectors[i] for i in ids])
    fit = sorted(set(map(tuple, x.tolist())))
    n, d = len(fit), x.shape[1]
    sums = [sum(r[k] for r in fit) for k in range(d)]
    v = np.array([[float(sum(Fraction(n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in fit) / n**3) for j in range(d)] for i in range(d)])
    values = np.linalg.eigvalsh(v)[::-1]
    got = {(r.vec_id, r.component): r for r in rows}
    k = max(c for _, c in got)
    assert set(got) == {(i, c) for i in ids for c in range(1, k + 1)}
    centred = x - np.array([float(Fraction(s, n)) for s in sums])
    for c in range(1, k + 1):
        w = np.array([got[i, c].whitened for i in ids])
        # the component that the whitened values come from: a unit eigenvector of V
        u = np.linalg.lstsq(centred, w * np.sqrt(values[c - 1]), rcond=None)[0]
        assert np.abs(centred @ u - w * np.sqrt(values[c - 1])).max() < 1e-7
        if len(fit) > d:
            assert abs(np.linalg.norm(u) - 1) < 1e-9 and np.abs(v @ u - values[c - 1] * u).max() < 1e-8 * values[0]
    for i, row in zip(ids, x.tolist()):
        r = got[i, 1]
        assert r.n == n and r.deviation == r.deviation_exact == sum((n * a - s) ** 2 for a, s in zip(row, sums))
        assert r.identity_error < 1e-9
        for c in range(1, k + 1):
            assert got[i, c].explained == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
    return k


def test_against_fractions(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 5)) @ rng.normal(size=(5, 5)) + 3
    vectors = {i: base[i % 60].astype(np.float32) for i in range(75)}  # repeats count once in the fit
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in vectors.items()], SCHEMA).repartition(4)
    assert _compare(whitening.whitened(df).collect(), vectors) == 5


def test_whole_table(spark, sf):
    rows = op13_polarised_whitening(spark, sf).collect()
    table = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = _x([r.embedding for r in table])
    fit = np.unique(x, axis=0)
    v = np.cov((fit - 1_000_000).T, bias=True)
    values, vectors = np.linalg.eigh(v)
    want = (x - fit.mean(axis=0)) @ vectors[:, ::-1][:, :16] / np.sqrt(values[::-1][:16])
    got = {(r.vec_id, r.component): r.whitened for r in rows}
    assert len(got) == len(rows) == 16 * len(table)
    for k, r in enumerate(table):
        assert np.allclose(np.abs([got[r.vec_id, c] for c in range(1, 17)]), np.abs(want[k]), atol=1e-7)


def test_a_common_offset_costs_no_digits():
    rng = np.random.default_rng(4)
    z = rng.integers(-9, 9, (50, 4))
    small = whitening.pair_squares(z)
    assert small == whitening.pair_squares(z.astype(object))
    wide = whitening.pair_squares(z * (1 << 40))  # beyond what 64 bits add up
    assert wide == [[s << 80 for s in r] for r in small]


def test_large_values_are_exact(spark):
    vectors = {i: [float(v) for v in np.random.default_rng(i).integers(-(1 << 39), 1 << 39, 3)] for i in range(12)}
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors.items()], "vec_id long, embedding array<double>, label int")
    rows = whitening.whitened(df).collect()
    x = [[int(64 * c) + 1_000_000 for c in v] for v in vectors.values()]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((12 * a - s) ** 2 for a, s in zip(r, sums)) for i, r in zip(vectors, x)}
    assert {r.vec_id: int(r.deviation_exact) for r in rows} == want
    assert all(r.deviation is None for r in rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = {1: [0.5, 1.0], 2: [-0.5, 0.25], 3: [0.125, 0.75]}
    odd = [(4, None), (5, [1.0, None]), (6, [nan, 1.0]), (7, [1.0, -inf]), (8, []), (9, [1.0]), (None, [0.5, 1.0]), (1, [0.5, 1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in [*good.items(), *odd]], SCHEMA)
    rows = whitening.whitened(df).collect()
    assert sorted((r.vec_id or 0, r.component) for r in rows) == sorted((i, c) for i in (0, 1, 1, 2, 3) for c in (1, 2))
    assert {r.n for r in rows} == {3}
    _compare([r for r in rows if r.vec_id in (2, 3) or r.vec_id == 1], good)
    assert whitening.whitened(df.limit(0)).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0], 1) for i in range(5)], SCHEMA)  # no variance
    assert whitening.whitened(same).collect() == []
    clash = df.withColumnsRenamed({"label": "n"}).withColumn("component", df.vec_id).withColumn("x", df.vec_id)
    assert len(whitening.whitened(clash).collect()) == len(rows)


def test_a_component_without_variance_is_left_out(spark):
    df = spark.createDataFrame([(i, [float(i), 2.0, float(i)], 1) for i in range(9)], SCHEMA)
    rows = whitening.whitened(df).collect()
    assert {r.component for r in rows} == {1} and rows[0].explained == pytest.approx(1.0)
