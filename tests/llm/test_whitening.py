"""Whitening against numpy's own eigenvalues and exact whole-number sums."""

import random

import numpy as np
import pytest

from docsift.llm import queries, whitening
from tests.llm.helpers import HAS_TABLES, SF_DIR

SCHEMA = "vec_id long, embedding array<float>, label int, x string, dim string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "d", "n") for i, v in rows], SCHEMA)


def brute(rows, components=4):
    good = [(i, v) for i, v in rows if v is not None and None not in v and np.isfinite(np.array(v, dtype=np.float32)).all()]
    xs = [tuple(int(np.floor(256.0 * float(np.float32(c)))) for c in v) for _, v in good]
    fit = sorted(set(xs))
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    centred = np.array([[x[j] - sums[j] / n for j in range(d)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for (i, _), x in zip(good, xs, strict=True):
        y = (np.array(x) - np.array(sums) / n) @ vectors
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        for c in range(min(components, int((values > values[0] * 1e-12).sum()))):
            out.append((i, c + 1, n, deviation, y[c] / np.sqrt(values[c]), values[c] / values.sum()))
    return out


def check(spark, rows):
    got = sorted(whitening.whitened(frame(spark, rows)).collect(), key=str)
    want = brute(rows)
    # Rows that repeat an id are told apart by what they hold.
    key = lambda r: (str(r[0]), r[1], r[3], round(abs(r[4]), 6))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want] and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error <= 1e-9
    for component in {r[1] for r in want}:
        a = np.array([r.whitened for r in got if r.component == component])
        b = np.array([r[4] for r in want if r[1] == component])
        sign = np.sign(a @ b)
        assert np.allclose(a, sign * b, rtol=1e-7, atol=1e-7)
        assert np.allclose([r.explained for r in got if r.component == component], [r[5] for r in want if r[1] == component], rtol=1e-9)


def vectors(n, d, seed, shift=0.0):
    rng = np.random.default_rng(seed)
    return [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(rng.normal(size=(n, d)) * np.arange(1, d + 1) + shift)]


def test_against_numpy(spark):
    check(spark, vectors(300, 7, 1))


def test_copies_count_once_and_odd_rows_go(spark):
    rows = vectors(60, 5, 2)
    rows += [(100 + i, rows[3][1]) for i in range(200)] + [(3, rows[3][1]), (None, rows[4][1])]
    rows += [(900, None), (901, [1.0, None, 2.0, 3.0, 4.0]), (902, [1.0, float("nan"), 0.0, 0.0, 0.0]), (903, [float("inf"), 0.0, 0.0, 0.0, 0.0])]
    random.Random(1).shuffle(rows)
    check(spark, rows)


def test_large_mean_and_few_dimensions(spark):
    check(spark, vectors(80, 2, 3, shift=10_000.0))


def test_other_lengths_go(spark):
    rows = vectors(40, 3, 4)
    got = whitening.whitened(frame(spark, [*rows, (77, [1.0, 2.0]), (78, []), (79, [0.5] * 9)])).collect()
    assert {r.vec_id for r in got} == {i for i, _ in rows}


def test_rank_below_dimension(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(a), float(b), float(a + b), 0.0]) for i, (a, b) in enumerate(rng.integers(-20, 20, size=(50, 2)))]
    got = whitening.whitened(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2} and abs(sum({r.explained for r in got}) - 1) < 1e-12
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])]])
def test_nothing_to_fit(spark, rows):
    assert whitening.whitened(frame(spark, rows)).collect() == []


def test_numbers_beyond_64_bits(spark):
    rows = [(i, [float(np.float32(s * 3e38)), float(i)]) for i, s in enumerate((1, -1, 1, -1))]
    got = whitening.whitened(frame(spark, rows)).collect()
    assert all(r.deviation is None for r in got) and {r.vec_id for r in got} == {0, 1, 2, 3}


def test_factor_and_rotations():
    rng = np.random.default_rng(6)
    a = rng.normal(size=(30, 12)) * 10.0 ** -np.arange(12)
    m = a.T @ a
    g = whitening.pivoted_cholesky(m)
    assert np.allclose(g @ g.T, m, rtol=1e-12, atol=1e-14)
    values, components = whitening.one_sided_jacobi(g)
    assert np.allclose(components.T @ components, np.eye(len(values)), atol=1e-12)
    assert np.allclose(values[:4], np.linalg.eigvalsh(m)[::-1][:4], rtol=1e-10)
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)


@pytest.mark.skipif(not HAS_TABLES, reason="no test tables")
def test_query(spark):
    got = queries.QUERIES["op13_embedding_whitening"](spark, SF_DIR)
    assert got.count() == 4 * spark.read.parquet(f"{SF_DIR}/embeddings.parquet").count()
