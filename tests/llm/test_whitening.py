import math

import numpy as np
import pytest

from adstream.llm.feast import above, largest, tridiagonal
from adstream.llm.whitening import whitened

SCHEMA = "vec_id long, embedding array<float>, n long, component string, length int, label int"


def random_matrix(seed, size, values=None):
    draw = np.random.default_rng(seed)
    if values is None:
        made = draw.normal(size=(size * 3, size))
        return made.T @ made
    turn, _ = np.linalg.qr(draw.normal(size=(size, size)))
    made = turn @ np.diag(values) @ turn.T
    return (made + made.T) / 2


MATRICES = [
    *(random_matrix(k, size) for k, size in enumerate((1, 2, 7, 8, 9, 64, 130))),
    random_matrix(1, 40, [5.0] * 12 + [1.0] * 28),
    random_matrix(2, 40, [5.0] * 7 + [5 - 1e-5, 5 - 2e-5] + [1.0] * 31),
    random_matrix(3, 40, np.logspace(0, -30, 40)),
    random_matrix(4, 40, np.linspace(100, 99.9, 40)),
    random_matrix(5, 30, [1e9] + [1.0] * 29),
    np.eye(20),
    np.zeros((10, 10)),
    np.diag([3.0, 0, 0, 0, 0, 0, 0, 0, 0, 0]),
]


@pytest.mark.parametrize("k", range(len(MATRICES)))
def test_contours_give_the_largest_eigenvalues(k):
    matrix = MATRICES[k]
    values, vectors = largest(matrix, 8)
    expected = np.linalg.eigvalsh(matrix)[::-1][:8]
    scale = max(np.abs(expected).max(), 1e-300)
    assert np.abs(values - expected).max() <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-12 * scale


@pytest.mark.parametrize("k", range(len(MATRICES)))
def test_inertia_counts_eigenvalues(k):
    matrix = MATRICES[k]
    exact = np.linalg.eigvalsh(matrix)
    size = np.abs(exact).max() + 1
    shifts = np.linspace(-size, size, 41) + 0.0123
    clear = np.array([np.abs(exact - s).min() > 1e-9 * size for s in shifts])
    counts = above(tridiagonal(matrix), shifts)
    assert (counts == [(exact > s).sum() for s in shifts])[clear].all()


def brute(rows, components=8):
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    made = []
    for length in {len(v) for _, v in kept}:
        these = [(i, v) for i, v in kept if len(v) == length]
        x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in these]
        n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
        centred = np.array([[c - s / n for c, s in zip(v, sums, strict=True)] for v in x])
        cov = centred.T @ centred / n
        values, vectors = np.linalg.eigh(cov)
        values, vectors = values[::-1], vectors[:, ::-1]
        for k in range(min(components, length)):
            if values[k] > 1e-12 * np.trace(cov):
                scores = centred @ vectors[:, k] / math.sqrt(values[k])
                for (i, _), row, w in zip(these, x, scores, strict=True):
                    dev = sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True))
                    made.append((i, k + 1, n, dev, w, values[k] / np.trace(cov)))
    return made


def check(spark, rows):
    df = spark.createDataFrame([(i, v, 5, "x", 6, 7) for i, v in rows], SCHEMA)
    got = whitened(df.repartition(3), "vec_id", "embedding").collect()

    def exact(r):
        return (str(r[0]), *r[1:4])

    expected = brute(rows)
    assert sorted(map(exact, got)) == sorted(map(exact, expected))
    for part in {(r[1], r[2]) for r in expected}:
        one = sorted((r for r in expected if (r[1], r[2]) == part), key=exact)
        two = sorted((r for r in got if (r.component, r.n) == part), key=exact)
        a, b = (np.array([r[4] for r in rows]) for rows in (one, two))
        if len(set(map(exact, one))) == len(one):
            assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
        assert all(abs(r.explained / one[0][5] - 1) < 1e-9 for r in two)
    assert all(r.identity_error < 1e-9 for r in got)
    return got


def test_equals_brute_force(spark):
    draw = np.random.default_rng(6)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(draw.normal(size=(300, 12)) * np.arange(1, 13))]
    assert len(check(spark, rows)) == 2400


def test_odd_vectors_and_lengths(spark):
    draw = np.random.default_rng(7)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(draw.normal(size=(40, 9)))]
    rows += [(100 + k, [float(c) for c in v]) for k, v in enumerate(draw.normal(size=(30, 3)))]
    rows += [(200, None), (201, []), (202, [1.0, None] + [0.0] * 7), (203, [math.nan] * 9), (204, [math.inf] * 9)]
    rows += [(None, [0.5] * 9), (205, [0.0] * 9), (205, [1.0] * 9), (1, [0.25] * 9)]
    got = check(spark, rows)
    assert not {r.vec_id for r in got} & {200, 201, 202, 203, 204}
    assert {r.n for r in got} == {44, 30}


def test_vectors_without_variance(spark):
    assert check(spark, []) == []
    assert check(spark, [(1, [1.0, 2.0])]) == []
    assert check(spark, [(k, [1.0, 2.0]) for k in range(5)]) == []
    assert {r.component for r in check(spark, [(k, [1.0, float(k)]) for k in range(5)])} == {1}


def test_large_entries_do_not_wrap(spark):
    rows = [(k, [1e14 * k, 1.0, 5e30 if k == 9 else 0.0]) for k in range(8)]
    df = spark.createDataFrame([(i, v, 5, "x", 6, 7) for i, v in rows + [(9, rows[0][1][:2] + [5e30])]], SCHEMA)
    got = whitened(df, "vec_id", "embedding").collect()
    assert {r.vec_id for r in got} == set(range(8)) and {r.deviation for r in got} == {None}
    assert all(abs(r.whitened) < 3 for r in got)
