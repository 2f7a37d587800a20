import math
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest
from helpers import saved

from txnlake.llm import whitening
from txnlake.llm.queries import op11_whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, folder, vectors, schema=SCHEMA, values=(1,)):
    rows = [(v[0], v[1], *values) if isinstance(v, tuple) else (i, v, *values) for i, v in enumerate(vectors)]
    return saved(spark, folder, rows, schema)


def integers(vectors):
    return [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]


def check(found, vectors, components=8):
    """Against Python integers and an eigensolver of another kind."""
    x = integers(vectors)
    n, d = len(x), len(x[0])
    sums = [sum(col) for col in zip(*x, strict=True)]
    scatter = [
        [n * sum(r[i] * r[j] for r in x) - sums[i] * sums[j] for j in range(d)] for i in range(d)
    ]
    values, axes = np.linalg.eigh(np.array(scatter, float))
    values, axes = values[::-1], axes[:, ::-1]
    count = min(components, d, int((values > 1e-9 * values[0]).sum()) if values[0] > 0 else 0)
    assert len(found) == n * count
    trace = sum(scatter[i][i] for i in range(d))
    by_row = {}
    for r in found:
        assert r.n == n and r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-8)
        by_row.setdefault((r.vec_id, r.deviation), {})[r.component] = r.whitened
    signs = {}
    for i, row in enumerate(x):
        deviation = sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True))
        got = by_row[i, deviation]
        assert sorted(got) == list(range(1, count + 1))
        centred = np.array([float(Fraction(n * a - s, n)) for a, s in zip(row, sums, strict=True)])
        for k, value in got.items():
            wanted = centred @ axes[:, k - 1] / math.sqrt(values[k - 1] / n**2)
            if k not in signs and abs(wanted) > 1e-3:
                signs[k] = np.sign(wanted * value)
            assert value * signs.get(k, 1) == pytest.approx(wanted, abs=1e-6)
    return count


def test_random_vectors(spark, tmp_path):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(0, 1, (60, 11)) @ rng.normal(0, 0.3, (11, 11))).astype("f4").tolist()
    assert check(whitening.whiten(table(spark, tmp_path, vectors)).collect(), vectors) == 8


def test_fewer_dimensions_than_components_and_no_variance_in_one(spark, tmp_path):
    rng = np.random.default_rng(2)
    # Multiples of 1/64, so that the dependence holds for the integers.
    vectors = np.round(rng.normal(0, 1, (40, 4)) * 64) / 64
    vectors[:, 3] = 0.5
    vectors[:, 2] = vectors[:, 0] - vectors[:, 1]
    vectors = vectors.tolist()
    assert check(whitening.whiten(table(spark, tmp_path, vectors)).collect(), vectors) == 2


def test_equal_eigenvalues_get_orthogonal_components(spark, tmp_path):
    vectors = [[s * (i == j) * 0.5 for j in range(5)] for i in range(5) for s in (1, -1)]
    found = whitening.whiten(table(spark, tmp_path, vectors)).collect()
    assert {r.component for r in found} == {1, 2, 3, 4, 5}
    assert all(r.identity_error < 1e-12 for r in found)
    assert all(r.explained == pytest.approx(0.2, rel=1e-12) for r in found)
    w = np.zeros((10, 5))
    for r in found:
        w[r.vec_id, r.component - 1] = r.whitened
    assert np.allclose(w.T @ w / 10, np.eye(5), atol=1e-12)


def test_unusable_and_repeated_rows(spark, tmp_path):
    rng = np.random.default_rng(3)
    good = rng.normal(0, 1, (12, 3)).astype("f4").tolist()
    bad = [None, [1.0, None, 2.0], [math.nan, 0.0, 0.0], [math.inf, 0.0, 0.0], [-math.inf, 1.0, 1.0],
           [1e30, 0.0, 0.0], [1.0, 2.0], [], [1.0, 2.0, 3.0, 4.0]]
    rows = [*enumerate(good), *[(100 + i, v) for i, v in enumerate(bad)]]
    wide = SCHEMA + ", v int, id string, component string, n string, deviation string"
    docs = table(spark, tmp_path, rows, wide, (1, 2, "i", "c", "n", "d"))
    found = whitening.whiten(docs).collect()
    assert check(found, good) == 3
    twice = table(spark, tmp_path, [*enumerate(good), (None, good[0]), (3, good[3]), (3, good[3])])
    found = whitening.whiten(twice).collect()
    assert len(found) == 45 and {r.n for r in found} == {15}
    assert sum(r.vec_id is None for r in found) == 3 and sum(r.vec_id == 3 for r in found) == 9


def test_large_entries_are_exact(spark, tmp_path):
    vectors = [[2.0**40, 1.0], [-(2.0**41), 3.0], [2.0**39 + 2.0**20, -5.0], [0.0, 2.0**45]]
    found = whitening.whiten(table(spark, tmp_path, vectors)).collect()
    x = integers(vectors)
    sums = [sum(c) for c in zip(*x, strict=True)]
    for r in found:
        exact = sum((4 * a - s) ** 2 for a, s in zip(x[r.vec_id], sums, strict=True))
        assert r.deviation_exact == exact and r.deviation == (exact if exact < 1 << 63 else None)
        assert r.identity_error < 1e-9


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None], [[], []]])
def test_without_variance_there_is_no_component(spark, tmp_path, vectors):
    found = whitening.whiten(table(spark, tmp_path, vectors))
    assert found.count() == 0 and found.columns[0] == "vec_id"


def determinant(m):
    out = Fraction(0)
    for order in permutations(range(len(m))):
        sign = (-1) ** sum(a > b for i, a in enumerate(order) for b in order[i + 1 :])
        out += sign * math.prod(m[i][j] for i, j in enumerate(order))
    return out


def test_polynomial_is_the_determinant(spark):
    rng = np.random.default_rng(4)
    a = rng.integers(-(10**6), 10**6, (5, 3)).astype(object)
    matrix = a @ a.T  # of rank 3
    polynomial = whitening.characteristic_polynomial(spark, matrix)
    assert polynomial[0] == polynomial[1] == 0 and polynomial[5] == 1
    for x in (-3, 10**9, 12345678901234567890):
        shifted = [[x * (i == j) - int(matrix[i, j]) for j in range(5)] for i in range(5)]
        assert determinant(shifted) == sum(c * x**k for k, c in enumerate(polynomial))


def test_polynomial_modulo_a_prime_with_zero_pivots():
    p = 2_147_483_647
    matrix = np.array([[1, 2, 0, 3], [0, 4, 0, 1], [5, 0, 6, 0], [0, 7, 0, 8]])
    found = whitening.hessenberg_polynomial(matrix % p, p)
    for x in range(5):
        shifted = [[x * (i == j) - int(matrix[i, j]) for j in range(4)] for i in range(4)]
        assert determinant(shifted) % p == sum(int(c) * x**k for k, c in enumerate(found)) % p


def test_roots_are_counted_and_isolated():
    polynomial = [1]
    for root in (0, 3, 3, 7, 10**20):
        polynomial = [a - root * b for a, b in zip([0, *polynomial], [*polynomial, 0], strict=True)]
    assert [whitening.roots_beyond(polynomial, a) for a in (-1, 0, 2, 3, 6, 7, 10**20)] == [5, 4, 4, 2, 2, 1, 0]
    for k, root in enumerate((10**20, 7, 3, 3), 1):
        a, s = whitening.isolated_root(polynomial, k, 10**21)
        assert (a - 1) < root << s <= a
    assert whitening.isolated_root(polynomial, 5, 10**21) is None


def test_the_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    found = op11_whitening(spark, sf_dir).collect()
    assert [r.vec_id for r in rows] == list(range(len(rows)))
    assert check(found, [r.embedding for r in rows]) == 8
