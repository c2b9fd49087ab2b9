import math
from fractions import Fraction

import numpy as np
import pytest

from ledgerlake.llm import queries, whitening

SF = "/root/testdata/sf0.01"


def random_symmetric(rng, values):
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
    a = q * values @ q.T
    return (a + a.T) / 2


def test_counts_are_those_of_the_eigenvalues():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 8, 33):
        for _ in range(20):
            a = random_symmetric(rng, rng.normal(size=n) * 10.0 ** rng.integers(-4, 5, n))
            assert whitening.positive_count(a) == (np.linalg.eigvalsh(a) > 0).sum()
    hollow = np.array([[0.0, 1, 0], [1, 0, 0], [0, 0, 0]])  # zero diagonal: a pivot of two rows
    assert whitening.positive_count(hollow) == 1 and whitening.positive_count(np.zeros((4, 4))) == 0


@pytest.mark.parametrize("values", [
    np.arange(40, 0, -1.0), 2.0 ** -np.arange(12), np.array([3.0, 3, 3, 1, 1, 0, 0]), np.array([1 + 1e-13, 1, 0.5]),
    np.array([5.0]), np.array([7.0, 0, 0, 0]), np.full(6, 2.0)])
def test_leading_pairs(values):
    v = random_symmetric(np.random.default_rng(2), values)
    got, vectors = whitening.leading_eigenpairs(v, min(8, len(values)))
    want = np.sort(values)[::-1][:8]
    assert len(got) == (want > 0).sum()
    assert np.abs(got - want[:len(got)]).max() < 1e-13 * want[0] * len(values)
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-9
    assert np.abs(v @ vectors - vectors * got).max() < 1e-12 * want[0] * len(values)


def plain(vectors, components=8):
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(row, sums)] for row in x])
    v = centred.T @ centred / n
    values, directions = np.linalg.eigh(v)
    values, directions = values[::-1][:components], directions[:, ::-1][:, :components]
    return n, deviation, centred @ directions / np.sqrt(values), values / v.trace()


def test_query_matches_plain_version(spark):
    given = {r.vec_id: r.embedding for r in queries.table(spark, SF, "embeddings").collect()}
    ids = sorted(given)
    n, deviation, whitened, explained = plain([given[i] for i in ids])
    got = {(r.vec_id, r.component): r for r in queries.op11_whitening(spark, SF).collect()}
    assert len(got) == 8 * len(ids)
    for k in range(8):
        column = np.array([got[i, k + 1].whitened for i in ids])
        sign = np.sign(column @ whitened[:, k])
        assert np.abs(column * sign - whitened[:, k]).max() < 1e-8
        assert abs(got[ids[0], k + 1].explained / explained[k] - 1) < 1e-10
    assert [got[i, 1].deviation for i in ids] == deviation and {r.n for r in got.values()} == {n}
    assert {r.identity_error for r in got.values()}.pop() < 1e-9


def rows_of(spark, rows, **options):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, vector string, x long")
    return whitening.whitening_report(table, **options).collect()


def test_what_is_left_out_and_small_tables(spark):
    rng = np.random.default_rng(3)
    good = [(i if i else None, rng.normal(size=3).tolist(), "a", 1) for i in range(20)] * 2
    bad = [(90, None, "", 0), (91, [], "", 0), (92, [1.0, None, 2.0], "", 0), (93, [1.0, math.nan, 2.0], "", 0),
           (94, [math.inf, 1.0, 1.0], "", 0), (95, [1.0, 2.0], "", 0)]
    got = rows_of(spark, good + bad)
    assert len(got) == 40 * 3 and {r.vec_id for r in got} == {None, *range(1, 20)}
    assert abs(sum(r.explained for r in got) / 40 - 1) < 1e-9
    assert rows_of(spark, []) == [] and rows_of(spark, bad[:2]) == []
    assert rows_of(spark, [(1, [1.0, 2.0], "", 0)] * 3) == []  # no spread, no components
    line = rows_of(spark, [(i, [float(i), 2.0 * i, 0.5], "", 0) for i in range(9)])
    assert {r.component for r in line} == {1} and len(line) == 9 and line[0].identity_error < 1e-9


def test_exact_deviations_beyond_a_long(spark):
    rows = [(i, [1e9 * (i - 20), -3e8 * i * i, 7.25], "", 0) for i in range(40)]
    got = {r.vec_id: r for r in rows_of(spark, rows, components=2) if r.component == 1}
    _, deviation, _, _ = plain([r[1] for r in rows], 2)
    assert [int(got[i].deviation_exact) for i in range(40)] == deviation
    assert all(r.deviation == (int(r.deviation_exact) if r.deviation_exact < 1 << 63 else None) for r in got.values())
    assert any(r.deviation is None for r in got.values())
    # the second component is 0 up to rounding beside the first
    assert len(rows_of(spark, [(i, [1e300 * (-1) ** i, float(i)], "", 0) for i in range(4)])) == 4
