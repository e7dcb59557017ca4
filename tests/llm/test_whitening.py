"""Whitening against numpy's symmetric eigenvalues and exact integer arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from statlake.llm import exact_spectrum as X
from statlake.llm import whitening
from statlake.llm.frames import table
from statlake.llm.queries import op11_whitening
from tests.conftest import SMOKE_DIR

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string, v string, whitened string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x", "x") for i, v in rows], SCHEMA)


def scatter_of(y):
    n, d = y.shape
    y = y.astype(object)
    s, c = y.sum(0), y.T @ y
    return [[int(n * c[i, j] - s[i] * s[j]) for j in range(d)] for i in range(d)]


def polynomial(m):
    trace = sum(m[i][i] for i in range(len(m)))
    return X.combine({p: X.charpoly_mod(m, p) for p in X.primes_for(X.coefficient_bits(trace, len(m)))})


def by_traces(m):
    """Faddeev and LeVerrier's recurrence in exact fractions."""
    n = len(m)
    a, b, out = [[Fraction(x) for x in r] for r in m], [[Fraction(0)] * n for _ in range(n)], [Fraction(1)]
    for k in range(1, n + 1):
        b = [[sum(a[i][t] * b[t][j] for t in range(n)) + (out[-1] if i == j else 0) for j in range(n)] for i in range(n)]
        out.append(-sum(sum(a[i][t] * b[t][i] for t in range(n)) for i in range(n)) / k)
    return [int(x) for x in out[::-1]]


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 6), st.integers(1, 9), st.integers(0, 10 ** 6), st.sampled_from([1, 3, 10 ** 6, 2 ** 40]))
def test_polynomial_and_roots(d, n, seed, size):
    y = np.random.default_rng(seed).integers(-size, size + 1, (n, d))
    m = scatter_of(y)
    c = polynomial(m)
    assert c == by_traces(m)
    roots, once = X.isolate(c, d)
    expected = np.linalg.eigvalsh(np.array(m, float))[::-1]
    found = [float(Fraction(*_parts(X.refine(once, r)))) for r in roots for _ in range(r.times)]
    assert np.allclose(found + [0.0] * (d - len(found)), expected, atol=1e-9 * max(1.0, expected[0]))


def _parts(at):
    return at[0], 2 ** at[1]


@pytest.mark.parametrize("repeated", [
    [[1, 0], [-1, 0], [0, 1], [0, -1]],
    np.vstack([np.diag([1, 1, 2, 2, 3]), -np.diag([1, 1, 2, 2, 3])]).tolist(),
    np.vstack([np.eye(5, dtype=int), -np.eye(5, dtype=int)]).tolist()])
def test_equal_roots_give_an_orthonormal_basis(repeated):
    m = scatter_of(np.array(repeated))
    roots, once = X.isolate(polynomial(m), 99)
    vecs, vals = [], []
    for r in roots:
        a, s = X.refine(once, r)
        vecs += X.null_vectors(m, a, s, r.gap.bit_length() - 1 - r.scale, r.times)
        vals += [a / 2 ** s] * r.times
    v = np.array(vecs).T
    assert len(vals) == len(m) and np.allclose(v.T @ v, np.eye(len(m)), atol=1e-14)
    assert np.allclose(np.array(m, float) @ v, v * np.array(vals), atol=1e-12 * vals[0])


def test_close_roots_keep_their_vectors_apart():
    # two roots whose distance is 1e-12 of their size
    m = [[10 ** 15, 250, 0], [250, 10 ** 15 + 7, 0], [0, 0, 3]]
    roots, once = X.isolate(polynomial(m), 2)
    (a, s), (b, t) = (X.refine(once, r) for r in roots)
    u = X.null_vectors(m, a, s, roots[0].gap.bit_length() - 1 - roots[0].scale, 1)[0]
    w = X.null_vectors(m, b, t, roots[1].gap.bit_length() - 1 - roots[1].scale, 1)[0]
    angle = math.atan2(500, -7) / 2          # of [[0, 250], [250, 7]]
    assert abs(abs(u[0] * math.cos(angle) + u[1] * math.sin(angle)) - 1) < 1e-14
    assert abs(sum(x * y for x, y in zip(u, w))) < 1e-15


def brute(rows, most=32):
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    y = np.array([[math.floor(64 * float(np.float32(c))) for c in v] for _, v in kept])
    n = len(y)
    x = y.astype(object) + 1000000
    s = x.sum(0)
    dev = [int(sum(int(n * a - b) ** 2 for a, b in zip(r, s))) for r in x]
    cov = np.array(scatter_of(y), float) / n ** 2
    w, v = np.linalg.eigh(cov)
    w, v = w[::-1], v[:, ::-1]
    take = [k for k in range(min(most, len(w))) if w[k] > 1e-9 * w[0]]
    z = (y - y.mean(0)) @ v[:, take] / np.sqrt(w[take])
    return [i for i, _ in kept], n, dev, z, w[take] / w.sum()


def check(rows, got):
    ids, n, dev, z, explained = brute(rows)
    by = {}
    for r in got:
        by.setdefault(r["component"], {}).setdefault(r["vec_id"], []).append(r)
    assert sorted(by) == list(range(1, z.shape[1] + 1))
    assert len(got) == z.size
    for k in by:
        one = {i: by[k][i][0] for i in by[k]}
        column = np.array([one[i]["whitened"] for i in ids])
        assert min(np.abs(column - z[:, k - 1]).max(), np.abs(column + z[:, k - 1]).max()) < 1e-6
        assert abs(one[ids[0]]["explained"] - explained[k - 1]) < 1e-9
        assert [int(one[i]["deviation"]) for i in ids] == dev and one[ids[0]]["n"] == n
    assert 0 <= got[0]["identity_error"] < 1e-9 and len({r["identity_error"] for r in got}) == 1


def rows_of(seed, n, d, scale=0.2):
    r = np.random.default_rng(seed)
    mix = r.normal(0, scale, (d, d))
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(r.normal(0, 1, (n, d)) @ mix)]


def test_against_numpy(spark):
    rows = rows_of(3, 400, 7)
    check(rows, whitening.whiten(vectors(spark, rows).repartition(5)).collect())


def test_odd_rows_are_left_out(spark):
    rows = rows_of(4, 60, 4)
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [1.0, float("nan"), 2.0, 3.0]),
           (104, [1.0, float("inf"), 2.0, 3.0]), (105, [1.0, 2.0]), (106, [3e38, 1.0, 1.0, 1.0])]
    check(rows, whitening.whiten(vectors(spark, rows + odd)).collect())


def test_repeated_rows_and_null_ids_count(spark):
    rows = rows_of(5, 40, 3)
    got = whitening.whiten(vectors(spark, [(None, v) for _, v in rows] + rows[:10] + rows[:10])).collect()
    assert len(got) == 60 * 3 and got[0]["n"] == 60
    assert sum(r["vec_id"] is None for r in got) == 40 * 3


def test_fewer_rows_than_dimensions(spark):
    rows = rows_of(6, 5, 9)
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert {r["component"] for r in got} == {1, 2, 3, 4}
    check(rows, got)


def test_no_variance_no_component(spark):
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, None)])).collect() == []
    assert whitening.whiten(vectors(spark, []).where("false")).collect() == []


def test_large_entries_stay_exact(spark):
    rows = [(k, [float(np.float32((-1) ** k * 10 ** 12 * (k + 1))), float(k)]) for k in range(9)]
    ids, n, dev, _, _ = brute(rows)
    got = {r["vec_id"]: r for r in whitening.whiten(vectors(spark, rows)).where("component = 1").collect()}
    assert [int(got[i]["deviation"]) for i in ids] == dev


def test_query_on_the_given_table(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in table(spark, SMOKE_DIR, "embeddings").collect()]
    got = op11_whitening(spark, SMOKE_DIR)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    check(rows, got.collect())
