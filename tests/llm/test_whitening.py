import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tessera.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>, label int, component int, n string"


def table(spark, vectors, ids=None):
    ids = list(range(len(vectors))) if ids is None else ids
    return spark.createDataFrame([(i, v, 1, 7, "x") for i, v in zip(ids, vectors)], SCHEMA).repartition(3)


def integers(vector):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector]


def brute_force(vectors):
    """n, sums, exact covariance (as doubles), exact deviations."""
    x = [integers(v) for v in vectors]
    n, dims = len(x), len(x[0])
    sums = [sum(row[i] for row in x) for i in range(dims)]
    means = [Fraction(s, n) for s in sums]
    cov = np.array([[float(sum((r[i] - means[i]) * (r[j] - means[j]) for r in x) / n) for j in range(dims)] for i in range(dims)])
    return x, n, sums, cov, [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]


def correlated(rng, count, dims):
    mix = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(dims)]
    out = []
    for _ in range(count):
        z = [rng.gauss(0, 0.3) / (k + 1) for k in range(dims)]
        out.append([sum(a * b for a, b in zip(row, z)) for row in mix])
    return out


def check(rows, vectors, ids, components):
    x, n, sums, cov, deviations = brute_force(vectors)
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis[:, ::-1]
    assert len(rows) == len(vectors) * components
    signs = {}
    for r in rows:
        i, k = ids.index(r["vec_id"]), r["component"] - 1
        centred = np.array([float(Fraction(c) - Fraction(s, n)) for c, s in zip(x[i], sums)])
        want = centred @ basis[:, k] / math.sqrt(values[k])
        sign = signs.setdefault(k, 1 if want * r["whitened"] >= 0 else -1)
        assert r["whitened"] == pytest.approx(sign * want, abs=1e-8)
        assert (r["n"], r["deviation"]) == (n, deviations[i])
        assert r["explained"] == pytest.approx(values[k] / cov.trace(), rel=1e-9)
        assert r["identity_error"] < 1e-8


def test_matches_exact_arithmetic(spark):
    vectors = correlated(random.Random(1), 150, 6)
    check(w.whiten(table(spark, vectors), components=4).collect(), vectors, list(range(150)), 4)


def test_polarisation_is_exact():
    rng = random.Random(2)
    for reach in (50, 1 << 33, 1 << 59):
        d = np.array([[rng.randrange(-reach, reach) for _ in range(5)] for _ in range(40)])
        squares = list(w._square_sums(d))
        sums = [int(s) for s in d.astype(object).sum(axis=0)]
        got = w.covariance(40, sums, squares)
        for i in range(5):
            for j in range(5):
                exact = Fraction(sum(int(a) * int(b) for a, b in zip(d[:, i], d[:, j])), 40) - Fraction(sums[i] * sums[j], 1600)
                assert got[i, j] == float(exact)


def test_dropped_rows_lengths_and_ids(spark):
    good = correlated(random.Random(3), 60, 4)
    ids = [None] + list(range(1, 60))
    odd = [None, [], [0.1, None, 0.2, 0.3], [0.1, float("nan"), 0.2, 0.3], [float("inf"), 0.0, 0.0, 0.0], [0.1, 0.2]]
    df = table(spark, good + odd, ids + list(range(100, 106)))
    check(w.whiten(df, components=3).collect(), good, ids, 3)


def test_far_entries_keep_exact_sums(spark):
    rng = random.Random(4)
    vectors = [[rng.gauss(0, 1) * scale for scale in (1.0, 1e6, 1e12)] for _ in range(30)]
    x, n, sums, cov, deviations = brute_force(vectors)
    fitted = w.fit(table(spark, vectors))
    assert fitted.n == n and [int(m) * n + r for m, r in zip(fitted.means, fitted.remainders)] == sums
    assert fitted.trace == pytest.approx(cov.trace(), rel=1e-12)
    rows = w.project(table(spark, vectors), fitted, 1).collect()
    assert all(r["deviation"] == (deviations[r["vec_id"]] if deviations[r["vec_id"]] < 2**63 else None) for r in rows)
    beyond = w.whiten(table(spark, [[3e38, 1.0], [-3e38, 2.0], [0.0, 5.0]]), 1).collect()
    assert len(beyond) == 3 and all(math.isfinite(r["whitened"]) for r in beyond)


def test_constant_repeated_and_empty(spark):
    line = [[0.5, float(i % 4)] for i in range(20)]  # one constant dimension: one component
    rows = w.whiten(table(spark, line, [i // 2 for i in range(20)])).collect()
    assert len(rows) == 20 and {r["component"] for r in rows} == {1} and rows[0]["identity_error"] < 1e-12
    assert w.whiten(table(spark, [[0.5, 1.0]] * 5)).collect() == []
    assert w.whiten(table(spark, [None, []])).collect() == []
    assert w.whiten(table(spark, [])).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
