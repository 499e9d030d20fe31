import math

import numpy as np
import pytest

from strata.llm.whitening import COMPONENTS, Centre, components, fit, op13_whitening, polar, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(rows):
    return [(r.vec_id, r.embedding) for r in rows
            if r.embedding and all(c is not None and math.isfinite(c) for c in r.embedding)]


def brute(rows):
    """By numpy's own eigensolver and Python integers."""
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in v] for _, v in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    y = np.array([[float(n * a - b) / n for a, b in zip(row, s)] for row in x])
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1], q[:, ::-1]
    return n, [sum((n * a - b) ** 2 for a, b in zip(row, s)) for row in x], y, e, q


def check(rows, got):
    n, dev, y, e, q = brute(rows)
    k = min(COMPONENTS, y.shape[1])
    assert len(got) == n * k
    by = {(r.vec_id, r.component): r for r in got}
    for c in range(1, k + 1):
        white = y @ q[:, c - 1] / np.sqrt(e[c - 1])
        mine = np.array([by[i, c].whitened for i, _ in rows])
        assert np.allclose(mine, white, atol=1e-7) or np.allclose(-mine, white, atol=1e-7)
    for (i, _), d in zip(rows, dev):
        r = by[i, 1]
        assert (r.n, r.deviation) == (n, d)
    assert all(abs(r.explained / (e[r.component - 1] / e.sum()) - 1) < 1e-9 and r.identity_error < 1e-9 for r in got)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_tables(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()
    check(usable(rows), op13_whitening(spark, f"/root/testdata/{sf}").collect())


@pytest.mark.parametrize("size", [1, 2, 5, 40])
def test_polar_factor(size):
    a = np.random.default_rng(size).normal(size=(size, size))
    u, _, w = np.linalg.svd(a)
    assert np.allclose(polar(a), u @ w, atol=1e-11)


@pytest.mark.parametrize("spectrum", [[3.0], [2, 2, 2, 2], [5, 5, 1, 1, 0, 0], list(range(1, 31)), [10.0 ** -i for i in range(12)],
                                      [1e6] + [1.0] * 20, [0, 0, 0], [1 + 1e-9 * i for i in range(10)]])
def test_components_of_known_spectra(spectrum):
    size = len(spectrum)
    q, _ = np.linalg.qr(np.random.default_rng(7).normal(size=(size, size)))
    v = q @ np.diag(spectrum) @ q.T
    v = (v + v.T) / 2
    values, vectors = components(v, size)
    assert np.allclose(values, sorted(spectrum, reverse=True), atol=1e-13 * max(1, max(spectrum)) * size)
    assert np.allclose(vectors @ vectors.T, np.eye(size), atol=1e-13)
    assert np.abs(v @ vectors.T - vectors.T * values).max() <= 1e-13 * max(1, max(spectrum)) * size
    few = components(v, 3)[0]
    assert np.allclose(few, values[:3], atol=1e-12 * max(1, max(spectrum)))


def test_unusable_rows_ties_and_clashing_columns(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=5)], i) for i in range(300)]
    rows += [(5, rows[5][1], 1), (None, rows[6][1], None)]
    bad = [(900, None, 1), (901, [], 1), (902, [1.0, None, 1.0, 1.0, 1.0], 1), (903, [1.0, math.nan, 1.0, 1.0, 1.0], 1),
           (904, [1.0, math.inf, 1.0, 1.0, 1.0], 1), (905, [1.0, 2.0], 1), (906, [3e38] * 5, 1)]
    df = spark.createDataFrame(rows + bad, SCHEMA).selectExpr("*", "1 as v", "2 as n", "3 as component", "4 as whitened").repartition(7)
    got = whiten(df, fit(df)).collect()
    assert len(got) == 302 * 5 and {r.vec_id for r in got} == set(range(300)) | {None}
    unique = [(i if i is not None else -1, v) for i, v, _ in rows]
    n, dev, _, e, _ = brute(unique)
    assert {(r.n, round(r.explained, 12)) for r in got} == {(n, round(x, 12)) for x in e / e.sum()}
    assert sorted(r.deviation for r in got if r.component == 2) == sorted(dev)


def test_degenerate_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert whiten(none, fit(none)).collect() == []
    same = spark.createDataFrame([(i, [1.5, -2.0], 0) for i in range(4)], SCHEMA)
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in whiten(same, fit(same)).collect()} == {(4, 0, None, None, 0.0)}
    line = spark.createDataFrame([(i, [float(i), float(i), 0.0], 0) for i in range(10)], SCHEMA)
    got = whiten(line, fit(line)).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in got) and got[0].identity_error < 1e-9
    assert all(abs(r.explained - (r.component == 1)) < 1e-9 for r in got)


def test_exact_deviations():
    centre = Centre.of(3, [10 ** 15 + 1, 5])
    x = np.array([[10 ** 15, 0], [0, 0], [1, 5]])
    want = [sum((3 * int(a) - s) ** 2 for a, s in zip(row, (10 ** 15 + 1, 5))) for row in x]
    assert centre.deviations(x) == [w if w < 1 << 63 else None for w in want]
    small = Centre.of(3, [7, 5])
    assert small.deviations(np.array([[7, 0], [0, 0], [0, 5]])) == [(21 - 7) ** 2 + 25, 49 + 25, 49 + 100]
