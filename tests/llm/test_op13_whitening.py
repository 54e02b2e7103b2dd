import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekly_impact.llm import queries as Q
from weekly_impact.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, count=4):
    """vec_id -> per component (n, deviation, |whitened|, explained), by a library eigensolver and exact integers."""
    dim = max((len(v) for _, v in rows if v is not None), default=0)
    kept = [(i, tuple(math.floor(256 * float(c)) for c in v) + (0,) * (dim - len(v))) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in kept})
    n = len(fit)
    sums = [sum(c) for c in zip(*fit)]
    x = np.array(fit, dtype=float) - np.array(sums, dtype=float) / n
    cov = x.T @ x / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:count], v[:, ::-1][:, :count]
    out = {}
    for i, y in kept:
        w = np.abs((np.array(y, dtype=float) - np.array(sums, dtype=float) / n) @ v / np.sqrt(e))
        deviation = sum((n * a - s) ** 2 for a, s in zip(y, sums))
        out.setdefault(i, []).append([(n, deviation, w[j], e[j] / np.trace(cov)) for j in range(count)])
    return out


def check(got, rows, count=4):
    want = brute(rows, count)
    found = {}
    for r in got:
        assert r.identity_error <= 1e-4
        found.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    assert set(found) == set(want)
    for i, copies in want.items():
        assert sorted(found[i]) == list(range(1, count + 1))
        for j in range(count):
            ours = sorted(found[i][j + 1], key=lambda r: abs(r.whitened))
            theirs = sorted((c[j] for c in copies), key=lambda c: c[2])
            assert len(ours) == len(theirs)
            for r, (n, deviation, w, explained) in zip(ours, theirs):
                assert (r.n, r.deviation) == (n, deviation)
                assert abs(r.whitened) == pytest.approx(w, abs=1e-7) and r.explained == pytest.approx(explained, rel=1e-8)


def test_whole_table(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    out = Q.op13_whitening(spark, path)
    assert out.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(out.dtypes) | {"component": "int", "n": "bigint", "deviation": "bigint"} == dict(out.dtypes)
    check(out.collect(), rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(c)) for c in rng.standard_normal(5) * [5, 4, 3, 2, 1]]) for i in range(300)]
    rows += [rows[7]] * 50 + [(None, rows[7][1]), (7, rows[8][1])]
    bad = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0]), (902, [float("nan")] * 5), (903, [float("inf"), 0.0, 0.0, 0.0, 0.0])]
    short = [(910, []), (911, [1.0]), (912, [1.0, 0.0])]  # 911 and 912 become equal
    df = spark.createDataFrame([(*r, None) for r in rows + bad + short], SCHEMA).repartition(5)
    for name in ("x", "n", "Component", "v"):
        df = df.withColumn(name, F.lit("other"))
    check(W.whiten_vectors(df).collect(), rows + short)


def test_no_variance_and_empty(spark):
    for rows in ([], [(1, [1.0, 2.0], None)], [(1, [0.0], None), (2, [0.0], None)], [(1, [], None)], [(1, None, None)]):
        assert W.whiten_vectors(spark.createDataFrame(rows, SCHEMA)).count() == 0
    line = [(i, [float(i), 2.0 * i, 0.0], None) for i in range(10)]  # one direction only
    out = W.whiten_vectors(spark.createDataFrame(line, SCHEMA)).collect()
    assert {r.component for r in out} == {1} and all(r.explained == pytest.approx(1) and r.identity_error < 1e-9 for r in out)


def test_huge_entries(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 3.0]), (3, [5.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = W.whiten_vectors(df).collect()
    assert len(out) and all(math.isfinite(r.whitened) for r in out) and all(r.deviation is None for r in out if r.vec_id < 3)


@pytest.mark.parametrize("values", [
    [9, 7, 5, 3, 1], [4, 4, 4, 4], [5, 5, 5, 1, 1], [1e8, 1e4, 1, 1e-4], [3, 2, 1], [1, 0, 0, 0], [10.0, 9.999999, 9.99999, 1],
    list(range(64, 0, -1)), [1 + 1e-9, 1, 1 - 1e-9, 0.5]])
def test_divide_and_conquer(values):
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    a = q @ np.diag(np.array(values, dtype=float)) @ q.T
    a = (a + a.T) / 2
    e, v = W.components(a, len(values))
    scale = max(values)
    assert np.allclose(e, sorted(values, reverse=True), atol=1e-12 * scale, rtol=0)
    assert np.abs(v.T @ v - np.eye(len(values))).max() < 1e-12
    assert np.abs(a @ v - v * e).max() < 1e-12 * scale
    few, top = W.components(a, 2)
    assert np.allclose(few, e[:2], atol=1e-12 * scale, rtol=0) and np.abs(a @ top - top * few).max() < 1e-12 * scale


def test_polar_factor():
    rng = np.random.default_rng(4)
    a = rng.standard_normal((20, 20))
    a = a + a.T
    u = W.polar_factor(a)
    assert np.abs(u @ u - np.eye(20)).max() < 1e-13 and np.linalg.eigvalsh(u @ a).min() > 0
