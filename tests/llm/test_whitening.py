import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """n, sums, deviations, axes and variances of the rows with a vector of finite numbers, by eigh."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in good]
    d = max(set(lengths), key=lambda k: (lengths.count(k), k))
    good = [(i, v) for i, v in good if len(v) == d]
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in good], object)
    n, sums = len(x), x.sum(axis=0)
    deviations = [int(sum((n * a - s) ** 2 for a, s in zip(row, sums))) for row in x]
    deviations = [v if v < 1 << 63 else None for v in deviations]
    y = np.array((n * x - sums) / n, float)
    variances, axes = np.linalg.eigh(y.T @ y / n)
    return [i for i, _ in good], n, deviations, y, variances[::-1], axes[:, ::-1]


def check(spark, rows, result, components=8):
    names, n, deviations, y, variances, axes = brute(rows)
    got = result.collect()
    k = min(components, y.shape[1])
    assert len(got) == len(names) * k
    table = {}
    for r in got:
        table.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r["whitened"])
    assert set(table) == set(zip(names, deviations))
    assert {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] <= 1e-9
    for c in range(1, k + 1):
        share = {r["explained"] for r in got if r["component"] == c}
        assert len(share) == 1 and share.pop() == pytest.approx(variances[c - 1] / variances.sum(), rel=1e-9, abs=1e-12)
        if variances[c - 1] > 1e-9 * variances[0]:
            want = y @ axes[:, c - 1] / math.sqrt(variances[c - 1])
            have = np.array([table[key][c][0] for key in zip(names, deviations)])
            assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-7


def test_query_equals_eigenvectors(spark, sf):
    from tabwright.llm.queries import op12_embedding_whitening

    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(spark, rows, op12_embedding_whitening(spark, sf))


def test_awkward_vectors(spark):
    rnd = np.random.default_rng(3)
    good = [(i, (rnd.normal(size=5) * [9, 4, 2, 1, 0.5]).tolist()) for i in range(200)]
    odd = [(900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0]), (903, [1.0, float("nan"), 0.0, 0.0, 0.0]), (904, [float("inf")] * 5), (905, [1.0, 2.0])]
    rows = good + good[:3] + odd + [(None, [1.0, 2.0, 3.0, 4.0, 5.0])]
    rows = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], VECTORS).withColumns({c: F.lit(0) for c in ("n", "x", "i", "j", "k", "deviation")})
    check(spark, rows, whitening.report(spark, table))


def test_badly_conditioned_vectors(spark):
    rnd = np.random.default_rng(4)
    mixed = rnd.normal(size=(10, 10))
    rows = [(i, (rnd.normal(size=10) * 10.0 ** -np.linspace(0, 3, 10) * 300 @ mixed).tolist()) for i in range(3000)]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in rows]
    check(spark, rows, whitening.report(spark, spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)))


def test_directions_without_variance(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0, float(i * i % 5)]) for i in range(40)]
    got = whitening.report(spark, spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)).collect()
    assert {r["component"] for r in got} == {1, 2, 3, 4} and got[0]["identity_error"] < 1e-9
    assert all(r["whitened"] == 0 and r["explained"] == 0 for r in got if r["component"] > 2)
    for same in ([(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5):
        got = whitening.report(spark, spark.createDataFrame([(i, v, 0) for i, v in same], VECTORS)).collect()
        assert len(got) == 2 * len(same) and all(r["whitened"] == 0 and r["deviation"] == 0 for r in got)


def test_huge_entries(spark):
    rows = [(i, [i * 1e12, float(i % 3)]) for i in range(30)] + [(99, [1e30, 0.0])]
    got = whitening.report(spark, spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")).collect()
    assert {r["vec_id"] for r in got} == set(range(30)) and got[0]["identity_error"] < 1e-6


def test_no_vectors(spark):
    assert whitening.report(spark, spark.createDataFrame([(1, None, 1)], VECTORS)).collect() == []


def test_large_deviations_are_exact():
    x = np.array([[1_100_000, 0], [0, 3]], np.int64)
    n, sums = 3_000_000, np.array([100_000 * 3_000_000, 5], np.int64)
    exact = [(n * 1_100_000 - int(sums[0])) ** 2 + 25, int(sums[0]) ** 2 + (3 * n - 5) ** 2]
    assert whitening._deviations(x, n, sums) == [v if v < 1 << 63 else None for v in exact]
    assert whitening._deviations(x, 2, np.array([5, 5])) == [(2_200_000 - 5) ** 2 + 25, 25 + 1]
