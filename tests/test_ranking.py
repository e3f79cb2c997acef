import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.functions import ranking
from tabwright.functions.ranking import dense_codes
from tabwright.operators.metrics import binary_auc, one_vs_one_auc


def brute_auc(y, p):
    wins = [(a > b) + (a == b) / 2 for a, b in itertools.product(p[y == 1], p[y == 0])]
    return np.mean(wins) if wins else None


def brute_ovo(y, scores):
    found = []
    for i, j in itertools.permutations(sorted(set(y)), 2):
        rows = (y == i) | (y == j)
        found.append(brute_auc((y[rows] == i).astype(int), scores[rows, i]))
    return np.mean(found)


def binary(spark, y, p):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double").repartition(3)


def auc(spark, y, p):
    return binary_auc(binary(spark, y, p), "y", F.col("p")).first()["roc_auc"]


@pytest.mark.parametrize("rows_per_bucket", [10_000, 40])
def test_auc_equals_all_pairs(spark, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", rows_per_bucket)
    random = np.random.default_rng(1)
    y = (random.random(300) < 0.3).astype(int)
    p = np.where(random.random(300) < 0.35, 0.4, np.round(random.random(300) * 0.6 + y * 0.2, 2))  # a third share one score
    assert auc(spark, y, p) == pytest.approx(brute_auc(y, p), abs=1e-12)
    assert auc(spark, y, -p) == pytest.approx(1 - brute_auc(y, p), abs=1e-12)


def test_auc_edges(spark):
    assert auc(spark, [0, 1, 0, 1], [0.5] * 4) == 0.5
    assert auc(spark, [0, 0, 1, 1], [0.1, 0.2, 0.3, 0.4]) == 1.0
    assert auc(spark, [1, 1, 0, 0], [0.1, 0.2, 0.3, 0.4]) == 0.0
    assert auc(spark, [1, 1], [0.1, 0.2]) is None


@pytest.mark.parametrize("rows_per_bucket", [10_000, 60])
def test_one_vs_one_equals_all_pairs(spark, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", rows_per_bucket)
    random = np.random.default_rng(2)
    y = random.integers(0, 3, 200)
    scores = np.round(random.dirichlet([1, 1, 1], 200), 2)
    rows = [(int(a), [float(v) for v in s], "ab"[n % 2]) for n, (a, s) in enumerate(zip(y, scores))]
    df = spark.createDataFrame(rows, "y int, s array<double>, k string")
    whole = one_vs_one_auc(df, "y", F.col("s"), 3).first()["roc_auc"]
    assert whole == pytest.approx(brute_ovo(y, scores), abs=1e-12)
    for row in one_vs_one_auc(df, "y", F.col("s"), 3, ["k"]).collect():
        part = np.arange(200) % 2 == "ab".index(row["k"])
        assert row["roc_auc"] == pytest.approx(brute_ovo(y[part], scores[part]), abs=1e-12)


def test_class_that_does_not_occur_is_left_out(spark):
    df = spark.createDataFrame([(0, [0.7, 0.2, 0.1]), (1, [0.3, 0.6, 0.1]), (1, [0.8, 0.1, 0.1])], "y int, s array<double>")
    y, s = np.array([0, 1, 1]), np.array([[0.7, 0.2, 0.1], [0.3, 0.6, 0.1], [0.8, 0.1, 0.1]])
    assert one_vs_one_auc(df, "y", F.col("s"), 3).first()["roc_auc"] == pytest.approx(brute_ovo(y, s))


@pytest.mark.parametrize("rows_per_bucket", [10_000, 10])
def test_dense_codes_number_values_in_order(spark, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", rows_per_bucket)
    rows = [(k, f"v{n:03d}") for k in ("a", "b") for n in range(137 if k == "a" else 3)]
    df = spark.createDataFrame(rows, "k string, v string").repartition(7)
    got = {(r["k"], r["v"]): r["code"] for r in dense_codes(df, ["k"], "v", 137).collect()}
    assert got == {(k, v): int(v[1:]) for k, v in rows}


def test_buckets_are_of_distinct_scores_not_of_rows(spark, monkeypatch):
    sizes = []

    def recorded(counted, rows):
        sizes.append(rows)
        return counted, []

    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 50)
    monkeypatch.setattr(ranking, "_with_bucket", recorded)
    df = spark.range(900).select((F.col("id") % 3).cast("int").alias("y"), F.array(*[(F.col("id") * k % 5).cast("double") for k in (1, 2, 3)]).alias("s"))
    found = ranking.pair_wins(df, "y", F.col("s"), range(3))
    assert {(r["n_own"], r["n_other"]) for r in found.collect()} == {(300, 300)}
    assert sizes == [45]


def test_scores_are_worked_out_once_a_row(spark):
    df = spark.range(10).select((F.col("id") % 2).cast("int").alias("y"), F.col("id").cast("double").alias("p"))
    scores = F.transform(F.array("p", "p"), lambda v: v * 7)
    plan = ranking.pair_wins(df, "y", scores, [0, 1])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("transform(") == 1


def test_rows_without_a_score_do_not_count_in_large_tables(spark, monkeypatch):
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 5)
    df = spark.createDataFrame([(1, 3.0), (1, 2.0), (1, None), (0, 2.0), (0, 1.0), (0, None)], "y int, p double")
    (row,) = ranking.pair_wins(df, "y", F.array("p"), [1]).where("j = 0").collect()
    assert (row["n_own"], row["n_other"], row["wins"]) == (2, 2, 3.5)
