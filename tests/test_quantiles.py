import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.functions import quantiles
from tabwright.functions.quantiles import EVERY_ROW, exact_quantiles


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v), i) for i, v in enumerate(values)], "x double, i int").repartition(5)


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.8, 1.0])
def test_small_column_is_read_off_at_once(spark, q):
    values = [3, 1, 2, 10, 7, 7, 7]
    got = exact_quantiles(frame(spark, values), {"x": F.col("x")}, q)
    assert got[EVERY_ROW, "x"] == pytest.approx(np.quantile(values, q))


@pytest.mark.parametrize("kind", ["spread", "skewed", "two_heavy"])
@pytest.mark.parametrize("sketch_rows", [500, 1_000_000])
def test_narrowing_is_exact_for_any_sketch(spark, monkeypatch, kind, sketch_rows):
    monkeypatch.setattr(quantiles, "SKETCH_ROWS", sketch_rows)
    random = np.random.default_rng(3)
    n = 20_000
    values = {
        "spread": random.normal(size=n),
        "skewed": np.where(random.random(n) < 0.4, 5.0, np.exp(random.normal(size=n) * 8)),
        "two_heavy": np.concatenate([np.full(n // 2 - 5, 1.0), 1 + np.arange(10) / 10, np.full(n // 2 - 5, 2.0)]),
    }[kind]
    df = frame(spark, values)
    got = {q: exact_quantiles(df, {"x": F.col("x")}, q, distinct_limit=100)[EVERY_ROW, "x"] for q in (0.5, 0.03)}
    if kind == "two_heavy":
        # few values: force rounds anyway
        got = {q: exact_quantiles(df, {"x": F.col("x")}, q, distinct_limit=4)[EVERY_ROW, "x"] for q in got}
    for q, value in got.items():
        assert value == pytest.approx(np.quantile(values, q), rel=1e-12)


def test_masks_far_apart_are_searched_separately(spark):
    values = np.arange(5000, dtype=float)
    masks = {"low": F.col("i") < 500, "high": F.col("i") >= 4000, "none": F.lit(False), "all": None}
    got = exact_quantiles(frame(spark, values), {"x": F.col("x")}, 0.5, masks, distinct_limit=100)
    assert got["low", "x"] == 249.5
    assert got["high", "x"] == 4499.5
    assert got["none", "x"] is None
    assert got["all", "x"] == 2499.5


def test_missing_values_do_not_count(spark):
    df = frame(spark, [None, float("nan"), 4, 8, None])
    assert exact_quantiles(df, {"x": F.col("x")}, 0.5)[EVERY_ROW, "x"] == 6.0
    assert exact_quantiles(df.where("x > 100"), {"x": F.col("x")}, 0.5)[EVERY_ROW, "x"] is None


def test_known_counts_save_a_pass(spark):
    df = frame(spark, [3, 1, 2, 10])
    got = exact_quantiles(df, {"x": F.col("x")}, 0.5, known={"x": (4, {EVERY_ROW: 4})})
    assert got[EVERY_ROW, "x"] == 2.5


def test_values_are_read_off_without_a_lambda_a_row(spark, monkeypatch):
    """A lambda keeps the explode out of generated code: twenty times the time of the pass."""

    def refused(_):
        raise AssertionError("array_compact filters with a lambda")

    monkeypatch.setattr(F, "array_compact", refused)
    df = spark.createDataFrame([(1.0, None), (2.0, 7.0), (None, 9.0), (4.0, None)], "a double, b double")
    found = exact_quantiles(df, {"a": F.col("a"), "b": F.col("b")}, 0.5)
    assert found == {(None, "a"): 2.0, (None, "b"): 8.0}
