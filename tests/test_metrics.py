import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators.metrics import (
    MULTI_CLASS,
    REGRESSION,
    TWO_CLASS,
    binary_metrics,
    macro_metrics,
    metric_key,
    most_likely,
    regression_metrics,
    signed,
)


def pairs(spark, rows):
    return spark.createDataFrame(rows, "y int, f int")


def test_nothing_predicted_gives_zero(spark):
    row = binary_metrics(pairs(spark, [(1, 0), (0, 0), (1, 0)]), "y", "f", 1).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0) and row["accuracy"] == pytest.approx(1 / 3)


def test_positive_class_can_be_either(spark):
    df = pairs(spark, [(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)])
    one, zero = binary_metrics(df, "y", "f", 1).first(), binary_metrics(df, "y", "f", 0).first()
    assert (one["precision"], one["recall"]) == (0.5, 0.5)
    assert (zero["precision"], zero["recall"]) == (pytest.approx(2 / 3), pytest.approx(2 / 3))


def test_macro_counts_classes_of_both_sides(spark):
    # class 2 is only predicted, class 3 only true
    row = macro_metrics(pairs(spark, [(0, 0), (0, 2), (1, 1), (3, 1)]), "y", "f").first()
    assert row["recall"] == pytest.approx((0.5 + 1 + 0 + 0) / 4)
    assert row["precision"] == pytest.approx((1 + 0.5 + 0 + 0) / 4)
    assert row["accuracy"] == 0.5


def test_regression(spark):
    y, f = np.array([1.0, 2.0, 4.0]), np.array([1.5, 2.0, 3.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, f)], "y double, f double")
    row = regression_metrics(df, "y", "f").first()
    assert row["r2"] == pytest.approx(1 - ((y - f) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert row["mae"] == pytest.approx(abs(y - f).mean()) and row["rmse"] == pytest.approx(np.sqrt(row["mse"]))
    constant = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "y double, f double")
    assert regression_metrics(constant, "y", "f").first()["r2"] == 1.0


def test_most_likely_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],), (None,)], "s array<double>")
    assert [r[0] for r in df.select(most_likely(F.col("s"))).collect()] == [1, None]


def test_metric_names():
    assert metric_key("ROC AUC", TWO_CLASS) == "roc_auc" and metric_key("MAE", REGRESSION) == "mae"
    for name, task in (("R2", TWO_CLASS), ("ROC AUC", REGRESSION), ("nonsense", MULTI_CLASS)):
        with pytest.raises(ValueError):
            metric_key(name, task)
    assert signed("mae", 2.0) == -2.0 and signed("r2", 2.0) == 2.0
