"""Test metrics as grouped aggregates. Every function can evaluate many candidates at once (``keys``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.hashing import quoted
from tabwright.functions.ranking import pair_wins

TWO_CLASS, MULTI_CLASS, REGRESSION = "two-class classification", "multi-class classification", "regression"

# The metrics a search can optimise, by the name the user picks.
CLASS_METRICS = {"ROC AUC": "roc_auc", "Accuracy": "accuracy", "F1 Score": "f1", "Precision": "precision", "Recall": "recall"}
REGRESSION_METRICS = {"R2": "r2", "MAE": "mae", "MSE": "mse"}
LOWER_IS_BETTER = {"mae", "mse", "rmse"}


def metric_key(name: str, task: str) -> str:
    known = REGRESSION_METRICS if task == REGRESSION else CLASS_METRICS
    if name not in known:
        raise ValueError(f"metric {name!r} does not fit {task}; choose one of {', '.join(known)}")
    return known[name]


def signed(metric: str, value: float | None) -> float | None:
    """The score to maximise: errors are negated."""
    return -value if value is not None and metric in LOWER_IS_BETTER else value


def _share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where there is nothing to divide by."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def confusion(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per (label, prediction)."""
    return df.groupBy(*keys, F.col(quoted(label)).alias("label"), F.col(quoted(prediction)).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def binary_metrics(df: DataFrame, label: str, prediction: str, positive: object, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy, F1, precision and recall of the positive class, in one aggregate."""
    actual, predicted = F.col(quoted(label)) == F.lit(positive), F.col(quoted(prediction)) == F.lit(positive)
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(actual & predicted, 1)).alias("_tp"),
        F.count(F.when(actual, 1)).alias("_actual"),
        F.count(F.when(predicted, 1)).alias("_predicted"),
        F.count(F.when(F.col(quoted(label)) == F.col(quoted(prediction)), 1)).alias("_right"),
    )
    tp = F.col("_tp").cast("double")
    return counts.select(
        *keys,
        "n_rows",
        _share(F.col("_right").cast("double"), F.col("n_rows")).alias("accuracy"),
        _share(2 * tp, F.col("_actual") + F.col("_predicted")).alias("f1"),
        _share(tp, F.col("_predicted")).alias("precision"),
        _share(tp, F.col("_actual")).alias("recall"),
    )


def macro_metrics(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy, and F1, precision and recall averaged over the classes that occur on either side.

    Works on the confusion table, so the table itself is aggregated once.
    """
    table = confusion(df, label, prediction, keys)
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.col("n_rows").alias("actual"),
            F.lit(0).cast("long").alias("predicted"),
            F.when(F.col("label") == F.col("prediction"), F.col("n_rows")).otherwise(0).alias("tp"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            F.lit(0).cast("long").alias("actual"),
            F.col("n_rows").alias("predicted"),
            F.lit(0).cast("long").alias("tp"),
        ),
    )
    per_class = (
        table.select(*keys, F.explode(sides).alias("s"))
        .groupBy(*keys, "s.class")
        .agg(F.sum("s.actual").alias("actual"), F.sum("s.predicted").alias("predicted"), F.sum("s.tp").alias("tp"))
    )
    tp = F.col("tp").cast("double")
    return per_class.groupBy(*keys).agg(
        F.sum("actual").alias("n_rows"),
        (F.sum(tp) / F.sum("actual")).alias("accuracy"),
        F.avg(_share(2 * tp, F.col("actual") + F.col("predicted"))).alias("f1"),
        F.avg(_share(tp, F.col("predicted"))).alias("precision"),
        F.avg(_share(tp, F.col("actual"))).alias("recall"),
    )


def regression_metrics(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """R2, MAE, MSE and RMSE, in one aggregate."""
    y = F.col(quoted(label)).cast("double")
    error = y - F.col(quoted(prediction)).cast("double")
    sums = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(y).alias("_variance"),
    )
    return sums.select(
        *keys,
        "n_rows",
        F.when(F.col("_variance") > 0, 1 - F.col("mse") / F.col("_variance"))
        .otherwise(F.when(F.col("mse") == 0, 1.0).otherwise(0.0))
        .alias("r2"),
        "mae",
        "mse",
        F.sqrt("mse").alias("rmse"),
    )


def binary_auc(df: DataFrame, label: str, score: Column, keys: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """Area under the ROC curve; ``label`` is 0/1. Null where only one class occurs."""
    wins = pair_wins(df, label, F.array(score), [1], keys, rows)
    # a row per class that occurs: the pairs are those with class 0
    auc = F.max(F.when((F.col("j") == 0) & (F.col("n_own") > 0), F.col("wins") / (F.col("n_own") * F.col("n_other"))))
    return wins.groupBy(*keys).agg(auc.alias("roc_auc"))


def one_vs_one_auc(
    df: DataFrame, label: str, scores: Column, n_classes: int, keys: Sequence[str] = (), rows: int | None = None
) -> DataFrame:
    """Mean over class pairs of the two-sided pairwise AUC (Hand and Till 2001); ``label`` is 0..K-1.

    Pairs with a class that does not occur are left out.
    """
    wins = pair_wins(df, label, scores, range(n_classes), keys, rows)
    # both orders of a pair weigh the same, so the mean of all of them is the mean over pairs
    auc = F.when((F.col("i") != F.col("j")) & (F.col("n_own") > 0), F.col("wins") / (F.col("n_own") * F.col("n_other")))
    return wins.groupBy(*keys).agg(F.avg(auc).alias("roc_auc"))


def search_score(
    df: DataFrame, metric: str, task: str, n_classes: int, keys: Sequence[str], rows: int | None = None
) -> DataFrame:
    """(keys, score): one metric for each candidate. Expects ``label`` and ``scores`` or ``prediction``."""
    if task == REGRESSION:
        return regression_metrics(df, "label", "prediction", keys).select(*keys, F.col(metric).alias("score"))
    if metric == "roc_auc":
        if task == TWO_CLASS:
            found = binary_auc(df, "label", F.element_at("scores", -1), keys, rows)
        else:
            found = one_vs_one_auc(df, "label", F.col("scores"), n_classes, keys, rows)
    else:
        predicted = df.withColumn("prediction", most_likely(F.col("scores")))
        if task == TWO_CLASS:
            found = binary_metrics(predicted, "label", "prediction", 1, keys)
        else:
            found = macro_metrics(predicted, "label", "prediction", keys)
    return found.select(*keys, F.col(metric).alias("score"))


def all_metrics(df: DataFrame, task: str, n_classes: int, keys: Sequence[str], rows: int | None = None) -> DataFrame:
    """Every metric of the task for each candidate. Expects ``label`` and ``scores`` or ``prediction``.

    For classes ``df`` is read twice, for the rates and for the ranking.
    """
    if task == REGRESSION:
        return regression_metrics(df, "label", "prediction", keys)
    predicted = df.withColumn("prediction", most_likely(F.col("scores")))
    if task == TWO_CLASS:
        rates = binary_metrics(predicted, "label", "prediction", 1, keys)
        ranking = binary_auc(df, "label", F.element_at("scores", -1), keys, rows)
    else:
        rates = macro_metrics(predicted, "label", "prediction", keys)
        ranking = one_vs_one_auc(df, "label", F.col("scores"), n_classes, keys, rows)
    return rates.join(ranking, list(keys), "left")


def most_likely(scores: Column) -> Column:
    """The class number with the largest score; the first of equals. Null scores give null."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")
