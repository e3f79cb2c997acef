"""Class probabilities and predictions as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.hashing import quoted
from tabwright.operators.estimators import class_value
from tabwright.operators.metrics import most_likely

# Names of the output columns.
PREDICTION, PROBABILITY_PREFIX = "PREDICTION", "PREDICT_PROBA_"


def probability_name(value: object) -> str:
    return f"{PROBABILITY_PREFIX}{value}"


def probability_columns(scores: Column, classes: Sequence) -> list[Column]:
    """One column per class, named after the class value."""
    return [F.get(scores, F.lit(i)).alias(probability_name(c)) for i, c in enumerate(classes)]


def threshold_prediction(score: Column, threshold: float, classes: Sequence, dtype: T.DataType) -> Column:
    """The last class where its score is strictly above the threshold, else the first; null without a score."""
    first, last = F.lit(classes[0]).cast(dtype), F.lit(classes[-1]).cast(dtype)
    return F.when(score > F.lit(float(threshold)), last).when(score.isNotNull(), first)


def with_class_predictions(
    df: DataFrame, scores: str, classes: Sequence, dtype: T.DataType, keep: Sequence[str], threshold: float | None
) -> DataFrame:
    """``keep`` columns, a probability per class and the prediction in the target's type.

    With a threshold (two classes) it decides; without, the most likely class is predicted.
    """
    column = F.col(scores)
    if threshold is None:
        prediction = class_value(most_likely(column), classes).cast(dtype)
    else:
        prediction = threshold_prediction(F.element_at(column, -1), threshold, classes, dtype)
    return df.select(
        *[F.col(quoted(c)) for c in keep], *probability_columns(column, classes), prediction.alias(PREDICTION)
    )
