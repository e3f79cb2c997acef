"""A trained model: preparation, estimator and what is needed to turn scores into predictions."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.hashing import quoted
from tabwright.operators.estimators import FittedEstimator
from tabwright.operators.metrics import REGRESSION, TWO_CLASS
from tabwright.operators.prep import PrepModel
from tabwright.operators.scoring import PREDICTION, probability_name, with_class_predictions

SCORES = "_scores"


@dataclass
class TrainedModel:
    """``classes`` are the target values in score order; the positive class is the last."""

    task: str
    target: str
    target_type: str
    classes: list
    features: list[str]
    prep: PrepModel
    estimator: FittedEstimator

    def scores(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` columns and the raw output: probabilities per class, or the predicted number."""
        return self.estimator.predict(self.prep.transform(df, keep), SCORES).select(
            *[F.col(quoted(c)) for c in keep], SCORES
        )

    def score(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        """All input columns, then probabilities and ``PREDICTION``. Map-only: no shuffle."""
        outputs = set(self.output_columns())
        keep = [c for c in df.columns if c not in outputs]
        scored = self.scores(df, keep)
        if self.task == REGRESSION:
            return scored.withColumnRenamed(SCORES, PREDICTION)
        cut = threshold if self.task == TWO_CLASS else None
        return with_class_predictions(scored, SCORES, self.classes, _type(self.target_type), keep, cut)

    def output_columns(self) -> list[str]:
        return [*[probability_name(c) for c in self.classes], PREDICTION]

    def signature(self, df: DataFrame) -> str:
        """Input and output fields as JSON, from the schema alone."""
        inputs = [f for f in df.schema.fields if f.name in self.features]
        kind = T.DoubleType() if self.task == REGRESSION else _type(self.target_type)
        outputs = [T.StructField(probability_name(c), T.DoubleType()) for c in self.classes]
        outputs.append(T.StructField(PREDICTION, kind))
        return json.dumps({"inputs": T.StructType(inputs).jsonValue(), "outputs": T.StructType(outputs).jsonValue()})

    def save(self, spark: SparkSession, path: str) -> None:
        self.prep.save(spark, f"{path}/prep")
        self.estimator.save(spark, f"{path}/estimator")
        about = {
            "task": self.task,
            "target": self.target,
            "target_type": self.target_type,
            "classes": self.classes,
            "features": self.features,
            "algorithm": self.estimator.algorithm,
            "n_models": len(self.estimator.models),
        }
        frame = spark.createDataFrame([(json.dumps(about),)], "about string")
        frame.coalesce(1).write.mode("overwrite").json(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TrainedModel:
        about = json.loads(spark.read.schema("about string").json(f"{path}/about").first()["about"])
        estimator = FittedEstimator.load(
            spark, f"{path}/estimator", about["algorithm"], about["task"], len(about["classes"]), about["n_models"]
        )
        prep = PrepModel.load(spark, f"{path}/prep")
        names = ("task", "target", "target_type", "classes", "features")
        return cls(*[about[n] for n in names], prep, estimator)


def _type(name: str) -> T.DataType:
    return T.StructType.fromDDL(f"t {name}")["t"].dataType
