"""Estimators behind one set of parameter names: histogram trees and boosting, linear models from sums, MLlib's boosting of classes.

Training frames hold ``features`` (vector), ``label`` (class number 0..K-1, or the target of a
regression) and, when weighted, ``weight``.
"""

from __future__ import annotations

import math
import threading
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators.blocks import Blocks, blocks_of, small_batches
from tabwright.operators.cells import CodedEnsemble, boosted_on_cells, with_margins
from tabwright.operators.linear import MOST_PARAMETERS, LinearModel, gram_matrices, lasso_path, logistic_models
from tabwright.operators.metrics import MULTI_CLASS, REGRESSION, TWO_CLASS
from tabwright.operators.prep import FEATURES, OWN_PREFIX
from tabwright.operators.trees import LOGISTIC, MEAN, RESIDUAL, SHARES, SOFTMAX, SQUARED, Growth, averaged, boosted, models_of
from tabwright.session import checkpoint_dir, ensure_checkpointing

LABEL, WEIGHT = "label", "weight"
ROW = f"{OWN_PREFIX}row"
MLLIB_MAX_DEPTH = 30

# Searched parameters of each algorithm with their default ranges.
# (parameter, kind of draw, smallest, largest)
FOREST = (("n_estimators", "integer", 80, 200), ("max_depth", "integer", 6, 20), ("min_samples_leaf", "integer", 1, 20))
BOOSTED = (
    ("n_estimators", "integer", 200, 400),
    ("max_depth", "integer", 3, 10),
    ("min_child_weight", "uniform", 1, 5),
    ("learning_rate", "log", 0.01, 0.2),
)
GRADIENT = (
    ("n_estimators", "integer", 200, 400),
    ("max_depth", "integer", 3, 10),
    ("min_samples_leaf", "integer", 1, 20),
    ("learning_rate", "log", 0.01, 0.2),
)
TREE = (("max_depth", "integer", 3, 10), ("min_samples_leaf", "integer", 1, 20))
CLASSIFIERS = {
    "logistic_regression": (("C", "log", 0.01, 100),),
    "random_forest": FOREST,
    "xgb": BOOSTED,
    "lgbm": BOOSTED,
    "gradient_boosting": GRADIENT,
    "decision_tree": TREE,
}
REGRESSORS = {
    "lasso": (("alpha", "log", 0.1, 10),),
    "random_forest": FOREST,
    "xgb": BOOSTED,
    "lgbm": BOOSTED,
    "gradient_boosting": GRADIENT,
    "decision_tree": TREE,
}
MAX_BINS = 256  # cut points of a continuous feature plus one, unless an AlgoSpec says otherwise
TREES = ("random_forest", "xgb", "lgbm", "gradient_boosting", "decision_tree")
AVERAGED = ("random_forest", "decision_tree")
LINEAR = ("lasso", "logistic_regression")
ROWS_PER_PIECE = 50_000
LEAST_PIECES = 8
HISTOGRAM_MB = 512  # per task; more nodes per pass over the rows than with the default of 256


def parameter_ranges(algorithm: str, task: str) -> tuple:
    known = REGRESSORS if task == REGRESSION else CLASSIFIERS
    if algorithm not in known:
        raise ValueError(f"{algorithm!r} does not fit {task}; choose one of {', '.join(known)}")
    return known[algorithm]


def class_label(position: Column, classes: Sequence) -> Column:
    """A label column that carries the number of classes, so fits need not look for it."""
    attribute = {"ml_attr": {"type": "nominal", "name": LABEL, "vals": [str(c) for c in classes]}}
    return position.cast("double").alias(LABEL, metadata=attribute)


def class_index(column: Column, classes: Sequence) -> Column:
    """Position of a target value among the sorted classes; null for other values."""
    if isinstance(classes[0], float):
        column = column.cast("double")
    found = F.array_position(F.array(*[F.lit(c) for c in classes]), column)
    return F.when(found > 0, (found - 1).cast("int"))


def class_value(position: Column, classes: Sequence) -> Column:
    return F.get(F.array(*[F.lit(c) for c in classes]), position)


@dataclass
class FittedEstimator:
    """A fitted learner: linear coefficients, or tree ensembles as MLlib models, one per margin."""

    algorithm: str
    task: str
    n_classes: int
    models: list

    def predict(self, df: DataFrame, output: str) -> DataFrame:
        """Add ``output``: a double for regression, else an array of K class probabilities."""
        if self.algorithm in LINEAR:
            return df.withColumn(output, self._from_margins(self.models[0].margins(FEATURES)))
        if self.algorithm == "gradient_boosting" and self.task != REGRESSION:
            return self._one_against_rest(df, output)
        if isinstance(self.models[0], RandomForestClassificationModel):
            vector = f"_{output}_0"
            model = self.models[0].setFeaturesCol(FEATURES).setProbabilityCol(vector).setRawPredictionCol("").setPredictionCol("")
            return model.transform(df).withColumn(output, vector_to_array(F.col(vector))).drop(vector)
        sums = [f"_{output}_{i}" for i in range(len(self.models))]
        for model, name in zip(self.models, sums):
            df = model.setFeaturesCol(FEATURES).setPredictionCol(name).transform(df)
        margins = [F.col(name) for name in sums]
        if self.task == TWO_CLASS and self.algorithm in AVERAGED:
            return df.withColumn(output, F.array(1 - margins[0], margins[0])).drop(*sums)
        return df.withColumn(output, self._from_margins(margins)).drop(*sums)

    def _from_margins(self, margins: list[Column]) -> Column:
        if self.task == REGRESSION:
            return margins[0]
        if len(margins) == 1:
            share = 1 / (1 + F.exp(-margins[0]))
            return F.array(1 - share, share)
        # the largest margin is taken off first: no exponential overflows
        top = F.array(*margins)
        raised = F.transform(top, lambda m: F.exp(m - F.array_max(top)))
        return F.transform(raised, lambda e: e / F.aggregate(raised, F.lit(0.0), lambda a, x: a + x))

    def _one_against_rest(self, df: DataFrame, output: str) -> DataFrame:
        vectors = [f"_{output}_{i}" for i in range(len(self.models))]
        for model, vector in zip(self.models, vectors):
            model = model.setFeaturesCol(FEATURES).setProbabilityCol(vector)
            df = model.setRawPredictionCol("").setPredictionCol("").transform(df)
        if len(vectors) == 1:
            return df.withColumn(output, vector_to_array(F.col(vectors[0]))).drop(*vectors)
        each = [F.get(vector_to_array(F.col(v)), F.lit(1)) for v in vectors]
        total = f"_{output}_total"
        df = df.withColumn(output, F.array(*each)).drop(*vectors)
        df = df.withColumn(total, F.aggregate(output, F.lit(0.0), lambda a, p: a + p))
        return df.withColumn(output, F.transform(output, lambda p: p / F.col(total))).drop(total)

    def save(self, spark: SparkSession, path: str) -> None:
        for i, model in enumerate(self.models):
            if isinstance(model, LinearModel):
                model.save(spark, f"{path}/{i}")
            else:
                model.write().overwrite().save(f"{path}/{i}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, algorithm: str, task: str, n_classes: int, n_models: int):
        reader = _model_class(algorithm, task)
        read = (lambda p: LinearModel.load(spark, p)) if reader is LinearModel else reader.load
        return cls(algorithm, task, n_classes, [read(f"{path}/{i}") for i in range(n_models)])


class CodedEstimator(FittedEstimator):
    """An ensemble fitted to cells. It scores by codes (``predict_all``); MLlib models of it are written when first asked for."""

    def __init__(self, algorithm: str, task: str, n_classes: int, ensemble: CodedEnsemble, spark: SparkSession) -> None:
        self.algorithm, self.task, self.n_classes, self.ensemble = algorithm, task, n_classes, ensemble
        self._spark, self._models, self._lock = spark, None, threading.Lock()

    @property
    def models(self) -> list:
        with self._lock:
            if self._models is None:
                path = f"{checkpoint_dir(self._spark).rstrip('/')}/trees-{uuid.uuid4().hex}"
                self._models = models_of(self._spark, self.ensemble.as_ensemble(), path)
            return self._models


def predict_all(df: DataFrame, fitted: dict[str, FittedEstimator]) -> DataFrame:
    """Add the output of each estimator under its name; those fitted to cells share one pass over the rows."""
    coded = {name: model for name, model in fitted.items() if isinstance(model, CodedEstimator)}
    if coded:
        margins = f"{OWN_PREFIX}margins"
        df = with_margins(df, FEATURES, [model.ensemble for model in coded.values()], margins)
        begin = 0
        for name, model in coded.items():
            own = [F.get(F.col(margins), F.lit(begin + i)) for i in range(model.ensemble.outputs)]
            df = df.withColumn(name, model._from_margins(own))
            begin += model.ensemble.outputs
        df = df.drop(margins)
    for name, model in fitted.items():
        if name not in coded:
            df = model.predict(df, name)
    return df


def _model_class(algorithm: str, task: str) -> type:
    if algorithm in LINEAR:
        return LinearModel
    if algorithm in AVERAGED and task == MULTI_CLASS:
        return RandomForestClassificationModel
    if algorithm == "gradient_boosting" and task != REGRESSION:
        return GBTClassificationModel
    return GBTRegressionModel


@dataclass
class FittingRows:
    """The prepared rows of one training set, in the forms that its learners read; each form is kept once made."""

    frame: DataFrame  # features, label, weight, row
    d: int
    groups: list[list[int]]
    weighted: bool
    _blocks: Blocks | None = None
    _rows: DataFrame | None = None
    _lock: threading.Lock = field(default_factory=threading.Lock)

    def blocks(self) -> Blocks:
        with self._lock:
            if self._blocks is None:
                self._blocks = blocks_of(self.frame, FEATURES, LABEL, WEIGHT if self.weighted else None, ROW, self.d, self.groups)
            return self._blocks

    def rows(self) -> DataFrame:
        with self._lock:
            if self._rows is None:
                self._rows = keep_for_fitting(self.frame)
            return self._rows

    def release(self) -> None:
        if self._blocks is not None:
            self._blocks.release()
        if self._rows is not None:
            self._rows.unpersist()
        self._blocks = self._rows = None


def growth_of(algorithm: str, params: dict, task: str, n_classes: int, d: int, seed: int) -> Growth:
    """The criterion and limits by which an algorithm grows its trees."""
    depth, multi = int(params["max_depth"]), task == MULTI_CLASS
    if algorithm in AVERAGED:
        forest = algorithm == "random_forest"
        return Growth(
            SHARES if multi else MEAN, n_classes if multi else 1, depth, least_rows=int(params["min_samples_leaf"]), bootstrap=forest,
            features_per_node=max(1, math.isqrt(d)) if forest and task != REGRESSION else None, seed=seed,
        )
    if algorithm == "gradient_boosting":
        return Growth(RESIDUAL, max_depth=depth, least_rows=int(params["min_samples_leaf"]), seed=seed)
    objective = SQUARED if task == REGRESSION else SOFTMAX if multi else LOGISTIC
    common = {"classes": n_classes if multi else 1, "max_depth": depth, "least_hessian": float(params["min_child_weight"]), "seed": seed}
    if algorithm == "xgb":
        return Growth(objective, l2=float(params.get("reg_lambda", 1.0)), least_gain=float(params.get("gamma", 0.0)), **common)
    return Growth(
        objective, leaves=int(params.get("num_leaves", 31)), least_rows=int(params.get("min_child_samples", 20)),
        l2=float(params.get("reg_lambda", 0.0)), **common,
    )


def build_learner(params: dict, task: str, weighted: bool, seed: int):
    """The MLlib learner behind ``gradient_boosting`` for one parameter draw; of classes, ``growth_of`` has the regression's."""
    common = {"featuresCol": FEATURES, "labelCol": LABEL}
    if weighted:
        common["weightCol"] = WEIGHT
    tree = {
        "maxDepth": int(params["max_depth"]), "seed": seed, "maxBins": int(params.get("max_bins", MAX_BINS)), "maxMemoryInMB": HISTOGRAM_MB,
        "minInstancesPerNode": int(params["min_samples_leaf"]), "maxIter": int(params["n_estimators"]), "stepSize": float(params["learning_rate"]),
    }
    return (GBTRegressor if task == REGRESSION else GBTClassifier)(**tree, **common)


def fit_estimator(
    train: FittingRows,
    algorithm: str,
    params: dict,
    task: str,
    n_classes: int,
    seed: int,
    parallelism: int = 4,
) -> FittedEstimator:
    """Fit one estimator."""
    with small_batches(train.frame.sparkSession):
        return _fit(train, algorithm, params, task, n_classes, seed, parallelism)


def _fit(train: FittingRows, algorithm: str, params: dict, task: str, n_classes: int, seed: int, parallelism: int) -> FittedEstimator:
    spark = train.frame.sparkSession
    if algorithm == "lasso":
        gram = gram_matrices(_gram_frame([train]), [train.d])[0][0]
        return FittedEstimator(algorithm, task, n_classes, list(lasso_path(gram, [params["alpha"]]).values()))
    if algorithm == "logistic_regression":
        return fit_logistic(train, [params["C"]], task, n_classes)[0]
    if algorithm == "gradient_boosting" and task != REGRESSION:
        return _fit_mllib_boosting(train, params, task, n_classes, seed, parallelism)
    growth = growth_of(algorithm, params, task, n_classes, train.d, seed)
    bins = int(params.get("max_bins", MAX_BINS))
    path = f"{checkpoint_dir(spark).rstrip('/')}/trees-{uuid.uuid4().hex}"
    if algorithm in AVERAGED:
        ensemble = averaged(train.blocks(), growth, int(params["n_estimators"]) if algorithm == "random_forest" else 1, bins)
        return FittedEstimator(algorithm, task, n_classes, models_of(spark, ensemble, path, n_classes if task == MULTI_CLASS else 0))
    rounds, rate = int(params["n_estimators"]), float(params["learning_rate"])
    on_cells = boosted_on_cells(train.blocks(), growth, rounds, rate, bins)
    if on_cells is not None:
        return CodedEstimator(algorithm, task, n_classes, on_cells, spark)
    ensemble = boosted(train.blocks(), growth, rounds, rate, bins)
    return FittedEstimator(algorithm, task, n_classes, models_of(spark, ensemble, path))


def fit_logistic(train: FittingRows, strengths: Sequence[float], task: str, n_classes: int) -> list[FittedEstimator]:
    """One model per strength C: Newton steps of all of them together, or MLlib's fits where a model has too many parameters."""
    size = (train.d + 1) * (1 if n_classes == 2 else n_classes)
    with small_batches(train.frame.sparkSession):
        if size <= MOST_PARAMETERS:
            models = logistic_models(train.blocks(), n_classes, strengths)
        else:
            models = [_fit_mllib_logistic(train, c) for c in strengths]
    return [FittedEstimator("logistic_regression", task, n_classes, [model]) for model in models]


def _fit_mllib_logistic(train: FittingRows, strength: float) -> LinearModel:
    # C multiplies the summed loss; MLlib's penalty is relative to the mean loss
    regularisation = 1.0 / (strength * train.blocks().weight)
    weight = {"weightCol": WEIGHT} if train.weighted else {}
    fitted = LogisticRegression(
        featuresCol=FEATURES, labelCol=LABEL, regParam=regularisation, elasticNetParam=0.0, standardization=False, maxIter=200, **weight
    ).fit(train.rows())
    return LinearModel(fitted.coefficientMatrix.toArray().tolist(), fitted.interceptVector.toArray().tolist())


def _fit_mllib_boosting(train: FittingRows, params: dict, task: str, n_classes: int, seed: int, parallelism: int) -> FittedEstimator:
    ensure_checkpointing(train.frame.sparkSession)
    learner, rows = build_learner(params, task, train.weighted, seed), train.rows()
    if task != MULTI_CLASS:
        return FittedEstimator("gradient_boosting", task, n_classes, [learner.fit(rows)])

    def against_rest(k: int):
        one = F.when(F.col(LABEL) == float(k), 1).otherwise(0)
        columns = [c for c in rows.columns if c != LABEL]
        return learner.fit(rows.select(*columns, class_label(one, [0, 1])))

    models = run_parallel(rows.sparkSession, against_rest, range(n_classes), parallelism)
    return FittedEstimator("gradient_boosting", task, n_classes, models)


def _gram_frame(sets: Sequence[FittingRows]) -> DataFrame:
    """(no fold, target, weight, features) of one training set."""
    (rows,) = sets
    weight = F.col(WEIGHT).cast("double") if rows.weighted else F.lit(1.0)
    return rows.frame.select(
        F.lit(-1).alias("fold"), F.col(LABEL).cast("double").alias("y"), weight.alias("w"), vector_to_array(F.col(FEATURES)).alias("x")
    )


def keep_for_fitting(df: DataFrame) -> DataFrame:
    """Keep prepared rows for the passes of an MLlib fit.

    MLlib draws samples and adds up per piece and in row order. So that a fit depends on the rows
    alone, they are dealt out by ``ROW``, a hash of the key, into a number of pieces that follows
    from the row count, and sorted within each; how the input was cut and how many cores there are
    changes nothing, and no value of a feature gathers rows in one piece.
    """
    pieces = max(LEAST_PIECES, -(-df.count() // ROWS_PER_PIECE))
    kept = df.repartition(pieces, ROW).sortWithinPartitions(ROW, LABEL).drop(ROW).persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    return kept


def run_parallel(spark: SparkSession, work: Callable, items: Sequence, parallelism: int) -> list:
    """Run driver-side submissions of Spark jobs from a bounded pool, keeping order."""
    items = list(items)
    if parallelism <= 1 or len(items) <= 1:
        return [work(item) for item in items]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(work), item) for item in items]
        return [future.result() for future in futures]
