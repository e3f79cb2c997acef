"""Random search with cross-validation."""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwright.functions.hashing import quoted
from tabwright.operators.estimators import LABEL, ROW, WEIGHT, FittedEstimator, FittingRows, fit_estimator, fit_logistic, predict_all, run_parallel
from tabwright.operators.linear import gram_matrices, lasso_path, squared_error
from tabwright.operators.metrics import REGRESSION, search_score, signed
from tabwright.operators.prep import OWN_PREFIX, PrepModel
from tabwright.sources.tables import DUMMY
from tabwright.operators.split import FOLD_COLUMN


_FOLD, _TARGET, _WEIGHT = (f"{OWN_PREFIX}{name}" for name in ("fold", "target", "weight"))


@dataclass(frozen=True)
class Candidate:
    algorithm: str
    number: int
    params: dict


def draw_candidates(algorithms: Sequence, task: str, n_iter: int, seed: int) -> list[Candidate]:
    """``n_iter`` draws per algorithm: whole numbers and uniform draws include both ends."""
    candidates = []
    for position, algorithm in enumerate(algorithms):
        random = np.random.default_rng([abs(seed), position])
        for number in range(1, n_iter + 1):
            params = {}
            for parameter, kind, low, high in algorithm.draws(task):
                if kind == "integer":
                    params[parameter] = int(random.integers(low, high, endpoint=True))
                elif kind == "log":
                    params[parameter] = float(math.exp(random.uniform(math.log(low), math.log(high))))
                else:
                    params[parameter] = float(random.uniform(low, high))
            candidates.append(Candidate(algorithm.name, number, {**params, **algorithm.settings}))
    return candidates


def candidate_table(spark: SparkSession, candidates: Sequence[Candidate]) -> DataFrame:
    rows = [(c.algorithm, c.number, {k: str(v) for k, v in c.params.items()}) for c in candidates]
    return spark.createDataFrame(rows, "algorithm string, candidate int, params map<string,string>")


FOLD_SCORES = "algorithm string, candidate int, fold int, score double, fit_seconds double"


def cross_validate(
    train: DataFrame,
    preps: dict[int, PrepModel],
    candidates: Sequence[Candidate],
    label: Column,
    metric: str,
    task: str,
    n_classes: int,
    weight_column: str | None,
    seed: int,
    parallelism: int = 4,
    keys: Sequence[str] | None = None,
) -> list[tuple]:
    """Fit every candidate on every set that leaves out one fold and score it on that fold.

    ``train`` holds the raw rows and the fold column; ``preps`` the preparation of each
    left-out fold. Lasso candidates are fitted, and scored by squared errors, from sums that one scan
    takes for all folds. Of the others the prepared rows of one fold at a time are kept; logistic
    candidates are fitted together, trees a few at a time, and one job scores each lot before the next
    is fitted. Returns rows of the ``FOLD_SCORES`` schema, with the score signed so that larger is better.
    """
    folds = sorted(f for f in preps if f >= 0)
    found: dict[tuple, tuple] = {}
    ready = _lasso_folds(train, preps, folds, candidates, label, metric, weight_column, found)
    rest = [c for c in candidates if c.algorithm != "lasso"]
    for fold in folds:
        rows = prepared_for_fitting(train.where(F.col(FOLD_COLUMN) != fold), preps[fold], label, weight_column, keys)
        held_out = prepared(train.where(F.col(FOLD_COLUMN) == fold), preps[fold], label, None)
        waiting = [entry for (_, at), entry in ready.items() if at == fold]
        logistic = [c for c in rest if c.algorithm == "logistic_regression"]
        if logistic:
            started = time.monotonic()
            fits = fit_logistic(rows, [c.params["C"] for c in logistic], task, n_classes)
            waiting += [(c, fit, (time.monotonic() - started) / len(logistic)) for c, fit in zip(logistic, fits)]

        def fit(candidate: Candidate) -> tuple[Candidate, FittedEstimator, float]:
            started = time.monotonic()
            fitted = fit_estimator(rows, candidate.algorithm, candidate.params, task, n_classes, seed, parallelism)
            return candidate, fitted, time.monotonic() - started

        trees = [c for c in rest if c.algorithm != "logistic_regression"]
        lots = [trees[i : i + max(1, parallelism)] for i in range(0, len(trees), max(1, parallelism))]
        for lot in lots or [[]]:
            waiting += run_parallel(train.sparkSession, fit, lot, parallelism)
            if waiting:
                scores = score_candidates(held_out, [fitted for _, fitted, _ in waiting], metric, task, n_classes)
                for position, (candidate, _, seconds) in enumerate(waiting):
                    found[candidate.algorithm, candidate.number, fold] = (signed(metric, scores.get(position)), seconds)
            waiting = []
        rows.release()
    return [(c.algorithm, c.number, fold, *found[c.algorithm, c.number, fold]) for fold in folds for c in candidates]


def _lasso_folds(
    train: DataFrame, preps: dict[int, PrepModel], folds: list[int], candidates: Sequence[Candidate], label: Column, metric: str,
    weight_column: str | None, found: dict,
) -> dict:
    """Fit all lasso candidates on all folds from one scan. Scores that follow from the sums go to ``found``;
    the fits that must be scored on rows come back, by candidate number and fold."""
    lasso = [c for c in candidates if c.algorithm == "lasso"]
    if not lasso:
        return {}
    started = time.monotonic()
    weight = F.col(quoted(weight_column)).cast("double") if weight_column else F.lit(1.0)
    frame = train.select("*", F.col(FOLD_COLUMN).alias(_FOLD), label.cast("double").alias(_TARGET), weight.alias(_WEIGHT))
    sizes, arrays = [], []
    others = [F.col(c) for c in (_FOLD, _TARGET, _WEIGHT)]
    for fold in folds:
        name = f"{_FOLD}_{fold}"
        frame = preps[fold].arrays(frame, name)
        arrays.append(F.col(name))
        sizes.append(len(preps[fold].outputs))
    grams = gram_matrices(frame.select(*others, *arrays), sizes)
    ready = {}
    for fold, (inside, outside) in zip(folds, grams):
        models = lasso_path(inside, [c.params["alpha"] for c in lasso])
        for candidate in lasso:
            model = models[candidate.params["alpha"]]
            seconds = (time.monotonic() - started) / (len(lasso) * len(folds))
            n, squares, spread = squared_error(outside, model)
            if metric in ("r2", "mse", "rmse") and n and (metric != "r2" or spread > 0):
                score = {"r2": lambda: 1 - squares / spread, "mse": lambda: squares / n, "rmse": lambda: math.sqrt(max(squares, 0.0) / n)}[metric]()
                found["lasso", candidate.number, fold] = (signed(metric, float(score)), seconds)
            else:
                ready[candidate.number, fold] = (candidate, FittedEstimator("lasso", REGRESSION, 0, [model]), seconds)
    return ready


def prepared(df: DataFrame, prep: PrepModel, label: Column, weight_column: str | None) -> DataFrame:
    """features, label and weight: all that the estimators read."""
    weight = [F.col(quoted(weight_column)).alias(WEIGHT)] if weight_column else []
    return prep.beside(df, [label, *weight])


def prepared_for_fitting(
    df: DataFrame, prep: PrepModel, label: Column, weight_column: str | None, keys: Sequence[str] | None = None
) -> FittingRows:
    """The prepared rows, each with a hash of its key (of all columns if there is none)."""
    names = [c for c in keys or df.columns if c not in (FOLD_COLUMN, weight_column)]
    row = F.xxhash64(*[F.col(quoted(c)) for c in names]).alias(ROW)
    weight = [F.col(quoted(weight_column)).alias(WEIGHT)] if weight_column else []
    outputs, groups = 0, []
    for plan in prep.plans:
        size = len(plan.outputs)
        if plan.encoding == DUMMY and size:
            groups.append(list(range(outputs, outputs + size)))
        outputs += size
    return FittingRows(prep.beside(df, [label, *weight, row]), outputs, groups, weight_column is not None)


def model_outputs(rows: DataFrame, fitted: dict[str, FittedEstimator], task: str) -> DataFrame:
    """(model, label, scores or prediction): many fitted models applied in one pass over prepared rows."""
    outputs = {name: f"_out_{i}" for i, name in enumerate(fitted)}
    rows = predict_all(rows, {outputs[name]: model for name, model in fitted.items()})
    value = "prediction" if task == REGRESSION else "scores"
    each = F.array(*[F.struct(F.lit(n).alias("model"), F.col(o).alias(value)) for n, o in outputs.items()])
    label = F.col(LABEL) if task == REGRESSION else F.col(LABEL).cast("int").alias(LABEL)
    return rows.select(label, F.explode(each).alias("m")).select(LABEL, "m.*")


def score_candidates(
    held_out: DataFrame, fitted: Sequence[FittedEstimator], metric: str, task: str, n_classes: int
) -> dict[int, float]:
    """One metric of each fitted model on the held-out rows."""
    outputs = model_outputs(held_out, {str(i): model for i, model in enumerate(fitted)}, task)
    rows = None
    if metric == "roc_auc":
        # the ranking reads the scores more than once
        outputs = outputs.persist(StorageLevel.MEMORY_AND_DISK)
        rows = outputs.count()
    found = search_score(outputs, metric, task, n_classes, ["model"], rows).collect()
    outputs.unpersist()
    return {int(row["model"]): row["score"] for row in found}


def cv_results(fold_scores: DataFrame) -> DataFrame:
    """One row per candidate: mean score, mean fit time, and its rank within the algorithm."""
    by_score = Window.partitionBy("algorithm").orderBy(F.desc("mean_test_score"))
    return (
        fold_scores.groupBy("algorithm", "candidate")
        .agg(F.avg("score").alias("mean_test_score"), F.avg("fit_seconds").alias("mean_fit_time"))
        .withColumn("rank_test_score", F.rank().over(by_score))
    )


def best_candidates(results: DataFrame) -> DataFrame:
    """The candidate with the best mean score of each algorithm; the lower number of equals."""
    order = F.struct(F.col("mean_test_score"), -F.col("candidate"))
    return results.groupBy("algorithm").agg(
        F.max_by("candidate", order).alias("candidate"), F.max("mean_test_score").alias("best_score")
    )


def best_algorithm(best: DataFrame) -> DataFrame:
    """The one row with the best score over all algorithms; the first name of equals."""
    return best.orderBy(F.desc("best_score"), "algorithm").limit(1)
