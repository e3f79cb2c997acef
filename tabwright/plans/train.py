"""Training from table to registered model."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from decimal import Decimal

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tabwright.functions.hashing import quoted
from tabwright.operators.estimators import (
    LABEL,
    FittedEstimator,
    class_index,
    class_label,
    fit_estimator,
    run_parallel,
)
from tabwright.operators.metrics import (
    REGRESSION,
    TWO_CLASS,
    all_metrics,
    metric_key,
)
from tabwright.operators.prep import WHOLE, PrepModel, fit_prep_per_fold
from tabwright.operators.quality import check_training_table
from tabwright.operators.search import (
    FOLD_SCORES,
    best_algorithm,
    best_candidates,
    cross_validate,
    cv_results,
    draw_candidates,
    model_outputs,
    prepared,
    prepared_for_fitting,
)
from tabwright.operators.split import FOLD_COLUMN, SPLIT_COLUMN, TEST, TRAIN, Split, random_split, time_split
from tabwright.operators.weights import WEIGHT_COLUMN, class_list, with_class_weights
from tabwright.plans.model import TrainedModel
from tabwright.plans.registry import Registry
from tabwright.plans.spec import TrainSpec
from tabwright.plans.tracking import Run, Tracker
from tabwright.session import checkpoint_dir
from tabwright.sources.tables import is_missing, write_table


SMALL_ROWS = 2_000_000


@dataclass
class TrainResult:
    leaderboard: DataFrame  # one row per algorithm: best candidate, scores, test metrics
    cv_results: DataFrame
    models: dict[str, TrainedModel]
    best: str
    test_metrics: dict[str, dict[str, float]]
    split: Split
    row_counts: dict[str, int]  # input, train, test, and rows dropped for want of a target or time
    registered: str | None = None
    version: str | None = None
    runs: list[Run] = field(default_factory=list)

    @property
    def best_model(self) -> TrainedModel:
        return self.models[self.best]


def target_classes(df: DataFrame, spec: TrainSpec) -> list:
    """The target's values, sorted, the positive class last."""
    if spec.task == REGRESSION:
        return []
    classes = [float(c) if isinstance(c, Decimal) else c for c in class_list(df, spec.target, spec.max_classes)]
    if spec.task == TWO_CLASS and len(classes) != 2:
        raise ValueError(f"target {spec.target!r} has {len(classes)} values, not two")
    if len(classes) < 2:
        raise ValueError(f"target {spec.target!r} has fewer than two values")
    if spec.positive_class is not None:
        if spec.positive_class not in classes:
            raise ValueError(f"positive class {spec.positive_class!r} does not occur")
        classes = [c for c in classes if c != spec.positive_class] + [spec.positive_class]
    return classes


def label_column(spec: TrainSpec, classes: list) -> Column:
    target = F.col(quoted(spec.target))
    if spec.task == REGRESSION:
        return target.cast("double").alias(LABEL)
    return class_label(class_index(target, classes), classes)


def on_all_cores(df: DataFrame) -> DataFrame:
    """A small table may be one piece of one file: its rows are dealt out to all cores. Others stay where they lie."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.count() <= SMALL_ROWS else df


def split_table(df: DataFrame, spec: TrainSpec, table_path: str | None = None, stratified: bool = False) -> Split:
    """Drop rows without a target, split, weigh the classes, and write both sides if asked to.

    Rows are told apart by the key, or by the input's own columns: added weights change no side.
    ``stratified`` folds hold equal parts of each class.
    """
    df = df.where(~is_missing(df, spec.target))
    if table_path:
        df = on_all_cores(df)
    keys = list(spec.key or df.columns)
    if spec.time_column:
        split = time_split(df, spec.time_column, spec.train_ratio)
    else:
        split = random_split(df, spec.train_ratio, spec.seed, keys)
    if spec.weighted:
        source = split.train if spec.weights_from == "train" else df
        split = Split(with_class_weights(split.labelled, spec.target, source), split.cut)
    by = spec.target if stratified and spec.folds > 1 else None
    return split.write(table_path, spec.folds, spec.seed, keys, by) if table_path else split


def fit_one(
    train: DataFrame, spec: TrainSpec, classes: list, algorithm: str, params: dict, prep: PrepModel | None = None
) -> TrainedModel:
    """Preparation and one estimator with given parameters, fitted on all rows of ``train``."""
    if prep is None:
        prep = fit_prep_per_fold(train, spec.features, 0)[WHOLE]
    weight = WEIGHT_COLUMN if spec.weighted else None
    rows = prepared_for_fitting(train, prep, label_column(spec, classes), weight, spec.key)
    estimator = fit_estimator(rows, algorithm, params, spec.task, len(classes), spec.seed, spec.parallelism)
    rows.release()
    return as_model(spec, classes, train, prep, estimator)


def as_model(spec: TrainSpec, classes: list, df: DataFrame, prep: PrepModel, estimator: FittedEstimator) -> TrainedModel:
    target_type = df.schema[spec.target].dataType.simpleString()
    return TrainedModel(spec.task, spec.target, target_type, classes, [f.name for f in spec.features], prep, estimator)


def measure(models: Sequence[TrainedModel], df: DataFrame, spec: TrainSpec) -> list[Row]:
    """All test metrics of models that share one preparation: one row per algorithm."""
    first = models[0]
    rows = prepared(df, first.prep, label_column(spec, first.classes), None)
    outputs = model_outputs(rows, {m.estimator.algorithm: m.estimator for m in models}, spec.task)
    count = None
    if spec.task != REGRESSION:
        # read twice: for the rates, then for the ranking
        outputs = outputs.persist(StorageLevel.MEMORY_AND_DISK)
        count = outputs.count()
    metrics = all_metrics(outputs, spec.task, len(first.classes), ["model"], count)
    found = metrics.withColumnRenamed("model", "algorithm").collect()
    outputs.unpersist()
    return found


def evaluate(model: TrainedModel, df: DataFrame, spec: TrainSpec) -> DataFrame:
    """All test metrics of one model, in one row."""
    return df.sparkSession.createDataFrame(measure([model], df, spec)).drop("algorithm")


def train(
    df: DataFrame,
    spec: TrainSpec,
    workdir: str | None = None,
    registry: Registry | None = None,
    project_key: str = "PROJECT",
    train_output: str | None = None,
    test_output: str | None = None,
) -> TrainResult:
    """Search, evaluate and compare all algorithms of the specification.

    ``workdir`` (shared storage) receives the train and test tables and the run tables. Without
    it the tables go to the session's checkpoint folder and no runs are kept. The search reads
    the written table, so lost executors cost a re-read, not the whole lineage. With a registry
    the best model is registered. ``train_output`` and ``test_output`` name tables (by catalog
    name or path) that get the sides with the input's columns, and the class weights if there are
    any; each is copied from its own partitions of the written table.
    """
    spark = df.sparkSession
    features = [f.name for f in spec.features]
    reserved = [SPLIT_COLUMN, FOLD_COLUMN, *([WEIGHT_COLUMN] if spec.weighted else [])]
    check_training_table(df, spec.target, spec.is_classification, features, spec.time_column, reserved)
    metric = metric_key(spec.metric, spec.task)
    # two trainings of a model in one second must not share a table or a version
    stamp = f"{datetime.now(timezone.utc):%Y_%m_%d_%H_%M_%S}_{uuid.uuid4().hex[:6]}"
    classes = target_classes(df, spec)
    folder = workdir or f"{checkpoint_dir(spark).rstrip('/')}/train-{uuid.uuid4().hex}"
    split = split_table(df, spec, f"{folder}/tables/{spec.model_name}_{stamp}", spec.is_classification)

    for side, output in ((TRAIN, train_output), (TEST, test_output)):
        if output is not None:
            write_table(split.side(side), output)

    weight = WEIGHT_COLUMN if spec.weighted else None
    label = label_column(spec, classes)
    folded = split.folded_train(spec.folds, spec.seed, spec.key or df.columns)
    preps = fit_prep_per_fold(folded, spec.features, spec.folds)
    candidates = draw_candidates(spec.algorithms, spec.task, spec.n_iter, spec.seed)
    rows = cross_validate(
        folded, preps, candidates, label, metric, spec.task, len(classes), weight, spec.seed, spec.parallelism, spec.key
    )
    results = cv_results(spark.createDataFrame(rows, FOLD_SCORES))
    ranked = {(r["algorithm"], r["candidate"]): r for r in results.collect()}
    best = best_candidates(results)
    chosen = {r["algorithm"]: r for r in best.collect()}
    winner = best_algorithm(best).first()["algorithm"]

    by_key = {(c.algorithm, c.number): c for c in candidates}
    runs = [
        Run(
            f"{spec.model_name}_{stamp}_cv_{c.number}",
            c.algorithm,
            "cv",
            c.params,
            {
                "mean_fit_time": ranked[key]["mean_fit_time"],
                f"mean_test_{metric}": ranked[key]["mean_test_score"],
                "rank_test_score": ranked[key]["rank_test_score"],
            },
        )
        for key, c in by_key.items()
    ]

    fitting = prepared_for_fitting(split.train, preps[WHOLE], label, weight, spec.key)

    def refit(algorithm: str) -> tuple[FittedEstimator, float]:
        params = by_key[algorithm, chosen[algorithm]["candidate"]].params
        started = time.monotonic()
        estimator = fit_estimator(fitting, algorithm, params, spec.task, len(classes), spec.seed, spec.parallelism)
        return estimator, time.monotonic() - started

    refits = dict(zip(chosen, run_parallel(spark, refit, list(chosen), spec.parallelism)))
    models = {a: as_model(spec, classes, split.train, preps[WHOLE], estimator) for a, (estimator, _) in refits.items()}
    fitting.release()

    test_metrics, board, finals = {}, [], {}
    for measured in measure(list(models.values()), split.test, spec):
        algorithm, row = measured["algorithm"], chosen[measured["algorithm"]]
        seconds = refits[algorithm][1]
        test_metrics[algorithm] = {f"test_{k}": v for k, v in measured.asDict().items() if k not in ("n_rows", "algorithm")}
        scores = {f"{k}_score": v for k, v in test_metrics[algorithm].items()}
        finals[algorithm] = Run(
            f"{spec.model_name}_{stamp}_final_model",
            algorithm,
            "final",
            by_key[algorithm, row["candidate"]].params,
            {"whole_dataset_refit_time": seconds, **scores},
        )
        board.append((algorithm, row["candidate"], row["best_score"], seconds, test_metrics[algorithm], algorithm == winner))
    runs += finals.values()

    leaderboard = spark.createDataFrame(
        board,
        "algorithm string, candidate int, best_score double, refit_seconds double, "
        "test_metrics map<string,double>, is_best boolean",
    )
    counts = {row[SPLIT_COLUMN]: row["n_rows"] for row in split.sizes().collect()}  # at most two rows
    counts["input"] = df.count()
    counts["dropped"] = counts["input"] - counts.get(TRAIN, 0) - counts.get(TEST, 0)
    result = TrainResult(leaderboard, results, models, winner, test_metrics, split, counts, runs=runs)
    if workdir:
        Tracker(spark, f"{workdir}/tracking").log(runs)
    if registry is not None:
        final = finals[winner]
        result.version = final.name
        result.registered = registry.register(
            models[winner], spec.model_name, project_key, final.name, final.run_id, models[winner].signature(df),
            {k: v for k, v in test_metrics[winner].items() if v is not None}, spec.threshold,
        )
    return result
