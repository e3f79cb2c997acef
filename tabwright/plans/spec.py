"""The training specification: what a user chooses."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tabwright.operators.estimators import MAX_BINS, MLLIB_MAX_DEPTH, TREES, parameter_ranges
from tabwright.operators.metrics import MULTI_CLASS, REGRESSION, TWO_CLASS, metric_key
from tabwright.operators.prep import FeatureSpec
from tabwright.sources.tables import default_encoding, default_imputation


@dataclass(frozen=True)
class AlgoSpec:
    """An algorithm to try, with (smallest, largest) per searched parameter; defaults fill in the rest.

    ``max_bins`` bounds how finely trees cut a continuous feature: into at most so many ranges,
    placed by quantiles.
    """

    name: str
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    max_bins: int = MAX_BINS

    @property
    def settings(self) -> dict:
        """What every candidate has beside its drawn parameters."""
        return {"max_bins": self.max_bins} if self.name in TREES else {}

    def draws(self, task: str) -> list[tuple[str, str, float, float]]:
        known = parameter_ranges(self.name, task)
        unknown = set(self.ranges) - {p for p, *_ in known}
        if unknown:
            raise ValueError(f"{self.name} has no parameter {', '.join(sorted(unknown))}")
        chosen = []
        for parameter, kind, smallest, largest in known:
            low, high = self.ranges.get(parameter, (smallest, largest))
            if low is None or high is None or low > high:
                raise ValueError(f"{self.name}: {parameter} needs a smallest value that is not above the largest")
            if parameter == "max_depth" and high > MLLIB_MAX_DEPTH:
                raise ValueError(f"{self.name}: trees have at most {MLLIB_MAX_DEPTH} levels, max_depth may not reach {high}")
            chosen.append((parameter, kind, low, high))
        return chosen


@dataclass(frozen=True)
class TrainSpec:
    model_name: str
    target: str
    task: str
    features: Sequence[FeatureSpec]
    algorithms: Sequence[AlgoSpec]
    metric: str
    train_ratio: float = 0.8
    seed: int = 42
    n_iter: int = 4
    folds: int = 3
    class_weights: bool = True
    weights_from: str = "all"  # or "train": which rows' class shares decide the weights
    time_column: str | None = None
    key: Sequence[str] | None = None
    positive_class: object = None
    threshold: float = 0.5
    parallelism: int = 4
    max_classes: int | None = None  # refuse targets with more values; by default any number will do

    def __post_init__(self) -> None:
        if not re.fullmatch(r"[A-Za-z0-9_]+", self.model_name or ""):
            raise ValueError("the model name may hold letters, digits and underscores only")
        if self.task not in (TWO_CLASS, MULTI_CLASS, REGRESSION):
            raise ValueError(f"unknown task {self.task!r}")
        if not 0 < self.train_ratio < 1:
            raise ValueError("the train ratio must lie between 0 and 1")
        if not isinstance(self.seed, int):
            raise ValueError("the seed must be an integer")
        if not isinstance(self.n_iter, int) or self.n_iter < 1:
            raise ValueError("n_iter must be a positive integer")
        if self.weights_from not in ("all", "train"):
            raise ValueError("weights come from all rows or from the train rows")
        if not self.features:
            raise ValueError("choose at least one feature")
        if not self.algorithms:
            raise ValueError("choose at least one algorithm")
        metric_key(self.metric, self.task)
        for algorithm in self.algorithms:
            algorithm.draws(self.task)

    @property
    def is_classification(self) -> bool:
        return self.task != REGRESSION

    @property
    def weighted(self) -> bool:
        return self.is_classification and self.class_weights


def feature_specs(
    df: DataFrame,
    columns: Sequence[str],
    encodings: dict[str, str] | None = None,
    imputations: dict[str, str] | None = None,
    constants: dict[str, object] | None = None,
    max_categories: int = 10,
) -> list[FeatureSpec]:
    """The feature plan: each chosen column with its treatment, by default the one of its type."""
    encodings, imputations, constants = encodings or {}, imputations or {}, constants or {}
    specs = []
    for name in columns:
        dtype = df.schema[name].dataType
        specs.append(
            FeatureSpec(
                name,
                encodings.get(name, default_encoding(dtype)),
                imputations.get(name, default_imputation(dtype)),
                constants.get(name),
                max_categories,
            )
        )
    return specs
