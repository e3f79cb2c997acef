"""Tabular model training, evaluation, registration and scoring on Spark DataFrames."""

from tabwright.operators.metrics import MULTI_CLASS, REGRESSION, TWO_CLASS
from tabwright.operators.prep import FeatureSpec
from tabwright.plans.registry import Registry
from tabwright.plans.score import score
from tabwright.plans.spec import AlgoSpec, TrainSpec, feature_specs
from tabwright.plans.train import train
from tabwright.session import build_session

__all__ = [
    "MULTI_CLASS",
    "REGRESSION",
    "TWO_CLASS",
    "AlgoSpec",
    "FeatureSpec",
    "Registry",
    "TrainSpec",
    "build_session",
    "feature_specs",
    "score",
    "train",
]
