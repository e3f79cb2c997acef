"""A few registered queries beside their SQL twins; ``check_oracles.py`` runs them all."""

import importlib

import pytest

from check_oracles import compare

entry = importlib.import_module("__spark_entry__")

NAMES = [
    "schema_columns",
    "class_weights",
    "time_split",
    "example_record",
    "scale_standard",
    "encode_dummy",
    "encode_unseen",
    "feature_matrix",
    "preparation_per_fold",
    "quality_features",
    "metrics_macro",
    "auc_one_vs_one",
    "threshold_predictions",
    "best_of_each_algorithm",
    "train_lasso",
    "one_split_decision_tree",
    "registry_cleanup",
    "surviving_versions",
]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_twin(spark, sf, name):
    assert compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], sf).startswith("ok")


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 1 and rows[0]["n_rows"] > 0


def test_every_twin_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
