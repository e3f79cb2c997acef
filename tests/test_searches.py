"""The searches over general data draw as many candidates, from as wide ranges, as a user's search does by default."""

import pytest

from catalog.models import regression_spec, two_class_spec
from tabwright.operators.estimators import parameter_ranges
from tabwright.operators.search import draw_candidates
from tabwright.plans.spec import TrainSpec


@pytest.mark.parametrize("name", ["search_regression", "search_two_class"])
def test_searches_draw_from_the_default_ranges(spark, sf, name):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    spec = regression_spec(lines) if name == "search_regression" else two_class_spec()
    assert (spec.n_iter, spec.folds) == (TrainSpec.n_iter, TrainSpec.folds) == (4, 3)
    for algorithm in spec.algorithms:
        assert algorithm.draws(spec.task) == list(parameter_ranges(algorithm.name, spec.task))
    rounds = [c.params["n_estimators"] for c in draw_candidates(spec.algorithms, spec.task, spec.n_iter, spec.seed) if "n_estimators" in c.params]
    assert len(rounds) == 4 and min(rounds) >= 200
