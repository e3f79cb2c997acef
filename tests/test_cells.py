"""Boosting on rows put together by their codes, beside boosting that walks the rows and the library's own."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tabwright.operators import cells as C
from tabwright.operators import trees as T
from tabwright.operators.blocks import blocks_of
from tabwright.operators.estimators import CodedEstimator, FittedEstimator, FittingRows, LABEL, ROW, fit_estimator, predict_all
from tabwright.operators.metrics import REGRESSION
from tabwright.operators.prep import FEATURES

GROUPS = [[2, 3, 4]]


def data(n, seed=1):
    rnd = np.random.default_rng(seed)
    kind = rnd.integers(0, 4, n)  # 3: none of the dummies
    x = np.column_stack([rnd.integers(0, 30, n), rnd.integers(0, 9, n) / 4, *(kind == k for k in range(3))]).astype(float)
    y = 3.0 * (x[:, 0] > 17) + x[:, 1] * (kind == 1) - 2.0 * (kind == 2) + rnd.normal(size=n)
    return x, y, rnd.choice([1.0, 0.37, 2.2], n)


def frame_of(spark, x, y, w, pieces=4):
    names = [f"x{i}" for i in range(x.shape[1])]
    rows = [(i, *map(float, r), float(a), float(b)) for i, (r, a, b) in enumerate(zip(x, y, w))]
    df = spark.createDataFrame(rows, ["id", *names, LABEL, "weight"]).repartition(pieces)
    return VectorAssembler(inputCols=names, outputCol=FEATURES).transform(df).select(FEATURES, LABEL, "weight", F.xxhash64("id").alias(ROW))


def blocked(spark, x, y, w, pieces=4):
    return blocks_of(frame_of(spark, x, y, w, pieces), FEATURES, LABEL, "weight", ROW, x.shape[1], GROUPS)


def margins(ensemble, x):
    out = np.tile(np.array(ensemble.base, float), (len(x), 1))
    for k, nodes in ensemble.trees:
        for i, row in enumerate(x):
            at = 0
            while nodes[at][0] >= 0:
                at = nodes[at][2] if row[nodes[at][0]] <= nodes[at][1] else nodes[at][3]
            out[i, k] += nodes[at][4]
    return out


@pytest.mark.parametrize("objective, leaves", [(T.SQUARED, None), (T.SQUARED, 6), (T.RESIDUAL, None), (T.LOGISTIC, None), (T.SOFTMAX, None)])
def test_cells_give_the_trees_of_the_rows(spark, objective, leaves):
    x, y, w = data(1500)
    if objective in (T.LOGISTIC, T.SOFTMAX):
        y = np.digitize(y, [0.0] if objective == T.LOGISTIC else [-1.0, 1.0]).astype(float)
    growth = T.Growth(objective, classes=3 if objective == T.SOFTMAX else 1, max_depth=3, leaves=leaves, l2=1.0, least_rows=20, least_hessian=1.0)
    blocks = blocked(spark, x, y, w)
    by_rows, by_cells = T.boosted(blocks, growth, 3, 0.3, 256), C.boosted_on_cells(blocks, growth, 3, 0.3, 256)
    blocks.release()
    made = by_cells.as_ensemble()
    assert np.abs(margins(by_rows, x) - margins(made, x)).max() < 1e-6
    number = C.Numbering(by_cells.columns).number(C.codes_of(x, by_cells.columns, "<i8"))
    assert set(by_cells.known) == set(number)  # every row's vector, and no other
    kept = by_cells.margins[np.searchsorted(by_cells.known, number)]
    assert np.abs(kept - margins(made, x)).max() < 1e-9


def test_one_ensemble_however_rows_are_cut(spark):
    x, y, w = data(2000, 2)
    made = []
    for pieces in (1, 3, 16):
        blocks = blocked(spark, x, y, w, pieces)
        made.append(C.boosted_on_cells(blocks, T.Growth(T.SQUARED, max_depth=4, l2=1.0), 5, 0.3, 16).as_ensemble())
        blocks.release()
    assert made[0] == made[1] == made[2]


def test_jobs_do_not_follow_the_rounds(spark, monkeypatch):
    """A default search has hundreds of rounds: they must not become passes over the rows."""
    x, y, w = data(800, 3)
    passes = []
    for module in (T, C):
        before = module.map_batches
        monkeypatch.setattr(module, "map_batches", lambda *a, run=before: passes.append(a) or run(*a))
    made = {}
    for rounds in (2, 60):
        rows = FittingRows(frame_of(spark, x, y, w), 5, GROUPS, True)
        params = {"n_estimators": rounds, "max_depth": 4, "min_samples_leaf": 5, "learning_rate": 0.1}
        passes.clear()
        fitted = fit_estimator(rows, "gradient_boosting", params, REGRESSION, 0, 1)
        made[rounds] = len(passes)
        assert len(fitted.ensemble.trees) == rounds
        rows.release()
    assert made[2] == made[60] <= 6


def test_first_order_boosting_is_the_librarys(spark):
    x, y, w = data(1500, 4)
    frame = frame_of(spark, x, y, w)
    params = {"n_estimators": 6, "max_depth": 4, "min_samples_leaf": 7, "learning_rate": 0.2}
    rows = FittingRows(frame, 5, GROUPS, True)
    own = fit_estimator(rows, "gradient_boosting", params, REGRESSION, 0, 1)
    rows.release()
    learner = GBTRegressor(
        featuresCol=FEATURES, labelCol=LABEL, weightCol="weight", maxDepth=4, maxIter=6, stepSize=0.2, minInstancesPerNode=7, maxBins=256, seed=1
    )
    want = learner.fit(frame).transform(frame)
    got = predict_all(want.withColumnRenamed("prediction", "want"), {"got": own})
    assert isinstance(own, CodedEstimator) and got.agg(F.max(F.abs(F.col("got") - F.col("want")))).first()[0] < 1e-6


def test_scores_by_codes_are_those_of_the_written_model(spark):
    """Also of vectors that no training row had, and of values beyond the training rows'."""
    x, y, w = data(60, 5)
    rows = FittingRows(frame_of(spark, x, y, w), 5, GROUPS, True)
    params = {"n_estimators": 8, "max_depth": 5, "min_child_weight": 1.0, "learning_rate": 0.3}
    fitted = {name: fit_estimator(rows, name, params, REGRESSION, 0, 1) for name in ("xgb", "lgbm")}
    rows.release()
    other, label, weight = data(3000, 6)
    other[:9, 0], other[5:12, 1] = -1e6, 1e6
    scored = predict_all(frame_of(spark, other, label, weight), fitted)
    for name, model in fitted.items():
        scored = FittedEstimator.predict(model, scored, f"{name}_library")
    worst = scored.agg(*[F.max(F.abs(F.col(n) - F.col(f"{n}_library"))) for n in fitted]).first()
    assert max(worst) < 1e-9


def test_too_many_cells_are_walked_as_rows(spark, monkeypatch):
    x, y, w = data(700, 7)
    params = {"n_estimators": 4, "max_depth": 3, "min_samples_leaf": 5, "learning_rate": 0.3}
    made = []
    for most in (1 << 20, 50):
        monkeypatch.setattr(C, "CELL_CODES", most)
        rows = FittingRows(frame_of(spark, x, y, w), 5, GROUPS, True)
        made.append(fit_estimator(rows, "gradient_boosting", params, REGRESSION, 0, 1))
        rows.release()
    assert [isinstance(m, CodedEstimator) for m in made] == [True, False]
    df = frame_of(spark, x, y, w)
    for i, model in enumerate(made):
        df = model.predict(df, f"p{i}")
    assert df.agg(F.max(F.abs(F.col("p0") - F.col("p1")))).first()[0] < 1e-6


def test_sums_stop_where_there_are_too_many():
    total = C._Sum(100)
    for i in range(200):
        total.add(tuple(np.arange(i * 1000, (i + 1) * 1000) for _ in range(4)))
        if total.over:
            break
    assert total.over and i < 80
    few = C._Sum(100)
    for _ in range(5000):
        few.add(tuple(np.arange(50) for _ in range(4)))
    assert (few.close()[1] == 5000 * np.arange(50)).all() and not few.over
