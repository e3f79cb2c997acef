"""Histogram trees, linear fits from sums and cut points, against direct versions on the driver."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabwright.operators import trees as T
from tabwright.operators.blocks import blocks_of, cut_points
from tabwright.operators.linear import gram_matrices, lasso_path, logistic_models

NAMES = ["x0", "x1", "d0", "d1", "d2"]
GROUPS = [[2, 3, 4]]


def data(n=3000, seed=1):
    rnd = np.random.default_rng(seed)
    x0, x1 = rnd.integers(0, 40, n).astype(float), rnd.integers(0, 25, n).astype(float) / 4
    kind = rnd.integers(0, 4, n)  # 3: none of the dummies
    x = np.column_stack([x0, x1, *(kind == k for k in range(3))]).astype(float)
    y = 3.0 * (x0 > 17) + x1 * (kind == 1) - 2.0 * (kind == 2) + rnd.integers(-8, 9, n) / 4
    return x, y, rnd.choice([1.0, 0.5, 2.0], n)


def blocked(spark, x, y, w=None, pieces=4, groups=GROUPS):
    w = np.ones(len(y)) if w is None else w
    rows = [(i, *map(float, r), float(a), float(b)) for i, (r, a, b) in enumerate(zip(x, y, w))]
    names = [f"x{i}" for i in range(x.shape[1])]
    df = spark.createDataFrame(rows, ["id", *names, "y", "w"]).repartition(pieces)
    df = VectorAssembler(inputCols=names, outputCol="f").transform(df).select("f", "y", "w", F.xxhash64("id").alias("key"))
    return blocks_of(df, "f", "y", "w", "key", x.shape[1], groups)


def predicted(ensemble, x, outputs=1):
    out = np.tile(np.array(ensemble.base, float), (len(x), 1))
    for k, nodes in ensemble.trees:
        for i, row in enumerate(x):
            at = 0
            while nodes[at][0] >= 0:
                at = nodes[at][2] if row[nodes[at][0]] <= nodes[at][1] else nodes[at][3]
            out[i, k] += nodes[at][4]
    return out


def plain_tree(x, g, h, depth, l2, least_h, least_n, leaves=None):
    """A dictionary tree by trying every gap of every feature; level by level, or the best leaf first."""

    def score(rows):
        return g[rows].sum() ** 2 / (h[rows].sum() + l2)

    def best(rows):
        top = (1e-9 * max(score(rows), 1e-20), None)
        for f in range(x.shape[1]):
            values = np.unique(x[rows, f])
            for a, b in zip(values, values[1:]):
                left = rows & (x[:, f] <= (a + b) / 2)
                right = rows & ~left
                if min(left.sum(), right.sum()) < least_n or min(h[left].sum(), h[right].sum()) < least_h:
                    continue
                gain = score(left) + score(right) - score(rows)
                if gain > top[0] * (1 + 1e-12):
                    top = (gain, (f, (a + b) / 2, left, right))
        return top

    value = np.zeros(len(x))
    open_ = [(np.ones(len(x), bool), 0, *best(np.ones(len(x), bool)))]
    done, order = [], []
    while open_:
        if leaves is None:
            at = 0
        else:
            at = max(range(len(open_)), key=lambda i: open_[i][2] if open_[i][3] and open_[i][1] < depth else -1)
        rows, level, gain, split = open_.pop(at)
        full = leaves is not None and len(done) + len(open_) + 1 >= leaves
        if split is None or level >= depth or full:
            done.append(rows)
            continue
        order.append((level, split[0]))
        open_ += [(side, level + 1, *best(side)) for side in split[2:]]
    for rows in done:
        value[rows] = -g[rows].sum() / (h[rows].sum() + l2)
    return value, order, done


@pytest.mark.parametrize("leaves", [None, 5])
def test_two_rounds_equal_a_plain_version(spark, leaves):
    x, y, w = data(1200)
    growth = T.Growth(T.SQUARED, max_depth=3 if leaves is None else 8, leaves=leaves, l2=1.0, least_hessian=20.0, least_rows=5)
    blocks = blocked(spark, x, y, w)
    ensemble = T.boosted(blocks, growth, 2, 0.5, 256)
    blocks.release()
    f = np.full(len(y), np.average(y, weights=w))
    for _ in range(2):
        value, _, _ = plain_tree(x, (f - y) * w, w, growth.max_depth, 1.0, 20.0, 5, leaves)
        f = f + 0.5 * value
    assert np.abs(predicted(ensemble, x)[:, 0] - f).max() < 1e-6


def test_logistic_rounds_use_gradients_and_hessians(spark):
    x, y, w = data(900, 3)
    label = (y > 1).astype(float)
    blocks = blocked(spark, x, label, w)
    ensemble = T.boosted(blocks, T.Growth(T.LOGISTIC, max_depth=2, l2=1.0, least_hessian=1.0), 3, 0.3, 256)
    blocks.release()
    share = np.average(label, weights=w)
    m = np.full(len(label), math.log(share / (1 - share)))
    for _ in range(3):
        p = 1 / (1 + np.exp(-m))
        m = m + 0.3 * plain_tree(x, (p - label) * w, p * (1 - p) * w, 2, 1.0, 1.0, 1)[0]
    assert np.abs(predicted(ensemble, x)[:, 0] - m).max() < 1e-6


def test_the_best_leaf_is_split_next(spark):
    """A table on which level by level would split a leaf that best first leaves alone."""
    x = np.array([[a, b] for a in range(2) for b in range(8) for _ in range(30)], float)
    y = np.where(x[:, 0] == 0, 0.01 * (x[:, 1] > 3), 10 + 5 * (x[:, 1] > 3) + 4 * (x[:, 1] > 5))
    blocks = blocked(spark, x, y, groups=[])
    leaf = T.boosted(blocks, T.Growth(T.SQUARED, max_depth=8, leaves=4), 1, 1.0, 255)
    level = T.boosted(blocks, T.Growth(T.SQUARED, max_depth=2), 1, 1.0, 255)
    blocks.release()
    depths = lambda nodes: sorted(_depths(nodes))
    assert depths(leaf.trees[0][1]) == [1, 2, 3, 3] and depths(level.trees[0][1]) == [2, 2, 2, 2]
    value, order, _ = plain_tree(x, -y + y.mean(), np.ones(len(y)), 8, 0.0, 0.0, 1, 4)
    assert [d for d, _ in order] == [0, 1, 2]
    assert np.abs(predicted(leaf, x)[:, 0] - (y.mean() + value)).max() < 1e-6


def _depths(nodes, at=0, depth=0):
    if nodes[at][0] < 0:
        return [depth]
    return _depths(nodes, nodes[at][2], depth + 1) + _depths(nodes, nodes[at][3], depth + 1)


def test_leaves_counted_ahead_need_few_jobs(spark):
    x, y, _ = data(2000)
    blocks = blocked(spark, x, y)
    T.coded(blocks, 255).frame.count()
    made = []
    grower = T.Grower(T.coded(blocks, 255), T.Growth(T.SQUARED, max_depth=20, leaves=31), [0.0], (20.0, 2.0))
    count = grower._histograms
    grower._histograms = lambda asked: made.append(len(asked)) or count(asked)
    (tree,) = grower.grow([T._Growing(0, 0)])
    assert (tree.column < 0).sum() == 31 and len(made) <= 15
    blocks.release()


def test_a_round_of_many_classes_needs_no_more_jobs(spark):
    x, y, _ = data(1500)
    jobs = {}
    for k in (3, 9):
        label = np.digitize(y, np.quantile(y, np.arange(1, k) / k)).astype(float)
        blocks = blocked(spark, x, label)
        grower = T.Grower(T.coded(blocks, 255), T.Growth(T.SOFTMAX, classes=k, max_depth=3), [0.0] * k, (1.0, 1.0))
        count, made = grower._histograms, []
        grower._histograms = lambda asked: made.append(len(asked)) or count(asked)
        assert len(grower.grow([T._Growing(0, c) for c in range(k)])) == k
        jobs[k] = len(made)
        blocks.release()
    assert jobs[3] == jobs[9] == 3


def test_class_shares_stand_in_the_leaves(spark, tmp_path):
    x, y, w = data(2000)
    label = np.digitize(y, [0.0, 2.0]).astype(float)
    blocks = blocked(spark, x, label, w)
    ensemble = T.averaged(blocks, T.Growth(T.SHARES, classes=3, max_depth=1), 1, 256)
    blocks.release()
    nodes = ensemble.trees[0][1]
    left = x[:, nodes[0][0]] <= nodes[0][1]
    want = [np.bincount(label[s].astype(int), w[s], 3) for s in (left, ~left)]
    got = [-np.array(nodes[nodes[0][side]][5]) for side in (2, 3)]
    assert np.abs(np.array(got) - np.array(want)).max() < 1e-6
    (model,) = T.models_of(spark, ensemble, str(tmp_path / "forest"), 3)
    scored = VectorAssembler(inputCols=["a", "b", "c", "d", "e"], outputCol="features").transform(spark.createDataFrame([tuple(map(float, x[0]))], list("abcde")))
    shares = model.transform(scored).first()["probability"].toArray()
    assert np.abs(shares - want[int(not left[0])] / want[int(not left[0])].sum()).max() < 1e-9


@pytest.mark.parametrize("objective", [T.MEAN, T.LOGISTIC])
def test_one_model_however_rows_are_cut(spark, objective):
    x, y, w = data(2500)
    made = []
    for pieces in (2, 4, 8, 40):
        blocks = blocked(spark, x, (y > 1).astype(float), w, pieces)
        if objective == T.MEAN:
            made.append(T.averaged(blocks, T.Growth(T.MEAN, max_depth=6, bootstrap=True, features_per_node=2, seed=4), 6, 32))
        else:
            made.append(T.boosted(blocks, T.Growth(T.LOGISTIC, max_depth=3, l2=1.0), 3, 0.3, 32))
        plan = blocks.frame._jdf.queryExecution().toString()
        assert "hashpartitioning" not in plan.split("InMemoryRelation")[0]
        blocks.release()
    assert all(m == made[0] for m in made)


def test_margins_written_into_the_rows_change_nothing(spark, monkeypatch):
    x, y, w = data(800)
    made = []
    for rounds in (2, 1000):
        monkeypatch.setattr(T, "REFRESH", rounds)
        blocks = blocked(spark, x, y, w)
        made.append(T.boosted(blocks, T.Growth(T.SQUARED, max_depth=2, l2=1.0), 9, 0.3, 64))
        blocks.release()
    assert made[0] == made[1]


def test_bootstrap_counts():
    key = np.random.default_rng(0).integers(-(2**62), 2**62, 200_000)
    a, b = T.draws_of(key, 5, 0), T.draws_of(key, 5, 1)
    assert abs(a.mean() - 1) < 0.01 and abs(a.var() - 1) < 0.02 and abs(np.corrcoef(a, b)[0, 1]) < 0.01
    assert (T.draws_of(key, 5, 0) == a).all()


def test_cut_points(spark, sf):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select("l_extendedprice", "l_linenumber", "l_shipdate")
    year = lines.withColumn("year", F.year("l_shipdate").cast("double")).withColumn("far", F.col("year") * 1e9 + F.col("l_linenumber"))
    df = VectorAssembler(inputCols=["l_extendedprice", "year", "far"], outputCol="f").transform(year)
    made = []
    for pieces in (1, 7):
        rows = df.repartition(pieces).select("f", F.lit(0.0).alias("y"), F.lit(1).cast("long").alias("key"))
        blocks = blocks_of(rows, "f", "y", None, "key", 3)
        made.append(cut_points(blocks, [0, 1, 2], 256))
        blocks.release()
    assert all((made[0][f] == made[1][f]).all() for f in range(3))
    price = np.sort(np.array([r[0] for r in lines.select("l_extendedprice").collect()], float))
    ranks = np.searchsorted(price, made[0][0], side="right") / len(price)
    assert len(ranks) == 255 and np.abs(ranks - np.arange(1, 256) / 256).max() <= 1 / 1024
    years = sorted(r[0] for r in year.select("year").distinct().collect())
    far = sorted(r[0] for r in year.select("far").distinct().collect())
    for values, cuts in ((years, made[0][1]), (far, made[0][2])):
        assert len(cuts) == len(values) - 1 and all(a < c < b for a, c, b in zip(values, cuts, values[1:]))


def test_lasso_satisfies_its_conditions(spark):
    x, y, w = data(2000, 8)
    frame = spark.createDataFrame([(i % 3, float(b), float(c), [float(v) for v in a]) for i, (a, b, c) in enumerate(zip(x, y, w))], "f int, y double, w double, x array<double>")
    (inside, outside), *_ = gram_matrices(frame.repartition(5), [5])
    keep = np.arange(len(y)) % 3 != 0
    assert inside[0, 0] == pytest.approx(w[keep].sum()) and outside[0, 0] == (~keep).sum()
    for alpha, model in lasso_path(inside, [0.01, 0.2, 5.0]).items():
        b = np.array(model.coefficients[0])
        rest = y[keep] - x[keep] @ b - model.intercepts[0]
        slope = (x[keep] * (rest * w[keep])[:, None]).sum(axis=0) / w[keep].sum()
        assert abs((rest * w[keep]).sum()) < 1e-6 and (np.abs(slope) <= alpha + 1e-6).all()
        assert np.abs(slope[b != 0] - alpha * np.sign(b[b != 0])).max(initial=0) < 1e-6


@pytest.mark.parametrize("classes", [2, 3])
def test_logistic_models_are_optimal_and_need_no_more_jobs(spark, classes):
    x, y, w = data(1500, 9)
    x[:, 0] /= 40
    label = np.digitize(y, np.quantile(y, np.arange(1, classes) / classes)).astype(float)
    blocks = blocked(spark, x, label, w)
    strengths = [0.01, 1.0, 100.0]
    together = logistic_models(blocks, classes, strengths)
    for c, model in zip(strengths, together):
        beta, b = np.array(model.coefficients), np.array(model.intercepts)
        z = x @ beta.T + b
        z = np.column_stack([np.zeros(len(z)), z]) if classes == 2 else z
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        r = (p - (label[:, None] == np.arange(classes))) * w[:, None]
        r = r[:, 1:] if classes == 2 else r
        gradient = c * r.T @ x + beta
        assert np.abs(gradient).max() < 1e-4 * max(1, c) and np.abs(c * r.sum(axis=0)).max() < 1e-4 * max(1, c)
        (alone,) = logistic_models(blocks, classes, [c])
        assert np.abs(np.array(alone.coefficients) - beta).max() < 1e-5
    blocks.release()
