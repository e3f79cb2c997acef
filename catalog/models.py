"""Training, search and scoring. Where a learner has a closed form on the data, SQL works it out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.common import LINE_KEY, LINE_KEY_SQL, SEED, rounded, sql_fold, sql_unit, table, work_folder
from tabwright.operators.blocks import blocks_of, cut_points
from tabwright.operators.metrics import MULTI_CLASS, REGRESSION, TWO_CLASS
from tabwright.operators.prep import FeatureSpec, fit_prep_per_fold
from tabwright.operators.search import FOLD_SCORES, candidate_table, cross_validate, draw_candidates
from tabwright.plans.model import TrainedModel
from tabwright.plans.registry import Registry
from tabwright.plans.score import score
from tabwright.plans.spec import AlgoSpec, TrainSpec, feature_specs
from tabwright.plans.train import evaluate, fit_one, label_column, split_table, target_classes, train
from tabwright.streaming.score_stream import score_stream
from tabwright.sources.tables import AVERAGE, DUMMY, MEDIAN, MOST_FREQUENT, NO_RESCALING, STANDARD

RATIO = 0.8


def fit_on_split(df: DataFrame, spec: TrainSpec, algorithm: str, params: dict) -> tuple[TrainedModel, DataFrame]:
    """Weights, split, preparation and one fit; returns the model and the test rows."""
    classes = target_classes(df, spec)
    split = split_table(df, spec, f"{work_folder(df.sparkSession)}/split")
    return fit_one(split.train, spec, classes, algorithm, params), split.test


# ------------------------------------------------------------------ flagship


def documents_with_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    return table(spark, sf_dir, "labels").select("doc_id", "quality").join(documents, "doc_id")


def quality_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights, split, preparation, logistic regression, test metrics."""
    df = documents_with_quality(spark, sf_dir)
    features = feature_specs(df, ["n_chars", "lang", "source"])
    spec = TrainSpec(
        "document_quality", "quality", TWO_CLASS, features, [AlgoSpec("logistic_regression")], "ROC AUC", key=["doc_id"]
    )
    model, test = fit_on_split(df, spec, "logistic_regression", {"C": 1.0})
    return rounded(evaluate(model, test, spec), "accuracy", "f1", "precision", "recall", "roc_auc", digits=4)


# ------------------------------------------------------------------ logistic regression


def status_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        (F.col("o_orderstatus") == "F").cast("int").alias("finished"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(5).alias("status"),
    )


def logistic_spec(target: str, task: str, weighted: bool) -> TrainSpec:
    features = [FeatureSpec("o_orderpriority", DUMMY, MOST_FREQUENT)]
    return TrainSpec(
        "order_status", target, task, features, [AlgoSpec("logistic_regression")], "ROC AUC",
        seed=SEED, class_weights=weighted, key=["o_orderkey"],
    )


def _priority_probabilities(spark: SparkSession, sf_dir: str, target: str, task: str, weighted: bool) -> DataFrame:
    """With one categorical feature and next to no penalty, the fit gives the (weighted) class shares."""
    spec = logistic_spec(target, task, weighted)
    model, test = fit_on_split(status_orders(spark, sf_dir), spec, "logistic_regression", {"C": 1e6})
    scored = model.score(test)
    names = [c for c in scored.columns if c.startswith("PREDICT_PROBA")]
    return scored.groupBy("o_orderpriority", "PREDICTION").agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.round(F.avg(c), 3).alias(c.lower()) for c in names]
    ).withColumnRenamed("PREDICTION", "prediction")


def train_logistic_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _priority_probabilities(spark, sf_dir, "finished", TWO_CLASS, False)


def train_logistic_regression_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _priority_probabilities(spark, sf_dir, "finished", TWO_CLASS, True)


def train_logistic_regression_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _priority_probabilities(spark, sf_dir, "status", MULTI_CLASS, False)


STATUS_ORDERS = f"""
status_orders AS (
  SELECT *, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS finished,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 5 END AS status,
         {sql_unit(["o_orderkey"], SEED)} < {RATIO} AS in_train
  FROM orders
)"""


def _two_class_sql(weighted: bool) -> str:
    # the classes are weighed over all rows, before the split
    weight = "n / (2 * CAST(sum(CASE WHEN finished = {c} THEN 1 ELSE 0 END) AS DOUBLE))"
    one, zero = ("w1", "w0") if weighted else ("1", "1")
    return f"""
WITH {STATUS_ORDERS},
weights AS (
  SELECT {weight.format(c=1)} AS w1, {weight.format(c=0)} AS w0
  FROM (SELECT finished, CAST(count(*) OVER () AS DOUBLE) AS n FROM status_orders) GROUP BY n
),
shares AS (
  SELECT o_orderpriority, sum(CASE WHEN finished = 1 THEN {one} ELSE 0 END) / CAST(sum(CASE WHEN finished = 1 THEN {one} ELSE {zero} END) AS DOUBLE) AS p
  FROM status_orders, weights WHERE in_train GROUP BY o_orderpriority
)"""


def _two_class_groups(weighted: bool) -> str:
    return f"""{_two_class_sql(weighted)}
SELECT o_orderpriority, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction, count(*) AS n_rows,
       round(1 - p, 3) AS predict_proba_0, round(p, 3) AS predict_proba_1
FROM status_orders JOIN shares USING (o_orderpriority) WHERE NOT in_train GROUP BY o_orderpriority, p"""


_STATUS_SHARES = f"""
WITH {STATUS_ORDERS},
shares AS (
  SELECT o_orderpriority, {", ".join(f"count(*) FILTER (WHERE status = {c}) / CAST(count(*) AS DOUBLE) AS p{c}" for c in (1, 2, 5))}
  FROM status_orders WHERE in_train GROUP BY o_orderpriority
)"""
_STATUS_PREDICTION = "CASE WHEN p1 >= p2 AND p1 >= p5 THEN 1 WHEN p2 >= p5 THEN 2 ELSE 5 END"
LOGISTIC_MULTI = f"""{_STATUS_SHARES}
SELECT o_orderpriority, {_STATUS_PREDICTION} AS prediction, count(*) AS n_rows,
       round(p1, 3) AS predict_proba_1, round(p2, 3) AS predict_proba_2, round(p5, 3) AS predict_proba_5
FROM status_orders JOIN shares USING (o_orderpriority) WHERE NOT in_train GROUP BY o_orderpriority, p1, p2, p5"""


# ------------------------------------------------------------------ lasso


def revenue_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, "l_extendedprice", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue")
    )


def lasso_spec(alpha: float) -> TrainSpec:
    return TrainSpec(
        "revenue", "revenue", REGRESSION, [FeatureSpec("l_extendedprice", STANDARD, AVERAGE)],
        [AlgoSpec("lasso", {"alpha": (alpha, alpha)})], "R2", seed=SEED, n_iter=1, key=LINE_KEY,
    )


def train_lasso(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature, so the fit is a soft threshold of its covariance with the target."""
    spec = lasso_spec(500.0)
    model, test = fit_on_split(revenue_lines(spark, sf_dir), spec, "lasso", {"alpha": 500.0})
    return rounded(evaluate(model, test, spec), "r2", "mae", "mse", "rmse", digits=3)


REVENUE_LINES = f"""
lines AS (
  SELECT {LINE_KEY_SQL}, l_extendedprice AS x, l_extendedprice * (1 - l_discount) AS y,
         {sql_unit(LINE_KEY, SEED)} < {RATIO} AS in_train, {sql_fold(LINE_KEY)} AS fold
  FROM lineitem
)"""


def _lasso_fit_sql(rows: str, alpha: float) -> str:
    return f"""
SELECT m, s, b0, CASE WHEN abs(c) > {alpha} THEN c - sign(c) * {alpha} ELSE 0 END AS b
FROM (SELECT avg(x) AS m, stddev_pop(x) AS s, avg(y) AS b0, covar_pop(x, y) / stddev_pop(x) AS c FROM {rows})"""


LASSO = f"""
WITH {REVENUE_LINES},
fit AS ({_lasso_fit_sql("(SELECT * FROM lines WHERE in_train)", 500.0)}),
scored AS (SELECT y, b0 + b * (x - m) / s AS f FROM lines, fit WHERE NOT in_train)
SELECT count(*) AS n_rows, round(1 - avg((y - f) * (y - f)) / var_pop(y), 3) AS r2, round(avg(abs(y - f)), 3) AS mae,
       round(avg((y - f) * (y - f)), 3) AS mse, round(sqrt(avg((y - f) * (y - f))), 3) AS rmse
FROM scored"""


def cross_validated_lasso(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preparation and fit without each fold in turn, scored on that fold."""
    spec = lasso_spec(800.0)
    lines = revenue_lines(spark, sf_dir)
    split = split_table(lines, spec, f"{work_folder(spark)}/split")
    folded = split.folded_train(3, SEED, LINE_KEY)
    preps = fit_prep_per_fold(folded, spec.features, 3)
    candidates = draw_candidates(spec.algorithms, REGRESSION, 1, SEED)
    rows = cross_validate(folded, preps, candidates, label_column(spec, []), "r2", REGRESSION, 0, None, SEED)
    scores = spark.createDataFrame(rows, FOLD_SCORES)
    return rounded(scores.select("algorithm", "candidate", "fold", "score"), "score")


CV_LASSO = f"WITH {REVENUE_LINES}, train AS (SELECT * FROM lines WHERE in_train)" + "\nUNION ALL".join(
    f"""
SELECT 'lasso' AS algorithm, 1 AS candidate, {f} AS fold, round(1 - avg((y - f) * (y - f)) / var_pop(y), 6) AS score
FROM (SELECT y, b0 + b * (x - m) / s AS f FROM train, ({_lasso_fit_sql(f"(SELECT * FROM train WHERE fold <> {f})", 800.0)}) WHERE fold = {f})"""
    for f in range(3)
)


# ------------------------------------------------------------------ trees on a target they can learn


def banded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY,
        "l_quantity",
        "l_discount",
        "l_tax",
        "l_returnflag",
        (quantity > 30).cast("int").alias("large"),
        F.when(quantity <= 15, 0).when(quantity <= 35, 1).otherwise(2).alias("band"),
        F.when(quantity <= 15, 10.0).when(quantity <= 35, 25.0).otherwise(70.0).alias("level"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        (F.col("l_extendedprice") > 50000).cast("int").alias("dear"),
    )


TREE_FEATURES = [
    FeatureSpec("l_quantity", STANDARD, MEDIAN),
    FeatureSpec("l_discount", STANDARD, MEDIAN),
    FeatureSpec("l_tax", STANDARD, MEDIAN),
    FeatureSpec("l_returnflag", DUMMY, MOST_FREQUENT),
]
FOREST = {"n_estimators": 10, "max_depth": 6, "min_samples_leaf": 1}
BOOSTED = {"n_estimators": 5, "max_depth": 3, "min_child_weight": 1.0, "learning_rate": 0.3}
GRADIENT = {"n_estimators": 5, "max_depth": 3, "min_samples_leaf": 5, "learning_rate": 0.3}
TREE = {"max_depth": 4, "min_samples_leaf": 5}


def tree_spec(target: str, task: str, algorithm: str) -> TrainSpec:
    metric = "R2" if task == REGRESSION else "ROC AUC"
    return TrainSpec("bands", target, task, TREE_FEATURES, [AlgoSpec(algorithm)], metric, seed=SEED, key=LINE_KEY)


def _learned(target: str, task: str, algorithm: str, params: dict) -> Callable[[SparkSession, str], DataFrame]:
    """Train on the train side; predictions against truth on the test side."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        model, test = fit_on_split(banded_lines(spark, sf_dir), tree_spec(target, task, algorithm), algorithm, params)
        prediction = F.col("PREDICTION") if task != REGRESSION else F.round("PREDICTION", 6)
        return (
            model.score(test)
            .groupBy(F.col(target).alias("label"), prediction.alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n_rows"))
        )

    query.__doc__ = f"{algorithm}, {task}: the target is a step function of one feature, so no test row may be wrong."
    return query


def _learned_sql(label: str) -> str:
    return f"""
SELECT {label} AS label, {label} AS prediction, count(*) AS n_rows
FROM lineitem WHERE {sql_unit(LINE_KEY, SEED)} >= {RATIO} GROUP BY 1, 2"""


LARGE = _learned_sql("CASE WHEN l_quantity > 30 THEN 1 ELSE 0 END")
BAND = _learned_sql("CASE WHEN l_quantity <= 15 THEN 0 WHEN l_quantity <= 35 THEN 1 ELSE 2 END")
LEVEL = _learned_sql("CAST(CASE WHEN l_quantity <= 15 THEN 10 WHEN l_quantity <= 35 THEN 25 ELSE 70 END AS DOUBLE)")


def _shrunk_level(l2: float) -> str:
    """Each round takes 0.3 of a level's residual, by n / (n + l2): after five rounds this much of the distance to the mean is left."""
    return f"""
WITH banded AS (
  SELECT CAST(CASE WHEN l_quantity <= 15 THEN 10 WHEN l_quantity <= 35 THEN 25 ELSE 70 END AS DOUBLE) AS level,
         {sql_unit(LINE_KEY, SEED)} < {RATIO} AS in_train
  FROM lineitem
),
start AS (SELECT avg(level) AS base FROM banded WHERE in_train),
sizes AS (SELECT level, CAST(count(*) AS DOUBLE) AS n FROM banded WHERE in_train GROUP BY level)
SELECT level AS label, round(level + (base - level) * pow(1 - 0.3 * n / (n + {l2}), 5), 6) AS prediction, count(*) AS n_rows
FROM banded JOIN sizes USING (level), start WHERE NOT in_train GROUP BY 1, 2"""


# ------------------------------------------------------------------ trees on a target of chance

STUMP_FEATURES = [FeatureSpec(c, NO_RESCALING, MEDIAN) for c in ("l_quantity", "l_discount", "l_tax")]


def features_with_reserved_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stump with features called as the columns that learners read."""
    names = {"l_quantity": "label", "l_discount": "weight", "l_tax": "features"}
    lines = banded_lines(spark, sf_dir).withColumnsRenamed(names)
    features = [FeatureSpec(c, NO_RESCALING, MEDIAN) for c in names.values()]
    spec = TrainSpec("stump", "dear", TWO_CLASS, features, [AlgoSpec("decision_tree")], "ROC AUC", seed=SEED, class_weights=False, key=LINE_KEY)
    model, test = fit_on_split(lines, spec, "decision_tree", ONE_SPLIT)
    return model.score(test).groupBy(F.round("PREDICT_PROBA_1", 4).alias("prediction")).agg(F.count(F.lit(1)).alias("n_rows"))


def _stump(target: str, task: str, algorithm: str, params: dict) -> Callable[[SparkSession, str], DataFrame]:
    """Trees of depth one: SQL can try every split."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        metric = "R2" if task == REGRESSION else "ROC AUC"
        spec = TrainSpec(
            "stump", target, task, STUMP_FEATURES, [AlgoSpec(algorithm)], metric, seed=SEED, class_weights=False, key=LINE_KEY
        )
        model, test = fit_on_split(banded_lines(spark, sf_dir), spec, algorithm, params)
        column = "PREDICTION" if task == REGRESSION else "PREDICT_PROBA_1"
        return model.score(test).groupBy(F.round(column, 4).alias("prediction")).agg(F.count(F.lit(1)).alias("n_rows"))

    return query


def _stump_steps(name: str, residual: str, source: str, l2: float = 0, least: int = 1) -> str:
    """CTEs ``<name>``: feature, cut, value left and right of the best split of ``residual``."""
    columns = ("l_quantity", "l_discount", "l_tax")
    stacked = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS x, {residual} AS y FROM {source} WHERE in_train" for c in columns)
    return f"""
{name}_sums AS (SELECT feature, x, CAST(count(*) AS DOUBLE) AS n, sum(y) AS s FROM ({stacked}) GROUP BY feature, x),
{name}_runs AS (
  SELECT feature, x, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER f AS nt, sum(s) OVER f AS st FROM {name}_sums
  WINDOW w AS (PARTITION BY feature ORDER BY x), f AS (PARTITION BY feature)
),
{name} AS (
  SELECT feature, x AS cut, sl / (nl + {l2}) AS below, (st - sl) / (nt - nl + {l2}) AS above FROM {name}_runs
  WHERE nl >= {least} AND nt - nl >= {least}
  ORDER BY sl * sl / (nl + {l2}) + (st - sl) * (st - sl) / (nt - nl + {l2}) DESC LIMIT 1
)"""


def _stump_value(name: str) -> str:
    picked = f"CASE {name}.feature WHEN 'l_quantity' THEN l_quantity WHEN 'l_discount' THEN l_discount ELSE l_tax END"
    return f"CASE WHEN {picked} <= {name}.cut THEN {name}.below ELSE {name}.above END"


def _stump_rows(target: str) -> str:
    return f"""
rows0 AS (
  SELECT l_quantity, l_discount, l_tax, {target} AS y, {sql_unit(LINE_KEY, SEED)} < {RATIO} AS in_train FROM lineitem
)"""


def _stump_sql(target: str) -> str:
    return f"""
WITH {_stump_rows(target)}, {_stump_steps("first", "y", "rows0")}
SELECT round({_stump_value("first")}, 4) AS prediction, count(*) AS n_rows FROM rows0, first WHERE NOT in_train GROUP BY 1"""


def _two_rounds_sql(target: str, rate: float) -> str:
    # squared loss: the second tree is fitted to twice the residual
    return f"""
WITH {_stump_rows(target)}, {_stump_steps("first", "y", "rows0")},
rows1 AS (SELECT rows0.*, {_stump_value("first")} AS f0 FROM rows0, first), {_stump_steps("second", "2 * (y - f0)", "rows1")}
SELECT round(f0 + {rate} * {_stump_value("second")}, 4) AS prediction, count(*) AS n_rows
FROM rows1, second WHERE NOT in_train GROUP BY 1"""


def _second_order_sql(target: str, rate: float, l2: float, least: int) -> str:
    """Two rounds from the mean on: leaves are -G / (H + l2), with squared loss the residuals' sum over the rows' number."""
    return f"""
WITH {_stump_rows(target)},
start AS (SELECT *, (SELECT avg(y) FROM rows0 WHERE in_train) AS f0 FROM rows0), {_stump_steps("first", "y - f0", "start", l2, least)},
rows1 AS (SELECT start.*, f0 + {rate} * {_stump_value("first")} AS f1 FROM start, first), {_stump_steps("second", "y - f1", "rows1", l2, least)}
SELECT round(f1 + {rate} * {_stump_value("second")}, 4) AS prediction, count(*) AS n_rows
FROM rows1, second WHERE NOT in_train GROUP BY 1"""


_REVENUE = "l_extendedprice * (1 - l_discount)"
_DEAR = "CASE WHEN l_extendedprice > 50000 THEN CAST(1 AS DOUBLE) ELSE 0 END"
ONE_SPLIT = {"max_depth": 1, "min_samples_leaf": 1}
TWO_ROUNDS = {"n_estimators": 2, "max_depth": 1, "min_samples_leaf": 1, "min_child_weight": 1.0, "learning_rate": 0.5}


# ------------------------------------------------------------------ search


def search_two_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search, refit, test and choose over three algorithms, with tables and runs written."""
    return _board(train(banded_lines(spark, sf_dir), two_class_spec(), work_folder(spark)).leaderboard)


def two_class_spec() -> TrainSpec:
    """The default number of draws from the default ranges: hundreds of rounds."""
    algorithms = [AlgoSpec("decision_tree"), AlgoSpec("logistic_regression"), AlgoSpec("xgb")]
    return TrainSpec("dear", "dear", TWO_CLASS, TREE_FEATURES, algorithms, "ROC AUC", seed=SEED, key=LINE_KEY)


def search_multi_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("fifth", F.least(F.floor(F.col("value") / 25), F.lit(3)).cast("int"))
    features = feature_specs(events, ["value", "event_type"])
    algorithms = [
        AlgoSpec("decision_tree", {"max_depth": (2, 4)}),
        AlgoSpec("random_forest", {"n_estimators": (3, 6), "max_depth": (2, 4)}),
    ]
    spec = TrainSpec(
        "value_band", "fifth", MULTI_CLASS, features, algorithms, "F1 Score", seed=SEED, n_iter=2, key=["event_id"]
    )
    return _board(train(events, spec).leaderboard)


def search_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered by time; errors are compared with the smaller one winning."""
    lines = table(spark, sf_dir, "lineitem").withColumn("revenue", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return _board(train(lines, regression_spec(lines)).leaderboard)


def regression_spec(lines: DataFrame) -> TrainSpec:
    """The default number of draws from the default ranges: hundreds of rounds."""
    features = feature_specs(lines, ["l_extendedprice", "l_discount", "l_returnflag"])
    algorithms = [AlgoSpec("lasso"), AlgoSpec("gradient_boosting")]
    return TrainSpec(
        "revenue", "revenue", REGRESSION, features, algorithms, "MAE", seed=SEED, key=LINE_KEY, time_column="l_shipdate"
    )


def squared_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, "l_quantity", (quantity * quantity + F.col("l_extendedprice") / 100).alias("amount")
    )


def closed_form_spec(metric: str = "MSE") -> TrainSpec:
    """One lasso and one split of the same feature: both have a closed form, so the whole search has."""
    algorithms = [
        AlgoSpec("lasso", {"alpha": (20.0, 20.0)}),
        AlgoSpec("decision_tree", {"max_depth": (1, 1), "min_samples_leaf": (1, 1)}),
    ]
    features = [FeatureSpec("l_quantity", STANDARD, AVERAGE)]
    return TrainSpec("amount", "amount", REGRESSION, features, algorithms, metric, seed=SEED, n_iter=1, key=LINE_KEY)


def search_closed_form(spark: SparkSession, sf_dir: str, metric: str = "MSE") -> DataFrame:
    """Cross-validation, refit, test and choice, all of it checked."""
    board = train(squared_lines(spark, sf_dir), closed_form_spec(metric)).leaderboard
    metrics = [F.round(F.col("test_metrics")[f"test_{m}"], 3).alias(f"test_{m}") for m in ("r2", "mae", "mse", "rmse")]
    return board.select("algorithm", "candidate", F.round("best_score", 3).alias("best_score"), "is_best", *metrics)


def _scored_by_both(name: str, learn: str, apply: str) -> str:
    """CTE ``<name>``: algorithm, y and prediction f of the rows where ``apply``, learned where ``learn``."""
    rows = f"(SELECT * FROM lines WHERE {learn})"
    return f"""
{name}_runs AS (
  SELECT x, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER () AS nt, sum(s) OVER () AS st
  FROM (SELECT x, CAST(count(*) AS DOUBLE) AS n, sum(y) AS s FROM {rows} GROUP BY x) WINDOW w AS (ORDER BY x)
),
{name}_split AS (
  SELECT x AS cut, sl / nl AS below, (st - sl) / (nt - nl) AS above FROM {name}_runs WHERE nl < nt
  ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC LIMIT 1
),
{name} AS (
  SELECT 'lasso' AS algorithm, y, b0 + b * (x - m) / s AS f FROM lines, ({_lasso_fit_sql(rows, 20.0)}) WHERE {apply}
  UNION ALL
  SELECT 'decision_tree', y, CASE WHEN x <= cut THEN below ELSE above END FROM lines, {name}_split WHERE {apply}
)"""


_SEARCHED = f"""
WITH lines AS (
  SELECT l_quantity AS x, l_quantity * l_quantity + l_extendedprice / 100 AS y,
         {sql_unit(LINE_KEY, SEED)} < {RATIO} AS in_train, {sql_fold(LINE_KEY)} AS fold
  FROM lineitem
),
{",".join(_scored_by_both(f"fold{f}", f"in_train AND fold <> {f}", f"in_train AND fold = {f}") for f in range(3))},
{_scored_by_both("final", "in_train", "NOT in_train")},
searched AS (
  SELECT algorithm, avg(score) AS best_score FROM (
    {" UNION ALL ".join(f"SELECT algorithm, -avg((y - f) * (y - f)) AS score FROM fold{f} GROUP BY algorithm" for f in range(3))}
  ) GROUP BY algorithm
),
tested AS (
  SELECT algorithm, 1 - avg((y - f) * (y - f)) / var_pop(y) AS test_r2, avg(abs(y - f)) AS test_mae,
         avg((y - f) * (y - f)) AS test_mse, sqrt(avg((y - f) * (y - f))) AS test_rmse
  FROM final GROUP BY algorithm
)"""
SEARCH_CLOSED_FORM = f"""{_SEARCHED}
SELECT algorithm, 1 AS candidate, round(best_score, 3) AS best_score,
       best_score = (SELECT max(best_score) FROM searched) AS is_best,
       {", ".join(f"round(test_{m}, 3) AS test_{m}" for m in ("r2", "mae", "mse", "rmse"))}
FROM searched JOIN tested USING (algorithm)"""
SEARCH_CLOSED_FORM_MAE = SEARCH_CLOSED_FORM.replace("-avg((y - f) * (y - f)) AS score", "-avg(abs(y - f)) AS score")
TRACKED_RUNS = f"""{_SEARCHED}
SELECT algorithm, 'cv' AS kind, 'mean_test_mse' AS metric, round(best_score, 3) AS value FROM searched
UNION ALL SELECT algorithm, 'cv', 'rank_test_score', 1 FROM searched
{" ".join(f"UNION ALL SELECT algorithm, 'final', 'test_{m}_score', round(test_{m}, 3) FROM tested" for m in ("r2", "mae", "mse", "rmse"))}"""


DRAWN = {
    "logistic_regression": {"C": (0.5, 2.0)},
    "random_forest": {"n_estimators": (3, 9), "max_depth": (2, 4), "min_samples_leaf": (1, 1)},
    "xgb": {"n_estimators": (2, 4), "max_depth": (1, 2), "min_child_weight": (1.0, 5.0), "learning_rate": (0.01, 0.2)},
}


def drawn_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many candidates per algorithm as there are order priorities: their number, ranges and repeatability."""
    n_iter = table(spark, sf_dir, "orders").select("o_orderpriority").distinct().count()
    algorithms = [AlgoSpec(name, ranges) for name, ranges in DRAWN.items()]
    draws = [candidate_table(spark, draw_candidates(algorithms, TWO_CLASS, n_iter, SEED)) for _ in range(2)]
    each = [d.select("algorithm", "candidate", F.explode("params").alias("parameter", "text")) for d in draws]
    rows = [(a, p, float(low), float(high)) for a, ranges in DRAWN.items() for p, (low, high) in ranges.items()]
    limits = spark.createDataFrame(rows, "algorithm string, parameter string, low double, high double")
    again = each[1].withColumnRenamed("text", "again")
    value = F.col("text").cast("double")
    return (
        each[0].join(limits, ["algorithm", "parameter"]).join(again, ["algorithm", "candidate", "parameter"])
        .groupBy("algorithm", "parameter")
        .agg(F.count("*").alias("n_drawn"), F.every(value.between(F.col("low"), F.col("high"))).alias("in_range"),
             F.every(F.col("text") == F.col("again")).alias("repeated"))
    )


DRAWN_CANDIDATES = "SELECT algorithm, parameter, count(DISTINCT o_orderpriority) AS n_drawn, true AS in_range, true AS repeated FROM orders, (VALUES " + ", ".join(
    f"('{a}', '{p}')" for a, ranges in DRAWN.items() for p in ranges
) + ") AS d(algorithm, parameter) GROUP BY algorithm, parameter"

CLASS_RATES = ("accuracy", "f1", "precision", "recall", "roc_auc")


def _shares_search(metric: str) -> Callable[[SparkSession, str], DataFrame]:
    """Class shares per priority and one split of priorities: both have a closed form, for every metric of classes."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_orderpriority", (F.col("o_orderstatus") == "F").cast("int").alias("finished")
        )
        algorithms = [
            AlgoSpec("logistic_regression", {"C": (1e6, 1e6)}),
            AlgoSpec("decision_tree", {"max_depth": (1, 1), "min_samples_leaf": (1, 1)}),
        ]
        features = [FeatureSpec("o_orderpriority", DUMMY, MOST_FREQUENT)]
        spec = TrainSpec(
            "finished", "finished", TWO_CLASS, features, algorithms, metric, seed=SEED, n_iter=1, class_weights=False, key=["o_orderkey"]
        )
        board = train(orders, spec).leaderboard
        rates = [F.round(F.col("test_metrics")[f"test_{m}"], 6).alias(f"test_{m}") for m in CLASS_RATES]
        return board.select("algorithm", "candidate", F.round("best_score", 6).alias("best_score"), "is_best", *rates)

    return query


def _shares_applied(name: str, learn: str, apply: str) -> str:
    """CTE ``<name>``: metrics per algorithm on the rows where ``apply``, learned where ``learn``."""
    return f"""
{name}_n AS (SELECT c, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS s FROM finished WHERE {learn} GROUP BY c),
{name}_split AS (
  SELECT c, s / n AS inside, (ts - s) / (tn - n) AS outside FROM {name}_n, (SELECT sum(n) AS tn, sum(s) AS ts FROM {name}_n)
  ORDER BY s * s / n + (ts - s) * (ts - s) / (tn - n) DESC LIMIT 1
),
{name}_rows AS (
  SELECT 'logistic_regression' AS algorithm, y, s / n AS p FROM finished JOIN {name}_n USING (c) WHERE {apply}
  UNION ALL
  SELECT 'decision_tree', y, CASE WHEN f.c = b.c THEN inside ELSE outside END FROM finished f, {name}_split b WHERE {apply}
),
{name}_ranked AS (
  SELECT algorithm, y, CASE WHEN p > 1 - p THEN 1 ELSE 0 END AS q,
         rank() OVER (PARTITION BY algorithm ORDER BY p) + (count(*) OVER (PARTITION BY algorithm, p) - 1) / CAST(2 AS DOUBLE) AS r
  FROM {name}_rows
),
{name}_sums AS (
  SELECT algorithm, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS actual, CAST(sum(q) AS DOUBLE) AS predicted,
         CAST(sum(q * y) AS DOUBLE) AS tp, CAST(sum(CASE WHEN q = y THEN 1 ELSE 0 END) AS DOUBLE) AS same, sum(r * y) AS ranks
  FROM {name}_ranked GROUP BY algorithm
),
{name} AS (
  SELECT algorithm, same / n AS accuracy, CASE WHEN actual + predicted > 0 THEN 2 * tp / (actual + predicted) ELSE 0 END AS f1,
         CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision, CASE WHEN actual > 0 THEN tp / actual ELSE 0 END AS recall,
         (ranks - actual * (actual + 1) / 2) / (actual * (n - actual)) AS roc_auc
  FROM {name}_sums
)"""


# rows of a class in the order of their hash, in three runs; the test side has no fold
_STRATIFIED = f"""
hashed AS (
  SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS finished,
         {sql_unit(["o_orderkey"], SEED)} < {RATIO} AS in_train, md5(concat_ws(':', o_orderkey, '{SEED}', 'fold')) AS digest
  FROM orders
),
dealt AS (
  SELECT *, row_number() OVER (PARTITION BY in_train, finished ORDER BY digest) - 1 AS place, count(*) OVER (PARTITION BY in_train, finished) AS n
  FROM hashed
),
stratified AS (
  SELECT *, CASE WHEN in_train THEN CASE WHEN place >= 2 * n // 3 THEN 2 WHEN place >= n // 3 THEN 1 ELSE 0 END ELSE -1 END AS fold FROM dealt
)"""


def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per class and fold of the table that a search reads."""
    orders = status_orders(spark, sf_dir)
    split = split_table(orders, logistic_spec("finished", TWO_CLASS, False), f"{work_folder(spark)}/split", stratified=True)
    return split.labelled.groupBy("finished", F.col("split_side").alias("side"), F.col("split_fold").alias("fold")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )


STRATIFIED_FOLDS = f"""
WITH {_STRATIFIED}
SELECT finished, CASE WHEN in_train THEN 'train' ELSE 'test' END AS side, fold, count(*) AS n_rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM stratified GROUP BY 1, 2, 3"""


def bin_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut points of a feature with many values: how many, and whether each has the rank it stands for to 1/1024."""
    lines = table(spark, sf_dir, "lineitem").select(F.array("l_extendedprice").alias("x"), F.xxhash64(*LINE_KEY).alias("key"), "l_extendedprice")
    rows = lines.select(array_to_vector("x").alias("x"), F.lit(0.0).alias("y"), "key")
    blocks = blocks_of(rows, "x", "y", None, "key", 1)
    cuts = cut_points(blocks, [0], 256)[0].tolist()
    n = blocks.rows
    blocks.release()
    below = [F.count(F.when(F.col("l_extendedprice") <= c, 1)) for c in cuts]
    ranks = lines.agg(F.array(*below).alias("ranks"))
    off = F.transform("ranks", lambda r, i: F.abs(r / n - (i + 1) / 256))
    return ranks.select(F.size("ranks").alias("n_cuts"), (F.array_max(off) <= 1 / 1024).alias("exact_enough"), F.lit(n).cast("long").alias("n_rows"))


BIN_EDGES = "SELECT 255 AS n_cuts, true AS exact_enough, count(*) AS n_rows FROM lineitem"


def _shares_search_sql(metric: str) -> str:
    folds = " UNION ALL ".join(f"SELECT algorithm, {metric} AS score FROM fold{f}" for f in range(3))
    key = ["o_orderkey"]
    return f"""
WITH {_STRATIFIED},
finished AS (SELECT o_orderpriority AS c, finished AS y, in_train, fold FROM stratified),
{",".join(_shares_applied(f"fold{f}", f"in_train AND fold <> {f}", f"in_train AND fold = {f}") for f in range(3))},
{_shares_applied("final", "in_train", "NOT in_train")},
searched AS (SELECT algorithm, avg(score) AS best_score FROM ({folds}) GROUP BY algorithm)
SELECT algorithm, 1 AS candidate, round(best_score, 6) AS best_score,
       algorithm = (SELECT algorithm FROM searched ORDER BY best_score DESC, algorithm LIMIT 1) AS is_best,
       {", ".join(f"round({m}, 6) AS test_{m}" for m in CLASS_RATES)}
FROM searched JOIN final USING (algorithm)"""


# The metrics of classes, as a user names them.
_CLASS_SEARCHES = {
    f"search_class_shares_{key}": (_shares_search(name), _shares_search_sql(key))
    for name, key in (("ROC AUC", "roc_auc"), ("Accuracy", "accuracy"), ("F1 Score", "f1"), ("Precision", "precision"), ("Recall", "recall"))
}


def _board(leaderboard: DataFrame) -> DataFrame:
    return leaderboard.select(
        "algorithm", "candidate", F.round("best_score", 4).alias("best_score"), "is_best",
        F.transform_values("test_metrics", lambda _, v: F.round(v, 4)).cast("string").alias("test_metrics"),
    )


# ------------------------------------------------------------------ register, load, score


def _registered(spark: SparkSession, df: DataFrame, spec: TrainSpec, algorithm: str, params: dict) -> tuple[Registry, str]:
    """Train, save and register one model on the train side of the split."""
    model, _ = fit_on_split(df, spec, algorithm, params)
    registry = Registry(spark, f"{work_folder(spark)}/registry")
    name = registry.register(model, spec.model_name, "CATALOG", "v1", "run1", model.signature(df), {}, spec.threshold)
    return registry, name


def score_two_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered, reloaded model over the whole table: probabilities and the threshold's prediction."""
    orders = status_orders(spark, sf_dir)
    registry, name = _registered(spark, orders, logistic_spec("finished", TWO_CLASS, True), "logistic_regression", {"C": 1e6})
    scored = score(orders.select("o_orderkey", "o_orderpriority"), registry, name)
    return rounded(scored, "PREDICT_PROBA_0", "PREDICT_PROBA_1", digits=3)


SCORE_TWO_CLASS = f"""{_two_class_sql(True)}
SELECT o_orderkey, o_orderpriority, round(1 - p, 3) AS "PREDICT_PROBA_0", round(p, 3) AS "PREDICT_PROBA_1",
       CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS "PREDICTION"
FROM status_orders JOIN shares USING (o_orderpriority)"""


def score_stream_two_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same model over the table read as a stream."""
    orders = status_orders(spark, sf_dir)
    registry, name = _registered(spark, orders, logistic_spec("finished", TWO_CLASS, True), "logistic_regression", {"C": 1e6})
    raw = table(spark, sf_dir, "orders")
    stream = spark.readStream.schema(raw.schema).parquet(f"{sf_dir}/orders[.]parquet").select("o_orderkey", "o_orderpriority")
    folder = work_folder(spark)
    score_stream(stream, registry, name, f"{folder}/scored", f"{folder}/state").awaitTermination()
    return rounded(spark.read.parquet(f"{folder}/scored"), "PREDICT_PROBA_0", "PREDICT_PROBA_1", digits=3)


def scored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table that scoring writes, and the train and test tables that training writes, read back by name."""
    lines = squared_lines(spark, sf_dir)
    folder = work_folder(spark)
    registry = Registry(spark, f"{folder}/registry")
    result = train(lines, closed_form_spec(), folder, registry, "CATALOG", f"{folder}/train_rows", f"{folder}/test_rows")
    score(lines, registry, result.registered, output=f"{folder}/scored")
    sides = [spark.read.parquet(f"{folder}/{side}_rows").select(*lines.columns, F.lit(side).alias("side")) for side in ("train", "test")]
    scored = spark.read.parquet(f"{folder}/scored").select(*LINE_KEY, "PREDICTION")
    return rounded(sides[0].unionByName(sides[1]).join(scored, LINE_KEY).select(*LINE_KEY, "side", "PREDICTION"), "PREDICTION", digits=3)


def _scored_table_sql() -> str:
    return f"""{_SEARCHED.replace("SELECT l_quantity AS x", f"SELECT {LINE_KEY_SQL}, l_quantity AS x")},
best AS (SELECT algorithm FROM searched ORDER BY best_score DESC LIMIT 1)
SELECT {LINE_KEY_SQL}, CASE WHEN in_train THEN 'train' ELSE 'test' END AS side,
       round(CASE WHEN (SELECT algorithm FROM best) = 'lasso' THEN b0 + b * (x - m) / s ELSE CASE WHEN x <= cut THEN below ELSE above END END, 3) + 0 AS "PREDICTION"
FROM lines, final_split, ({_lasso_fit_sql("(SELECT * FROM lines WHERE in_train)", 20.0)})"""


def score_multi_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = status_orders(spark, sf_dir)
    registry, name = _registered(spark, orders, logistic_spec("status", MULTI_CLASS, False), "logistic_regression", {"C": 1e6})
    scored = score(orders.select("o_orderkey", "o_orderpriority"), registry, name, "v1")
    return rounded(scored, "PREDICT_PROBA_1", "PREDICT_PROBA_2", "PREDICT_PROBA_5", digits=3)


SCORE_MULTI_CLASS = f"""{_STATUS_SHARES}
SELECT o_orderkey, o_orderpriority, round(p1, 3) AS "PREDICT_PROBA_1", round(p2, 3) AS "PREDICT_PROBA_2",
       round(p5, 3) AS "PREDICT_PROBA_5", {_STATUS_PREDICTION} AS "PREDICTION"
FROM status_orders JOIN shares USING (o_orderpriority)"""


def score_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = revenue_lines(spark, sf_dir)
    registry, name = _registered(spark, lines, lasso_spec(500.0), "lasso", {"alpha": 500.0})
    return rounded(score(lines.drop("revenue"), registry, name), "PREDICTION", digits=2)


SCORE_REGRESSION = f"""
WITH {REVENUE_LINES}, fit AS ({_lasso_fit_sql("(SELECT * FROM lines WHERE in_train)", 500.0)})
SELECT {LINE_KEY_SQL}, x AS l_extendedprice, round(b0 + b * (x - m) / s, 2) AS "PREDICTION" FROM lines, fit"""

QUERIES = {
    "quality_of_documents": (quality_of_documents, None),
    "train_logistic_regression": (train_logistic_regression, _two_class_groups(False)),
    "train_logistic_regression_weighted": (train_logistic_regression_weighted, _two_class_groups(True)),
    "train_logistic_regression_multi": (train_logistic_regression_multi, LOGISTIC_MULTI),
    "train_lasso": (train_lasso, LASSO),
    "cross_validated_lasso": (cross_validated_lasso, CV_LASSO),
    "train_random_forest": (_learned("large", TWO_CLASS, "random_forest", FOREST), LARGE),
    "train_xgb": (_learned("large", TWO_CLASS, "xgb", BOOSTED), LARGE),
    "train_lgbm": (_learned("large", TWO_CLASS, "lgbm", BOOSTED), LARGE),
    "train_gradient_boosting": (_learned("large", TWO_CLASS, "gradient_boosting", GRADIENT), LARGE),
    "train_decision_tree": (_learned("large", TWO_CLASS, "decision_tree", TREE), LARGE),
    "train_random_forest_multi": (_learned("band", MULTI_CLASS, "random_forest", FOREST), BAND),
    "train_xgb_multi": (_learned("band", MULTI_CLASS, "xgb", BOOSTED), BAND),
    "train_decision_tree_multi": (_learned("band", MULTI_CLASS, "decision_tree", TREE), BAND),
    "train_random_forest_regression": (_learned("level", REGRESSION, "random_forest", FOREST), LEVEL),
    "train_xgb_regression": (_learned("level", REGRESSION, "xgb", BOOSTED), _shrunk_level(1)),
    "train_lgbm_regression": (_learned("level", REGRESSION, "lgbm", BOOSTED), _shrunk_level(0)),
    "train_gradient_boosting_regression": (_learned("level", REGRESSION, "gradient_boosting", GRADIENT), LEVEL),
    "train_decision_tree_regression": (_learned("level", REGRESSION, "decision_tree", TREE), LEVEL),
    "one_split_decision_tree": (_stump("dear", TWO_CLASS, "decision_tree", ONE_SPLIT), _stump_sql(_DEAR)),
    **_CLASS_SEARCHES,
    "stratified_folds": (stratified_folds, STRATIFIED_FOLDS),
    "bin_edges": (bin_edges, BIN_EDGES),
    "search_closed_form_mae": (lambda spark, sf_dir: search_closed_form(spark, sf_dir, "MAE"), SEARCH_CLOSED_FORM_MAE),
    "drawn_candidates": (drawn_candidates, DRAWN_CANDIDATES),
    "scored_table": (scored_table, _scored_table_sql()),
    "features_with_reserved_names": (features_with_reserved_names, _stump_sql(_DEAR)),
    "one_split_decision_tree_regression": (_stump("revenue", REGRESSION, "decision_tree", ONE_SPLIT), _stump_sql(_REVENUE)),
    "two_rounds_gradient_boosting_regression": (
        _stump("revenue", REGRESSION, "gradient_boosting", TWO_ROUNDS),
        _two_rounds_sql(_REVENUE, 0.5),
    ),
    "two_rounds_xgb_regression": (_stump("revenue", REGRESSION, "xgb", TWO_ROUNDS), _second_order_sql(_REVENUE, 0.5, 1, 1)),
    "two_rounds_lgbm_regression": (_stump("revenue", REGRESSION, "lgbm", TWO_ROUNDS), _second_order_sql(_REVENUE, 0.5, 0, 20)),
    "search_closed_form": (search_closed_form, SEARCH_CLOSED_FORM),
    "search_two_class": (search_two_class, None),
    "search_multi_class": (search_multi_class, None),
    "search_regression": (search_regression, None),
    "score_two_class": (score_two_class, SCORE_TWO_CLASS),
    "score_stream_two_class": (score_stream_two_class, SCORE_TWO_CLASS),
    "score_multi_class": (score_multi_class, SCORE_MULTI_CLASS),
    "score_regression": (score_regression, SCORE_REGRESSION),
}
