"""Metrics, rankings of candidates, and predictions from scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.common import rounded, table
from tabwright.operators.metrics import (
    binary_auc,
    binary_metrics,
    confusion,
    macro_metrics,
    one_vs_one_auc,
    regression_metrics,
)
from tabwright.operators.scoring import with_class_predictions
from tabwright.operators.search import best_algorithm, best_candidates, cv_results

RATES = ("accuracy", "f1", "precision", "recall")


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a label (expensive or not) and a score that knows nothing of it."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        (F.col("o_totalprice") > 250000).cast("int").alias("y"),
        ((F.col("o_custkey") % 100).cast("double") / 100).alias("p"),
    )


SCORED_ORDERS = """
scored AS (
  SELECT o_orderkey, o_orderpriority, CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS y,
         CAST(o_custkey % 100 AS DOUBLE) / 100 AS p
  FROM orders
)"""


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with three classes, a prediction and a score per class."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        (F.floor("value") % 3).cast("int").alias("y"),
        (F.col("event_id") % 3).cast("int").alias("prediction"),
        F.array(*[(F.col("event_id") % m).cast("double") / m for m in (7, 11, 13)]).alias("scores"),
    )


SCORED_EVENTS = """
scored AS (
  SELECT event_id, CAST(floor(value) AS BIGINT) % 3 AS y, event_id % 3 AS prediction,
         CAST(event_id % 7 AS DOUBLE) / 7 AS p0, CAST(event_id % 11 AS DOUBLE) / 11 AS p1, CAST(event_id % 13 AS DOUBLE) / 13 AS p2
  FROM events
)"""


def confusion_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion(scored_events(spark, sf_dir), "y", "prediction")


CONFUSION = f"""
WITH {SCORED_EVENTS}
SELECT CAST(y AS INTEGER) AS label, CAST(prediction AS INTEGER) AS prediction, count(*) AS n_rows FROM scored GROUP BY y, prediction"""


def metrics_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All binary metrics per order priority: each priority stands for a candidate."""
    scored = scored_orders(spark, sf_dir).withColumn("prediction", (F.col("p") > 0.6).cast("int"))
    return rounded(binary_metrics(scored, "y", "prediction", 1, ["o_orderpriority"]), *RATES)


METRICS_BINARY = f"""
WITH {SCORED_ORDERS},
counts AS (
  SELECT o_orderpriority, count(*) AS n, count(*) FILTER (WHERE y = 1 AND p > 0.6) AS tp,
         count(*) FILTER (WHERE y = 0 AND p > 0.6) AS fp, count(*) FILTER (WHERE y = 1 AND p <= 0.6) AS fn
  FROM scored GROUP BY o_orderpriority
)
SELECT o_orderpriority, n AS n_rows, round((n - fp - fn) / CAST(n AS DOUBLE), 6) AS accuracy,
       round(2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 6) AS f1, round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision,
       round(tp / CAST(tp + fn AS DOUBLE), 6) AS recall
FROM counts"""


def metrics_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(macro_metrics(scored_events(spark, sf_dir), "y", "prediction"), *RATES)


METRICS_MACRO = f"""
WITH {SCORED_EVENTS},
classes AS (SELECT DISTINCT y AS c FROM scored UNION SELECT DISTINCT prediction FROM scored),
per_class AS (
  SELECT c, (SELECT count(*) FROM scored WHERE y = c AND prediction = c) AS tp,
         (SELECT count(*) FROM scored WHERE y = c) AS actual, (SELECT count(*) FROM scored WHERE prediction = c) AS predicted
  FROM classes
)
SELECT CAST(sum(actual) AS BIGINT) AS n_rows, round(CAST(sum(tp) AS DOUBLE) / CAST(sum(actual) AS DOUBLE), 6) AS accuracy,
       round(avg(CASE WHEN actual + predicted > 0 THEN 2 * tp / CAST(actual + predicted AS DOUBLE) ELSE 0 END), 6) AS f1,
       round(avg(CASE WHEN predicted > 0 THEN tp / CAST(predicted AS DOUBLE) ELSE 0 END), 6) AS precision,
       round(avg(CASE WHEN actual > 0 THEN tp / CAST(actual AS DOUBLE) ELSE 0 END), 6) AS recall
FROM per_class"""


def metrics_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("y"),
        (F.col("l_extendedprice") * F.lit(0.95)).alias("prediction"),
    )
    return rounded(
        regression_metrics(lines, "y", "prediction", ["l_returnflag"]), "r2", "mae", "mse", "rmse", digits=4
    )


METRICS_REGRESSION = """
WITH scored AS (
  SELECT l_returnflag, l_extendedprice * (1 - l_discount) AS y, l_extendedprice * CAST(0.95 AS DOUBLE) AS f FROM lineitem
)
SELECT l_returnflag, count(*) AS n_rows, round(1 - sum((y - f) * (y - f)) / (var_pop(y) * count(*)), 4) AS r2,
       round(avg(abs(y - f)), 4) AS mae, round(avg((y - f) * (y - f)), 4) AS mse, round(sqrt(avg((y - f) * (y - f))), 4) AS rmse
FROM scored GROUP BY l_returnflag"""


def auc_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(binary_auc(scored_orders(spark, sf_dir), "y", F.col("p")), "roc_auc")


_RANKED = """
ranked AS (
  SELECT {by} y, rank() OVER ({part} ORDER BY p) + (count(*) OVER ({part_p}) - 1) / CAST(2 AS DOUBLE) AS r FROM scored
)"""
AUC_BINARY = f"""
WITH {SCORED_ORDERS}, {_RANKED.format(by="", part="", part_p="PARTITION BY p")}
SELECT round((sum(r) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / CAST(2 AS DOUBLE))
       / (count(*) FILTER (WHERE y = 1) * CAST(count(*) FILTER (WHERE y = 0) AS DOUBLE)), 6) AS roc_auc
FROM ranked"""


def auc_by_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One AUC per order priority, all in one pass."""
    return rounded(binary_auc(scored_orders(spark, sf_dir), "y", F.col("p"), ["o_orderpriority"]), "roc_auc")


AUC_BY_CANDIDATE = f"""
WITH {SCORED_ORDERS},
{_RANKED.format(by="o_orderpriority,", part="PARTITION BY o_orderpriority", part_p="PARTITION BY o_orderpriority, p")}
SELECT o_orderpriority, round((sum(r) FILTER (WHERE y = 1)
       - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / CAST(2 AS DOUBLE))
       / (count(*) FILTER (WHERE y = 1) * CAST(count(*) FILTER (WHERE y = 0) AS DOUBLE)), 6) AS roc_auc
FROM ranked GROUP BY o_orderpriority"""


def auc_one_vs_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(one_vs_one_auc(scored_events(spark, sf_dir), "y", F.col("scores"), 3), "roc_auc")


def _ovo_sql() -> str:
    sides = []
    for i, j in [(0, 1), (1, 0), (0, 2), (2, 0), (1, 2), (2, 1)]:
        sides.append(f"""
SELECT (sum(r) FILTER (WHERE y = {i}) - count(*) FILTER (WHERE y = {i}) * (count(*) FILTER (WHERE y = {i}) + 1) / CAST(2 AS DOUBLE))
       / (count(*) FILTER (WHERE y = {i}) * CAST(count(*) FILTER (WHERE y = {j}) AS DOUBLE)) AS auc
FROM (SELECT y, rank() OVER (ORDER BY p{i}) + (count(*) OVER (PARTITION BY p{i}) - 1) / CAST(2 AS DOUBLE) AS r
      FROM scored WHERE y IN ({i}, {j}))""")
    return f"WITH {SCORED_EVENTS}, sides AS (" + "\nUNION ALL".join(sides) + ") SELECT round(avg(auc), 6) AS roc_auc FROM sides"


MANY = 100


def auc_one_vs_one_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundred classes: the work grows with rows times classes, not with pairs of classes."""
    part = F.col("l_partkey").cast("double")
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % MANY).cast("int").alias("y"),
        F.transform(F.sequence(F.lit(0), F.lit(MANY - 1)), lambda i: (part * (i + 3)) % 101).alias("scores"),
    )
    return rounded(one_vs_one_auc(lines, "y", F.col("scores"), MANY), "roc_auc")


AUC_OVO_MANY = f"""
WITH per AS (
  SELECT i, l_suppkey % {MANY} AS y, CAST((l_partkey * (i + 3)) % 101 AS DOUBLE) AS score, count(*) AS n
  FROM lineitem, (SELECT unnest(range({MANY})) AS i) GROUP BY 1, 2, 3
),
own AS (SELECT i, score, n FROM per WHERE i = y),
sizes AS (SELECT i, y, sum(n) AS n FROM per GROUP BY 1, 2),
wins AS (
  SELECT p.i, p.y, sum(p.n * (CASE WHEN o.score > p.score THEN o.n WHEN o.score = p.score THEN o.n / CAST(2 AS DOUBLE) ELSE 0 END)) AS wins
  FROM per p JOIN own o ON p.i = o.i AND p.y <> p.i GROUP BY 1, 2
)
SELECT round(avg(w.wins / (CAST(a.n AS DOUBLE) * b.n)), 6) AS roc_auc
FROM wins w JOIN sizes a ON w.i = a.i AND a.y = w.i JOIN sizes b ON w.i = b.i AND w.y = b.y"""


def threshold_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two classes: strictly above the threshold is the last class; no score, no prediction."""
    scored = scored_orders(spark, sf_dir).withColumn("p", F.expr("nullif(p, 0.99D)"))
    scores = scored.withColumn("scores", F.when(F.col("p").isNotNull(), F.array(1 - F.col("p"), F.col("p"))))
    named = with_class_predictions(scores, "scores", [0, 1], T.IntegerType(), ["o_orderkey"], 0.5)
    return rounded(named, "PREDICT_PROBA_0", "PREDICT_PROBA_1")


THRESHOLD = f"""
WITH {SCORED_ORDERS}
SELECT o_orderkey, round(1 - nullif(p, CAST(0.99 AS DOUBLE)), 6) AS "PREDICT_PROBA_0", nullif(p, CAST(0.99 AS DOUBLE)) AS "PREDICT_PROBA_1",
       CASE WHEN p = CAST(0.99 AS DOUBLE) THEN NULL WHEN p > 0.5 THEN 1 ELSE 0 END AS "PREDICTION"
FROM scored"""


def most_likely_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several classes, named 1, 2 and 5: the one with the largest score, the first of equals."""
    scored = scored_events(spark, sf_dir)
    named = with_class_predictions(scored, "scores", [1, 2, 5], T.LongType(), ["event_id"], None)
    return rounded(named, "PREDICT_PROBA_1", "PREDICT_PROBA_2", "PREDICT_PROBA_5")


MOST_LIKELY = f"""
WITH {SCORED_EVENTS}
SELECT event_id, round(p0, 6) AS "PREDICT_PROBA_1", round(p1, 6) AS "PREDICT_PROBA_2", round(p2, 6) AS "PREDICT_PROBA_5",
       CAST(CASE WHEN p0 >= p1 AND p0 >= p2 THEN 1 WHEN p1 >= p2 THEN 2 ELSE 5 END AS BIGINT) AS "PREDICTION"
FROM scored"""


def line_fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of fold scores: return flags as algorithms, suppliers as candidates, line numbers as folds."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_returnflag").alias("algorithm"), F.col("l_suppkey").alias("candidate"), F.col("l_linenumber").alias("fold"))
        .agg(F.sum("l_quantity").alias("score"), F.count(F.lit(1)).cast("double").alias("fit_seconds"))
    )


LINE_RESULTS = """
fold_scores AS (
  SELECT l_returnflag AS algorithm, l_suppkey AS candidate, l_linenumber AS fold, sum(l_quantity) AS score,
         CAST(count(*) AS DOUBLE) AS fit_seconds
  FROM lineitem GROUP BY 1, 2, 3
),
means AS (
  SELECT algorithm, candidate, avg(score) AS mean_test_score, avg(fit_seconds) AS mean_fit_time FROM fold_scores GROUP BY 1, 2
)"""


def ranked_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cv_results(line_fold_scores(spark, sf_dir)), "mean_test_score", "mean_fit_time")


RANKED_CANDIDATES = f"""
WITH {LINE_RESULTS}
SELECT algorithm, candidate, round(mean_test_score, 6) AS mean_test_score, round(mean_fit_time, 6) AS mean_fit_time,
       CAST(rank() OVER (PARTITION BY algorithm ORDER BY mean_test_score DESC) AS INTEGER) AS rank_test_score
FROM means"""


def best_of_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(best_candidates(cv_results(line_fold_scores(spark, sf_dir))), "best_score")


BEST_OF_EACH = f"""
WITH {LINE_RESULTS}
SELECT algorithm, candidate, round(mean_test_score, 6) AS best_score
FROM (SELECT *, row_number() OVER (PARTITION BY algorithm ORDER BY mean_test_score DESC, candidate) AS place FROM means)
WHERE place = 1"""


def best_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(best_algorithm(best_candidates(cv_results(line_fold_scores(spark, sf_dir)))), "best_score")


BEST_OF_ALL = f"""
WITH {LINE_RESULTS}
SELECT algorithm, candidate, round(mean_test_score, 6) AS best_score
FROM means ORDER BY mean_test_score DESC, algorithm, candidate LIMIT 1"""

QUERIES = {
    "confusion_table": (confusion_table, CONFUSION),
    "metrics_binary": (metrics_binary, METRICS_BINARY),
    "metrics_macro": (metrics_macro, METRICS_MACRO),
    "metrics_regression": (metrics_regression, METRICS_REGRESSION),
    "auc_binary": (auc_binary, AUC_BINARY),
    "auc_by_candidate": (auc_by_candidate, AUC_BY_CANDIDATE),
    "auc_one_vs_one": (auc_one_vs_one, _ovo_sql()),
    "auc_one_vs_one_many": (auc_one_vs_one_many, AUC_OVO_MANY),
    "threshold_predictions": (threshold_predictions, THRESHOLD),
    "most_likely_predictions": (most_likely_predictions, MOST_LIKELY),
    "ranked_candidates": (ranked_candidates, RANKED_CANDIDATES),
    "best_of_each_algorithm": (best_of_each, BEST_OF_EACH),
    "best_of_all": (best_of_all, BEST_OF_ALL),
}
