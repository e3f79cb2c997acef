"""Registry records at table size: versions, default pointers, removals and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.common import table, work_folder
from catalog.models import SEARCH_CLOSED_FORM, TRACKED_RUNS, closed_form_spec, fit_on_split, logistic_spec, squared_lines, status_orders
from tabwright.operators.metrics import TWO_CLASS
from tabwright.plans.registry import (
    MODEL_ID_TAG,
    PARENT_MODEL,
    PROJECT_TAG,
    Registry,
    current_versions,
    default_versions,
    stale_entries,
)
from tabwright.plans.tracking import Tracker
from tabwright.plans.train import train


def default_pointer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event sets a default: users as models, events as versions."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("model_name"), F.col("event_id").cast("string").alias("version"), F.col("ts").alias("set_at")
    )
    return default_versions(events)


DEFAULT_POINTER = """
SELECT CAST(user_id AS VARCHAR) AS model_name, arg_max(CAST(event_id AS VARCHAR), (ts, CAST(event_id AS VARCHAR))) AS version
FROM events GROUP BY user_id"""


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as models, orders as their versions, order status as project; urgent orders carry no tags."""
    customer = F.col("o_custkey").cast("string")
    tags = F.create_map(F.lit(PROJECT_TAG), F.col("o_orderstatus"), F.lit(MODEL_ID_TAG), customer)
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), customer).alias("model_name"),
        F.concat(F.lit("V"), F.col("o_orderkey").cast("string")).alias("version"),
        F.when(F.col("o_orderpriority") != "1-URGENT", tags).alias("tags"),
        F.col("o_orderdate").alias("created_at"),
        "o_custkey",
        "o_orderpriority",
    )


def surviving_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removals: low-priority orders two days on, and all orders of machinery customers before 1996."""
    versions = order_versions(spark, sf_dir)
    single = versions.where(F.col("o_orderpriority") == "5-LOW").select(
        "model_name", "version", (F.col("created_at") + F.expr("INTERVAL 2 DAYS")).alias("removed_at")
    )
    whole = (
        table(spark, sf_dir, "customer")
        .where(F.col("c_mktsegment") == "MACHINERY")
        .select(
            F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("model_name"),
            F.lit(PARENT_MODEL).alias("version"),
            F.expr("TIMESTAMP_NTZ '1996-01-01 00:00:00'").alias("removed_at"),
        )
    )
    kept = current_versions(versions, single.unionByName(whole))
    return kept.select("model_name", "version", "created_at")


SURVIVING = """
SELECT 'C' || o_custkey AS model_name, 'V' || o_orderkey AS version, o_orderdate AS created_at
FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'MACHINERY'
WHERE o_orderpriority <> '5-LOW' AND (c_custkey IS NULL OR o_orderdate > TIMESTAMP '1996-01-01 00:00:00')"""


def registry_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live are customers with a positive balance, and of theirs the orders above 100,000."""
    versions = order_versions(spark, sf_dir)
    rich = table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, sf_dir, "orders").where(F.col("o_totalprice") > 100000)
    live = rich.join(orders.select("o_custkey", "o_orderkey"), "o_custkey", "left").select(
        F.col("o_custkey").cast("string").alias("model_id"),
        F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("version"),
    )
    return stale_entries(versions, live, "F")


CLEANUP = f"""
WITH tagged AS (
  SELECT o_custkey, 'C' || o_custkey AS name, 'V' || o_orderkey AS version, o_totalprice FROM orders
  WHERE o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT'
),
live AS (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
SELECT DISTINCT name, '{PARENT_MODEL}' AS version FROM tagged WHERE o_custkey NOT IN (SELECT c_custkey FROM live)
UNION ALL
SELECT name, version FROM tagged WHERE o_custkey IN (SELECT c_custkey FROM live) AND NOT o_totalprice > 100000"""


def tracked_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs and metrics that a training wrote, read back and joined; times are left out."""
    folder = work_folder(spark)
    train(squared_lines(spark, sf_dir), closed_form_spec(), folder)
    tracker = Tracker(spark, f"{folder}/tracking")
    metrics = tracker.metrics().where(~F.col("key").isin("mean_fit_time", "whole_dataset_refit_time"))
    return (
        tracker.runs()
        .join(metrics, "run_id")
        .select("algorithm", "kind", F.col("key").alias("metric"), F.round("value", 3).alias("value"))
    )


def cleaned_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register a model twice, remove what the orders say is gone, and read back what is left.

    Live is the version whose order status has more orders; the listing, the versions left and
    whether their files are still there are read from the registry.
    """
    orders = status_orders(spark, sf_dir)
    model, _ = fit_on_split(orders, logistic_spec("finished", TWO_CLASS, True), "logistic_regression", {"C": 1e6})
    registry = Registry(spark, f"{work_folder(spark)}/registry")
    for version in ("F", "O"):
        registry.register(model, "status", "CATALOG", version, "run", "{}", {})
    versions = registry.versions()
    model_id = versions.first()["tags"][MODEL_ID_TAG]
    counts = table(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin("F", "O")).groupBy("o_orderstatus").count()
    most = counts.orderBy(F.desc("count"), "o_orderstatus").limit(1)
    live = most.select(F.lit(model_id).alias("model_id"), F.lower("o_orderstatus").alias("version"))
    before = {r["version"]: r["path"] for r in versions.select("version", "path").collect()}
    removed = registry.cleanup(live, "CATALOG", perform_deletion=True).select("version", F.lit("removed").alias("state"))
    left = registry.versions().select("version", F.lit("left").alias("state"))
    rows = [(r["version"], r["state"], _has_files(spark, before[r["version"]])) for r in removed.unionByName(left).collect()]
    return spark.createDataFrame(rows, "version string, state string, has_files boolean")


def _has_files(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


CLEANED_REGISTRY = """
WITH n AS (
  SELECT o_orderstatus AS version, row_number() OVER (ORDER BY count(*) DESC, o_orderstatus) AS place
  FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY o_orderstatus
)
SELECT version, CASE WHEN place = 1 THEN 'left' ELSE 'removed' END AS state, place = 1 AS has_files FROM n"""


def registered_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a closed-form training registers, read back: signature, metrics, tags, classes, run parameters."""
    folder = work_folder(spark)
    registry = Registry(spark, f"{folder}/registry")
    train(squared_lines(spark, sf_dir), closed_form_spec(), folder, registry, "CATALOG")
    fields = "struct<inputs:struct<fields:array<struct<name:string,type:string>>>,outputs:struct<fields:array<struct<name:string,type:string>>>>"
    row = registry.versions().withColumn("s", F.from_json("signature", fields))
    names = lambda side: F.array_join(F.transform(f"s.{side}.fields", lambda f: F.concat_ws(":", f["name"], f["type"])), ",")
    params = Tracker(spark, f"{folder}/tracking").params().where(F.col("key").isin("alpha", "max_depth", "min_samples_leaf"))
    chosen = params.groupBy("run_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "key", F.round(F.col("value").cast("double")).cast("int")))), ",").alias("params")
    )
    return row.join(chosen, "run_id").select(
        "model_name", "algorithm", "target", F.size("classes").alias("n_classes"), names("inputs").alias("inputs"), names("outputs").alias("outputs"),
        F.col("tags")[PROJECT_TAG].alias("project"), F.round(F.col("metrics")["test_mse"], 3).alias("test_mse"), "params",
    )


REGISTERED_RECORD = f"""
SELECT 'CATALOG_amount' AS model_name, algorithm, 'amount' AS target, 0 AS n_classes, 'l_quantity:double' AS inputs,
       'PREDICTION:double' AS outputs, 'CATALOG' AS project, test_mse,
       CASE algorithm WHEN 'lasso' THEN 'alpha=20' ELSE 'max_depth=1,min_samples_leaf=1' END AS params
FROM ({SEARCH_CLOSED_FORM}) WHERE is_best"""


QUERIES = {
    "default_pointer": (default_pointer, DEFAULT_POINTER),
    "surviving_versions": (surviving_versions, SURVIVING),
    "registry_cleanup": (registry_cleanup, CLEANUP),
    "tracked_runs": (tracked_runs, TRACKED_RUNS),
    "cleaned_registry": (cleaned_registry, CLEANED_REGISTRY),
    "registered_record": (registered_record, REGISTERED_RECORD),
}
