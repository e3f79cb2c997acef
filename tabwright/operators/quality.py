"""Checks of the training table, as one aggregate per question."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.hashing import quoted
from tabwright.operators.prep import OWN_PREFIX
from tabwright.sources.tables import is_missing, role_of


def target_report(df: DataFrame, target: str) -> DataFrame:
    """Rows, missing targets, classes, smallest and largest class."""
    name = quoted(target)
    # null and NaN are one missing value
    value = F.when(~is_missing(df, target), F.col(name))
    per_class = df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    present = F.col("value").isNotNull()
    return per_class.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("n_missing"),
        F.count(F.when(present, 1)).alias("n_classes"),
        F.min(F.when(present, F.col("n"))).alias("smallest_class"),
        F.max(F.when(present, F.col("n"))).alias("largest_class"),
    )


def time_report(df: DataFrame, time_column: str) -> DataFrame:
    """Rows, missing times, first and last time."""
    name = quoted(time_column)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col(name).isNull(), 1)).alias("n_missing"),
        F.min(name).alias("first_time"),
        F.max(name).alias("last_time"),
    )


def feature_report(df: DataFrame, features: Sequence[str], exact: bool = False) -> DataFrame:
    """One row per feature: rows, missing values, distinct values, whether it is constant.

    Distinct values are estimated from a bounded sketch per column; ``exact`` counts them from
    one grouped table of (feature, value).
    """
    if exact:
        pairs = F.array(
            *[
                F.struct(F.lit(f).alias("feature"), F.when(~is_missing(df, f), F.col(quoted(f)).cast("string")).alias("value"))
                for f in features
            ]
        )
        return (
            df.select(F.explode(pairs).alias("p"))
            .groupBy("p.feature", "p.value")
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy("feature")
            .agg(
                F.sum("n").alias("n_rows"),
                F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_missing"),
                F.count("value").alias("n_distinct"),
            )
            .withColumn("is_constant", F.col("n_distinct") <= 1)
        )
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.when(is_missing(df, f), 1)).alias(f"m{i}") for i, f in enumerate(features)],
        *[F.approx_count_distinct(F.when(~is_missing(df, f), F.col(quoted(f)))).alias(f"d{i}") for i, f in enumerate(features)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"), F.col("n_rows"), F.col(f"m{i}").alias("n_missing"), F.col(f"d{i}").alias("n_distinct")
            )
            for i, f in enumerate(features)
        ]
    )
    return counts.select(F.explode(rows).alias("r")).select("r.*").withColumn("is_constant", F.col("n_distinct") <= 1)


def check_training_table(
    df: DataFrame, target: str, classification: bool, features: Sequence[str], time_column: str | None = None,
    reserved: Sequence[str] = (),
) -> None:
    """Refuse what training cannot use, from the schema alone.

    ``reserved`` are names of columns that training adds to the table.
    """
    names = set(df.columns)
    taken = [c for c in df.columns if c.lower() in {r.lower() for r in reserved} or c.lower().startswith(OWN_PREFIX)]
    if taken:
        raise ValueError(f"rename {', '.join(taken)}: training uses these names")
    for name in [target, *features, *([time_column] if time_column else [])]:
        if name not in names:
            raise ValueError(f"no column {name!r} in the training table")
    if classification and role_of(df.schema[target].dataType) != "numeric":
        raise ValueError(f"target {target!r} must be numeric for classification")
    if target in features:
        raise ValueError(f"target {target!r} cannot be a feature")
    if time_column and role_of(df.schema[time_column].dataType) != "time":
        raise ValueError(f"{time_column!r} is not a date or timestamp")
