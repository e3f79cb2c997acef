"""Class counts and balanced class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.hashing import quoted
from tabwright.session import cut_lineage
from tabwright.sources.tables import is_missing

WEIGHT_COLUMN = "SAMPLE_WEIGHTS"
BROADCAST_CLASSES = 100_000


def class_counts(df: DataFrame, target: str) -> DataFrame:
    """Rows per target value, missing values included; combined map-side before the shuffle."""
    return df.groupBy(F.col(quoted(target))).agg(F.count(F.lit(1)).alias("n_rows"))


def class_values(df: DataFrame, target: str) -> DataFrame:
    """The distinct values of the target; a missing value counts as one."""
    return df.select(F.col(quoted(target))).distinct()


def class_list(df: DataFrame, target: str, max_classes: int | None = None) -> list:
    """Sorted target values on the driver, one per class; more than ``max_classes`` are refused if that is set."""
    values = class_values(df.where(~is_missing(df, target)), target)
    rows = values.collect() if max_classes is None else values.take(max_classes + 1)
    if max_classes is not None and len(rows) > max_classes:
        raise ValueError(f"target {target!r} has more than {max_classes} values; use regression")
    return sorted(row[0] for row in rows)


def with_class_weights(df: DataFrame, target: str, weights_from: DataFrame | None = None) -> DataFrame:
    """Add ``SAMPLE_WEIGHTS`` = rows / (classes x rows of the class).

    Weights are computed over all rows of ``weights_from`` (default: ``df`` itself). Rows with
    a missing target (null or NaN) are no class and get a null weight.
    """
    source = df if weights_from is None else weights_from
    # written once, so the join does not scan the source again and no cache is left behind
    counts = cut_lineage(class_counts(source.where(~is_missing(source, target)), target))
    totals = counts.agg(F.count(F.lit(1)).alias("k"), F.sum("n_rows").alias("n")).first()
    return join_class_weights(df, target, counts, totals["k"], totals["n"] or 0)


def join_class_weights(df: DataFrame, target: str, counts: DataFrame, n_classes: int, n_rows: int) -> DataFrame:
    """Add the weights that follow from counted classes; small class tables are broadcast."""
    if WEIGHT_COLUMN.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"rename the column {WEIGHT_COLUMN}: class weights take that name")
    weights = counts.select(
        F.col(quoted(target)),
        (F.lit(float(n_rows)) / (F.lit(float(n_classes)) * F.col("n_rows"))).alias(WEIGHT_COLUMN),
    )
    if n_classes <= BROADCAST_CLASSES:
        weights = F.broadcast(weights)
    return df.join(weights, [target], "left").select(*[quoted(c) for c in df.columns], WEIGHT_COLUMN)
