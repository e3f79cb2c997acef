"""Scoring a table with a registered model."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabwright.plans.registry import Registry
from tabwright.sources.tables import write_table


def score(
    df: DataFrame, registry: Registry, model_name: str, version: str | None = None, output: str | None = None
) -> DataFrame:
    """All input columns plus probabilities and ``PREDICTION``.

    The version asked for becomes the model's default. ``output`` also writes the scored table.
    """
    model, row = registry.load(model_name, version)
    if version is not None:
        registry.set_default(model_name, version)
    scored = model.score(df, row["threshold"])
    if output is not None:
        write_table(scored, output)
    return scored
