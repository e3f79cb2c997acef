"""Arrow batches through Python functions of this package."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def map_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow``, with this package on the workers' path."""
    on_workers(df.sparkSession)
    return df.mapInArrow(function, schema)


def on_workers(spark: SparkSession) -> None:
    """This package on the workers' path where they share the driver's disk.

    On a cluster without a common installation ship it with ``--py-files``.
    """
    environment = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
