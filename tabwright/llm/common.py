"""Pieces that several operators share: tables, folders all executors see, ordered shares."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.session import checkpoint_dir
from tabwright.sources.tables import read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder on the storage that all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lost executors cost nothing that lies behind it."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def unused(df_columns: list[str], name: str) -> str:
    """``name``, or with underscores before it if a column has it (Spark ignores case)."""
    taken = {c.lower() for c in df_columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def bounds_of(df: DataFrame, column: str, parts: int) -> list[int]:
    """Rising cut values that share the rows of a whole-number column among at most ``parts`` ranges.

    At most ``parts`` numbers come to the driver.
    """
    if parts < 2:
        return []
    at = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(column, at, 10_000).alias("q")).first()["q"]
    return sorted(set(found or []))


def range_of(value: Column, bounds: list[int]) -> Column:
    """How many of the rising ``bounds`` are at or below ``value``: two short scans, not one long."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    heads, all_bounds = F.lit(bounds[::step]), F.lit(bounds)
    block = F.greatest(F.size(F.filter(heads, lambda b: b <= value)) - 1, F.lit(0))
    within = F.size(F.filter(F.slice(all_bounds, block * step + 1, F.lit(step)), lambda b: b <= value))
    return F.when(value.isNull(), F.lit(0)).otherwise(block * step + within).cast("int")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once however often the body uses it, inside lambdas too."""
    return F.transform(F.array(value), body)[0]


def give_back() -> None:
    """Hand memory that a task has freed back to the system: the worker lives on and serves other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def map_batches(df: DataFrame, function: Callable, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow``, with this package on the workers' path where they share the driver's disk.

    On a cluster without a common installation ship it with ``--py-files``.
    """
    environment = df.sparkSession.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return df.mapInArrow(function, schema)
