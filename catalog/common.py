"""Shared pieces of the queries and of their SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.session import checkpoint_dir
from tabwright.sources.tables import read_table

SEED = 42
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """A new folder on the storage that the session's checkpoints use."""
    return f"{checkpoint_dir(spark).rstrip('/')}/work-{uuid.uuid4().hex}"


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    # adding zero turns a rounded -0.0 into 0.0
    return df.withColumns({n: F.round(n, digits) + F.lit(0.0) for n in names})


def sql_unit(keys: list[str], *salt: object) -> str:
    """The row hash in [0, 1) in SQL."""
    parts = ", ".join([*keys, *[f"'{s}'" for s in salt]])
    return f"(CAST(('0x' || substr(md5(concat_ws(':', {parts})), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE))"


def sql_fold(keys: list[str], k: int = 3) -> str:
    return f"CAST(floor({sql_unit(keys, SEED, 'fold')} * {k}) AS INTEGER)"


LINE_KEY_SQL = ", ".join(LINE_KEY)
