"""Scans, sinks and schema roles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.hashing import quoted


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a table lazily, by catalog name or by path of a parquet folder or file."""
    if "/" in name:
        return spark.read.parquet(name)
    return spark.table(name)


def write_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Write a table with its schema, by catalog name or by path."""
    if "/" in name:
        df.write.mode(mode).parquet(name)
    else:
        df.write.mode(mode).saveAsTable(name)


def resolve_column(df: DataFrame, name: str) -> str:
    """The column's exact name; falls back to a unique match that ignores letter case."""
    if name in df.columns:
        return name
    matches = [c for c in df.columns if c.lower() == name.lower()]
    if len(matches) != 1:
        raise LookupError(f"no column {name!r} in {df.columns}")
    return matches[0]


def column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[resolve_column(df, name)].dataType


def role_of(dtype: T.DataType) -> str:
    """``numeric``, ``categorical``, ``time`` or ``unusable``, from the Spark type alone."""
    if isinstance(dtype, T.NumericType):
        return "numeric"
    if isinstance(dtype, (T.StringType, T.BooleanType)):
        return "categorical"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "time"
    return "unusable"


# Names of the feature treatments a user chooses from.
STANDARD, MIN_MAX, NO_RESCALING = "Standard rescaling", "Min-max rescaling", "No rescaling"
DUMMY, ORDINAL = "Dummy encoding", "Ordinal encoding"
AVERAGE, MEDIAN, MOST_FREQUENT, CONSTANT = "Average", "Median", "Most frequent value", "Constant"


def default_encoding(dtype: T.DataType) -> str:
    return STANDARD if role_of(dtype) == "numeric" else DUMMY


def default_imputation(dtype: T.DataType) -> str:
    return MEDIAN if role_of(dtype) == "numeric" else MOST_FREQUENT


def is_missing(df: DataFrame, name: str) -> F.Column:
    """Null, or NaN for floating point columns."""
    column = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def column_report(df: DataFrame) -> DataFrame:
    """One row per column: type, role, default treatment, rows and missing values.

    The counts of all columns come from one aggregate; it is turned on its side afterwards.
    """
    fields = df.schema.fields
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.when(is_missing(df, f.name), 1)).alias(f"m{i}") for i, f in enumerate(fields)],
    )
    described = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.lit(role_of(f.dataType)).alias("role"),
                F.lit(default_encoding(f.dataType)).alias("default_encoding"),
                F.lit(default_imputation(f.dataType)).alias("default_imputation"),
                F.col("n_rows"),
                F.col(f"m{i}").alias("n_missing"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counts.select(F.explode(described).alias("c")).select("c.*")
