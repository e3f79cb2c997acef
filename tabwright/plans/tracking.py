"""Experiment runs in three append-only tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

RUNS = "run_id string, name string, algorithm string, kind string, started_at timestamp"
RUN_PARAMS = "run_id string, key string, value string"
RUN_METRICS = "run_id string, key string, value double"


@dataclass
class Run:
    name: str
    algorithm: str
    kind: str  # "cv" or "final"
    params: dict[str, object]
    metrics: dict[str, float | None]
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    started_at: datetime = field(default_factory=lambda: datetime.now(timezone.utc).replace(tzinfo=None))


class Tracker:
    """Runs, parameters and metrics below one folder. Rows are only ever appended."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def log(self, runs: Sequence[Run]) -> None:
        """Append all runs of a training in one small write per table."""
        self._append("runs", [(r.run_id, r.name, r.algorithm, r.kind, r.started_at) for r in runs], RUNS)
        params = [(r.run_id, k, str(v)) for r in runs for k, v in {"algorithm": r.algorithm, **r.params}.items()]
        self._append("run_params", params, RUN_PARAMS)
        metrics = [(r.run_id, k, None if v is None else float(v)) for r in runs for k, v in r.metrics.items()]
        self._append("run_metrics", metrics, RUN_METRICS)

    def _append(self, table: str, rows: list[tuple], schema: str) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.path}/{table}")

    def runs(self) -> DataFrame:
        return self.spark.read.schema(RUNS).parquet(f"{self.path}/runs")

    def params(self) -> DataFrame:
        return self.spark.read.schema(RUN_PARAMS).parquet(f"{self.path}/run_params")

    def metrics(self) -> DataFrame:
        return self.spark.read.schema(RUN_METRICS).parquet(f"{self.path}/run_metrics")
