"""Scoring rows as they arrive: the same expressions and models on a streaming DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tabwright.plans.registry import Registry


def score_stream(
    stream: DataFrame, registry: Registry, model_name: str, output: str, checkpoint: str, version: str | None = None
) -> StreamingQuery:
    """Append scored rows to a parquet table; stateless, so it needs no watermark.

    The version asked for becomes the model's default. ``checkpoint`` must be on shared storage: it makes restarts exactly-once. The query stops
    when it has scored all rows that were there.
    """
    model, row = registry.load(model_name, version)
    if version is not None:
        registry.set_default(model_name, version)
    scored = model.score(stream, row["threshold"])
    return (
        scored.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
