import pyarrow as pa
from pyspark.sql import functions as F

from tabwright.functions.batches import map_batches
from tabwright.operators import estimators
from tabwright.operators.blocks import BATCH_BYTES, small_batches

NAME = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_a_worker_gets_few_blocks_at_a_time(spark):
    """Whatever a task's share of the table is: these 32 MB were one batch."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["bytes"])

    blocks = spark.range(0, 64, 1, 1).select(F.repeat(F.lit("x"), 1 << 19).cast("binary").alias("x"))
    with small_batches(spark):
        found = [r["bytes"] for r in map_batches(blocks, sizes, "bytes long").collect()]
    assert sum(found) >= 32 << 20 and max(found) <= BATCH_BYTES + (1 << 20)


def test_fits_read_small_batches_and_leave_the_setting_as_it_was(spark, monkeypatch):
    seen, before = [], spark.conf.get(NAME)
    monkeypatch.setattr(estimators, "_fit", lambda *a: seen.append(spark.conf.get(NAME)))
    rows = estimators.FittingRows(spark.range(1), 1, [], False)
    with small_batches(spark):
        estimators.fit_estimator(rows, "xgb", {}, "two-class classification", 2, 0)
        assert spark.conf.get(NAME) == str(BATCH_BYTES)
    estimators.fit_estimator(rows, "xgb", {}, "two-class classification", 2, 0)
    assert seen == [str(BATCH_BYTES)] * 2 and spark.conf.get(NAME) == before
