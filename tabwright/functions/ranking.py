"""Ranks and prefix sums over an order, without one task that sees the whole order."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.hashing import quoted
from tabwright.session import cut_lineage

ROWS_PER_BUCKET = 2_000_000


def dense_codes(values: DataFrame, keys: Sequence[str], value: str | Sequence[str], largest: int) -> DataFrame:
    """Number distinct (keys, value) rows 0, 1, ... in the order of one or more value columns within each key.

    ``largest`` is the size of the largest group. Up to the bucket size a window per group
    does. Beyond it rows are range-partitioned once, numbered inside their partition and
    shifted by the sizes of the partitions before it (a table of one row per partition).
    """
    keys, value = list(keys), [value] if isinstance(value, str) else list(value)
    if largest <= ROWS_PER_BUCKET:
        order = Window.partitionBy(*keys).orderBy(*value)
        return values.withColumn("code", F.row_number().over(order) - 1)
    # written once: a retried range partitioning could place rows elsewhere
    placed = cut_lineage(
        values.repartitionByRange(*keys, *value).withColumn("_part", F.spark_partition_id())
    )
    sizes = placed.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.withColumn("_shift", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    order = Window.partitionBy(*keys, "_part").orderBy(*value)
    return (
        placed.withColumn("_place", F.row_number().over(order))
        .join(shifts, [*keys, "_part"])
        .withColumn("code", F.col("_place") - 1 + F.col("_shift"))
        .select(*values.columns, "code")
    )


def pair_wins(
    df: DataFrame,
    label: str,
    scores: Column,
    score_ids: Sequence[int],
    keys: Sequence[str] = (),
    rows: int | None = None,
) -> DataFrame:
    """Per scored class i and other class j: rows, and how often i's score ranks i above j.

    ``scores`` is an array with one score per entry of ``score_ids``; ``label`` is the class
    number. Returns (keys, i, j, n_own, n_other, wins), with a row for each class j that occurs:
    ``wins`` counts pairs of a row of i and a row of j where i's row has the larger score, ties
    as one half.

    No pair is ever formed. Rows are counted per class and distinct score, so a score shared by a
    third of the table is one row per class. One running count, of class i's own rows by falling
    score, gives each row of another class the rows of i above it; with half of those beside it
    that is what the row adds to ``wins``. So the work is one row per scored row and class, and
    only the small result has a row per pair of classes. Running counts are kept inside score
    buckets of bounded size; a table of one row per bucket supplies what lies above each bucket.
    ``rows`` is the row count of ``df`` where the caller knows it.
    """
    keys = list(keys)
    # outer: an inner explode would work the scores out twice, first to see that there are any
    long = df.select(*keys, F.col(label).alias("_y"), F.posexplode_outer(scores).alias("_pos", "score")).where("_pos IS NOT NULL")
    long = long.withColumn("i", F.get(F.array(*[F.lit(int(s)) for s in score_ids]), F.col("_pos")))
    per_score, bucket = long.groupBy(*keys, "i", "score", "_y").agg(F.count(F.lit(1)).alias("n")), []
    if (df.count() if rows is None else rows) * len(score_ids) > ROWS_PER_BUCKET:
        # counted in one pass over the rows; buckets are of what is left. Nulls have no place in a bucket
        known = [F.col(quoted(c)).isNotNull() for c in (*keys, "score")]
        per_score = cut_lineage(per_score.where(functools.reduce(operator.and_, known)))
        per_score, bucket = _with_bucket(per_score, per_score.count())
    own = F.when(F.col("_y") == F.col("i"), F.col("n")).otherwise(0)
    here = Window.partitionBy(*keys, "i", *bucket)
    falling = here.orderBy(F.desc("score"))
    upto = falling.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    beside = falling.rangeBetween(Window.currentRow, Window.currentRow)
    placed = per_score.select(
        *keys, "i", *bucket, "_y", "n", F.sum(own).over(upto).alias("reached"), F.sum(own).over(beside).alias("tied")
    )
    # own rows above and half of those tied; the rows of class i itself carry the class's size
    per_class = placed.groupBy(*keys, "i", *bucket, "_y").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("reached") - F.col("tied") / 2)).alias("wins")
    )
    if bucket:
        sizes = per_class.groupBy(*keys, "i", *bucket).agg(F.sum(own).alias("_own"))
        later = Window.partitionBy(*keys, "i").orderBy(F.desc(*bucket)).rowsBetween(Window.unboundedPreceding, -1)
        above = sizes.select(*keys, "i", *bucket, F.coalesce(F.sum("_own").over(later), F.lit(0)).alias("_above"))
        per_class = per_class.join(above, [*keys, "i", *bucket]).withColumn("wins", F.col("wins") + F.col("n") * F.col("_above"))
    found = per_class.groupBy(*keys, "i", "_y").agg(F.sum("n").alias("n"), F.sum("wins").alias("wins"))
    own_size = F.sum(own).over(Window.partitionBy(*keys, "i"))
    return found.select(*keys, "i", F.col("_y").alias("j"), own_size.alias("n_own"), F.col("n").alias("n_other"), F.col("wins").cast("double").alias("wins"))


def _with_bucket(long: DataFrame, rows: int) -> tuple[DataFrame, list[str]]:
    """Add a bucket of about ``ROWS_PER_BUCKET`` rows by score; none when one bucket would do."""
    if rows <= ROWS_PER_BUCKET:
        return long, []
    buckets = -(-rows // ROWS_PER_BUCKET)
    steps = [b / buckets for b in range(1, buckets)]
    # the result does not depend on where the cuts lie, so a sample is enough to place them
    share = min(1.0, 500 * buckets / rows)
    sample = long.where(F.rand(11) < share) if share < 1 else long
    cuts = sample.agg(F.percentile_approx("score", steps, 10 * buckets)).first()[0] or []
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    cutter = Bucketizer(splits=splits, inputCol="score", outputCol="_bucket", handleInvalid="keep")
    return cutter.transform(long), ["_bucket"]
