"""Train/test splits, folds, samples and the example record."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.hashing import hash_below, hash_bucket, quoted, row_digest
from tabwright.functions.quantiles import EVERY_ROW, exact_quantiles

FOLD_COLUMN = "split_fold"
NO_FOLD = -1  # the fold of test rows


SPLIT_COLUMN, TRAIN, TEST = "split_side", "train", "test"


@dataclass
class Split:
    """Rows labelled ``train`` or ``test``; the sides are filters of that one table."""

    labelled: DataFrame
    cut: float | None = None

    @property
    def train(self) -> DataFrame:
        return self.side(TRAIN)

    @property
    def test(self) -> DataFrame:
        return self.side(TEST)

    def side(self, name: str) -> DataFrame:
        return self.labelled.where(F.col(SPLIT_COLUMN) == name).drop(SPLIT_COLUMN, FOLD_COLUMN)

    def folded_train(self, k: int, seed: int, keys: Sequence[str] | None = None) -> DataFrame:
        """The train side with its fold column."""
        if FOLD_COLUMN in self.labelled.columns:
            return self.labelled.where(F.col(SPLIT_COLUMN) == TRAIN).drop(SPLIT_COLUMN)
        return with_folds(self.train, k, seed, keys)

    def sizes(self) -> DataFrame:
        """Rows per side, in one pass."""
        return self.labelled.groupBy(SPLIT_COLUMN).agg(F.count(F.lit(1)).alias("n_rows"))

    def write(self, path: str, k: int, seed: int, keys: Sequence[str] | None = None, by: str | None = None) -> Split:
        """Write both sides in one pass, and go on from the written table. Folds hold equal parts of each value of ``by``.

        Sides and folds are partitions of the table: a job that leaves out a fold, or reads only
        one, opens no file of the others and hashes nothing again.
        """
        keys = list(keys or self.columns)
        if by is None:
            number = fold_number(k, seed, keys)
        else:
            number = stratified_fold(by, keys, seed, fold_bounds(self.train, by, k, seed, keys))
        fold = F.when(F.col(SPLIT_COLUMN) == TRAIN, number).otherwise(NO_FOLD)
        writer = self.labelled.withColumn(FOLD_COLUMN, fold).write.mode("overwrite")
        writer.partitionBy(SPLIT_COLUMN, FOLD_COLUMN).parquet(path)
        return Split(self.labelled.sparkSession.read.parquet(path), self.cut)

    @property
    def columns(self) -> list[str]:
        return [c for c in self.labelled.columns if c not in (SPLIT_COLUMN, FOLD_COLUMN)]


def _labelled(df: DataFrame, train_side: Column) -> DataFrame:
    taken = [c for c in df.columns if c.lower() in (SPLIT_COLUMN, FOLD_COLUMN)]
    if taken:
        raise ValueError(f"rename {', '.join(taken)}: the split uses these names")
    return df.withColumn(SPLIT_COLUMN, F.when(train_side, TRAIN).otherwise(TEST))


def in_train(keys: Sequence[str], ratio: float, seed: int) -> Column:
    return hash_below(keys, ratio, seed)


def random_split(df: DataFrame, ratio: float, seed: int, keys: Sequence[str] | None = None) -> Split:
    """Split by a hash of the key, so that retries and repartitioning give the same rows.

    Without a key all columns are hashed; equal rows then fall on the same side.
    """
    return Split(_labelled(df, in_train(keys or df.columns, ratio, seed)))


def epoch_seconds(name: str) -> Column:
    return F.unix_timestamp(F.col(quoted(name)))


def time_split(df: DataFrame, time_column: str, ratio: float) -> Split:
    """Train on rows strictly before the ratio quantile of time, test on the rest.

    Rows without a time are on neither side.
    """
    seconds = epoch_seconds(time_column)
    cut = exact_quantiles(df, {"cut": seconds}, ratio)[EVERY_ROW, "cut"]
    return Split(_labelled(df.where(seconds.isNotNull()), seconds < F.lit(cut)), cut)


def with_folds(df: DataFrame, k: int, seed: int, keys: Sequence[str] | None = None) -> DataFrame:
    """Add the fold number 0..k-1, by a hash independent of the split's."""
    return df.withColumn(FOLD_COLUMN, fold_number(k, seed, keys or df.columns))


def fold_number(k: int, seed: int, keys: Sequence[str]) -> Column:
    return hash_bucket(keys, k, seed, "fold")


FOLD_DIGITS = 3  # hex digits of the row hash that a pass looks at: 4096 ranges


def fold_bounds(df: DataFrame, by: str, k: int, seed: int, keys: Sequence[str]) -> dict:
    """For each value of ``by`` the k - 1 row hashes at which its folds begin: rows in the order of their hash
    are dealt out in k runs whose sizes differ by one at most.

    Rows are counted by value and leading digits; the range that holds a bound is counted again by the next
    digits, until the bound is exact. Nothing is sorted or moved; each pass returns at most ``16 ** FOLD_DIGITS``
    counts for a value, later ones only those of the ranges still open. Rows with one key and value can't be parted.
    """
    rows = df.select(F.col(quoted(by)).alias("value"), row_digest(keys, seed, "fold").alias("digest")).where("value IS NOT NULL")
    bounds: dict = {}
    open_: dict[tuple, list[tuple[int, int]]] = {}  # (value, digits so far): [(bound, rows before it in the range)]
    digits = 0
    while digits < 32:
        known = rows
        if digits:
            ranges = df.sparkSession.createDataFrame(
                list(open_), T.StructType([T.StructField("value", df.schema[by].dataType), T.StructField("prefix", T.StringType())])
            )
            known = rows.withColumn("prefix", F.substring("digest", 1, digits)).join(F.broadcast(ranges), ["value", "prefix"])
        digits += FOLD_DIGITS
        counted = known.groupBy("value", F.substring("digest", 1, digits).alias("prefix")).count().collect()
        groups: dict[tuple, list[tuple[str, int]]] = {}
        for value, prefix, n in counted:
            groups.setdefault((value, prefix[: digits - FOLD_DIGITS]), []).append((prefix, n))
        wanted, open_ = open_, {}
        for (value, start), counts in groups.items():
            counts.sort()
            total = sum(n for _, n in counts)
            if not start:
                bounds[value] = ["g"] * (k - 1)  # behind every digit
                wanted[value, start] = [(j, j * total // k) for j in range(1, k)]
            for j, rank in wanted[value, start]:
                before = 0
                for prefix, n in counts:
                    if before == rank:  # the bound is the range's beginning
                        bounds[value][j - 1] = prefix
                        break
                    if before < rank < before + n:
                        bounds[value][j - 1] = prefix
                        if n > 1:
                            open_.setdefault((value, prefix), []).append((j, rank - before))
                        break
                    before += n
        if not open_:
            break
    return bounds


def stratified_fold(by: str, keys: Sequence[str], seed: int, bounds: dict) -> Column:
    """How many of its value's bounds a row's hash has reached."""
    entries = [x for value, cuts in bounds.items() for x in (F.lit(value), F.array(*[F.lit(c) for c in cuts]))]
    if not entries or not next(iter(bounds.values())):
        return F.lit(0)
    own = F.element_at(F.create_map(*entries), F.col(quoted(by)))
    return F.coalesce(F.array_size(F.filter(own, lambda cut: cut <= row_digest(keys, seed, "fold"))), F.lit(NO_FOLD))


def sample_rows(df: DataFrame, n: int, seed: int, keys: Sequence[str] | None = None) -> DataFrame:
    """``n`` rows with the smallest row hash: a uniform sample that can be repeated.

    Only rows below a hash threshold can be among the n smallest, so on large tables the
    threshold is applied first and the top-n sees a few thousand rows, not a few per task.
    """
    keys = list(keys or df.columns)
    total = df.count()
    if total <= n:
        return df
    candidates = df
    bound = (n + 10 * math.sqrt(n) + 10) / total
    if bound < 0.5:
        below = df.where(hash_below(keys, bound, seed)).persist(StorageLevel.MEMORY_AND_DISK)
        if below.count() >= n:  # always so unless the key repeats heavily
            candidates = below
        else:
            below.unpersist()
    order = [row_digest(keys, seed), *[F.col(quoted(k)) for k in keys]]
    return candidates.orderBy(*order).limit(n)


def example_record(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One record made of the first value present in each column, by the first column's order.

    A global aggregate, not a window over one partition; ``keys`` break ties.
    """
    order = F.struct(F.col(quoted(df.columns[0])), *[F.col(quoted(k)) for k in keys])
    return df.agg(
        *[
            F.min_by(F.col(quoted(c)), F.when(F.col(quoted(c)).isNotNull(), order)).alias(c)
            for c in df.columns
        ]
    )
