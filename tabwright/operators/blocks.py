"""Training rows as blocks of numbers, and cut points of their features from all rows.

A fit reads its rows many times. They are put together once, where they lie, into blocks of a few
thousand rows: features row by row, target, weight and row hash as plain bytes. No row is moved.

Cut points come from counts by the leading bits of a value. Counts, and the smallest and largest
value behind each prefix, merge exactly in any order, so the cut points depend on the rows alone. A
prefix with more than ``FINE`` of the weight and more than one value is counted again by further
bits, until every range of values between neighbouring cut points is known to that share of ranks.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import AbstractContextManager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.batches import map_batches
from tabwright.session import setting

ROWS, BYTES = 16_384, 4 << 20
FINE = 1 / 2048
#: Bits of a value that the first count and the ones after it look at.
PREFIXES = (20, 32, 44, 64)
WEIGHT_UNIT = 1 << 20
#: Of the blocks that a Python worker gets at a time: it holds two such batches, however large the table is.
BATCH_BYTES = 4 << 20

BLOCK = "n int, x binary, y binary, w binary, key binary"
_BLOCK = pa.schema([("n", pa.int32()), ("x", pa.binary()), ("y", pa.binary()), ("w", pa.binary()), ("key", pa.binary())])


def small_batches(spark: SparkSession) -> AbstractContextManager:
    """For jobs that read blocks: Spark's default of 64 MB a batch is a task's whole share of a middling table."""
    return setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


@dataclass
class Blocks:
    """``frame`` is kept until ``release``; ``groups`` are features of which a row sets at most one, to 1."""

    frame: DataFrame
    d: int
    groups: list[list[int]] = field(default_factory=list)
    rows: int = 0
    weight: float = 0.0
    _kept: dict = field(default_factory=dict)
    _lock: threading.Lock = field(default_factory=threading.Lock)

    def once(self, name: object, make: Callable[[], object]) -> object:
        """What ``make`` returns, made for the first caller and shared by all fits on these rows."""
        with self._lock:
            if name not in self._kept:
                self._kept[name] = make()
            return self._kept[name]

    def release(self) -> None:
        for kept in self._kept.values():
            if hasattr(kept, "release"):
                kept.release()
        self._kept.clear()
        self.frame.unpersist()


def _blockify(d: int, rows: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0

        def out(parts: list[tuple]) -> pa.RecordBatch:
            x, y, w, key = (np.concatenate(c) for c in zip(*parts))
            values = [[len(y)], [x.tobytes()], [y.tobytes()], [w.tobytes()], [key.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, _BLOCK.types)], schema=_BLOCK)

        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3)]
            for at in range(0, batch.num_rows, rows):
                held.append((x[at : at + rows], *(c[at : at + rows] for c in columns)))
                count += len(held[-1][1])
                if count >= rows:
                    yield out(held)
                    held, count = [], 0
        if held:
            yield out(held)

    return work


def blocks_of(df: DataFrame, features: str, label: str, weight: str | None, key: str, d: int, groups: Sequence[Sequence[int]] = ()) -> Blocks:
    """The rows of ``df`` as blocks, kept; one pass counts them and adds up their weights."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    flat = df.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"), w.alias("w"), F.col(key).alias("key"))
    size = max(64, min(ROWS, BYTES // (8 * max(d, 1))))
    frame = map_batches(flat, _blockify(d, size), BLOCK).persist(StorageLevel.MEMORY_AND_DISK)
    out = Blocks(frame, d, [list(g) for g in groups])
    out.rows, out.weight = _counted(out)
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, w = 0, 0
    for block in opened(batches, None):
        n, w = n + block.n, w + int(np.rint(block.w * WEIGHT_UNIT).sum())
    yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([w])], names=["n", "w"])


def _counted(blocks: Blocks) -> tuple[int, float]:
    sums = map_batches(blocks.frame.select("n", "w"), _count, "n long, w long").agg(F.sum("n"), F.sum("w")).first()
    return int(sums[0] or 0), (sums[1] or 0) / WEIGHT_UNIT


@dataclass
class Block:
    n: int
    x: np.ndarray | None
    y: np.ndarray | None
    w: np.ndarray | None
    key: np.ndarray | None


def opened(batches: Iterator[pa.RecordBatch], d: int | None) -> Iterator[Block]:
    """The blocks of a task, whatever columns were selected."""
    for batch in batches:
        at = {name: i for i, name in enumerate(batch.schema.names)}

        def read(name: str, kind: type, row: int) -> np.ndarray | None:
            return np.frombuffer(batch.column(at[name])[row].as_buffer(), kind) if name in at else None

        for row in range(batch.num_rows):
            x = read("x", np.float64, row)
            yield Block(
                batch.column(at["n"])[row].as_py(), None if x is None else x.reshape(-1, d), read("y", np.float64, row),
                read("w", np.float64, row), read("key", np.int64, row),
            )


# --- cut points ---------------------------------------------------------------------------------


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the values (0.0 and -0.0 are one)."""
    bits = (values + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def _grouped(prefix: np.ndarray, weight: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums, minima and maxima per prefix, prefixes rising."""
    order = np.argsort(prefix, kind="stable")
    prefix = prefix[order]
    starts = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]])) if len(prefix) else np.zeros(0, np.int64)
    if not len(starts):
        return prefix, weight, low, high
    return (
        prefix[starts], np.add.reduceat(weight[order], starts), np.minimum.reduceat(low[order], starts), np.maximum.reduceat(high[order], starts)
    )


_SKETCH = pa.schema([("feature", pa.int32()), ("prefix", pa.binary()), ("weight", pa.binary()), ("low", pa.binary()), ("high", pa.binary())])
SKETCH = "feature int, prefix binary, weight binary, low binary, high binary"


def _sketch_row(feature: int, sketch: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((feature, *(a.tobytes() for a in sketch)), _SKETCH.types)], schema=_SKETCH)


def _sketcher(d: int, bits: int, features: Sequence[int], within: dict[int, tuple[int, np.ndarray]] | None):
    """Per task and feature the counts by the leading ``bits``; later only behind the prefixes ``within``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        sizes: dict[int, int] = {}
        for block in opened(batches, d):
            weight = np.rint(block.w * WEIGHT_UNIT).astype(np.int64)
            for f in features:
                x = block.x[:, f]
                x = np.where(np.isnan(x), 0.0, x)
                key = ordered_bits(x)
                own = weight
                if within is not None:
                    before, heavy = within[f]
                    keep = np.isin(key >> (64 - before), heavy)
                    x, key, own = x[keep], key[keep], weight[keep]
                held.setdefault(f, []).append(_grouped(key >> (64 - bits), own, x, x))
                sizes[f] = sizes.get(f, 0) + len(held[f][-1][0])
                if sizes[f] > 1 << 18:
                    held[f] = [_grouped(*(np.concatenate(c) for c in zip(*held[f])))]
                    sizes[f] = len(held[f][0][0])
        for f, parts in held.items():
            yield _sketch_row(f, _grouped(*(np.concatenate(c) for c in zip(*parts))))

    return work


def _merge_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All tasks' counts of a feature together. Neighbours that are light together become one."""
    held: dict[int, list] = {}
    for batch in batches:
        for row in batch.to_pylist():
            held.setdefault(row["feature"], []).append(tuple(np.frombuffer(row[c], t) for c, t in _KINDS))
    for f, parts in held.items():
        yield _sketch_row(f, _grouped(*(np.concatenate(c) for c in zip(*parts))))


_KINDS = (("prefix", np.int64), ("weight", np.int64), ("low", np.float64), ("high", np.float64))


def _merged(blocks: Blocks, work, features: int) -> dict[int, tuple[np.ndarray, ...]]:
    frame = map_batches(blocks.frame.select("n", "x", "w"), work, SKETCH)
    frame = map_batches(frame.repartition(max(1, min(features, 64)), "feature"), _merge_sketches, SKETCH)
    return {r["feature"]: tuple(np.frombuffer(r[c], t) for c, t in _KINDS) for r in frame.collect()}


def cut_points(blocks: Blocks, features: Sequence[int], max_bins: int) -> dict[int, np.ndarray]:
    """Rising cut points of each feature, at most ``max_bins - 1``: every gap between values where those are few,
    else quantiles of the weighted rows. A value at or below a cut point lies on its left.

    What comes to the driver is a feature's counts by prefix: a few hundred for each power of two in its range.
    """
    if not features or not blocks.rows:
        return {f: np.zeros(0) for f in features}
    found = _merged(blocks, _sketcher(blocks.d, PREFIXES[0], list(features), None), len(features))
    for before, bits in zip(PREFIXES, PREFIXES[1:]):
        heavy = {}
        for f, (prefix, weight, low, high) in found.items():
            few = len(prefix) <= max_bins  # so few that each gap may become a cut point: look into all of them
            unclear = (high > low) & ((weight > FINE * weight.sum()) | few)
            if unclear.any():
                heavy[f] = (before, prefix[unclear], unclear)
        if not heavy:
            break
        within = {f: (b, p) for f, (b, p, _) in heavy.items()}
        inner = _merged(blocks, _sketcher(blocks.d, bits, list(within), within), len(heavy))
        for f, (_, _, unclear) in heavy.items():
            # prefixes of this length for all: what was clear already is no longer looked into
            prefix, weight, low, high = (a[~unclear] for a in found[f])
            parts = zip((ordered_bits(low) >> (64 - bits), weight, low, high), inner[f])
            joined = [np.concatenate(p) for p in parts]
            order = np.argsort(joined[2], kind="stable")
            found[f] = tuple(a[order] for a in joined)
        for f in found:
            if f not in heavy:
                prefix, weight, low, high = found[f]
                found[f] = (ordered_bits(low) >> (64 - bits), weight, low, high)
    return {f: _cuts(*found[f][1:], max_bins) for f in features}


def _cuts(weight: np.ndarray, low: np.ndarray, high: np.ndarray, max_bins: int) -> np.ndarray:
    between = high[:-1] / 2 + low[1:] / 2
    between = np.where(between >= low[1:], high[:-1], between)
    if len(weight) <= max_bins:
        return between
    ranks = np.cumsum(weight)
    wanted = ranks[-1] * (np.arange(1, max_bins) / max_bins)
    at = np.unique(np.searchsorted(ranks, wanted))
    return between[at[at < len(between)]]
