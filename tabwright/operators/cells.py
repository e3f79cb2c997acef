"""Boosting on rows put together by their codes.

A tree tells rows apart by their codes alone, and a margin is a sum of trees' values: rows with the same
vector of codes have the same margin in every round. Gradients are linear in the target, so the rows of one
vector (a cell; with classes, of one vector and class) are as one row with their summed weight, their mean
target and their number. One pass over all rows adds up the cells, in whole numbers, so they depend on the
rows alone. Where they are few enough for one task, a fit is one task that reads the cells, however many
rounds it has, and fits of several candidates run side by side. Where they are not (``CELL_CODES``), or the
vectors can't be numbered, the fit walks the rows as before.

A fitted ensemble scores rows by the same codes: each vector is walked through the trees once a task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.batches import map_batches, on_workers
from tabwright.operators.blocks import Blocks, opened
from tabwright.operators.trees import (
    SOFTMAX,
    Codes,
    Column,
    Ensemble,
    Grower,
    Growth,
    Labels,
    Start,
    Tree,
    _Growing,
    boosted_trees,
    boosting_labels,
    codes_of,
    columns_of,
    gradients,
    in_features,
    start_of,
)

CELL_CODES = 1 << 20  # codes of all cells of one fit: a few dozen MB in its task
MOST_VECTORS = 1 << 61
LOCAL_HISTOGRAM_BYTES = 64 << 20

_PART = [("part", pa.int32()), *[(name, pa.binary()) for name in ("id", "w", "t", "n")]]
CELLS, _CELLS = "part int, id binary, w binary, t binary, n binary", pa.schema(_PART)
TOO_MANY = -1


class Numbering:
    """Vectors of codes as whole numbers, in the order of their codes."""

    def __init__(self, columns: Sequence[Column]) -> None:
        self.sizes = [c.cells for c in columns]

    @property
    def vectors(self) -> int:
        return math.prod(self.sizes)

    def number(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(codes), np.int64)
        for j, size in enumerate(self.sizes):
            out = out * size + codes[:, j]
        return out

    def codes(self, numbers: np.ndarray) -> np.ndarray:
        out = np.empty((len(numbers), len(self.sizes)), np.int64)
        for j in reversed(range(len(self.sizes))):
            numbers, out[:, j] = np.divmod(numbers, self.sizes[j])
        return out


def _summed(number: np.ndarray, *stats: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums per number, numbers rising."""
    if not len(number):
        return number, *stats
    order = np.argsort(number, kind="stable")
    number = number[order]
    starts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
    return number[starts], *[np.add.reduceat(s[order], starts) for s in stats]


def _together(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    return _summed(*(np.concatenate(c) for c in zip(*parts)))


def _row(part: int, cells: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((part, *(c.tobytes() for c in cells)), _CELLS.types)], schema=_CELLS)


_NOTHING = tuple(np.zeros(0, np.int64) for _ in range(4))


class _Sum:
    """Cells added up piece by piece, until there are more than ``most`` of them."""

    def __init__(self, most: int) -> None:
        self.most, self.parts, self.size, self.over = most, [], 0, False

    def add(self, cells: tuple[np.ndarray, ...]) -> None:
        self.parts.append(cells)
        self.size += len(cells[0])
        if self.size > 2 * self.most + 65_536:
            self.close()

    def close(self) -> tuple[np.ndarray, ...]:
        self.parts = [_together(self.parts)] if self.parts else [_NOTHING]
        self.size = len(self.parts[0][0])
        self.over |= self.size > self.most
        return self.parts[0]


def _adder(d: int, columns: list[Column], mean: float, scales: tuple[float, float], classes: int, most: int, spread: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbering, total = Numbering(columns), _Sum(most)
        for block in opened(batches, d):
            if total.over:
                continue
            number = numbering.number(codes_of(block.x, columns, "<i8"))
            if classes:
                number = number * classes + block.y.astype(np.int64)
            w = np.rint(block.w * scales[1]).astype(np.int64)
            t = np.rint((block.y - mean) * block.w * scales[0]).astype(np.int64)
            total.add(_summed(number, w, t, np.ones(block.n, np.int64)))
        cells = total.close()
        if total.over:
            yield _row(TOO_MANY, _NOTHING)
            return
        part = cells[0] % spread
        for p in np.unique(part):
            yield _row(int(p), tuple(c[part == p] for c in cells))

    return work


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield batch.column(0)[row].as_py(), tuple(np.frombuffer(batch.column(i)[row].as_buffer(), np.int64) for i in range(1, 5))


def _merger(most: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, _Sum] = {}
        over = False
        for part, cells in _read(batches):
            own = total.setdefault(part, _Sum(most))
            over |= part == TOO_MANY or own.over
            if not over:
                own.add(cells)
        if over:
            yield _row(TOO_MANY, _NOTHING)
            return
        for part, own in total.items():
            cells = own.close()
            yield _row(TOO_MANY if own.over else part, _NOTHING if own.over else cells)

    return work


@dataclass
class Cells:
    """``frame`` is kept until ``release``. Weights and targets less ``mean`` are whole multiples of 1 / ``scales``."""

    frame: DataFrame
    columns: list[Column]
    classes: int
    mean: float
    scales: tuple[float, float]
    rows: int

    def release(self) -> None:
        self.frame.unpersist()


def cells_of(blocks: Blocks, columns: list[Column], max_bins: int, labels: Labels, classes: int) -> Cells | None:
    """The cells of all rows, added up once for all fits with so many bins; None where there are too many for one task."""

    def make() -> Cells | None:
        vectors = Numbering(columns).vectors * max(classes, 1)
        if not columns or vectors > MOST_VECTORS:
            return None
        most = max(1, CELL_CODES // len(columns))
        spread = max(1, min(64, int(blocks.frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
        bits = min(36, 60 - max(1, blocks.rows).bit_length())
        largest = (max(labels.spread, 1e-300) * labels.largest_w, max(labels.largest_w, 1e-300))
        scales = tuple(2.0 ** (bits - math.frexp(max(x, 1e-290))[1]) for x in largest)
        work = _adder(blocks.d, columns, labels.mean, scales, classes, most, spread)
        parts = map_batches(blocks.frame.select("n", "x", "y", "w"), work, CELLS)
        merged = map_batches(parts.repartition(spread, "part"), _merger(most), CELLS)
        cells = Cells(merged.persist(StorageLevel.MEMORY_AND_DISK), columns, classes, labels.mean, scales, blocks.rows)
        over, size = cells.frame.agg(F.max((F.col("part") == TOO_MANY).cast("int")), F.sum(F.length("id") / 8)).first()
        if over or size > most:
            cells.release()
            return None
        return cells

    return blocks.once(("cells", max_bins, classes), make)


class CellGrower(Grower):
    """Grows trees on cells held in arrays: no job a step."""

    SUM_BITS = 52  # sums are of whole numbers that a double holds

    def __init__(self, cells: Cells, growth: Growth, start: Start, stats: tuple[np.ndarray, ...]) -> None:
        codes = Codes(None, cells.columns, False, cells.rows)
        super().__init__(codes, growth, start.base, start.largest)
        number, w, t, n = stats
        of_class = np.zeros(len(number))
        if cells.classes:
            number, of_class = np.divmod(number, cells.classes)
        self.number, self.cell_codes = number, Numbering(cells.columns).codes(number)
        self.w, self.n = w / cells.scales[1], n.astype(float)
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = cells.mean + np.where(self.w > 0, t / cells.scales[0] / self.w, 0.0)
        self.y = of_class if cells.classes else mean
        self.margins = np.tile(self.layout["base"], (len(number), 1))
        self.flat = self.cell_codes + self.offsets[:-1]
        self._gradients()

    def _gradients(self) -> None:
        g, h = gradients(self.growth, self.y, self.w, self.margins)
        self.g, self.h = np.rint(g * self.scales[0]), np.rint(h * self.scales[1])

    def _histograms(self, asked: list[tuple[_Growing, int]]) -> dict[tuple[int, int], np.ndarray]:
        cells = int(self.offsets[-1])
        found: dict[tuple[int, int], np.ndarray] = {}
        trees: dict[int, tuple[_Growing, list[int]]] = {}
        for tree, node in asked:
            trees.setdefault(id(tree), (tree, []))[1].append(node)
        at_once = max(1, LOCAL_HISTOGRAM_BYTES // (cells * self.width * 8))
        for tree, nodes in trees.values():
            own = Tree(*tree.shape(), None, None).walk(self.cell_codes, self.grouped)
            h = self.h[:, min(tree.gradient, self.h.shape[1] - 1)]
            for begin in range(0, len(nodes), at_once):
                part = nodes[begin : begin + at_once]
                slots = np.full(len(tree.nodes), -1, np.int64)
                slots[part] = np.arange(len(part))
                place = slots[own]
                keep = place >= 0
                at = (self.flat[keep] + (place[keep] * cells)[:, None]).ravel()
                sums = np.empty((len(part) * cells, self.width), np.int64)
                for k, stat in enumerate((self.g[:, tree.gradient], h, self.n)):
                    sums[:, k] = np.bincount(at, np.repeat(stat[keep], len(self.grouped)), len(sums))
                for k, node in enumerate(part):
                    found[id(tree), node] = sums[k * cells : (k + 1) * cells]
        return found

    def push(self, trees: list[tuple[int, Tree]]) -> None:
        for output, tree in trees:
            self.margins[:, output] += tree.values[tree.walk(self.cell_codes, self.grouped), 0]
        self._gradients()

    def release(self) -> None:
        pass


_TREES = pa.schema([("output", pa.int32()), *[(name, pa.binary()) for name in ("column", "cut", "left", "right", "value")]])
TREES = "output int, column binary, cut binary, left binary, right binary, value binary"
VECTORS = -1  # in place of an output: vectors and their margins


def _fitter(cells: Cells, growth: Growth, start: Start):
    cells = Cells(None, cells.columns, cells.classes, cells.mean, cells.scales, cells.rows)

    def out(output: int, values: Sequence[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((output, *(x.tobytes() for x in values)), _TREES.types)], schema=_TREES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [part for _, part in _read(batches)]
        if not parts:
            return
        grower = CellGrower(cells, growth, start, _together(parts))
        for output, tree in boosted_trees(grower, start):
            shape = [a.astype(np.int32) for a in (tree.column, tree.cut, tree.left, tree.right)]
            yield out(output, [*shape, tree.values[:, 0].astype(np.float64)])
        number, first = np.unique(grower.number, return_index=True)
        empty = np.zeros(0)
        yield out(VECTORS, [number, grower.margins[first].ravel(), empty, empty, empty])

    return work


@dataclass
class CodedEnsemble:
    """Trees on codes, beside the margins of the vectors they were fitted to."""

    columns: list[Column]
    base: list[float]
    trees: list[tuple[int, Tree]]
    known: np.ndarray  # numbers of vectors, rising
    margins: np.ndarray  # theirs, by output
    d: int

    @property
    def outputs(self) -> int:
        return len(self.base)

    def as_ensemble(self) -> Ensemble:
        return Ensemble(self.base, [(k, in_features(tree, self.columns)) for k, tree in self.trees], self.d)

    def margins_of(self, number: np.ndarray) -> np.ndarray:
        """Margins of vectors, each walked through all trees."""
        codes = Numbering(self.columns).codes(number)
        grouped = np.array([c.cuts is None for c in self.columns])
        out = np.tile(np.array(self.base, float), (len(number), 1))
        for output, tree in self.trees:
            out[:, output] += tree.values[tree.walk(codes, grouped), 0]
        return out


def boosted_on_cells(blocks: Blocks, growth: Growth, rounds: int, rate: float, max_bins: int) -> CodedEnsemble | None:
    """Boosting in one task that reads the cells; None where they are too many."""
    labels = boosting_labels(blocks, growth)
    start = start_of(labels, growth, rounds, rate)
    columns = columns_of(blocks, max_bins)
    cells = cells_of(blocks, columns, max_bins, labels, growth.classes if growth.objective == SOFTMAX else 0)
    if cells is None:
        return None
    trees, known, margins = [], np.zeros(0, np.int64), np.zeros((0, start.outputs))
    for row in map_batches(cells.frame.coalesce(1), _fitter(cells, growth, start), TREES).collect():
        if row["output"] == VECTORS:
            known, margins = np.frombuffer(row["column"], np.int64), np.frombuffer(row["cut"], np.float64).reshape(-1, start.outputs)
            continue
        shape = [np.frombuffer(row[c], np.int32) for c in ("column", "cut", "left", "right")]
        trees.append((row["output"], Tree(*shape, np.frombuffer(row["value"], np.float64)[:, None], np.zeros((len(shape[0]), 1)))))
    return CodedEnsemble(columns, start.base, trees, known, margins, blocks.d)


def _scorer(d: int, ensembles: list[CodedEnsemble]) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """Per row the margins of all ensembles, one behind the other."""
    width = sum(e.outputs for e in ensembles)

    def work(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = [[e.known, e.margins] for e in ensembles]
        for array in arrays:
            x = array.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            x = np.where(np.isnan(x), np.inf, x)  # right of every cut point, as in the library's models
            out = np.empty((len(x), width))
            begin, number, shown = 0, None, None
            for ensemble, seen in zip(ensembles, known):
                if shown is not ensemble.columns:  # candidates of one fold share their columns
                    number = Numbering(ensemble.columns).number(codes_of(x, ensemble.columns, "<i8"))
                    unique, back = np.unique(number, return_inverse=True)
                    shown = ensemble.columns
                new = np.setdiff1d(unique, seen[0], assume_unique=True)
                if len(new):
                    order = np.argsort(both := np.concatenate([seen[0], new]), kind="stable")
                    seen[:] = both[order], np.concatenate([seen[1], ensemble.margins_of(new)])[order]
                out[:, begin : begin + ensemble.outputs] = seen[1][np.searchsorted(seen[0], unique)][back]
                begin += ensemble.outputs
            offsets = np.arange(0, len(x) * width + 1, width, dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))

    return work


def with_margins(df: DataFrame, features: str, ensembles: Sequence[CodedEnsemble], output: str) -> DataFrame:
    """``df`` with an array of the margins of all ensembles, from one pass over the rows."""
    on_workers(df.sparkSession)
    scorer = _scorer(ensembles[0].d, list(ensembles))

    def margins(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from scorer(arrays)

    return df.withColumn(output, F.arrow_udf(margins, "array<double>")(vector_to_array(F.col(features))))
