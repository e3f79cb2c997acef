"""Trees grown from histograms: second-order boosting level by level or leaf by leaf, forests, single trees.

Rows stay where their blocks are. Values become codes once (``coded``); dummy features of one column,
of which a row sets at most one, share a code. Per step one job walks all unfinished trees over all rows,
adds up sums of gradients and hessians per node and code in each task, and merges them node by node;
the driver sees one histogram per node (``cells`` has boosting without jobs, where the codes allow it). Of two siblings only the one with fewer rows is counted, the
other is its parent less that. Sums are of whole numbers (gradients times a power of two), so a tree
depends on the rows alone, not on how they are cut into pieces or in which order tasks end.

Every criterion is one form: with G the sums of gradients (one per class in a tree of class shares), H of
hessians, the score of a node is the sum of G^2 / (H + lambda), the gain of a split is the children's
scores less the node's, and a leaf's value is -G / (H + lambda). Class shares and means are the case of
gradients -y and hessian 1: the gain is then the decrease of Gini impurity or of variance.

``leaves`` unlimited grows level by level. With a limit the leaf with the largest gain is split next;
children of all leaves that may still be split are counted ahead in the same job, which changes no
choice and makes the number of jobs follow the depth, not the number of leaves.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.batches import map_batches
from tabwright.operators.blocks import Blocks, cut_points, opened
from tabwright.session import cut_lineage

HISTOGRAM_BYTES = 256 << 20  # of all nodes that one job counts
REFRESH = 16  # boosting rounds after which rows carry their new margins
REFRESHES_PER_CUT = 4
SQUARED, LOGISTIC, SOFTMAX, SHARES, MEAN = "squared", "logistic", "softmax", "shares", "mean"
RESIDUAL = "residual"  # first-order boosting: trees of the residuals' variance, leaves their mean
SPLIT_BYTES = 8 << 20  # of the histograms whose splits are looked for at once
#: Chances of at most 0, 1, 2, ... draws of a row into a bootstrap sample.
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])


@dataclass(frozen=True)
class Growth:
    """How trees are grown."""

    objective: str
    classes: int = 1  # gradients per row: K for softmax and class shares
    max_depth: int = 6
    leaves: int | None = None
    l2: float = 0.0
    least_gain: float = 0.0
    least_hessian: float = 0.0
    least_rows: int = 1
    bootstrap: bool = False
    features_per_node: int | None = None
    seed: int = 0


@dataclass
class Column:
    """A column of codes: a feature with cut points, or a group of features of which one may be set."""

    features: list[int]
    cuts: np.ndarray | None

    @property
    def cells(self) -> int:
        return len(self.features) + 1 if self.cuts is None else len(self.cuts) + 1


@dataclass
class Codes:
    """Blocks of codes (``frame``: n, c, y, w, key, m) with the layout of a histogram. No margins ``m`` yet: those a fit starts from."""

    frame: DataFrame
    columns: list[Column]
    wide: bool
    rows: int

    @property
    def offsets(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum([c.cells for c in self.columns])]).astype(np.int64)

    def release(self) -> None:
        self.frame.unpersist()


CODED = "n int, c binary, y binary, w binary, key binary, m binary"
_CODED = pa.schema([("n", pa.int32()), *[(c, pa.binary()) for c in ("c", "y", "w", "key", "m")]])


def codes_of(x: np.ndarray, columns: list[Column], kind: str) -> np.ndarray:
    """Features row by row as codes; a feature that is not a number counts as 0."""
    codes = np.empty((len(x), len(columns)), kind)
    for j, column in enumerate(columns):
        if column.cuts is None:
            chosen = x[:, column.features] > 0.5
            codes[:, j] = np.where(chosen.any(axis=1), chosen.argmax(axis=1) + 1, 0)
        else:
            own = x[:, column.features[0]]
            codes[:, j] = np.searchsorted(column.cuts, np.where(np.isnan(own), 0.0, own))
    return codes


def _coder(d: int, columns: list[Column], kind: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in opened(batches, d):
            codes = codes_of(block.x, columns, kind)
            values = (block.n, codes.tobytes(), block.y.tobytes(), block.w.tobytes(), block.key.tobytes(), b"")
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _CODED.types)], schema=_CODED)

    return work


def columns_of(blocks: Blocks, max_bins: int) -> list[Column]:
    """The columns of codes, from all rows: found once for all fits with so many bins."""

    def make() -> list[Column]:
        grouped = {f for g in blocks.groups for f in g}
        single = [f for f in range(blocks.d) if f not in grouped]
        cuts = cut_points(blocks, single, max_bins)
        return [Column([f], cuts[f]) for f in single] + [Column(list(g), None) for g in blocks.groups if g]

    return blocks.once(("columns", max_bins), make)


def coded(blocks: Blocks, max_bins: int) -> Codes:
    """The rows' codes, kept with the blocks: all fits with so many bins share them."""
    columns = columns_of(blocks, max_bins)

    def make() -> Codes:
        wide = max((c.cells for c in columns), default=1) > 256
        frame = map_batches(blocks.frame, _coder(blocks.d, columns, "<u2" if wide else "u1"), CODED)
        return Codes(frame.persist(StorageLevel.MEMORY_AND_DISK), columns, wide, blocks.rows)

    return blocks.once(("codes", max_bins), make)


# --- trees --------------------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes by number. ``column`` -1 is a leaf; else codes at or below ``cut`` go left, in a group all but ``cut`` do."""

    column: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    values: np.ndarray  # nodes by outputs
    sums: np.ndarray  # nodes by outputs: class weights of a tree of class shares

    def walk(self, codes: np.ndarray, grouped: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        at = np.zeros(len(codes), np.int64)
        rows = np.arange(len(codes))
        while True:
            column = self.column[at]
            inner = column >= 0
            if not inner.any():
                return at
            code, cut = codes[rows, np.maximum(column, 0)].astype(np.int64), self.cut[at]
            to_left = np.where(grouped[np.maximum(column, 0)], code != cut, code <= cut)
            at = np.where(inner, np.where(to_left, self.left[at], self.right[at]), at)


@dataclass
class _Node:
    depth: int
    sums: np.ndarray  # G..., H, rows
    path: int
    histogram: np.ndarray | None = None
    split: tuple | None = None  # gain, column, cut, sums left
    kids: tuple[int, int] | None = None
    taken: bool = False


@dataclass
class _Growing:
    number: int  # of the tree, for the bootstrap
    gradient: int  # which of the rows' gradients it is fitted to
    nodes: list[_Node] = field(default_factory=list)
    heap: list[tuple] = field(default_factory=list)
    count: int = 1

    def shape(self) -> tuple[np.ndarray, ...]:
        column = np.full(len(self.nodes), -1, np.int64)
        cut, left, right = (np.zeros(len(self.nodes), np.int64) for _ in range(3))
        for i, node in enumerate(self.nodes):
            if node.kids:
                column[i], cut[i] = node.split[1], node.split[2]
                left[i], right[i] = node.kids
        return column, cut, left, right


def _mixed(key: np.ndarray, salt: int) -> np.ndarray:
    """Well-spread 64-bit numbers."""
    with np.errstate(over="ignore"):
        z = key.astype(np.uint64) + np.uint64(salt % (1 << 64)) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def draws_of(key: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row is in a tree's bootstrap sample: Poisson with mean 1, from the row's hash."""
    spread = _mixed(_mixed(key, 2 * seed + 1).view(np.int64), tree + 1)
    return np.searchsorted(POISSON, (spread >> np.uint64(11)) / 2.0**53, side="right")


def gradients(growth: Growth, y: np.ndarray, w: np.ndarray, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(G, H) of each row, one column per gradient; H has one column where all share it."""
    if growth.objective == SQUARED:
        return ((margins[:, 0] - y) * w)[:, None], w[:, None]
    if growth.objective == RESIDUAL:
        return (2 * (margins[:, 0] - y) * w)[:, None], w[:, None]
    if growth.objective == LOGISTIC:
        p = 1 / (1 + np.exp(-margins[:, 0]))
        return ((p - y) * w)[:, None], np.maximum(p * (1 - p), 1e-16)[:, None] * w[:, None]
    if growth.objective == SOFTMAX:
        e = np.exp(margins - margins.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        one = y[:, None] == np.arange(growth.classes)
        return (p - one) * w[:, None], np.maximum(2 * p * (1 - p), 1e-16) * w[:, None]
    if growth.objective == SHARES:  # of the row's own class
        return -w[:, None], w[:, None]
    return (-y * w)[:, None], w[:, None]


_SUMS = pa.schema([("slot", pa.int32()), ("sums", pa.binary())])


def _opened(batches: Iterator[pa.RecordBatch], layout: dict, pending: list) -> Iterator[tuple]:
    """(codes, y, w, key, margins) of each block, the trees in ``pending`` added to the margins."""
    grouped, kind, base = layout["grouped"], layout["kind"], layout["base"]
    for batch in batches:
        for row in range(batch.num_rows):
            codes, y, w, key, m = (np.frombuffer(batch.column(i)[row].as_buffer(), t) for i, t in zip(range(1, 6), (kind, "f8", "f8", "i8", "f8")))
            codes = codes.reshape(-1, len(grouped))
            m = m.reshape(-1, len(base)).copy() if len(m) else np.tile(base, (len(y), 1))
            if pending:
                for gradient, tree in pending:
                    m[:, gradient] += tree.values[tree.walk(codes, grouped), 0]
            yield codes, y, w, key, m


def _counter(layout: dict, growth: Growth, scales: tuple[float, float], pending: list, trees: list):
    """Per task the histograms of the wanted nodes of each tree: (gradient, number, shape, {node: slot})."""
    offsets, grouped = layout["offsets"], layout["grouped"]
    cells, width = int(offsets[-1]), layout["width"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for codes, y, w, key, margins in _opened(batches, layout, pending):
            g, h = gradients(growth, y, w, margins)
            g, h = np.rint(g * scales[0]), np.rint(h * scales[1])
            flat = codes + offsets[:-1]
            for number, gradient, shape, wanted in trees:
                own = Tree(*shape, None, None).walk(codes, grouped)
                slots = np.full(len(shape[0]), -1, np.int64)
                for k, node in enumerate(wanted):
                    slots[node] = k
                place = slots[own]
                keep = place >= 0
                times = None
                if growth.bootstrap:
                    times = draws_of(key, growth.seed, number)
                    keep &= times > 0
                if not keep.any():
                    continue
                at = (flat[keep] + (place[keep] * cells)[:, None]).ravel()
                count = np.ones(int(keep.sum())) if times is None else times[keep].astype(float)
                hessian = h[keep, min(gradient, h.shape[1] - 1)] * count
                many = len(wanted) * cells
                sums = np.empty((many, width), np.int64)
                if growth.objective == SHARES:
                    # a row has one class, so all classes are one count
                    by_class = at * growth.classes + np.repeat(y[keep].astype(np.int64), len(grouped))
                    sums[:, :-2] = -np.bincount(by_class, np.repeat(hessian, len(grouped)), many * growth.classes).reshape(many, -1)
                else:
                    sums[:, 0] = np.bincount(at, np.repeat(g[keep, gradient] * count, len(grouped)), many)
                for place, stat in ((-2, hessian), (-1, count)):
                    sums[:, place] = np.bincount(at, np.repeat(stat, len(grouped)), many)
                for k, slot in enumerate(wanted.values()):
                    part = sums[k * cells : (k + 1) * cells]
                    total[slot] = total[slot] + part if slot in total else part.copy()
        for slot, part in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([part.tobytes()], pa.binary())], schema=_SUMS)

    return work


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for slot, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            part = np.frombuffer(data.as_buffer(), np.int64)
            total[slot] = total[slot] + part if slot in total else part
    for slot, part in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([part.tobytes()], pa.binary())], schema=_SUMS)


class Grower:
    """Grows trees on coded rows, from the margins ``base`` on. ``largest`` bounds the gradients' and hessians' size."""

    SUM_BITS = 60  # of a sum over all rows

    def __init__(self, codes: Codes, growth: Growth, base: Sequence[float], largest: tuple[float, float]) -> None:
        self.codes, self.growth, self.frame = codes, growth, codes.frame
        self.offsets = codes.offsets
        self.grouped = np.array([c.cuts is None for c in codes.columns])
        self.width = (growth.classes if growth.objective == SHARES else 1) + 2
        bits = min(36, self.SUM_BITS - max(1, codes.rows).bit_length())
        self.scales = tuple(2.0 ** (bits - math.frexp(max(x, 1e-300))[1]) for x in largest)
        self.layout = {
            "offsets": self.offsets, "grouped": self.grouped, "kind": "<u2" if codes.wide else "u1", "base": np.array(base, float), "width": self.width,
        }
        self.pending: list = []
        self.refreshed = 0
        column_of = np.repeat(np.arange(len(codes.columns)), [c.cells for c in codes.columns])
        self.column_of, self.code_of = column_of, np.arange(int(self.offsets[-1])) - self.offsets[column_of]
        last = self.offsets[1:] - 1
        self.possible = np.ones(len(column_of), bool)
        self.possible[last[~self.grouped]] = False  # nothing is right of the last cell
        self.possible[self.offsets[:-1][self.grouped]] = False  # cell 0 of a group: none is set
        self.feature_of = np.array([
            c.features[0] if c.cuts is not None else (c.features[k - 1] if k else -1) for c in codes.columns for k in range(c.cells)
        ], np.int64)

    # sums: int64 (..., G..., H, rows) -> floats
    def _float(self, sums: np.ndarray) -> np.ndarray:
        out = sums.astype(float)
        out[..., :-2] /= self.scales[0]
        out[..., -2] /= self.scales[1]
        return out

    def _score(self, sums: np.ndarray) -> np.ndarray:
        h = sums[..., -2] + self.growth.l2
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(h > 0, (sums[..., :-2] ** 2).sum(axis=-1) / h, 0.0)

    def _values(self, sums: np.ndarray) -> np.ndarray:
        h = sums[:, -2:-1] + self.growth.l2
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(h > 0, -sums[:, :-2] / h, 0.0)

    def _find_splits(self, tree: _Growing, nodes: list[_Node]) -> None:
        """The best split of each node, if it has one; many nodes at a time."""
        at_once = max(1, SPLIT_BYTES // (len(self.column_of) * self.width * 8))
        for begin in range(0, len(nodes), at_once):
            self._find_some(tree, nodes[begin : begin + at_once])

    def _find_some(self, tree: _Growing, nodes: list[_Node]) -> None:
        growth, cells = self.growth, np.stack([n.histogram for n in nodes])
        total = np.stack([n.sums for n in nodes])[:, None, :]
        running = np.concatenate([np.zeros((len(nodes), 1, self.width), np.int64), np.cumsum(cells, axis=1)], axis=1)
        before = running[:, self.offsets[:-1][self.column_of]]
        left = np.where(self.grouped[self.column_of][:, None], total - cells, running[:, 1:] - before)
        right = total - left
        a, b, whole = self._float(left), self._float(right), self._float(total)
        fits = self.possible & (left[..., -1] >= growth.least_rows) & (right[..., -1] >= growth.least_rows) & (left[..., -1] > 0) & (right[..., -1] > 0)
        fits &= (a[..., -2] >= growth.least_hessian) & (b[..., -2] >= growth.least_hessian)
        parent = self._score(whole)
        gains = np.where(fits, self._score(a) + self._score(b) - parent, -np.inf)
        floors = np.maximum(2 * growth.least_gain, 1e-10 * np.maximum(np.abs(parent[:, 0]), 1e-30))
        for node, own, gain, floor in zip(nodes, left, gains, floors):
            node.split = None
            if growth.features_per_node:
                features = np.unique(self.feature_of[self.feature_of >= 0])
                order = np.random.default_rng([growth.seed & 0x7FFFFFFF, tree.number, node.path & 0x7FFFFFFFFFFF]).permutation(features)
                few = np.where(np.isin(self.feature_of, order[: growth.features_per_node]), gain, -np.inf)
                # of the rest only if none of these splits the node
                gain = few if few.max(initial=-np.inf) > floor else gain
            best = int(np.argmax(gain))
            if gain[best] > floor:
                node.split = (float(gain[best]), int(self.column_of[best]), int(self.code_of[best]), own[best].copy())

    def _histograms(self, asked: list[tuple[_Growing, int]]) -> dict[tuple[int, int], np.ndarray]:
        """The histograms of (tree, node), as many a job as fit the limit."""
        size = int(self.offsets[-1]) * self.width * 8
        at_once = max(1, HISTOGRAM_BYTES // size)
        found: dict[tuple[int, int], np.ndarray] = {}
        for begin in range(0, len(asked), at_once):
            part = asked[begin : begin + at_once]
            trees: dict[int, tuple] = {}
            names = {}
            for slot, (tree, node) in enumerate(part):
                names[slot] = (id(tree), node)
                trees.setdefault(id(tree), (tree.number, tree.gradient, tree.shape(), {}))[3][node] = slot
            work = _counter(self.layout, self.growth, self.scales, self.pending, list(trees.values()))
            counted = map_batches(self.frame, work, "slot int, sums binary")
            spread = max(1, int(self.frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))
            merged = map_batches(counted.repartition(min(spread, len(part)), "slot"), _merge, "slot int, sums binary")
            for row in merged.collect():
                found[names[row["slot"]]] = np.frombuffer(row["sums"], np.int64).reshape(-1, self.width)
        empty = np.zeros((int(self.offsets[-1]), self.width), np.int64)
        return {(id(t), n): found.get((id(t), n), empty) for t, n in asked}

    def _children(self, tree: _Growing, at: int) -> None:
        node = tree.nodes[at]
        left = node.split[3]
        node.kids = (len(tree.nodes), len(tree.nodes) + 1)
        for bit, sums in ((0, left), (1, node.sums - left)):
            tree.nodes.append(_Node(node.depth + 1, sums, (node.path * 2 + bit + 1) & 0x7FFFFFFFFFFFFFFF))

    def _may_split(self, node: _Node) -> bool:
        enough = node.sums[-1] >= 2 * max(1, self.growth.least_rows)
        return node.depth < self.growth.max_depth and enough and node.sums[-2] / self.scales[1] >= 2 * self.growth.least_hessian

    def _open(self, tree: _Growing, at: int) -> None:
        node = tree.nodes[at]
        if node.histogram is not None:
            self._find_splits(tree, [node])
        if node.split:
            heapq.heappush(tree.heap, (-node.split[0], at))

    def grow(self, trees: list[_Growing]) -> list[Tree]:
        """Grow all ``trees`` together."""
        if not self.codes.columns:
            raise ValueError("no feature to split by")
        for tree in trees:
            tree.nodes = [_Node(0, np.zeros(self.width, np.int64), 0)]
        first = self._histograms([(t, 0) for t in trees])
        one = slice(int(self.offsets[0]), int(self.offsets[1]))
        for tree in trees:
            root = tree.nodes[0]
            root.histogram = first[id(tree), 0]
            root.sums = root.histogram[one].sum(axis=0)
            if self._may_split(root):
                self._open(tree, 0)
        while True:
            asked, ahead = [], []
            for tree in trees:
                todo = self._commit(tree)
                for at in todo:
                    self._children(tree, at)
                    kids = [tree.nodes[k] for k in tree.nodes[at].kids]
                    if any(self._may_split(k) for k in kids):
                        small = int(kids[1].sums[-1] < kids[0].sums[-1])
                        asked.append((tree, tree.nodes[at].kids[small]))
                        ahead.append((tree, at, small))
                    else:
                        tree.nodes[at].histogram = None
            if not asked and all(self._settled(t) for t in trees):
                break
            found = self._histograms(asked) if asked else {}
            counted: dict[int, tuple[_Growing, list[_Node]]] = {}
            for tree, at, small in ahead:
                node = tree.nodes[at]
                kids = [tree.nodes[k] for k in node.kids]
                own = found[id(tree), node.kids[small]]
                for kid, cells in ((kids[small], own), (kids[1 - small], node.histogram - own)):
                    if self._may_split(kid):
                        kid.histogram = cells
                        counted.setdefault(id(tree), (tree, []))[1].append(kid)
                node.histogram = None
            for tree, nodes in counted.values():
                self._find_splits(tree, nodes)
        return [self._finished(t) for t in trees]

    def _room(self, tree: _Growing) -> int:
        return (self.growth.leaves or 1 << 60) - tree.count

    def _commit(self, tree: _Growing) -> list[int]:
        """Split leaves whose children are known, the best first; returns leaves whose children must be counted."""
        todo: list[tuple] = []
        while tree.heap and self._room(tree) > 0:
            entry = heapq.heappop(tree.heap)
            node = tree.nodes[entry[1]]
            if node.kids is None:
                todo.append(entry)
                if self.growth.leaves is not None:
                    break
                continue
            node.taken = True
            tree.count += 1
            for kid in node.kids:
                if tree.nodes[kid].split:
                    heapq.heappush(tree.heap, (-tree.nodes[kid].split[0], kid))
        if self.growth.leaves is not None and todo:
            # no more leaves than there is room for can be split before this one's children
            rest = [e for e in heapq.nsmallest(self._room(tree), tree.heap) if tree.nodes[e[1]].kids is None]
            for entry in todo:
                heapq.heappush(tree.heap, entry)
            return [e[1] for e in todo + rest]
        for entry in todo:
            heapq.heappush(tree.heap, entry)
        return [e[1] for e in todo]

    def _settled(self, tree: _Growing) -> bool:
        return not tree.heap or self._room(tree) <= 0

    def _finished(self, tree: _Growing) -> Tree:
        """Only the nodes that were split, and their children."""
        column, cut, left, right, sums = [], [], [], [], []

        def add(at: int) -> int:
            node, here = tree.nodes[at], len(column)
            for out, v in ((column, -1), (cut, 0), (left, 0), (right, 0)):
                out.append(v)
            sums.append(node.sums)
            if node.taken:
                column[here], cut[here] = node.split[1], node.split[2]
            return here

        stack = [(0, add(0))]
        while stack:
            at, here = stack.pop()
            if tree.nodes[at].taken:
                a, b = tree.nodes[at].kids
                left[here], right[here] = add(a), add(b)
                stack += [(a, left[here]), (b, right[here])]
        whole = self._float(np.array(sums))
        return Tree(*[np.array(x, np.int64) for x in (column, cut, left, right)], self._values(whole), whole[:, :-1])

    # --- boosting

    def push(self, trees: list[tuple[int, Tree]]) -> None:
        """Add fitted trees to the rows' margins: at once in every later job, and into the rows now and then."""
        self.pending += trees
        if len(self.pending) < REFRESH * len(self.layout["base"]):
            return
        work = _remargin(self.layout, self.pending)
        self.refreshed += 1
        new = map_batches(self.frame, work, CODED)
        new = cut_lineage(new) if self.refreshed % REFRESHES_PER_CUT == 0 else new
        new = new.persist(StorageLevel.MEMORY_AND_DISK)
        new.agg(F.sum("n")).first()
        self.release()
        self.frame, self.pending = new, []

    def release(self) -> None:
        if self.frame is not self.codes.frame:
            self.frame.unpersist()


def _remargin(layout: dict, pending: list):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, y, w, key, m in _opened(batches, layout, pending):
            values = (len(y), codes.tobytes(), y.tobytes(), w.tobytes(), key.tobytes(), m.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _CODED.types)], schema=_CODED)

    return work


# --- ensembles ----------------------------------------------------------------------------------


@dataclass
class Ensemble:
    """Trees per output with thresholds in the features' own units: margin k is ``base[k]`` plus its trees' values."""

    base: list[float]
    trees: list[tuple[int, list[tuple]]]  # output, nodes: (feature, threshold, left, right, value, class weights); feature -1 is a leaf
    d: int

    @property
    def nodes(self) -> int:
        return sum(len(t) for _, t in self.trees)


def in_features(tree: Tree, columns: list[Column], scale: float = 1.0) -> list[tuple]:
    """A tree's nodes by feature and threshold: at or below it goes left."""
    out = []
    for i in range(len(tree.column)):
        j, feature, threshold = int(tree.column[i]), -1, 0.0
        if j >= 0 and columns[j].cuts is not None:
            feature, threshold = columns[j].features[0], float(columns[j].cuts[tree.cut[i]])
        elif j >= 0:
            feature, threshold = columns[j].features[int(tree.cut[i]) - 1], 0.5
        out.append((feature, threshold, int(tree.left[i]), int(tree.right[i]), float(tree.values[i][0]) * scale, tree.sums[i][:-1].tolist()))
    return out


@dataclass(frozen=True)
class Labels:
    """What a fit must know of its target: weighted mean, class weights, the largest values."""

    mean: float
    shares: list[float]
    largest_y: float
    spread: float
    largest_w: float


def _labels(k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, wy, by = 0.0, 0.0, np.zeros(max(k, 1))
        low, high, w_max = math.inf, -math.inf, 0.0
        for block in opened(batches, None):
            n, wy = n + block.w.sum(), wy + (block.w * block.y).sum()
            if k:
                by += np.bincount(block.y.astype(np.int64), block.w, k)[:k]
            if block.n:
                low, high, w_max = min(low, block.y.min()), max(high, block.y.max()), max(w_max, block.w.max())
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (n, wy, by.tolist(), low, high, w_max)], names=["n", "wy", "s", "low", "high", "w"])

    return work


def labels_of(blocks: Blocks, k: int) -> Labels:
    return blocks.once(("labels", k), lambda: _labels_of(blocks, k))


def _labels_of(blocks: Blocks, k: int) -> Labels:
    schema = "n double, wy double, s array<double>, low double, high double, w double"
    parts = map_batches(blocks.frame.select("n", "y", "w"), _labels(k), schema).collect()  # one small row a task
    n = math.fsum(p["n"] for p in parts)
    low, high = min((p["low"] for p in parts), default=0.0), max((p["high"] for p in parts), default=0.0)
    shares = [math.fsum(p["s"][i] for p in parts) / n for i in range(k)] if n else []
    if not n:
        raise ValueError("no row to learn from")
    mean = float(f"{math.fsum(p['wy'] for p in parts) / n:.12g}")  # the same in whatever order tasks add up
    return Labels(mean, [float(f"{s:.12g}") for s in shares], max(abs(low), abs(high)), high - low, max(p["w"] for p in parts))


@dataclass(frozen=True)
class Start:
    """The margins from which boosting starts, bounds of its gradients and hessians, and each round's rate."""

    base: list[float]
    largest: tuple[float, float]
    rates: list[float]

    @property
    def outputs(self) -> int:
        return len(self.base)


def start_of(labels: Labels, growth: Growth, rounds: int, rate: float) -> Start:
    safe = lambda p: min(max(p, 1e-12), 1 - 1e-12)
    rates = [rate] * rounds
    if growth.objective == SQUARED:
        return Start([labels.mean], (max(labels.spread, 1e-12) * labels.largest_w, labels.largest_w), rates)
    if growth.objective == RESIDUAL:
        # from 0 on; the first tree is of the target itself, taken whole: half of what twice the residual would give
        largest = 2 * max(labels.largest_y + labels.spread, 1e-12) * labels.largest_w
        return Start([0.0], (largest, labels.largest_w), [0.5, *rates[1:]])
    if growth.objective == LOGISTIC:
        return Start([math.log(safe(labels.mean) / (1 - safe(labels.mean)))], (labels.largest_w, labels.largest_w), rates)
    return Start([math.log(safe(s)) for s in labels.shares], (labels.largest_w, labels.largest_w), rates)


def boosting_labels(blocks: Blocks, growth: Growth) -> Labels:
    return labels_of(blocks, growth.classes if growth.objective == SOFTMAX else 0)


def boosted_trees(grower: Grower, start: Start) -> Iterator[tuple[int, Tree]]:
    """(output, tree with its rate taken into the values), round by round. With K outputs a round grows K trees together."""
    for rate in start.rates:
        made = grower.grow([_Growing(0, k) for k in range(start.outputs)])
        for tree in made:
            tree.values = tree.values * rate
        yield from enumerate(made)
        grower.push(list(enumerate(made)))
    grower.release()


def boosted(blocks: Blocks, growth: Growth, rounds: int, rate: float, max_bins: int) -> Ensemble:
    """Boosting by passes over the rows. With K classes a round grows K trees together from the same jobs."""
    start = start_of(boosting_labels(blocks, growth), growth, rounds, rate)
    codes = coded(blocks, max_bins)
    grower = Grower(codes, growth, start.base, start.largest)
    return Ensemble(start.base, [(k, in_features(tree, codes.columns)) for k, tree in boosted_trees(grower, start)], blocks.d)


def averaged(blocks: Blocks, growth: Growth, n_trees: int, max_bins: int) -> Ensemble:
    """A forest (or one tree): class shares in the leaves, or means."""
    labels = labels_of(blocks, 0)
    codes = coded(blocks, max_bins)
    y_max = 1.0 if growth.objective == SHARES else max(labels.largest_y, 1e-12)
    grower = Grower(codes, growth, [0.0], (y_max * labels.largest_w, labels.largest_w))
    out = Ensemble([0.0], [], blocks.d)
    for tree in grower.grow([_Growing(t, 0) for t in range(n_trees)]):
        out.trees.append((0, in_features(tree, codes.columns, 1.0 if growth.objective == SHARES else 1 / n_trees)))
    return out


# --- as models of the library that Spark brings ---------------------------------------------------

REGRESSION_FOREST, CLASS_FOREST = "GBTRegressionModel", "RandomForestClassificationModel"
_TREE = {REGRESSION_FOREST: "regression.DecisionTreeRegressionModel", CLASS_FOREST: "classification.DecisionTreeClassificationModel"}
_FOREST = {REGRESSION_FOREST: "regression.GBTRegressionModel", CLASS_FOREST: "classification.RandomForestClassificationModel"}


def write_forest(spark: SparkSession, path: str, trees: list[list[tuple]], d: int, classes: int = 0) -> None:
    """Trees (``Ensemble.trees``) in the layout in which MLlib saves its ensembles, so that it loads and applies them.

    Without ``classes`` the model adds up the leaves' values; with them it averages the leaves' class shares.
    """
    kind = CLASS_FOREST if classes else REGRESSION_FOREST
    impurity = {"impurity": "gini" if classes else "variance"}
    about = {"timestamp": 0, "sparkVersion": spark.version, "paramMap": impurity, "defaultParamMap": {}}
    head = {"class": f"org.apache.spark.ml.{_FOREST[kind]}", **about, "uid": "forest", "numFeatures": d, "numTrees": len(trees)}
    each = json.dumps({"class": f"org.apache.spark.ml.{_TREE[kind]}", **about, "uid": "tree"})
    if classes:
        head["numClasses"] = classes
    split_type = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
    node_type = pa.struct([
        ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()),
        ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", split_type),
    ])
    schema = pa.schema([("treeID", pa.int32()), ("nodeData", node_type)])
    batches = []
    for t, nodes in enumerate(trees):  # a tree at a time: hundreds of large trees are millions of values
        rows = []
        for i, (feature, threshold, left, right, value, sums) in enumerate(nodes):
            inner = feature >= 0
            stats = [-s for s in sums] if classes else [1.0, value, value * value]
            best = float(max(range(classes), key=lambda k: stats[k])) if classes else value
            split = {"featureIndex": feature, "leftCategoriesOrThreshold": [threshold] if inner else [], "numCategories": -1}
            rows.append({
                "id": i, "prediction": best, "impurity": 0.0, "impurityStats": stats, "rawCount": 1, "gain": 0.0 if inner else -1.0,
                "leftChild": left if inner else -1, "rightChild": right if inner else -1, "split": split,
            })
        batches.append(pa.RecordBatch.from_arrays([pa.array([t] * len(rows), pa.int32()), pa.array(rows, node_type)], schema=schema))
    table = pa.Table.from_batches(batches, schema)
    spark.createDataFrame(table).write.mode("overwrite").parquet(f"{path}/data")
    spark.createDataFrame([(t, each, 1.0) for t in range(len(trees))], "_1 int, _2 string, _3 double").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/treesMetadata"
    )
    spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def models_of(spark: SparkSession, ensemble: Ensemble, path: str, classes: int = 0) -> list:
    """The ensemble as loaded models: one per margin, or one with class shares."""
    if classes:
        write_forest(spark, f"{path}/0", [nodes for _, nodes in ensemble.trees], ensemble.d, classes)
        return [RandomForestClassificationModel.load(f"{path}/0")]
    out = []
    for k, base in enumerate(ensemble.base):
        start = [[(-1, 0.0, -1, -1, base, [])]]
        write_forest(spark, f"{path}/{k}", start + [nodes for at, nodes in ensemble.trees if at == k], ensemble.d)
        out.append(GBTRegressionModel.load(f"{path}/{k}"))
    return out
