"""Linear models from sums over all rows: lasso from one Gram matrix per training set, logistic regressions by Newton steps.

Rows are read in Arrow batches where they lie; each task passes on matrices of features squared
numbers, merged per training set. The driver solves for any number of penalties at once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.batches import map_batches
from tabwright.operators.blocks import Blocks, opened

MOST_FEATURES = 2048  # a Gram matrix of 32 MB
MOST_PARAMETERS = 1024  # of one logistic model that Newton steps are taken for
TERMS = 200  # a longer sum is written as a loop over the vector


@dataclass
class LinearModel:
    """One row of ``coefficients`` and one intercept per output."""

    coefficients: list[list[float]]
    intercepts: list[float]

    def margins(self, features: str) -> list[Column]:
        vector = vector_to_array(F.col(features))
        return [self._sum(vector, row, b) for row, b in zip(self.coefficients, self.intercepts)]

    def _sum(self, vector: Column, row: list[float], intercept: float) -> Column:
        used = [(i, c) for i, c in enumerate(row) if c]
        if len(used) > TERMS:
            products = F.zip_with(vector, F.lit(row), lambda x, c: x * c)
            return F.aggregate(products, F.lit(float(intercept)), lambda a, p: a + p)
        total = F.lit(float(intercept))
        for i, c in used:
            total = total + F.get(vector, F.lit(i)) * F.lit(float(c))
        return total

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps({"coefficients": self.coefficients, "intercepts": self.intercepts})
        spark.createDataFrame([(text,)], "linear string").coalesce(1).write.mode("overwrite").json(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearModel:
        return cls(**json.loads(spark.read.schema("linear string").json(path).first()["linear"]))


# --- lasso --------------------------------------------------------------------------------------

_CELLS = pa.schema([("slot", pa.int32()), ("cells", pa.binary())])
CELLS = "slot int, cells binary"


def _add(total: dict, slot: int, part: np.ndarray) -> None:
    total[slot] = total[slot] + part if slot in total else part


def _rows_of(total: dict) -> Iterator[pa.RecordBatch]:
    for slot, part in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([np.ascontiguousarray(part).tobytes()], pa.binary())], schema=_CELLS)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for slot, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            _add(total, slot, np.frombuffer(data.as_buffer(), np.float64))
    yield from _rows_of(total)


def _merged(frame: DataFrame, work, slots: int) -> dict[int, np.ndarray]:
    parts = map_batches(frame, work, CELLS).repartition(max(1, min(slots, 32)), "slot")
    return {r["slot"]: np.frombuffer(r["cells"], np.float64) for r in map_batches(parts, _merge, CELLS).collect()}


def _grams(sizes: list[int]):
    """Per training set s the sums over its rows (slot 2 s) and over the rows it leaves out (2 s + 1)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            fold, y, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for s, d in enumerate(sizes):
                x = batch.column(3 + s).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                z = np.column_stack([np.ones(len(y)), x, y])
                inside = fold != s
                # who is left out is scored without weights
                for slot, rows, weight in ((2 * s, inside, w), (2 * s + 1, ~inside, np.ones(len(w)))):
                    if rows.any():
                        own = z[rows]
                        _add(total, slot, own.T @ (own * weight[rows][:, None]))
        yield from _rows_of(total)

    return work


def gram_matrices(frame: DataFrame, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each training set s the Gram matrices of (1, features, target) over its rows and over fold s.

    ``frame`` holds fold, target, weight and one feature array per training set: all of them from one scan.
    """
    if max(sizes) > MOST_FEATURES:
        raise ValueError(f"a lasso on {max(sizes)} features; at most {MOST_FEATURES}")
    found = _merged(frame, _grams(sizes), 2 * len(sizes))
    empty = lambda d: np.zeros((d + 2, d + 2))
    shaped = lambda slot, d: found[slot].reshape(d + 2, d + 2) if slot in found else empty(d)
    return [(shaped(2 * s, d), shaped(2 * s + 1, d)) for s, d in enumerate(sizes)]


def lasso_path(gram: np.ndarray, alphas: Sequence[float], tolerance: float = 1e-12, most_sweeps: int = 100_000) -> dict[float, LinearModel]:
    """Coordinate descent on the mean squared loss / 2 + alpha |b|, from the largest penalty to the smallest."""
    n, d = gram[0, 0], len(gram) - 2
    if n <= 0:
        raise ValueError("no row to learn from")
    means = gram[0, 1:] / n
    centred = gram[1:, 1:] / n - np.outer(means, means)
    a, c = centred[:d, :d], centred[:d, d]
    scale = np.diag(a).copy()
    usable = scale > 1e-12 * np.maximum(np.diag(gram)[1 : d + 1] / n, 1e-300)
    b = np.zeros(d)
    out = {}
    for alpha in sorted(set(alphas), reverse=True):
        left = c - a @ b
        for _ in range(most_sweeps):
            most = 0.0
            for j in np.flatnonzero(usable):
                old = b[j]
                raw = left[j] + scale[j] * old
                b[j] = np.sign(raw) * max(abs(raw) - alpha, 0.0) / scale[j]
                if b[j] != old:
                    left -= a[:, j] * (b[j] - old)
                    most = max(most, abs(b[j] - old) * scale[j] ** 0.5)
            if most <= tolerance * max(centred[d, d], 1e-300) ** 0.5:
                break
        out[alpha] = LinearModel([b.tolist()], [float(means[d] - means[:d] @ b)])
    return out


def squared_error(gram: np.ndarray, model: LinearModel) -> tuple[float, float, float]:
    """(rows, sum of squared errors, sum of squares about the mean) of the rows behind a Gram matrix."""
    v = np.concatenate([[-model.intercepts[0]], -np.array(model.coefficients[0]), [1.0]])
    n = gram[0, 0]
    return n, float(v @ gram @ v), float(gram[-1, -1] - gram[0, -1] ** 2 / n) if n else 0.0


# --- logistic regression ------------------------------------------------------------------------


def _newton_sums(d: int, k: int, betas: np.ndarray):
    """Loss, gradient and Hessian of each of the stacked models (m, k, d + 1) over a task's rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for block in opened(batches, d):
            x = np.column_stack([np.ones(block.n), block.x])
            label = block.y.astype(np.int64)
            rows = np.arange(block.n)
            margins = np.einsum("nd,mkd->mnk", x, betas)
            for m in range(len(betas)):
                if k == 1:
                    z = margins[m, :, 0]
                    p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                    loss = (block.w * (np.logaddexp(0, z) - label * z)).sum()
                    g = x.T @ (block.w * (p - label))
                    h = x.T @ (x * (block.w * p * (1 - p))[:, None])
                else:
                    z = margins[m] - margins[m].max(axis=1, keepdims=True)
                    e = np.exp(z)
                    p = e / e.sum(axis=1, keepdims=True)
                    loss = -(block.w * np.log(np.maximum(p[rows, label], 1e-300))).sum()
                    r = p.copy()
                    r[rows, label] -= 1
                    g = ((r * block.w[:, None]).T @ x).ravel()
                    h = np.empty((k, d + 1, k, d + 1))
                    for i in range(k):
                        for j in range(i, k):
                            s = block.w * p[:, i] * ((i == j) - p[:, j])
                            h[i, :, j, :] = x.T @ (x * s[:, None])
                            h[j, :, i, :] = h[i, :, j, :].T
                    h = h.reshape(k * (d + 1), -1)
                _add(total, m, np.concatenate([[loss], g, h.ravel()]))
        yield from _rows_of(total)

    return work


def logistic_models(blocks: Blocks, n_classes: int, strengths: Sequence[float], most_steps: int = 60, tolerance: float = 1e-10) -> list[LinearModel]:
    """One model per strength C, the summed loss times C plus half the squared coefficients, intercepts free.

    All models advance together: a step is one job, however many they are. A step that doesn't lower a
    model's objective is halved in the next job.
    """
    d, m = blocks.d, len(strengths)
    k = 1 if n_classes == 2 else n_classes
    size = k * (d + 1)
    penalty = np.tile(np.concatenate([[0.0], np.ones(d)]), k)
    betas, best = np.zeros((m, size)), np.full(m, np.inf)
    tried, steps = betas.copy(), np.zeros((m, size))
    halved = np.zeros(m, int)
    open_ = np.ones(m, bool)
    for _ in range(most_steps):
        at = np.flatnonzero(open_)
        if not len(at):
            break
        frame = blocks.frame.select("n", "x", "y", "w")
        sums = _merged(frame, _newton_sums(d, k, tried[at].reshape(len(at), k, d + 1)), len(at))
        for place, i in enumerate(at):
            s = sums.get(place)
            if s is None:
                raise ValueError("no row to learn from")
            c = strengths[i]
            value = c * s[0] + 0.5 * (penalty * tried[i] ** 2).sum()
            if value > best[i] * (1 + 1e-14) + 1e-300 and halved[i] < 30:
                steps[i], halved[i] = steps[i] / 2, halved[i] + 1
                tried[i] = betas[i] + steps[i]
                continue
            betas[i], fall, best[i], halved[i] = tried[i], best[i] - value, value, 0
            gradient = c * s[1 : 1 + size] + penalty * tried[i]
            hessian = c * s[1 + size :].reshape(size, size) + np.diag(penalty)
            # the classes' intercepts may shift together: the smallest step is taken along such directions
            steps[i] = -np.linalg.lstsq(hessian, gradient, rcond=1e-13)[0]
            if abs(gradient @ steps[i]) <= tolerance * max(1.0, abs(value)) * 1e-2 or 0 <= fall <= 1e-15 * abs(value):
                open_[i] = False
                continue
            tried[i] = betas[i] + steps[i]
    out = []
    for beta in betas.reshape(m, k, d + 1):
        rows = beta if k > 1 else beta[:1]
        out.append(LinearModel(rows[:, 1:].tolist(), rows[:, 0].tolist()))
    return out
