"""Whitening of embeddings by shifted CholeskyQR.

Vectors become whole numbers, x = floor(1024 c) + 100000, whose count and sums are exact. The
centred rows X are never formed as a table: each pass reads the vectors, centres them, applies the
triangular solves found so far, and adds up one Gram matrix a task, d by d numbers. Pass one factors
the Gram matrix with a shift, which keeps the factorisation alive however badly conditioned the
rows are; two more passes orthogonalise Q again, so that X = Q R with R the product of the three
factors. The SVD of R, d by d, gives the principal axes and their variances to double precision,
where the covariance itself would lose half of the digits.

What comes to the driver are d by d sums, whatever the number of rows; ``MOST_DIMENSIONS`` bounds d.

Rows without a vector, or whose vector has null, NaN or infinite entries or entries whose whole number
is no long, are left out, and so are vectors of another length than most have (of equally frequent
lengths the longest counts; length 0 never). Repeated rows count each. Directions without variance have the eigenvalue 0; along them
``whitened`` and ``explained`` are 0 and the identity error ignores them. ``deviation`` is exact; it
is null where it doesn't fit a long. Other columns are ignored. A table without vectors gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm.common import map_batches

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
MOST_DIMENSIONS = 4096
#: Entries of this size and more have no whole number that fits a long.
LARGEST = 2.0**52
#: Vectors that a task holds as doubles at once.
ROWS_AT_ONCE = 2048
_ROUND = np.finfo(np.float64).eps / 2


def usable(table: DataFrame, name: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, embedding) of the rows with a vector of finite numbers, as doubles."""
    values = F.col(vector).cast("array<double>")
    rows = table.select(F.col(name).cast("long").alias("vec_id"), values.alias("embedding"))
    finite = F.forall("embedding", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < LARGEST), F.lit(False)))
    return rows.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite)


def _blocks(batches: Iterator[pa.RecordBatch], column: str, d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of at most ``ROWS_AT_ONCE`` rows with their whole numbers."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            c = part.column(part.schema.get_field_index(column)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            yield part, np.floor(SCALE * c).astype(np.int64) + SHIFT


_ROWS = pa.schema([("i", pa.int32()), ("values", pa.list_(pa.float64()))])


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n, from whole numbers as far as they fit."""
    if sums.dtype == object or int(np.abs(x).max(initial=0)) * n >= 1 << 62:
        return x - (sums / n).astype(np.float64)
    return (n * x - sums) / n


def _matrix(sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(list(sums), _ROWS.field(1).type)], schema=_ROWS)


def _summed(vectors: DataFrame, task, d: int, rows: int) -> np.ndarray:
    """The sum over all tasks of the matrices that ``task`` makes of its batches."""
    parts = map_batches(vectors, task, "i int, values array<double>")
    cells = parts.select("i", F.posexplode("values").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    found = np.zeros((rows, d))
    for i, j, v in cells.toLocalIterator():
        found[i, j] = v
    return found


def _gram(d: int, n: int, sums: np.ndarray, factors: list[np.ndarray]):
    """Per task the Gram matrix of its centred rows behind the solves with ``factors``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _blocks(batches, "embedding", d):
            y = _solved(_centred(x, n, sums), factors)
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield _matrix(total)

    return work


def _solved(y: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``y`` behind the triangular solves with each factor in turn."""
    for r in factors:
        y = np.linalg.solve(r.T, y.T).T
    return y


@dataclass
class Whitening:
    """n vectors with their sums; principal axes as columns, by falling variance; the covariance's trace."""

    n: int
    sums: np.ndarray
    axes: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def projection(self) -> np.ndarray:
        """Whitened values are the centred row times this; zero along directions without variance."""
        scale = np.where(self.variances > 0, 1 / np.sqrt(np.where(self.variances > 0, self.variances, 1)), 0)
        return self.axes * scale

    @property
    def explained(self) -> np.ndarray:
        return self.variances / self.trace if self.trace > 0 else np.zeros(len(self.variances))


def _factor(gram: np.ndarray, shift: float) -> np.ndarray:
    """The upper triangular R with R'R = gram + shift; a larger shift where rounding made it indefinite."""
    d = len(gram)
    step = max(shift, 4 * d * _ROUND * float(np.trace(gram)), np.finfo(np.float64).tiny)
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(2 * shift, step)


def dimension(vectors: DataFrame) -> int:
    """The most frequent length, the longest of equals; 0 without vectors. Lengths are few: one row each."""
    found = vectors.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = found["d"] if found else 0
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors have {d} entries, more than {MOST_DIMENSIONS}")
    return d


def fitted(vectors: DataFrame, d: int) -> Whitening:
    """Fit on ``vectors`` (``usable`` rows of length ``d``)."""
    whole = F.transform("embedding", lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    cells = vectors.select(F.posexplode(whole).alias("j", "x")).groupBy("j").agg(F.sum(F.col("x").cast("decimal(19,0)")).alias("s"), F.count(F.lit(1)).alias("n"))
    rows = cells.collect()  # one row per dimension
    n, exact = int(rows[0]["n"]), {row["j"]: int(row["s"]) for row in rows}
    fits = max(map(abs, exact.values())) < 1 << 62
    sums = np.array([exact[j] for j in range(d)], np.int64 if fits else object)
    first = _summed(vectors, _gram(d, n, sums, []), d, d)
    squares = float(np.trace(first))
    if squares == 0:
        return Whitening(n, sums, np.eye(d), np.zeros(d), 0.0)
    factors = [_factor(first, 11 * (n * d + d * (d + 1.0)) * _ROUND * squares)]
    for _ in range(2):
        factors.append(_factor(_summed(vectors, _gram(d, n, sums, list(factors)), d, d), 0.0))
    r = factors[2] @ factors[1] @ factors[0]
    _, singular, axes = np.linalg.svd(r)
    variances = singular**2 / n
    # what is left of directions without variance is rounding and the shift
    variances[variances <= variances[0] * max(n, d) * 64 * _ROUND] = 0
    axes = axes.T
    return Whitening(n, sums, axes * np.where(axes[np.abs(axes).argmax(axis=0), range(d)] < 0, -1, 1), variances, squares / n)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact sums of (n x - S)^2."""
    apart = [n * int(v) for v in (x.max(), x.min())] if x.size else [0]
    most = max(abs(a - int(s)) for a in apart for s in (sums.max(), sums.min()))
    if sums.dtype != object and most * most * x.shape[1] < 1 << 63:
        return ((n * x - sums) ** 2).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums.tolist())) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def whitened(vectors: DataFrame, model: Whitening, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, deviation, whitened array) of each vector, map-only."""
    d, n, sums, project = len(model.sums), model.n, model.sums, model.projection[:, :components]
    schema = pa.schema([("vec_id", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, "embedding", d):
            y = _centred(x, n, sums) @ project
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_deviations(x, n, sums), pa.int64()), pa.array(list(y), schema.types[2])], schema=schema)

    return map_batches(vectors, work, "vec_id long, deviation long, whitened array<double>")


def identity_error(vectors: DataFrame, model: Whitening, components: int = COMPONENTS) -> float:
    """The largest absolute entry of the whitened values' covariance minus the identity, over all vectors."""
    project = model.projection[:, :components]
    k = project.shape[1]
    d, n, sums = len(model.sums), model.n, model.sums

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for _, x in _blocks(batches, "embedding", d):
            y = _centred(x, n, sums) @ project
            total[:k] += y.T @ y
            total[k] += y.sum(axis=0)
        yield _matrix(total)

    total = _summed(vectors, work, k, k + 1)
    mean = total[k] / n
    covariance = total[:k] / n - np.outer(mean, mean)
    live = model.variances[:k] > 0
    return float(np.abs(covariance - np.eye(k))[np.ix_(live, live)].max(initial=0.0))


def report(spark: SparkSession, table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per vector and component."""
    vectors = usable(table)
    d = dimension(vectors)
    if not d:
        return spark.createDataFrame(
            [], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        )
    vectors = vectors.where(F.size("embedding") == d)
    model = fitted(vectors, d)
    error = identity_error(vectors, model, components)
    rows = whitened(vectors, model, components).select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    explained = F.element_at(F.lit(model.explained[:components].tolist()), F.col("k") + 1)
    return rows.select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        explained.alias("explained"), F.lit(error).alias("identity_error"),
    )
