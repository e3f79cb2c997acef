"""Exact quantiles without a sort and without holding a column in one task.

``percentile`` keeps every distinct value of a group in one buffer. Here the value range is
narrowed around the wanted ranks instead: each round is one map-side aggregate over the
columns in question, and the exact order statistics are read from a grouped value table once a
bracket holds a bounded number of distinct values.

The next bracket is guessed from a sketch of about a million rows, so the sketches that reach
the last task stay small however many tasks there are. The guess needs no trust: the next
round counts all rows below and inside the bracket, and a bracket that misses a rank is undone.
"""

from __future__ import annotations

import math
from collections.abc import Hashable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EVERY_ROW = None
GRID = 1000
SKETCH_ROWS = 1_000_000
# one text literal: a thousand number literals per column would burden the analyzer
_GRID_POINTS = "cast(split('" + ",".join(str(p / GRID) for p in range(GRID + 1)) + "', ',') as array<double>)"


@dataclass
class _Search:
    """The bracket that holds the wanted rank of one column, for each row mask."""

    name: str
    value: Column
    masks: dict[Hashable, Column | None]
    low: float | None = None
    high: float | None = None
    outer: tuple[float | None, float | None] = (None, None)
    slack: int = 3
    sketch_share: float = 0.0  # share of the rows inside the bracket that the sketch takes
    probing: bool = False  # the bracket leaves out both ends of ``outer``, which are heavy values

    def inside(self) -> Column:
        if self.low is None:
            return self.value
        return F.when(self.value.between(F.lit(self.low), F.lit(self.high)), self.value)

    def below(self) -> Column:
        if self.low is None:
            return F.lit(None).cast("double")
        return F.when(self.value < F.lit(self.low), self.value)

    def separate(self) -> list[_Search]:
        """One search per mask, for masks whose quantiles lie far apart."""
        return [
            _Search(
                self.name, _masked(self.value, mask), {key: EVERY_ROW}, self.low, self.high, self.outer,
                sketch_share=self.sketch_share,
            )
            for key, mask in self.masks.items()
        ]


def exact_quantiles(
    df: DataFrame,
    columns: dict[str, Column],
    q: float,
    masks: dict[Hashable, Column | None] | None = None,
    distinct_limit: int = 100_000,
    known: dict[str, tuple[int, dict[Hashable, int]]] | None = None,
) -> dict[tuple[Hashable, str], float | None]:
    """The interpolated ``q`` quantile of each numeric expression over the rows of each mask.

    Nulls and NaN do not count. Returns {(mask key, column name): quantile}; the mask
    ``EVERY_ROW`` stands for the whole table. All columns share each pass over ``df``. ``known``
    may give (bound on the distinct values, {mask key: values}) of a column where the caller has
    counted before; that saves the first pass.
    """
    masks = masks or {EVERY_ROW: EVERY_ROW}
    searches = [_Search(name, _number(value), dict(masks)) for name, value in columns.items()]
    result: dict[tuple[Hashable, str], float | None] = {}
    measures = None
    if known is not None:
        measures = [_Measured.from_known(*known[search.name]) for search in searches]
    while searches:
        ready, waiting = [], []
        for search, measured in zip(searches, measures or _measure(df, searches)):
            for key in [k for k in search.masks if measured.total(k) == 0]:
                result[key, search.name] = None
                del search.masks[key]
            if not search.masks:
                continue
            holds = all(measured.holds(k, q) for k in search.masks)
            if search.probing and not holds:
                (key,) = search.masks
                result[key, search.name] = measured.at_ends(*search.outer, key, q)
            elif not holds:
                # the sketch misplaced a rank: go back one bracket and cut less tightly
                search.low, search.high = search.outer
                search.slack *= 8
                waiting.append(search)
            elif measured.distinct <= distinct_limit or (search.low is not None and search.low == search.high):
                ready.append((search, measured))
            elif measured.points is None:
                search.sketch_share = min(1.0, SKETCH_ROWS / measured.n_rows)
                waiting.append(search)
            else:
                waiting += _narrow(search, measured, q)
        if ready:
            result.update(_read_off(df, ready, q))
        searches, measures = waiting, None
    return result


def _number(value: Column) -> Column:
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def _masked(value: Column, mask: Column | None) -> Column:
    return value if mask is None else F.when(mask, value)


@dataclass
class _Measured:
    n_rows: int
    distinct: int
    points: list[float] | None
    smallest: float | None
    largest: float | None
    n_in: dict[Hashable, int]
    n_below: dict[Hashable, int]
    n_all: dict[Hashable, int]

    @classmethod
    def from_known(cls, distinct: int, counts: dict[Hashable, int]) -> _Measured:
        below = dict.fromkeys(counts, 0)
        return cls(max(counts.values()), distinct, None, None, None, dict(counts), below, dict(counts))

    def total(self, key: Hashable) -> int:
        return self.n_all[key]

    def position(self, key: Hashable, q: float) -> float:
        return q * (self.n_all[key] - 1)

    def holds(self, key: Hashable, q: float) -> bool:
        position, below = self.position(key, q), self.n_below[key]
        return below <= math.floor(position) and math.ceil(position) < below + self.n_in[key]

    def at_ends(self, low: float, high: float, key: Hashable, q: float) -> float:
        """The quantile when a wanted rank falls on ``low`` or ``high``, just outside the bracket."""
        position, below = self.position(key, q), self.n_below[key]

        def at(rank: int, inner: float) -> float:
            return low if rank < below else high if rank >= below + self.n_in[key] else inner

        first, second = at(math.floor(position), self.largest), at(math.ceil(position), self.smallest)
        return first + (second - first) * (position - math.floor(position))


def _measure(df: DataFrame, searches: list[_Search]) -> list[_Measured]:
    aggregates = []
    grid = F.expr(_GRID_POINTS)
    if any(search.sketch_share for search in searches):
        df = df.withColumn("_pick", F.rand(11))
    for i, search in enumerate(searches):
        inside, below = search.inside(), search.below()
        if search.sketch_share:
            sketched = inside if search.sketch_share == 1 else F.when(F.col("_pick") < search.sketch_share, inside)
            aggregates.append(F.percentile_approx(sketched, grid, 4 * GRID).alias(f"points_{i}"))
        else:
            aggregates.append(F.lit(None).alias(f"points_{i}"))
        aggregates += [
            F.count(inside).alias(f"rows_{i}"),
            F.approx_count_distinct(inside).alias(f"distinct_{i}"),
            F.min(inside).alias(f"smallest_{i}"),
            F.max(inside).alias(f"largest_{i}"),
        ]
        for j, mask in enumerate(search.masks.values()):
            aggregates += [
                F.count(_masked(inside, mask)).alias(f"in_{i}_{j}"),
                F.count(_masked(below, mask)).alias(f"below_{i}_{j}"),
                F.count(_masked(search.value, mask)).alias(f"all_{i}_{j}"),
            ]
    row = df.agg(*aggregates).first()
    return [
        _Measured(
            row[f"rows_{i}"],
            row[f"distinct_{i}"],
            row[f"points_{i}"],
            row[f"smallest_{i}"],
            row[f"largest_{i}"],
            {key: row[f"in_{i}_{j}"] for j, key in enumerate(search.masks)},
            {key: row[f"below_{i}_{j}"] for j, key in enumerate(search.masks)},
            {key: row[f"all_{i}_{j}"] for j, key in enumerate(search.masks)},
        )
        for i, search in enumerate(searches)
    ]


def _narrow(search: _Search, measured: _Measured, q: float) -> list[_Search]:
    shares = [
        (measured.position(key, q) - measured.n_below[key]) / measured.n_in[key] for key in search.masks
    ]
    first = max(0, math.floor(min(shares) * GRID) - search.slack)
    last = min(GRID, math.ceil(max(shares) * GRID) + search.slack)
    low, high = measured.points[first], measured.points[last]
    stuck = (low, high) == (search.low, search.high)
    if (stuck or last - first > GRID // 10) and list(search.masks.values()) != [EVERY_ROW]:
        return search.separate()
    expected = max(1.0, measured.n_rows * (last - first) / GRID)
    search.sketch_share = min(1.0, SKETCH_ROWS / expected)
    search.outer, search.probing = (search.low, search.high), stuck
    if stuck:
        low, high = math.nextafter(low, math.inf), math.nextafter(high, -math.inf)
    search.low, search.high = low, high
    return [search]


def _read_off(df: DataFrame, ready: list[tuple[_Search, _Measured]], q: float) -> dict:
    """Order statistics from one table of (column, value, rows per mask) inside the brackets."""
    pairs = F.array(
        *[
            F.when(search.inside().isNotNull(), F.struct(F.lit(i).alias("id"), search.inside().alias("value")))
            for i, (search, _) in enumerate(ready)
        ]
    )
    masks = {key: mask for search, _ in ready for key, mask in search.masks.items()}
    flags = [F.lit(True) if mask is None else mask for mask in masks.values()]
    in_mask = [f"mask_{j}" for j in range(len(masks))]
    up_to = Window.partitionBy("id").orderBy("value")
    reached = (
        df.select(*[flag.alias(m) for flag, m in zip(flags, in_mask)], F.explode(pairs).alias("p"))
        .where("p IS NOT NULL")
        .groupBy("p.id", "p.value")
        .agg(*[F.count(F.when(F.col(m), 1)).alias(m) for m in in_mask])
        .select("id", "value", *[F.sum(m).over(up_to).alias(m) for m in in_mask])
    )
    wanted, index = [], {}
    for j, key in enumerate(masks):
        ranks = [
            measured.position(key, q) - measured.n_below[key] if key in search.masks else None for search, measured in ready
        ]
        for side, rounded in (("low", math.floor), ("high", math.ceil)):
            rank = F.get(F.array(*[F.lit(None if r is None else rounded(r)).cast("long") for r in ranks]), F.col("id"))
            index[key, side] = f"{side}_{j}"
            wanted.append(F.min(F.when(F.col(in_mask[j]) > rank, F.col("value"))).alias(f"{side}_{j}"))
    found = {}
    for row in reached.groupBy("id").agg(*wanted).collect():  # one row per column
        search, measured = ready[row["id"]]
        for key in search.masks:
            low, high = row[index[key, "low"]], row[index[key, "high"]]
            position = measured.position(key, q)
            found[key, search.name] = low + (high - low) * (position - math.floor(position))
    return found
