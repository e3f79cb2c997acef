"""Feature preparation: impute, rescale and encode, fitted by aggregates, applied as expressions.

All training sets a search needs (the k leave-one-fold-out sets and the whole set) are fitted
together from the same aggregates:

* numeric columns: one aggregate grouped by fold (count, missing, mean, variance, min, max);
  the folds of a training set are merged on the driver, and the effect of imputation on
  mean, variance, min and max is worked out from the counts, so no second pass is needed;
* medians: conditional targets of one shared exact-quantile search;
* categories: one grouped count with a column per fold.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.hashing import quoted
from tabwright.functions.quantiles import exact_quantiles
from tabwright.functions.ranking import dense_codes
from tabwright.operators.split import FOLD_COLUMN
from tabwright.session import cut_lineage
from tabwright.sources.tables import (
    AVERAGE,
    CONSTANT,
    DUMMY,
    MEDIAN,
    MIN_MAX,
    MOST_FREQUENT,
    NO_RESCALING,
    ORDINAL,
    STANDARD,
    is_missing,
    role_of,
)

OWN_PREFIX = "_tabwright_"  # of all columns that stand beside a user's for a while
FEATURES = f"{OWN_PREFIX}features"
WHOLE = -1  # the training set that leaves out no fold
COLUMNS_PER_PASS = 60  # a wider aggregate would no longer compile; each pass reads only its columns
BROADCAST_VALUES = 200_000
BROADCAST_CHARS = 32_000_000
MISSING_KEYS = 10_000


@dataclass(frozen=True)
class FeatureSpec:
    """One feature column and its treatment."""

    name: str
    encoding: str
    imputation: str
    constant: object = None
    max_categories: int = 10


@dataclass
class ColumnPlan:
    """What was learned about one feature."""

    name: str
    encoding: str
    fill: object = None
    center: float = 0.0
    scale: float = 1.0
    kept: list[str] = field(default_factory=list)
    has_rare: bool = False
    dictionary_rows: int = 0
    dictionary_chars: int = 0
    fill_code: float = -1.0  # the code of the value that missing rows take
    empty: bool = False

    @property
    def outputs(self) -> list[str]:
        if self.empty:
            return []
        if self.encoding != DUMMY:
            return [self.name]
        slots = [f"{self.name}={value}" for value in self.kept]
        return slots + [f"{self.name}=(rare)"] if self.has_rare else slots


@dataclass
class PrepModel:
    """Fitted preparation: column plans, and the value dictionary of ordinal features."""

    plans: list[ColumnPlan]
    dictionary: DataFrame | None = None  # feature, value, code

    @property
    def outputs(self) -> list[str]:
        return [name for plan in self.plans for name in plan.outputs]

    def columns(self, df: DataFrame) -> tuple[DataFrame, list[Column]]:
        """The output expressions, and the frame (with dictionary codes joined) to select them from."""
        columns: list[Column] = []
        raw, sent_values, sent_chars = df, 0, 0
        for position, plan in enumerate(self.plans):
            if plan.empty:
                continue
            value = clean_value(df, plan)
            if plan.encoding in (STANDARD, MIN_MAX, NO_RESCALING):
                filled = F.coalesce(value, F.lit(plan.fill).cast("double"))
                columns.append(((filled - F.lit(plan.center)) / F.lit(plan.scale)).alias(plan.name))
            elif plan.encoding == DUMMY:
                columns += dummy_columns(F.coalesce(value, F.lit(plan.fill)), plan)
            else:
                code = f"{OWN_PREFIX}code_{position}"
                # all dictionaries of a plan together stay within the limits of a broadcast
                sent_values, sent_chars = sent_values + plan.dictionary_rows, sent_chars + plan.dictionary_chars
                small = sent_values <= BROADCAST_VALUES and sent_chars <= BROADCAST_CHARS
                if not small:
                    sent_values, sent_chars = sent_values - plan.dictionary_rows, sent_chars - plan.dictionary_chars
                df = self._join_codes(df, plan, value, code, small, raw.columns)
                found = F.coalesce(F.col(code), F.lit(-1.0))
                columns.append(F.when(value.isNull(), F.lit(plan.fill_code)).otherwise(found).alias(plan.name))
        return df, columns

    def _join_codes(self, df: DataFrame, plan: ColumnPlan, value: Column, code: str, small: bool, names: list[str]) -> DataFrame:
        """Codes of the values that are there. Missing rows, which may be many, need no lookup: in a
        shuffled join they are spread over keys that no dictionary has."""
        key = f"{code}_value"
        codes = self.dictionary.where(F.col("feature") == plan.name).select(
            F.col("value").alias(key), F.col("code").cast("double").alias(code)
        )
        if small:
            return df.withColumn(key, value).join(F.broadcast(codes), key, "left").drop(key)
        apart = F.concat(F.lit("\0missing "), F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in names]), F.lit(MISSING_KEYS)).cast("string"))
        return df.withColumn(key, F.coalesce(value, apart)).join(codes, key, "left").drop(key)

    def transform(self, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
        """Append the feature vector to ``keep`` (default: all) columns."""
        return self.beside(df, [F.col(quoted(c)) for c in (df.columns if keep is None else keep)])

    def beside(self, df: DataFrame, others: Sequence[Column]) -> DataFrame:
        """The feature vector beside other expressions of the raw columns, from one projection.

        Whatever the others are called, features are read from the raw columns.
        """
        frame, columns = self.columns(df)
        if not columns:
            raise ValueError("no feature has a value to learn from")
        slots = [f"{OWN_PREFIX}slot_{i}" for i in range(len(columns))]
        frame = frame.select(*others, *[c.alias(slot) for c, slot in zip(columns, slots)])
        assembler = VectorAssembler(inputCols=slots, outputCol=FEATURES, handleInvalid="keep")
        return assembler.transform(frame).drop(*slots)

    def arrays(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with the outputs as one array column."""
        frame, columns = self.columns(df)
        if not columns:
            raise ValueError("no feature has a value to learn from")
        made = frame.withColumn(name, F.array(*[c.cast("double") for c in columns]))
        return made.select(*[F.col(quoted(c)) for c in df.columns], name)

    def transform_columns(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """Append one double column per output instead of a vector."""
        frame, columns = self.columns(df)
        return frame.select(*[F.col(quoted(c)) for c in keep], *columns)

    def filled(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` columns and every feature with its missing values replaced, not yet encoded."""
        values = [
            F.coalesce(clean_value(df, p), F.lit(p.fill)).alias(p.name) for p in self.plans if not p.empty
        ]
        return df.select(*[F.col(quoted(c)) for c in keep], *values)

    def statistics(self, spark: SparkSession) -> DataFrame:
        """What was learned, one row per feature."""
        rows = [
            (p.name, p.encoding, None if p.fill is None else str(p.fill), float(p.center), float(p.scale), p.kept, p.has_rare)
            for p in self.plans
        ]
        return spark.createDataFrame(
            rows,
            "feature string, encoding string, fill string, center double, scale double, kept array<string>, has_rare boolean",
        )

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps([asdict(plan) for plan in self.plans])
        spark.createDataFrame([(text,)], "plans string").coalesce(1).write.mode("overwrite").json(f"{path}/plans")
        if self.dictionary is not None:
            self.dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> PrepModel:
        text = spark.read.schema("plans string").json(f"{path}/plans").first()["plans"]
        plans = [ColumnPlan(**plan) for plan in json.loads(text)]
        needs_dictionary = any(p.encoding == ORDINAL and not p.empty for p in plans)
        dictionary = spark.read.parquet(f"{path}/dictionary") if needs_dictionary else None
        return cls(plans, dictionary)


def clean_value(df: DataFrame, plan: ColumnPlan | FeatureSpec) -> Column:
    """The raw value with missing as null: a double for rescaling, text for encoding."""
    target = "string" if plan.encoding in (DUMMY, ORDINAL) else "double"
    column, kind = F.col(quoted(plan.name)), df.schema[plan.name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        column = F.when(column == 0, F.lit(0.0).cast(kind)).otherwise(column)  # 0.0 and -0.0 are one value
    return F.when(~is_missing(df, plan.name), column.cast(target))


def _numeric_names(df: DataFrame, specs: Sequence[FeatureSpec]) -> list[str]:
    return [s.name for s in specs if role_of(df.schema[s.name].dataType) == "numeric"]


def _number(numeric: Sequence[str]) -> Column:
    """The value of a numeric feature as a number, by which it is ordered; null for text."""
    if not numeric:
        return F.lit(None).cast("double")
    return F.when(F.col("feature").isin(list(numeric)), F.col("value").try_cast("double"))


def dummy_columns(value: Column, plan: ColumnPlan) -> list[Column]:
    def flag(condition: Column, name: str) -> Column:
        return F.when(condition, 1.0).otherwise(0.0).alias(name)

    columns = [flag(value == F.lit(kept), name) for kept, name in zip(plan.kept, plan.outputs)]
    if plan.has_rare:
        columns.append(flag(~value.isin(plan.kept), plan.outputs[-1]))
    return columns


# ---------------------------------------------------------------------------- fitting


def check_specs(df: DataFrame, specs: Sequence[FeatureSpec]) -> None:
    if not specs:
        raise ValueError("choose at least one feature")
    for spec in specs:
        role = role_of(df.schema[spec.name].dataType)
        if spec.encoding in (STANDARD, MIN_MAX, NO_RESCALING) and role != "numeric":
            raise ValueError(f"{spec.name}: {spec.encoding} needs a numeric column")
        if spec.encoding in (DUMMY, ORDINAL) and role not in ("categorical", "numeric"):
            raise ValueError(f"{spec.name}: columns of this type cannot be features")
        if spec.imputation in (AVERAGE, MEDIAN) and spec.encoding in (DUMMY, ORDINAL):
            raise ValueError(f"{spec.name}: {spec.imputation} cannot be used with {spec.encoding}")
        if spec.imputation == CONSTANT and spec.constant is None:
            raise ValueError(f"{spec.name}: constant imputation needs a constant")


def fit_prep(df: DataFrame, specs: Sequence[FeatureSpec]) -> PrepModel:
    """Fit on all rows of ``df``."""
    return fit_prep_per_fold(df, specs, 0)[WHOLE]


def fit_prep_per_fold(df: DataFrame, specs: Sequence[FeatureSpec], k: int) -> dict[int, PrepModel]:
    """Fit on the whole of ``df`` (key ``WHOLE``) and on each set that leaves out fold 0..k-1."""
    check_specs(df, specs)
    if k == 0:
        df = df.select(*[F.col(quoted(s.name)) for s in specs]).withColumn(FOLD_COLUMN, F.lit(WHOLE))
    sets = [WHOLE, *range(k)]
    numeric = [s for s in specs if s.encoding in (STANDARD, MIN_MAX, NO_RESCALING)]
    categorical = [s for s in specs if s.encoding in (DUMMY, ORDINAL)]

    plans: dict[tuple[int, str], ColumnPlan] = {}
    for start in range(0, len(numeric), COLUMNS_PER_PASS):
        plans |= _fit_numeric(df, numeric[start : start + COLUMNS_PER_PASS], sets)
    dictionaries: dict[int, DataFrame] = {}
    if categorical:
        counts = _value_counts(df, categorical, k).persist(StorageLevel.MEMORY_AND_DISK)
        numbers = _numeric_names(df, categorical)
        plans |= _fit_categories(counts, categorical, sets, df)
        ordinal = [s.name for s in categorical if s.encoding == ORDINAL]
        if ordinal:
            dictionaries = _fit_dictionaries(counts, ordinal, sets, plans, numbers)
        counts.unpersist()
    return {
        left_out: PrepModel([plans[left_out, s.name] for s in specs], dictionaries.get(left_out))
        for left_out in sets
    }


@dataclass
class _Moments:
    n: int = 0
    missing: int = 0
    mean: float = 0.0
    spread: float = 0.0  # sum of squared distances from the mean
    low: float = math.inf
    high: float = -math.inf

    def merged(self, other: _Moments) -> _Moments:
        n = self.n + other.n
        missing = self.missing + other.missing
        if n == 0:
            return _Moments(missing=missing)
        gap = other.mean - self.mean
        return _Moments(
            n,
            missing,
            self.mean + gap * other.n / n,
            self.spread + other.spread + gap * gap * self.n * other.n / n,
            min(self.low, other.low),
            max(self.high, other.high),
        )

    def filled(self, value: float) -> _Moments:
        """The moments after every missing row has taken ``value``."""
        return self.merged(_Moments(self.missing, 0, value, 0.0, value, value)) if self.missing else self


def _fit_numeric(df: DataFrame, specs: list[FeatureSpec], sets: list[int]) -> dict[tuple[int, str], ColumnPlan]:
    aggregates = []
    for i, spec in enumerate(specs):
        x = clean_value(df, spec)
        aggregates += [
            F.count(x).alias(f"n_{i}"),
            F.count(F.lit(1)).alias(f"rows_{i}"),
            F.avg(x).alias(f"mean_{i}"),
            F.var_pop(x).alias(f"var_{i}"),
            F.min(x).alias(f"low_{i}"),
            F.max(x).alias(f"high_{i}"),
        ]
        if spec.imputation == MEDIAN:
            aggregates.append(F.approx_count_distinct(x).alias(f"distinct_{i}"))
    by_fold = df.groupBy(FOLD_COLUMN).agg(*aggregates).collect()  # one row per fold
    medians = _medians(df, specs, sets, by_fold)
    modes = _numeric_modes(df, [s for s in specs if s.imputation == MOST_FREQUENT], sets)

    plans = {}
    for i, spec in enumerate(specs):
        for left_out in sets:
            moments = _Moments()
            for row in by_fold:
                if row[FOLD_COLUMN] == left_out and left_out != WHOLE:
                    continue
                n = row[f"n_{i}"]
                part = _Moments(missing=row[f"rows_{i}"])
                if n:
                    part = _Moments(
                        n, row[f"rows_{i}"] - n, row[f"mean_{i}"], row[f"var_{i}"] * n, row[f"low_{i}"], row[f"high_{i}"]
                    )
                moments = moments.merged(part)
            fill = {
                AVERAGE: moments.mean if moments.n else None,
                MEDIAN: medians.get((left_out, spec.name)),
                MOST_FREQUENT: modes.get((left_out, spec.name)),
                CONSTANT: None if spec.constant is None else float(spec.constant),
            }[spec.imputation]
            plans[left_out, spec.name] = _numeric_plan(spec, moments, fill)
    return plans


def _numeric_plan(spec: FeatureSpec, moments: _Moments, fill: float | None) -> ColumnPlan:
    if fill is None or moments.n + moments.missing == 0:
        return ColumnPlan(spec.name, spec.encoding, empty=True)
    moments = moments.filled(fill)
    center, scale = 0.0, 1.0
    if spec.encoding == STANDARD:
        center, scale = moments.mean, math.sqrt(moments.spread / moments.n)
    elif spec.encoding == MIN_MAX:
        center, scale = moments.low, moments.high - moments.low
    return ColumnPlan(spec.name, spec.encoding, fill, center, scale or 1.0)


def _medians(
    df: DataFrame, specs: list[FeatureSpec], sets: list[int], by_fold: list[Row]
) -> dict[tuple[int, str], float | None]:
    chosen = {i: spec for i, spec in enumerate(specs) if spec.imputation == MEDIAN}
    if not chosen:
        return {}
    columns = {spec.name: clean_value(df, spec) for spec in chosen.values()}
    masks = {left_out: None if left_out == WHOLE else F.col(FOLD_COLUMN) != left_out for left_out in sets}
    known = {}
    for i, spec in chosen.items():
        counts = {
            left_out: sum(r[f"n_{i}"] for r in by_fold if left_out == WHOLE or r[FOLD_COLUMN] != left_out)
            for left_out in sets
        }
        known[spec.name] = (sum(r[f"distinct_{i}"] for r in by_fold), counts)
    return exact_quantiles(df, columns, 0.5, masks, known=known)


def _value_counts(df: DataFrame, specs: list[FeatureSpec], k: int) -> DataFrame:
    """Rows per (feature, value): in all, and per fold. Combined map-side before the shuffle."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(s.name).alias("feature"),
                (F.coalesce(clean_value(df, s), F.lit(_text(s.constant))) if s.imputation == CONSTANT else clean_value(df, s))
                .cast("string")
                .alias("value"),
            )
            for s in specs
        ]
    )
    return (
        df.select(FOLD_COLUMN, F.explode(pairs).alias("p"))
        .groupBy("p.feature", "p.value")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count(F.when(F.col(FOLD_COLUMN) == f, 1)).alias(f"n_{f}") for f in range(k)],
        )
    )


def _text(value: object) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def _per_set(counts: DataFrame, sets: list[int]) -> DataFrame:
    """(left_out, feature, value, n): the value counts of every training set."""
    per_set = F.array(
        *[
            F.struct(
                F.lit(left_out).alias("left_out"),
                (F.col("n") if left_out == WHOLE else F.col("n") - F.col(f"n_{left_out}")).alias("n"),
            )
            for left_out in sets
        ]
    )
    return (
        counts.select("feature", "value", F.explode(per_set).alias("s"))
        .select("s.left_out", "feature", "value", "s.n")
        .where(F.col("n") > 0)
    )


def _fit_categories(
    counts: DataFrame, specs: list[FeatureSpec], sets: list[int], df: DataFrame
) -> dict[tuple[int, str], ColumnPlan]:
    numbers = _numeric_names(df, specs)
    per_set = _per_set(counts, sets).withColumn("number", _number(numbers))
    present = F.col("value").isNotNull()
    overview = (
        per_set.groupBy("left_out", "feature")
        .agg(
            F.sum(F.when(~present, F.col("n"))).alias("missing"),
            F.count(F.when(present, 1)).alias("n_values"),
            F.sum(F.length("value")).alias("chars"),
            F.min_by("value", F.when(present, F.struct(-F.col("n"), F.col("number"), F.col("value")))).alias("mode"),
        )
        .collect()  # one row per training set and feature
    )
    seen = {(row["left_out"], row["feature"]): row for row in overview}
    fills: dict[tuple[int, str], str | None] = {}
    for spec in specs:
        for left_out in sets:
            row = seen.get((left_out, spec.name))
            mode = row["mode"] if row else None
            fills[left_out, spec.name] = _text(spec.constant) if spec.imputation == CONSTANT else mode
    kept = _frequent_values(per_set, specs, fills, seen)

    plans = {}
    for spec in specs:
        for left_out in sets:
            row, fill = seen.get((left_out, spec.name)), fills[left_out, spec.name]
            plan = ColumnPlan(spec.name, spec.encoding, fill)
            if row is None or not row["n_values"]:
                plan.empty = True
            elif spec.encoding == DUMMY:
                plan.has_rare = row["n_values"] > spec.max_categories
                plan.kept = kept[left_out, spec.name]
            else:
                plan.dictionary_rows, plan.dictionary_chars = row["n_values"], row["chars"]
            plans[left_out, spec.name] = plan
    return plans


def _frequent_values(
    per_set: DataFrame, specs: list[FeatureSpec], fills: dict, seen: dict
) -> dict[tuple[int, str], list[str]]:
    """The values with a column of their own: all of them, or the most frequent ones.

    Equally frequent values: the later in sort order stays. The imputed rows count for the
    value they take.
    """
    most = {s.name: s.max_categories for s in specs if s.encoding == DUMMY}
    if not most:
        return {}
    spark = per_set.sparkSession
    # both tables have at most one row per training set and feature
    limits = spark.createDataFrame(list(most.items()), "feature string, most int")
    imputed = spark.createDataFrame(
        [(s, name, fills[s, name], row["missing"]) for (s, name), row in seen.items() if name in most and row["missing"]],
        "left_out int, feature string, value string, imputed long",
    )
    by_frequency = Window.partitionBy("left_out", "feature").orderBy(F.desc("n"), F.desc("number"), F.desc("value"))
    rows = (
        per_set.where(F.col("value").isNotNull())
        .join(F.broadcast(limits), "feature")
        .join(F.broadcast(imputed), ["left_out", "feature", "value"], "left")
        .withColumn("n", F.col("n") + F.coalesce("imputed", F.lit(0)))
        .withColumn("place", F.row_number().over(by_frequency))
        .where(F.col("place") <= max(most.values()))  # each task passes on only its first places
        .where(F.col("place") <= F.col("most"))
        .select("left_out", "feature", "value", "number", "place")
        .collect()
    )
    kept: dict[tuple[int, str], list[str]] = {}
    for row in sorted(rows, key=lambda r: (r["number"] is not None, r["number"] or 0.0, r["value"])):
        key = (row["left_out"], row["feature"])
        if seen[key]["n_values"] <= most[row["feature"]] or row["place"] < most[row["feature"]]:
            kept.setdefault(key, []).append(row["value"])
    return kept


def _numeric_modes(df: DataFrame, specs: list[FeatureSpec], sets: list[int]) -> dict[tuple[int, str], float]:
    if not specs:
        return {}
    counts = _value_counts(df, specs, len(sets) - 1)
    number = F.col("value").cast("double")
    rows = (
        _per_set(counts.where(F.col("value").isNotNull()), sets)
        .groupBy("left_out", "feature")
        .agg(F.min_by(number, F.struct(-F.col("n"), number)).alias("mode"))
        .collect()  # one row per training set and feature
    )
    return {(row["left_out"], row["feature"]): row["mode"] for row in rows}


def _fit_dictionaries(
    counts: DataFrame, ordinal: list[str], sets: list[int], plans: dict[tuple[int, str], ColumnPlan], numbers: list[str]
) -> dict[int, DataFrame]:
    """Codes in the order of the values: numbers as numbers, text as text."""
    values = _per_set(counts.where(F.col("feature").isin(ordinal) & F.col("value").isNotNull()), sets)
    values = values.select("left_out", "feature", _number(numbers).alias("number"), "value")
    largest = max(plans[left_out, name].dictionary_rows for left_out in sets for name in ordinal)
    codes = dense_codes(values, ["left_out", "feature"], ["number", "value"], largest)
    codes = cut_lineage(codes)  # read at every scoring
    # one row per training set and feature
    fills = values.sparkSession.createDataFrame(
        [(left_out, name, plans[left_out, name].fill) for left_out in sets for name in ordinal], "left_out int, feature string, value string"
    )
    for row in codes.join(F.broadcast(fills), ["left_out", "feature", "value"]).collect():
        plans[row["left_out"], row["feature"]].fill_code = float(row["code"])
    return {
        left_out: codes.where(F.col("left_out") == left_out).select("feature", "value", "code") for left_out in sets
    }
