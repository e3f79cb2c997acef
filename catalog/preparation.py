"""Splits, class weights, imputation, rescaling, encoding and data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.common import LINE_KEY, LINE_KEY_SQL, SEED, rounded, sql_fold, sql_unit, table
from tabwright.operators.estimators import class_index
from tabwright.operators.prep import FeatureSpec, fit_prep, fit_prep_per_fold
from tabwright.operators.quality import feature_report, target_report, time_report
from tabwright.operators.split import FOLD_COLUMN, SPLIT_COLUMN, example_record, random_split, sample_rows, time_split, with_folds
from tabwright.operators.weights import class_counts, class_list, class_values, with_class_weights
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
    column_report,
)

RATIO = 0.8


def lines_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with missing prices, quantities, taxes and flags, told by other columns."""
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY,
        F.when(F.col("l_linestatus") != "O", F.col("l_extendedprice")).alias("price"),
        F.expr("nullif(l_quantity, 25)").alias("quantity"),
        F.expr("nullif(l_tax, 0.04D)").alias("tax"),
        F.expr("nullif(l_returnflag, 'R')").alias("flag"),
        "l_discount",
    )


LINES_WITH_GAPS = f"""
lines AS (
  SELECT {LINE_KEY_SQL},
         CASE WHEN l_linestatus <> 'O' THEN l_extendedprice END AS price,
         nullif(l_quantity, 25) AS quantity,
         nullif(l_tax, CAST(0.04 AS DOUBLE)) AS tax,
         nullif(l_returnflag, 'R') AS flag,
         l_discount
  FROM lineitem
)"""


# ------------------------------------------------------------------ schema and classes


def schema_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_report(table(spark, sf_dir, "orders"))


_ORDER_COLUMNS = [
    ("o_orderkey", "bigint", "numeric"),
    ("o_custkey", "bigint", "numeric"),
    ("o_orderstatus", "string", "categorical"),
    ("o_totalprice", "double", "numeric"),
    ("o_orderdate", "timestamp_ntz", "time"),
    ("o_orderpriority", "string", "categorical"),
]
SCHEMA_COLUMNS = "\nUNION ALL\n".join(
    f"""SELECT '{name}' AS column_name, '{kind}' AS type, '{role}' AS role,
       '{"Standard rescaling" if role == "numeric" else "Dummy encoding"}' AS default_encoding,
       '{"Median" if role == "numeric" else "Most frequent value"}' AS default_imputation,
       count(*) AS n_rows, count(*) - count({name}) AS n_missing FROM orders"""
    for name, kind, role in _ORDER_COLUMNS
)


def class_count_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_counts(table(spark, sf_dir, "orders"), "o_orderstatus")


def class_value_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_values(table(spark, sf_dir, "events"), "event_type")


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = with_class_weights(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus")
    return rounded(weighted.withColumnRenamed("SAMPLE_WEIGHTS", "sample_weight"), "sample_weight")


CLASS_WEIGHTS = """
WITH counts AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus),
weights AS (
  SELECT o_orderstatus, CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n) AS w FROM counts
)
SELECT o_orderkey, o_orderstatus, round(w, 6) AS sample_weight
FROM orders LEFT JOIN weights USING (o_orderstatus)"""


def class_index_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    classes = class_list(events, "event_type")
    return events.select("event_id", "event_type", class_index(F.col("event_type"), classes).alias("class_index"))


CLASS_INDEX = """
WITH classes AS (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS i FROM (SELECT DISTINCT event_type FROM events))
SELECT event_id, event_type, CAST(i AS INTEGER) AS class_index FROM events JOIN classes USING (event_type)"""


# ------------------------------------------------------------------ splits and samples


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return random_split(table(spark, sf_dir, "orders").select("o_orderkey"), RATIO, SEED, ["o_orderkey"]).labelled.withColumnRenamed(SPLIT_COLUMN, "split")


HASH_SPLIT = f"""
SELECT o_orderkey, CASE WHEN {sql_unit(["o_orderkey"], SEED)} < {RATIO} THEN 'train' ELSE 'test' END AS split FROM orders"""


def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return random_split(table(spark, sf_dir, "lineitem"), RATIO, SEED, LINE_KEY).sizes().withColumnRenamed(SPLIT_COLUMN, "split")


SPLIT_SIZES = f"""
SELECT CASE WHEN {sql_unit(LINE_KEY, SEED)} < {RATIO} THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows
FROM lineitem GROUP BY 1"""


def time_split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return time_split(orders, "o_orderdate", RATIO).labelled.withColumnRenamed(SPLIT_COLUMN, "split")


TIME_SPLIT = f"""
SELECT o_orderkey, o_orderdate,
       CASE WHEN epoch(o_orderdate) < (SELECT quantile_cont(epoch(o_orderdate), {RATIO}) FROM orders)
            THEN 'train' ELSE 'test' END AS split
FROM orders WHERE o_orderdate IS NOT NULL"""


def fold_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = with_folds(table(spark, sf_dir, "lineitem"), 3, SEED, LINE_KEY)
    stats = folded.groupBy(F.col(FOLD_COLUMN).alias("fold")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg("l_extendedprice").alias("mean_price"),
        F.stddev_pop("l_extendedprice").alias("std_price"),
    )
    return rounded(stats, "mean_price", "std_price", digits=4)


FOLD_STATISTICS = f"""
SELECT {sql_fold(LINE_KEY)} AS fold, count(*) AS n_rows, round(avg(l_extendedprice), 4) AS mean_price,
       round(stddev_pop(l_extendedprice), 4) AS std_price
FROM lineitem GROUP BY 1"""


def sampled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_rows(table(spark, sf_dir, "lineitem"), 1000, SEED, LINE_KEY)


_SAMPLE = f"SELECT * FROM lineitem ORDER BY md5(concat_ws(':', {LINE_KEY_SQL}, '{SEED}')), {LINE_KEY_SQL} LIMIT 1000"


def example_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = sample_rows(lines_with_gaps(spark, sf_dir), 1000, SEED, LINE_KEY)
    return example_record(sample, LINE_KEY)


EXAMPLE_LINE = f"""
WITH {LINES_WITH_GAPS},
picked AS (SELECT * FROM lines ORDER BY md5(concat_ws(':', {LINE_KEY_SQL}, '{SEED}')), {LINE_KEY_SQL} LIMIT 1000)
SELECT {", ".join(
    f"arg_min({c}, ({LINE_KEY_SQL})) FILTER (WHERE {c} IS NOT NULL) AS {c}"
    for c in [*LINE_KEY, "price", "quantity", "tax", "flag", "l_discount"])}
FROM picked"""


# ------------------------------------------------------------------ imputation


def _imputed(spark: SparkSession, sf_dir: str, spec: FeatureSpec) -> DataFrame:
    lines = lines_with_gaps(spark, sf_dir)
    return fit_prep(lines, [spec]).filled(lines, LINE_KEY)


def impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_imputed(spark, sf_dir, FeatureSpec("price", NO_RESCALING, AVERAGE)), "price")


def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_imputed(spark, sf_dir, FeatureSpec("price", NO_RESCALING, MEDIAN)), "price")


def impute_mode_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _imputed(spark, sf_dir, FeatureSpec("quantity", NO_RESCALING, MOST_FREQUENT))


def impute_mode_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _imputed(spark, sf_dir, FeatureSpec("flag", DUMMY, MOST_FREQUENT))


def impute_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _imputed(spark, sf_dir, FeatureSpec("tax", NO_RESCALING, CONSTANT, -1.0))


def _impute_sql(column: str, fill: str, digits: str = "") -> str:
    value = f"coalesce({column}, ({fill}))"
    value = f"round({value}, {digits})" if digits else value
    return f"WITH {LINES_WITH_GAPS} SELECT {LINE_KEY_SQL}, {value} AS {column} FROM lines"


def _mode_sql(column: str) -> str:
    return (
        f"SELECT {column} FROM lines WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1"
    )


IMPUTE_MEAN = _impute_sql("price", "SELECT avg(price) FROM lines", "6")
IMPUTE_MEDIAN = _impute_sql("price", "SELECT quantile_cont(price, 0.5) FROM lines", "6")
IMPUTE_MODE_NUMBER = _impute_sql("quantity", _mode_sql("quantity"))
IMPUTE_MODE_TEXT = _impute_sql("flag", _mode_sql("flag"))
IMPUTE_CONSTANT = _impute_sql("tax", "CAST(-1 AS DOUBLE)")


# ------------------------------------------------------------------ rescaling


def _rescaled(spark: SparkSession, sf_dir: str, spec: FeatureSpec) -> DataFrame:
    lines = lines_with_gaps(spark, sf_dir)
    return rounded(fit_prep(lines, [spec]).transform_columns(lines, LINE_KEY), spec.name)


def scale_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rescaled(spark, sf_dir, FeatureSpec("price", STANDARD, MEDIAN))


def scale_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rescaled(spark, sf_dir, FeatureSpec("quantity", MIN_MAX, AVERAGE))


def scale_minmax_outside_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rescaled(spark, sf_dir, FeatureSpec("tax", MIN_MAX, CONSTANT, -0.5))


def scale_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rescaled(spark, sf_dir, FeatureSpec("l_discount", NO_RESCALING, MEDIAN))


def _scale_sql(column: str, fill: str, scaled: str) -> str:
    return f"""WITH {LINES_WITH_GAPS},
full_lines AS (SELECT {LINE_KEY_SQL}, coalesce({column}, ({fill})) AS x FROM lines),
stats AS (SELECT avg(x) AS m, stddev_pop(x) AS s, min(x) AS lo, max(x) AS hi FROM full_lines)
SELECT {LINE_KEY_SQL}, round({scaled}, 6) + 0 AS {column} FROM full_lines, stats"""


SCALE_STANDARD = _scale_sql("price", "SELECT quantile_cont(price, 0.5) FROM lines", "(x - m) / s")
SCALE_MINMAX = _scale_sql("quantity", "SELECT avg(quantity) FROM lines", "(x - lo) / (hi - lo)")
SCALE_MINMAX_OUTSIDE = _scale_sql("tax", "CAST(-0.5 AS DOUBLE)", "(x - lo) / (hi - lo)")
SCALE_NONE = _scale_sql("l_discount", "SELECT quantile_cont(l_discount, 0.5) FROM lines", "x")


# ------------------------------------------------------------------ encoding


def encode_dummy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 brands: nine with a column of their own, the rest share one."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    prep = fit_prep(part, [FeatureSpec("p_brand", DUMMY, MOST_FREQUENT)])
    names = {name: f"d{i}" for i, name in enumerate(prep.outputs)}
    return prep.transform_columns(part, ["p_partkey"]).withColumnsRenamed(names)


ENCODE_DUMMY = f"""
WITH places AS (
  SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand DESC) AS place FROM part GROUP BY p_brand
),
slots AS (
  SELECT p_brand, CASE WHEN place < 10 THEN row_number() OVER (PARTITION BY place < 10 ORDER BY p_brand) - 1 ELSE 9 END AS slot
  FROM places
)
SELECT p_partkey, {", ".join(f"CAST(CASE WHEN slot = {i} THEN 1 ELSE 0 END AS DOUBLE) AS d{i}" for i in range(10))}
FROM part JOIN slots USING (p_brand)"""


def encode_dummy_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few values, so each has a column; missing rows take the most frequent one."""
    lines = lines_with_gaps(spark, sf_dir)
    prep = fit_prep(lines, [FeatureSpec("flag", DUMMY, MOST_FREQUENT)])
    names = {name: f"d{i}" for i, name in enumerate(prep.outputs)}
    return prep.transform_columns(lines, LINE_KEY).withColumnsRenamed(names)


ENCODE_DUMMY_FILLED = f"""
WITH {LINES_WITH_GAPS},
full_lines AS (SELECT {LINE_KEY_SQL}, coalesce(flag, ({_mode_sql("flag")})) AS flag FROM lines),
slots AS (SELECT flag, row_number() OVER (ORDER BY flag) - 1 AS slot FROM (SELECT DISTINCT flag FROM full_lines))
SELECT {LINE_KEY_SQL}, {", ".join(f"CAST(CASE WHEN slot = {i} THEN 1 ELSE 0 END AS DOUBLE) AS d{i}" for i in range(2))}
FROM full_lines JOIN slots USING (flag)"""


def encode_ordinal_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of a numeric column follow the numbers, not their spelling."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return fit_prep(part, [FeatureSpec("p_size", ORDINAL, MOST_FREQUENT)]).transform_columns(part, ["p_partkey"])


ENCODE_ORDINAL_NUMBER = "SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_size) - 1 AS DOUBLE) AS p_size FROM part"


def encode_dummy_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine most frequent sizes in rising order, of equals the larger ones, and one column for the rest."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    prep = fit_prep(part, [FeatureSpec("p_size", DUMMY, MOST_FREQUENT)])
    names = {name: f"d{i}" for i, name in enumerate(prep.outputs)}
    return prep.transform_columns(part, ["p_partkey"]).withColumnsRenamed(names)


ENCODE_DUMMY_NUMBER = ENCODE_DUMMY.replace("p_brand", "p_size")


def encode_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on small parts of low-numbered brands, applied to all: unseen brands get -1 or all zeros."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    known = part.where((F.col("p_brand") < "Brand#2") & (F.col("p_type") < "PROMO"))
    prep = fit_prep(known, [FeatureSpec("p_brand", ORDINAL, MOST_FREQUENT), FeatureSpec("p_type", DUMMY, MOST_FREQUENT)])
    names = {name: f"t{i}" for i, name in enumerate(prep.outputs[1:])}
    return prep.transform_columns(part, ["p_partkey"]).withColumnsRenamed({"p_brand": "brand_code", **names})


ENCODE_UNSEEN = f"""
WITH known AS (SELECT * FROM part WHERE p_brand < 'Brand#2' AND p_type < 'PROMO'),
brands AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS code FROM (SELECT DISTINCT p_brand FROM known)),
types AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS slot FROM (SELECT DISTINCT p_type FROM known))
SELECT p_partkey, CAST(coalesce(code, -1) AS DOUBLE) AS brand_code,
       {", ".join(f"CAST(CASE WHEN slot = {i} THEN 1 ELSE 0 END AS DOUBLE) AS t{i}" for i in range(3))}
FROM part LEFT JOIN brands USING (p_brand) LEFT JOIN types USING (p_type)"""


def encode_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on the train side of the split, applied to all documents."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    train = random_split(documents, RATIO, SEED, ["doc_id"]).train
    specs = [FeatureSpec("source", ORDINAL, MOST_FREQUENT), FeatureSpec("lang", ORDINAL, MOST_FREQUENT)]
    return fit_prep(train, specs).transform_columns(documents, ["doc_id"])


ENCODE_ORDINAL = f"""
WITH train AS (SELECT * FROM documents WHERE {sql_unit(["doc_id"], SEED)} < {RATIO}),
sources AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS code FROM (SELECT DISTINCT source FROM train)),
langs AS (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS code FROM (SELECT DISTINCT lang FROM train))
SELECT doc_id, CAST(coalesce(sources.code, -1) AS DOUBLE) AS source, CAST(coalesce(langs.code, -1) AS DOUBLE) AS lang
FROM documents LEFT JOIN sources USING (source) LEFT JOIN langs USING (lang)"""


def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All treatments together, over lineitem joined with part."""
    lines = lines_with_gaps(spark, sf_dir)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    # preparation reads its input several times: the join is written once
    rows = cut_lineage(lines.join(part, lines["l_partkey"] == part["p_partkey"]))
    prep = fit_prep(
        rows,
        [
            FeatureSpec("price", STANDARD, AVERAGE),
            FeatureSpec("quantity", MIN_MAX, MEDIAN),
            FeatureSpec("p_size", NO_RESCALING, MEDIAN),
            FeatureSpec("flag", DUMMY, CONSTANT, "none"),
            FeatureSpec("p_type", ORDINAL, MOST_FREQUENT),
        ],
    )
    names = {name: f"flag_{i}" for i, name in enumerate(prep.outputs[3:-1])}
    return rounded(prep.transform_columns(rows, LINE_KEY).withColumnsRenamed(names), "price", "quantity")


FEATURE_MATRIX = f"""
WITH {LINES_WITH_GAPS},
joined AS (
  SELECT {LINE_KEY_SQL}, price, quantity, coalesce(flag, 'none') AS flag, p_type, p_size
  FROM lines JOIN part ON l_partkey = p_partkey
),
full_rows AS (
  SELECT * REPLACE (coalesce(price, (SELECT avg(price) FROM joined)) AS price,
                    coalesce(quantity, (SELECT quantile_cont(quantity, 0.5) FROM joined)) AS quantity)
  FROM joined
),
stats AS (SELECT avg(price) AS m, stddev_pop(price) AS s, min(quantity) AS lo, max(quantity) AS hi FROM full_rows),
flags AS (SELECT flag, row_number() OVER (ORDER BY flag) - 1 AS slot FROM (SELECT DISTINCT flag FROM joined)),
types AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS code FROM (SELECT DISTINCT p_type FROM joined))
SELECT {LINE_KEY_SQL}, round((price - m) / s, 6) + 0 AS price, round((quantity - lo) / (hi - lo), 6) + 0 AS quantity,
       CAST(p_size AS DOUBLE) AS p_size,
       {", ".join(f"CAST(CASE WHEN slot = {i} THEN 1 ELSE 0 END AS DOUBLE) AS flag_{i}" for i in range(3))},
       CAST(code AS DOUBLE) AS p_type
FROM full_rows JOIN flags USING (flag) JOIN types USING (p_type), stats"""


def preparation_per_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each leave-one-fold-out set teaches, from the shared aggregates (-1: the whole table)."""
    folded = with_folds(lines_with_gaps(spark, sf_dir), 3, SEED, LINE_KEY)
    preps = fit_prep_per_fold(
        folded,
        [FeatureSpec("price", STANDARD, MEDIAN), FeatureSpec("quantity", MIN_MAX, AVERAGE), FeatureSpec("flag", DUMMY, MOST_FREQUENT)],
        3,
    )
    parts = [prep.statistics(spark).withColumn("left_out", F.lit(fold)) for fold, prep in preps.items()]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    numeric = F.col("feature") != "flag"
    return stacked.select(
        "left_out",
        "feature",
        F.when(numeric, F.round(F.col("fill").try_cast("double"), 4)).alias("fill_number"),
        F.when(~numeric, F.col("fill")).alias("fill_text"),
        F.round("center", 4).alias("center"),
        F.round("scale", 4).alias("scale"),
        F.array_join("kept", ",").alias("kept"),
    )


def _per_fold_sql() -> str:
    parts = []
    for left_out in (-1, 0, 1, 2):
        rows = f"(SELECT * FROM folded WHERE fold <> {left_out})"
        parts.append(f"""
SELECT {left_out} AS left_out, 'price' AS feature, round(fill, 4) AS fill_number, NULL AS fill_text,
       round(avg(coalesce(price, fill)), 4) AS center, round(stddev_pop(coalesce(price, fill)), 4) AS scale, '' AS kept
FROM {rows}, (SELECT quantile_cont(price, 0.5) AS fill FROM {rows}) GROUP BY fill
UNION ALL
SELECT {left_out}, 'quantity', round(fill, 4), NULL, min(coalesce(quantity, fill)),
       max(coalesce(quantity, fill)) - min(coalesce(quantity, fill)), ''
FROM {rows}, (SELECT avg(quantity) AS fill FROM {rows}) GROUP BY fill
UNION ALL
SELECT {left_out}, 'flag', NULL, fill, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE), string_agg(DISTINCT flag, ',' ORDER BY flag)
FROM {rows}, (SELECT flag AS fill FROM {rows} WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1) GROUP BY fill""")
    return f"WITH {LINES_WITH_GAPS}, folded AS (SELECT *, {sql_fold(LINE_KEY)} AS fold FROM lines)" + "\nUNION ALL".join(parts)


PREPARATION_PER_FOLD = _per_fold_sql()


# ------------------------------------------------------------------ data checks


def quality_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing are nulls and NaN alike."""
    labels = table(spark, sf_dir, "labels")
    target = F.when(F.col("doc_id") % 7 == 0, F.lit(float("nan"))).when(F.col("toxic") == 0, F.col("quality").cast("double"))
    return target_report(labels.withColumn("target", target), "target")


QUALITY_TARGET = """
WITH t AS (SELECT CASE WHEN doc_id % 7 <> 0 AND toxic = 0 THEN CAST(quality AS DOUBLE) END AS target FROM labels),
c AS (SELECT target, count(*) AS n FROM t GROUP BY target)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(n) FILTER (WHERE target IS NULL), 0) AS BIGINT) AS n_missing,
       count(target) AS n_classes, min(n) FILTER (WHERE target IS NOT NULL) AS smallest_class,
       max(n) FILTER (WHERE target IS NOT NULL) AS largest_class
FROM c"""


def quality_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return time_report(events.withColumn("ts", F.when(F.col("value") >= 1, F.col("ts"))), "ts")


QUALITY_TIME = """
SELECT count(*) AS n_rows, count(*) - count(t) AS n_missing, min(t) AS first_time, max(t) AS last_time
FROM (SELECT CASE WHEN value >= 1 THEN ts END AS t FROM events)"""


def quality_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = lines_with_gaps(spark, sf_dir).withColumn("currency", F.lit("usd"))
    return feature_report(lines, ["price", "quantity", "tax", "flag", "currency"], exact=True)


QUALITY_FEATURES = f"WITH {LINES_WITH_GAPS}" + "\nUNION ALL".join(
    f"""
SELECT '{c}' AS feature, count(*) AS n_rows, count(*) - count({x}) AS n_missing,
       count(DISTINCT {x}) AS n_distinct, count(DISTINCT {x}) <= 1 AS is_constant FROM lines"""
    for c, x in [("price", "price"), ("quantity", "quantity"), ("tax", "tax"), ("flag", "flag"), ("currency", "'usd'")]
)

QUERIES = {
    "schema_columns": (schema_columns, SCHEMA_COLUMNS),
    "class_counts": (class_count_table, "SELECT o_orderstatus, count(*) AS n_rows FROM orders GROUP BY o_orderstatus"),
    "class_values": (class_value_table, "SELECT DISTINCT event_type FROM events"),
    "class_weights": (class_weights, CLASS_WEIGHTS),
    "class_index": (class_index_table, CLASS_INDEX),
    "hash_split": (hash_split, HASH_SPLIT),
    "split_sizes": (split_sizes, SPLIT_SIZES),
    "time_split": (time_split_rows, TIME_SPLIT),
    "fold_statistics": (fold_statistics, FOLD_STATISTICS),
    "sample_rows": (sampled_lines, _SAMPLE),
    "example_record": (example_line, EXAMPLE_LINE),
    "impute_mean": (impute_mean, IMPUTE_MEAN),
    "impute_median": (impute_median, IMPUTE_MEDIAN),
    "impute_mode_number": (impute_mode_number, IMPUTE_MODE_NUMBER),
    "impute_mode_text": (impute_mode_text, IMPUTE_MODE_TEXT),
    "impute_constant": (impute_constant, IMPUTE_CONSTANT),
    "scale_standard": (scale_standard, SCALE_STANDARD),
    "scale_minmax": (scale_minmax, SCALE_MINMAX),
    "scale_minmax_outside_fill": (scale_minmax_outside_fill, SCALE_MINMAX_OUTSIDE),
    "scale_none": (scale_none, SCALE_NONE),
    "encode_dummy": (encode_dummy, ENCODE_DUMMY),
    "encode_dummy_filled": (encode_dummy_filled, ENCODE_DUMMY_FILLED),
    "encode_ordinal": (encode_ordinal, ENCODE_ORDINAL),
    "encode_ordinal_number": (encode_ordinal_number, ENCODE_ORDINAL_NUMBER),
    "encode_dummy_number": (encode_dummy_number, ENCODE_DUMMY_NUMBER),
    "encode_unseen": (encode_unseen, ENCODE_UNSEEN),
    "feature_matrix": (feature_matrix, FEATURE_MATRIX),
    "preparation_per_fold": (preparation_per_fold, PREPARATION_PER_FOLD),
    "quality_target": (quality_target, QUALITY_TARGET),
    "quality_time": (quality_time, QUALITY_TIME),
    "quality_features": (quality_features, QUALITY_FEATURES),
}
