"""Sources mixed to target weights by weighted sampling without replacement.

Every source gets a budget of words. Whole epochs of a source come first; what is left of its
budget is filled by its documents in the order of Efraimidis-Spirakis keys, exponential variables
divided by a quality weight, so better documents tend to be early. Keys come from a hash of the
document, so reruns agree.

The running sums over a source never sit in one task: documents are counted per key range first,
the ranges of a source (as many as its size asks for) are summed up, and only the documents of one
range are sorted together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.common import stored

#: Source weights by rank, repeating.
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
#: A source of n documents is dealt into n to this power key ranges: both the ranges of a source and the
#: documents of a range grow with the square root only.
RANGE_POWER = 0.5
SEED = "mix-1"


def words_in(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; a null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """From 0.1 (no letters or blanks) to 1: the share of characters that are letters or blanks."""
    odd = F.regexp_count(text, F.lit(r"[^\p{L}\s]"))
    return F.coalesce(0.1 + 0.9 * (1 - odd / F.greatest(F.length(text), F.lit(1))), F.lit(0.1))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources stand by code point, null last, and weigh 5, 2, 1, 5, ... They share the sum of all
    sizes; a target stops at ``MOST_EPOCHS`` times its source's size and the excess goes to the
    others by weight, until none is above. Each round of that is one aggregate over the sources,
    of which only sums come to the driver.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int"))
    weighed = stored(sizes.withColumn("weight", weight.cast("long")), "source-weights")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    limit = MOST_EPOCHS * F.col("source_size")
    rate = 0.0
    while True:
        # sources that reach their limit at this rate have it; the others share what is left
        capped = F.col("weight") * F.lit(rate) >= limit
        row = weighed.agg(F.sum(F.when(capped, limit)), F.sum(F.when(~capped, F.col("weight")))).first()
        if not row[1]:
            rate = None
            break
        new = (total - (row[0] or 0)) / row[1]
        if new <= rate:
            break
        rate = new
    share = limit.cast("double") if rate is None else F.least(limit.cast("double"), F.col("weight") * F.lit(float(rate)))
    return weighed.select("source", "source_size", share.alias("target"))


def sample_key(doc_id: Column, text: Column, weight: Column) -> Column:
    """An exponential variable with rate ``weight``, from a hash: small keys are taken first."""
    digest = F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))), F.lit(SEED)))
    unit = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
    return -F.ln(unit) / weight


def mixture(docs: DataFrame, weight: Column | None = None) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, epochs, doc_key.

    ``taken`` is the document's size times the number of times the mix takes it: the whole epochs
    of its source, and once more if it is in the fractional part. A document is in that part if
    the budget reaches at least half of it. Null and blank texts have size 0 and are taken with
    their neighbours. A null source is a source of its own. Rows that repeat others are documents
    of their own with the same key; as they are equal, their order among themselves is irrelevant.
    ``doc_key`` is a hash of the text, which tells rows with the same doc_id apart.
    """
    weight = quality_weight(F.col("text")) if weight is None else weight
    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), words_in(F.col("text")).alias("size"),
        sample_key(F.col("doc_id"), F.col("text"), weight).alias("sample_key"), F.xxhash64("text").alias("doc_key"),
    )
    rows = stored(rows, "sizes")
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"), F.avg("sample_key").alias("mean_key"))
    by_source = stored(by_source, "source-sizes")
    wanted = targets(by_source.select("source", "source_size"))
    budget = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    wanted = wanted.withColumnRenamed("source", "s").join(
        by_source.select("source", "n_docs", "mean_key"), F.col("s").eqNullSafe(F.col("source"))
    ).select("s", "source_size", "target", budget.alias("epochs"), "n_docs", "mean_key")

    keyed = rows.join(wanted, F.col("source").eqNullSafe(F.col("s")))
    # ranges of keys with about as many documents each: keys are about exponential
    n_ranges = F.ceil(F.pow(F.col("n_docs"), F.lit(RANGE_POWER)))
    keyed = keyed.withColumn("key_range", F.floor(n_ranges * (1 - F.exp(-F.col("sample_key") / F.col("mean_key")))).cast("int"))
    ranges = keyed.groupBy("s", "key_range").agg(F.sum("size").alias("range_size"))
    earlier = Window.partitionBy("s").orderBy("key_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        F.col("s").alias("r"), F.col("key_range").alias("k"), F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("before")
    )
    placed = keyed.join(ranges, F.col("s").eqNullSafe(F.col("r")) & (F.col("key_range") == F.col("k")))
    within = Window.partitionBy("s", "key_range").orderBy("sample_key", "doc_id", "doc_key").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    more = F.when((F.col("size") > 0) & (begin + F.col("size") / 2 <= rest), 1).otherwise(0)
    times = (F.col("epochs") + more).cast("long")
    return placed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"), times.alias("epochs"), "doc_key"
    )


def mixed(docs: DataFrame, weight: Column | None = None) -> DataFrame:
    """``docs`` with each document as often as the mix takes it; all columns and names stay."""
    plan = mixture(docs, weight).where("epochs > 0").groupBy("doc_id", "doc_key").agg(F.max("epochs").alias("epochs"))
    plan = plan.toDF("mix_id", "mix_key", "mix_epochs")
    same = docs["doc_id"].cast("long").eqNullSafe(plan["mix_id"]) & (F.xxhash64(docs["text"]) == plan["mix_key"])
    joined = docs.join(plan, same).select(*(docs[c] for c in docs.columns), F.explode(F.sequence(F.lit(1), plan["mix_epochs"].cast("int"))))
    return joined.toDF(*[f"c{i}" for i in range(len(docs.columns))], "copy").drop("copy").toDF(*docs.columns)


#: The same with the rate at which targets stop found over the sources in the order in which they do.
ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         coalesce(0.1::DOUBLE + 0.9::DOUBLE * (1 - len(regexp_extract_all(text, '[^\\p{{L}}\\s]')) / greatest(length(text), 1)::DOUBLE), 0.1) AS weight,
         (CAST('0x' || substr(md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, '')), '{SEED}')), 1, 12) AS BIGINT)
           + 0.5::DOUBLE) / {1 << 48}::DOUBLE AS unit
  FROM documents
),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         list_value({", ".join(map(str, WEIGHTS))})[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::INTEGER] AS w
  FROM sized GROUP BY source
),
rated AS (
  SELECT *, {MOST_EPOCHS} * source_size / w::DOUBLE AS stops, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
         coalesce(sum({MOST_EPOCHS} * source_size) OVER earlier, 0) AS capped, coalesce(sum(w) OVER earlier, 0) AS capped_w
  FROM sources WINDOW earlier AS (ORDER BY {MOST_EPOCHS} * source_size / w::DOUBLE, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
rate AS (
  SELECT any_value(rate) AS rate FROM (
    SELECT (total - capped)::DOUBLE / (all_w - capped_w)::DOUBLE AS rate, stops FROM rated
    WHERE (total - capped)::DOUBLE / (all_w - capped_w)::DOUBLE < stops ORDER BY stops, source LIMIT 1
  )
),
wanted AS (
  SELECT source, source_size, least({MOST_EPOCHS} * source_size::DOUBLE, w::DOUBLE * coalesce(rate, 'infinity'::DOUBLE)) AS target FROM sources, rate
),
placed AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole,
         sum(size) OVER (PARTITION BY s.source ORDER BY -ln(unit) / weight, doc_id) - size AS before
  FROM sized s JOIN wanted t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN size > 0 AND before + size / 2::DOUBLE <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken,
       CAST(whole + CASE WHEN size > 0 AND before + size / 2::DOUBLE <= target - whole * source_size THEN 1 ELSE 0 END AS BIGINT) AS epochs
FROM placed
"""
