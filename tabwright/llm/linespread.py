"""Lines that stand on many sites: sketched spread, exact counts near the limit, removal.

Every line gets a HyperLogLog sketch of its sites; sketches merge in the aggregation, so a line
that stands everywhere is one small row per task. An estimate well away from the limit decides;
lines near it, where the sketch may err, are counted exactly. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import let, stored

#: A line on at least so many sites is boilerplate.
MIN_SITES = 10
#: 2^12 registers: a standard error of 1.6 %. Estimates within ten percent and two sites of the limit aren't trusted.
LOG_REGISTERS, DOUBT, DOUBT_SITES = 12, 0.10, 2
_LINE = ["line", "line_check"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def _line_rows(docs: DataFrame, site: str) -> DataFrame:
    """One row per line that isn't blank: hash of its text, place, site, two hashes of the trimmed line."""
    rows = docs.select(
        F.xxhash64(F.col("text").cast("string")).alias("text_key"), F.col(site).cast("string").alias("site"),
        F.posexplode(lines_of(F.col("text"))).alias("place", "raw"),
    ).withColumn("trimmed", F.trim("raw")).where("trimmed != ''")
    return rows.select("text_key", "site", "place", F.xxhash64("trimmed").alias("line"), F.crc32(F.col("trimmed").cast("binary")).alias("line_check"))


def spread(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> tuple[DataFrame, DataFrame]:
    """(lines on at least ``min_sites`` sites with their number of sites, all places of lines near or above)."""
    rows = _line_rows(docs, site)
    sketched = rows.groupBy(*_LINE).agg(F.hll_sketch_agg("site", LOG_REGISTERS).alias("sketch"))
    guess = F.hll_sketch_estimate("sketch").alias("guess")
    low = min(min_sites - DOUBT_SITES, min_sites * (1 - DOUBT))
    high = max(min_sites + DOUBT_SITES, min_sites * (1 + DOUBT))
    likely = stored(sketched.select(*_LINE, guess).where(F.col("guess") >= low), "line-guesses")
    places = stored(rows.join(likely, _LINE), "line-places")
    doubtful = places.where(F.col("guess") <= high).select(*_LINE, "site").distinct()
    exact = doubtful.groupBy(*_LINE).agg(F.count("site").alias("n_sites")).where(F.col("n_sites") >= min_sites)
    sure = likely.where(F.col("guess") > high).select(*_LINE, F.col("guess").alias("n_sites"))
    return sure.unionAll(exact), places


def _kept(lines: Column, gone: Column) -> Column:
    """``lines`` without those at the sorted places ``gone``: the stretches between them."""

    def stretches(all_lines: Column) -> Column:
        def between(cuts: Column) -> Column:
            return F.flatten(
                F.transform(
                    F.sequence(F.lit(1), F.size(cuts) - 1),
                    lambda k: F.slice(all_lines, F.element_at(cuts, k) + 2, F.element_at(cuts, k + 1) - F.element_at(cuts, k) - 1),
                )
            )

        return let(F.concat(F.array(F.lit(-1)), gone, F.array(F.size(all_lines))), between)

    return let(lines, stretches)


def _removals(docs: DataFrame, site: str, min_sites: int) -> DataFrame:
    wide, places = spread(docs, site, min_sites)
    found = places.select("text_key", "place", *_LINE).join(wide, _LINE, "left_semi")
    found = found.groupBy("text_key").agg(F.array_sort(F.collect_set("place")).alias("gone"))
    # texts move by their hash at every size: whether the places would fit a broadcast depends on the corpus
    return found.toDF("boiler_key", "boiler_places").hint("merge")


def without_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with the lines taken out of ``text`` that stand on at least ``min_sites`` sites.

    A line is compared without the blanks around it; blank lines stay. A null site is no site. A
    null text stays null. All columns and names stay; rows without such a line are unchanged.
    """
    gone = _removals(docs, site, min_sites)
    joined = docs.join(gone, F.xxhash64(docs["text"].cast("string")) == gone["boiler_key"], "left")
    cleaned = F.when(gone["boiler_key"].isNull(), docs["text"]).otherwise(F.array_join(_kept(lines_of(docs["text"]), gone["boiler_places"]), "\n"))
    return joined.select(*(cleaned.alias(c) if c == "text" else docs[c] for c in docs.columns))


def line_report(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """One row per document: doc_id, n_lines (a null text has none), n_removed, cleaned_sha256 (null for null)."""
    gone = _removals(docs, site, min_sites)
    joined = docs.join(gone, F.xxhash64(docs["text"].cast("string")) == gone["boiler_key"], "left")
    cleaned = F.when(gone["boiler_key"].isNull(), docs["text"]).otherwise(F.array_join(_kept(lines_of(docs["text"]), gone["boiler_places"]), "\n"))
    return joined.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.when(docs["text"].isNull(), 0).otherwise(F.size(lines_of(docs["text"]))).cast("long").alias("n_lines"),
        F.when(gone["boiler_key"].isNull() | docs["text"].isNull(), 0).otherwise(F.size(gone["boiler_places"])).cast("long").alias("n_removed"),
        F.sha2(cleaned, 256).alias("cleaned_sha256"),
    )


#: The same by exact counts.
ORACLE = f"""
WITH lines AS (
  SELECT row_id, source, generate_subscripts(parts, 1) AS place, unnest(parts) AS raw
  FROM (SELECT row_number() OVER () AS row_id, source, string_split(text, chr(10)) AS parts FROM documents)
), wide AS (
  SELECT trim(raw) AS line FROM lines WHERE trim(raw) != '' GROUP BY 1 HAVING count(DISTINCT source) >= {MIN_SITES}
), marked AS (
  SELECT row_id, place, raw, trim(raw) IN (SELECT line FROM wide) AS gone FROM lines
), texts AS (
  SELECT row_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(raw, chr(10) ORDER BY place) FILTER (NOT gone), '') AS cleaned
  FROM marked GROUP BY row_id
)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(cleaned) AS cleaned_sha256
FROM (SELECT row_number() OVER () AS row_id, doc_id FROM documents) d LEFT JOIN texts USING (row_id)
"""
