"""Dated block lists against dated captures: validity intervals and an as-of join.

List entries say from which day on a pattern is listed or no longer listed. They become intervals;
a capture is blocked by the entries that were active on the day it was fetched. A pattern is a host
with all its subdomains (``example.org``), or a host with a path (``example.org/a``) and all below.
Captures meet patterns by equality on each parent domain and each leading path, so no pattern is
tried on every capture. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.common import let, unused


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dots; null where there is none."""
    place = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#\s]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(place, r"^.*@", ""), r"(:[0-9]*)?$", ""))
    host = F.regexp_replace(host, r"\.+$", "")
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    """The path's segments, without query, fragment and empty segments."""
    path = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]*(/[^?#\s]*)", 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def patterns_of(url: Column) -> Column:
    """Everything a list may name to cover this address: parent domains, and the host with leading paths."""

    def with_host(host: Column) -> Column:
        def with_labels(labels: Column) -> Column:
            return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))

        domains = let(F.split(host, r"\."), with_labels)

        def with_path(path: Column) -> Column:
            return F.transform(
                F.when(F.size(path) > 0, F.sequence(F.lit(1), F.size(path))).otherwise(F.array().cast("array<int>")),
                lambda k: F.concat_ws("/", host, F.array_join(F.slice(path, F.lit(1), k), "/")),
            )

        return F.concat(domains, let(path_of(url), with_path))

    return F.when(host_of(url).isNotNull(), let(host_of(url), with_host)).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, from_day, until_day) from (list, pattern, day, listed).

    An entry holds until the next one of its list and pattern; of several on a day a delisting
    wins. Null patterns, days and states say nothing. ``until_day`` is exclusive, null while the
    entry is in force. Entries of a day are united first, so a pattern has at most a row per day.
    """
    days = entries.where("pattern IS NOT NULL AND day IS NOT NULL AND listed IS NOT NULL")
    days = days.groupBy("list", "pattern", "day").agg(F.min("listed").alias("listed"))
    own = Window.partitionBy("list", "pattern").orderBy("day")
    states = days.withColumn("before", F.lag("listed").over(own)).where("before IS NULL OR before != listed")
    spans = states.select("list", "pattern", F.col("day").alias("from_day"), "listed", F.lead("day").over(own).alias("until_day"))
    return spans.where("listed").drop("listed")


def evaluated(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(url, day) of each distinct capture with the entries active that day.

    Adds ``n_active``, ``blocked``, ``rule`` (the longest active pattern, of equals the first by
    name) and ``listed_since`` (the first day among that rule's active entries). Captures without a
    host or a day meet nothing. Copies of a capture are evaluated once.
    """
    spans = intervals(entries)
    once = captures.select(F.col("url").cast("string"), F.col("day").cast("date")).distinct()
    keyed = once.where("day IS NOT NULL").select("url", "day", F.explode(patterns_of(F.col("url"))).alias("pattern"))
    active = keyed.join(spans, "pattern").where("from_day <= day AND (until_day IS NULL OR day < until_day)")
    best = F.struct(-F.length("pattern"), "pattern", "from_day").alias("best")
    found = active.groupBy("url", "day").agg(F.count("*").alias("n_active"), F.min(best).alias("best"))
    return found.select("url", "day", "n_active", F.col("best.pattern").alias("rule"), F.col("best.from_day").alias("listed_since"))


def filtered(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "day") -> DataFrame:
    """``captures`` with n_active, blocked, rule and listed_since; every row stays, copies too.

    Where the captures have a column of such a name already, the new one has underscores before it.
    """
    n_active, blocked, rule, since = (unused(captures.columns, c) for c in ("n_active", "blocked", "rule", "listed_since"))
    seen = evaluated(captures.select(F.col(url).alias("url"), F.col(day).alias("day")), entries).toDF(
        "seen_url", "seen_day", "n_active", "rule", "listed_since"
    )
    same = (captures[url].cast("string") == seen["seen_url"]) & (captures[day].cast("date") == seen["seen_day"])
    joined = captures.join(seen, same, "left")
    return joined.select(
        *(captures[c] for c in captures.columns), F.coalesce(seen["n_active"], F.lit(0)).cast("long").alias(n_active),
        seen["n_active"].isNotNull().alias(blocked), seen["rule"].alias(rule), seen["listed_since"].alias(since),
    )


# Dated lists for tables that bring none: which patterns are listed, and when, follows from md5.


def _number(value: Column, modulus: int) -> Column:
    return (F.conv(F.substring(F.md5(value), 1, 7), 16, 10).cast("long") % modulus).cast("int")


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages with a day of 2024 on which they were fetched."""
    return pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"),
        F.date_add(F.lit("2024-01-01").cast("date"), _number(F.coalesce(F.col("url").cast("string"), F.lit("")), 366)).alias("day"),
    )


def entries_of(pages: DataFrame) -> DataFrame:
    """Two dated lists over the hosts, domains and first paths that the pages have."""
    names = pages.select(F.explode(patterns_of(F.col("url").cast("string"))).alias("pattern")).distinct()
    chosen = names.where(F.col("pattern").contains(".") & (_number(F.concat(F.lit("in:"), F.col("pattern")), 4) == 0))
    start = F.date_add(F.lit("2023-07-01").cast("date"), _number(F.concat(F.lit("on:"), F.col("pattern")), 500))
    length = 20 + _number(F.concat(F.lit("for:"), F.col("pattern")), 200)
    dated = chosen.select(
        F.when(F.col("pattern").contains("/"), "paths").otherwise("hosts").alias("list"), "pattern", start.alias("start"), length.alias("length")
    )
    changes = F.array(
        F.struct(F.col("start").alias("day"), F.lit(True).alias("listed")),
        F.struct(F.date_add("start", F.col("length")).alias("day"), F.lit(False).alias("listed")),
        F.struct(F.date_add("start", 2 * F.col("length")).alias("day"), F.lit(True).alias("listed")),
    )
    return dated.select("list", "pattern", F.inline(changes))


ORACLE = """
WITH base AS (
  SELECT page_id, url,
    DATE '2024-01-01' + (('0x' || substr(md5(coalesce(url, '')), 1, 7))::BIGINT % 366)::INTEGER AS day,
    lower(regexp_replace(regexp_replace(regexp_replace(regexp_extract(url, '^\\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#\\s]*)', 1), '^.*@', ''), '(:[0-9]*)?$', ''), '\\.+$', '')) AS host,
    list_filter(string_split(regexp_extract(url, '^\\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#\\s]*(/[^?#\\s]*)', 1), '/'), lambda s: s != '') AS path
  FROM pages
), keyed AS (
  SELECT page_id, url, day, unnest(list_concat(
    list_transform(range(1, len(string_split(host, '.')) + 1), lambda k: array_to_string(string_split(host, '.')[k:], '.')),
    list_transform(range(1, len(path) + 1), lambda k: host || '/' || array_to_string(path[1:k], '/')))) AS pattern
  FROM base WHERE host != ''
), names AS (
  SELECT DISTINCT pattern FROM keyed WHERE contains(pattern, '.') AND ('0x' || substr(md5('in:' || pattern), 1, 7))::BIGINT % 4 = 0
), dated AS (
  SELECT pattern, DATE '2023-07-01' + (('0x' || substr(md5('on:' || pattern), 1, 7))::BIGINT % 500)::INTEGER AS start,
    20 + (('0x' || substr(md5('for:' || pattern), 1, 7))::BIGINT % 200)::INTEGER AS length
  FROM names
), spans AS (
  SELECT pattern, start AS from_day, start + length AS until_day FROM dated
  UNION ALL SELECT pattern, start + 2 * length, NULL FROM dated
), active AS (
  SELECT page_id, pattern, from_day FROM keyed JOIN spans USING (pattern)
  WHERE from_day <= day AND (until_day IS NULL OR day < until_day)
), best AS (
  SELECT page_id, count(*) AS n_active, min({'n': -length(pattern), 'p': pattern, 'd': from_day}) AS b FROM active GROUP BY page_id
)
SELECT page_id, url, day, coalesce(n_active, 0)::BIGINT AS n_active, n_active IS NOT NULL AS blocked, b.p AS rule, b.d AS listed_since
FROM base LEFT JOIN best USING (page_id)
"""
