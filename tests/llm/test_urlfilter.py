import datetime as dt

import pytest
from pyspark.sql import functions as F

from check_oracles import compare
from tabwright.llm import queries, urlfilter

URLS = [
    "http://User:pw@A.B.example.org:8080/x//y/z?q#f", "https://example.org", "ftp://example.org./x", "example.org/x", "", None, "http://",
    "http:///x", "https://b.example.org/x/y", "HTTP://EXAMPLE.ORG/X", "https://exämple.de/ü",
]


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def brute(captures, entries):
    listed = {}
    for name, pattern, when, on in entries:
        if None not in (pattern, when, on):
            key = (name, pattern, when)
            listed[key] = listed.get(key, True) and on
    out = []
    for url, when in captures:
        names = set()
        if url and "://" in url:
            rest = url.strip().split("://", 1)[1]
            place = rest.split("/")[0].split("?")[0].split("#")[0]
            host = place.rsplit("@", 1)[-1].split(":")[0].lower().rstrip(".")
            if host:
                labels = host.split(".")
                names = {".".join(labels[i:]) for i in range(len(labels))}
                path = [s for s in rest.split("?")[0].split("#")[0].split("/")[1:] if s]
                names |= {host + "/" + "/".join(path[: i + 1]) for i in range(len(path))}
        n, rule = 0, None
        for name, pattern in {(a, b) for a, b, _ in listed}:
            days = [d for a, b, d in listed if (a, b) == (name, pattern) and when is not None and d <= when]
            if pattern in names and days and listed[name, pattern, max(days)]:
                n += 1
                if rule is None or (-len(pattern), pattern) < rule:
                    rule = (-len(pattern), pattern)
        out.append((url, when, n, n > 0, rule and rule[1]))
    return sorted(out, key=str)


ENTRIES = [
    ("a", "example.org", day(0), True), ("a", "example.org", day(10), False), ("a", "example.org", day(10), True), ("a", "example.org", day(20), True),
    ("b", "b.example.org/x", day(5), True), ("b", "b.example.org/x", day(6), True), ("b", None, day(1), True), ("b", "org", None, True),
    ("b", "org", day(15), True), ("b", "org", day(17), None), ("c", "example.org", day(12), False), ("c", "a.b.example.org/x/y", day(0), True),
    ("c", "exämple.de/ü", day(3), True),
]


def test_captures_meet_what_was_listed_that_day(spark):
    captures = [(u, d) for u in URLS for d in [*(day(n) for n in (0, 4, 9, 10, 12, 16, 25)), dt.date(2023, 1, 1), None]] * 2
    frame = spark.createDataFrame(captures, "url string, day date").withColumns({"n": F.lit(1), "pattern": F.lit("x"), "best": F.lit(2)})
    entries = spark.createDataFrame(ENTRIES, "list string, pattern string, day date, listed boolean")
    found = urlfilter.filtered(frame, entries)
    assert found.columns[:5] == ["url", "day", "n", "pattern", "best"]
    rows = found.select("url", "day", "n_active", "blocked", "rule").collect()
    assert sorted((tuple(r) for r in rows), key=str) == brute(captures, ENTRIES)
    since = {r["listed_since"] for r in found.where("day = '2024-01-26' AND url = 'https://b.example.org/x/y'").collect()}
    assert since == {day(5)}


def test_columns_of_the_same_names_stay(spark):
    entries = spark.createDataFrame(ENTRIES, "list string, pattern string, day date, listed boolean")
    own = {"Rule": F.lit("mine"), "n_active": F.lit(7), "blocked": F.lit("no"), "_blocked": F.lit("yes"), "seen_url": F.lit(1), "from_day": F.lit(2)}
    captures = spark.createDataFrame([("https://example.org", day(3))], "url string, day date").withColumns(own)
    found = urlfilter.filtered(captures, entries)
    assert found.columns == [*captures.columns, "_n_active", "__blocked", "_rule", "listed_since"]
    row = found.select("Rule", "_rule", "n_active", "_n_active", "blocked", "__blocked").first()
    assert tuple(row) == ("mine", "example.org", 7, 1, "no", True)


def test_empty_lists_and_captures(spark):
    entries = spark.createDataFrame(ENTRIES, "list string, pattern string, day date, listed boolean")
    captures = spark.createDataFrame([("https://example.org", day(3))], "url string, day date")
    assert urlfilter.filtered(captures.limit(0), entries).isEmpty()
    assert not urlfilter.filtered(captures, entries.limit(0)).first()["blocked"]


def test_query_equals_its_twin(spark, sf):
    assert compare(spark, "op9_url_lists", *queries.QUERIES["op9_url_lists"], sf).startswith("ok")


@pytest.mark.parametrize("rows", [[(None, None, None), (1, "", "")], []])
def test_pages_without_addresses(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = urlfilter.filtered(urlfilter.captures_of(pages), urlfilter.entries_of(pages))
    assert found.count() == len(rows) and found.where("blocked").isEmpty()
