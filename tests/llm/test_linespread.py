from collections import defaultdict
import hashlib

import pytest
from pyspark.sql import functions as F

from check_oracles import compare
from tabwright.llm import linespread, queries


def brute(rows, least):
    sites = defaultdict(set)
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            if line.strip(" ") and source is not None:
                sites[line.strip(" ")].add(source)
    out = []
    for name, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(sites.get(x.strip(" "), ())) < least]
        digest = None if text is None else hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((name, 0 if text is None else len(lines), 0 if text is None else len(lines) - len(kept), digest))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [2, 3])
@pytest.mark.parametrize("table", ["awkward", "clashing", "none", "documents"])
def test_lines_on_many_sites_go(request, table, least):
    docs = request.getfixturevalue(table)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    assert sorted((tuple(r) for r in linespread.line_report(docs, min_sites=least).collect()), key=str) == brute(rows, least)
    cleaned = linespread.without_boilerplate(docs, min_sites=least)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()


def test_estimates_near_the_limit_are_counted(spark):
    # lines on 95 to 105 sites with a limit of 100: only exact counts tell them apart
    rows = [(100 * n + s, f"line {n}\nown {n} {s}\n  line {n}  ", f"site {s}") for n in range(95, 106) for s in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    wide, _ = linespread.spread(docs, min_sites=100)
    assert sorted(r["n_sites"] for r in wide.collect()) == list(range(100, 106))
    found = linespread.without_boilerplate(docs, min_sites=100)
    assert found.where(F.col("text").startswith("line")).count() == sum(range(95, 100))


def test_query_equals_its_twin(spark, sf):
    assert compare(spark, "op7_line_spread", *queries.QUERIES["op7_line_spread"], sf).startswith("ok")
