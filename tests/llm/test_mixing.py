from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from check_oracles import compare
from tabwright.llm import mixing, queries


def shares(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        found = {s: rest * weight[s] / sum(weight[t] for t in open_) for s in open_}
        above = [s for s in open_ if found[s] > 3 * sizes[s]]
        if not above:
            return fixed | found
        fixed.update((s, 3 * sizes[s]) for s in above)


@pytest.mark.parametrize("power", [0.0, 0.8])
@pytest.mark.parametrize("table", ["awkward", "clashing", "none", "documents"])
def test_taken_words_come_near_their_targets(request, monkeypatch, table, power):
    monkeypatch.setattr(mixing, "RANGE_POWER", power)
    docs = request.getfixturevalue(table)
    source = defaultdict(list)
    found = mixing.mixture(docs).join(docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("k"), "source").distinct(),
                                      F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("doc_key") == F.col("k"))).collect()
    assert len(found) == docs.count()
    for r in found:
        source[r["source"]].append(r)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * r["epochs"]
    want = shares({s: sum(r["size"] for r in own) for s, own in source.items()}) if source else {}
    for s, own in source.items():
        assert {r["source_size"] for r in own} == {sum(r["size"] for r in own)}
        assert all(abs(r["target"] - want[s]) < 1e-6 * max(1, want[s]) for r in own)
        assert abs(sum(r["taken"] for r in own) - want[s]) <= max(r["size"] for r in own)
    copies = mixing.mixed(docs)
    assert copies.columns == docs.columns
    assert copies.where("doc_id != 10 OR doc_id IS NULL").count() == sum(r["epochs"] for r in found if r["doc_id"] != 10)


def test_reruns_and_ranges_agree(documents, monkeypatch):
    one = {tuple(r) for r in mixing.mixture(documents).collect()}
    monkeypatch.setattr(mixing, "RANGE_POWER", 0.9)
    assert {tuple(r) for r in mixing.mixture(documents.repartition(7)).collect()} == one


def test_better_documents_come_first(spark):
    # half of every source is taken once more than the other half: weights decide which
    rows = [(i, "a b c d", "s", 0) for i in range(4000)] + [(9000, "x " * 12_000, "t", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n int")
    found = mixing.mixture(docs, F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.2)).where("size = 4").collect()
    most = max(r["epochs"] for r in found)
    even = sum(r["epochs"] == most for r in found if r["doc_id"] % 2 == 0)
    odd = sum(r["epochs"] == most for r in found if r["doc_id"] % 2 == 1)
    assert 0 < odd < 0.75 * even


def test_shares_that_reach_their_limit(spark):
    rows = [("a", 10), ("b", 100), ("c", 1000), ("d", 1), (None, 5000), ("e", 0)]
    found = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(rows, "source string, source_size long")).collect()}
    want = shares(dict(rows))
    assert all(abs(found[s] - want[s]) < 1e-6 for s in want)


def test_query_equals_its_twin(spark, sf):
    assert compare(spark, "op8_source_mixture", *queries.QUERIES["op8_source_mixture"], sf).startswith("ok")
