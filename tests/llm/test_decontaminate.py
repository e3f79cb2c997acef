import hashlib
import re

import pytest

from check_oracles import compare
from tabwright.llm import decontaminate, queries

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for name, text in items:
        w = words(text)
        size = min(13, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add("null" if name is None else str(name))
    out = []
    for name, text in docs:
        w, hit, found = words(text), set(), set()
        for size in range(1, 14):
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[tuple(w[k : k + size])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((name, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def items(spark, awkward):
    long = awkward.where("doc_id = 6").first()["text"]
    rows = [(1, long), (2, "one"), (3, None), (4, " .. "), (5, "Other line"), (None, "w1 w2"), (10, long), (2, "no name"), (7, "ÄÖ 日本")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("block", [1 << 20, 40])
@pytest.mark.parametrize("table", ["awkward", "clashing", "none"])
def test_hits_are_those_of_all_windows(request, items, table, block):
    docs = request.getfixturevalue(table)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    benchmark = [(r["item_id"], r["text"]) for r in items.collect()]
    found = decontaminate.contamination(docs, items, block)
    want = brute(rows, benchmark)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    left = decontaminate.decontaminated(docs, items, block_bytes=block)
    assert left.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(r[0]) for r in want if not r[5])


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_spans_go_and_clean_texts_stay(awkward, items, block):
    benchmark = [(r["item_id"], r["text"]) for r in items.collect()]
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    left = [(r["doc_id"], r["text"]) for r in decontaminate.decontaminated(awkward, items, "spans", block).collect()]
    assert len(left) == len(rows)
    clean = {r[0] for r in brute(rows, benchmark) if not r[5]}
    before = dict(rows)
    assert all(t == before[i] for i, t in left if i in clean and i is not None and i != 10)
    assert dict(left)[6] == "" and dict(left)[8] in ("more", " more")


def test_a_whole_table(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert sorted((tuple(r) for r in decontaminate.contamination(docs, items).collect()), key=str) == want


def test_an_empty_benchmark(spark, awkward):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(awkward, nothing).where("contaminated OR n_hit > 0").isEmpty()
    assert decontaminate.decontaminated(awkward, nothing).count() == awkward.count()
    with pytest.raises(ValueError):
        decontaminate.decontaminated(awkward, nothing, "words")


def test_query_equals_its_twin(spark, sf):
    assert compare(spark, "op4_benchmark_decontamination", *queries.QUERIES["op4_benchmark_decontamination"], sf).startswith("ok")
