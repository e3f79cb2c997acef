import hashlib
import re

import pytest

from check_oracles import compare
from tabwright.llm import queries, spotsigs

ANCHORS = set(spotsigs.ANCHORS)


def chains(text):
    """The signatures in words; Spark's hashes only name them."""
    words = [w for w in re.split(r"[^\w]|_", text.lower()) if w]
    out = set()
    for i, w in enumerate(words):
        if w in ANCHORS:
            content = [x for x in words[i + 1 : i + 1 + spotsigs.AHEAD] if x not in ANCHORS][: spotsigs.CHAIN]
            if content:
                out.add((w, *content))
    if not text:
        return set()
    return out or {("", *words)} if words else {("", text)}


def like(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


@pytest.mark.parametrize("table", ["awkward", "clashing", "none", "documents"])
def test_fingerprints_of_edited_and_next_texts(request, table):
    docs = request.getfixturevalue(table)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    want = []
    for (name, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        want.append((name, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(like(chains(text), chains(edited)), 9), round(like(chains(text), chains(following)), 9)))
    found = spotsigs.fingerprints(docs).collect()
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    by_text = {}
    texts = {name: text for name, text in rows if name is not None}
    for r in found:
        if r["doc_id"] in texts:
            assert by_text.setdefault(texts[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
        assert len(r["fingerprint"]) % 16 == 0


@pytest.mark.parametrize("threshold", [0.3, 0.75])
def test_pairs_are_those_of_all_comparisons(documents, awkward, threshold):
    for docs in (documents, awkward):
        rows = sorted((r["doc_id"], r["text"] or "") for r in docs.where("doc_id IS NOT NULL").distinct().collect())
        classes = {}
        for name, text in rows:
            if chains(text):
                classes.setdefault(frozenset(chains(text)), name)
        sets = sorted((name, s) for s, name in classes.items())
        want = {(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[i + 1 :] if like(x, y) >= threshold}
        pairs, members = spotsigs.near_pairs(docs, threshold)
        assert {(r["a"], r["b"]) for r in pairs.collect()} == want
        assert {(r["doc_id"], r["class_id"]) for r in members.collect()} == {(n, classes[frozenset(chains(t))]) for n, t in rows if chains(t)}


def test_one_document_follows_itself(spark):
    found = spotsigs.fingerprints(spark.createDataFrame([(7, "the quick brown fox of old")], "doc_id long, text string")).collect()
    assert len(found) == 1 and found[0]["near_next"] == 1.0


def test_query_equals_its_twin(spark, sf):
    assert compare(spark, "op10_spot_signatures", *queries.QUERIES["op10_spot_signatures"], sf).startswith("ok")
