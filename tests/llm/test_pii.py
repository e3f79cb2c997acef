import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tabwright.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    spans = {k: [(m.start(), m.end()) for m in re.finditer(p, text or "") if valid(k, m[0])] for k, p in PATTERNS.items()}
    listed = [f"{k}:{a}:{b}" for k, own in spans.items() for a, b in own]
    return [len(own) for own in spans.values()], listed


def holds(docs):
    texts = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str)
    found = sorted(pii.report(docs).collect(), key=lambda r: (str(r["doc_id"]),))
    assert len(found) == len(texts)
    by_digest = sorted((str(i), hashlib.sha256(",".join(brute(t)[1]).encode()).hexdigest(), *brute(t)[0]) for i, t in texts)
    assert sorted((str(r["doc_id"]), r["base_sha256"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in found) == by_digest
    for r in found:
        assert r["spans"] is not None
    return {r["doc_id"]: r["spans"] for r in found}


@pytest.mark.parametrize("table", ["awkward", "clashing", "none", "documents"])
def test_base_spans_are_those_of_the_patterns(request, table):
    docs = request.getfixturevalue(table)
    spans = holds(docs)
    masked = pii.masked(docs)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    for r in docs.where("doc_id IS NOT NULL").collect():
        own = set(spans[r["doc_id"]].split(","))
        assert set(brute(r["text"])[1]) <= own


PIECES = [
    "a@b.com", "_x@y.org", "@", "a.b", " ", "-", "1.2.3.4", ".5", ".", "256", "0012.1.1.1", "+1 (487) 555-7209", "+", "(", ")",
    "4111 1111 1111 1111", "41-", "9", "12", "é", "😀", "\n", "call 487-555-1234", "bob (at) site (dot) com", "bob at home. now",
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "%a", "+x",
]


def test_matches_touch_and_overlap_as_the_patterns_say(spark):
    rnd = random.Random(3)
    rows = [(i, "".join(rnd.choice(PIECES) for _ in range(rnd.randrange(0, 14)))) for i in range(1500)]
    rows += [(9001, "1 " * 20_000), (9002, "a." * 20_000 + "@x.y"), (9003, "9" * 30_000), (9004, "+1" + " " * 20_000), (9005, "a@b.co " * 2000)]
    holds(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))


def test_labellers_add_credentials_and_leave_prose(spark):
    rows = [(i, f'the of token = "{hashlib.sha1(str(i).encode()).hexdigest()}" and {i}') for i in range(40)]
    rows += [(100 + i, f"prose of an ordinary kind, number {i} of it, seen at home. Then on") for i in range(200)]
    found = {r["doc_id"]: r["spans"] for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[i] == "secret:16:56" for i in range(40)) and not any(found[100 + i] for i in range(200))
    masked = {r["doc_id"]: r["text"] for r in pii.masked(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert masked[3] == 'the of token = "[secret]" and 3' and masked[101] == rows[41][1]


def test_prefix_sums_in_blocks(spark):
    values = list(range(1, 1000))
    row = spark.createDataFrame([(values,)], "v array<long>").select(pii.before(F.col("v")).alias("b")).first()
    assert row["b"] == [sum(values[:i]) for i in range(len(values))]


def labelled(rnd, first):
    """Texts with announced credentials and numbers, and with long words and numbers that are none."""
    rows, true = [], {}
    for i in range(first, first + 300):
        kind = rnd.randrange(4)
        if kind == 0:
            secret = "".join(rnd.choice("abcdefghkmnpqrstuvwxyzABCDEFGHKMNPQRSTUVWXYZ23456789") for _ in range(40)) + "a7"
            lead, found = rnd.choice(["api_key = ", "the secret: ", "auth token: "]), secret
        elif kind == 1:
            lead, found = rnd.choice(["call me: ", "phone ", "my cell is "]), f"({rnd.randrange(200, 999)}) {rnd.randrange(200, 999)}-{rnd.randrange(1000, 9999)}"
        elif kind == 2:
            lead, found = "see the chapter ", f"part-{i}-of-the-long-story-of-old-{rnd.choice(['days', 'towns', 'rivers'])}"
        else:
            lead, found = "in all there were ", f"1{rnd.randrange(10, 99)} {rnd.randrange(100, 199)}.{rnd.randrange(1000, 9999)}"
        text = f"some prose of no matter, {lead}{found} and so on"
        rows.append((i, text))
        at = text.index(found)
        true[i] = f"{('secret', 'number')[kind]}:{at}:{at + len(found)}" if kind < 2 else ""
    return rows, true


def test_classifier_on_texts_it_was_not_fitted_on(spark):
    rnd = random.Random(11)
    seen, _ = labelled(rnd, 0)
    unseen, true = labelled(rnd, 1000)
    model = pii.span_model(pii.candidates(spark.createDataFrame(seen, "doc_id long, text string")))
    assert any(abs(w) > 0.1 for w in model.weights[len(pii.KINDS) + len(pii.VOTES) :])
    found = pii.candidates(spark.createDataFrame(unseen, "doc_id long, text string"))
    kept = found.select("doc_id", pii._joined(F.filter("found", lambda c: (c["kind"] >= len(pii.BASE_KINDS)) & model.accepts(c))).alias("spans"))
    got = {r["doc_id"]: r["spans"] for r in kept.collect()}
    right = sum(bool(true[i]) and got[i] == true[i] for i in true)
    assert right >= 0.95 * sum(map(bool, got.values())) and right >= 0.95 * sum(map(bool, true.values()))


def test_a_text_of_addresses_is_walked_once(spark):
    text = "write to a@b.co, 10.0.0.7 " * 5000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    begin = time.monotonic()
    row = pii.report(docs).first()
    assert (row["n_email"], row["n_ip"]) == (5000, 5000) and time.monotonic() - begin < 10
    leads = pii.candidates(docs).select(F.expr("found[4999].start AS at"), F.expr("found[4999].context AS context")).first()
    assert text[leads["at"] : leads["at"] + 6] == "a@b.co" and leads["context"] == 1
