import math
import re
from itertools import groupby

import numpy as np
import pyarrow as pa
import pytest

from tabwright.llm import quality
from tabwright.llm.wordhash import text_bytes


@pytest.mark.parametrize("table", ["awkward", "clashing", "none"])
def test_every_row_has_a_score(request, table):
    docs = request.getfixturevalue(table)
    found = quality.scored(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        assert 0 <= r["score"] <= 1 and 0 <= r["posterior"] <= 1 and r["good"] == (r["score"] >= 0.5)
    for r in found:
        if r["doc_id"] in (1, 2, 3):
            assert r["score"] == 0.0


def test_scores_follow_the_unseen_labels(spark):
    sf = "/root/testdata/sf0.01"
    found = quality.scored(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    right = np.mean([r["good"] == bool(r["quality"]) for r in found])
    assert right > 0.93
    again = quality.scored(spark.read.parquet(f"{sf}/documents.parquet").repartition(5))
    scores = {r["doc_id"]: r["score"] for r in again.collect()}
    assert all(abs(scores[r["doc_id"]] - r["score"]) < 1e-9 for r in found)


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.7
    accuracy = np.linspace(0.6, 0.95, len(quality.VOTES))
    votes = np.where(rng.random((len(truth), len(accuracy))) < accuracy, 1, -1) * np.where(truth, 1, -1)[:, None]
    patterns, counts = np.unique(quality._pattern(votes), return_counts=True)
    model = quality.LabelModel(patterns, counts)
    assert abs(model.prior - 0.7) < 0.03
    assert np.abs(model.rates[1, :, 2] - accuracy).max() < 0.05
    assert ((model.posterior(quality._pattern(votes)) >= 0.5) == truth).mean() > 0.95


def test_patterns_pack_all_votes():
    votes = np.array([[1, 0, -1] * 3, [-1] * 9, [1] * 9])
    assert (quality._unpacked(quality._pattern(votes)) == votes).all()


def test_variety_reads_the_whole_text():
    name = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(4))
    front, spun = [name(i) for i in range(400)], ["buy", "now"] * 1000
    texts = [front + spun, spun + front, front, spun, front + front, front[:30]]
    values, _, _ = quality._described(*text_bytes(pa.array([" ".join(t) for t in texts], pa.large_string())))
    assert np.allclose(values["variety"], [410 / 2400, 410 / 2400, 1, 10 / 2000, 1, 1])
    votes = quality._votes(values)[:, quality.VOTES.index("variety")]
    assert list(votes) == [-1, -1, 1, -1, 1, 1]


def shape(word):
    kind = lambda c: "A" if "A" <= c <= "Z" else "a" if "a" <= c <= "z" or c >= "\x80" else "0" if "0" <= c <= "9" else c
    return "".join(k for k, _ in groupby(map(kind, word)))


def direct_votes(text):
    """The nine votes on one text, from plain strings."""
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    own = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[A-Za-z\x80-\U0010ffff]+", text)]
    letters = len(re.findall("[A-Za-z\x80-\U0010ffff]", text))
    share = lambda found, of: len(found) / of if of else None
    values = {
        "length": len(words),
        "symbols": share(re.findall("[!-/:-@\\[-`{-~]", text), len(text)) if words else None,
        "capitals": share(re.findall("[A-Z]", text), letters),
        "variety": sum(len(set(own[i : i + 400])) for i in range(0, len(own), 400)) / len(own) if len(own) >= 20 else None,
        "function_words": share([w for w in own if w in quality.FUNCTION_WORDS], len(own)) if len(own) >= 10 else None,
        "columns": share([w for w in words if shape(w) == "|"], len(words)),
        "plain_words": share([w for w in words if shape(w) in quality.PLAIN_SHAPES], len(words)),
        "phrases": len(set(zip(own, own[1:], own[2:]))) / (len(own) - 2) if len(own) >= 20 else None,
        "word_length": share("".join(words), len(words)),
    }
    votes = []
    for name, (low, high, good_from, good_to) in quality.LIMITS.items():
        v = values[name]
        bad = v is not None and ((low is not None and v < low) or (high is not None and v > high))
        good = v is not None and not bad and (good_from is None or v >= good_from) and (good_to is None or v <= good_to)
        votes.append(int(good) - int(bad))
    return tuple(votes)


def direct_posteriors(votes):
    """Expectation-maximisation document by document."""
    prior, rates = 0.5, {(label, j, v): 0.6 if v == 2 * label - 1 else 0.2 for label in (0, 1) for j in range(9) for v in (-1, 0, 1)}

    def posterior(own):
        odds = math.log(prior / (1 - prior)) + sum(math.log(rates[1, j, v] / rates[0, j, v]) for j, v in enumerate(own))
        return 1 / (1 + math.exp(-min(max(odds, -30), 30)))

    for _ in range(100):
        good = [posterior(own) for own in votes]
        prior = (sum(good) + 1) / (len(votes) + 2)
        for label in (0, 1):
            for j in range(9):
                told = {v: 1 + sum(g if label else 1 - g for g, own in zip(good, votes) if own[j] == v) for v in (-1, 0, 1)}
                rates.update({(label, j, v): told[v] / sum(told.values()) for v in told})
    return [posterior(own) for own in votes]


@pytest.mark.parametrize("table", ["awkward", "documents"])
def test_votes_and_posteriors_are_the_direct_ones(request, table):
    docs = request.getfixturevalue(table)
    texts = [r["text"] or "" for r in docs.select("text").collect()]
    votes = [direct_votes(t) for t in texts]
    values, _, _ = quality._described(*text_bytes(pa.array(texts, pa.large_string())))
    assert [tuple(v) for v in quality._votes(values)] == votes
    want = sorted((sum(map(abs, v)), round(p, 6)) for v, p in zip(votes, direct_posteriors(votes)))
    assert sorted((r["n_votes"], round(r["posterior"], 6)) for r in quality.scored(docs).collect()) == want


def test_scorer_is_the_regression_on_posteriors(documents):
    texts = sorted({r["text"] for r in documents.select("text").collect() if r["text"]})[:60]
    target = np.linspace(0, 1, len(texts))
    weights, offset = quality.fit_scorer(texts, target)
    tokens = [quality._described(*text_bytes(pa.array([t], pa.large_string())))[1] for t in texts]
    used = sorted({int(f) for own in tokens for f in own})
    x = np.array([[math.sqrt(n) for n in np.bincount(np.searchsorted(used, own), minlength=len(used))] for own in tokens])
    x /= np.maximum(np.sqrt((x**2).sum(axis=1, keepdims=True)), 1e-12)

    def loss(w, b):
        p = np.clip(1 / (1 + np.exp(-(x @ w + b))), 1e-12, 1 - 1e-12)
        return -np.mean(target * np.log(p) + (1 - target) * np.log(1 - p)) + quality.PENALTY / 2 * (w**2).sum()

    w, b = np.zeros(len(used)), 0.0
    for _ in range(20_000):
        error = (1 / (1 + np.exp(-(x @ w + b))) - target) / len(texts)
        w, b = w - 2 * (x.T @ error + quality.PENALTY * w), b - 2 * error.sum()
    assert abs(loss(weights[used], offset) - loss(w, b)) < 2e-3 and np.count_nonzero(weights) <= len(used)
