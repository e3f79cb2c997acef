"""Document quality without labels: heuristics vote, a label model weighs them, a linear scorer learns.

Overlapping heuristics vote good, bad or nothing on every document. Expectation-maximisation over
the counts of vote patterns (at most 3^9, whatever the corpus) estimates how accurate each is and
gives a posterior per pattern. The posteriors are soft labels for a logistic regression over hashed
words and word shapes, which then scores every whole text. The scorer is fitted on a bounded
sample: at most ``SAMPLE`` documents, in the order of a hash of their text, of at most
``LONGEST_SAMPLE`` characters. Votes, pattern counts and scores cover all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import map_batches, stored
from tabwright.llm.wordhash import NOT_BLANK, byte_table, run_hashes, shares, text_bytes, word_bounds, word_hashes

SAMPLE = 4000
LONGEST_SAMPLE = 20_000
FEATURE_BITS = 16
PENALTY = 1e-4
#: Distinct words are counted within so many neighbouring words, since their share falls with a text's length.
BLOCK = 400
# Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = (
    "the of and to in a is that it for was on with as be by der die das und den von zu mit ist im für auf nicht le la les de des du "
    "et en un une est que qui dans pour par el los las y del se con no al lo como"
).split()
# The shapes of plain words, with runs of a kind written once.
PLAIN_SHAPES = [w + end for w in ("a", "Aa", "A", "0", "a'a", "a-a") for end in ("", ".", ",", ";", ":", "!", "?")]
#: Heuristic: bad below, bad above, good from, good to; a value that is not defined says nothing.
LIMITS = {
    "length": (8, None, 60, None),
    "symbols": (None, 0.12, None, 0.06),
    "capitals": (None, 0.3, None, 0.1),
    "variety": (0.3, None, 0.45, None),
    "function_words": (0.08, None, 0.2, None),
    "columns": (None, 0.1, None, 0.01),
    "plain_words": (0.7, None, 0.9, None),
    "phrases": (0.5, None, 0.8, None),
    "word_length": (3.0, 11.0, 4.5, 9.0),
}
VOTES = tuple(LIMITS)
_LETTERS = byte_table(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
_UPPER = byte_table(lambda b: 0x41 <= b <= 0x5A)
_SYMBOL = byte_table(lambda b: 0x21 <= b <= 0x7E and not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A))
_KIND = np.arange(256, dtype=np.uint8)
_KIND[0x41:0x5B], _KIND[0x61:0x7B], _KIND[0x30:0x3A], _KIND[0x80:] = ord("A"), ord("a"), ord("0"), ord("a")


def _hashes_of(strings: list[str], wanted: np.ndarray, lower: bool) -> np.ndarray:
    data, offsets = text_bytes(pa.array(strings, pa.large_string()))
    starts, ends, _ = word_bounds(data, offsets, wanted)
    return np.sort(word_hashes(data, starts, ends, lower))


_FUNCTION = _hashes_of(FUNCTION_WORDS, _LETTERS, True)
_PLAIN = _hashes_of(PLAIN_SHAPES, NOT_BLANK, False)
_BAR = _hashes_of(["|"], NOT_BLANK, False)


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


def _per_text(flags: np.ndarray, until: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[until])


def _described(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """(value of each heuristic per text, hashed features of all tokens, where each text's features begin)."""
    starts, ends, until = word_bounds(data, offsets, NOT_BLANK)
    n_words = np.diff(until).astype(float)
    n_chars = _per_text((data & 0xC0) != 0x80, offsets).astype(float)
    letters = _per_text(_LETTERS[data] & ((data & 0xC0) != 0x80), offsets)
    w_starts, w_ends, w_until = word_bounds(data, offsets, _LETTERS)
    words = word_hashes(data, w_starts, w_ends)
    n_letter_words = np.diff(w_until)
    # shapes: one byte for each run of a kind
    kinds = _KIND[data]
    keep = np.ones(len(data), bool)
    keep[1:] = kinds[1:] != kinds[:-1]
    keep[starts] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    shapes = word_hashes(kinds[keep], at[starts], at[ends], lower=False) if len(starts) else np.zeros(0, np.uint64)
    variety, phrases = np.full(len(n_words), np.nan), np.full(len(n_words), np.nan)
    threes = run_hashes(words, 3)
    for k in np.flatnonzero(n_letter_words >= 20):
        a, b = w_until[k], w_until[k + 1]
        variety[k] = sum(len(np.unique(words[i : min(b, i + BLOCK)])) for i in range(a, b, BLOCK)) / (b - a)
        phrases[k] = len(np.unique(threes[a : b - 2])) / (b - a - 2)
    with np.errstate(divide="ignore", invalid="ignore"):
        some = np.where(n_words > 0, 1.0, np.nan)
        values = {
            "length": n_words,
            "symbols": some * _per_text(_SYMBOL[data], offsets) / n_chars,
            "capitals": np.where(letters > 0, _per_text(_UPPER[data], offsets) / letters, np.nan),
            "variety": variety,
            "function_words": np.where(n_letter_words >= 10, _per_text(_among(words, _FUNCTION), w_until) / n_letter_words, np.nan),
            "columns": some * _per_text(_among(shapes, _BAR), until) / n_words,
            "plain_words": some * _per_text(_among(shapes, _PLAIN), until) / n_words,
            "phrases": phrases,
            "word_length": some * (_per_text(NOT_BLANK[data] & ((data & 0xC0) != 0x80), offsets)) / n_words,
        }
    place = np.uint64(64 - FEATURE_BITS)
    half = np.uint64(1 << (FEATURE_BITS - 1))
    features = np.concatenate([(words >> place) & (half - np.uint64(1)), ((shapes >> place) & (half - np.uint64(1))) | half]).astype(np.int64)
    owner = np.concatenate([np.repeat(np.arange(len(n_words)), n_letter_words), np.repeat(np.arange(len(n_words)), np.diff(until))])
    order = np.argsort(owner, kind="stable")
    return values, features[order], np.concatenate([[0], np.cumsum(n_letter_words + np.diff(until))])


def _votes(values: dict[str, np.ndarray]) -> np.ndarray:
    out = np.zeros((len(values["length"]), len(VOTES)), np.int8)
    for j, (name, (low, high, good_from, good_to)) in enumerate(LIMITS.items()):
        v = values[name]
        known = ~np.isnan(v)
        bad = known & ((v < low if low is not None else False) | (v > high if high is not None else False))
        good = known & ~bad
        if good_from is not None:
            good &= v >= good_from
        if good_to is not None:
            good &= v <= good_to
        out[:, j] = good.astype(np.int8) - bad
    return out


def _pattern(votes: np.ndarray) -> np.ndarray:
    """The votes as one number."""
    return (votes.astype(np.int64) + 1) @ (3 ** np.arange(len(VOTES)))


def _unpacked(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(len(VOTES)) % 3 - 1


class LabelModel:
    """Accuracies of the heuristics and a posterior per vote pattern, by expectation-maximisation."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray) -> None:
        table, n = _unpacked(patterns), counts.astype(float)
        self.prior = 0.5
        # a heuristic starts as right three times out of four
        self.rates = np.tile(np.array([[0.6, 0.2, 0.2], [0.2, 0.2, 0.6]])[:, None, :], (1, len(VOTES), 1))
        for _ in range(100):
            posterior = self.posterior(patterns)
            self.prior = float((np.dot(posterior, n) + 1) / (n.sum() + 2))
            for label, weight in ((1, posterior * n), (0, (1 - posterior) * n)):
                for j in range(len(VOTES)):
                    told = np.array([np.dot(weight, table[:, j] == v) for v in (-1, 0, 1)]) + 1.0
                    self.rates[label, j] = told / told.sum()

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        table = _unpacked(patterns)
        odds = np.full(len(patterns), np.log(self.prior / (1 - self.prior)))
        for j in range(len(VOTES)):
            odds += np.log(self.rates[1, j, table[:, j] + 1] / self.rates[0, j, table[:, j] + 1])
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _rows_of(features: np.ndarray, begins: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value): the share of a text's tokens, square-rooted, of unit length per text."""
    owner = np.repeat(np.arange(n), np.diff(begins))
    keys, counts = np.unique((owner << FEATURE_BITS) | features, return_counts=True)
    rows, columns = keys >> FEATURE_BITS, keys & ((1 << FEATURE_BITS) - 1)
    values = np.sqrt(counts)
    norm = np.sqrt(np.bincount(rows, values**2, n))
    return rows, columns, values / norm[rows]


def fit_scorer(texts: list[str], posteriors: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights per hashed feature and an offset: logistic regression on soft labels, by accelerated descent."""
    weights, offset = np.zeros(1 << FEATURE_BITS), 0.0
    if not texts:
        return weights, offset
    _, features, begins = _described(*text_bytes(pa.array(texts, pa.large_string())))
    n = len(texts)
    rows, columns, values = _rows_of(features, begins, n)
    held, held_offset, momentum = weights.copy(), 0.0, 1.0
    for _ in range(300):
        margin = np.bincount(rows, held[columns] * values, n) + held_offset
        error = (1 / (1 + np.exp(-margin)) - posteriors) / n
        step = np.bincount(columns, error[rows] * values, len(weights)) + PENALTY * held
        # rows have unit length, so the loss is smooth with a constant below 1/2
        new, new_offset = held - 2 * step, held_offset - 2 * error.sum()
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        pull = (momentum - 1) / following
        held, held_offset = new + pull * (new - weights), new_offset + pull * (new_offset - offset)
        weights, offset, momentum = new, float(new_offset), following
    return weights, offset


def _vote_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(0))
        for begin, stop in shares(offsets):
            own = offsets[begin : stop + 1]
            values, _, _ = _described(data[own[0] : own[-1]], own - own[0])
            yield pa.RecordBatch.from_arrays([pa.array(_pattern(_votes(values)))], names=["pattern"])


def _score_batches(model: Column, fitted: Column):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels: LabelModel = model.value
        weights, offset = fitted.value
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for begin, stop in shares(offsets):
                own = offsets[begin : stop + 1]
                n = stop - begin
                values, features, begins = _described(data[own[0] : own[-1]], own - own[0])
                votes = _votes(values)
                rows, columns, shares_ = _rows_of(features, begins, n)
                margin = np.bincount(rows, weights[columns] * shares_, n) + offset
                found = np.where(np.diff(begins) > 0, 1 / (1 + np.exp(-np.clip(margin, -40, 40))), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, n), pa.array(np.abs(votes).sum(axis=1).astype(np.int64)),
                        pa.array(labels.posterior(_pattern(votes))), pa.array(found),
                    ],
                    names=["doc_id", "n_votes", "posterior", "score"],
                )

    return score


def scored(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, n_votes, posterior, score, good.

    ``n_votes`` counts heuristics that say anything, ``posterior`` is the label model's, ``score``
    the scorer's probability of good. Null and wordless texts score 0. Other columns are ignored;
    repeated rows each get a row. An empty table gives no row.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counts = map_batches(rows.select("text"), _vote_batches, "pattern long").groupBy("pattern").count().collect()
    counts.sort()
    model = LabelModel(np.array([r[0] for r in counts], np.int64), np.array([r[1] for r in counts], np.int64))
    # the sample's order needs the hashes only; its texts are fetched by them
    keys = rows.where(F.length("text").between(1, LONGEST_SAMPLE)).select(F.xxhash64("text").alias("k")).distinct().orderBy("k").limit(sample)
    keys = stored(keys, "quality-sample")
    sampled = rows.join(F.broadcast(keys), F.xxhash64("text") == F.col("k"), "left_semi").where(F.length("text") <= LONGEST_SAMPLE)
    texts = sorted(r["text"] for r in sampled.select("text").distinct().collect())
    if texts:
        values, _, _ = _described(*text_bytes(pa.array(texts, pa.large_string())))
        posteriors = model.posterior(_pattern(_votes(values)))
    else:
        posteriors = np.zeros(0)
    fitted = spark.sparkContext.broadcast(fit_scorer(texts, posteriors))
    found = map_batches(rows, _score_batches(spark.sparkContext.broadcast(model), fitted), "doc_id long, n_votes long, posterior double, score double")
    return found.withColumn("good", F.col("score") >= 0.5)
