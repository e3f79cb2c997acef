"""Toxicity by a support vector machine over a gap-weighted subsequence kernel.

Two strings are alike by the letter subsequences of three and four letters that they share, each
weighed by ``DECAY`` per skipped character, in any script. So ``i.d.i.o.t`` and ``idxiot`` stay close to
``idiot``. The machine is linear in Nyström features: similarities to ``landmarks`` (words that
mark toxic documents, and random stretches), whitened by the landmarks' own kernel matrix. The
``MARKED`` strongest words are landmarks, and beyond them each word that explains ``LEAST_EXPLAINED``
toxic documents without a sure word so far: their number follows from the labels.

Labels are of documents, insults are a few characters, so a document's score is that of its most
toxic stretch, and training picks that stretch anew in every round (a toxic document needs one
toxic stretch, a clean one has none). Since the kernel has explicit features, the landmarks'
weights fold into one table over letter sequences, and scoring is a lookup per subsequence.

The fit uses a bounded sample: at most ``sample`` labelled documents of each label, in the order of
a hash of doc_id, texts of at most ``LONGEST_SAMPLE`` characters. Scoring covers whole texts.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.common import give_back, map_batches
from tabwright.llm.wordhash import LOWER, shares, text_bytes

SAMPLE = 3000
LONGEST_SAMPLE = 20_000
#: 0 is anything but a letter, then a to z, six groups of accented letters, and letters of other scripts by
#: their code point modulo OTHERS, so that neighbours in an alphabet differ.
OTHERS = 31
LETTERS = 33 + OTHERS
DECAY = 0.7
#: Skipped characters within a subsequence of so many letters, at most.
SKIPS = {3: 2, 4: 3}
#: Four letters in common say more than three.
SHARE = {3: 0.4, 4: 1.0}
REACH = 8
#: A stretch holds the subsequences that begin at so many neighbouring characters.
WIDTH = 10
MARKED, RANDOM = 64, 64
#: Toxic documents without another sure word that make a word sure.
LEAST_EXPLAINED = 12
ROUNDS = 4
#: Forms of each word that surely marks a label, and what each counts in training. Short words have few
#: subsequences, so plain forms are asked for a larger margin than other examples, disguises for one between.
VARIANTS, FORM_WEIGHT = 8, 3.0
PLAIN_MARGIN, DISGUISE_MARGIN = 3.0, 2.0
COST = 1.0
PIECE = 1 << 18
#: Texts of the sample whose codes are found at a time.
CODED_AT_ONCE = 256
#: Features computed at a time.
HELD = 1 << 23
_PLAIN = np.zeros(256, np.uint8)
_PLAIN[97:123] = np.arange(1, 27)
_PLAIN = _PLAIN[LOWER]
_ACCENTED = {x: 27 + k for k, own in enumerate(("àáâãäå", "èéêë", "ìíîï", "òóôõö", "ùúûü", "çñßæøý")) for x in own}
#: Letters of other alphabets that look like a Latin one, and that one.
LOOK_ALIKES = dict(zip("аеорсухіјѕԁһԛԝкмтοανρικτυχεıɑɡłđ", "aeopcyxijsdhqwkmtoavpiktuxeiagld"))
#: No letter has a code point from here on.
_POINTS = 0x40000
#: Words, and where scripts write no blanks, all runs of three and of four letters.
_WORDS = (re.compile(rb"[\x01-\x3f]{3,14}"), re.compile(rb"(?=([\x21-\x3f]{3}))"), re.compile(rb"(?=([\x21-\x3f]{4}))"))


def _code(letter: str) -> int:
    """Code of a character beyond ASCII: that of its plain form where it has one."""
    small = letter.lower()[0]
    if small in _ACCENTED:
        return _ACCENTED[small]
    # a Hangul syllable would come apart
    plain = small if "\uac00" <= small <= "\ud7a3" else unicodedata.normalize("NFKD", small)[0].lower()[0]
    plain = LOOK_ALIKES.get(plain, plain)
    if "a" <= plain <= "z":
        return ord(plain) - 96
    # marks are vowels in some scripts, accents and variants of the sign before are not
    mark = unicodedata.category(plain)[0] == "M" and not ("\u0300" <= plain <= "\u036f" or "\ufe00" <= plain <= "\ufe0f")
    return 33 + ord(plain) % OTHERS if plain.isalpha() or mark else 0


@functools.cache
def _beyond_ascii() -> np.ndarray:
    out = np.zeros(_POINTS, np.uint8)
    out[0x80:] = [0 if 0xD800 <= x < 0xE000 else _code(chr(x)) for x in range(0x80, _POINTS)]
    return out


def letter_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts as one code per character, and their bounds."""
    codes = _PLAIN[data]
    at = np.flatnonzero(data >= 0xC0)
    if not len(at):
        return codes, offsets
    lead = data[at]
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    point = lead.astype(np.int32) & (0x7F >> size)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        point[more] = point[more] << 6 | data[np.minimum(at[more] + k, len(data) - 1)] & 0x3F
    codes[at] = np.where(point < _POINTS, _beyond_ascii()[np.minimum(point, _POINTS - 1)], 0)
    follows = (data & 0xC0) == 0x80
    return codes[~follows], offsets - np.searchsorted(np.flatnonzero(follows), offsets)


def _patterns(letters: int) -> list[tuple[tuple[int, ...], float]]:
    """Places of a subsequence's letters behind its first one, and its weight."""
    out = []
    for gaps in itertools.product(range(SKIPS[letters] + 1), repeat=letters - 1):
        if sum(gaps) <= SKIPS[letters]:
            places = tuple(int(x) for x in np.cumsum([g + 1 for g in gaps]))
            out.append((places, SHARE[letters] * DECAY ** sum(gaps)))
    return out


PATTERNS = {n: _patterns(n) for n in SKIPS}


def _indices(codes: np.ndarray, letters: int) -> Iterator[tuple[np.ndarray, float]]:
    """For each pattern, at each start, the number of the letter sequence; 0 where it isn't one.

    The first place may be a non-letter, so a word's beginning counts. ``codes`` is padded by
    ``REACH`` zeros along its last axis.
    """
    n = codes.shape[-1] - REACH
    scaled = [codes * np.int32(LETTERS ** (letters - 1 - k)) for k in range(letters)]
    barred = [np.where(codes == 0, np.int32(-(LETTERS**letters)), x) for x in scaled]
    for places, weight in PATTERNS[letters]:
        total = scaled[0][..., :n].copy()
        for k, place in enumerate(places, 1):
            total += barred[k][..., place : place + n]
        yield np.maximum(total, 0, out=total), weight


@dataclass
class Model:
    """Weights per letter sequence, the machine's offset and the two numbers that make it a probability."""

    tables: dict[int, np.ndarray]
    offset: float
    slope: float
    shift: float

    # few letter sequences have a weight: only those are sent
    def __getstate__(self) -> dict:
        return self.__dict__ | {"tables": {n: (len(t), (at := np.flatnonzero(t)), t[at]) for n, t in self.tables.items()}}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.tables = {}
        for n, (size, at, weights) in state["tables"].items():
            self.tables[n] = np.zeros(size, np.float32)
            self.tables[n][at] = weights

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40)))


def _local(codes: np.ndarray, tables: dict[int, np.ndarray]) -> np.ndarray:
    total = np.zeros(codes.shape[-1] - REACH, np.float32)
    for letters, table in tables.items():
        for index, weight in _indices(codes, letters):
            total += np.float32(weight) * table[index]
    return total


def _best(texts: np.ndarray, offsets: np.ndarray, tables: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The largest sum over a stretch of each text, at least 0, and where that stretch begins."""
    n = len(offsets) - 1
    best, where = np.zeros(n, np.float64), np.zeros(n, np.int64)
    pieces = [
        (k, a, min(a + PIECE, offsets[k + 1]))
        for k in range(n) if offsets[k + 1] > offsets[k]
        for a in range(int(offsets[k]), int(offsets[k + 1]), PIECE - 2 * (WIDTH + REACH))
    ]
    begin = 0
    while begin < len(pieces):
        held, stop = 0, begin
        while stop < len(pieces) and (stop == begin or held + pieces[stop][2] - pieces[stop][1] <= PIECE):
            held += int(pieces[stop][2] - pieces[stop][1])
            stop += 1
        own = pieces[begin:stop]
        # before each piece stands one non-letter, behind it so many that no stretch reaches the next piece
        gap = 1 + WIDTH + REACH
        sizes = np.array([b - a for _, a, b in own], np.int64)
        at = np.concatenate([[0], np.cumsum(sizes + gap)])
        codes = np.zeros(at[-1] + REACH, np.int32)
        for (_, a, b), place in zip(own, at):
            codes[place + 1 : place + 1 + b - a] = texts[a:b]
        sums = np.concatenate([[0.0], np.cumsum(_local(codes, tables), dtype=np.float64)])
        stretch = sums[np.minimum(np.arange(at[-1]) + WIDTH, at[-1])] - sums[:-1]
        for (k, a, _), low, size in zip(own, at, sizes):
            # stretches that begin before or within the text
            inside = stretch[low : low + size]
            value = inside.max()
            if value > best[k] + 1e-9:
                best[k] = value
                where[k] = a + max(0, int(np.argmax(inside >= value - 1e-9)) - 1)
        begin = stop
    return best, where


def margins(column: pa.Array, model: Model) -> np.ndarray:
    """The machine's value for each text, from a few megabytes of them at a time."""
    data, offsets = text_bytes(column)
    out = np.zeros(len(offsets) - 1)
    for begin, stop in shares(offsets):
        own = offsets[begin : stop + 1]
        out[begin:stop], _ = _best(*letter_codes(data[own[0] : own[-1]], own - own[0]), model.tables)
    return out + model.offset


def _codes_of(strings: list[bytes], size: int) -> np.ndarray:
    out = np.zeros((len(strings), size + REACH), np.int32)
    for row, s in zip(out, strings):
        row[: min(len(s), size)] = np.frombuffer(s[:size], np.uint8)
    return out


class _Features:
    """Explicit features of strings, restricted to the letter sequences of the landmarks."""

    def __init__(self, landmarks: list[bytes]) -> None:
        codes = _codes_of(landmarks, max(map(len, landmarks)))
        self.used = {}
        count = 0
        for letters in SKIPS:
            used = np.unique(np.concatenate([i.ravel() for i, _ in _indices(codes, letters)]))
            used = used[used > 0]
            self.used[letters] = used, count
            count += len(used)
        self.count = count

    def of(self, strings: list[bytes], size: int) -> np.ndarray:
        codes = _codes_of(strings, size)
        wide = self.count + 1
        out = np.zeros(len(strings) * wide, np.float32)
        rows = np.arange(len(strings))[:, None] * wide
        for letters, (used, first) in self.used.items():
            if not len(used):
                continue
            for index, weight in _indices(codes, letters):
                # looked up in the few sequences used: a table of all would take 67 MB of the driver's memory
                place = np.minimum(np.searchsorted(used, index), len(used) - 1)
                at = (rows + place + (first + 1))[used[place] == index]
                np.add.at(out, at, np.float32(weight))
        return out.reshape(-1, wide)[:, 1:]

    def projected(self, strings: list[bytes], size: int, onto: np.ndarray) -> np.ndarray:
        """Features times ``onto``, from a few strings at a time."""
        step = max(1, HELD // (self.count + 1))
        parts = [self.of(strings[i : i + step], size) @ onto for i in range(0, len(strings), step)]
        return np.concatenate([np.zeros((0, onto.shape[1]), np.float32), *parts])

    def tables(self, weights: np.ndarray) -> dict[int, np.ndarray]:
        out = {}
        for letters, (used, first) in self.used.items():
            out[letters] = np.zeros(LETTERS**letters, np.float32)
            out[letters][used] = weights[first : first + len(used)]
        return out


def _disguises(word: bytes, rng: np.random.Generator) -> list[bytes]:
    """A word, and it with a skipped character between all letters, at one or two places, or a letter put in."""
    out = [word, bytes(c for x in word for c in (x, 0))]
    while len(out) < VARIANTS:
        cuts = sorted(int(c) for c in rng.integers(1, len(word), 2))
        put = bytes([int(rng.integers(1, 27)) * int(rng.integers(0, 2))])
        out.append(word[: cuts[0]] + put + word[cuts[0] : cuts[1]] + (b"\0" if rng.integers(0, 2) else b"") + word[cuts[1] :])
    return [b"\0" + v for v in out]


def _words(text: bytes) -> set[bytes]:
    return {w for words in _WORDS for w in words.findall(text)}


def _explaining(strings: list[bytes], sure: list[bytes], candidates: list[bytes]) -> list[bytes]:
    """Candidates, the first ones first, that occur in ``LEAST_EXPLAINED`` strings without a sure word so far.

    A word of many copies of one text adds nothing beside the stronger word that the copies share.
    """
    holders: dict[bytes, list[int]] = {w: [] for w in candidates}
    explained, known = np.zeros(len(strings), bool), set(sure)
    for k, own in enumerate(map(_words, strings)):
        explained[k] = not own.isdisjoint(known)
        for word in own & holders.keys():
            holders[word].append(k)
    found = []
    for word in candidates:
        if np.count_nonzero(~explained[holders[word]]) >= LEAST_EXPLAINED:
            found.append(word)
            explained[holders[word]] = True
    return found


def _squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """A linear machine with squared hinge loss below each example's margin, by Newton steps on its support vectors.

    The last column of ``x`` is 1 and carries the offset, next to unpenalised.
    """
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        active = y * (x @ w) < margin
        support = x[active]
        own = support * weight[active, None]
        new = np.linalg.solve(ridge + COST * own.T @ support, COST * own.T @ (y * margin)[active])
        del support, own
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


def _logistic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the probability of label 1, with a weak prior."""
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -40, 40)))
        g, h = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-9)
        grad = np.array([(g * margin).sum() + 1e-3 * a, g.sum() + 1e-3 * b])
        hess = np.array([[(h * margin**2).sum() + 1e-3, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(hess, grad)
        step /= max(1.0, np.abs(step).max() / 2)
        a, b = a - step[0], b - step[1]
    return max(float(a), 1e-3), float(b)


def _codes_of_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``letter_codes`` of a list, found for a few texts at a time."""
    parts, sizes = [np.zeros(0, np.uint8)], [np.zeros(1, np.int64)]
    for begin in range(0, len(texts), CODED_AT_ONCE):
        codes, bounds = letter_codes(*text_bytes(pa.array(texts[begin : begin + CODED_AT_ONCE], pa.large_string())))
        parts.append(codes)
        sizes.append(np.diff(bounds))
    return np.concatenate(parts), np.cumsum(np.concatenate(sizes))


def fit(texts: list[str], labels: list[int], prior: float) -> Model:
    """Train on labelled texts; ``prior`` is the share of label 1 among all labelled documents."""
    y = np.array([1.0 if v else -1.0 for v in labels])
    if not len(y) or abs(y.sum()) == len(y):
        # one label only: the same probability for every text
        share = min(max(prior, 1e-3), 1 - 1e-3)
        return Model({n: np.zeros(LETTERS**n, np.float32) for n in SKIPS}, 0.0, 1e-3, float(np.log(share / (1 - share))))
    data, offsets = _codes_of_texts(texts)
    give_back()
    strings = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
    toxic, clean = Counter(), Counter()
    for own, label in zip(strings, y):
        (toxic if label > 0 else clean).update(_words(own))
    n_toxic, n_clean = (y > 0).sum(), (y < 0).sum()
    odds = {}
    for word in toxic:
        p, q = (toxic[word] + 0.5) / (n_toxic + 1), (clean[word] + 0.5) / (n_clean + 1)
        odds[word] = (np.log(p / (1 - p)) - np.log(q / (1 - q))) * np.sqrt(toxic[word])
    marked: list[bytes] = []
    strongest = sorted(odds, key=lambda w: (-odds[w], -len(w), w))
    for word in strongest:
        # a run within a word that marks exactly as much adds nothing
        if not any(word in other and odds[word] == odds[other] for other in marked):
            marked.append(word)
        if len(marked) == MARKED:
            break
    sure = [w for w in marked if toxic[w] >= max(5, 0.02 * n_toxic) and toxic[w] > 20 * clean[w]]
    candidates = [w for w in strongest if toxic[w] >= LEAST_EXPLAINED and toxic[w] > 20 * clean[w]]
    more = _explaining([s for s, label in zip(strings, y) if label > 0], sure, candidates)
    sure += more
    marked += [w for w in more if w not in marked]
    rng = np.random.default_rng(11)
    span = WIDTH + REACH
    some = []
    for k in rng.permutation(len(strings))[:RANDOM]:
        begin = int(rng.integers(0, max(1, len(strings[k]) - span)))
        some.append(strings[k][begin : begin + span])
    landmarks = [b"\0" + w for w in marked] + [x for x in dict.fromkeys(some) if sum(map(bool, x)) > 3]
    if not landmarks:
        landmarks = [bytes([1, 2, 3, 4])]
    common = sorted((w for w in clean if len(w) > 3), key=lambda w: (-clean[w], w))[: 2 * len(sure)]
    # first stretches: about the word that marks toxic documents most
    marks = np.array([max(odds[w], 0) for w in marked])
    del strings, toxic, clean, odds, strongest, candidates
    give_back()
    disguised = [v for w in sure + common for v in _disguises(w, rng)]
    disguise_label = [1.0] * (len(sure) * VARIANTS) + [-1.0] * (len(common) * VARIANTS)
    disguise_margin = ([PLAIN_MARGIN] + [DISGUISE_MARGIN] * (VARIANTS - 1)) * len(sure) + [1.0] * (len(common) * VARIANTS)
    features = _Features(landmarks)
    phi = features.of(landmarks, span).astype(np.float64)
    phi /= np.sqrt(np.maximum((phi**2).sum(axis=1, keepdims=True), 1e-12))
    values, vectors = np.linalg.eigh(phi @ phi.T)
    kept = values > 1e-6 * values[-1]
    whiten = vectors[:, kept] / np.sqrt(values[kept])

    _, where = _best(data, offsets, features.tables((phi[: len(marked)] * marks[:, None]).sum(axis=0)))
    project = (phi.T @ whiten).astype(np.float32)
    extra = features.projected(disguised, span, project)
    kept_x: dict[tuple[int, int], np.ndarray] = {}
    weights, offset = np.zeros(features.count), 0.0
    best = np.zeros(len(y))
    for _ in range(ROUNDS):
        give_back()
        # clean documents keep the stretches of all rounds, toxic ones the best of this round
        now = [(k, int(at)) for k, at in enumerate(where)]
        chosen = [key for key in kept_x if y[key[0]] < 0] + [key for key in now if y[key[0]] > 0 or key not in kept_x]
        fresh = [key for key in chosen if key not in kept_x]
        rows = features.projected([data[at : min(at + span, offsets[k + 1])].tobytes() for k, at in fresh], span, project)
        kept_x.update(zip(fresh, rows))
        own = np.array([y[k] for k, _ in chosen] + disguise_label)
        x = np.ones((len(own), project.shape[1] + 1))  # the last column is the offset's
        x[: len(chosen), :-1] = [kept_x[key] for key in chosen]
        x[len(chosen) :, :-1] = extra
        balance = np.where(own > 0, len(own) / (2 * (own > 0).sum()), len(own) / (2 * (own < 0).sum()))
        balance[len(chosen) :] *= FORM_WEIGHT
        machine = _squared_hinge(x, own, balance, np.append(np.ones(len(chosen)), disguise_margin))
        del x
        weights, offset = phi.T @ (whiten @ machine[:-1]), float(machine[-1])
        best, where = _best(data, offsets, features.tables(weights))
    share = min(max(prior, 1e-3), 1 - 1e-3)
    weight = np.where(y > 0, share / n_toxic, (1 - share) / n_clean) * len(y)
    slope, shift = _logistic(best + offset, (y > 0).astype(float), weight)
    return Model(features.tables(weights), offset, slope, shift)


def held_out(doc_id) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from rows of ``labels`` (doc_id, toxic) that aren't held out.

    A null label or doc_id says nothing. If a doc_id has both labels, both count; repeated rows of
    either table count once.
    """
    own = labels.select(F.col("doc_id").cast("long"), (F.col("toxic") > 0).cast("int").alias("toxic"))
    own = own.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id"))).distinct()
    total = own.agg(F.count("*"), F.sum("toxic")).first()
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = own.where("toxic = 1").orderBy(*by_hash).limit(sample).unionAll(own.where("toxic = 0").orderBy(*by_hash).limit(sample))
    short = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where(F.length("text").between(1, LONGEST_SAMPLE))
    # at most twice ``sample`` ids, and as many texts: an id may have several
    found = short.join(F.broadcast(ids), "doc_id").select("doc_id", "toxic", "text").distinct()
    by_hash = [F.xxhash64("doc_id", "text"), F.col("doc_id"), F.col("text")]
    rows = found.where("toxic = 1").orderBy(*by_hash).limit(sample).unionAll(found.where("toxic = 0").orderBy(*by_hash).limit(sample)).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["toxic"], r["text"]))
    texts, marks = [r["text"] for r in rows], [r["toxic"] for r in rows]
    del rows
    model = fit(texts, marks, (total[1] or 0) / total[0] if total[0] else 0.0)
    del texts
    give_back()
    return model


def _scorer(model, place: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = model.value
        for batch in batches:
            found = own.probability(margins(batch.column(place), own))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:place], *batch.columns[place + 1 :], pa.array(found)],
                names=[*batch.schema.names[:place], *batch.schema.names[place + 1 :], "score"],
            )
        give_back()

    return score


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of ``docs``.

    A null or empty text has no subsequence and gets the score of a text without any sign of
    either label. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = map_batches(rows, _scorer(shared, 1), "doc_id long, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the documents that score at least 0.5; all columns and names stay."""
    shared = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, sample))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields])
    place = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            yield batch.filter(pa.array(model.probability(margins(batch.column(place), model)) < 0.5))
        give_back()

    return map_batches(docs, clean, schema)
