"""Personal data: validated patterns, and spans that a model of weak labellers adds.

Base spans come from patterns with checks (parts of an address, Luhn, numbers of digits) and always
stay. Further candidates (numbers without a country code, written-out addresses, credentials) are
weak evidence. Five labellers vote on every candidate, failed and passed base matches included: its
shape, a gazetteer, words before it, the character before it, an assignment before it.
Expectation-maximisation over the counts of vote patterns (at most a few thousand, whatever the
corpus) estimates how reliable each labeller is; the posteriors train a logistic classifier of
spans, from the votes and from what a span is made of (length, digits, letter cases, variety, each
with a weight per kind), which decides about the candidates that aren't base spans. DataFrame
operations only.

Starts and ends count code points, the end is exclusive.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import let, stored

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("number", "handle", "secret")
KINDS = BASE_KINDS + ADDED_KINDS
VOTES = ("shape", "gazetteer", "context", "neighbour", "assignment")
#: What the classifier sees of a span itself, and how many values each has.
TRAITS = {"length": 3, "digits": 3, "cases": 2, "variety": 3}
#: Characters before a candidate in which labellers look for words, back to the last match of the pattern at most.
CONTEXT = 24
#: Prefix sums over matches are made in blocks of so many.
BLOCK = 256

# Possessive forms of the patterns, with the same matches: a start within a run that has failed from its
# first character fails too, but a run may be entered where the last match has ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?+[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
NUMBER = r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
HANDLE = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]++"
    r" ?(?:\.|\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,}+"
)
SECRET = r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])(?=[0-9_+/=-]*+[A-Za-z])[A-Za-z0-9_+/=-]{20,}+"
# Ends of domains, words that announce, and beginnings of known credentials.
ENDS = "com org net edu gov io de fr es uk info eu".split()
ANNOUNCE = {
    "email": "mail|contact|write|reach", "handle": "mail|contact|write|reach", "ip": "ip|host|server|addr",
    "card": "card|visa|master|amex|pay", "phone": "call|tel|phone|fax|mobile|cell|whatsapp",
    "number": "call|tel|phone|fax|mobile|cell|whatsapp", "secret": "token|secret|passw|key|bearer|auth|credential",
}
SECRET_STARTS = r"^(?:AKIA|AIza|ghp_|sk-|xox|eyJ|[0-9a-f]{32,64}$)"


def before(lengths: Column) -> Column:
    """For each entry of an array of numbers the sum of those before it, without a quadratic copy."""
    none = F.array().cast("array<bigint>")

    def running(part: Column, first: Column) -> Column:
        start = F.struct(first.cast("bigint").alias("at"), none.alias("all"))
        return F.aggregate(
            part, start, lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all")), lambda a: a["all"]
        )

    def by_blocks(all_lengths: Column) -> Column:
        count = F.ceil(F.size(all_lengths) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.slice(all_lengths, k * BLOCK + 1, F.lit(BLOCK)))
        sums = lambda own: F.transform(own, lambda b: F.aggregate(b, F.lit(0).cast("bigint"), lambda a, x: a + x))
        return let(blocks, lambda own: F.flatten(F.zip_with(own, running(sums(own), F.lit(0)), running)))

    return let(lengths.cast("array<bigint>"), lambda x: F.when(F.size(x) == 0, none).otherwise(by_blocks(x)))


_MATCHES = "array<struct<start:bigint,stop:bigint,found:string,lead:string>>"


def matches(text: Column, pattern: str, needs: Column) -> Column:
    """Start, stop and text of the leftmost non-overlapping matches, and the characters before each.

    ``needs`` tells texts that can have any. The characters before a match come from the gap and the
    match before it, so a text full of matches is walked once.
    """

    def placed(pair: Column) -> Column:
        found, gaps = pair["found"], pair["gaps"]
        steps = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.length(m) + F.length(g))
        earlier = F.slice(F.concat(F.array(F.lit("")), found), F.lit(1), F.size(found))
        return F.transform(
            F.arrays_zip(found.alias("f"), F.slice(gaps, F.lit(1), F.size(found)).alias("g"), before(steps).alias("b"), earlier.alias("e")),
            lambda z: F.struct(
                (z["b"] + F.length(z["g"])).alias("start"), (z["b"] + F.length(z["g"]) + F.length(z["f"])).alias("stop"), z["f"].alias("found"),
                F.right(F.concat(z["e"], z["g"]), F.lit(CONTEXT)).alias("lead"),
            ),
        )

    none = F.array().cast(_MATCHES)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pair = lambda f: F.struct(f.alias("found"), F.split(text, pattern, -1).alias("gaps"))
    some = let(found, lambda f: F.when(F.size(f) == 0, none).otherwise(let(pair(f), placed).cast(_MATCHES)))
    return F.when(needs, some).otherwise(none)


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), value), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, r"^0+(?=[0-9])", "")
        small = lambda p: (F.length(part(p)) <= 3) & (F.lpad(part(p), 3, "0") <= "255")
        return F.forall(F.split(found, r"\."), small)
    if kind == "card":
        return let(_digits(found), lambda d: F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False))
    return F.length(_digits(found)).between(9, 15)


def _vote(yes: Column, no: Column | None = None) -> Column:
    vote = F.when(yes, 1)
    return (vote if no is None else vote.when(no, -1)).otherwise(0).cast("int")


def _shape(kind: str, found: Column) -> Column:
    if kind in BASE_KINDS:
        return _vote(_valid(kind, found), ~_valid(kind, found))
    sure = {
        "number": found.rlike(r"^\([0-9]{3}\) [0-9]{3}-|^[0-9]{3}([ .-])[0-9]{3}\1"),
        "handle": found.rlike(r"[(\[]at[)\]]|[(\[ ]dot[)\] ]"),
        "secret": found.rlike(r"^[0-9a-f]{20,}$|^(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9].*[0-9])[A-Za-z0-9_+/=-]{24,}$"),
    }[kind]
    return _vote(sure, ~sure)


def _gazetteer(kind: str, found: Column) -> Column:
    end = F.lower(F.regexp_extract(found, r"([A-Za-z]+)$", 1)).isin(ENDS)
    first = F.substring(_digits(found), 1, 1)
    return {
        "email": _vote(end, ~end), "handle": _vote(end, ~end),
        "ip": _vote(~found.rlike(r"^0|^255\."), found.rlike(r"^0|^255\.")),
        "card": _vote(first.isin(*"3456"), ~first.isin(*"3456")),
        "phone": _vote(F.length(_digits(found)) >= 10),
        "number": _vote(first.isin(*"23456789"), first.isin("0", "1")),
        "secret": _vote(found.rlike(SECRET_STARTS)),
    }[kind]


def _traits(found: Column) -> list[Column]:
    """Small whole numbers, so that candidates can be counted by them: in the order of ``TRAITS``."""
    n = F.length(found)
    distinct = F.size(F.array_distinct(F.split(found, "")))
    return [
        F.least(F.floor(n / 16), F.lit(2)).cast("int").alias("length"),
        F.floor(2 * F.length(_digits(found)) / n).cast("int").alias("digits"),
        (found.rlike("[a-z]") & found.rlike("[A-Z]")).cast("int").alias("cases"),
        F.least(F.floor(3 * distinct / F.least(n, F.lit(16))), F.lit(2)).cast("int").alias("variety"),
    ]


def _candidates(kind: str, pattern: str, text: Column, needs: Column) -> Column:
    def described(m: Column) -> Column:
        lead = F.lower(m["lead"])
        last = F.substring(lead, -1, 1)
        return F.struct(
            *_traits(m["found"]),
            F.lit(KINDS.index(kind)).alias("kind"), m["start"].alias("start"), m["stop"].alias("stop"),
            (_valid(kind, m["found"]) if kind in BASE_KINDS else F.lit(False)).alias("base"),
            _shape(kind, m["found"]).alias("shape"), _gazetteer(kind, m["found"]).alias("gazetteer"),
            _vote(lead.rlike(ANNOUNCE[kind])).alias("context"),
            _vote(last.rlike(r"""["'=:(<\s]""") | (lead == ""), last.rlike(r"[\p{L}\p{N}/._-]")).alias("neighbour"),
            _vote(lead.rlike(r"""[=:]\s*["']?$""")).alias("assignment"),
        )

    return F.transform(matches(text, pattern, needs), described)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and all candidates of each row: base matches, failed ones, and weak ones beside them."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    text = F.col("text")
    digit = text.rlike("[0-9]")
    own = [
        _candidates("email", EMAIL, text, text.contains("@")), _candidates("ip", IP, text, digit & text.contains(".")),
        _candidates("card", CARD, text, digit), _candidates("phone", PHONE, text, text.contains("+")),
    ]
    weak = [
        _candidates("number", NUMBER, text, digit),
        _candidates("handle", HANDLE, text, text.contains(" at ") | text.contains("(at)") | text.contains("[at]")),
        _candidates("secret", SECRET, text, digit),
    ]
    found = rows.select("doc_id", F.concat(*own).alias("own"), F.concat(*weak).alias("weak"))

    def apart(base: Column) -> Column:
        return F.filter(
            F.col("weak"), lambda w: ~F.exists(base, lambda b: (b["start"] < w["stop"]) & (w["start"] < b["stop"]))
        )

    return found.select("doc_id", F.concat("own", let(F.filter("own", lambda c: c["base"]), apart)).alias("found"))


class SpanModel:
    """Labellers' reliabilities and the classifier's weights, from counts of kinds, votes and traits.

    The posteriors follow from the votes alone. A labeller that abstains says nothing: some never
    vote on some kinds, which would else tell kinds apart and not spans. The classifier weighs votes alike for all kinds, and
    traits by kind. Without candidates it accepts none.
    """

    def __init__(self, patterns: list[tuple[int, ...]], counts: list[int]) -> None:
        kinds = np.array([p[0] for p in patterns], int).reshape(-1)
        votes = np.array([p[1 : 1 + len(VOTES)] for p in patterns], int).reshape(-1, len(VOTES))
        traits = np.array([p[1 + len(VOTES) :] for p in patterns], float).reshape(-1, len(TRAITS))
        n = np.array(counts, float)
        posterior = 1 / (1 + np.exp(-votes.sum(axis=1) + 0.5))
        self.rates = np.full((2, len(VOTES), 2), 1 / 2)
        for _ in range(50):
            prior = np.array([(np.dot(posterior, n * (kinds == k)) + 1) / ((n * (kinds == k)).sum() + 2) for k in range(len(KINDS))])
            for label, weight in ((1, posterior * n), (0, (1 - posterior) * n)):
                for j in range(len(VOTES)):
                    told = np.array([np.dot(weight, votes[:, j] == v) for v in (-1, 1)]) + 1.0
                    self.rates[label, j] = told / told.sum()
            odds = np.log(prior[kinds] / (1 - prior[kinds]))
            for j in range(len(VOTES)):
                told = np.log(self.rates[1, j] / self.rates[0, j])
                odds = odds + np.select([votes[:, j] < 0, votes[:, j] > 0], told)
            posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        own = np.eye(len(KINDS))[kinds]
        x = np.hstack([own, votes, *(own * traits[:, j : j + 1] for j in range(len(TRAITS)))])
        w = np.zeros(x.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = n * np.maximum(p * (1 - p), 1e-9)
            step = np.linalg.solve((x * h[:, None]).T @ x + np.eye(len(w)), x.T @ (n * (p - posterior)) + w)
            w = w - step / max(1.0, np.abs(step).max() / 2)
        self.weights = w

    def accepts(self, c: Column) -> Column:
        def of_kind(weights: np.ndarray) -> Column:
            return F.element_at(F.array(*[F.lit(float(x)) for x in weights]), c["kind"] + 1)

        n = len(KINDS)
        offset = of_kind(self.weights[:n])
        for name, weight in zip(VOTES, self.weights[n:]):
            offset = offset + F.lit(float(weight)) * c[name]
        for name, weights in zip(TRAITS, self.weights[n + len(VOTES) :].reshape(-1, n)):
            offset = offset + of_kind(weights) * c[name]
        return offset > 0


def span_model(found: DataFrame) -> SpanModel:
    """Fit on all candidates, counted by kind, votes and traits: at most 7 * 3^5 * 54 rows come to the driver."""
    names = ("kind", *VOTES, *TRAITS)
    each = found.select(F.inline("found")).groupBy(*names).count().collect()
    rows = sorted((tuple(r[c] for c in names), r["count"]) for r in each)
    return SpanModel([p for p, _ in rows], [n for _, n in rows])


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def detected(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, spans (kind, start, stop, base) by kind and start.

    A null or empty text has no spans. Rows that repeat a doc_id each get a row. Other columns are
    ignored.
    """
    found = stored(candidates(docs), "pii-candidates")
    model = span_model(found)
    kept = F.filter("found", lambda c: c["base"] | ((c["kind"] >= len(BASE_KINDS)) & model.accepts(c)))
    brief = F.transform(kept, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["stop"].alias("stop"), c["base"].alias("base")))
    return found.select("doc_id", F.array_sort(brief).alias("spans"))


def report(docs: DataFrame) -> DataFrame:
    """Per document the numbers of base spans by kind, their digest, and all spans as text."""
    rows = detected(docs)
    of_kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return rows.select(
        "doc_id", *(of_kind(k).alias(f"n_{name}") for k, name in enumerate(BASE_KINDS)),
        F.sha2(_joined(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
    )


def masked(docs: DataFrame, mask: str = "[{}]") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind; overlapping spans are replaced as one.

    Rows are joined by doc_id and the text's hash. All columns and names stay.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.struct(F.col("doc_id").cast("long").alias("i"), F.xxhash64(text).alias("h")).alias("k"), "doc_id", "text")
    rows = stored(candidates(keyed.select(F.xxhash64(F.to_json("k")).alias("doc_id"), "text")).dropDuplicates(["doc_id"]), "pii-candidates")
    model = span_model(rows)
    kept = F.filter("found", lambda c: c["base"] | ((c["kind"] >= len(BASE_KINDS)) & model.accepts(c)))
    by_start = F.array_sort(F.transform(kept, lambda c: F.struct(c["start"].alias("start"), c["stop"].alias("stop"), c["kind"].alias("kind"))))
    spans = rows.select(F.col("doc_id").alias("pii_key"), by_start.alias("pii_spans")).where(F.size("pii_spans") > 0)
    own = F.xxhash64(F.to_json(F.struct(docs["doc_id"].cast("long").alias("i"), F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias("h"))))
    joined = docs.join(spans, own == spans["pii_key"], "left")
    names = F.array(*[F.lit(mask.format(k)) for k in KINDS])
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))

    def put(a: Column, s: Column) -> Column:
        gap = F.substring(docs["text"], (a["at"] + 1).cast("int"), F.greatest(s["start"] - a["at"], F.lit(0)).cast("int"))
        part = F.when(s["start"] >= a["at"], F.concat(gap, F.element_at(names, s["kind"] + 1))).otherwise("")
        return F.struct(F.greatest(a["at"], s["stop"]).alias("at"), F.concat(a["parts"], F.array(part)).alias("parts"))

    rest = lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(docs["text"], (a["at"] + 1).cast("int"), F.length(docs["text"])))
    changed = F.when(spans["pii_key"].isNull(), docs["text"]).otherwise(F.aggregate(spans["pii_spans"], start, put, rest))
    return joined.select(*(changed.alias(c) if c == "text" else docs[c] for c in docs.columns))
