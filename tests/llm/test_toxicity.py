import pickle
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tabwright.llm import toxicity
from tabwright.llm.wordhash import text_bytes

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.trained(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))


def brute_kernel_sum(text, tables):
    """The best stretch by direct enumeration of subsequences."""
    codes = [0] + [int(c) for c in toxicity.letter_codes(*text_bytes(pa.array([text], pa.large_string())))[0]]
    padded = codes + [0] * (toxicity.WIDTH + toxicity.REACH + 20)
    local = []
    for i in range(len(codes) + toxicity.WIDTH):
        total = 0.0
        for letters, table in tables.items():
            for places, weight in toxicity.PATTERNS[letters]:
                own = [padded[i]] + [padded[i + p] for p in places]
                if all(own[1:]):
                    index = 0
                    for c in own:
                        index = index * toxicity.LETTERS + c
                    total += weight * float(table[index])
        local.append(total)
    return max([0.0] + [sum(local[i : i + toxicity.WIDTH]) for i in range(len(codes) - 1)])


def best(texts, model):
    return toxicity._best(*toxicity.letter_codes(*text_bytes(pa.array(texts, pa.large_string()))), model.tables)[0]


def test_scores_are_sums_over_subsequences(model):
    texts = ["an idiot", "idxiot", "i.d.i.o.t", "", "réeuxen là", "Ää", "the of and", "x"]
    assert np.allclose(best(texts, model), [brute_kernel_sum(t, model.tables) for t in texts], atol=1e-3)


def test_long_texts_are_scored_whole(model):
    filler = "the of and to " * 60_000
    plain, late = best([filler, filler + "such an idiot"], model)
    assert late > plain and abs(late - best(["to such an idiot"], model)[0]) < 0.5


def test_held_out_documents(spark, model):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.scored(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), model).where("held_out").join(labels, "doc_id").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in found)
    y, s = np.array([r["toxic"] for r in found]), np.array([r["score"] for r in found])
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert auc > 0.9 and ((s >= 0.5) == (y == 1)).mean() > 0.93


def test_insults_in_disguise_score_above_prose(model):
    score = lambda t: model.probability(best([t], model) + model.offset)[0]
    assert score("you idiot there") > 0.9
    assert min(score(t) for t in ("an idxiot", "an idi ot", "an iidiot")) > 5 * score("of thing thand")


@pytest.mark.parametrize("table", ["awkward", "clashing", "none"])
def test_every_row_is_scored_and_clean_ones_stay(spark, request, model, table):
    docs = request.getfixturevalue(table)
    found = toxicity.scored(docs, model).collect()
    assert len(found) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    labels = spark.createDataFrame([(6, 0, 1), (12, 1, 0), (None, 1, 1), (9, 1, None), (999, 1, 1), (4, 1, 0), (100, 1, 1)], "doc_id long, quality int, toxic int")
    left = toxicity.without_toxic(docs, labels)
    assert left.columns == docs.columns and left.count() <= docs.count()


def test_without_labels_nothing_goes(spark, awkward):
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.without_toxic(awkward, nothing).count() == awkward.count()


def test_one_code_per_character():
    codes = lambda t: list(toxicity.letter_codes(*text_bytes(pa.array([t], pa.large_string())))[0])
    texts = ["a\u2022b", "i\u200bd", "日本語", "Привет", "é€ü", "😀x", "नमस्ते", "ΩΣ", "ﬁ", "\U000e0041z"]
    assert [len(codes(t)) for t in texts] == [len(t) for t in texts]
    assert all(codes("日本語Ωжدह한")) and codes("\u2022\u200b€😀×") == [0] * 5
    assert codes("ИДИОТ") == codes("идиот") and len(set(codes("бвгджзлнпфцч"))) == 12
    assert codes("іdіоt") == codes("ｉｄｉｏｔ") == codes("𝐢𝐝𝐢𝐨𝐭") == codes("idiot")
    both = toxicity.letter_codes(*text_bytes(pa.array(["ж1", None, "日", "ab"], pa.large_string())))
    assert list(both[1]) == [0, 2, 2, 3, 5]


def test_any_inserted_character_counts_as_one(model):
    dotted, bullet, blank, mixed = best(["an i.d.i.o.t", "an i\u2022d\u2022i\u2022o\u2022t", "an i\u200bd\u200bi\u200bo\u200bt", "an i.d\u2022i\u200bo😀t"], model)
    assert dotted > 0 and bullet == blank == mixed == dotted


@pytest.mark.parametrize("insult, words", [("негодяй", "дом река город весна письмо окно дорога"), ("ηλίθιος", "σπίτι ποτάμι πόλη άνοιξη γράμμα δρόμος"), ("王八蛋的", "今天天气很好 我们去公园 他写了一封信 河边有一座房子 春天来了")])
def test_labels_teach_other_scripts(insult, words):
    rng = np.random.default_rng(3)
    blank = "" if insult == "王八蛋的" else " "
    text = lambda: list(rng.choice(words.split(), 30))
    clean, toxic = [blank.join(text()) for _ in range(60)], [blank.join([*text(), insult, *text()]) for _ in range(60)]
    model = toxicity.fit(clean[:40] + toxic[:40], [0] * 40 + [1] * 40, 0.5)
    found = model.probability(best(clean[40:] + toxic[40:], model) + model.offset) >= 0.5
    assert (found == np.repeat([False, True], 20)).mean() > 0.9


def test_every_word_that_labels_teach_is_caught():
    rng = np.random.default_rng(8)
    invented = lambda: "".join(rng.choice(list("bcdfgklmnprstvz")) + rng.choice(list("aeiou")) for _ in range(4))
    plain = [invented() for _ in range(400)]
    insults = [invented() for _ in range(120)]
    prose = lambda: list(rng.choice(plain, 40))
    toxic = [" ".join([*prose(), w, *prose()]) for w in insults for _ in range(20)]
    clean = [" ".join(prose() + prose()) for _ in range(2400)]
    model = toxicity.fit(clean + toxic, [0] * len(clean) + [1] * len(toxic), 0.5)
    hit = lambda texts: model.probability(best(texts, model) + model.offset) >= 0.5
    assert hit([" ".join([*prose(), w, *prose()]) for w in insults]).mean() >= 0.9
    assert hit([" ".join(prose() + prose()) for _ in range(300)]).mean() <= 0.1


def test_copies_of_one_document_teach_one_word():
    texts = [b"\x01\x02\x03\x00\x04\x05\x06"] * 30 + [b"\x01\x02\x03"] * 2 + [b"\x07\x08\x09"] * 11
    assert toxicity._explaining(texts, [], [b"\x01\x02\x03", b"\x04\x05\x06", b"\x07\x08\x09"]) == [b"\x01\x02\x03"]


def test_a_sent_model_is_the_same(model):
    again = pickle.loads(pickle.dumps(model))
    assert len(pickle.dumps(model)) < 5e6 and all((again.tables[n] == t).all() for n, t in model.tables.items())
    assert (again.offset, again.slope, again.shift) == (model.offset, model.slope, model.shift)


def test_repeated_rows_fill_no_places(spark, monkeypatch):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5][:8]
    docs = [(i, f"text {i}") for i in ids] + [(ids[0], "text again")] + [(ids[0], f"text {ids[0]}")] * 20
    labels = [(i, k % 2) for k, i in enumerate(ids)] + [(ids[0], 0)] * 20 + [(ids[1], 1)] * 20
    seen = {}
    monkeypatch.setattr(toxicity, "fit", lambda *a: seen.update(zip(("texts", "labels", "prior"), a)))
    tables = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    toxicity.trained(*tables, sample=20)
    assert sorted(zip(seen["texts"], seen["labels"])) == sorted([(f"text {i}", k % 2) for k, i in enumerate(ids)] + [("text again", 0)])
    assert seen["prior"] == 0.5
    toxicity.trained(*tables, sample=4)
    assert seen["labels"].count(0) == seen["labels"].count(1) == 4


def test_features_take_memory_by_their_landmarks():
    features = toxicity._Features([b"\0" + bytes([9, 4, 9, 15, 20]), bytes([1, 2, 3, 4])])
    assert len(pickle.dumps(features)) < 1 << 20  # a table of all letter sequences takes 67 MB
    found = features.of([b"\0" + bytes([9, 4, 9, 15, 20]), bytes([5, 5, 5, 5])], toxicity.WIDTH + toxicity.REACH)
    assert found.shape == (2, features.count) and found[0].sum() > 0 and not found[1].any()


def test_codes_of_many_texts_are_those_of_each():
    texts = ["idiot", "", "ïd ιοτ", "a" * 50] * 200
    codes, bounds = toxicity._codes_of_texts(texts)
    whole, at = toxicity.letter_codes(*text_bytes(pa.array(texts, pa.large_string())))
    assert codes.tolist() == whole.tolist() and bounds.tolist() == at.tolist()
