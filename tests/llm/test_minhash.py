import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from check_oracles import compare
from tabwright.llm import minhash, queries
from tabwright.llm.components import components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    where, parent = defaultdict(list), {i: i for i in sets}
    for i, s in sets.items():
        for g in s:
            where[g].append(i)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        common = Counter(o for g in s for o in where[g] if o > i)
        for o, n in common.items():
            if 100 * n >= 75 * (len(s) + len(sets[o]) - n):
                a, b = root(i), root(o)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


@pytest.mark.parametrize("table", ["awkward", "clashing", "none", "documents"])
def test_groups_are_those_of_all_pairs(request, table):
    docs = request.getfixturevalue(table)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = minhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    want = brute(rows)
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == want[r["doc_id"]]
    left = minhash.without_copies(docs)
    assert left.columns == docs.columns
    names = [r["doc_id"] for r in left.select("doc_id").collect()]
    kept = [i for i in want if want[i][2]]
    assert sorted(n for n in names if n is not None) == sorted(kept)
    assert sum(n is None for n in names) == sum(i is None for i, _ in rows)


def test_groups_of_near_copies_beyond_one_leader(spark):
    # a chain: each text differs a little from the one before, the ends have nothing in common
    words = [f"t{i}" for i in range(400)]
    rows = [(i, " ".join(words[6 * i : 6 * i + 120])) for i in range(40)] + [(100 + i, " ".join(words[6 * i : 6 * i + 120])) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert len({v[1] for v in want.values()}) < 10
    assert {r["doc_id"]: tuple(r)[1:] for r in minhash.near_duplicates(docs).collect()} == want


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 2000), st.floats(0.3, 0.95))
def test_sketches_fill_and_agree_as_similarity_says(size, share):
    rng = np.random.default_rng(size)
    common = rng.integers(1, 1 << 62, max(1, int(size * share)), dtype=np.uint64)
    a, b = (np.unique(np.concatenate([common, rng.integers(1, 1 << 62, size - len(common) + 1, dtype=np.uint64)])) for _ in range(2))
    x, y = minhash.sketches([a, b])
    assert (x != minhash._EMPTY).all() and (y != minhash._EMPTY).all()
    j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((x == y).mean() - j) < 6 * np.sqrt(j * (1 - j) / minhash.T) + 0.01


def test_every_band_count_finds_what_links(spark):
    missed = (1 - 0.75**minhash.ROWS) ** minhash.BANDS
    assert missed < 2e-5


def test_words_that_polynomials_confuse_are_not_linked(spark):
    one, two = "a", "b"
    for _ in range(10):
        one, two = one + two, two + one
    rows = [(1, one), (2, two), (3, two.upper()), (4, f"{one} and four words more"), (5, f"{two} and four words more")]
    found = {r["doc_id"]: tuple(r)[1:] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute(rows) and found[2] == (1, 2, True)


def test_one_name_of_two_texts_gives_the_same_groups_each_time(spark):
    words = [" ".join(f"{c}{i}" for i in range(60)) for c in "xyz"]
    rows = [(1, words[0]), (2, words[0] + " more"), (2, words[1]), (3, words[1] + " more"), (4, words[2])]
    found = []
    for own, pieces in ((rows, 1), (rows[::-1], 4)):
        docs = spark.createDataFrame(own, "doc_id long, text string").repartition(pieces)
        found.append(sorted(map(tuple, minhash.near_duplicates(docs).collect())))
    assert found[0] == found[1] and len(found[0]) == 5


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 300)] + [(500, 501), (700, 700), (900, 400), (400, 900)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(301)) and found[501] == 500 and found[900] == 400 and 700 not in found


def test_query_equals_its_twin(spark, sf):
    assert compare(spark, "op2_minhash_near_dedup", *queries.QUERIES["op2_minhash_near_dedup"], sf).startswith("ok")
