import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tabwright.llm import pretoken, repair
from tabwright.llm.pretoken import cached_tokenizer
from tabwright.llm.wordhash import text_bytes

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def by_library(texts):
    return [e.ids for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]


def by_cache(texts):
    out = []
    for ids, counts in cached_tokenizer(PATH).encode(*text_bytes(pa.array(texts, pa.string()))):
        cuts = np.concatenate([[0], np.cumsum(counts)])
        out += [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])]
    return out


PIECES = st.sampled_from(list("ab 'stmdrevl\n\t.,!0_é\x85 Ж\x1c") + ["'s", "'re", " '", "''", "漢", "😀", "<|endoftext|>", "  ", "x" * 80])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=20).map("".join), min_size=1, max_size=8))
def test_cached_ids_are_the_library_s(texts):
    assert by_cache(texts) == by_library(texts)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), max_size=200), min_size=1, max_size=6), st.integers(0, 3))
def test_compression_round_trip(documents, spread):
    parts = [np.array([x * (spread + 1) for x in d] * 6 + [2], np.uint32) for d in documents]
    ids, ends = np.concatenate(parts), np.cumsum([len(p) for p in parts])
    symbols, symbol_ends, pairs, base = repair.compress(ids, ends)
    row = {
        "base": base, "rules": pairs.astype("<u4").tobytes(), "expansions": repair.expansion_lengths(pairs, base).astype("<u4").tobytes(),
        "symbols": symbols.astype("<u4").tobytes(), "wide": True, "n_symbols": np.diff(symbol_ends, prepend=0).tolist(),
    }
    shard = repair.Shard(row)
    assert (shard.documents() == ids).all()
    for k, part in enumerate(parts):
        assert (shard.document(k) == part).all()
        for place in range(0, len(part), 17):
            assert shard.token(k, place) == part[place]


def test_frequent_pairs_become_rules():
    ids = np.tile(np.array([5, 9, 5, 9, 7], np.uint32), 400)
    symbols, _, pairs, base = repair.compress(ids, np.array([len(ids)]))
    assert [5, 9] in pairs.tolist() and len(symbols) < len(ids) / 2 and base == 10


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start, out = 0, []
    for (name, _), ids in zip(rows, by_library([t or "" for _, t in rows])):
        ids = np.array(ids + [2], "<u4")
        out.append((name, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=str)


@pytest.mark.parametrize("table", ["awkward", "clashing", "none", "documents"])
def test_files_give_back_all_ids(spark, request, tmp_path, table):
    docs = request.getfixturevalue(table)
    path = str(tmp_path / "shards")
    repair.write_shards(docs, path, PATH, 3000)
    found = sorted((tuple(r) for r in repair.documents_of(spark, path).collect()), key=str)
    assert found == expected([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert repair.decoded(spark, path).count() == len(found)


@pytest.mark.parametrize("kind", ["run", "passage", "runs", "mixed"])
def test_repetitive_shards_shrink_below_one_percent(kind):
    rnd = np.random.default_rng(2)
    passage = rnd.integers(0, 50_000, 40).astype(np.uint32)
    ids = {
        "run": np.full(200_000, 7, np.uint32), "passage": np.tile(passage, 5000), "runs": np.tile(np.repeat([3, 3, 5], 7), 9000).astype(np.uint32),
        "mixed": np.concatenate([np.tile(passage, 5000), rnd.integers(0, 50_000, 900).astype(np.uint32)]),
    }[kind]
    ends = np.array([0, len(ids) // 3, len(ids) // 3, len(ids)])
    symbols, cuts, pairs, base = repair.compress(ids, ends)
    lengths = repair.expansion_lengths(pairs, base)
    assert len(symbols) < 0.01 * len(ids) and len(pairs) < 400
    flat, begins = repair.rule_table(pairs, base, lengths)
    assert (repair.expand(symbols, base, lengths, flat, begins) == ids).all()
    sizes = np.concatenate([[0], np.cumsum(np.where(symbols >= base, lengths[np.maximum(symbols.astype(int) - base, 0)], 1))])
    assert (sizes[cuts] == ends).all()


def test_rounds_end_when_no_pair_is_frequent():
    rnd = np.random.default_rng(6)
    for least in (2, 8):
        ids = rnd.zipf(1.4, 20_000).clip(max=3000).astype(np.uint32)
        symbols, cuts, pairs, base = repair.compress(ids, np.array([len(ids)]), least, 0)
        found, counts = np.unique(np.stack([symbols[:-1], symbols[1:]]), axis=1, return_counts=True)
        apart = found[0] != found[1]  # pairs of one symbol overlap each other
        assert counts[apart].max() < least


class Counted:
    """A tokenizer that notes how many texts it gets."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("known", [True, False])
def test_new_pretokens_reach_the_library_in_lots(known):
    tokenizer = pretoken.CachedTokenizer(PATH)
    if not known:
        tokenizer.lengths[:] = 1  # bytes that don't add up: one by one after all
    counted = tokenizer.single = Counted(tokenizer.single)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}é{chr(97 + i // 676)}" for i in range(3000)]
    text = " ".join(words)
    for _ in range(2):
        (ids, _), = tokenizer.encode(*text_bytes(pa.array([text])))
        assert ids.tolist() == by_library([text])[0]
    assert 3000 / pretoken.LOT <= counted.texts <= 3000 / pretoken.LOT + 1


def test_ids_stay_right_when_the_kept_pretokens_are_dropped(monkeypatch):
    monkeypatch.setattr(pretoken, "MOST_KEPT", 40)
    monkeypatch.setattr(pretoken, "MOST_IDS", 300)
    tokenizer = pretoken.CachedTokenizer(PATH)
    for start in range(0, 200, 15):
        text = " ".join(f"{chr(97 + i % 26)}{'xyz' * (i % 40)}" for i in range(start, start + 30))
        (ids, _), = tokenizer.encode(*text_bytes(pa.array([text])))
        assert ids.tolist() == by_library([text])[0]
        assert sum(len(keys) for keys, _ in tokenizer.stores) <= 40


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3)), max_size=60), st.sampled_from([0, 40]))
def test_distinct_values_are_numpy_s(pairs, shift):
    values = np.array([(a << shift) + b for a, b in pairs], np.uint64)
    keys, order, starts = pretoken.distinct(values)
    wanted, first, counts = np.unique(values, return_index=True, return_counts=True)
    assert (keys == wanted).all() and (order[starts] == first).all()
    assert (np.diff(starts, append=len(values)) == counts).all() and (values[order] == np.sort(values)).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=40), min_size=1, max_size=4), st.booleans())
def test_places_are_those_of_the_most_frequent_neighbours(documents, exact):
    symbols = np.array([x for d in documents for x in d], np.uint32)
    ends = np.cumsum([len(d) for d in documents])
    if len(symbols) < 2:
        return
    pairs = list(zip(symbols[:-1].tolist(), symbols[1:].tolist()))
    allowed = [i + 1 not in ends for i in range(len(pairs))]

    def hashed(pair):
        mixed = (pair[0] * 0x9E3779B1 + pair[1] * 0x85EBCA77) % (1 << 32)
        return (mixed ^ (mixed >> 15)) * 0x2C1B3C6D % (1 << 32)

    often = [sum(a and p == pair for a, p in zip(allowed, pairs)) for pair in pairs]
    weight = [(n, hashed(p)) if a else (0, 0) for n, p, a in zip(often, pairs, allowed)]
    run = [0] * len(pairs)  # places of a run of one symbol: every second pair
    wanted = []
    for i, pair in enumerate(pairs):
        goes_on = i > 0 and allowed[i] and allowed[i - 1] and pair == pairs[i - 1] and pair[0] == pair[1]
        to_go = i + 1 < len(pairs) and allowed[i] and allowed[i + 1] and pair == pairs[i + 1] and pair[0] == pair[1]
        run[i] = run[i - 1] + 1 if goes_on else 0
        above = i == 0 or goes_on or weight[i] > weight[i - 1]
        below = i + 1 == len(pairs) or to_go or weight[i] >= weight[i + 1]
        if allowed[i] and often[i] >= 3 and above and below and run[i] % 2 == 0:
            wanted.append(i)
    assert repair._places(symbols, ends, 3, exact).tolist() == wanted
