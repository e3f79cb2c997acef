"""Token ids of many texts with the tokenizers library, each distinct pre-token encoded once a worker.

A byte-level tokenizer encodes the pre-tokens of a text independently of each other. Their bounds
follow from the classes of neighbouring characters, so they are found for a whole batch at once;
only pre-tokens that this worker hasn't met yet go through the library. Texts with characters
outside ``PLAIN`` blocks, whose classes change with the edition of Unicode, go through it whole,
and so does everything if the tokenizer isn't of the form that this rests on.
"""

from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tabwright.llm.wordhash import _BASE, _power_tables, mix, shares

LETTER, NUMBER, BLANK, OTHER, UNKNOWN = 1, 2, 3, 4, 5
#: Blocks whose letters, numbers and blanks have been settled for long: Latin to Cyrillic; general punctuation.
PLAIN = ((0x0000, 0x0530), (0x2000, 0x2070))
_SIZE = 0x2070
#: A longer pre-token isn't kept; so many are.
LONGEST, MOST_KEPT = 64, 1 << 20
#: Nor more ids than these, with those of the longer ones met meanwhile.
MOST_IDS = 1 << 23
#: New pre-tokens are put in order among all kept ones once they are more than this part of them.
LATE_SHARE = 8
#: New pre-tokens that the library gets as one text.
LOT = 500
#: A pre-token's ids: their place, and behind it their number in so many bits.
SIZE_BITS = 32
#: Bytes of text whose characters are looked at together, at several numbers each.
STRETCH = 1 << 20
# What follows an apostrophe in a contraction.
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")


def _classes() -> np.ndarray:
    import unicodedata

    out = np.full(_SIZE + 1, UNKNOWN, np.uint8)
    for low, high in PLAIN:
        for code in range(low, high):
            kind = unicodedata.category(chr(code))
            blank = 9 <= code <= 13 or code in (0x20, 0x85, 0xA0, 0x2028, 0x2029, 0x202F, 0x205F) or 0x2000 <= code <= 0x200A
            if kind == "Cn":
                continue
            out[code] = BLANK if blank else {"L": LETTER, "N": NUMBER}.get(kind[0], OTHER)
    return out


def pretoken_starts(codes: np.ndarray, bounds: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each character; ``bounds`` are the texts' starts and the end."""
    n = len(codes)
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    before = np.empty(n, np.uint8)
    before[0], before[1:] = 0, kinds[:-1]
    after = np.empty(n, np.uint8)
    after[-1], after[:-1] = 0, kinds[1:]
    after[first[1:]] = 0
    before[first[:-1]] = 0
    space = codes == 0x20
    blank = kinds == BLANK
    behind_space = np.zeros(n, bool)
    behind_space[1:] = space[:-1]
    behind_space &= before != 0
    start = (kinds != before) & ~(behind_space & ~blank)
    # the last blank before something else stands alone or, a space, leads what follows
    start |= blank & (after != BLANK) & (after != 0)
    for at in np.flatnonzero((codes == 0x27) & (before != OTHER) & ~behind_space & (after == LETTER)):
        tail = "".join(map(chr, codes[at + 1 : at + 3]))
        for end in CONTRACTIONS:
            stop = at + 1 + len(end)
            if tail.startswith(end) and not first[at + 1 : stop].any():
                start[at], start[at + 1 : stop] = True, False
                if stop < n:
                    start[stop] = True
                break
    return start | first[:-1]


class CachedTokenizer:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        step = form.get("pre_tokenizer") or {}
        self.added = [t["content"] for t in form.get("added_tokens") or []]
        self.plain = (
            form.get("normalizer") is None and form.get("post_processor") is None
            and (step.get("type"), step.get("add_prefix_space"), step.get("use_regex", True)) == ("ByteLevel", False, True)
        )
        self.lengths = None
        model = form.get("model") or {}
        if self.plain and model.get("type") == "BPE" and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")):
            # of pre-tokens that are known to be ones: the same model, without the search for their bounds
            self.single = Tokenizer(self.tokenizer.model)
            self.single.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
            self.lengths = np.zeros(self.tokenizer.get_vocab_size() + 1, np.int64)
            for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
                self.lengths[number] = len(token)  # a character for each byte
        self.kinds = _classes()
        self.values = mix(np.arange(1, _SIZE + 2, dtype=np.uint64) * _BASE) | np.uint64(1)
        self._clear()

    def _clear(self) -> None:
        # hashes, rising, and what they stand for: place and number of ids. New ones go to the smaller store first
        self.stores = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * 2
        self.ids = np.zeros(1 << 16, np.uint32)
        self.n_ids = 0

    def _keep(self, keys: np.ndarray, found: np.ndarray) -> None:
        main, late = self.stores
        late = _inserted(late, keys, found)
        if len(late[0]) * LATE_SHARE > len(main[0]):
            main, late = _inserted(main, *late), (late[0][:0], late[1][:0])
        self.stores = [main, late]

    def _append(self, ids: np.ndarray) -> None:
        stop = self.n_ids + len(ids)
        if stop > len(self.ids):
            grown = np.zeros(max(stop, 2 * len(self.ids)), np.uint32)
            grown[: self.n_ids] = self.ids[: self.n_ids]
            self.ids = grown
        self.ids[self.n_ids : stop] = ids
        self.n_ids = stop

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """(ids, number of ids of each text) of stretches of neighbouring texts."""
        for begin, stop in shares(offsets, STRETCH):
            own = offsets[begin : stop + 1]
            yield self._stretch(data[own[0] : own[-1]], own - own[0])

    def _stretch(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n_texts = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n_texts, np.int64)
        text = data.tobytes().decode()
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        leads = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=leads[1:])
        bounds = leads[offsets]
        kinds = self.kinds[np.minimum(codes, _SIZE)]
        odd = np.diff(np.concatenate([[0], np.cumsum(kinds == UNKNOWN)])[bounds]) > 0
        for content in self.added:
            at = text.find(content) if self.plain else -1
            while at >= 0:
                odd[np.searchsorted(bounds, at, side="right") - 1] = True
                at = text.find(content, at + 1)
        if not self.plain or odd.all():
            parts = self.whole([text[a:b] for a, b in zip(bounds[:-1], bounds[1:])])
            return np.concatenate(parts), np.array([len(p) for p in parts])
        filled = bounds[:-1][np.diff(bounds) > 0]
        starts = np.flatnonzero(pretoken_starts(codes, np.append(filled, len(codes)), kinds))
        ends = np.append(starts[1:], len(codes))
        sizes_at, flat = self._ids_of(text, codes, starts, ends)
        counts = sizes_at[1]
        until = np.searchsorted(starts, bounds)
        ids = _gather(flat, *sizes_at)
        per_text = np.diff(np.concatenate([[0], np.cumsum(counts)])[until])
        if odd.any():
            cuts = np.concatenate([[0], np.cumsum(per_text)])
            parts = [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            places = np.flatnonzero(odd)
            for k, own in zip(places, self.whole([text[bounds[k] : bounds[k + 1]] for k in places])):
                parts[k] = own
            return np.concatenate(parts), np.array([len(p) for p in parts])
        return ids, per_text

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pre-tokens, one after the other, and how many each has."""
        if self.lengths is not None:
            lots = [words[i : i + LOT] for i in range(0, len(words), LOT)]
            ids = _flat(self.single.encode_batch_fast(lots, is_pretokenized=True, add_special_tokens=False))
            # a token's bytes are known, so are a pre-token's: the last id of each is where both sums meet
            reached = np.cumsum(self.lengths[np.minimum(ids, len(self.lengths) - 1)])
            wanted = np.cumsum([len(word.encode()) for word in words])
            last = np.searchsorted(reached, wanted)
            if len(reached) and reached[-1] == wanted[-1] and (reached[last] == wanted).all():
                return ids, np.diff(last, prepend=-1)
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return _flat(found), np.array([len(e) for e in found])

    def _ids_of(self, text: str, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """For each pre-token where its ids begin in the flat array and how many they are."""
        hashes = np.empty(len(starts), np.uint64)
        values = self.values[np.minimum(codes, _SIZE)]
        step = 1 << 18
        begin = 0
        while begin < len(starts):
            stop = max(begin + 1, int(np.searchsorted(ends, starts[begin] + step, side="right")))
            low, high = starts[begin], ends[stop - 1]
            powers, inverses = _power_tables(high - low + 1)
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(values[low:high] * powers[: high - low], out=sums[1:])
            a, b = starts[begin:stop] - low, ends[begin:stop] - low
            hashes[begin:stop] = mix((sums[b] - sums[a]) * inverses[a])
            begin = stop
        long = ends - starts > LONGEST
        hashes[long] = mix(np.flatnonzero(long).astype(np.uint64)) if long.any() else 0
        keys, order, first = distinct(hashes)
        one, times = order[first], np.diff(first, append=len(order))
        short = ~long[one]
        found = np.full(len(keys), -1, np.int64)
        for stored, values in self.stores:
            if len(stored):
                at = np.minimum(np.searchsorted(stored, keys), len(stored) - 1)
                found = np.where((stored[at] == keys) & short, values[at], found)
        new = np.flatnonzero(found < 0)
        if len(new):
            own = one[new]
            ids, sizes = self._encoded([text[a:b] for a, b in zip(starts[own].tolist(), ends[own].tolist())])
            found[new] = ((self.n_ids + np.cumsum(sizes) - sizes) << SIZE_BITS) | sizes
            self._append(ids)
        flat = self.ids
        keep = new[short[new]]
        if sum(len(stored) for stored, _ in self.stores) + len(keep) > MOST_KEPT or self.n_ids > MOST_IDS:
            self._clear()
        elif len(keep):
            self._keep(keys[keep], found[keep])
        each = np.empty(len(order), np.int64)
        each[order] = np.repeat(found, times)
        return (each >> SIZE_BITS, each & ((1 << SIZE_BITS) - 1)), flat


def _flat(encoded: list) -> np.ndarray:
    return np.fromiter(chain.from_iterable(e.ids for e in encoded), np.uint32)


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the distinct 64-bit ``values``, rising; the order that sorts all; where each one's stretch begins in it).

    Leading bits and place are sorted as one number, which is faster than a sort of places. Where values
    that differ in the other bits only meet, places are sorted after all.
    """
    low = np.uint64((1 << len(values).bit_length()) - 1)
    order = np.sort((values & ~low) | np.arange(len(values), dtype=np.uint64)) & low
    order = order.astype(np.int64)
    ranked = values[order]
    if (ranked[1:] < ranked[:-1]).any():
        order = np.argsort(values, kind="stable")
        ranked = values[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
    return ranked[starts], order, starts


def _inserted(store: tuple[np.ndarray, np.ndarray], keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    where = np.searchsorted(store[0], keys)
    return np.insert(store[0], where, keys), np.insert(store[1], where, values)


def _gather(flat: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The pieces ``flat[at : at + size]``, one after the other."""
    ends = np.cumsum(size)
    if not len(ends):
        return flat[:0]
    return flat[np.repeat(at - ends + size, size) + np.arange(ends[-1])]


_tokenizers: dict[str, CachedTokenizer] = {}


def cached_tokenizer(path: str) -> CachedTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = CachedTokenizer(path)
    return _tokenizers[path]
