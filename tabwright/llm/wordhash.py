"""Words of many texts at once, as 64-bit hashes, from the bytes of an Arrow string column.

Nothing here knows Spark. A word is a longest run of wanted bytes within one text; its hash is a
polynomial over a random value per byte, found for all words of a stretch by one running sum and
mixed afterwards, so equal words have equal hashes wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

STRETCH = 1 << 20
#: Polynomials modulo 2^64 are weak for long words of few letters: beyond so many bytes a word has a cryptographic hash.
SHORT = 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20_240_607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def byte_table(wanted) -> np.ndarray:
    return np.array([bool(wanted(b)) for b in range(256)])


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_BLANK = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: After lower-casing: digits, a to z and every byte of a character beyond ASCII.
WORD_BYTES = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or 0x41 <= b <= 0x5A or b >= 0x80)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE, np.uint64)]))
        _inverses = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse, np.uint64)]))
    return _powers, _inverses


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the bounds of its texts; a null has no bytes."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the number of words before it."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = wanted[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    begin = 0
    while begin < len(starts):
        stop = max(begin + 1, int(np.searchsorted(ends, starts[begin] + STRETCH, side="right")))
        low = starts[begin]
        part = data[low : ends[stop - 1]]
        powers, inverses = _power_tables(len(part) + 1)
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[LOWER[part] if lower else part] * powers[: len(part)], out=sums[1:])
        a, b = starts[begin:stop] - low, ends[begin:stop] - low
        out[begin:stop] = mix((sums[b] - sums[a]) * inverses[a])
        begin = stop
    return out


def sure_word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """As ``word_hashes``, lower-cased, with 64 bits of BLAKE2b for words of more than ``SHORT`` bytes."""
    out = word_hashes(data, starts, ends)
    for i in np.flatnonzero(ends - starts > SHORT):
        out[i] = int.from_bytes(blake2b(LOWER[data[starts[i] : ends[i]]].tobytes(), digest_size=8).digest(), "little")
    return out


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` words, by the place of its first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(size), np.uint64)
    for i in range(size):
        total = total * _BASE + words[i : i + n]
    return mix(total)


def shares(offsets: np.ndarray, most: int = 2 * STRETCH) -> Iterator[tuple[int, int]]:
    """Neighbouring texts in groups of about ``most`` bytes; a longer text is a group of its own."""
    begin = 0
    while begin < len(offsets) - 1:
        stop = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + most, side="right")) - 1)
        yield begin, stop
        begin = stop
