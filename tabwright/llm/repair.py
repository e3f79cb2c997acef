"""Token shards compressed by pair replacement (Re-Pair), decodable document by document.

Documents are sorted by doc_id over range partitions. A task encodes its documents, cuts them into
shards of about ``SHARD_TOKENS`` ids and compresses each: in every round frequent pairs of
neighbouring symbols are replaced by new symbols, of overlapping pairs the more frequent one,
until a round saves next to nothing (``LEAST_GAIN``). Pairs never cross a document's end, so each document is a
stretch of symbols of its own.

File format: a Parquet table with one row per shard.

- ``part``, ``shard``: place of the shard; documents ascend by part, shard and within a shard.
- ``first``: ids of all documents before the shard in its part.
- ``doc_ids``, ``n_tokens``, ``n_symbols``: one entry per document.
- ``base``: symbols below it are token ids; ``base + k`` stands for rule k.
- ``rules``: for each rule its two symbols, which are below the rule's own.
- ``expansions``: for each rule the number of ids that it stands for. With them the place of any
  id in a document is found by a running sum over its symbols, without decoding what is before.
- ``symbols``: all documents' symbols. The three binary fields are little-endian unsigned 32-bit
  integers, ``symbols`` 16-bit ones where ``wide`` is false.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwright.llm.common import give_back, map_batches, spread
from tabwright.llm.pretoken import cached_tokenizer, distinct
from tabwright.llm.wordhash import text_bytes

END_ID = 2
SHARD_TOKENS = 1 << 19
#: A pair is replaced if it can be so often: a rule takes 12 bytes, a symbol 2 or 4, so rarer pairs gain nothing.
LEAST_COUNT = 8
#: Rounds end when one saves less than this share of the symbols; 0: when no pair is frequent.
LEAST_GAIN = 0.001
_TABLE_BITS = 20

SHARD_SCHEMA = (
    "part int, shard int, first long, doc_ids array<long>, n_tokens array<int>, n_symbols array<int>, base long, "
    "rules binary, expansions binary, wide boolean, symbols binary"
)


def _places(symbols: np.ndarray, ends: np.ndarray, least_count: int, exact: bool) -> np.ndarray:
    """Places of pairs to replace in this round: no two overlap.

    Of overlapping pairs the more frequent one is taken, of equally frequent ones that with the larger
    hash, which is the same one wherever the two meet; in a run of one symbol every second pair.
    """
    left, right = symbols[:-1], symbols[1:]
    hashed = left * np.uint32(0x9E3779B1) + right * np.uint32(0x85EBCA77)
    hashed ^= hashed >> np.uint32(15)
    hashed *= np.uint32(0x2C1B3C6D)
    # places of pairs that would cross a document's end
    barred = np.unique(ends[(ends > 0) & (ends < len(symbols))]) - 1
    # counts by slot guide the choice, exact ones where those find nothing more; the pairs chosen are counted themselves
    if exact:
        slot = np.unique((left.astype(np.uint64) << np.uint64(32)) | right, return_inverse=True)[1]
    else:
        slot = (hashed >> np.uint32(32 - _TABLE_BITS)).astype(np.int64)
    counts = np.bincount(slot, minlength=1 << _TABLE_BITS)
    np.subtract.at(counts, slot[barred], 1)
    often = counts.astype(np.uint32)[slot]
    weight = np.stack([hashed, often], axis=1).astype("<u4", copy=False).view("<u8")[:, 0]
    weight[barred] = 0
    chosen = often >= least_count
    chosen[barred] = False
    rising = weight[1:] > weight[:-1]
    twins = left == right
    twins[barred] = False
    same = twins[:-1] & twins[1:]
    inside = np.flatnonzero(same) + 1  # pairs that go on a run of one symbol
    if len(inside):
        chosen[1:] &= rising | same
        chosen[:-1] &= ~rising | same
        begins = np.concatenate([[True], np.diff(inside) != 1])
        begun = (inside[begins] - 1)[np.cumsum(begins) - 1]
        chosen[inside[(inside - begun) % 2 == 1]] = False
    else:
        chosen[1:] &= rising
        chosen[:-1] &= ~rising
    return np.flatnonzero(chosen)


def compress(
    ids: np.ndarray, ends: np.ndarray, least_count: int = LEAST_COUNT, least_gain: float = LEAST_GAIN
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(symbols, documents' ends among them, rules as pairs, first rule's symbol).

    Rounds go on until one saves less than ``least_gain`` of the symbols; with 0 until no pair can be
    replaced ``least_count`` times.
    """
    symbols, ends = ids.astype(np.uint32), ends.astype(np.int64)
    base = int(symbols.max()) + 1 if len(symbols) else 0
    rules: list[np.ndarray] = []
    n_rules, exact = 0, False
    while len(symbols) > 1:
        at = _places(symbols, ends, least_count, exact)
        bits = (base + n_rules).bit_length()
        unused = np.uint64(64 - 2 * bits)
        pairs, order, starts = distinct(((symbols[at].astype(np.uint64) << np.uint64(bits)) | symbols[at + 1]) << unused)
        counts = np.diff(starts, append=len(at))
        frequent = counts >= least_count
        n_used = int(counts[frequent].sum())
        if not n_used or n_used < least_gain * len(symbols):
            if exact or least_gain:
                break
            exact = True
            continue
        names = (np.cumsum(frequent) - 1 + base + n_rules).astype(np.uint32)
        used = np.repeat(frequent, counts)
        at = at[order[used]]
        symbols[at] = np.repeat(names[frequent], counts[frequent])
        kept = pairs[frequent] >> unused
        rules.append(np.stack([kept >> np.uint64(bits), kept & np.uint64((1 << bits) - 1)], axis=1).astype(np.uint32))
        n_rules += len(kept)
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        symbols = symbols[stay]
        ends = ends - np.searchsorted(np.flatnonzero(~stay), ends)
    pairs = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    return symbols, ends, pairs, base


def expansion_lengths(pairs: np.ndarray, base: int) -> np.ndarray:
    """How many ids each rule stands for. Rules of a round use only symbols of earlier rounds."""
    lengths = np.ones(len(pairs), np.int64)
    done = 0
    while done < len(pairs):
        # as many rules as use only what is known
        top = pairs[done:].max(axis=1)
        late = np.flatnonzero(top >= base + done)
        stop = done + (int(late[0]) if len(late) else len(top))
        own = pairs[done:stop].astype(np.int64)
        known = np.where(own < base, 1, lengths[np.maximum(own - base, 0)])
        lengths[done:stop] = known.sum(axis=1)
        done = stop
    return lengths


def rule_table(pairs: np.ndarray, base: int, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All rules' ids one after the other, and where each rule's begin."""
    begins = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    flat = np.zeros(begins[-1], np.uint32)
    done = 0
    while done < len(pairs):
        top = pairs[done:].max(axis=1)
        late = np.flatnonzero(top >= base + done)
        stop = done + (int(late[0]) if len(late) else len(top))
        flat[begins[done] : begins[stop]] = expand(pairs[done:stop].ravel(), base, lengths, flat, begins)
        done = stop
    return flat, begins


def expand(symbols: np.ndarray, base: int, lengths: np.ndarray, flat: np.ndarray, begins: np.ndarray) -> np.ndarray:
    symbols = symbols.astype(np.int64)
    ruled = symbols >= base
    rule = np.where(ruled, symbols - base, 0)
    if not len(lengths):
        return symbols.astype(np.uint32)
    size = np.where(ruled, lengths[rule], 1)
    ends = np.cumsum(size)
    if not len(ends):
        return np.zeros(0, np.uint32)
    out = np.empty(ends[-1], np.uint32)
    plain = ~ruled
    out[(ends - 1)[plain]] = symbols[plain]
    own, count = rule[ruled], size[ruled]
    total = np.cumsum(count)
    if len(total):
        within = np.arange(total[-1]) - np.repeat(total - count, count)
        out[np.repeat(ends[ruled] - count, count) + within] = flat[np.repeat(begins[own], count) + within]
    return out


class Shard:
    """A row of the file, opened: whole documents or single ids of them."""

    def __init__(self, row: dict) -> None:
        self.base = row["base"]
        self.pairs = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
        self.lengths = np.frombuffer(row["expansions"], "<u4").astype(np.int64)
        self.symbols = np.frombuffer(row["symbols"], "<u4" if row["wide"] else "<u2")
        self.ends = np.cumsum(np.array(row["n_symbols"], np.int64))
        self.flat, self.begins = rule_table(self.pairs, self.base, self.lengths)

    def document(self, k: int) -> np.ndarray:
        own = self.symbols[self.ends[k - 1] if k else 0 : self.ends[k]]
        return expand(own, self.base, self.lengths, self.flat, self.begins)

    def documents(self) -> np.ndarray:
        return expand(self.symbols, self.base, self.lengths, self.flat, self.begins)

    def token(self, k: int, place: int) -> int:
        """One id of document k: a running sum of lengths, then down the rules."""
        own = self.symbols[self.ends[k - 1] if k else 0 : self.ends[k]].astype(np.int64)
        sizes = np.ones(len(own), np.int64)
        ruled = own >= self.base
        sizes[ruled] = self.lengths[own[ruled] - self.base]
        before = np.cumsum(sizes)
        i = int(np.searchsorted(before, place, side="right"))
        symbol, place = int(own[i]), place - int(before[i] - sizes[i])
        while symbol >= self.base:
            left, right = (int(x) for x in self.pairs[symbol - self.base])
            size = int(self.lengths[left - self.base]) if left >= self.base else 1
            symbol, place = (left, place) if place < size else (right, place - size)
        return symbol


def _shard_row(part: int, shard: int, first: int, doc_ids: list, parts: list[np.ndarray], least_count: int) -> pa.RecordBatch:
    sizes = np.array([len(p) for p in parts], np.int64)
    symbols, ends, pairs, base = compress(np.concatenate(parts), np.cumsum(sizes), least_count)
    wide = bool(base + len(pairs) > 1 << 16)
    values = {
        "part": part, "shard": shard, "first": first, "doc_ids": doc_ids, "n_tokens": sizes.tolist(),
        "n_symbols": np.diff(ends, prepend=0).tolist(), "base": base, "rules": pairs.astype("<u4").tobytes(),
        "expansions": expansion_lengths(pairs, base).astype("<u4").tobytes(), "wide": wide,
        "symbols": symbols.astype("<u4" if wide else "<u2").tobytes(),
    }
    return pa.RecordBatch.from_pylist([values], schema=_ARROW)


_ARROW = pa.schema(
    [
        ("part", pa.int32()), ("shard", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int32())), ("n_symbols", pa.list_(pa.int32())), ("base", pa.int64()),
        ("rules", pa.binary()), ("expansions", pa.binary()), ("wide", pa.bool_()), ("symbols", pa.binary()),
    ]
)


def _encoder(tokenizer_path: str, shard_tokens: int, least_count: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = cached_tokenizer(tokenizer_path)
        part = TaskContext.get().partitionId()
        shard, first, held = 0, 0, 0
        doc_ids: list = []
        parts: list[np.ndarray] = []
        for batch in batches:
            names, place = batch.column(0).to_pylist(), 0
            for ids, counts in tokenizer.encode(*text_bytes(batch.column(1))):
                at, ids = 0, np.insert(ids, np.cumsum(counts), END_ID)
                for count in (counts + 1).tolist():
                    parts.append(ids[at : at + count])
                    doc_ids.append(names[place])
                    at, place, held = at + count, place + 1, held + count
                    if held >= shard_tokens:
                        yield _shard_row(part, shard, first, doc_ids, parts, least_count)
                        shard, first, held, doc_ids, parts = shard + 1, first + held, 0, [], []
        if parts:
            yield _shard_row(part, shard, first, doc_ids, parts, least_count)
        parts.clear()
        give_back()

    return encode


def write_shards(docs: DataFrame, path: str, tokenizer_path: str, shard_tokens: int = SHARD_TOKENS, least_count: int = LEAST_COUNT) -> None:
    """Encode ``text`` of all documents in ascending doc_id order and write the shards to ``path``.

    A null or empty text has only the end id. Rows that share a doc_id stand in the order of their
    texts; rows without one come first. Other columns are ignored. No row gives no shard.
    """
    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .repartitionByRange(spread(docs.sparkSession), "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    # a row is a whole shard: look at sizes after every row, not after a hundred
    shards = map_batches(ordered, _encoder(tokenizer_path, shard_tokens, least_count), SHARD_SCHEMA)
    each_row = {"parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}
    shards.write.options(**each_row, **{"parquet.enable.dictionary": "false"}).parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards, with ``start``: the ids of all documents before a shard."""
    shards = spark.read.parquet(path)
    # one row per part: as many as the write had tasks, whatever the size of the corpus
    totals = shards.select("part", F.expr("first + aggregate(n_tokens, 0L, (a, x) -> a + x)").alias("stop"))
    totals = totals.groupBy("part").agg(F.max("stop").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    return shards.join(F.broadcast(offsets), "part").withColumn("start", F.col("offset") + F.col("first")).drop("offset")


_READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = Shard(row).documents().astype("<u4")
            ends = np.cumsum(np.array(row["n_tokens"], np.int64))
            begins = np.concatenate([[0], ends[:-1]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(begins + row["start"], pa.int64()),
                    pa.array(row["n_tokens"], pa.int64()),
                    pa.array([zlib.crc32(ids[a:b]) for a, b in zip(begins, ends)], pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def documents_of(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and the crc32 of its decoded ids."""
    return map_batches(read_shards(spark, path), _check, _READ)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            shard = Shard(row)
            for k, name in enumerate(row["doc_ids"]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name], pa.int64()), pa.array([shard.document(k).tolist()], pa.list_(pa.int64()))],
                    names=["doc_id", "ids"],
                )


def decoded(spark: SparkSession, path: str) -> DataFrame:
    """Per document its ids."""
    return map_batches(spark.read.parquet(path), _decode, "doc_id long, ids array<long>")
