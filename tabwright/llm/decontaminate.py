"""Benchmark passages in training documents: a hash set of windows, verified hits, removal.

The windows of the benchmark (13 words, or all words of a shorter item) are hashed. Blocks of
items with at most ``BLOCK_BYTES`` of text are broadcast one after the other, so what a task holds
does not grow with the benchmark; all blocks usually are one. A task hashes every window of its
documents, looks the hashes up and compares the words of each hit with those of the item.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.common import map_batches, stored, unused
from tabwright.llm.wordhash import LOWER, WORD_BYTES, run_hashes, shares, text_bytes, word_bounds, word_hashes

WINDOW = 13
BLOCK_BYTES = 32 << 20
#: A text of a hit counts as contaminated if at least one in this many of its words is hit.
LEAST_SHARE = 20
HITS = "doc_id long, key long, n_words long, hits array<struct<first:int,size:int>>, items array<string>"


def _spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    return b" ".join(LOWER[data[a:b]].tobytes() for a, b in zip(starts, ends))


class Windows:
    """The windows of some items: by length, their sorted hashes and the places of their first words."""

    def __init__(self, items: list[tuple[str, str]]) -> None:
        self.names = [name for name, _ in items]
        self.data, offsets = text_bytes(pa.array([text for _, text in items], pa.large_string()))
        starts, ends, self.until = word_bounds(self.data, offsets, WORD_BYTES)
        hashes = word_hashes(self.data, starts, ends)
        self.starts, self.ends = starts.astype(np.int32), ends.astype(np.int32)
        places: dict[int, list[np.ndarray]] = {}
        for a, b in zip(self.until[:-1], self.until[1:]):
            if size := min(WINDOW, int(b - a)):
                places.setdefault(size, []).append(np.arange(a, b - size + 1, dtype=np.int32))
        self.by_size = {}
        for size, parts in places.items():
            first = np.concatenate(parts)
            runs = run_hashes(hashes, size)[first]
            order = np.argsort(runs, kind="stable")
            marks = np.zeros(1 << 20, bool)
            marks[(runs >> np.uint64(44)).astype(np.int64)] = True
            self.by_size[size] = runs[order], marks, first[order]
        self.spelled: dict[tuple[int, int], dict[bytes, set[str]]] = {}

    def items_of(self, run: np.uint64, size: int) -> dict[bytes, set[str]]:
        """The words of the windows with this hash (one, but for a chance collision) and their items."""
        found = self.spelled.get((int(run), size))
        if found is None:
            found = self.spelled[int(run), size] = {}
            known, _, first = self.by_size[size]
            low, high = np.searchsorted(known, run, side="left"), np.searchsorted(known, run, side="right")
            for i in first[low:high]:
                words = _spelled(self.data, self.starts[i : i + size], self.ends[i : i + size])
                name = self.names[int(np.searchsorted(self.until, i, side="right")) - 1]
                found.setdefault(words, set()).add(name)
        return found

    def hits(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, until: np.ndarray, hashes: np.ndarray
    ) -> Iterator[tuple[int, int, int, set[str]]]:
        """(text, place of its first word, number of words, items) of each verified hit."""
        for size, (known, marks, _) in self.by_size.items():
            runs = run_hashes(hashes, size)
            maybe = np.flatnonzero(marks[(runs >> np.uint64(44)).astype(np.int64)])
            if not len(maybe):
                continue
            at = np.minimum(np.searchsorted(known, runs[maybe]), len(known) - 1)
            for i in maybe[known[at] == runs[maybe]]:
                k = int(np.searchsorted(until, i, side="right")) - 1
                if i + size <= until[k + 1]:
                    words = _spelled(data, starts[i : i + size], ends[i : i + size])
                    if items := self.items_of(runs[i], size).get(words):
                        yield k, int(i), size, items


def _scanner(block):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = block.value if block else None
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for begin, stop in shares(offsets):
                own = offsets[begin : stop + 1]
                part = data[own[0] : own[-1]]
                starts, ends, until = word_bounds(part, own - own[0], WORD_BYTES)
                n_words = np.diff(until)
                hits: list[list] = [[] for _ in n_words]
                items: list[set[str]] = [set() for _ in n_words]
                if windows:
                    hashes = word_hashes(part, starts, ends)
                    for k, first, size, names in windows.hits(part, starts, ends, until, hashes):
                        hits[k].append({"first": first - int(until[k]), "size": size})
                        items[k] |= names
                rows = slice(begin, stop - begin)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(rows.start, rows.stop),
                        batch.column(1).slice(rows.start, rows.stop),
                        pa.array(n_words, pa.int64()),
                        pa.array(hits, pa.list_(pa.struct([("first", pa.int32()), ("size", pa.int32())]))),
                        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    ],
                    names=["doc_id", "key", "n_words", "hits", "items"],
                )

    return scan


def _item_blocks(benchmark: DataFrame, most: int) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of at most ``most`` bytes of text (a longer item is a block), one at a time on the driver."""
    named = benchmark.where("text IS NOT NULL").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"), F.col("text").cast("string").alias("text")
    )
    block, size = [], 0
    for row in named.toLocalIterator():
        if block and size + len(row["text"]) > most:
            yield block
            block, size = [], 0
        block.append((row["name"], row["text"]))
        size += len(row["text"])
    yield block


def _covered(spans: F.Column) -> F.Column:
    """The number of words in at least one of the spans, which are sorted by their first word."""
    step = lambda a, s: F.struct(
        (a["n"] + F.greatest(s["first"] + s["size"] - F.greatest(a["end"], s["first"]), F.lit(0))).alias("n"),
        F.greatest(a["end"], s["first"] + s["size"]).alias("end"),
    )
    return F.aggregate(spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step, lambda a: a["n"].cast("long"))


def hits(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, key (a hash of the text), n_words, hits (spans of words, sorted) and items of each row of ``docs``.

    With more than one block every block is a scan of the documents; the blocks' hits are then
    united by the text's hash, so equal texts count once each and rows stay as many as in ``docs``.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("key"), F.col("text").cast("string")
    )
    scans = []
    for block in _item_blocks(benchmark, block_bytes):
        scan = map_batches(texts, _scanner(spark.sparkContext.broadcast(Windows(block))), HITS)
        scans.append(scan if not scans else stored(scan.where(F.size("hits") > 0).dropDuplicates(["doc_id", "key"]), "block-hits"))
    whole = scans[0]
    if len(scans) > 1:
        more = scans[1]
        for other in scans[2:]:
            more = more.unionAll(other)
        more = more.groupBy("doc_id", "key").agg(F.flatten(F.collect_list("hits")).alias("h"), F.flatten(F.collect_list("items")).alias("i"))
        more = more.withColumnsRenamed({"doc_id": "d", "key": "k"})
        none = F.array().cast("array<struct<first:int,size:int>>")
        whole = whole.join(more, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left").select(
            "doc_id", "key", "n_words", F.concat("hits", F.coalesce("h", none)).alias("hits"),
            F.concat("items", F.coalesce("i", F.array().cast("array<string>"))).alias("items"),
        )
    return whole.withColumns({"hits": F.array_sort("hits"), "items": F.array_sort(F.array_distinct("items"))})


def contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``n_hit`` counts words inside any occurrence of a benchmark window, ``items_sha256`` is of the
    item ids with occurring windows, sorted as strings and joined with commas. Contaminated is a
    document with a hit in at least one of ``LEAST_SHARE`` words. Null and wordless texts have no
    words and no hits; items without words have no windows; an item without an id is called null;
    items that share an id count once. An empty benchmark leaves all documents clean.
    """
    found = hits(docs, benchmark, block_bytes).withColumn("n_hit", _covered(F.col("hits")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (LEAST_SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def _without(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, hit: np.ndarray) -> str:
    """A text without its hit words and what stands between two of them."""
    gone = np.zeros(len(text) + 1, np.int64)
    joined = hit[:-1] & hit[1:]
    np.add.at(gone, starts[hit], 1)
    np.add.at(gone, ends[hit], -1)
    np.add.at(gone, ends[:-1][joined], 1)
    np.add.at(gone, starts[1:][joined], -1)
    return text[np.cumsum(gone)[:-1] == 0].tobytes().decode()


def _remover(block, whole_documents: bool):
    """Takes contaminated documents out, or the hit stretches out of them.

    Without a block the hits stand in the last column, which goes too.
    """

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index("text")
            data, offsets = text_bytes(batch.column(place))
            keep, texts = [], []
            for begin, stop in shares(offsets):
                own = offsets[begin : stop + 1]
                part, local = data[own[0] : own[-1]], own - own[0]
                starts, ends, until = word_bounds(part, local, WORD_BYTES)
                hit = np.zeros(len(starts), bool)
                if block:
                    for _, first, size, _ in block.value.hits(part, starts, ends, until, word_hashes(part, starts, ends)):
                        hit[first : first + size] = True
                else:
                    for k, spans in enumerate(batch.column(batch.num_columns - 1).slice(begin, stop - begin).to_pylist()):
                        for span in spans or []:
                            hit[until[k] + span["first"] :][: span["size"]] = True
                n_hit = np.diff(np.concatenate([[0], np.cumsum(hit)])[until])
                bad = (n_hit > 0) & (LEAST_SHARE * n_hit >= np.diff(until))
                keep += [not (b and whole_documents) for b in bad]
                for k in range(0 if whole_documents else len(bad)):
                    if bad[k]:
                        w = slice(until[k], until[k + 1])
                        own_text = part[local[k] : local[k + 1]]
                        texts.append(_without(own_text, starts[w] - local[k], ends[w] - local[k], hit[w]))
                    else:
                        texts.append(batch.column(place)[begin + k].as_py())
            if texts:
                batch = batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))
            if not block:
                batch = batch.select(range(batch.num_columns - 1))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return remove


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) without their hit stretches.

    The columns are those of ``docs``, whatever they are called; clean rows are unchanged. One
    block of benchmark items needs one pass without a shuffle. With several blocks the united hits
    decide, and are joined to the documents.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is documents or spans, not {remove}")
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields])
    blocks = _item_blocks(benchmark, block_bytes)
    first = next(blocks)
    if next(blocks, None) is None:
        block = docs.sparkSession.sparkContext.broadcast(Windows(first))
        return map_batches(docs, _remover(block, remove == "documents"), schema)
    found = hits(docs, benchmark, block_bytes).where(F.size("hits") > 0).dropDuplicates(["doc_id", "key"])
    found = found.select(*(F.col(c).alias(unused(docs.columns, f"hit_{c}")) for c in ("doc_id", "key", "hits")))
    d, k, h = found.columns
    same = docs["doc_id"].eqNullSafe(found[d]) & (F.xxhash64(docs["text"].cast("string")) == found[k])
    joined = docs.join(found, same, "left").select(*(docs[c] for c in docs.columns), found[h])
    return map_batches(joined, _remover(None, remove == "documents"), schema)


_SQL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
#: The same with windows as text.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_SQL_WORDS} AS w FROM benchmark),
starts AS (SELECT item, w, least({WINDOW}, len(w)) AS n, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
wins AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM starts),
runs AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n),
hits AS (SELECT r, i, n, item FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM runs) JOIN wins USING (n, win)),
covered AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {LEAST_SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""
