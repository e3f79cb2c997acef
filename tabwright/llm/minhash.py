"""Near-duplicate groups by fast similarity sketching, banding and exact verification.

A sketch has ``T`` coordinates. In round i < T every shingle is hashed to one coordinate and a
value; a coordinate keeps the least value of the first round that reaches it. Rounds from T on
send all shingles to coordinate i - T, so each is filled after 2T rounds for any set, and the
share of equal coordinates is concentrated about the Jaccard similarity. Most texts are done
after a few rounds, so the cost is near one hash per shingle instead of T.

Bands of equal coordinates give candidates. Each band bucket first compares its members with its
least and its greatest one; what these links leave in different groups is then compared member by
member, so that no pair of a bucket with a possible link stays unseen and none is compared inside
a group that is already one. A pair is dropped unseen only if its sketches agree in far fewer
coordinates than those of a link do (over four standard deviations). All other candidates are
confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import map_batches, stored
from tabwright.llm.components import components
from tabwright.llm.wordhash import NOT_BLANK, _BASE, mix, run_hashes, shares, sure_word_hashes, text_bytes, word_bounds

SHINGLE = 5
BANDS, ROWS = 56, 6
#: The bands take the first third; all coordinates tell a similarity of 0.70 from one of 0.75.
T = 3 * BANDS * ROWS
#: A pair with a similarity of 0.75 agrees in 756 +- 14 of 1008 coordinates: 4.2 deviations below.
LEAST_AGREEMENT = 698
#: One bit of each coordinate: a similarity of 0.75 differs in 126 +- 10.5 of 1008 bits; again 4.2 deviations.
BITS, MOST_DIFFERENCE = 16, 170
#: Texts sketched together.
TEXTS = 512
#: The filter that spares texts a shuffle has at most so many bits (16 MB) and at least so many.
MOST_BITS, LEAST_BITS = 27, 16
#: Shingles of texts compared lately that a task keeps.
KEPT_SHINGLES = 1 << 21
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)

SKETCH_SCHEMA = "doc_id long, n_shingles long, set_low long, set_high long, bands array<long>, bits array<long>, coordinates array<long>"


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each text its sorted distinct shingles, as hashes."""
    starts, ends, until = word_bounds(data, offsets, NOT_BLANK)
    words = sure_word_hashes(data, starts, ends)
    runs = run_hashes(words, SHINGLE)
    found = []
    for a, b in zip(until[:-1], until[1:]):
        if b - a >= SHINGLE:
            found.append(np.unique(runs[a : b - SHINGLE + 1]))
        else:
            found.append(run_hashes(words[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64))
    return found


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of T coordinates per set; a set without shingles has no filled coordinate."""
    out = np.full((len(sets), T), _EMPTY, np.uint64)
    live = np.flatnonzero([len(s) > 0 for s in sets])
    if not len(live):
        return out
    table = np.full((len(live), T), _EMPTY, np.uint64)
    shingles = np.concatenate([sets[k] for k in live])
    owner = np.repeat(np.arange(len(live), dtype=np.int64), [len(sets[k]) for k in live])
    for round_ in range(2 * T):
        h = mix(shingles + np.uint64((round_ + 1) * int(_BASE) % (1 << 64)))
        value = (np.uint64(round_) << np.uint64(48)) | (h >> np.uint64(16))
        place = ((h & np.uint64(0xFFFF)) * np.uint64(T) >> np.uint64(16)).astype(np.int64) if round_ < T else round_ - T
        np.minimum.at(table.reshape(-1), owner * T + place, value)
        if round_ % 4 == 3 or round_ == 2 * T - 1:
            # filled sets leave; a round too many would change nothing
            done = ~(table == _EMPTY).any(axis=1)
            if done.any():
                out[live[done]] = table[done]
                live, table = live[~done], table[~done]
                if not len(live):
                    break
                stay = ~done[owner]
                shingles, owner = shingles[stay], (np.cumsum(~done) - 1)[owner[stay]]
    return out


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        for begin, stop in ((a, min(a + TEXTS, b)) for low, b in shares(offsets) for a in range(low, b, TEXTS)):
            own = offsets[begin : stop + 1]
            sets = shingle_sets(data[own[0] : own[-1]], own - own[0])
            rows = sketches(sets)
            bands = np.zeros((len(sets), BANDS), np.uint64)
            for i in range(ROWS):
                bands = bands * _BASE + rows[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)[:, :, i]
            bands = mix(bands + np.arange(1, BANDS + 1, dtype=np.uint64) * _BASE).view(np.int64)
            low = np.array([np.bitwise_xor.reduce(s) if len(s) else 0 for s in sets], np.uint64)
            high = np.array([mix(s).sum(dtype=np.uint64) if len(s) else 0 for s in sets], np.uint64)
            mixed = mix(rows)
            codes = mixed.astype(np.uint8).view(np.int64)
            bits = np.zeros((len(sets), 8 * BITS), np.uint8)
            bits[:, : T // 8] = np.packbits((mixed >> np.uint64(63)).astype(bool), axis=1)
            bands_at = np.zeros(len(sets) + 1, np.int32)
            np.cumsum([BANDS * bool(len(s)) for s in sets], out=bands_at[1:])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(begin, stop - begin),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(low.view(np.int64)),
                    pa.array(high.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(bands_at), pa.array(bands[[bool(len(s)) for s in sets]].ravel())),
                    pa.FixedSizeListArray.from_arrays(pa.array(bits.view(np.int64).ravel()), BITS).cast(pa.list_(pa.int64())),
                    pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), T // 8).cast(pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "set_low", "set_high", "bands", "bits", "coordinates"],
            )


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, size and hash of the shingle set, band hashes and a byte of each coordinate."""
    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), _sketch_batches, SKETCH_SCHEMA)


def _agreement(left: Column, right: Column) -> Column:
    """The number of equal bytes of two arrays of longs."""

    def unequal(x: Column, y: Column) -> Column:
        t = x.bitwiseXOR(y)
        for shift, mask in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
            t = t.bitwiseOR(F.shiftrightunsigned(t, shift)).bitwiseAND(F.lit(mask))
        return F.bit_count(t)

    return T - F.aggregate(F.zip_with(left, right, unequal), F.lit(0), lambda a, n: a + n)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: dict[int, np.ndarray] = {}
    size = 0
    for batch in batches:
        keep = []
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            names = [part.column(i).to_pylist() for i in (0, 1)]
            texts = {}
            for side in (0, 1):
                for row, name in enumerate(names[side]):
                    if name not in kept and name not in texts:
                        texts[name] = part.column(side + 2)[row].as_py()
            if size > KEPT_SHINGLES:
                kept, size, texts = {}, 0, {}
                for side in (0, 1):
                    texts.update((name, part.column(side + 2)[row].as_py()) for row, name in enumerate(names[side]))
            found = shingle_sets(*text_bytes(pa.array(texts.values(), pa.large_string())))
            kept.update(zip(texts, found))
            size += sum(map(len, found))
            for a, b in zip(*names):
                x, y = kept[a], kept[b]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= 75 * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _near(left: str, right: str) -> Column:
    """A first look at one bit of each coordinate: a few machine instructions."""
    return sum((F.bit_count(F.col(left)[i].bitwiseXOR(F.col(right)[i])) for i in range(BITS)), F.lit(0)) <= MOST_DIFFERENCE


def _close(n: str, m: str) -> Column:
    return 100 * F.least(n, m) >= 75 * F.greatest(n, m)


def _plausible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose sizes and sketches admit a link."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("n"), F.col("coordinates").alias("left"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("m"), F.col("coordinates").alias("right"))
    alike = _agreement(F.col("left"), F.col("right")) >= LEAST_AGREEMENT
    return pairs.join(one, "a").join(two, "b").where(_close("n", "m") & alike).select("a", "b")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right"))
    return map_batches(pairs.join(two, "b").join(one, "a").select("a", "b", "left", "right"), _confirm, "a long, b long")


def _holder(ids: DataFrame) -> tuple[np.ndarray, int]:
    """A bit filter of the ids of at most ``2 ** MOST_BITS`` bits, two of them per id, and its mask."""
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * ids.count()).bit_length()))
    mask = (1 << bits) - 1
    h = F.xxhash64("doc_id")
    places = ids.select(F.explode(F.array(h.bitwiseAND(F.lit(mask)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(mask)))).alias("p"))
    words = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, int(p & 63))")).alias("bits")).toArrow()
    held = np.zeros((mask >> 6) + 1, np.int64)
    held[words["w"].to_numpy()] = words["bits"].to_numpy()
    return held.view(np.uint8), mask


def _texts_of(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id and text (the least one, should a doc_id have several) of the documents in ``pairs``; most others are left out before the shuffle."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    ids = stored(ids, "pair-ids")
    held, mask = _holder(ids)
    shared = docs.sparkSession.sparkContext.broadcast(held)

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(2).to_numpy().view(np.uint64)
            keep = np.ones(len(h), bool)
            for place in (h & np.uint64(mask), (h >> np.uint64(32)) & np.uint64(mask)):
                keep &= (shared.value[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            yield batch.select([0, 1]).filter(pa.array(keep))

    named = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64(F.col("doc_id").cast("long"))).where("doc_id IS NOT NULL")
    texts = map_batches(named, maybe, "doc_id long, text string").join(ids, "doc_id", "left_semi")
    # of several texts of one doc_id always the same one, whatever arrives first
    return stored(texts.groupBy("doc_id").agg(F.min("text").alias("text")), "pair-texts")


def _across_groups(members: DataFrame, seen: DataFrame) -> DataFrame:
    """Pairs of a bucket from different groups that sizes and sketches admit, without those in ``seen``.

    Each pair comes out of the least of its common buckets only.
    """
    one = members.toDF("a", "bucket", "c", "n", "left", "left_bits", "left_bands")
    two = members.toDF("b", "bucket", "d", "m", "right", "right_bits", "right_bands")
    near = _near("left_bits", "right_bits")
    first = F.array_min(F.array_intersect("left_bands", "right_bands")) == one["bucket"]
    alike = _agreement(F.col("left"), F.col("right")) >= LEAST_AGREEMENT
    found = one.join(two, (one["bucket"] == two["bucket"]) & (F.col("a") < F.col("b")) & (F.col("c") != F.col("d")) & _close("n", "m") & near & first & alike)
    return found.select("a", "b").join(seen, ["a", "b"], "left_anti")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 times the size of the intersection of their sets of five-word
    shingles is at least 75 times that of the union. ``component_id`` is the smallest doc_id that
    links reach. A null or blank text has no shingles and is linked with nothing. A null doc_id
    has no component and is not kept as one: its component_id is null and kept is true, because
    nothing can name it as a copy. Rows that repeat a doc_id each get a row; they should repeat its
    text too, else their sets count together and links are confirmed on the least text. Other columns are ignored. No row, no result.
    """
    found = stored(sketch(docs), "sketches")
    named = found.where("doc_id IS NOT NULL AND n_shingles > 0")
    same = ["n_shingles", "set_low", "set_high"]
    classes = stored(named.groupBy(*same).agg(F.min("doc_id").alias("class_id")), "classes")
    firsts = classes.select(F.col("class_id").alias("doc_id")).distinct()
    sets = stored(named.join(firsts, "doc_id", "left_semi").dropDuplicates(["doc_id", *same]), "class-sketches")
    members = sets.select("doc_id", F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    shared = stored(members.join(buckets, "bucket"), "buckets")

    star = (
        shared.select(F.col("least").alias("a"), F.col("doc_id").alias("b"))
        .unionAll(shared.select(F.col("doc_id").alias("a"), F.col("most").alias("b")))
        .where("a < b")
        .distinct()
    )
    seen = stored(star, "star-pairs")
    likely = stored(_plausible(seen, sets), "likely-pairs")
    links = stored(_confirmed(likely, _texts_of(likely, docs)), "star-links")
    joined = components(links)

    grouped = shared.select("bucket", "doc_id").join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    grouped = grouped.select("bucket", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    mixed = grouped.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    open_ = grouped.join(mixed.select("bucket"), "bucket", "left_semi").join(sets, "doc_id")
    open_ = open_.select("doc_id", "bucket", "component", "n_shingles", "coordinates", "bits", "bands")
    rest = stored(_across_groups(stored(open_, "open-buckets"), seen), "other-pairs")
    final = joined
    if not rest.isEmpty():
        more = stored(_confirmed(rest, _texts_of(rest, docs)), "other-links")
        if not more.isEmpty():
            final = components(links.unionAll(more))
    groups = classes.join(final.withColumnRenamed("node", "class_id"), "class_id", "left")
    groups = groups.select(*same, F.coalesce("component", "class_id").alias("group"))
    out = found.select("doc_id", *same).join(groups, same, "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("group", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(component)
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, all columns and names kept.

    Documents without words are kept as they are. Of rows that repeat a doc_id one stays.
    """
    found = near_duplicates(docs)
    gone = stored(found.where("NOT kept").select("doc_id").distinct(), "copies")
    left = docs.join(gone, "doc_id", "left_anti")
    repeated = found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        return left
    return left.where("doc_id IS NULL").unionAll(left.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]))


_SQL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x20\x09-\x0D]+')"
)
#: The same from all pairs that share a shingle, and all that links reach.
ORACLE = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 75 * (p.n + q.n - k)
),
reach AS (SELECT doc_id AS node, doc_id AS root FROM d UNION SELECT b, root FROM reach JOIN links ON node = a),
grouped AS (SELECT node AS doc_id, min(root) AS component_id FROM reach GROUP BY node)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM grouped LEFT JOIN n USING (doc_id)
"""
