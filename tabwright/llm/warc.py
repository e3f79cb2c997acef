"""WARC archives with a two-level capture index: sorted compressed blocks and a sparse directory of them.

``write_archives`` writes one record per page, each a gzip member of its own. Of pages with equal
payloads the one with the largest page_id is a ``response``, the others are ``revisit`` records
without payload that name it. Payloads are grouped before they are moved: a task passes on one copy
of each distinct payload, and revisits are made from rows without payload, so a payload that a
third of all pages share is moved once a task.

``write_index`` sorts the records by their reversed-host key into range partitions. Each part is one
file: blocks of ``BLOCK_LINES`` lines, each compressed alone, behind them the directory with every
block's first key, place and size. What a caller holds of an index is one row per part.

``lookup`` sends each key to the parts whose range holds it; there it is found by binary search in
the directory, one range read of a block, and binary search in the block. ``read_records`` reads the
found ranges from the archives.

Archives and index parts go to the folder given, which all executors must reach; names carry the
task attempt, and only files of attempts that succeeded are listed, so retries and lost executors
leave no doubtful file behind.

Nulls: a null html is an empty payload; a null url has the empty key and no target URI; a null
page_id is below all others. Rows equal in page_id, url and html are one response and revisits of it
(or all revisits). Other columns are ignored. A table without rows gives no file and an empty index.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm.common import map_batches, shared_folder, spread, stored

BLOCK_LINES = 512
PART_LINES = 1 << 20
ARCHIVE_BYTES = 1 << 30
READ_AHEAD = 1 << 20
#: Revisits of rows that are equal in everything are made so many at a time.
COPIES_AT_ONCE = 10_000
#: The tables bring no time of capture.
CAPTURED = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = "page_id long, url string, key string, file string, offset long, length long"
FOUND = "key string, page_id long, url string, file string, offset long, length long"
READ = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
)


def url_key(url: Column) -> Column:
    """``com,example,www)/path?query``: the host's labels from the last to the first, then the rest.

    Scheme, user, port and fragment are left out, the host is in lower case. Null gives the empty key.
    """
    rest = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://", ""), r"(?s)#.*$", "")
    authority = F.regexp_extract(rest, r"^[^/?]*", 0)
    host = F.lower(F.regexp_replace(F.regexp_replace(authority, r"(?s)^.*@", ""), r":[0-9]*$", ""))
    labels = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    path = F.when(F.length(rest) > F.length(authority), F.substr(rest, F.length(authority) + 1)).otherwise("/")
    return F.when(url.isNull(), "").otherwise(F.concat(labels, F.lit(")"), path))


def _record_id(page: Column, url: Column, sha1: Column, copy: Column) -> Column:
    text = F.concat_ws("|", F.coalesce(page.cast("string"), F.lit("")), F.coalesce(url, F.lit("")), sha1, copy.cast("string"))
    return F.regexp_replace(F.md5(text), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def typed(pages: DataFrame) -> DataFrame:
    """One row per record: page_id, url, html (null in revisits), the payload's size and SHA-1, refers_to and the ids."""
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    ).select("*", F.octet_length("html").cast("long").alias("bytes"), F.sha2("html", 256).alias("same"), F.sha1("html").alias("sha1"))
    top = F.max(F.struct("page_id", "url"))
    responses = rows.groupBy("same").agg(
        top.alias("top"), F.first("html").alias("html"), F.first("bytes").alias("bytes"), F.first("sha1").alias("sha1")
    ).select(
        "top.page_id", "top.url", "html", "bytes", "sha1", F.lit(None).cast("long").alias("refers_to"), F.lit(None).cast("string").alias("refers_id"),
        F.lit(0).cast("long").alias("copy"),
    )
    heads = rows.groupBy("same").agg(top.alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1").select("same", "top")
    alike = rows.groupBy("same", "page_id", "url", "bytes", "sha1").agg(F.count(F.lit(1)).alias("n")).join(heads, "same")
    is_top = F.col("page_id").eqNullSafe(F.col("top.page_id")) & F.col("url").eqNullSafe(F.col("top.url"))
    others = alike.withColumn("n", F.col("n") - is_top.cast("long")).where("n > 0")
    lots = others.withColumn("lot", F.explode(F.expr(f"sequence(0L, (n - 1) div {COPIES_AT_ONCE})")))
    lots = lots.repartition(spread(pages.sparkSession), "page_id", "url", "lot")
    each = F.expr(f"sequence(lot * {COPIES_AT_ONCE} + 1, least(n, (lot + 1) * {COPIES_AT_ONCE}))")
    revisits = lots.withColumn("copy", F.explode(each)).select(
        "page_id", "url", F.lit(None).cast("string").alias("html"), "bytes", "sha1", F.col("top.page_id").alias("refers_to"),
        _record_id(F.col("top.page_id"), F.col("top.url"), F.col("sha1"), F.lit(0)).alias("refers_id"), "copy",
    )
    both = responses.unionByName(revisits)
    return both.withColumns({
        "record_id": _record_id(F.col("page_id"), F.col("url"), F.col("sha1"), F.col("copy")), "key": url_key(F.col("url")),
    })


def _member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + f"Content-Length: {len(block)}\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def _clean(value: str) -> str:
    """A header field's value: line ends and the like as percent codes."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def _record(row: dict) -> bytes:
    payload = None if row["html"] is None else row["html"].encode()
    fields = [
        ("WARC-Type", "revisit" if payload is None else "response"), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", CAPTURED),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(row["sha1"])).decode()),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", _clean(row["url"])))
    if row["page_id"] is not None:
        fields.append(("X-Page", str(row["page_id"])))
    if payload is None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", row["refers_id"])]
        if row["refers_to"] is not None:
            fields.append(("X-Refers-To-Page", str(row["refers_to"])))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    return _member(fields, http + (payload or b""))


_RECORDS = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("key", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
)


def _archiver(folder: str, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = FileSystem.from_uri(folder)
        task, n, out, name = TaskContext.get(), 0, None, ""
        try:
            for batch in batches:
                done = []
                for i in range(batch.num_rows):
                    row = {c: batch.column(k)[i].as_py() for k, c in enumerate(batch.schema.names)}
                    if out is None or out.tell() >= archive_bytes:
                        if out is not None:
                            out.close()
                        name = f"archive-{task.partitionId():05d}-{n:04d}-{task.taskAttemptId()}.warc.gz"
                        n += 1
                        out = files.open_output_stream(f"{root}/{name}", compression=None)
                        out.write(_member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{_uuid(name)}>"), ("WARC-Date", CAPTURED),
                                           ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                    at, data = out.tell(), _record(row)
                    out.write(data)
                    done.append((row["page_id"], row["url"], row["key"], name, at, len(data)))
                if done:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), _RECORDS.types)], schema=_RECORDS)
        finally:
            if out is not None:
                out.close()

    return write


def _uuid(name: str) -> str:
    h = hashlib.md5(name.encode()).hexdigest()
    return f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"


def make_folder(folder: str) -> None:
    files, root = FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives of ``pages`` (page_id, url, html) and return where each record lies (``RECORDS``)."""
    make_folder(folder)
    columns = ["page_id", "url", "html", "bytes", "sha1", "refers_to", "refers_id", "record_id", "key"]
    return stored(map_batches(typed(pages).select(*columns), _archiver(folder, archive_bytes), RECORDS), "warc-records")


@dataclass
class Index:
    """One entry per part, in key order: its file, where its directory lies, its first and last key."""

    folder: str
    parts: list[tuple]

    @property
    def firsts(self) -> list[str]:
        return [p[3] for p in self.parts]

    @property
    def lasts(self) -> list[str]:
        return [p[4] for p in self.parts]


def _indexer(folder: str, block_lines: int):
    schema = pa.schema([("part", pa.int32()), ("file", pa.string()), ("at", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("n", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = FileSystem.from_uri(folder)
        task, out, lines, directory, n, last = TaskContext.get(), None, [], [], 0, ""
        name = f"index-{task.partitionId():05d}-{task.taskAttemptId()}"

        def close_block() -> None:
            packed = zlib.compress("\n".join(json.dumps(x) for x in lines).encode())
            directory.append((lines[0][0], out.tell(), len(packed)))
            out.write(packed)
            lines.clear()

        try:
            for batch in batches:
                if batch.num_rows and out is None:
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                for line in zip(*(c.to_pylist() for c in batch.columns)):
                    lines.append(line)
                    n, last = n + 1, line[0]
                    if len(lines) >= block_lines:
                        close_block()
            if out is None:
                return
            if lines:
                close_block()
            at = out.tell()
            out.write(zlib.compress(json.dumps(directory).encode()))
        finally:
            if out is not None:
                out.close()
        yield pa.RecordBatch.from_pylist(
            [{"part": task.partitionId(), "file": name, "at": at, "first": directory[0][0], "last": last, "n": n}], schema=schema
        )

    return write


def write_index(records: DataFrame, folder: str, block_lines: int = BLOCK_LINES, part_lines: int = PART_LINES) -> Index:
    """Sort ``records`` by key into parts of about ``part_lines`` lines and write them. One row per part comes back."""
    make_folder(folder)
    parts = max(spread(records.sparkSession), -(-records.count() // part_lines))
    # page_id and place behind the key: the captures of one key can fill several parts
    order = ["key", "page_id", "file", "offset"]
    lines = records.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("key", "page_id", "url", "file", "offset", "length")
    schema = "part int, file string, at long, first string, last string, n long"
    made = map_batches(lines, _indexer(folder, block_lines), schema).collect()
    return Index(folder, [tuple(r) for r in sorted(made, key=lambda r: r["part"])])


def _router(firsts: list[str], lasts: list[str]):
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts = [], []
            for key in batch.column(0).to_pylist():
                for part in range(bisect_left(lasts, key), bisect_right(firsts, key)):
                    keys.append(key)
                    parts.append(part)
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(keys, pa.string())], names=["part", "key"])

    return route


class Part:
    """An opened index part: the directory in memory, one block at a time read from the file."""

    def __init__(self, files: FileSystem, root: str, entry: tuple) -> None:
        _, name, at, *_ = entry
        self.file = files.open_input_file(f"{root}/{name}")
        self.directory = json.loads(zlib.decompress(self.file.read_at(self.file.size() - at, at)))
        self.firsts = [d[0] for d in self.directory]
        self.held, self.lines, self.keys = -1, [], []

    def block(self, k: int) -> None:
        if k != self.held:
            _, at, length = self.directory[k]
            self.lines = [json.loads(x) for x in zlib.decompress(self.file.read_at(length, at)).split(b"\n")]
            self.keys = [x[0] for x in self.lines]
            self.held = k

    def find(self, key: str) -> Iterator[list]:
        """All lines with the key, by binary search in the directory and then in each block that can hold it."""
        k = max(0, bisect_left(self.firsts, key) - 1)
        while k < len(self.firsts) and self.firsts[k] <= key:
            self.block(k)
            for i in range(bisect_left(self.keys, key), bisect_right(self.keys, key)):
                yield self.lines[i]
            k += 1


_FOUND = pa.schema(
    [("key", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
)


def _searcher(index: Index, lot: int = 2000):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = FileSystem.from_uri(index.folder)
        opened, part, found = -1, None, []

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), _FOUND.types)], schema=_FOUND)
            found.clear()
            return batch

        for batch in batches:
            for k, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != opened:
                    if part is not None:
                        part.file.close()
                    opened, part = k, Part(files, root, index.parts[k])
                for line in part.find(key):
                    found.append(line)
                    if len(found) >= lot:
                        yield out()
        if found:
            yield out()

    return search


def lookup(keys: DataFrame, index: Index) -> DataFrame:
    """The captures (``FOUND``) of each key in the one column of ``keys``; a key that occurs twice is found twice."""
    keys = keys.select(F.coalesce(keys[keys.columns[0]].cast("string"), F.lit("")).alias("key"))
    routed = map_batches(keys, _router(index.firsts, index.lasts), "part int, key string")
    routed = routed.repartition(max(1, min(len(index.parts), 1 << 16)), "part").sortWithinPartitions("part", "key")
    return map_batches(routed, _searcher(index), FOUND)


def lookup_urls(urls: DataFrame, index: Index) -> DataFrame:
    """The captures of exactly the urls in the one column of ``urls``, each asked for once."""
    asked = urls.select(urls[urls.columns[0]].cast("string").alias("asked")).distinct()
    found = lookup(asked.select(url_key(F.col("asked")).alias("key")).distinct(), index)
    return found.join(asked, F.col("url").eqNullSafe(F.col("asked")), "left_semi")


def parsed(data: bytes) -> dict:
    """A record from its gzip member: its fields, the payload, and what ``READ`` names."""
    text = zlib.decompress(data, 31)
    head, rest = text.split(b"\r\n\r\n", 1)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response":
        real = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if real != digest or len(payload) != size:
            raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    else:
        payload = None
    page, other = fields.get("X-Page"), fields.get("X-Refers-To-Page")
    return {
        "page_id": None if page is None else int(page), "record_type": fields["WARC-Type"], "fields": fields,
        "refers_to": None if other is None else int(other), "payload_bytes": size, "payload_digest": digest, "payload": payload,
    }


_READ = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("payload", pa.binary()),
])


def _reader(folder: str, ahead: int, with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = FileSystem.from_uri(folder)
        name, file, held, held_at = None, None, b"", 0
        for batch in batches:
            rows, size = [], 0
            for url, of, at, length in zip(*(batch.column(c).to_pylist() for c in ("url", "file", "offset", "length"))):
                if of != name:
                    if file is not None:
                        file.close()
                    name, file, held = of, files.open_input_file(f"{root}/{of}"), b""
                if at < held_at or at + length > held_at + len(held):
                    held, held_at = file.read_at(max(length, ahead), at), at
                record = parsed(held[at - held_at : at - held_at + length])
                record["url"] = url
                record["payload"] = record["payload"] if with_payload else None
                rows.append({c: record[c] for c in _READ.names})
                size += len(record["payload"] or b"")
                if size > 1 << 23:
                    yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_READ)

    return read


def read_records(captures: DataFrame, folder: str, ahead: int = READ_AHEAD, with_payload: bool = True) -> DataFrame:
    """The records (``READ``) at the places in ``captures``, which are read in the order of their files.

    Neighbours are read together, up to ``ahead`` bytes; with 0 only the records' own ranges. A revisit
    has no payload; its size and digest are those of the full payload it stands for.
    """
    n = spread(captures.sparkSession)
    ordered = captures.select("url", "file", "offset", "length").repartition(n, "file").sortWithinPartitions("file", "offset")
    return map_batches(ordered, _reader(folder, ahead, with_payload), READ)


def report(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archives and index of ``pages``, and every page's record as found through the index and read back.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to, url.
    """
    folder = shared_folder(spark, "warc")
    index = write_index(write_archives(pages, f"{folder}/archives"), f"{folder}/index")
    keys = pages.select(url_key(F.col("url").cast("string")).alias("key")).distinct()
    records = read_records(lookup(keys, index), f"{folder}/archives", with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     d AS (SELECT page_id, strlen(html) AS bytes, html, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
           (((strpos('0123456789abcdef', substr(h, 1 + i * 5 // 4, 1)) - 1) * 16
             + greatest(strpos('0123456789abcdef', substr(h || '0', 2 + i * 5 // 4, 1)) - 1, 0)) >> CAST(3 - i * 5 % 4 AS INTEGER)) & 31) AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM d
"""
