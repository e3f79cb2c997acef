import base64
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from check_oracles import compare
from tabwright.llm import warc

PAGES = "page_id long, url string, html string"
AWKWARD = [
    (1, "http://www.Example.com:80/a?x=1#top", "<p>ä</p>"), (2, "https://example.com", "<p>ä</p>"), (3, None, None), (4, "", ""), (5, "not a url\nat all", None),
    (5, "not a url\nat all", None), (None, "http://b.org/", "n"), (None, "http://b.org/", "n"), (None, None, "<p>ä</p>"), (6, "http://c.org/", "x" * 3_000_000),
    (7, "http://c.org/", "日本" * 10), (7, "http://c.org/", "日本" * 10), (7, "http://c.org/", "日本" * 11), (-8, "http://user@d.org/%7Efoo bar", "x"),
] + [(100 + i, "http://hot.org/same", f"page {i % 7}") for i in range(300)] + [(500 + i, f"http://h{i % 9}.org/{i}", "copy") for i in range(100)]


def brute(rows):
    groups = {}
    for page, url, html in rows:
        groups.setdefault((html or "").encode(), []).append((page is not None, page or 0, url is not None, url or ""))
    out = []
    for payload, members in groups.items():
        members.sort()
        top = members[-1]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for m in members[:-1]:
            out.append((m[1] if m[0] else None, len(payload), digest, "revisit", top[1] if top[0] else None))
        out.append((top[1] if top[0] else None, len(payload), digest, "response", None))
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


def same(got, want):
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(AWKWARD, PAGES).repartition(5)


@pytest.fixture(scope="module")
def written(spark, pages, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warc"))
    records = warc.write_archives(pages, f"{folder}/archives", archive_bytes=20_000)
    return folder, records, warc.write_index(records, f"{folder}/index", block_lines=8, part_lines=64)


def test_query_equals_its_twin(spark, sf):
    name = "op11_warc_index"
    assert compare(spark, name, __spark_entry__.queries()[name], __spark_entry__.oracle_sql()[name], sf).startswith("ok")


def test_report_of_awkward_pages(spark, pages):
    clashing = pages.withColumns({c: F.lit(1) for c in ("key", "same", "top", "copy", "n", "lot", "file", "offset", "part", "bytes", "sha1")})
    same(warc.report(spark, clashing).collect(), brute(AWKWARD))


def test_no_pages(spark):
    assert warc.report(spark, spark.createDataFrame([], PAGES)).collect() == []


def test_archives_are_gzip_members_that_the_index_points_to(written):
    folder, records, _ = written
    import os

    rows = records.collect()
    assert len(rows) == len(AWKWARD)
    seen = 0
    for name in {r["file"] for r in rows}:
        data = open(os.path.join(folder, "archives", name), "rb").read()
        own = {r["offset"]: r["length"] for r in rows if r["file"] == name}
        at = 0
        while at < len(data):
            packer = zlib.decompressobj(31)
            text = packer.decompress(data[at:]) + packer.flush()
            length = len(data) - at - len(packer.unused_data)
            assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
            head, rest = text.split(b"\r\n\r\n", 1)
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            assert len(rest) == int(fields["Content-Length"]) + 4
            if fields["WARC-Type"] != "warcinfo":
                assert own[at] == length
                seen += 1
            at += length
    assert seen == len(AWKWARD)


def test_blocks_are_sorted_and_a_key_may_fill_many_parts(written):
    _, _, index = written
    assert index.firsts == sorted(index.firsts) and sum(p[5] for p in index.parts) == len(AWKWARD)
    hot = "org,hot)/same"
    assert sum(first <= hot <= last for first, last in zip(index.firsts, index.lasts)) > 1


def test_lookup_by_url_reads_only_its_records(spark, written):
    folder, _, index = written
    asked = ["http://hot.org/same", "http://c.org/", "https://example.com", "http://absent.org/", None]
    found = warc.lookup_urls(spark.createDataFrame([(u,) for u in asked + asked[:1]], "clash string"), index)
    read = warc.read_records(found, f"{folder}/archives", ahead=0).collect()
    same([(r["page_id"], r["url"]) for r in read], [(p, u) for p, u, _ in AWKWARD if u in asked])
    texts = {h or "" for _, u, h in AWKWARD if u in asked}
    assert {r["payload"].decode() for r in read if r["record_type"] == "response"} <= texts
    assert any(len(r["payload"] or b"") == 3_000_000 for r in read)


def test_keys(spark):
    rows = spark.createDataFrame([(u,) for u in ("http://www.Example.com:80/a?x=1#t", "https://u:p@example.com", "//a.b?q", "", None)], "u string")
    assert [r[0] for r in rows.select(warc.url_key(F.col("u"))).collect()] == ["com,example,www)/a?x=1", "com,example)/", ")//a.b?q", ")/", ""]
