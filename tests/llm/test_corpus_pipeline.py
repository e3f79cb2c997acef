import importlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tabwright.llm import mixing, toxicity
from test_decontaminate import brute as contaminated
from test_minhash import brute as groups


def test_stages_are_what_they_say(spark, sf):
    """Each stage against brute force on all that the one before it kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    tables = {}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, sf).cache()
        tables[name] = (before, after)
        before = after
    rows = lambda df: sorted(tuple(r) for r in df.collect())

    a, b = tables["toxicity"]
    model = toxicity.trained(a, spark.read.parquet(f"{sf}/labels.parquet"))
    toxic = {r["doc_id"] for r in toxicity.scored(a, model).where("score >= 0.5").collect()}
    assert b.columns == columns and toxic and rows(b) == [r for r in rows(a) if r[0] not in toxic]

    a, b = tables["minhash_near_dedup"]
    kept = groups([(r["doc_id"], r["text"]) for r in a.collect()])
    assert b.columns == columns and rows(b) == [r for r in rows(a) if kept[r[0]][2]]

    a, b = tables["benchmark_decontamination"]
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    bad = {r[0] for r in contaminated([(r["doc_id"], r["text"]) for r in a.collect()], [(r["item_id"], r["text"]) for r in items]) if r[5]}
    assert b.columns == columns and rows(b) == [r for r in rows(a) if r[0] not in bad]

    a, b = tables["source_mixing"]
    times = {r["doc_id"]: r["epochs"] for r in mixing.mixture(a).collect()}
    assert b.columns == columns and rows(b) == sorted(r for r in rows(a) for _ in range(times[r[0]]))

    a, b = tables["token_output"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, want = 0, []
    for r in sorted(a.collect(), key=lambda r: r["doc_id"]):
        ids = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert rows(b) == sorted(want)


@pytest.mark.parametrize("table", ["awkward", "none"])
def test_stages_stand_awkward_rows(spark, sf, request, table):
    docs = request.getfixturevalue(table)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf).cache()
        docs.count()


def test_queries_are_registered(spark):
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
