"""Every query over the given tables against brute force."""

import re
import zlib

import numpy as np
import pytest

from tests.llm import brute
from tests.llm.conftest import SF
from tests.oracle import compare, connect
from tidemark.llm import packing, quality
from tidemark.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def result(spark):
    done = {}

    def rows(number):
        if number not in done:
            name = next(q for q in QUERIES if q.startswith(f"op{number}_"))
            done[number] = [r.asDict() for r in QUERIES[name](spark, SF).collect()]
        return done[number]

    return rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    compare(spark, connect(SF), SF, name, QUERIES[name], ORACLES[name])


def test_contamination(result, table):
    want = brute.contamination(table("documents", "doc_id", "text"), table("benchmark", "item_id", "text"))
    keys = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(tuple(r[k] for k in keys) for r in result(1)) == sorted(want)
    assert any(r[-1] for r in want)


def test_quality_is_learnt(result, table):
    labels = {i: q for i, q in table("labels", "doc_id", "quality")}
    rows = result(2)
    assert len(rows) == len(table("documents", "doc_id"))
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in held)
    assert right >= 0.85 * len(held)


def test_text_of_pages(result, table):
    pages = {i: h for i, h in table("pages", "page_id", "html")}
    rows = result(3)
    assert len(rows) == len(pages)
    for r in rows:
        # The given pages have one article each, of paragraphs and inline tags.
        inner = re.search(r"<article>(.*?)(?:</article>|$)", pages[r["page_id"]], re.S)[1]
        parts = [re.sub(r"<br>|<[^>]+>", " ", p) for p in re.split(r"</?(?:p|h1)>", inner)]
        from html import unescape

        want = "\n\n".join(x for p in parts if (x := " ".join(unescape(p).split())))
        assert r["text"] == want and r["n_chars"] == len(want)


def test_vectors(spark, table):
    sf = "/root/testdata/sf0.01"
    want = brute.similar_vectors(table("embeddings", "vec_id", "embedding", sf=sf))
    rows = QUERIES["op4_embedding_near_dedup"](spark, sf).collect()
    assert sorted(tuple(r[k] for k in ("vec_id", "n_links", "component_id", "kept")) for r in rows) == sorted(want)


@pytest.mark.parametrize(("number", "kinds"), [(5, brute.SECRETS), (9, brute.PERSONAL)])
def test_spans(result, table, number, kinds):
    texts = dict(table("documents", "doc_id", "text"))
    rows = result(number)
    assert len(rows) == len(texts)
    for r in rows:
        want = brute.spans_row(r["doc_id"], texts[r["doc_id"]], kinds)
        assert {k: r[k] for k in want} == want
        base = [f"{k}:{s}:{e}" for s, _, e, k in brute.base_spans(texts[r["doc_id"]], kinds)]
        spans = r["spans"].split(",") if r["spans"] else []
        assert [x for x in spans if x.split(":")[0] in kinds] == base
        starts = [int(x.split(":")[1]) for x in spans]
        assert starts == sorted(starts)


def test_shards(result, table):
    texts = dict(table("documents", "doc_id", "text"))
    rows, slots = result(6), {}
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r["doc_id"]]
        assert r["size"] == len((t or "").encode()) + 16 and r["text_crc32"] == brute.crc(t) and r["law"] == "key"
        assert 0 <= r["shard"] < 40 and r["grown_shard"] in (r["shard"], 40)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) > 30


def test_near_duplicates(result, table):
    want = brute.near_duplicates(table("documents", "doc_id", "text"))
    keys = ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(tuple(r[k] for k in keys) for r in result(7)) == sorted(want)


def test_packing(result, table):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary())
    by_doc, by_sequence = {}, {}
    for r in result(10):
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    total = 0
    for doc_id, text in table("documents", "doc_id", "text"):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        rows = sorted(by_doc.pop(doc_id), key=lambda r: r["piece"])
        assert [r["piece"] for r in rows] == list(range(len(rows)))
        at = 0
        for r in rows:
            assert r["start"] == at
            own = ids[at : at + r["length"]]
            assert len(own) == r["length"] and zlib.crc32(np.array(own, "<u4").tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
        assert len(rows) == 1 if len(ids) <= 1024 else all(r["length"] == 1024 for r in rows[1:])
        total += len(ids)
    assert not by_doc
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(by_sequence) <= 1.02 * total / 1024 + 2


def test_no_label_is_looked_at(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    from pyspark.sql import functions as F

    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    renamed = docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y"))
    a = {r["doc_id"]: r["score"] for r in quality.report(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in quality.report(renamed, turned).collect()}
    assert a == b
