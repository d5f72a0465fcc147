"""What is very long, very deep or very often repeated, how rows are dealt to tasks, and sides too large to send."""

import os
import subprocess
import sys
import textwrap
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import SF
from tests.llm.test_edges import DOCS, ITEMS, ROWS, document, prose
from tidemark.llm import (
    decontaminate, embeddings, extract, minhash, packing, pii, quality, secrets, sharding, tables, text, trie, urls,
)
from tidemark.llm.queries import QUERIES


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- long runs, deep and wide pages


@pytest.mark.parametrize("run", [" " * 1_000_000, "x " + "\n" * 5_000_000 + " y", "-" * 1_000_000, "a" * 1_000_000, "\t " * 300_000])
def test_ids_of_long_runs(run):
    from tokenizers import Tokenizer

    path = packing.vocabulary()
    want = Tokenizer.from_file(path).encode(run, add_special_tokens=False).ids
    assert np.frombuffer(packing.Encoder(path)(run), np.uint32).tolist() == want


def test_panics_of_the_library_are_caught(monkeypatch):
    """Also those on runs that nobody knows of yet."""
    monkeypatch.setattr(packing, "LONG_RUN", packing.re.compile(r"(?!)"))
    encoder = packing.Encoder(packing.vocabulary())
    run = " " * 1_500_000
    assert np.frombuffer(encoder(run), np.uint32).tolist() == encoder.tokenizer.encode(run, add_special_tokens=False).ids


def nested(n, name="div"):
    return f"<{name}>" * n + "deep text" + f"</{name}>" * n + "<p>after it</p>"


@pytest.mark.parametrize("html", [
    nested(100_000), nested(3_000, "section"), "<x1>" * 100_000 + "deep text", "<p>" + "<b><x>" * 50_000 + "deep text",
    "".join(f"<e{i}>" for i in range(30_000)) + "deep text" + "".join(f"</e{i}>" for i in range(30_000)),
], ids=["div", "section", "unclosed", "inline", "differing"])
def test_deep_pages(html):
    start = time.time()
    assert "deep text" in extract.text_of(html, None)
    assert time.time() - start < 20


def test_wide_pages():
    """Ten thousand differing siblings, in another order on each page."""
    names = [f"e{i}" for i in range(10_000)]
    pages = ["".join(f"<{x}>text of {x} {n}</{x}>" for x in (names, names[::-1], names[5_000:] + names[:5_000])[n]) for n in range(3)]
    start = time.time()
    trees = [extract._tree(extract.blocks(p)) for p in pages]
    whole = extract.align(extract.align(trees[0], trees[1]), trees[2])
    assert time.time() - start < 20
    assert {x[0] for x in whole} == set(names)
    both = extract.align(trees[0], trees[2])
    assert sum(not x[1] for x in both) == 5_000  # half of them stand in order on both


def test_alignment_of_long_lists_finds_what_the_table_finds(monkeypatch):
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = ([[f"l{i}", 0, 0, [["#", 0, 0, [["m"], "t", 1]]]] for i in rng.permutation(30)[:20]] for _ in range(2))
        assert len(extract._common(a, b)) == len(extract._by_occurrence(a, b))


def test_inline_elements_leave_no_blanks():
    assert extract.text_of("<p>super<wbr>man and a <img src=x>picture<br>below</p>", None) == "superman and a picture below"


def test_text_beyond_the_main_place_stays():
    story, end = prose(200, 1), prose(16, 2)
    html = f"<body><div class=a><div>{story}</div><div>{end}</div></div><div class=sidebar>{prose(9, 3)}</div></body>"
    assert extract.text_of(html, None) == f"{story}\n\n{end}"
    html = f"<body><div class=a><div>{story}</div></div><div class=b>{end}</div></body>"
    assert extract.text_of(html, None) == f"{story}\n\n{end}"


# ---- how rows are dealt to tasks


def shuffled_pages(n=40):
    """Pages of one host whose blocks stand in varying order, some of them left out."""
    rng = np.random.default_rng(2)
    out = []
    for i in range(n):
        parts = [f"<div class=c{k}><p>{prose(12, 100 * i + k)}</p></div>" for k in range(5)]
        parts += ["<ul class=x><li>one<li>two</ul>", f"<table><tr><td>{prose(3, i)}</table>", "<h2>Same head</h2>", "<p>Same end</p>"]
        kept = [parts[k] for k in rng.permutation(len(parts)) if rng.random() < 0.8]
        out.append((i, "http://h.org/" + str(i), "<body>" + "".join(kept) + "</body>"))
    return out + [(i, "http://other.org/", html) for i, _, html in out[:5]] + out[:7]


@pytest.mark.parametrize("together", [1024, 4])
def test_pages_in_any_layout_give_one_text(spark, monkeypatch, together):
    monkeypatch.setattr(extract, "TOGETHER", together)
    df = spark.createDataFrame(shuffled_pages(), "page_id long, url string, html string")
    want = rows(extract.extract(df.coalesce(1)))
    for n in (2, 5, 9):
        assert rows(extract.extract(df.orderBy(F.xxhash64("page_id", F.lit(n))).repartition(n))) == want
    # The same as one fold over the distinct pages by their digests, where they are few enough for one task.
    if together > 100:
        trees = {}
        for _, _, html in shuffled_pages()[:40]:
            made = extract.json.dumps(extract._tree(extract.blocks(html)))
            digest = int.from_bytes(extract.blake2b(made.encode(), digest_size=8).digest(), signed=True)
            trees[digest] = made
        whole = None
        for _, made in sorted(trees.items()):
            whole = extract.json.loads(made) if whole is None else extract.align(whole, extract.json.loads(made))
        rule = extract.rules(whole)
        texts = sorted((i, extract.text_of(html, rule)) for i, url, html in shuffled_pages() if "h.org/" in url and "other" not in url)
        assert texts == sorted((r[0], r[2]) for r in want if "other" not in r[1])


def test_scores_in_any_layout_are_equal(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    want = rows(quality.report(docs.coalesce(1), labels))
    for n in (3, 7):
        assert rows(quality.report(docs.repartition(n), labels.repartition(n))) == want


def test_scores_are_votes(spark, table):
    """Every score recomputed: all similarities, the nearest sixteen, weighted; ties share what is left."""
    labels = {}
    for i, q in table("labels", "doc_id", "quality"):
        if q is not None and brute.zlib.crc32(str(i).encode()) % 4 != 2:
            labels[i] = min(q, labels.get(i, q))
    texts = dict(table("documents", "doc_id", "text"))
    known = sorted(i for i in labels if i in texts)
    counts = np.log1p(np.stack([quality.term_counts(texts[i]) for i in known])).astype(np.float16).astype(np.float32)
    model = quality.fit(counts, np.array([float(labels[i] == 1) for i in known]))
    vectors = model.latent(counts)
    got = {r["doc_id"]: r["score"] for r in QUERIES["op2_quality_classifier"](spark, SF).collect()}
    assert len(got) == len(texts)
    for i, t in texts.items():
        x = model.latent(np.log1p(quality.term_counts(t))[None])[0]
        similar = sorted(((round(max(float(v @ x), 0), 9), float(labels[k] == 1)) for v, k in zip(vectors, known, strict=True)), reverse=True)
        last = similar[15][0]
        above = [s for s in similar if s[0] > last]
        level = [s for s in similar if s[0] == last]
        share = (16 - len(above)) / len(level)
        weights = [(s**8, y) for s, y in above] + [(share * s**8, y) for s, y in level]
        total = sum(w for w, _ in weights)
        want = sum(w * y for w, y in weights) / total if total and (t or "").strip() else model.labels.mean()
        assert got[i] == pytest.approx(want, abs=2e-8), i


def test_one_label_teaches_one_row(spark, monkeypatch):
    """However many rows of its document there are."""
    taught = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, y: taught.append(len(y)) or fit(x, y))
    docs = spark.range(100_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 3).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(3, "other text")], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1), (1, 0), (1, 1), (3, 1)], "doc_id long, quality int")
    quality.train(docs, labels)
    assert taught == [2]


# ---- vectors with links


def clustered(n=600, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(12, dim))
    out = [(i, middles[i % 12] + 0.14 * rng.normal(size=dim)) for i in range(n)]
    return [(i, [float(c) for c in v]) for i, v in out]


def test_links_of_near_vectors(spark, monkeypatch):
    """Against brute force, where there are thousands of links, many near the least cosine."""
    monkeypatch.setattr(embeddings, "PER_CELL", 8)
    want = brute.similar_vectors(clustered())
    assert sum(r[1] for r in want) > 10_000
    found = embeddings.near_duplicates(spark.createDataFrame(clustered(), "vec_id long, embedding array<double>"))
    got = {r["vec_id"]: r for r in found.collect()}
    links = sum(r["n_links"] for r in got.values())
    assert links >= 0.99 * sum(r[1] for r in want) and all(got[i]["n_links"] <= n for i, n, _, _ in want)
    assert np.mean([got[i]["component_id"] == c for i, _, c, _ in want]) >= 0.99


def test_huge_and_tiny_components_link(spark):
    rows_ = [(1, [1e200, 1e200]), (2, [1e200, 1.01e200]), (3, [1e-200, 1e-200]), (4, [1e-310, 1e-310]), (5, [1e308, -1e308]),
             (6, [0.0, 5e-324]), (7, [-1.0, 1.0])]
    found = embeddings.near_duplicates(spark.createDataFrame(rows_, "vec_id long, embedding array<double>"))
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found.collect()} == {
        1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5), 6: (0, 6), 7: (0, 7)}


# ---- the draw of shards


def test_draws_move_rows_only_into_a_new_shard(spark):
    """Of any weights, and whatever the layout."""
    docs = spark.createDataFrame([(i,) for i in range(300)], "doc_id long").withColumn("text", F.lit("x"))
    weights = [1.0, 3.0, 2.0, 4.0]
    found = sharding.shards(docs, weights, [*weights, 2.0])
    counts = {r["shard"]: r["count"] for r in found.groupBy("shard").count().collect()}
    assert sum(counts.values()) == 300 and all(counts[k] > 0 for k in range(4))
    moved = found.where("shard <> grown_shard").select("grown_shard").distinct().collect()
    assert [r[0] for r in moved] == [4]
    again = sharding.shards(docs.repartition(7), weights, [*weights, 2.0]).select("doc_id", "shard", "grown_shard")
    assert rows(again) == rows(found.select("doc_id", "shard", "grown_shard"))


# ---- texts with very many spans


@pytest.mark.parametrize("seed", range(6))
def test_cutting_agrees_with_slices(spark, seed):
    rng = np.random.default_rng(seed)
    whole = "".join(rng.choice(list("abé𝔘 \n"), size=int(rng.integers(0, 5000))))
    n = len(whole)
    spans = []
    for _ in range(int(rng.integers(1, 60))):
        a, b = sorted(map(int, rng.integers(0, n + 1, 2)))
        spans.append((a, min(b, a + 40) if rng.random() < 0.9 else b, rng.choice(["", "[X]"])))
    df = spark.createDataFrame([(1, whole, spans)], "id int, text string, _spans array<struct<start:long,end:long,mark:string>>")
    cut = text.cuts(df.select("id", "_spans"), ["id"])
    out = df.join(cut, "id").withColumn("_blocks", text.blocks(F.col("text")))
    got = out.select(text.put_together(F.col("_blocks"), F.char_length("text"), F.col("_cuts"), F.col("_tail"))).first()[0]
    want, at = "", 0
    for a, b, mark in sorted(spans):
        if a >= at:
            want += whole[at:a] + mark
        at = max(at, b)
    assert got == want + whole[at:]


def test_a_text_with_a_hundred_thousand_secrets(spark):
    one = "see password=abcdef{:06d} there. "
    whole = "".join(one.format(i) for i in range(100_000))
    docs = spark.createDataFrame(document([(1, whole), (2, "nothing"), (3, None)]), DOCS)
    start = time.time()
    out = {r["doc_id"]: r for r in secrets.redact(docs).collect()}
    assert time.time() - start < 60
    assert out[1]["text"] == "see [SECRET] there. " * 100_000 and out[1]["n_chars"] == len(out[1]["text"])
    assert out[2]["text"] == "nothing" and out[3]["text"] is None


def test_equal_rows_of_a_document(spark):
    """A set is compared once, however many rows have it."""
    shared = prose(300, 5)
    docs = spark.range(20_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit(shared).alias("text")).unionByName(
        spark.createDataFrame([(2, shared + " tail"), (3, prose(300, 6))], "doc_id long, text string"))
    found = minhash.near_duplicates(docs.repartition(8))
    got = found.groupBy("doc_id", "component_id", "kept").count().orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(1, 1, True, 20_000), (2, 1, False, 1), (3, 3, True, 1)]


# ---- sides that are too large to send


def test_shuffled_joins_give_equal_rows(spark, monkeypatch):
    """With a limit of no rows, read when it is called for, nothing is broadcast by it."""
    made = spark.createDataFrame(document(ROWS), DOCS).repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    pages = spark.createDataFrame(shuffled_pages(12), "page_id long, url string, html string")
    runs = {
        "op1": lambda: decontaminate.report(made, items), "documents": lambda: decontaminate.remove_documents(made, items),
        "spans": lambda: decontaminate.remove_spans(made, items), "op3": lambda: extract.extract(pages),
        "op5": lambda: secrets.report(made), "redact": lambda: secrets.redact(made),
        "op9": lambda: pii.report(made), "sanitise": lambda: pii.sanitise(made),
        "op8": lambda: urls.judge(pages, urls.advert_hosts(pages)),
    }
    want = {name: rows(run()) for name, run in runs.items()}
    monkeypatch.setattr(tables, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(urls, "CASCADE_BITS", 0)
    assert not tables.fits(made)
    for name, run in runs.items():
        assert rows(run()) == want[name], name


def test_sides_are_bounded_by_bytes(spark, monkeypatch):
    few = spark.createDataFrame([("x" * 1000,)] * 5, "t string")
    assert tables.fits(few)
    monkeypatch.setattr(tables, "BROADCAST_BYTES", 4000)
    assert not tables.fits(few)


# ---- executors without this package


def test_queries_from_a_foreign_folder(tmp_path):
    """Only the driver has the repository: workers start elsewhere and can't import it."""
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = textwrap.dedent(f"""
        import sys
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config(
            "spark.sql.shuffle.partitions", "4").getOrCreate()
        spark.sparkContext.setLogLevel("OFF")
        sys.path.insert(0, {repo!r})
        import __spark_entry__ as entry
        for name, query in entry.queries().items():
            if name.startswith("op") or name == "pipeline":
                print(name, query(spark, {SF!r}).count(), flush=True)
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1200)
    assert done.returncode == 0, done.stderr[-2000:]
    assert len(done.stdout.split("\n")) >= len(QUERIES) + 1


# ---- the pipeline on odd documents


def test_pipeline_of_odd_documents(spark, tmp_path):
    """Null, empty, repeated and id-less rows, an empty table, and columns that clash: every piece is of a document that the stages
    kept, once per row."""
    for name, made in (("full", document(ROWS + ROWS[:4])), ("empty", [])):
        base = tmp_path / name
        docs = spark.createDataFrame(made, DOCS).withColumn("score", F.lit("x"))
        docs.write.parquet(str(base / "documents.parquet"))
        spark.createDataFrame([(4, 1), (9, 1), (6, 0), (None, 1)], "doc_id long, quality int").write.parquet(str(base / "labels.parquet"))
        spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(str(base / "benchmark.parquet"))
        out = corpus_pipeline.run(spark, str(base)).collect()
        assert all(0 < r["length"] <= 1024 for r in out) and (out or name == "empty")
        starts = [(r["doc_id"], r["piece"], r["ids_crc32"]) for r in out if r["doc_id"] is not None and r["piece"] == 0]
        assert len({s[0] for s in starts}) <= len(starts)
        contaminated = {8, 9, 4, 5}  # these hold an item's passage
        assert not contaminated & {r["doc_id"] for r in out}


def test_trie_of_equal_conversations(spark):
    """A third of all conversations are alike."""
    made = spark.range(3000).select(
        (20 * F.col("id")).alias("conv_id"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("turn")).select(
        "conv_id", F.col("turn").cast("long"), F.lit("user").alias("role"),
        F.when(F.col("conv_id") % 60 == 0, "same words here").otherwise(F.concat(F.lit("own "), "conv_id")).alias("text"))
    found = {r["depth"]: r for r in trie.prefix_trie(made).where("n_convs >= 1000").collect()}
    assert [found[d]["n_convs"] for d in range(4)] == [3000, 1000, 1000, 1000]
    assert found[0]["n_children"] == 2001 and found[3]["n_leaves"] == 1 and found[0]["n_leaves"] == 2001
    assert found[1]["saved_tokens"] == 3 * 999 * 3
