"""Benchmark decontamination: token windows of test items looked up in training documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import bounded, stored
from tidemark.llm.text import words

#: Words of a window.
WINDOW = 10


def item_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """Distinct (item_id, len, window, ws): every n consecutive words of each item; of a shorter item, all its words.
    An item that is null, or has no words, has none."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0")
    items = items.withColumn("len", F.least(F.size("w"), F.lit(n)))
    at = items.select("*", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("len"))).alias("p"))
    ws = F.slice("w", F.col("p") + 1, F.col("len"))
    return at.select("item_id", "len", F.array_join(ws, " ").alias("window"), ws.alias("ws")).distinct()


def _stride(length: int) -> tuple[int, int]:
    """(s, g): every window of ``length`` words holds a whole g-gram that starts at a multiple of s."""
    s = (length + 1) // 2
    return s, length - s + 1


def _inner_grams(windows: DataFrame, length: int) -> DataFrame:
    """The hashed g-grams of windows of ``length`` words."""
    _, g = _stride(length)
    inner = F.transform(
        F.sequence(F.lit(0), F.lit(length - g)), lambda i: F.xxhash64(F.slice("ws", i + 1, F.lit(g))))
    return windows.where(F.col("len") == length).select("len", F.explode(inner).alias("gram"))


def _probes(w: Column, n: Column, length: int) -> Column:
    """The g-grams of a document at multiples of s, each with the words that windows around it can hold."""
    s, g = _stride(length)

    def probe(q: Column) -> Column:
        lo = F.greatest(q - (s - 1), F.lit(0))
        return F.struct(
            F.lit(length).alias("len"), q.alias("q"), F.xxhash64(F.slice(w, q + 1, F.lit(g))).alias("gram"),
            lo.alias("lo"), F.slice(w, lo + 1, q + length - lo).alias("near"),
        )

    return F.when(n >= length, F.transform(F.sequence(F.lit(0), n - g, F.lit(s)), probe))


def find(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """A row per document: doc_id, key (a number equal rows share), n_words, n_hit (words inside any occurrence of a window),
    n_items, items (ids of items with occurring windows, sorted as strings), hits (structs of the first word and the
    length of each occurrence).

    Null and empty texts have no words and no hits. Equal rows each get a row. An item without an id hits, but
    can't be named. Neither table's further columns matter. An empty benchmark hits nothing.

    A hash set of the windows' inner g-grams is broadcast (if small: else the join shuffles). Documents
    are scanned at every s-th word only, as any window holds a whole g-gram there; what the set knows is
    verified against the windows' words. One row per document goes along, so one shuffle of hits is all.
    """
    windows = stored(item_windows(benchmark, n), "windows")
    lengths = sorted(r[0] for r in windows.select("len").distinct().collect())
    grams = [_inner_grams(windows, x) for x in lengths]
    d = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), words(F.col("text")).alias("w"))
    d = d.withColumn("n_words", F.size("w"))
    # What no set knows, but another value for each document: so rows without a probe don't meet in one task.
    no_probe = F.struct(
        F.lit(-1).alias("len"), F.lit(None).cast("int").alias("q"), F.col("key").alias("gram"),
        F.lit(None).cast("int").alias("lo"), F.lit(None).cast("array<string>").alias("near"),
    )
    probes = [F.coalesce(_probes(F.col("w"), F.col("n_words"), x), F.array().cast(_PROBES)) for x in lengths]
    rows = d.select("doc_id", "key", "n_words", F.explode(F.concat(F.array(no_probe), *probes)).alias("p"))
    rows = rows.select("doc_id", "key", "n_words", "p.*")
    if lengths:
        known = stored(reduce(DataFrame.unionByName, grams).distinct().withColumn("known", F.lit(True)), "grams")
        rows = rows.join(bounded(known), ["len", "gram"], "left").where("q IS NULL OR known")
        starts = F.sequence(F.lit(0), F.least(F.col("q") - F.col("lo"), F.size("near") - F.col("len")))
        rows = rows.select(
            "doc_id", "key", "n_words", "len", "q", "lo", "near",
            F.explode_outer(F.when(F.size("near") >= F.col("len"), starts)).alias("k"),
        ).select(
            "doc_id", "key", "n_words", "q", "len", (F.col("lo") + F.col("k")).alias("start"),
            F.coalesce(
                F.array_join(F.slice("near", F.col("k") + 1, F.col("len")), " "), F.col("key").cast("string")).alias("window"),
        )
        by_window = windows.select("window", "len", "item_id").withColumn("hit", F.lit(True))
        rows = rows.join(bounded(by_window), ["window", "len"], "left").where("q IS NULL OR hit")
    else:
        rows = rows.select("*", F.lit(None).cast("int").alias("start"), F.lit(None).cast("long").alias("item_id"))
    each = rows.groupBy("doc_id", "key", "n_words").agg(
        F.sum(F.col("q").isNull().cast("int")).alias("copies"),
        F.collect_set(F.when(F.col("q").isNotNull(), F.struct("start", "len"))).alias("hits"),
        F.collect_set(F.col("item_id").cast("string")).alias("items"),
    )
    covered = F.aggregate(
        F.array_sort("hits"),
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, h: F.struct(
            F.greatest(a["end"], h["start"] + h["len"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), h["start"] + h["len"] - F.greatest(a["end"], h["start"]))).alias("n"),
        ),
    )["n"]
    # Copies of a hit shared by equal rows count once, as their places are the same.
    return each.select(
        "doc_id", "key", F.col("n_words").cast("long").alias("n_words"), covered.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sort_array("items").alias("items"), "hits",
        F.explode(F.sequence(F.lit(1), "copies")).alias("copy"),
    ).drop("copy")


_PROBES = "array<struct<len:int,q:int,gram:bigint,lo:int,near:array<string>>>"


def report(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """``find`` with the ids of items as one SHA-256, and whether there is any hit."""
    return find(docs, benchmark, n).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _hit(docs: DataFrame, benchmark: DataFrame, n: int) -> DataFrame:
    found = find(docs, benchmark, n).where("n_hit > 0").select(
        F.col("doc_id").alias("_id"), F.col("key").alias("_key"), F.col("hits").alias("_hits"))
    return bounded(stored(found.dropDuplicates(["_id", "_key"]), "contaminated"))


def _same(docs: DataFrame, hit: DataFrame) -> Column:
    return docs["doc_id"].eqNullSafe(hit["_id"]) & (F.xxhash64(docs["doc_id"], docs["text"]) == hit["_key"])


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """The documents without any hit, with all their columns."""
    hit = _hit(docs, benchmark, n)
    return docs.join(hit, _same(docs, hit), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """All documents; hit words, with what stands before each of them, are cut out of their texts."""
    hit = _hit(docs, benchmark, n)
    piece = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    joined = docs.join(hit, _same(docs, hit), "left")
    pieces = F.regexp_extract_all("text", F.lit(piece), F.lit(0))
    places = F.array_distinct(F.flatten(F.transform(
        "_hits", lambda h: F.sequence(h["start"], h["start"] + h["len"] - 1))))
    kept = F.filter(
        F.transform(pieces, lambda p, i: F.when(~F.array_contains(places, i), p)), lambda p: p.isNotNull())
    tail = F.substring(
        F.col("text"), F.aggregate(pieces, F.lit(0), lambda a, p: a + F.char_length(p)) + 1, F.char_length("text"))
    text = F.when(F.col("_hits").isNull(), F.col("text")).otherwise(F.concat(F.array_join(kept, ""), tail))
    return joined.withColumn("text", text).select(*docs.columns)


ORACLE = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
       'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
       'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
             FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, p, n, item_id FROM dw JOIN iw USING (n, win)),
places AS (SELECT doc_id, count(DISTINCT place) AS n_hit
           FROM (SELECT doc_id, unnest(range(p, p + n)) AS place FROM (SELECT DISTINCT doc_id, p, n FROM hit)) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""
