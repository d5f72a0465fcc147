"""Near-duplicate documents by MinHash bands, verified on whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shingles import MinHasher, Shingler
from tidemark.llm.tables import stored

#: Percent of the union that the intersection of linked sets reaches.
SIMILAR = 85
#: 32 bands of 6 minima: a pair at 85 % misses all of them with probability (1 - 0.85^6)^32, about 3 in 10^7.
BANDS, ROWS = 32, 6
#: Of 192 minima, a linked pair shares fewer than this with probability below 10^-7; others aren't verified.
LEAST_SHARED = 132
#: Shingles and sets that one task compares at a time, about. Larger groups are split.
UNIT_SHINGLES, UNIT_SETS = 2_000_000, 2_000
#: Rows that a task remembers, to hand over one of equal ones.
SEEN = 100_000
#: Bytes of sets that a task hands over at a time.
BATCH_BYTES = 1 << 24


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, d1, d2 (a digest of the set; null for an empty one), bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, hasher = Shingler(), MinHasher(BANDS, ROWS)
        for batch in batches:
            sizes, digests, bands = [], [], []
            for text in batch.column("text"):
                s = shingler.set(text.as_py())
                sizes.append(len(s))
                digest = blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                digests.append([int(x) for x in np.frombuffer(digest, np.int64)] if digest else [None, None])
                bands.append(hasher.keys(hasher.signature(s)) if len(s) else None)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_shingles": pa.array(sizes, pa.int64()),
                "d1": pa.array([d[0] for d in digests], pa.int64()),
                "d2": pa.array([d[1] for d in digests], pa.int64()), "bands": pa.array(bands, pa.list_(pa.int64())),
            })

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        sign, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>")


def _sets(docs: DataFrame, units: DataFrame) -> DataFrame:
    """units (id, units: array of leader, chunk, side) to a row per unit with the id's shingle set, from its text."""
    wanted = docs.select("doc_id", "text").join(units, F.col("doc_id") == F.col("id")).select("id", "text", "units")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        # Of equal rows, a task hands one over.
        seen: set[tuple[int, bytes]] = set()
        names = ["leader", "chunk", "side", "id", "shingles"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        out, size = [], 0
        made = lambda: pa.record_batch(
            [pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
        for batch in batches:
            for i, text, to in zip(*(batch.column(c) for c in ("id", "text", "units")), strict=True):
                s = shingler.set(text.as_py()).tobytes()
                one = (i.as_py(), blake2b(s, digest_size=16).digest())
                if one in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(one)
                for u in to.as_py():
                    out.append((u["leader"], u["chunk"], u["side"], i.as_py(), s))
                    size += len(s)
                    if size > BATCH_BYTES:
                        yield made()
                        out, size = [], 0
        if out:
            yield made()

    return wanted.mapInArrow(gather, "leader long, chunk long, side int, id long, shingles binary")


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    if 100 * min(len(a), len(b)) < SIMILAR * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= SIMILAR * (len(a) + len(b) - both)


def _verify(key: tuple, unit: pd.DataFrame) -> pd.DataFrame:
    """Links of one unit that connect what the unit's links connect, and which ids its leader reaches.

    Side 0 is the leader or another outlier, side 1 a member. First all are held against the leader. What it
    doesn't reach is held against every other set of the unit with enough minima in common, best first, until both are
    connected: so no link between parts is lost, and none within a part needs a look.
    """
    leader = key[0]
    unit = unit.drop_duplicates(["id", "side", "shingles"]).sort_values("id").reset_index(drop=True)
    ids = unit["id"].to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in unit["shingles"]]
    part = np.arange(len(ids))
    out = []

    def join(i: int, j: int) -> None:
        part[part == part[j]] = part[i]
        out.append((ids[j], ids[i], True))

    heads = np.flatnonzero(ids == leader)
    for h in heads:
        for j in range(len(ids)):
            if part[j] != part[h] and (ids[j] == ids[h] or _linked(sets[h], sets[j])):
                join(h, j)
    rest = np.flatnonzero(part != part[heads[0]]) if len(heads) else np.flatnonzero(unit["side"].to_numpy() == 0)
    if len(rest):
        hasher = MinHasher(BANDS, ROWS)
        signatures = np.stack([hasher.signature(s) for s in sets])
        for i in rest:
            shared = (signatures == signatures[i]).sum(axis=1)
            near = np.flatnonzero((shared >= LEAST_SHARED) & (part != part[i]))
            for j in near[np.argsort(-shared[near], kind="stable")]:
                if part[i] != part[j] and _linked(sets[i], sets[j]):
                    join(i, j)
    if len(heads):
        out += [(i, leader, False) for i in ids[part != part[heads[0]]]]
    return pd.DataFrame(out, columns=["a", "b", "linked"]).astype({"a": "int64", "b": "int64", "linked": "bool"})


def _units(rows: DataFrame) -> DataFrame:
    """(id, leader, chunk, side) to what ``_sets`` takes. An id has a leader per band at most, and a leader its chunks."""
    return rows.groupBy("id").agg(F.collect_list(F.struct("leader", "chunk", "side")).alias("units"))


def links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """classes (rep, bands): a row per distinct shingle set. Returns links (a, b) with the components of all links.

    The ids that share a band's key form a bucket, and the least of them leads it. A leader's buckets are verified
    together, as one unit or, if large, as chunks that each hold the leader. In a split unit, the sets that the
    leader doesn't reach go to all its other chunks too. Pairs are compared within tasks and never listed.
    """
    banded = classes.select("rep", F.explode("bands").alias("band"))
    leaders = banded.groupBy("band").agg(F.min("rep").alias("leader"), F.max("rep").alias("last"))
    leaders = leaders.where("leader < last").select("band", "leader")
    members = stored(banded.join(leaders, "band").where("rep != leader").select("leader", "rep").distinct(), "members")
    size = classes.select("rep", "n_shingles").groupBy("rep").agg(F.max("n_shingles").alias("n"))
    chunks = members.join(size, "rep").groupBy("leader").agg(
        F.greatest(F.ceil(F.sum("n") / UNIT_SHINGLES), F.ceil(F.count("*") / UNIT_SETS)).cast("long").alias("chunks"))
    chunks = stored(chunks, "chunks")
    place = F.pmod(F.xxhash64("rep"), F.col("chunks")).alias("chunk")
    dealt = members.join(chunks, "leader").select(
        F.col("rep").alias("id"), "leader", place, F.lit(1).alias("side"), "chunks")
    lead = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk")
    led = chunks.select(F.col("leader").alias("id"), "leader", lead, F.lit(0).alias("side"))
    sets = _sets(docs, _units(dealt.drop("chunks").unionByName(led)))
    schema = "a long, b long, linked boolean"
    first = stored(sets.groupBy("leader", "chunk").applyInPandas(_verify, schema), "verified")
    found = first.where("linked").select("a", "b")
    split = chunks.where("chunks > 1")
    if split.count() == 0:
        return found
    # Sets that the leader of a split unit doesn't reach, dealt into blocks, meet every chunk.
    out = first.where("NOT linked").select(F.col("a").alias("id"), F.col("b").alias("leader")).distinct()
    out = out.join(split, "leader")
    blocks = out.groupBy("leader").agg(F.ceil(F.count("*") / UNIT_SETS).cast("long").alias("blocks"))
    out = stored(out.join(blocks, "leader"), "outliers")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    # A chunk of members and a block of outliers make a unit without a leader: numbered below 0.
    number = lambda c, b: -(F.col(c) * F.col("blocks") + F.col(b)) - 1
    outside = out.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))).withColumn("c", every("chunks"))
    outside = outside.select("id", "leader", number("c", "block").alias("chunk"), F.lit(0).alias("side"))
    inside = dealt.join(blocks, "leader").withColumn("b", every("blocks"))
    inside = inside.select("id", "leader", number("chunk", "b").alias("chunk"), "side")
    again = _sets(docs, _units(outside.unionByName(inside)))
    more = again.groupBy("leader", "chunk").applyInPandas(_verify, schema).where("linked").select("a", "b")
    return found.unionByName(stored(more, "verified-across"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id, kept.

    A document's set: distinct 5-word shingles; of fewer words, all of them as one; a null, empty or blank text has none and is linked with
    nothing. Documents are linked where 100 * intersection >= 85 * union, and a component's id is its least doc_id,
    the only one kept. Equal rows each get a row; rows that share a doc_id are one node. A row without a doc_id is
    linked with nothing, has no component and is kept. Further columns don't matter; an empty table gives none.

    Equal sets are one class, with the least doc_id for it, so copies cost one row each. Sets hold 64-bit hashes of shingles.
    """
    signed = stored(_signed(docs), "signed")
    of_class = signed.where("d1 IS NOT NULL AND doc_id IS NOT NULL").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
    of_class = stored(of_class, "classes")
    own = signed.join(of_class.select("d1", "d2", F.col("rep").alias("doc_id")), ["doc_id", "d1", "d2"], "left_semi")
    classes = stored(own.select(F.col("doc_id").alias("rep"), "n_shingles", "bands"), "representatives")
    reached = components(links(docs, classes))
    of_class = of_class.join(reached, of_class["rep"] == reached["id"], "left").select(
        "d1", "d2", F.coalesce("component", "rep").alias("component"))
    slim = signed.select("doc_id", "n_shingles", "d1", "d2")
    slim = slim.withColumns({
        k: F.when(F.col("doc_id").isNotNull(), F.col(k)) for k in ("d1", "d2")})
    joined = slim.join(of_class, ["d1", "d2"], "left")
    component = F.coalesce("component", "doc_id").alias("component_id")
    return joined.select("doc_id", "n_shingles", component).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs with one document of each component, the least doc_id, with all columns."""
    dropped = near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("_id")).distinct()
    dropped = stored(dropped, "duplicates")
    kept = docs.join(dropped, docs["doc_id"] == dropped["_id"], "left_anti")
    return kept


# 64-bit shingles as text; components by repeated lookup of the least neighbour.
ORACLE = """
WITH RECURSIVE
d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
        ELSE array_to_string(w[p:p + 4], ' ') END AS shingle
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
hashed AS (SELECT doc_id, hash(shingle) AS h FROM s),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both
           FROM hashed x JOIN hashed y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM shared JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id
          WHERE 100 * n_both >= 85 * (p.n + q.n - n_both)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN least ON d.doc_id = a
"""
