"""Exact top-k search by inner product: ball trees per shard, branch and bound."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import stored
from tidemark.llm.vectors import EXACT, KINDS, LEAST, MOST, SCALE, doubles, integers, kind_of

#: Hits of a query, and what divides the ids of queries.
HITS, EVERY = 5, 50
#: Vectors of a shard, at most about, and bytes of them as 64-bit integers; vectors of a leaf at most.
SHARD, SHARD_BYTES, LEAF = 8_192, 16 << 20, 128
#: Bytes of the queries that are sent to all executors at a time, and queries that are searched for side by side.
QUERY_BYTES, SIDE_BY_SIDE = 16 << 20, 1_024
#: What rounding may take off a bound, as a share of it.
SLACK = 1e-9

_TREE = "dim int, shard int, kind int, vectors binary, ids binary, rows binary, nodes binary, centres binary"
_HIT = "query int, query_id long, score long, vec_id long, row long"


def _cleaned(embeddings: DataFrame) -> DataFrame:
    """Vectors that take part: row (a number of its own), vec_id, dim, kind, x."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for vec_id, x in zip(batch.column("vec_id").to_pylist(), integers(batch.column("embedding")), strict=True):
                if x is not None and vec_id is not None:
                    k = kind_of(x)
                    out.append((vec_id, len(x), k, x.astype(KINDS[k]).tobytes()))
            columns = zip(*out, strict=True) if out else [[]] * 4
            types = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["vec_id", "dim", "kind", "x"])

    rows = doubles(embeddings).mapInArrow(pack, "vec_id long, dim int, kind int, x binary")
    return rows.select(F.monotonically_increasing_id().alias("row"), "*")


def _matrix(kinds, vectors, dim: int) -> np.ndarray:
    return np.stack([np.frombuffer(x, KINDS[k]) for k, x in zip(kinds, vectors, strict=True)]).astype(
        np.int64).reshape(-1, dim)


# ---- ball trees


def ball_tree(x: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the vectors, nodes and centres. Nodes are rows (start, end, left child or -1, least id, radius); the right child
    stands behind the left one, and a node holds the vectors from its start to its end.

    A node is cut at the median along the line between two vectors far from each other; one of equal vectors, by id."""
    points = x.astype(np.float64)
    order = np.arange(len(x))
    nodes, centres = [[0, len(x), -1, 0, 0.0]], [None]
    at = 0
    while at < len(nodes):
        start, end = nodes[at][:2]
        here = order[start:end]
        own = points[here]
        centre = own.mean(axis=0)
        far = np.sqrt(((own - centre) ** 2).sum(axis=1))
        nodes[at][3:] = [int(ids[here].min()), float(far.max())]
        centres[at] = centre
        if end - start > LEAF:
            a = own[far.argmax()]
            away = ((own - a) ** 2).sum(axis=1)
            along = (own - a) @ (own[away.argmax()] - a)
            turned = np.lexsort((ids[here], along if away.any() else np.zeros(len(own))))
            order[start:end] = here[turned]
            middle = (start + end) // 2
            nodes[at][2] = len(nodes)
            nodes += [[start, middle, -1, 0, 0.0], [middle, end, -1, 0, 0.0]]
            centres += [None, None]
        at += 1
    kind = np.dtype([("start", "<i8"), ("end", "<i8"), ("left", "<i8"), ("least", "<i8"), ("radius", "<f8")])
    return order, np.array([tuple(n) for n in nodes], kind), np.stack(centres)


def _planted(frame: pd.DataFrame) -> pd.DataFrame:
    """A shard's tree, as one row."""
    dim = int(frame["dim"].iloc[0])
    x, ids, rows = _matrix(frame["kind"], frame["x"], dim), frame["vec_id"].to_numpy(), frame["row"].to_numpy()
    order, nodes, centres = ball_tree(x, ids)
    kind = kind_of(x)
    return pd.DataFrame({
        "dim": [dim], "shard": [int(frame["shard"].iloc[0])], "kind": [kind],
        "vectors": [x[order].astype(KINDS[kind]).tobytes()], "ids": [ids[order].tobytes()], "rows": [rows[order].tobytes()],
        "nodes": [nodes.tobytes()], "centres": [centres.tobytes()]})


def trees(vectors: DataFrame) -> DataFrame:
    """Ball trees over shards of bounded size; a vector's shard is drawn by its row, so copies spread as well."""
    sizes = {r["dim"]: r["n"] for r in vectors.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    shards = {dim: ceil(n / min(SHARD, max(LEAF, SHARD_BYTES // (8 * dim)))) for dim, n in sizes.items()}
    if not shards:
        return vectors.sparkSession.createDataFrame([], _TREE)
    many = F.create_map(*(F.lit(x) for item in sorted(shards.items()) for x in item))
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("row"), many[F.col("dim")]).cast("int"))
    return dealt.repartition(sum(shards.values()), "dim", "shard").groupBy("dim", "shard").applyInPandas(_planted, _TREE)


# ---- search


class _Tops:
    """The best hits of some queries so far: scores, ids, rows, best first; and each query's kth hit, or the shared one."""

    def __init__(self, shared: np.ndarray, k: int):
        """``shared``: score and id per query of a hit that k hits are no worse than."""
        self.k, self.n = k, len(shared)
        self.query = np.zeros(0, np.int64)
        self.score, self.id, self.row = (np.zeros(0, np.int64) for _ in range(3))
        self.least, self.last = shared[:, 0].copy(), shared[:, 1].copy()

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        q, s = np.concatenate([self.query, query]), np.concatenate([self.score, score])
        i, r = np.concatenate([self.id, ids]), np.concatenate([self.row, rows])
        # ~s falls as s rises, without overflow.
        order = np.lexsort((r, i, ~s, q))
        q, s, i, r = q[order], s[order], i[order], r[order]
        first = np.concatenate([[True], q[1:] != q[:-1]]) if len(q) else np.zeros(0, bool)
        nth = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
        keep = nth < self.k
        self.query, self.score, self.id, self.row = q[keep], s[keep], i[keep], r[keep]
        kth = nth[keep] == self.k - 1
        at, s, i = self.query[kth], self.score[kth], self.id[kth]
        better = (s > self.least[at]) | ((s == self.least[at]) & (i < self.last[at]))
        self.least[at[better]], self.last[at[better]] = s[better], i[better]


def _products(queries: np.ndarray, x: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of integers. Doubles are exact where no sum leaves 53 bits; else Python's integers are taken, and
    what leaves 64 bits counts as their nearest end."""
    if exact:
        return (queries.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    whole = queries.astype(object) @ x.T.astype(object)
    return np.vectorize(lambda v: max(LEAST, min(MOST, v)), otypes=[np.int64])(whole)


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))


def descend(tree: dict, queries: np.ndarray, own: np.ndarray, tops: _Tops, first_leaf: bool) -> None:
    """Branch and bound of all queries at a time. Each holds a list of open nodes and takes the one with the highest upper
    bound, query * centre + |query| * radius: children of an inner node are opened, a leaf is multiplied out. Nodes that can't
    hold a hit as good as the kth are dropped; at equal bounds those with greater ids only. With ``first_leaf`` each query ends
    with the first leaf it reaches."""
    x, ids, rows, nodes, centres = (tree[c] for c in ("x", "ids", "rows", "nodes", "centres"))
    exact = len(x.T) * _largest(x) * _largest(queries) < EXACT
    q = queries.astype(np.float64)
    length = np.sqrt((q * q).sum(axis=1))
    reach = np.sqrt((centres * centres).sum(axis=1)) + nodes["radius"]
    bound = q @ centres.T + np.outer(length, nodes["radius"]) + SLACK * np.outer(length, reach) + SLACK
    # Scores end at 64 bits, so bounds do.
    bound = np.clip(bound, float(LEAST), float(MOST))
    every = np.arange(len(q))
    open_ = np.full(bound.shape, -np.inf)
    open_[:, 0] = bound[:, 0]
    while len(every):
        best = open_[every].argmax(axis=1)
        value = open_[every, best]
        open_[every, best] = -np.inf
        goes_on = (value > -np.inf) & (value >= tops.least[every])
        every, best, value = every[goes_on], best[goes_on], value[goes_on]
        holds = (np.floor(value) > tops.least[every]) | (nodes["least"][best] <= tops.last[every])
        inner = holds & (nodes["left"][best] >= 0)
        for side in (0, 1):
            child = nodes["left"][best[inner]] + side
            open_[every[inner], child] = np.minimum(bound[every[inner], child], value[inner])
        leaf = holds & ~inner
        found = []
        by_leaf = np.flatnonzero(leaf)[np.argsort(best[leaf], kind="stable")]
        for group in np.split(by_leaf, np.flatnonzero(np.diff(best[by_leaf])) + 1) if len(by_leaf) else ():
            asked, node = every[group], nodes[best[group[0]]]
            held = slice(node["start"], node["end"])
            score = _products(queries[asked], x[held], exact)
            least, last = tops.least[asked][:, None], tops.last[asked][:, None]
            good = (score > least) | ((score == least) & (ids[held] <= last))
            good &= rows[held] != own[asked][:, None]
            a, b = np.nonzero(good)
            found.append((asked[a], score[a, b], ids[held][b], rows[held][b]))
        if found:
            tops.add(*(np.concatenate(c) for c in zip(*found, strict=True)))
        if first_leaf:
            every = every[~leaf]


def _hits(planted: DataFrame, dim: int, asked: dict, shared: np.ndarray, k: int, first_leaf: bool) -> DataFrame:
    """Each task's best k hits of every query over its shards. The kth score goes on from shard to shard."""
    queries, own, query_ids = asked["x"], asked["rows"], asked["ids"]
    sent = planted.sparkSession.sparkContext.broadcast((queries, own, query_ids, shared))
    node = [("start", "<i8"), ("end", "<i8"), ("left", "<i8"), ("least", "<i8"), ("radius", "<f8")]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, own, query_ids, shared = sent.value
        parts = [slice(i, i + SIDE_BY_SIDE) for i in range(0, len(x), SIDE_BY_SIDE)]
        tops = [_Tops(shared[p], k) for p in parts]
        for batch in batches:
            for row in batch.to_pylist():
                tree = {
                    "x": np.frombuffer(row["vectors"], KINDS[row["kind"]]).reshape(-1, dim).astype(np.int64),
                    "ids": np.frombuffer(row["ids"], np.int64), "rows": np.frombuffer(row["rows"], np.int64),
                    "nodes": np.frombuffer(row["nodes"], np.dtype(node)),
                    "centres": np.frombuffer(row["centres"]).reshape(-1, dim)}
                for p, best in zip(parts, tops, strict=True):
                    descend(tree, x[p], own[p], best, first_leaf)
        for p, best in zip(parts, tops, strict=True):
            at = best.query + p.start
            yield pa.record_batch(
                [pa.array(at, pa.int32()), pa.array(query_ids[at]), pa.array(best.score), pa.array(best.id), pa.array(best.row)],
                ["query", "query_id", "score", "vec_id", "row"])

    of_dim = planted.where(F.col("dim") == dim)
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    found = of_dim.mapInArrow(search, _HIT).withColumn("rank", F.row_number().over(ranked))
    return found.where(F.col("rank") <= k)


def _rounds(vectors: DataFrame, queries: DataFrame) -> Iterator[tuple[int, dict]]:
    """The queries in blocks of bounded size, each of one vector length."""
    sizes = queries.groupBy("dim").agg(F.count("*").alias("n")).orderBy("dim").collect()
    for dim, n in sizes:
        turns = ceil(n * (8 * dim + 32) / QUERY_BYTES)
        block = F.pmod(F.xxhash64("row", F.lit("round")), F.lit(turns))
        for turn in range(turns):
            rows = queries.where((F.col("dim") == dim) & (block == turn)).toPandas()
            if len(rows):
                yield dim, {
                    "x": _matrix(rows["kind"], rows["x"], dim), "rows": rows["row"].to_numpy(np.int64),
                    "ids": rows["vec_id"].to_numpy(np.int64)}


def search(embeddings: DataFrame, every: int = EVERY, k: int = HITS) -> DataFrame:
    """The ``k`` highest inner products of each query with all other rows: query_id, rank, vec_id, score. Queries are the rows
    whose vec_id is divisible by ``every``; ties go to the smaller vec_id.

    A component c becomes floor(256 * c); beyond 64 bits, the nearest end, and so do scores. Vectors that are null, empty, or
    hold null or non-finite components, and rows without a vec_id, take no part. Vectors of different lengths don't meet. A row
    is left out of its own hits only: rows that share a vec_id, or are equal, find each other. With fewer than k other rows there are
    fewer hits; an empty table gives none. Further columns don't matter.

    Every row stands in a ball tree over a shard of bounded size. Queries go out in blocks of ``QUERY_BYTES``. First
    each shard is searched down to one leaf per query; the best kth score over all shards is then shared, and all
    shards are searched with it, each to its end.
    """
    spark = embeddings.sparkSession
    vectors = stored(_cleaned(embeddings), "vectors")
    queries = vectors.where(F.col("vec_id") % every == 0)
    planted = stored(trees(vectors), "ball-trees")
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for dim, asked in _rounds(vectors, queries):
        nothing = np.tile(np.array([LEAST, MOST]), (len(asked["rows"]), 1))
        first = _hits(planted, dim, asked, nothing, k, True).where(F.col("rank") == k)
        shared = nothing.copy()
        for r in first.select("query", "score", "vec_id").collect():  # one per query of the block
            shared[r["query"]] = r["score"], r["vec_id"]
        found = stored(_hits(planted, dim, asked, shared, k, False), "hits")
        out = out.unionByName(found.select("query_id", "rank", "vec_id", "score"))
    return out


#: Products and sums of these integers are exact as doubles.
ORACLE = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.x, v.x) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.x) = len(v.x) WHERE q.vec_id % {EVERY} = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= {HITS}
"""
