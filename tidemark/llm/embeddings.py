"""Near-duplicate embeddings by an inverted multi-index."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.tables import stored

#: Least cosine of linked vectors.
COSINE = 0.9
#: Vectors that codebooks are fitted on at most, the first by a hash of the vector.
SAMPLE = 20_000
#: Vectors of the sample that are compared with all rows first to set how many cells are visited; each further draw is twice
#: as large, until probed vectors of ENOUGH cells have links or the sample is at its end.
PROBED, ENOUGH = 512, 32
#: Vectors per cell of the product grid, about; most codewords of a half.
PER_CELL, MOST_CODES = 64, 256
#: Share of a vector's links whose cell the traversal has to visit, on the mean over vectors, of all links and of those of each
#: band of cosines.
RECALL, BANDS = 0.999, (0.9, 0.92, 0.95, 0.98)
#: Made neighbours of a vector, at the least cosine, where the whole sample has no links to measure by.
MADE = 8
#: Sides of a block that one task multiplies.
RESIDENTS, PROBES = 1024, 4096


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows by their lengths, which neither overflow nor vanish, as the largest component is taken out first."""
    x = x.astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _codebook(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Lloyd's k-means; a centre that loses all its vectors stays where it was."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(8):
        near = _distances(x, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))[:, None]
        centres = np.where(n > 0, sums / np.maximum(n, 1), centres)
    return centres


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)


class Grid:
    """Two codebooks, one for each half of the vectors. A cell is a pair of codewords."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.books = [first, second]
        self.half, self.k = first.shape[1], len(second)

    def visits(self, x: np.ndarray, n: int) -> np.ndarray:
        """The nearest ``n`` cells of each vector, nearest first.

        The multi-sequence traversal, for many vectors at once: with both lists of codewords sorted by distance, the cell of
        the i-th and the j-th can only be among the first n if (i + 1) (j + 1) <= n.
        """
        d = [_distances(x[:, : self.half], self.books[0]), _distances(x[:, self.half :], self.books[1])]
        order = [a.argsort(axis=1, kind="stable") for a in d]
        near = [np.take_along_axis(a, o, axis=1) for a, o in zip(d, order, strict=True)]
        i, j = np.divmod(np.arange(near[0].shape[1] * self.k), self.k)
        reachable = (i + 1) * (j + 1) <= n
        i, j = i[reachable], j[reachable]
        first = (near[0][:, i] + near[1][:, j]).argsort(axis=1, kind="stable")[:, :n]
        return np.take_along_axis(order[0], i[first], axis=1) * self.k + np.take_along_axis(order[1], j[first], axis=1)


    def ranks(self, x: np.ndarray, rows: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How many cells the traversal of each of these rows of x takes before one: those that are nearer."""
        out = np.empty(len(rows), np.int64)
        at = -1
        for n, (i, cell) in enumerate(zip(rows, cells, strict=True)):
            if i != at:
                one, at = x[i : i + 1], i
                a = _distances(one[:, : self.half], self.books[0])[0]
                b = _distances(one[:, self.half :], self.books[1])[0]
                every = a[:, None] + b[None]
            # Cells as near as it count as well: the order among those is the traversal's own.
            out[n] = np.count_nonzero(every <= every[divmod(int(cell), self.k)] + 1e-12) - 1
        return out


def _codebooks(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    half = x.shape[1] // 2
    return _codebook(x[:, :half], k, 1) if half else np.zeros((1, 0)), _codebook(x[:, half:], k, 2)


def _cleaned(embeddings: DataFrame) -> DataFrame:
    """vec_id, c1, c2 (a digest of the direction; null where there is none), vector (doubles)."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            values = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
            ends, valid = vectors.offsets.to_numpy(), vectors.is_valid().to_numpy(zero_copy_only=False)
            digests, raws = [], []
            for i in range(len(vectors)):
                x = values[ends[i] : ends[i + 1]]
                usable = valid[i] and len(x) and np.isfinite(x).all() and x.any()
                raw = (x + 0.0).tobytes() if usable else None
                raws.append(raw)
                digest = blake2b(raw, digest_size=16).digest() if usable else None
                digests.append([int(d) for d in np.frombuffer(digest, np.int64)] if usable else [None, None])
            yield pa.record_batch({
                "vec_id": batch.column("vec_id"), "c1": pa.array([d[0] for d in digests], pa.int64()),
                "c2": pa.array([d[1] for d in digests], pa.int64()), "vector": pa.array(raws, pa.binary()),
            })

    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(
        clean, "vec_id long, c1 long, c2 long, vector binary")


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)


def _links(classes: DataFrame, grid, probes: np.ndarray) -> pd.DataFrame:
    """The probed vectors' links with all rows: probe, band, visits (how many cells the traversal takes to reach the
    linked one), links."""
    shared = classes.sparkSession.sparkContext.broadcast(probes)

    def ranks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g, q = Grid(*grid.value), shared.value
        for batch in batches:
            x = _unit(_matrix(batch["vector"]))
            own, found = None, []
            for at in range(0, len(q), PROBED):
                cosine = q[at : at + PROBED] @ x.T
                probe, to = np.nonzero((cosine >= COSINE) & (cosine < 1 - 1e-12))
                if not len(probe):
                    continue
                own = g.visits(x, 1)[:, 0] if own is None else own
                band = np.searchsorted(BANDS, cosine[probe, to], side="right")
                one, links = np.unique(np.stack([probe + at, band, own[to]]), axis=1, return_counts=True)
                found.append(pd.DataFrame({
                    "probe": one[0], "band": one[1], "visits": g.ranks(q, one[0], one[2]) + 1, "links": links}))
            if found:
                yield pd.concat(found)

    schema = "probe long, band long, visits long, links long"
    return classes.select("vector").mapInPandas(ranks, schema).groupBy("probe", "band", "visits").agg(
        F.sum("links").alias("links")).toPandas()


def _visits_for(found: pd.DataFrame) -> int:
    """The cells to visit so that vectors reach ``RECALL`` of their links on the mean. Every vector counts alike, however
    many links it has."""
    found = found.groupby(["probe", "visits"], as_index=False)["links"].sum()
    share = found["links"] / found.groupby("probe")["links"].transform("sum") / found["probe"].nunique()
    reached = share.groupby(found["visits"]).sum().sort_index().cumsum()
    return int(reached.index[(reached >= RECALL - 1e-9).to_numpy().argmax()])


def _cells_to_visit(classes: DataFrame, grid, sample: np.ndarray) -> int:
    """How many cells the traversal visits: so many that ``RECALL`` of the true links of probed vectors, found by comparing
    them with all rows in blocks, lie in visited cells. Vectors of the sample are drawn until those of enough cells
    have links; if none has any, neighbours made at the least cosine are measured by."""
    found, at, size = [], 0, PROBED
    own = Grid(*grid.value)
    while at < len(sample):
        part = _links(classes, grid, sample[at : at + size])
        found.append(part.assign(probe=part["probe"] + at))
        linked = pd.concat(found)["probe"].unique().astype(np.int64)
        if len(linked) and len(np.unique(own.visits(sample[linked], 1))) >= ENOUGH:
            break
        at, size = at + size, 2 * size
    measured = pd.concat(found)
    if len(measured):
        return max([_visits_for(measured), *(_visits_for(x) for _, x in measured.groupby("band"))])
    q = sample[:PROBED].repeat(MADE, axis=0)
    away = np.random.default_rng(3).standard_normal(q.shape)
    away -= (away * q).sum(1)[:, None] * q
    length = np.linalg.norm(away, axis=1, keepdims=True)
    made = COSINE * q + sqrt(1 - COSINE**2) * away / np.where(length > 0, length, 1)
    rank = own.ranks(q, np.arange(len(q)), own.visits(made, 1)[:, 0])
    return int(np.sort(rank)[ceil(RECALL * len(rank)) - 1]) + 1


def _compare(unit: pd.DataFrame) -> pd.DataFrame:
    """Of one block, what each vector gains in links, and the least rep of its connected part.

    A pair that both visit each other's cell is met in two units, so each side is counted where it
    probes; else the one that probes counts for both.
    """
    p, r = unit[unit["probe"]].reset_index(drop=True), unit[~unit["probe"]].reset_index(drop=True)
    empty = pd.DataFrame({k: pd.Series(dtype="int64") for k in ("c1", "c2", "rep", "links", "part")})
    if not len(p) or not len(r):
        return empty
    linked = _unit(_matrix(p["vector"])) @ _unit(_matrix(r["vector"])).T >= COSINE
    linked &= ~(
        (p["c1"].to_numpy()[:, None] == r["c1"].to_numpy()) & (p["c2"].to_numpy()[:, None] == r["c2"].to_numpy()))
    if not linked.any():
        return empty
    cells, where = np.unique(p["cell"].to_numpy(), return_inverse=True)
    visited = np.stack([np.isin(cells, v) for v in r["visits"]])
    mutual = visited[:, where].T
    gain_p = linked @ r["copies"].to_numpy(np.int64)
    gain_r = (linked & ~mutual).T @ p["copies"].to_numpy(np.int64)
    part_p, part_r = p["rep"].to_numpy(np.int64), r["rep"].to_numpy(np.int64)
    far = np.int64(np.iinfo(np.int64).max)
    while True:
        new_p = np.minimum(part_p, np.where(linked, part_r, far).min(axis=1))
        new_r = np.minimum(part_r, np.where(linked, new_p[:, None], far).min(axis=0))
        if (new_p == part_p).all() and (new_r == part_r).all():
            break
        part_p, part_r = new_p, new_r
    p, r = p.assign(links=gain_p, part=part_p)[linked.any(axis=1)], r.assign(links=gain_r, part=part_r)[linked.any(axis=0)]
    return pd.concat([p, r])[["c1", "c2", "rep", "links", "part"]].astype("int64")


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """A row per vector: vec_id, n_links (other vectors at cosine 0.9 or more), component_id, kept.

    Vectors that are null, empty, zero, or hold a null or non-finite component link with nothing, nor does one without a
    vec_id; they are kept (component: their own id). Equal rows each get a row and link with each other; rows that share a
    vec_id are one node. Vectors of different lengths are never linked. Further columns, labels too, don't matter;
    an empty table gives none.

    Equal vectors are one class. Codebooks of both halves are fitted on a bounded sample; their pairs are the cells of
    a product grid, and every class stands in one. Each class visits its nearest cells in the order of
    a multi-sequence traversal, so many that the target recall is reached, and all pairs met there are verified in
    double precision, in blocks: matrix products within tasks, never a list of pairs. Cells that hold many vectors, or
    that many visit, are split into several blocks.
    """
    cleaned = stored(_cleaned(embeddings), "vectors")
    usable = cleaned.where("c1 IS NOT NULL AND vec_id IS NOT NULL")
    classes = usable.groupBy("c1", "c2").agg(
        F.count("*").alias("copies"), F.min_by("vector", "vec_id").alias("vector"), F.min("vec_id").alias("rep"))
    classes = stored(classes, "classes")
    sizes = [r[0] for r in classes.select(F.length("vector")).distinct().collect()]
    found = [_of_length(classes.where(F.length("vector") == n)) for n in sizes]
    schema = "c1 long, c2 long, rep long, links long, part long"
    met = embeddings.sparkSession.createDataFrame([], schema)
    for f in found:
        met = met.unionByName(f)
    links = met.groupBy("c1", "c2").agg(F.sum("links").alias("links"))
    reached = components(met.select("rep", "part"))
    by_class = classes.select("c1", "c2", "copies", "rep").join(links, ["c1", "c2"], "left")
    by_class = by_class.join(reached, by_class["rep"] == reached["id"], "left").select(
        "c1", "c2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component"))
    rows = cleaned.select("vec_id", *[F.when(F.col("vec_id").isNotNull(), F.col(c)).alias(c) for c in ("c1", "c2")])
    out = rows.join(by_class, ["c1", "c2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _of_length(classes: DataFrame) -> DataFrame:
    """The blocks' findings for classes whose vectors have one length."""
    spark = classes.sparkSession
    n = classes.count()
    sample = classes.orderBy(F.xxhash64("c1", "c2"), "c1", "c2").limit(SAMPLE).select("vector").toPandas()
    x = _unit(_matrix(sample["vector"]))
    # Plain arrays: executors need not have this package.
    grid = spark.sparkContext.broadcast(_codebooks(x, max(1, min(MOST_CODES, ceil(sqrt(n / PER_CELL))))))
    visits = _cells_to_visit(classes, grid, x)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = Grid(*grid.value)
        for batch in batches:
            near = cells.visits(_unit(_matrix(batch["vector"])), visits)
            yield batch.assign(cell=near[:, 0], visits=list(near.astype(np.int64)))

    placed = stored(classes.mapInPandas(assign, classes.schema.simpleString()[7:-1] + ",cell:bigint,visits:array<bigint>"),
                    "placed")
    # At most MOST_CODES^2 cells: small enough to send everywhere.
    residents = placed.groupBy("cell").agg(F.ceil(F.count("*") / RESIDENTS).cast("long").alias("r_blocks"))
    probes = placed.select(F.explode("visits").alias("to")).groupBy("to").agg(
        F.ceil(F.count("*") / PROBES).cast("long").alias("p_blocks"))
    cells = stored(residents.join(probes, F.col("cell") == F.col("to")).select("to", "r_blocks", "p_blocks"), "cells")
    block = lambda k: F.pmod(F.xxhash64("c1", "c2"), F.col(k))
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.col(k) - 1))
    columns = ["to", "r", "p", "probe", "c1", "c2", "copies", "rep", "vector", "cell", "visits"]
    standing = placed.withColumn("to", F.col("cell")).join(F.broadcast(cells), "to")
    standing = standing.withColumns({"r": block("r_blocks"), "probe": F.lit(False)}).withColumn("p", every("p_blocks"))
    probing = placed.withColumn("to", F.explode("visits")).join(F.broadcast(cells), "to")
    probing = probing.withColumns({
        "p": block("p_blocks"), "probe": F.lit(True), "visits": F.array().cast("array<bigint>"),
    }).withColumn("r", every("r_blocks"))
    units = standing.select(columns).unionByName(probing.select(columns))
    found = units.groupBy("to", "r", "p").applyInPandas(_compare, "c1 long, c2 long, rep long, links long, part long")
    return stored(found, "met")
