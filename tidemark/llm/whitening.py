"""Whitening of embeddings: principal components by Chebyshev-filtered subspace iteration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from math import acosh, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored
from tidemark.llm.vectors import KINDS, MOST, doubles, integers, kind_of

#: Components that are asked for.
COMPONENTS = 4
#: Columns that are iterated at first, and rounds after which there are twice as many, up to all dimensions.
COLUMNS, ROUNDS = 32, 8
#: Most passes of a round's filter, and most that it may raise the first component above the last one asked for.
DEGREE, SPREAD = 20, 1e10
#: Steps that look for the spectrum's lower end.
LANCZOS = 10
#: A component is certified if V moves it by this share of the largest eigenvalue at most, times the root of the dimension;
#: or, where rounding doesn't let that be reached, by ``CLOSE`` and no less than half of what it was.
RESIDUAL, CLOSE = 4e-15, 1e-10
#: Eigenvalues below this share of the largest one are zero but for rounding.
NOTHING = 1e-11
#: Bytes of vectors, as 64-bit integers, that make one block.
BLOCK_BYTES = 8 << 20
#: Tasks that add up the sums of a pass.
ADDERS = 8


@dataclass(frozen=True)
class Whitening:
    """What makes vectors of one length white: (x - sums / n) @ projection, a column per component."""

    n: int
    sums: list[int]
    largest: int  # absolute component
    projection: np.ndarray
    explained: list[float]
    identity_error: float


def distinct_vectors(embeddings: DataFrame) -> DataFrame:
    """Every distinct vector once, in blocks: dim, kind, n, block (n * dim integers of that kind)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in integers(batch.column("embedding")):
                if x is not None:
                    k = kind_of(x)
                    out.append((len(x), k, x.astype(KINDS[k]).tobytes()))
            yield _batch(out, ["dim", "kind", "x"], [pa.int32(), pa.int32(), pa.binary()])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = ["dim", "kind", "n", "block"], [pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        waiting: dict[tuple[int, int], list[bytes]] = {}

        def made(of: tuple[int, int]) -> pa.RecordBatch:
            parts = waiting.pop(of)
            return _batch([(*of, len(parts), b"".join(parts))], names, types)

        for batch in batches:
            for dim, kind, x in zip(*(batch.column(c).to_pylist() for c in ("dim", "kind", "x")), strict=True):
                parts = waiting.setdefault((dim, kind), [])
                parts.append(x)
                if len(parts) * dim * 8 >= BLOCK_BYTES:
                    yield made((dim, kind))
        for of in sorted(waiting):
            yield made(of)

    packed = doubles(embeddings).select("embedding").mapInArrow(pack, "dim int, kind int, x binary")
    return packed.distinct().mapInArrow(join, "dim int, kind int, n long, block binary")


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for dim, kind, block in zip(*(batch.column(c).to_pylist() for c in ("dim", "kind", "block")), strict=True):
            yield np.frombuffer(block, KINDS[kind]).reshape(-1, dim).astype(np.int64)


def _exact_sums(blocks: DataFrame, dim: int) -> tuple[int, list[int], int]:
    """Number of vectors, exact sums of the dimensions, and the largest absolute component."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n, most = [0] * dim, 0, 0
        for x in _vectors(batches):
            largest = max(abs(int(x.min())), abs(int(x.max())))
            whole = x.sum(axis=0) if largest * len(x) <= MOST else x.astype(object).sum(axis=0)
            sums = [a + int(b) for a, b in zip(sums, whole, strict=True)]
            n, most = n + len(x), max(most, largest)
        if n:
            rows = [(i, n, Decimal(s), Decimal(most)) for i, s in enumerate(sums)]
            number = pa.decimal128(38, 0)
            yield _batch(rows, ["i", "n", "s", "most"], [pa.int32(), pa.int64(), number, number])

    per_task = blocks.mapInArrow(add, "i int, n long, s decimal(38,0), most decimal(38,0)")
    found = per_task.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.max("most").alias("most"))
    rows = found.orderBy("i").collect()  # one per dimension
    return rows[0]["n"], [int(r["s"]) for r in rows], max(int(r["most"]) for r in rows)


def _pass(blocks: DataFrame, mean: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pass over all vectors: X'X q and the squares' sums by dimension, X centred before it is multiplied. Each task
    sends one matrix in slices of rows, and the tasks' slices are added up side by side."""
    dim, width = q.shape
    cuts = [dim * i // min(ADDERS, dim) for i in range(min(ADDERS, dim) + 1)]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for whole in _vectors(batches):
            x = whole - mean
            part = np.concatenate([x.T @ (x @ q), (x * x).sum(axis=0)[:, None]], axis=1)
            out = part if out is None else out + part
        if out is not None:
            slices = [(i, out[a:b].tobytes()) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
            yield _batch(slices, ["i", "part"], [pa.int32(), pa.binary()])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column("i").to_pylist(), batch.column("part").to_pylist(), strict=True):
                sums[i] = np.frombuffer(part) + sums.get(i, 0)
        yield _batch([(i, x.tobytes()) for i, x in sums.items()], ["i", "part"], [pa.int32(), pa.binary()])

    slices = blocks.mapInArrow(multiply, "i int, part binary").repartition(len(cuts) - 1, "i")
    found = sorted(slices.mapInArrow(add, "i int, part binary").collect())
    whole = np.concatenate([np.frombuffer(r["part"]).reshape(-1, width + 1) for r in found])
    return whole[:, :width], whole[:, width]


def _lowest(multiply, dim: int, rng: np.random.Generator) -> float:
    """About where V's spectrum begins, from some steps of Lanczos; 0 or more. That only spares passes: what is returned is
    certified without it."""
    q = rng.standard_normal(dim)
    basis, along, across = [q / np.linalg.norm(q)], [], []
    for _ in range(min(LANCZOS, dim)):
        v = multiply(basis[-1][:, None])[:, 0]
        along.append(v @ basis[-1])
        for _ in range(2):
            v = v - np.array(basis).T @ (np.array(basis) @ v)
        across.append(np.linalg.norm(v))
        if across[-1] <= NOTHING * max(along):
            break
        basis.append(v / across[-1])
    theta, s = np.linalg.eigh(np.diag(along) + np.diag(across[:-1], 1) + np.diag(across[:-1], -1))
    return max(0.0, theta[0] - across[-1] * abs(s[-1, 0]))


def _filtered(multiply, q: np.ndarray, low: float, cut: float, top: float, degree: int) -> np.ndarray:
    """A Chebyshev polynomial of V times q: what belongs to eigenvalues between ``low`` and ``cut`` stays small, what lies
    above grows with the degree. Scaled so that ``top`` stays at about 1."""
    half, centre = (cut - low) / 2, (cut + low) / 2
    sigma = first = half / (top - centre)
    before, now = q, (multiply(q) - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (multiply(now) - centre * now) * (2 * following / half) - sigma * following * before
        sigma = following
    return now


def _degree(theta: np.ndarray, wanted: int, low: float) -> int:
    """Passes that damp the unwanted spectrum by 10^10 against the last component wanted, but raise the first above it
    by ``SPREAD`` at most."""
    half, centre = (theta[-1] - low) / 2, (theta[-1] + low) / 2
    growth = [acosh(max(1.0, (t - centre) / half)) for t in (theta[0], theta[wanted - 1])]
    most = log(SPREAD) / (growth[0] - growth[1]) if growth[0] > growth[1] else DEGREE
    return int(max(2, min(DEGREE, most, log(1e10) / growth[1] + 1 if growth[1] else DEGREE)))


def principal(multiply, dim: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and their unit eigenvectors, until they are certified: Chebyshev filter, QR, Rayleigh-Ritz, again.
    ``multiply(q)`` is V q. With as many columns as dimensions, Rayleigh-Ritz alone is exact."""
    rng = np.random.default_rng(11)
    wanted = min(wanted, dim)
    width = min(COLUMNS, dim)
    q = np.linalg.qr(rng.standard_normal((dim, width)))[0]
    last, turn, low = np.inf, 0, None
    while True:
        moved = multiply(q)
        theta, turned = np.linalg.eigh((q.T @ moved + moved.T @ q) / 2)
        theta, turned = theta[::-1], turned[:, ::-1]
        q, moved = q @ turned, moved @ turned
        largest = max(theta[0], np.finfo(float).tiny)
        error = np.linalg.norm(moved - q * theta, axis=0)[:wanted].max() / largest
        certified = error <= RESIDUAL * dim**0.5 or (error <= CLOSE and error > last / 2)
        if certified or width == dim or theta[0] <= 0:
            break
        last, turn = error, turn + 1
        if turn % ROUNDS == 0:
            more = min(dim, 2 * width) - width
            q, width = np.concatenate([q, rng.standard_normal((dim, more))], axis=1), width + more
            q, last = np.linalg.qr(q)[0], np.inf
            continue
        if theta[-1] <= NOTHING * largest:
            # There are more columns than V has dimensions: V q holds all of them.
            q = np.linalg.qr(moved)[0]
            continue
        low = _lowest(multiply, dim, rng) if low is None else low
        # The smallest Ritz value is below the spectrum's end only where that is found too high.
        low = min(low, 0.99 * theta[-1])
        q = np.linalg.qr(_filtered(multiply, q, low, theta[-1], largest, _degree(theta, wanted, low)))[0]
    # One of the two signs: the largest entry is positive.
    best = q[np.abs(q).argmax(axis=0), np.arange(q.shape[1])]
    q = q * np.where(best < 0, -1.0, 1.0)
    good = [j for j in range(wanted) if theta[j] > NOTHING * largest]
    return theta[good], q[:, good]


def fit(blocks: DataFrame, dim: int, wanted: int = COMPONENTS) -> Whitening:
    """The whitening of distinct vectors of one length."""
    blocks = blocks.where(F.col("dim") == dim)
    n, sums, largest = _exact_sums(blocks, dim)
    mean = np.array([s / n for s in sums])
    squares = np.zeros(dim)

    def multiply(q: np.ndarray) -> np.ndarray:
        nonlocal squares
        product, squares = _pass(blocks, mean, q)
        return product / n

    values, vectors = principal(multiply, dim, wanted)
    projection = vectors / np.sqrt(values)
    if not len(values):
        return Whitening(n, sums, largest, projection, [], 0.0)
    white = projection.T @ multiply(projection)
    error = float(np.abs(white - np.eye(len(values))).max())
    trace = float(squares.sum()) / n
    return Whitening(n, sums, largest, projection, [float(v / trace) for v in values], error)


def _deviation(x: np.ndarray, w: Whitening) -> int | None:
    """Sum of the squares of n * x - sums; None if it needs more than 64 bits."""
    bound = w.n * w.largest + max(map(abs, w.sums))
    if bound * bound * len(x) <= MOST:
        return int(((w.n * x - np.array(w.sums)) ** 2).sum())
    exact = sum((w.n * int(a) - s) ** 2 for a, s in zip(x, w.sums, strict=True))
    return exact if exact <= MOST else None


def whiten(embeddings: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: vec_id, component (from 1, by falling eigenvalue), n, deviation, whitened, explained,
    identity_error.

    Vectors that are null, empty, or hold a null or non-finite component give no row. A component c becomes floor(256 * c);
    beyond 64 bits, the nearest end. Means and covariances are those of the distinct vectors, n of them. Equal rows, and rows
    without a vec_id, each get their rows. Vectors of each length are whitened by themselves. Components without variance
    have no scale to whiten by and give no row: so neither does a table of one distinct vector, nor an empty one. A deviation
    beyond 64 bits is null. Further columns don't matter. Of eigenvalues that are equal, any basis is as good.

    Only sums by dimension and dimension x ``COLUMNS`` matrices reach the driver; each pass is a job over blocks of distinct vectors
    in the shared folder, adding X'(XQ) up by rows.
    """
    blocks = stored(distinct_vectors(embeddings), "distinct-vectors")
    dims = sorted(r[0] for r in blocks.select("dim").distinct().collect())
    fitted = {dim: fit(blocks, dim, wanted) for dim in dims}
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    means = {dim: np.array([s / w.n for s in w.sums]) for dim, w in fitted.items()}
    # Plain values: what executors get must not need this package there.
    known = {dim: (w.n, w.sums, w.largest, w.projection, w.explained, w.identity_error) for dim, w in fitted.items()}

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = {dim: Whitening(*w) for dim, w in known.items()}
        for batch in batches:
            out = []
            for vec_id, x in zip(batch.column("vec_id").to_pylist(), integers(batch.column("embedding")), strict=True):
                if x is None:
                    continue
                w = of[len(x)]
                white = (x - means[len(x)]) @ w.projection
                deviation = _deviation(x, w)
                out += [
                    (vec_id, j + 1, w.n, deviation, float(white[j]), w.explained[j], w.identity_error)
                    for j in range(len(white))
                ]
            yield _batch(out, names, types)

    return doubles(embeddings).mapInArrow(
        project, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
