"""Quality of documents by voting of the nearest labelled ones in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled documents that are learnt from at most: the first by a hash of their id.
LABELLED = 4096
#: Hashed terms, latent dimensions, and neighbours that vote.
TERMS, LATENT, NEIGHBOURS = 2048, 48, 16
#: Times that a similarity is squared to weigh: it counts by its eighth power.
SHARPNESS = 3
#: Decimals of similarities and scores.
DIGITS = 9
#: Least score that predicts label 1.
KEEP = 0.7
#: Documents multiplied with all labelled vectors at a time.
BLOCK = 1024


def term_counts(text: str | None) -> np.ndarray:
    """Counts of a text's hashed terms: trigrams of its bytes, and by themselves words equal to the one before, words of capitals
    only and words without letters or digits."""
    out = np.zeros(TERMS, np.float32)
    if not text:
        return out
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    for at in range(0, len(data), 1 << 20):
        b = data[at : at + (1 << 20) + 2].astype(np.uint32)
        if len(b) > 2:
            h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            out += np.bincount((h >> np.uint32(16)) % np.uint32(TERMS - 3), minlength=TERMS)
    w = text.split()
    out[TERMS - 3] = sum(map(eq, w, w[1:]))
    out[TERMS - 2] = sum(map(str.isupper, w))
    out[TERMS - 1] = len(w) - sum(map(str.isalnum, (x[0] for x in w)))
    return out


def _counts(texts: Sequence[str | None]) -> np.ndarray:
    return np.log1p(np.stack([term_counts(t) for t in texts])) if len(texts) else np.zeros((0, TERMS), np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    """Weights of terms, the projection to the latent space, the labelled vectors there and their labels."""

    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_unit(counts.astype(np.float64) * self.weights) @ self.projection)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, each weighted by its similarity. A text without any
        term gets the share among all."""
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        base = float(self.labels.mean())
        n = min(NEIGHBOURS, len(self.labels))
        # Rounded, so that how documents are dealt into blocks doesn't show.
        similar = np.maximum(np.round(self.latent(counts) @ self.vectors.T, DIGITS), 0)
        last = np.partition(similar, len(self.labels) - n, axis=1)[:, len(self.labels) - n, None]
        nearer, level = similar > last, similar == last
        # Neighbours that are as near as the last one share the places that are left.
        share = (n - nearer.sum(axis=1)) / level.sum(axis=1)
        for _ in range(SHARPNESS):
            similar = np.square(similar)
        weight = (nearer + level * share[:, None]) * similar
        total = weight.sum(axis=1)
        votes = np.round(weight @ self.labels / np.where(total > 0, total, 1), DIGITS)
        out = np.where(total > 0, votes, base)
        return np.clip(np.where(counts.any(axis=1), out, base), 0, 1)


def fit(counts: np.ndarray, labels: np.ndarray) -> Model:
    """Latent-semantic analysis: inverse document frequencies, then a truncated SVD by subspace iteration."""
    n = len(labels)
    if n == 0:
        return Model(np.ones(TERMS), np.zeros((TERMS, 1)), np.zeros((0, 1)), labels)
    weights = np.log((1 + n) / (1 + (counts > 0).sum(axis=0))) + 0.1
    x = _unit(counts.astype(np.float64) * weights)
    k = min(LATENT, n, TERMS)
    q = np.linalg.qr(np.random.default_rng(5).standard_normal((TERMS, k)))[0]
    for _ in range(8):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    model = Model(weights, q, np.zeros((0, k)), labels.astype(np.float64))
    model.vectors = model.latent(counts)
    return model


def held_out() -> Column:
    """Rows that nothing is learnt from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from labelled documents that aren't held out, ``LABELLED`` at most. Labels that are null, and ids without a
    document, teach nothing. Of an id's labels the least counts, and of its documents the one whose text is the least."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = _counts(batch["text"]).astype(np.float16)
                yield pd.DataFrame({"doc_id": batch["doc_id"], "quality": batch["quality"], "x": [r.tobytes() for r in x]})

    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    rows = rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text")).select("doc_id", "text", "quality")
    found = rows.mapInPandas(features, "doc_id long, quality int, x binary").toPandas().sort_values(["doc_id", "x"])
    x = np.stack([np.frombuffer(b, np.float16) for b in found["x"]]) if len(found) else np.zeros((0, TERMS))
    return fit(x.astype(np.float32), (found["quality"].to_numpy() == 1).astype(np.float64))


def score_name(columns: list[str]) -> str:
    """A name for the score that no column has."""
    name = "_score"
    while name in columns:
        name += "_"
    return name


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of docs, and the score: likelihood of label 1 by the whole text and nothing else."""
    # Plain arrays: executors need not have this package.
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.projection, model.vectors, model.labels))
    text = "text" if "text" in keep else "_text"
    name = score_name(keep)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.slice(at, BLOCK)
                scores = m.score(_counts(part.column(text).to_pylist()))
                columns = {c: part.column(c) for c in keep}
                yield pa.record_batch(columns | {name: pa.array(scores, pa.float64())})

    rows = docs.select(*keep) if text in keep else docs.select(*keep, F.col("text").alias(text))
    return rows.mapInArrow(vote, T.StructType([*docs.select(*keep).schema, T.StructField(name, T.DoubleType())]))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per document: doc_id, held_out, score, predicted.

    Null and empty texts get the share of label 1 in the sample; without any labelled document all scores are 0.5. Equal rows
    each get a row, further columns don't matter, an empty table gives none. A row without a doc_id isn't held out.

    The vectors of at most ``LABELLED`` documents are broadcast: about 2 MB, whatever the corpus. All documents are scored
    against all of them by blocked products.
    """
    scored = score(docs, train(docs, labels), ["doc_id"]).withColumnRenamed("_score", "score")
    return scored.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= KEEP).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with a score of at least ``KEEP``, with all columns."""
    name = score_name(docs.columns)
    return score(docs, train(docs, labels), docs.columns).where(F.col(name) >= KEEP).drop(name)
