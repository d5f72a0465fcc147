"""Best-fit packing of tokenised documents into sequences, with lower bounds that certify the number of sequences."""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from base64 import b64decode
from collections.abc import Iterator
from itertools import count
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored

#: Tokens of a sequence, and the id that ends a document.
CAPACITY, END = 1024, 2
#: Pieces that one task packs, about.
PART = 4_000
#: Runs of white space on which the faster form of the merges may end its stack.
LONG_RUN = re.compile(r"\s{10000}")


def vocabulary() -> str:
    """The tokenizer's file, where public_tokenizers is installed. Its merges stand beside it as a .tiktoken file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of a text as unsigned 32-bit numbers.

    They come from the tokenizer's merges in their other form, whose library takes a third of the time. It knows no special
    tokens, so a text that may hold one goes to the tokenizer itself; so does one with a long run of white space, and any that the
    library gives up on.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(f"{path.removesuffix('.json')}.tiktoken", "rb") as file:
            ranks = {b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.merges = tiktoken.Encoding(
            "merges", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if not (any(t in text for t in self.special) or LONG_RUN.search(text)):
            try:
                return array("I", self.merges.encode_ordinary(text)).tobytes()
            except BaseException as e:
                # Its panics are no Exceptions.
                if type(e).__name__ != "PanicException":
                    raise
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only a longer one is cut, and its first piece takes what is left over."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """A row per piece: row (a number of its own), doc_id, piece, start, length, ids_crc32, and ids (binary) if asked for."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: len(names)]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder(path), struct.pack("<I", END)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids, own_id = encoder(text.as_py() or "") + end, doc_id.as_py()
                for k, (s, n) in enumerate(cuts(len(ids) // 4)):
                    own = ids[4 * s : 4 * (s + n)]
                    out.append((own_id, k, s, n, zlib.crc32(own), own)[: len(names)])
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            yield pa.record_batch([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, schema)
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "*"), "pieces")


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece by best-fit decreasing. Open bins stand by the room they have left, and a
    number's bits tell which rooms there are."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = n = 0
    for i in np.argsort(-lengths, kind="stable"):
        w = int(lengths[i])
        fits = rooms >> w
        if fits:
            room = w + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b, n = capacity, n, n + 1
        bins[i], offsets[i] = b, capacity - room
        if room > w:
            by_room[room - w].append(b)
            rooms |= 1 << (room - w)
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """The most that dual feasible functions prove: sizes f(w) that fill no feasible bin beyond its capacity, so their
    sum over the capacity bounds the number of bins.

    Tried are: w itself; for each threshold t, sizes above capacity - t as full, sizes below t as nothing; and for each k, the
    rounding of (k + 1) w / capacity down to k-ths where it isn't whole.
    """
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    w = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((counts * w).sum()) // capacity)
    t = np.arange(1, capacity // 2 + 1)[:, None]
    sizes = np.where(w > capacity - t, capacity, np.where(w >= t, w, 0))
    best = max(best, int((-(-(sizes @ counts) // capacity)).max()))
    for k in range(1, 64):
        up = (k + 1) * w
        # In units of 1 / (k * capacity), whole sizes stay as they are.
        sizes = np.where(up % capacity == 0, w * k, up // capacity * capacity)
        best = max(best, -(-int((sizes * counts).sum()) // (k * capacity)))
    return best


def _pack(rows: DataFrame, turn: int) -> DataFrame:
    """rows dealt into parts by a hash that differs from turn to turn, each part packed. Adds sequence_id, offset, room (of
    the sequence) and gap (the part's sequences beyond its lower bound)."""
    parts = max(1, ceil(rows.count() / PART))
    part = F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(parts)).alias("part")

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        lengths = frame["length"].to_numpy(np.int64)
        bins, offsets = best_fit(lengths)
        used = np.bincount(bins, lengths).astype(np.int64)
        # Above all row numbers: 22 bits for the turn, 24 for the part, 16 for its sequences.
        ids = bins + (((1 << 22 | turn) << 24 | int(key[0])) << 16)
        return frame.drop(columns="part").assign(
            sequence_id=ids, offset=offsets, room=CAPACITY - used[bins], gap=len(used) - lower_bound(lengths))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    schema += ", sequence_id long, offset long, room long, gap long"
    packed = rows.select("*", part).groupBy("part").applyInPandas(pack, schema)
    return stored(packed, f"packed-{turn}")


def place(rows: DataFrame) -> DataFrame:
    """rows (row, length, more) with sequence_id and offset.

    Pieces are dealt into parts of bounded size, and each part is packed by best-fit decreasing. A dual-feasible lower bound
    certifies parts that use as few sequences as their pieces can. The others exchange: the pieces of their sequences
    that aren't full are dealt anew and packed again, as long as that saves sequences.
    """
    mine = [c for c in rows.columns]
    full = rows.where(F.col("length") == CAPACITY)
    done = [full.select(*mine, F.col("row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    now = _pack(rows.where(F.col("length") < CAPACITY), 0)
    chosen = [*mine, "sequence_id", "offset"]
    # Each round but the last saves a sequence, so it ends.
    for turn in count(1):
        loose = (F.col("gap") > 0) & (F.col("room") > 0)
        done.append(now.where(~loose).select(*chosen))
        now = now.where(loose)
        before = now.where("offset = 0").count()
        if not before:
            break
        again = _pack(now.select(*mine), turn)
        if again.where("offset = 0").count() >= before:
            break
        now = again
    done.append(now.select(*chosen))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def pack(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids if asked for.

    A document is the ids of its whole text and then id 2; null and empty texts are that id alone. Only documents longer than
    1024 are cut. Equal rows each are documents of their own; a row without a doc_id is packed as well; further
    columns don't matter; an empty table gives none. ``path`` is the vocabulary's file, the same on every executor.
    """
    made = pieces(docs, path or vocabulary(), with_ids)
    placed = place(made.drop("ids"))
    if with_ids:
        placed = placed.join(made.select("row", "ids"), "row")
    return placed.drop("row")
