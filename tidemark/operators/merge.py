"""The guarded upsert: an event is applied only if it is newer than what the target holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.columns import POSITION, cols, position, quoted, same_keys


# Keys of a batch are broadcast up to this size.
BROADCAST_BYTES = 64 << 20


def drop_stale(staged: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows without those whose key is stored at the same or a newer position.

    ``staged`` has one row per key; ``stored`` may hold several versions of a key, and only its keys
    and positions are read.
    """
    stored = stored.select(*cols(keys), *POSITION)
    newer = same_keys("s", "t", keys) & (position("t") >= position("s"))
    return staged.alias("s").join(stored.alias("t"), newer, "left_anti")


def stored_for(
    events: DataFrame, stored: DataFrame, keys: Sequence[str], key_bytes: int
) -> DataFrame:
    """Keys and positions of ``stored`` that ``events`` can meet. If the keys of ``events`` are known
    to take few bytes, they are broadcast to cut ``stored`` down before anything is shuffled."""
    stored = stored.select(*cols(keys), *POSITION)
    if key_bytes > BROADCAST_BYTES:
        return stored
    return stored.join(F.broadcast(events.select(*cols(keys))), list(keys), "left_semi")


def key_bytes(df: DataFrame, keys: Sequence[str]) -> Column:
    """Bytes the key of a row takes."""
    size = F.lit(16 * len(keys)).cast("bigint")
    for k in keys:
        if isinstance(df.schema[k].dataType, (T.StringType, T.BinaryType)):
            size = size + F.octet_length(F.col(quoted(k)))
    return size


def guarded_merge(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The whole target after the upsert: absent keys are inserted, rows with an older position are
    replaced in every column, all others stay. Both sides have one row per key and the same columns."""
    t = target.select("*", F.lit(True).alias("_here")).alias("t")
    s = staged.select(*cols(target.columns), F.lit(True).alias("_here")).alias("s")
    joined = t.join(s, same_keys("t", "s", keys), "full_outer")
    # Presence is told by the marker column: a user column may well be NULL.
    take = F.col("s._here").isNotNull() & (
        F.col("t._here").isNull() | (position("t") < position("s"))
    )
    return joined.select(
        *(
            F.when(take, F.col(f"s.{quoted(c)}")).otherwise(F.col(f"t.{quoted(c)}")).alias(c)
            for c in target.columns
        )
    )


def merge_counts(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many staged rows the upsert applies, and how many are stale."""
    s = staged.select(*cols(keys), *POSITION).alias("s")
    t = target.select(*cols(keys), *POSITION).alias("t")
    joined = s.join(t, same_keys("s", "t", keys), "left")
    stale = F.col("t._src_file").isNotNull() & (position("t") >= position("s"))
    return joined.agg(F.count_if(~stale).alias("applied"), F.count_if(stale).alias("stale"))


def live_view(replica: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that are not deleted; only ``columns`` if given."""
    live = replica.where(~F.col("_deleted"))
    return live.select(*cols(columns)) if columns else live
