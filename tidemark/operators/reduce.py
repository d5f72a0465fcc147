"""The newest event per primary key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.columns import POSITION, cols


def newest_per_key(
    events: DataFrame, keys: Sequence[str], position: Sequence[str] = POSITION
) -> DataFrame:
    """One row per key: the event with the greatest position. Events of equal position are the same
    log entry; the earliest delivered copy is taken.

    ``row_number() = 1`` lets Spark keep one candidate per key and input partition before the
    shuffle, so a key that holds a third of all events costs one row per partition.
    """
    tie_break = [c for c in ("_partition", "_offset") if c in events.columns]
    newest_first = [F.col(c).desc() for c in position] + [F.col(c).asc() for c in tie_break]
    window = Window.partitionBy(*cols(keys)).orderBy(*newest_first)
    return (
        events.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def latest_state(
    events: DataFrame, keys: Sequence[str], position: Sequence[str] = POSITION
) -> DataFrame:
    """The same result as a plain aggregation, which also runs as a streaming query in update mode
    (ranking does not)."""
    kept = [c for c in events.columns if c not in keys]
    newest = F.max_by(F.struct(*cols(kept)), F.struct(*cols(position)))
    grouped = events.groupBy(*cols(keys)).agg(newest.alias("_newest"))
    unpacked = [F.col("_newest").getField(c).alias(c) for c in kept]
    return grouped.select(*cols(keys), *unpacked).select(*cols(events.columns))
