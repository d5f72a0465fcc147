"""A table's first copy, taken in chunks while its log moves on."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import cols, quoted
from tidemark.operators.apply import BatchResult, apply_events
from tidemark.operators.replica import Position, Replica
from tidemark.operators.schema import version_of
from tidemark.sources.changes import snapshot_events

Range = tuple[Any, Any]  # of a key: from (or None), up to but without (or None)


def key_ranges(rows: DataFrame, key: str, chunks: int) -> list[Range]:
    """Ranges of a key column that hold about equally many rows and leave none out."""
    shares = F.lit([n / chunks for n in range(1, chunks)])
    found = rows.agg(F.percentile_approx(F.col(quoted(key)), shares, F.lit(10_000)).alias("at")).first()["at"] if chunks > 1 else []
    bounds = [None, *sorted(set(found or [])), None]
    return list(zip(bounds, bounds[1:], strict=False))


def in_range(key: str, of: Range) -> Column:
    low, high = of
    condition = F.lit(True)
    if low is not None:
        condition = condition & (F.col(quoted(key)) >= F.lit(low))
    if high is not None:
        condition = condition & (F.col(quoted(key)) < F.lit(high))
    return condition


def snapshot_chunk(
    replica: Replica,
    table: str,
    keys: Sequence[str],
    read: Callable[[Column], DataFrame],
    of: Range,
    log_position: Callable[[], Position],
    moved: Callable[[Position, Position], DataFrame] | None = None,
    run_id: str = "snapshot",
) -> BatchResult:
    """Copies one range of the first key column: ``read`` gives the source's rows that fulfil a condition, as they are when it is
    called.

    The rows get the log's position from before they were read. What they show may be newer, but then the log has an
    event behind that position, which wins, whether it is applied before or after. ``moved`` tells the log's events between
    two positions: rows of their keys are left out at once, so that nobody sees a row ahead of its log.
    """
    before = log_position()
    with replica.scratch() as path:
        # Read once: between the two looks at the log.
        rows = read(in_range(keys[0], of))
        rows.write.parquet(path)
        after = log_position()
        here = replica.spark.read.schema(rows.schema).parquet(path)
        if moved is not None and after > before:
            here = here.join(moved(before, after).select(*cols(keys)).distinct(), list(keys), "left_anti").select(*cols(rows.columns))
        events = snapshot_events(here, keys, before)
        return apply_events(replica, {table: (events, version_of(table, rows.schema, keys))}, run_id=run_id)


def snapshot_in_chunks(
    replica: Replica,
    table: str,
    keys: Sequence[str],
    read: Callable[[Column], DataFrame],
    ranges: Sequence[Range],
    log_position: Callable[[], Position],
    moved: Callable[[Position, Position], DataFrame] | None = None,
    between: Callable[[], None] | None = None,
) -> BatchResult:
    """All chunks, one after the other. Neither the source nor its log waits: batches of the log may be applied meanwhile, by
    ``between`` or by whoever writes the replica between two chunks."""
    whole = BatchResult()
    for of in ranges:
        whole.add(snapshot_chunk(replica, table, keys, read, of, log_position, moved))
        if between:
            between()
    return whole
