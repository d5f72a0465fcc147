"""Positions as state of a streaming query, and reading them back."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.columns import META_FIELDS, POSITION, cols
from tidemark.operators.replica import Replica
from tidemark.operators.verify import compare_tables

# Name of the state, and its type: a position, whatever the row.
STATE = "position"
STATE_SCHEMA = T.StructType([f for f in META_FIELDS if f.name in POSITION])


def newer_events(events: DataFrame, keys: Sequence[str], position: Sequence[str] = POSITION) -> DataFrame:
    """Of each key and batch of a stream, the event with the greatest position, if that is greater than any before. Of equal
    positions, the first that comes is taken.

    The state of a key is the position of its newest event, so it doesn't grow with the rows. Rows stream through, so
    neither does memory with the events of a hot key.
    """
    # Defined here, so that it travels to the executors by value.
    names = tuple(position)

    class Newest(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self._state = handle.getValueState(STATE, STATE_SCHEMA)

        def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
            known = tuple(self._state.get()) if self._state.exists() else None
            at, newest = known, None
            for row in rows:
                place = tuple(row[c] for c in names)
                if at is None or place > at:
                    at, newest = place, row
            if newest is not None:
                self._state.update(at)
                yield newest

        def close(self) -> None:
            pass

    grouped = events.groupBy(*cols(keys))
    return grouped.transformWithState(
        statefulProcessor=Newest(), outputStructType=events.schema, outputMode="Update", timeMode="None"
    )


def stored_positions(spark: SparkSession, checkpoint: str, version: int | None = None) -> DataFrame:
    """What the state of a query over ``newer_events`` holds: keys and positions, after its last batch or an earlier one."""
    reader = spark.read.format("statestore").option("stateVarName", STATE)
    if version is not None:
        reader = reader.option("batchId", version)
    return reader.load(checkpoint).select("key.*", "value.*")


def verify_state(replica: Replica, table: str, checkpoint: str, version: int | None = None) -> DataFrame:
    """The report of ``compare_tables`` on a query's state (source) and the positions its replica holds (target)."""
    keys = replica.keys(table)
    state = stored_positions(replica.spark, checkpoint, version)
    held = replica.read(table).select(*cols(keys), *POSITION)
    return compare_tables(state, held, keys, table)


def state_bytes(query: Any) -> int:
    """Memory a query's state takes, as its last progress tells."""
    progress = query.lastProgress
    return sum(op.memoryUsedBytes for op in progress.stateOperators) if progress else 0


