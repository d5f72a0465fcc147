"""Change messages as a stream."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import EVENT_COLUMNS, META_COLUMNS
from tidemark.functions.wire import LOGICAL_TYPES, LogicalType
from tidemark.operators.apply import BatchResult, apply_batch, apply_events
from tidemark.operators.decode import MAX_VERSIONS
from tidemark.operators.replica import Replica
from tidemark.operators.schema import version_of
from tidemark.operators.verify import caught_up, consumer_lag
from tidemark.streaming.live import LiveStats
from tidemark.streaming.state import newer_events

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_stream(
    source: DataFrame,
    replica: Replica,
    checkpoint: str,
    *,
    run_id: str = "run",
    consumer_id: str = "sink-1",
    trigger: Mapping[str, Any] | None = None,
    logical_types: Mapping[str, LogicalType] = LOGICAL_TYPES,
    before_publish: Callable[[], None] | None = None,
    after_publish: Callable[[BatchResult], None] | None = None,
    max_versions: int = MAX_VERSIONS,
    on_bad: str = "fail",
    stats: LiveStats | None = None,
) -> StreamingQuery:
    """Applies a stream of messages (see ``read_changes``) to a replica, batch by batch.

    Data first, progress second: the checkpoint moves on after a batch is published. A job that dies
    in between gets the batch again, finds every event stale, and changes nothing. The guard does
    not rely on batch numbers, so even a lost checkpoint is harmless. ``trigger`` defaults to
    taking what is there and stopping; the two callbacks let tests fail a batch at a given point; ``max_versions`` and
    ``on_bad`` are those of ``apply_batch``. ``stats`` is told of every batch once it is published, and of the query's pace.
    """

    def handle(batch: DataFrame, number: int) -> None:
        result = apply_batch(
            Replica(batch.sparkSession, replica.path, replica.buckets),
            batch,
            run_id=run_id,
            consumer_id=consumer_id,
            logical_types=logical_types,
            before_publish=before_publish,
            max_versions=max_versions,
            on_bad=on_bad,
        )
        if stats:
            stats.published(number, result)
        if after_publish:
            after_publish(result)

    if stats:
        source.sparkSession.streams.addListener(stats)
    query = (
        source.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    if stats:
        stats.runs.add(str(query.runId))
    return query


def run_state_stream(
    events: DataFrame,
    keys: tuple[str, ...],
    replica: Replica,
    table: str,
    checkpoint: str,
    trigger: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """The position of the newest event per key as state of a streaming query (``newer_events``): events that are newer are
    applied to a table of the replica, whose guard makes repeated batches and a lost checkpoint harmless. ``events`` are typed,
    as those of ``snapshot_events``. ``verify_state`` compares the state with the replica.

    There is no watermark: an event may be arbitrarily late, so state never expires, and is kept on disk."""
    own = [f for f in events.schema.fields if f.name not in (*META_COLUMNS, *EVENT_COLUMNS)]
    version = version_of(table, T.StructType(own), keys)

    def apply(changed: DataFrame, _: int) -> None:
        # Written first: reading the batch again would update the state again, and it can't be cached.
        at = Replica(changed.sparkSession, replica.path, replica.buckets)
        with at.scratch() as path:
            changed.write.parquet(path)
            came = at.spark.read.schema(events.schema).parquet(path)
            apply_events(at, {table: (came, version)})

    writer = (
        newer_events(events, keys)
        .writeStream.outputMode("update")
        .foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    # A query takes the settings over when it starts; the session's stay as they were.
    conf, name = events.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, ROCKSDB)
    try:
        return writer.start()
    finally:
        conf.set(name, before) if before else conf.unset(name)


# ---- waiting


def progress_offsets(spark: SparkSession, progress: Any) -> tuple[DataFrame, DataFrame]:
    """What a query's progress says of its sources' newest and its own offsets, per topic partition: the ``high`` and
    ``committed`` of ``consumer_lag``. Sources without such offsets (files) add nothing."""
    high, committed = [], []
    for source in progress.sources if progress else ():
        for text, into in ((source.latestOffset, high), (source.endOffset, committed)):
            for topic, of in _parsed(text).items():
                if isinstance(of, dict):
                    into += [(topic, int(p), int(n)) for p, n in of.items()]
    columns = "topic string, partition int, {} long"
    return (
        spark.createDataFrame(high, columns.format("high")),
        spark.createDataFrame(committed, columns.format("committed")),
    )


def _parsed(text: str | None) -> dict[str, Any]:
    """Offsets that are no JSON object are none of a topic."""
    try:
        offsets = json.loads(text or "null")
    except ValueError:
        return {}
    return offsets if isinstance(offsets, dict) else {}


def wait_caught_up(
    query: StreamingQuery,
    replica: Replica,
    table: str,
    markers: DataFrame,
    timeout: float,
    *,
    key: str = "id",
    poll: float = 1.0,
) -> None:
    """Waits until every marker (rows the source's ``table`` got last, by ``key``) is in the replica and the query has nothing
    left to read. Fails with the query, or with ``TimeoutError`` after ``timeout`` seconds."""
    spark = replica.spark
    deadline = time.monotonic() + timeout
    while True:
        if error := query.exception():
            raise error
        here = replica.version().tables
        arrived = replica.live(table) if table in here else markers.limit(0)
        lag = consumer_lag(*progress_offsets(spark, query.lastProgress))
        found = caught_up(markers, arrived, lag, key).first()
        status = query.status
        idle = not (query.isActive and (status["isDataAvailable"] or status["isTriggerActive"]))
        if found["caught_up"] and idle:
            return
        if time.monotonic() > deadline:
            raise TimeoutError(
                f"{table}: after {timeout} s {found['waiting']} of {found['markers']} markers have not arrived,"
                f" {found['lag']} messages are left, and the query is {'idle' if idle else 'busy'}"
            )
        time.sleep(poll)
