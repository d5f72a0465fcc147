"""One batch of change messages into a replica: all tables, or none."""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from functools import partial, reduce
from typing import TypeVar

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from tidemark.functions.columns import META_COLUMNS, cols
from tidemark.functions.wire import LOGICAL_TYPES, LogicalType, SchemaConflict
from tidemark.operators.decode import (
    MAX_VERSIONS,
    DecodedTable,
    batch_summary,
    decode_table,
    parse_versions,
    split_messages,
    texts_of,
    usable_versions,
    versions_by_table,
    versions_of_batch,
    with_places,
)
from tidemark.operators.merge import drop_stale, key_bytes, stored_for
from tidemark.operators.reduce import newest_per_key
from tidemark.operators.replica import Commit, Position, Replica, SchemaTexts, TableState, Version, bucket_of
from tidemark.operators.schema import TableVersion, align_to, evolve_schema
from tidemark.operators.stats import (
    BAD_SCHEMA,
    BATCH_SCHEMA,
    LAG_SCHEMA,
    histogram_percentiles,
    lag_histogram,
    ops_counts,
    run_ops,
    run_summary,
)

# Tables of one batch are independent of each other until it is published: so many are written side by side.
PARALLEL_TABLES = 16

# A table with so few events is one task, without a shuffle, if the whole batch that it is looked for in isn't larger than
# that. So many small tables fill the executors side by side.
ONE_TASK, LOOKED_THROUGH = 25_000, 1_000_000

# Look up the keys of a batch first if there are so many times more stored rows than events.
MUCH_LARGER = 4

# Batches whose statistics become one directory, so that a long run leaves few files.
STATS_JOINED = 100
_JOINED = "-joined"
_WITH_BAD = "-bad"

T_ = TypeVar("T_")

# Counts, the table's next state, its events for the lag, and where its bad messages are.
_Done = tuple["BatchResult", TableState, DataFrame | None, DataFrame | None]

# Lag percentiles of a run report.
REPORTED = {"p50": 0.5, "p95": 0.95, "p99": 0.99, "p999": 0.999}


@dataclass
class BatchResult:
    """``received = deduped + applied + stale``; bad messages are beside them."""

    received: int = 0
    deduped: int = 0  # superseded within the batch
    applied: int = 0
    stale: int = 0  # not newer than what the replica held
    ops: Counter[str] = field(default_factory=Counter)
    version: int = 0
    bad: int = 0  # set apart

    def add(self, other: BatchResult) -> None:
        self.received += other.received
        self.deduped += other.deduped
        self.applied += other.applied
        self.stale += other.stale
        self.ops.update(other.ops)


def apply_batch(
    replica: Replica,
    raw: DataFrame,
    *,
    run_id: str = "run",
    consumer_id: str = "sink-1",
    logical_types: Mapping[str, LogicalType] = LOGICAL_TYPES,
    before_publish: Callable[[], None] | None = None,
    max_versions: int = MAX_VERSIONS,
    on_bad: str = "fail",
    parallel_tables: int = PARALLEL_TABLES,
) -> BatchResult:
    """Decode, keep the newest event per key, evolve the schemas, write what is newer than the
    replica's rows, and publish data and statistics of all tables as one version.

    Applying a batch twice, or batches in another order, leads to the same replica. More than ``max_versions`` versions of
    tables in one batch are an error, as then something other than schemas varies.

    Counts, positions, schema versions and lags of all tables come from one pass over the messages; each table then is one
    job, which decodes, ranks, guards and writes, ``parallel_tables`` at a time. Small tables with the same columns, such as
    those of many tenants, are one job together.

    A message that can't be decoded stops the job. With ``on_bad='quarantine'`` it is set apart instead, with the
    reason (see ``bad_messages``), and the others are applied. A table whose schema can't be used (it has no primary key, say)
    is then set apart as well; schemas that contradict the replica's still stop the job.
    """
    if on_bad not in ("fail", "quarantine"):
        raise ValueError(f"on_bad must be 'fail' or 'quarantine', not {on_bad!r}")
    started = _now()
    parts = split_messages(raw).drop("_value_schema", "_key_schema")
    if on_bad == "fail":
        parts = with_places(parts)
    kept: list[DataFrame] = []
    came = raw.where(F.col("value").isNotNull())
    try:
        with replica.scratch() as path:
            # Read several times, and larger than memory, so they aren't cached: Spark holds a hundred blocks of 10,000 messages
            # a task while it writes or reads a cached partition. Of files, a table reads little more than its own messages.
            parts = replica.written(parts, path)
            current = replica.version()
            batch = _Batch(replica, current, run_id, consumer_id, started, kept, parallel_tables)
            if on_bad == "fail":
                summary = batch_summary(parts, max_versions)
                batch = replace(batch, messages=sum(r["n"] for r in summary))
                texts = texts_of(came, _firsts(summary), current.schemas, max_versions)
                tables = versions_by_table(parse_versions(texts, logical_types))
                by_version: dict[int, list[Row]] = {}
                for r in summary:
                    by_version.setdefault(r["_version"], []).append(r)
                found = {name: [r for i in of for r in by_version.get(i, ())] for name, of in tables.items()}
                alike = batch.alike(tables, found)
                together = {a.table for group in alike for a in group}
                decoders = {n: partial(_decode, parts, n, of) for n, of in tables.items() if n not in together}
                schemas = replica.schemas_with(current.schemas, texts)
                return batch.apply(decoders, schemas, before_publish, found=found, for_lag=parts, alike=alike)
            texts = versions_of_batch(came, parts, current.schemas, max_versions)
            versions, unusable = usable_versions(texts, logical_types)
            tables = versions_by_table(versions)
            decoders = {name: partial(_decode_usable, parts, name, of, kept) for name, of in tables.items()}
            schemas = replica.schemas_with(current.schemas, {i: texts[i] for i in versions})
            return batch.apply(decoders, schemas, before_publish, raw, _of_versions(parts, unusable))
    finally:
        for df in kept:
            df.unpersist()


def apply_events(
    replica: Replica,
    tables: Mapping[str, tuple[DataFrame, TableVersion]],
    *,
    run_id: str = "run",
    consumer_id: str = "sink-1",
) -> BatchResult:
    """The same for events that are typed already, such as a snapshot read from the source."""
    kept: list[DataFrame] = []
    try:
        current = replica.version()
        decoders = {
            name: partial(_Surviving, DecodedTable(name, events, version.keys, {0: version}))
            for name, (events, version) in sorted(tables.items())
        }
        batch = _Batch(replica, current, run_id, consumer_id, _now(), kept)
        return batch.apply(decoders, replica.schemas_with(current.schemas, {}))
    finally:
        for df in kept:
            df.unpersist()


def _firsts(summary: Sequence[Row]) -> dict[int, Row]:
    """Where one message of each version is."""
    firsts: dict[int, Row] = {}
    for r in sorted(summary, key=lambda r: tuple(map(str, r["first"]))):
        firsts.setdefault(r["_version"], r["first"])
    return firsts


@dataclass(frozen=True)
class _Surviving:
    """Events of one table, and apart from them those of versions that are superseded altogether."""

    decoded: DecodedTable
    dropped: DataFrame | None = None
    bad: DataFrame | None = None  # where bad messages are, and why; ``decoded`` is cached then


def _decode(parts: DataFrame, table: str, versions: Mapping[int, TableVersion]) -> _Surviving:
    """Only versions that an event surviving in this batch has may change the replica's schema. With
    several versions in the batch, keys and positions tell which those are."""
    if len(versions) == 1:
        return _Surviving(decode_table(parts, table, versions))
    light = decode_table(parts, table, versions, keys_only=True)
    newest = newest_per_key(light.events, light.keys)
    alive = {r[0] for r in newest.select("_version").distinct().collect()}
    if alive == set(versions):
        return _Surviving(decode_table(parts, table, versions))
    # No event of the other versions is the newest of its key: they only count.
    surviving = {i: versions[i] for i in alive}
    dropped = light.events.where(~F.col("_version").isin(*alive))
    return _Surviving(decode_table(parts, table, surviving, only_these=True), dropped)


def _decode_usable(
    parts: DataFrame, table: str, versions: Mapping[int, TableVersion], kept: list[DataFrame]
) -> _Surviving:
    """The same without bad messages."""

    def split(of: Mapping[int, TableVersion], keys_only: bool = False) -> tuple[DecodedTable, DataFrame]:
        all_ = decode_table(parts, table, of, keys_only=keys_only, only_these=True, on_bad="flag")
        flagged = all_.events.persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(flagged)
        good = flagged.where(F.col("_bad").isNull()).drop("_bad", "_topic")
        return replace(all_, events=good), flagged.where(F.col("_bad").isNotNull())

    if len(versions) == 1:
        decoded, bad = split(versions)
        return _Surviving(decoded, bad=bad.select(_place()))
    light, light_bad = split(versions, keys_only=True)
    newest = newest_per_key(light.events, light.keys)
    alive = {r[0] for r in newest.select("_version").distinct().collect()}
    superseded = ~F.col("_version").isin(*alive) if alive else F.lit(True)
    if not alive or alive == set(versions):
        decoded, bad = split(versions)
        return _Surviving(decoded, bad=bad.select(_place()))
    decoded, bad = split({i: versions[i] for i in alive})
    bad = bad.select(_place()).unionByName(light_bad.where(superseded).select(_place()))
    return _Surviving(decoded, light.events.where(superseded), bad)


def _place() -> Column:
    return F.struct(
        F.col("_topic").alias("topic"),
        F.col("_partition").alias("partition"),
        F.col("_offset").alias("offset"),
        F.col("_bad").alias("why"),
    ).alias("at")


def _of_versions(parts: DataFrame, why: Mapping[int, str]) -> DataFrame | None:
    """Places of the messages of versions that can't be used."""
    if not why:
        return None
    reasons = F.create_map(*(F.lit(x) for item in why.items() for x in item))
    of = parts.where(F.col("_version").isin(*why))
    place = F.struct("topic", "partition", "offset", reasons[F.col("_version")].alias("why"))
    return of.select(place.alias("at"))


@dataclass(frozen=True)
class _Alike:
    """A small table that is applied together with others of the same columns."""

    table: str
    number: int  # of its only version in the batch, so that this tells tables apart
    version: TableVersion
    state: TableState
    found: Sequence[Row]

    @property
    def events(self) -> int:
        return sum(r["n"] for r in self.found)


@dataclass(frozen=True)
class _Batch:
    replica: Replica
    current: Version
    run_id: str
    consumer_id: str
    started: datetime
    kept: list[DataFrame]  # to be released at the end
    parallel_tables: int = PARALLEL_TABLES
    messages: int = 0  # of all tables, where that is known beforehand

    @property
    def number(self) -> int:
        return self.current.number + 1

    def apply(
        self,
        decoders: Mapping[str, Callable[[], _Surviving]],
        schemas: SchemaTexts,
        before_publish: Callable[[], None] | None = None,
        raw: DataFrame | None = None,
        unusable: DataFrame | None = None,
        found: Mapping[str, Sequence[Row]] | None = None,
        for_lag: DataFrame | None = None,
        alike: Sequence[Sequence[_Alike]] = (),
    ) -> BatchResult:
        """``raw`` is where bad messages are looked up; ``unusable`` tells those no table is known of. ``found`` is each table's
        summary and ``for_lag`` has all events, where they are known from the messages already. ``alike`` are tables that are
        applied together."""
        calls: list[Callable[[], dict[str, _Done]]] = [
            partial(lambda n, d: {n: self._apply_table(n, d(), found[n] if found else None)}, n, d)
            for n, d in decoders.items()
        ]
        calls += [partial(self._apply_alike, for_lag, group) for group in alike]
        largest = max((sum(r["n"] for r in of) for of in (found or {}).values()), default=0)
        with self.replica.shuffles_by_bucket(largest):
            done = {n: d for some in _all(self.replica.spark, calls, self.parallel_tables) for n, d in some.items()}
        result = BatchResult(version=self.number)
        states = dict(self.current.tables)
        for name, (counts, state, _, _) in done.items():
            result.add(counts)
            states[name] = state
        bad = [b for b in (unusable, *(b for _, _, _, b in done.values())) if b is not None]
        set_apart = self._set_apart(raw, bad, result) if raw is not None and bad else None
        lags = [events for _, _, events, _ in done.values() if events is not None]
        stats = self._write_stats(result, lags if for_lag is None else [for_lag], set_apart)
        if before_publish:
            before_publish()
        self.replica.publish(Version(self.number, states, schemas, stats))
        return result

    def _state(self, name: str, versions: Iterable[TableVersion], keys: tuple[str, ...]) -> TableState:
        """The table as it is, with the schema that it has after the batch."""
        state = self.current.tables.get(name)
        if state and state.keys != keys:
            raise SchemaConflict(f"the key of {name} was {', '.join(state.keys)} and now is {', '.join(keys)}")
        schema = evolve_schema(state.schema if state else None, versions, keys)
        return TableState(schema, keys, state.commits if state else ())

    def alike(
        self, tables: Mapping[str, Mapping[int, TableVersion]], found: Mapping[str, Sequence[Row]]
    ) -> list[list[_Alike]]:
        """Small tables by what they have in common: the columns of their only version in the batch, the key, and the schema
        they have after it. Tables with a commit laid out by bucket go by themselves."""
        groups: dict[object, list[_Alike]] = {}
        for name, of in tables.items():
            if len(of) > 1 or sum(r["n"] for r in found[name]) > ONE_TASK:
                continue
            [(number, version)] = of.items()
            state = self._state(name, [version], version.keys)
            if all(c.buckets == 1 for c in state.commits):
                same = (version.columns, version.keys, state.schema.json())
                groups.setdefault(same, []).append(_Alike(name, number, version, state, found[name]))
        return [group for group in groups.values() if len(group) > 1]

    def _apply_alike(self, parts: DataFrame, group: Sequence[_Alike]) -> dict[str, _Done]:
        """The same as ``_apply_table`` for tables that are alike, as one job: ``_version`` is a part of each key. Every
        table is small, so its rows are one task's, and its commit is one file."""
        first, keys = group[0], ("_version", *group[0].version.keys)
        versions = {a.number: a.version for a in group}
        events = decode_table(parts, first.table, versions, alike=[a.table for a in group[1:]]).events
        since, reached = _reached_alike(group)
        if reached:
            events = self._cached(events)
        together = events.repartition(F.col("_version"))
        staged = align_to(newest_per_key(together, keys), first.state.schema).select(
            "_version", *self._row(first.state.schema)
        )
        came = None
        if reached:
            staged = self._cached(staged)
            came = {r["_version"]: r["count"] for r in staged.select("_version").groupBy("_version").count().collect()}  # one per table
            stored = self.replica.stored_alike(first.state, {n: (t, i) for n, (t, i, _) in reached.items()}, since)
            if sum(rows for _, _, rows in reached.values()) > MUCH_LARGER * sum(a.events for a in group):
                stored = stored_for(events, stored, keys, sum(r["key_bytes"] for a in group for r in a.found))
            staged = drop_stale(staged, stored, keys).repartition(F.col("_version"))
        commits = self.replica.write_alike({a.number: (a.table, a.state) for a in group}, staged, self.number)
        done: dict[str, _Done] = {}
        for a in group:
            commit = commits.get(a.table)
            applied = commit.rows if commit else 0
            n_staged = applied if came is None else came.get(a.number, 0)
            result = BatchResult(a.events, a.events - n_staged, applied, n_staged - applied)
            for r in a.found:
                result.ops[r["_op"]] += r["n"]
            done[a.table] = (result, a.state.plus(commit), None, None)
        return done

    def _row(self, schema: T.StructType) -> list[Column]:
        """A replica's row out of an event aligned to ``schema``."""
        applied_at = F.lit(self.started).cast("timestamp").alias("_applied_at")
        return [*cols(schema.names), *cols(META_COLUMNS[:-1]), applied_at]

    def _apply_table(self, name: str, surviving: _Surviving, found: Sequence[Row] | None = None) -> _Done:
        decoded, dropped = surviving.decoded, surviving.dropped
        keys = decoded.keys
        state = self._state(name, decoded.versions.values(), keys)
        schema = state.schema

        events, bad = decoded.events, surviving.bad
        result, for_lag = BatchResult(), None
        if found is None:
            # Parsed once, used for the counts, the merge and the lag.
            if bad is None:
                events = self._cached(events)
            found = _summary(events, keys).collect()
            for_lag = events.select("_op", "_src_commit_at")
            if dropped is not None:
                for_lag = for_lag.unionByName(dropped.select("_op", "_src_commit_at"))
                result.ops.update({r["_op"]: r["n"] for r in ops_counts(dropped).collect()})
        for r in found:
            result.ops[r["_op"]] += r["n"]
        n_events = sum(r["n"] for r in found)
        result.received = result.ops.total()
        if not found:
            return result, state, for_lag, bad

        if for_lag is None and n_events <= ONE_TASK and self.messages <= LOOKED_THROUGH:
            events = events.coalesce(1)
        since = _since(found)
        commits = [c for c in state.commits if c.newest >= since]
        if commits and for_lag is None:
            # Read more than once now.
            events = self._cached(events)
        commits, buckets = self._reached(name, state, commits, events)
        staged = align_to(newest_per_key(events, keys), schema).select(*self._row(schema))
        stored = self.replica.stored(name, state, commits, since, buckets)
        n_stored = sum(c.rows * len(buckets.get(c.name, range(c.buckets))) // c.buckets for c in commits)
        if stored is not None and n_stored > MUCH_LARGER * n_events:
            # The keys of the cached events: those of ``staged`` would be ranked once more.
            stored = stored_for(events, stored, keys, sum(r["key_bytes"] for r in found))
        n_staged, commit = self.replica.write_commit(
            name, state, staged, self.number, n_events, stored
        )
        result.applied = commit.rows if commit else 0
        result.stale = n_staged - result.applied
        result.deduped = result.received - n_staged
        return result, state.plus(commit), for_lag, bad

    def _cached(self, events: DataFrame) -> DataFrame:
        events = events.persist(StorageLevel.MEMORY_AND_DISK)
        self.kept.append(events)
        return events

    def _reached(
        self, name: str, state: TableState, commits: Sequence[Commit], events: DataFrame
    ) -> tuple[Sequence[Commit], dict[str, list[int]]]:
        """The commits, and the buckets of them, that hold rows as new as the oldest event of a key there."""
        many = max((c.buckets for c in commits), default=1)
        if many == 1:
            return commits, {}
        places = events.select(bucket_of(state, many).alias("bucket"), "_src_file", "_src_pos")
        by_file = places.groupBy("bucket", "_src_file").agg(F.min("_src_pos").alias("pos"))
        oldest: dict[int, tuple[int, int]] = {}
        for r in by_file.collect():  # a few per bucket
            at = (r["_src_file"], r["pos"])
            oldest[r["bucket"]] = min(at, oldest.get(r["bucket"], at))
        return self.replica.reached(name, commits, oldest)

    def _set_apart(self, raw: DataFrame, places: Sequence[DataFrame], result: BatchResult) -> DataFrame | None:
        """The bad messages as they came, with the reasons; None if there are none."""
        at = reduce(DataFrame.unionByName, places).select("at.*").persist(StorageLevel.MEMORY_AND_DISK)
        self.kept.append(at)
        result.bad = at.count()
        if not result.bad:
            return None
        by = ["topic", "partition", "offset"]
        # A message that came twice has one entry.
        once = at.groupBy(*by).agg(F.min("why").alias("why"))
        came = raw.where(F.col("value").isNotNull()).dropDuplicates(by)
        who = (F.lit(v) for v in (self.run_id, self.consumer_id, self.number))
        found = came.join(once, by)
        return found.select(_as(BAD_SCHEMA, [*who, *(F.col(f.name) for f in BAD_SCHEMA.fields[3:])]))

    def _write_stats(
        self, result: BatchResult, for_lag: Sequence[DataFrame], bad: DataFrame | None = None
    ) -> tuple[str, ...]:
        """Writes the batch's statistics to a directory of this attempt, and returns those of the next version, which alone
        makes them visible. Every ``STATS_JOINED`` batches, theirs become one directory."""
        name, applied_at = f"{self.number}-{uuid.uuid4().hex}", _now()
        who = (self.run_id, self.consumer_id, self.number)
        counts = (result.received, result.deduped, result.applied, result.stale)
        ops = F.create_map(*(F.lit(x) for op_n in result.ops.items() for x in op_n))
        row = [F.lit(v) for v in (*who, self.started, applied_at, 1, *counts)]
        spark = self.replica.spark
        batch = spark.range(1).select(_as(BATCH_SCHEMA, [*row, ops, F.lit(result.bad)])).coalesce(1)
        lags = spark.createDataFrame([], LAG_SCHEMA)
        if for_lag:
            events = reduce(DataFrame.unionByName, for_lag)
            lag = lag_histogram(events, F.lit(applied_at).cast("timestamp"))
            lags = lag.select(_as(LAG_SCHEMA, [*(F.lit(v) for v in who), F.col("lag_ms"), F.col("n")]))
        single = [n for n in self.current.stats if not n.endswith(_JOINED)]
        joined = len(single) + 1 >= STATS_JOINED
        before = [n for n in single if _WITH_BAD in n] if joined else []
        if before:
            earlier = _named(self.replica, before, "bad", BAD_SCHEMA)
            bad = earlier if bad is None else earlier.unionByName(bad)
        if bad is not None:
            name += _WITH_BAD
        if joined:
            name += _JOINED
            batch = _named(self.replica, single, "batches", BATCH_SCHEMA).unionByName(batch).coalesce(1)
            lags = _named(self.replica, single, "lag", LAG_SCHEMA).unionByName(lags)
        path = self.replica.stats_path(name)
        written = {"batches": batch, "lag": lags, **({} if bad is None else {"bad": bad})}
        _all(spark, [partial(df.write.parquet, f"{path}/{kind}") for kind, df in written.items()])
        gone = set(single) if joined else set()
        return (*(n for n in self.current.stats if n not in gone), name)


def _since(found: Iterable[Row]) -> Position:
    """Where the log starts that a summary is of."""
    places = [tuple(r["oldest"]) for r in found if None not in tuple(r["oldest"])]
    return (*min(places, default=(0, 0)), 0)


def _reached_alike(group: Sequence[_Alike]) -> tuple[Position, dict[str, tuple[str, int, int]]]:
    """The oldest position of the tables, and the commits that reach their table's: by name the table, its number, and rows."""
    reached = {}
    for a in group:
        since = _since(a.found)
        reached |= {c.name: (a.table, a.number, c.rows) for c in a.state.commits if c.newest >= since}
    return min(_since(a.found) for a in group), reached


def _all(spark: SparkSession, calls: Sequence[Callable[[], T_]], threads: int = PARALLEL_TABLES) -> list[T_]:
    """Results of calls that run side by side. Their jobs belong to the caller's job group and pool, so
    that stopping a query stops them."""
    with ThreadPoolExecutor(threads) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]
        return [f.result() for f in futures]


def _summary(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per kind of change: events, where the log starts, bytes of the keys. By log file first: a
    minimum of numbers is hashed, one of structs would sort all events."""
    # Only what is needed, before it is grouped: frames with a TIME can't be grouped in a thread of a pool.
    sizes = events.select("_op", "_src_file", "_src_pos", key_bytes(events, keys).alias("key_bytes"))
    by_file = sizes.groupBy("_op", "_src_file").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("_src_pos").alias("_src_pos"),
        F.sum("key_bytes").alias("key_bytes"),
    )
    return by_file.groupBy("_op").agg(
        F.sum("n").alias("n"),
        F.min(F.struct("_src_file", "_src_pos")).alias("oldest"),
        F.sum("key_bytes").alias("key_bytes"),
    )


def _as(schema: T.StructType, columns: Sequence[Column]) -> list[Column]:
    return [c.cast(f.dataType).alias(f.name) for c, f in zip(columns, schema.fields, strict=True)]


def batch_stats(replica: Replica) -> DataFrame:
    """One row per published batch."""
    return _stats(replica, "batches", BATCH_SCHEMA)


def lag_stats(replica: Replica) -> DataFrame:
    """Lag histogram per published batch: (run_id, consumer_id, version, lag_ms, n)."""
    return _stats(replica, "lag", LAG_SCHEMA)


def bad_messages(replica: Replica) -> DataFrame:
    """Messages that published batches set apart: run, consumer, version, the message, and why."""
    names = [n for n in replica.version().stats if _WITH_BAD in n]
    return _named(replica, names, "bad", BAD_SCHEMA)


def run_report(
    replica: Replica,
    run_id: str,
    reports: DataFrame | None = None,
    examples: DataFrame | None = None,
) -> dict[str, object]:
    """What a run did, as one small document: totals, events per kind, lag percentiles, and the
    outcome of ``verify`` and of ``verify_examples`` if given."""
    batches = batch_stats(replica).where(F.col("run_id") == run_id)
    lags = lag_stats(replica).where(F.col("run_id") == run_id)
    totals = run_summary(batches).drop("run_id", "started_at", "updated_at").first()
    report: dict[str, object] = {
        "run_id": run_id,
        "totals": totals.asDict() if totals else {},
        "events_by_op": {r["op"]: r["n"] for r in run_ops(batches).collect()},
        "lag_ms": histogram_percentiles(lags, REPORTED).first().asDict(),  # type: ignore[union-attr]
    }
    if reports is not None:
        rows = [r.asDict() for r in reports.collect()]  # one per table
        report["tables"] = rows
        report["all_ok"] = all(r["ok"] for r in rows)
    if examples is not None:
        report["examples"] = [r.asDict() for r in examples.collect()]  # a few per table
    return report


def write_report(replica: Replica, report: Mapping[str, object], path: str) -> None:
    """The report as a JSON file."""
    text = [(json.dumps(report, default=str),)]
    replica.spark.createDataFrame(text, "value string").coalesce(1).write.mode("overwrite").text(path)


def _stats(replica: Replica, kind: str, schema: T.StructType) -> DataFrame:
    return _named(replica, replica.version().stats, kind, schema)


def _named(replica: Replica, names: Sequence[str], kind: str, schema: T.StructType) -> DataFrame:
    if not names:
        return replica.spark.createDataFrame([], schema)
    return replica.spark.read.schema(schema).parquet(*(f"{replica.stats_path(n)}/{kind}" for n in names))


def _now() -> datetime:
    return datetime.now(timezone.utc)

