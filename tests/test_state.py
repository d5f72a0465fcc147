"""Streams that keep positions, tell what they do, and stop by themselves; snapshots in chunks."""

import random

import pytest
from pyspark.sql import functions as F

from tests.messages import change, reading
from tidemark.functions.columns import POSITION
from tidemark.operators.apply import apply_events, batch_stats
from tidemark.operators.reduce import newest_per_key
from tidemark.operators.replica import Replica
from tidemark.operators.schema import version_of
from tidemark.operators.snapshot import in_range, key_ranges, snapshot_in_chunks
from tidemark.sources.changes import RAW_SCHEMA, read_changes
from tidemark.streaming.live import LiveStats, stop_when_idle
from tidemark.streaming.runner import run_state_stream, run_stream
from tidemark.streaming.state import stored_positions, verify_state

EVENTS = """id long, name string, wide string, _op string, _src_file int, _src_pos long, _src_row int,
 _src_commit_at timestamp, _deleted boolean"""


def events(spark, rows):
    """Rows of (id, name, position)."""
    made = [(i, n, "w" * 200, "u", 1, p, 0, None, False) for i, n, p in rows]
    return spark.createDataFrame(made, EVENTS).withColumn("_src_commit_at", F.timestamp_micros(F.lit(0)))


def test_state_is_the_position(spark, tmp_path):
    """Batches in no order, a hot key, and null values; the state read back equals the replica, and what is lost shows."""
    batches = [
        [(i, f"a{i}", 100 + i) for i in range(40)] + [(7, f"hot{n}", 500 + n) for n in range(300)],
        [(i, None if i % 2 else "late", 50 + i) for i in range(45)],
        [(3, "new", 900), (3, "same place", 900), (50, "only", 1)],
    ]
    for n, batch in enumerate(batches):
        events(spark, batch).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / str(n)))
    replica = Replica(spark, str(tmp_path / "replica"))
    for n in range(len(batches)):
        source = spark.readStream.schema(events(spark, []).schema).parquet(str(tmp_path / "in" / "*"))
        if n == 0:
            run_state_stream(source, ("id",), replica, "t", str(tmp_path / "progress")).awaitTermination()
    want = {r.id: (r.name, r._src_pos) for r in newest_per_key(events(spark, sum(batches, [])), ["id"]).collect()}
    got = {r.id: (r.name, r._src_pos) for r in replica.read("t").collect()}
    assert {i: p for i, (_, p) in got.items()} == {i: p for i, (_, p) in want.items()}
    assert all(got[i] == want[i] for i in want if i != 3) and got[3][0] in ("new", "same place")
    state = stored_positions(spark, str(tmp_path / "progress"))
    assert state.columns == ["id", *POSITION]  # nothing of the rows
    assert verify_state(replica, "t", str(tmp_path / "progress")).first().ok
    more = events(spark, [(3, "newer", 999)])
    apply_events(replica, {"t": (more, version_of("t", more.select("id", "name", "wide").schema, ("id",)))})
    report = verify_state(replica, "t", str(tmp_path / "progress")).first()
    assert (report.mismatched, report.missing, report.extra, report.ok) == (1, 0, 0, False)


def test_live_totals_are_those_of_the_table(spark, tmp_path):
    """While it runs, and until it has been idle for a while; also with bad messages and new versions in a batch."""
    messages, replica = tmp_path / "messages", Replica(spark, str(tmp_path / "replica"))

    def deliver(*batch):
        spark.createDataFrame(list(batch), RAW_SCHEMA).coalesce(1).write.mode("append").parquet(str(messages))

    topic, key, value, p, o = change("u", reading(9), 700)
    deliver(*(change("c", reading(i), 100 + i) for i in range(5)), (topic, key, value[:-30], p, 7000))
    deliver(*(change("u", reading(i, "b"), 200 + i) for i in range(3)), change("u", reading(0, "old"), 10))
    seen = []
    stats = LiveStats(seen.append)
    query = run_stream(
        read_changes(spark, str(messages), streaming=True, max_per_trigger=1), replica, str(tmp_path / "progress"),
        trigger={"processingTime": "0 seconds"}, on_bad="quarantine", stats=stats)
    totals = stop_when_idle(query, stats, seconds=4)
    assert not query.isActive and totals["batches"] == 2 == len(seen)
    table = batch_stats(replica).agg(
        *(F.sum(c).alias(c) for c in ("received", "deduped", "applied", "stale", "bad"))).first().asDict()
    assert {c: totals[c] for c in table} == table and (table["received"], table["bad"]) == (9, 1)
    assert totals["ops"] == {"c": 5, "u": 4} and seen[0]["received"] < totals["received"]
    deliver(change("d", reading(0), 900))
    again = LiveStats()
    run_stream(
        read_changes(spark, str(messages), streaming=True), replica, str(tmp_path / "progress"), stats=again).awaitTermination()
    assert again.totals()["received"] == 1


@pytest.mark.parametrize("seed", range(4))
def test_chunks_beside_a_moving_log(spark, tmp_path, seed):
    """Whatever moves between the two looks at the log, and however batches and chunks alternate."""
    r = random.Random(seed)
    rows = {i: f"v{i}" for i in range(60)}
    log, applied = [], 0
    replica = Replica(spark, str(tmp_path / "replica"))
    columns = "id long, name string"
    version = version_of("t", spark.createDataFrame([], columns).schema, ("id",))

    def move(n):
        for _ in range(n):
            i, pos = r.randrange(80), len(log) + 1
            gone = i in rows and r.random() < 0.3
            name = rows.pop(i) if gone else rows.setdefault(i, "") or f"p{pos}"
            if not gone:
                rows[i] = name = f"p{pos}"
            log.append((i, name, None, "d" if gone else "u", 1, pos, 0, None, gone))

    def apply_log(upto):
        nonlocal applied
        if upto > applied:
            part = spark.createDataFrame(log[applied:upto], EVENTS).drop("wide")
            part = part.withColumn("_src_commit_at", F.timestamp_micros(F.lit(0)))
            apply_events(replica, {"t": (part, version)})
            applied = upto

    def position():
        return (1, len(log), 0)

    def read(condition):
        move(r.randrange(5))
        here = spark.createDataFrame(sorted(rows.items()), columns).where(condition)
        here = spark.createDataFrame(here.collect(), columns)  # as it is now
        move(r.randrange(5))
        return here

    def moved(after, upto):
        return spark.createDataFrame([(e[0],) for e in log[after[1] : upto[1]]], "id long")

    source = spark.createDataFrame(sorted(rows.items()), columns)
    ranges = key_ranges(source, "id", 4)
    assert sum(source.where(in_range("id", x)).count() for x in ranges) == 60 and len(ranges) == 4
    snapshot_in_chunks(
        replica, "t", ("id",), read, ranges, position, moved if seed % 2 else None,
        lambda: apply_log(r.randrange(applied, len(log) + 1)))
    apply_log(len(log))
    assert {x.id: x.name for x in replica.live("t").collect()} == rows
