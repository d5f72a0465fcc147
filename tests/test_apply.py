import json
import os
import re
import subprocess
import sys
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tests.messages import COMMIT_US, FIRST, KWH, LATER, METER, SLOT, STATE, change, column, digits, number, reading
from tidemark.functions.wire import JSON, TYPED_LOGICAL_TYPES, SchemaConflict
from tidemark.operators import apply as applying
from tidemark.operators.apply import apply_batch, batch_stats, lag_stats
from tidemark.operators import replica as replicas
from tidemark.operators.replica import ConcurrentWrite, Replica, Version
from tidemark.sources.changes import RAW_SCHEMA


@pytest.fixture
def replica(spark, tmp_path):
    return Replica(spark, str(tmp_path / "replica"))


def send(replica, *messages, **options):
    batch = replica.spark.createDataFrame(list(messages), RAW_SCHEMA)
    r = apply_batch(replica, batch, **options)
    assert r.received == r.deduped + r.applied + r.stale
    return r.applied, r.stale, r.deduped


def held(replica):
    return {r.slot: (r.state, r._deleted, r._src_pos) for r in replica.read("readings").collect()}


# ---- positions decide, however changes arrive

#: Per slot: its changes as (op, state, log file, position, row), and the place in this list of the one that has to stay.
HISTORY = {
    0: ([("c", "raw", 11, 10, 0), ("u", "fixed", 11, 25, 0), ("u", "final", 11, 31, 0)], 2),
    1: ([("c", "raw", 11, 11, 0), ("d", "raw", 11, 40, 0)], 1),
    2: ([("d", "void", 11, 12, 0)], 0),
    3: ([("u", "low", 11, 50, 0), ("u", "high", 11, 50, 1)], 1),
    4: ([("u", "far", 11, 8_000, 0), ("u", "near", 12, 7, 0)], 1),
    5: ([("d", "raw", 11, 60, 0), ("c", "again", 11, 61, 0)], 1),
    6: ([("r", "snapshot", 10, 3, 0)], 0),
}
CHANGES = [
    change(op, reading(slot, state), pos, row=row, file=file, offset=100 * slot + n)
    for slot, (changes, _) in HISTORY.items()
    for n, (op, state, file, pos, row) in enumerate(changes)
]
STAYS = {slot: changes[last] for slot, (changes, last) in HISTORY.items()}


@pytest.mark.parametrize(
    "batches",
    [
        [CHANGES],
        [CHANGES[::-1], CHANGES],
        [CHANGES[1::2], CHANGES[::2] * 3, CHANGES[4:8]],
        [CHANGES[7:], CHANGES[:7]],
    ],
    ids=["at once", "backwards and again", "mixed with copies", "second half first"],
)
def test_every_delivery_ends_alike(replica, batches):
    """Once a slot has the change that stays, whatever comes is stale, later copies and creations after a delete too."""
    newest = {}
    for batch in batches:
        place = {m[4]: (m[4] // 100, HISTORY[m[4] // 100][0][m[4] % 100]) for m in batch}
        best = {}
        for slot, (*_, file, pos, row) in place.values():
            best[slot] = max(best.get(slot, (0, 0, 0)), (file, pos, row))
        won = {slot for slot, at in best.items() if at > newest.get(slot, (0, 0, 0))}
        assert send(replica, *batch) == (len(won), len(best) - len(won), len(batch) - len(best))
        newest |= {slot: best[slot] for slot in won}
    assert held(replica) == {slot: (state, op == "d", pos) for slot, (op, state, _, pos, _) in STAYS.items()}
    live = {r.slot: r.state for r in replica.live("readings").collect()}
    assert live == {slot: state for slot, (op, state, *_) in STAYS.items() if op != "d"}


def test_how_a_table_is_laid_out(replica):
    send(replica, change("c", reading(2, meter="south"), 9), change("c", reading(2), 10))
    assert replica.keys("readings") == ("meter", "slot") and replica.live("readings").count() == 2
    own = ["_src_file", "_src_pos", "_src_row", "_src_commit_at", "_deleted", "_applied_at"]
    fields = replica.schema("readings").fields
    assert [f.name for f in fields] == [f["field"] for f in FIRST] + own
    assert {f.name for f in fields if f.nullable} == {"kwh", "state", "taken", "ok"}


# ---- columns follow the newest changes


@pytest.mark.parametrize(
    ("batches", "notes"),
    [
        # New column: rows from before have none, and a row of the new version may have none.
        ([[(0, 1, None)], [(1, 2, "seen"), (2, 3, "")]], {0: None, 1: "seen", 2: ""}),
        ([[(0, 1, None), (1, 2, "seen")]], {0: None, 1: "seen"}),
        # A newer change that lacks the column clears it.
        ([[(0, 1, "seen")], [(0, 2, None)]], {0: None}),
        # Only a change that another one of its batch supersedes has the column.
        ([[(0, 1, "seen"), (0, 2, None)]], "no column"),
    ],
)
def test_a_column_that_comes_later(replica, batches, notes):
    for batch in batches:
        send(replica, *(
            change("u", reading(slot), pos) if note is None else change("u", reading(slot, note=note), pos, fields=LATER)
            for slot, pos, note in batch
        ))
    if notes == "no column":
        assert "note" not in replica.schema("readings").names
    else:
        assert {r.slot: r.note for r in replica.read("readings").collect()} == notes


def other(column, *, of=FIRST):
    """The table with another column in the place of the one of the same name."""
    return tuple(column if f["field"] == column["field"] else f for f in of)


@pytest.mark.parametrize(
    ("column", "kwh", "stored"),
    [
        (number("kwh", 3, 15), "123456789.5", {0: "0.375", 1: "123456789.500"}),  # more digits
        (number("kwh", 5, 9), "0.00001", {0: "0.37500", 1: "0.00001"}),  # finer: none of the old digits is lost
    ],
)
def test_decimals_only_widen(replica, column, kwh, stored):
    old = change("c", reading(0), 5)
    scale = int(column["parameters"]["scale"])
    send(replica, old)
    send(replica, change("c", reading(1) | {"kwh": digits(kwh, scale)}, 6, fields=other(column)))
    assert send(replica, old) == (0, 1, 0)  # its type is the narrow one
    assert {r.slot: str(r.kwh) for r in replica.read("readings").collect()} == stored


@pytest.mark.parametrize(
    ("column", "value"),
    [
        ({**STATE, "type": "int16", "name": None}, 3),
        ({**STATE, "name": "io.debezium.data.Json"}, "[]"),
        ({**KWH, "type": "float64", "name": None, "parameters": {}}, 0.5),
    ],
)
def test_other_types_stop_unless_superseded(replica, column, value):
    name = column["field"]
    odd = change("u", reading(0) | {name: value}, 20, fields=other(column))
    send(replica, odd, change("u", reading(0), 21))
    with pytest.raises(SchemaConflict, match=rf"readings\.{name} is kept as .* and comes as"):
        send(replica, change("u", reading(0) | {name: value}, 22, fields=other(column)))
    assert held(replica)[0][2] == 21 and replica.latest() == 1


def test_another_key_stops(replica):
    send(replica, change("c", reading(0), 1))
    with pytest.raises(SchemaConflict, match="key"):
        send(replica, change("c", reading(0), 2, keys=(METER, SLOT, STATE)))


def test_a_decimal_key_survives_widening(replica):
    def keyed(column, pos):
        image = reading(0) | {"kwh": digits("7.25", int(column["parameters"]["scale"]))}
        return change("u", image, pos, fields=other(column), keys=(column,))

    send(replica, keyed(KWH, 1))
    assert send(replica, keyed(number("kwh", 4, 16), 2)) == (1, 0, 0)
    assert send(replica, keyed(KWH, 1)) == (0, 1, 0)
    assert [r.kwh for r in replica.read("readings").collect()] == [Decimal("7.25")]


# ---- versions and writers


def test_all_tables_or_none(replica):
    def stop():
        raise RuntimeError("killed")

    both = [change("c", reading(1), 1), change("c", reading(1), 2, table="others")]
    with pytest.raises(RuntimeError, match="killed"):
        send(replica, *both, before_publish=stop)
    assert replica.tables() == [] and replica.latest() == 0
    assert send(replica, *both) == (2, 0, 0)
    assert replica.tables() == ["others", "readings"]
    assert batch_stats(replica).count() == 1


def test_a_second_writer_fails_loudly(replica):
    send(replica, change("c", reading(1), 1))
    with pytest.raises(ConcurrentWrite):
        replica.publish(Version(1, {}))


def test_a_writer_that_comes_second_harms_nothing(replica):
    send(replica, change("c", reading(1), 1))
    other = Replica(replica.spark, replica.path)

    def overtaken():
        send(other, change("u", reading(1, "first"), 2))

    with pytest.raises(ConcurrentWrite):
        send(replica, change("u", reading(1, "second"), 3), before_publish=overtaken)
    assert held(replica) == {1: ("first", False, 2)}
    send(replica, change("u", reading(1, "second"), 3))
    assert held(replica) == {1: ("second", False, 3)}
    assert len(replica.vacuum(keep_versions=10)) == 2  # its rows and its statistics


def losing(replica, *messages, **options):
    """A batch that another writer's batch overtakes just before it is published."""
    other_writer = Replica(replica.spark, replica.path)
    winner = [change("u", reading(0, "winner"), 50), change("u", reading(1, "winner"), 51)]
    with pytest.raises(ConcurrentWrite):
        send(replica, *messages, before_publish=lambda: send(other_writer, *winner, run_id="won"), run_id="lost")


def test_statistics_are_the_winners(replica):
    send(replica, change("c", reading(0), 1), run_id="first")
    losing(replica, change("u", reading(0, "loser"), 60))
    assert {(r.run_id, r.version, r.received) for r in batch_stats(replica).collect()} == {("first", 1, 1), ("won", 2, 2)}
    assert {r.run_id: r.n for r in lag_stats(replica).groupBy("run_id").agg({"n": "sum"}).toDF("run_id", "n").collect()} == {
        "first": 1, "won": 2
    }
    assert sorted(p.split("/")[0] for p in replica.vacuum()) == ["_stats", "readings"]


def test_a_failed_batch_leaves_no_statistics(replica):
    def stop():
        raise RuntimeError("killed")

    for n in range(4):
        send(replica, change("c", reading(n), n))
    with pytest.raises(RuntimeError):
        send(replica, change("c", reading(9), 9), before_publish=stop)
    assert replica.rewrite() == ["readings"] and replica.latest() == 5
    assert batch_stats(replica).count() == 4 and replica.read("readings").count() == 4


def test_publishing_never_replaces(replica, monkeypatch):
    """Another writer publishes between the writing of a draft and its getting its name."""
    send(replica, change("c", reading(0), 1))
    now, moved = replica.version(), Replica._moved
    theirs, mine = Version(2, now.tables, now.schemas, ("theirs",)), Version(2, now.tables, now.schemas, ("mine",))

    def late(self, *paths):
        monkeypatch.setattr(Replica, "_moved", moved)
        Replica(self.spark, self.path).publish(theirs)
        return moved(self, *paths)

    monkeypatch.setattr(Replica, "_moved", late)
    with pytest.raises(ConcurrentWrite):
        replica.publish(mine)
    assert replica.version() == theirs


def test_statistics_of_many_batches_become_one_directory(replica, monkeypatch):
    monkeypatch.setattr(applying, "STATS_JOINED", 3)
    named = []
    for n in range(7):
        send(replica, change("c", reading(n), n + 1))
        named.append(len(replica.version().stats))
    assert named == [1, 2, 1, 2, 3, 2, 3]
    assert sorted(r.version for r in batch_stats(replica).collect()) == list(range(1, 8))
    assert lag_stats(replica).agg({"n": "sum"}).first()[0] == 7


def test_too_many_versions_are_named(replica):
    with pytest.raises(SchemaConflict, match=r"more than 1 schema versions.*plant\.db\.readings"):
        send(replica, change("c", reading(0), 1), change("c", reading(1), 2, fields=LATER), max_versions=1)


def test_a_batch_of_tombstones(replica):
    topic, key, _, p, o = change("d", reading(1), 1)
    assert send(replica, (topic, key, None, p, o)) == (0, 0, 0)


def test_older_versions_stay_readable(replica):
    send(replica, change("c", reading(1, "old"), 1))
    send(replica, change("u", reading(1, "new"), 2))
    assert replica.read("readings", version=1).first().state == "old"
    assert replica.live("readings").first().state == "new"


def test_stored_rows_are_read_only_for_late_events(replica):
    send(replica, change("c", reading(1), 100))
    state = replica.version().tables["readings"]
    assert replica.stored("readings", state, [], (11, 101, 0)) is None
    late = replica.stored("readings", state, state.commits, (11, 100, 0))
    assert late.count() == 1
    plan = late.select("slot", "_src_file", "_src_pos", "_src_row")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(_src_pos,100)" in plan
    assert "state" not in plan.split("ReadSchema")[-1]


def test_a_small_batch_against_many_rows(replica):
    """Its keys are looked up first."""
    send(replica, *(change("c", reading(i, "old"), 100 + i) for i in range(60)))
    batch = [change("u", reading(1, "new"), 500), change("u", reading(2, "older"), 50), change("c", reading(99), 90)]
    assert send(replica, *batch) == (2, 1, 0)
    assert {held(replica)[i][0] for i in (1, 2, 99)} == {"new", "old", "raw"}


def test_an_ordered_log_reads_nothing_back(replica, monkeypatch):
    seen = []
    stored = Replica.stored
    monkeypatch.setattr(Replica, "stored", lambda *a: seen.append(stored(*a)) or seen[-1])
    send(replica, change("c", reading(1), 100))
    send(replica, change("u", reading(1, "b"), 200), change("c", reading(2), 210))
    send(replica, change("d", reading(1, "b"), 300))
    assert seen == [None, None, None]
    assert held(replica)[1][1] is True


def test_a_rewrite_keeps_the_rows(replica):
    for i in range(9):
        send(replica, change("c", reading(i), 100 + i), change("u", reading(0, f"v{i}"), 200 + i))
    before = sorted(replica.read("readings").collect())
    assert replica.rewrite() == ["readings"]
    assert len(replica.version().tables["readings"].commits) == 1
    assert sorted(replica.read("readings").collect()) == before
    assert replica.rewrite() == [] and replica.rewrite(["readings"]) == []
    assert len(replica.vacuum(keep_versions=1)) == 9
    assert sorted(replica.read("readings").collect()) == before


# ---- rows by bucket of their key


@pytest.fixture
def bucketed(spark, tmp_path, monkeypatch):
    """Ten rows or more make a bucket, sixteen buckets a commit."""
    monkeypatch.setattr(replicas, "BUCKET_ROWS", 10)
    return Replica(spark, str(tmp_path / "replica"), buckets=16)


def bucket_dirs(replica, slots):
    state = replica.version().tables["readings"]
    rows = replica.read("readings").select("slot", replicas.bucket_of(state, state.commits[0].buckets)).collect()
    return {bucket for slot, bucket in rows if slot in slots}


def test_large_commits_are_laid_out_by_bucket(bucketed):
    send(bucketed, *(change("c", reading(i), 100 + i) for i in range(170)), change("u", reading(3, "b"), 500))
    send(bucketed, *(change("u", reading(i, "c"), 600 + i) for i in range(25)))
    send(bucketed, change("u", reading(5, "d"), 700))
    first, second, third = bucketed.version().tables["readings"].commits
    assert (first.buckets, second.buckets, third.buckets) == (16, 2, 1)
    newest = bucketed._newest("readings", first)
    assert max(newest.values()) == first.newest == (11, 500, 0) and len(newest) > 12
    rows = held(bucketed)
    assert len(rows) == 170 and rows[5][0] == "d" and rows[24][0] == "c" and rows[25][0] == "raw"
    assert bucketed.rewrite() == ["readings"] and held(bucketed) == rows
    assert bucketed.version().tables["readings"].commits[0].buckets == 16


@pytest.mark.parametrize("tasks", [4, 6])
def test_a_replay_of_a_large_batch_changes_nothing(bucketed, tasks):
    """Whether or not the shuffle by key fits the buckets."""
    spark, conf = bucketed.spark, "spark.sql.shuffle.partitions"
    before = spark.conf.get(conf)
    spark.conf.set(conf, tasks)
    try:
        messages = [change("c", reading(i), 100 + i) for i in range(170)] + [change("u", reading(3, "b"), 500)]
        assert send(bucketed, *messages) == (170, 0, 1)
        rows = held(bucketed)
        assert send(bucketed, *messages) == (0, 170, 1)
        assert held(bucketed) == rows
        # Some stale, some not.
        assert send(bucketed, *messages, *(change("u", reading(i, "c"), 600 + i) for i in range(25))) == (25, 145, 26)
    finally:
        spark.conf.set(conf, before)


def test_rows_by_bucket_are_shuffled_once(bucketed, monkeypatch):
    """Also if the session's number of partitions isn't a power of two."""
    spark, conf, dealt = bucketed.spark, "spark.sql.shuffle.partitions", []
    before = spark.conf.get(conf)
    of = type(spark.range(1))
    repartition = of.repartition
    monkeypatch.setattr(of, "repartition", lambda df, *by: dealt.append(by) or repartition(df, *by))
    spark.conf.set(conf, 6)
    try:
        assert send(bucketed, *(change("c", reading(i), 100 + i) for i in range(170))) == (170, 0, 0)
        assert spark.conf.get(conf) == "6"
    finally:
        spark.conf.set(conf, before)
    (commit,) = bucketed.version().tables["readings"].commits
    assert commit.buckets == 16 and not dealt


def test_times_and_documents_by_bucket(bucketed):
    """Grouped in threads of a pool, also by what a key or a value of type TIME is beside."""
    spark = bucketed.spark
    spark.conf.set("spark.sql.timeType.enabled", "true")
    fields = (METER, SLOT, column("at", "int64", "io.debezium.time.MicroTime"), column("doc", "string", JSON))

    def message(i, pos):
        image = {"meter": "north", "slot": i, "at": i * 1_000_000, "doc": json.dumps({"i": i})}
        return change("c", image, pos, fields=fields)

    for on_bad in ("fail", "quarantine"):
        replica = Replica(spark, f"{bucketed.path}-{on_bad}", buckets=16)
        typed = {"logical_types": TYPED_LOGICAL_TYPES, "on_bad": on_bad}
        assert send(replica, *(message(i, 100 + i) for i in range(170)), **typed) == (170, 0, 0)
        assert send(replica, *(message(i, 101 + i) for i in range(0, 170, 2)), message(1, 1), **typed) == (85, 1, 0)
        rows = replica.read("readings").select("slot", "at", "_src_pos").collect()
        assert {(r.slot, r.at.second + 60 * r.at.minute, r._src_pos) for r in rows} == {
            (i, i, 101 + i - i % 2) for i in range(170)}


def test_a_late_event_opens_one_bucket(bucketed, monkeypatch):
    send(bucketed, *(change("c", reading(i), 100 + i) for i in range(170)))
    seen = []
    stored = Replica.stored
    monkeypatch.setattr(Replica, "stored", lambda *a: seen.append(stored(*a)) or seen[-1])
    # Its position lies before the first commit's newest, but not before that of its own key.
    assert send(bucketed, change("u", reading(7, "late"), 107)) == (0, 1, 0)
    (opened,) = seen
    (bucket,) = bucket_dirs(bucketed, [7])
    plan = opened._jdf.queryExecution().toString()
    assert re.search(rf"PartitionFilters: \[[^]]*_bucket#\d+ = {bucket}\)", plan)


def test_a_bucket_that_ends_before_an_event_stays_closed(bucketed, monkeypatch):
    send(bucketed, *(change("c", reading(i), 100) for i in range(160)), change("c", reading(160), 900))
    newest = bucket_dirs(bucketed, [160])
    other = next(i for i in range(160) if bucket_dirs(bucketed, [i]) != newest)
    seen = []
    stored = Replica.stored
    monkeypatch.setattr(Replica, "stored", lambda *a: seen.append(stored(*a)) or seen[-1])
    assert send(bucketed, change("u", reading(other, "new"), 200)) == (1, 0, 0)
    assert seen == [None]  # the commit reaches position 900, but not in that bucket
    assert held(bucketed)[other][0] == "new"


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 1, 0], [1, 2, 0], [0, 2, 1, 0]])
def test_buckets_of_any_number_guard_alike(bucketed, order):
    """Commits of 16, 4 and 1 buckets, in any order of delivery."""
    batches = [
        [change("c", reading(i, "a"), 100 + i) for i in range(165)],
        [change("u", reading(i, "b"), 150 + i) for i in range(0, 165, 4)],
        [change("d", reading(i, "c"), 260 + i) for i in range(3, 9)],
    ]
    for n in order:
        send(bucketed, *batches[n])
    want = {}
    for batch in batches:
        for topic, key, value, partition, offset in batch:
            payload = json.loads(value)["payload"]
            row = payload["after"] or payload["before"]
            have = want.get(row["slot"])
            if have is None or have[2] < payload["source"]["pos"]:
                want[row["slot"]] = (row["state"], payload["op"] == "d", payload["source"]["pos"])
    assert held(bucketed) == want


def test_the_bulk_of_a_table_is_not_shuffled_on_reading(bucketed):
    send(bucketed, *(change("c", reading(i), 100 + i) for i in range(170)))
    send(bucketed, *(change("u", reading(i, "c"), 600 + i) for i in range(25)))
    bucketed.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        live = bucketed.live("readings")
        live.collect()
        plan = live._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    finally:
        bucketed.spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---- versions


def test_versions_stay_small(replica):
    """Schema texts are files of their own, and the latest version is found without a list of all."""
    send(replica, change("c", reading(0), 1), change("c", reading(1), 2, fields=LATER))
    size = len(replica._get(replica._version_file(1)))
    assert size < 2_500 and len(replica.version().schemas) == 2
    texts = dict(replica.version().schemas)
    assert all(t[0] == "readings" and "slot" in t[1] for t in texts.values())
    send(replica, change("u", reading(0, "b"), 3))
    assert dict(Replica(replica.spark, replica.path).version().schemas) == texts


def test_the_latest_version_needs_no_right_hint(replica):
    for n in range(4):
        send(replica, change("c", reading(n), n + 1))
    for hint in ("1", "", "x", "77"):
        replica._put(f"{replica._versions}/_latest", hint, True)
        assert Replica(replica.spark, replica.path).latest() == 4
    replica._put(f"{replica._versions}/_latest", "1", True)
    replica.vacuum(keep_versions=1)
    assert replica.latest() == 4 and len(held(replica)) == 4


# ---- many tables in a batch


def test_many_tables_in_one_pass(replica, monkeypatch):
    """One look at the messages for all tables, whatever their number."""
    summaries = []
    summary = applying.batch_summary
    monkeypatch.setattr(applying, "batch_summary", lambda *a: summaries.append(summary(*a)) or summaries[-1])
    monkeypatch.setattr(applying, "_summary", lambda *a: pytest.fail("a table of its own was looked at"))
    tables = [f"meter{i}" for i in range(12)]
    batch = [change("c", reading(k), 10 * n + k, table=t) for n, t in enumerate(tables) for k in range(n + 1)]
    assert send(replica, *batch) == (78, 0, 0)
    assert send(replica, *batch[:40], *batch[:40]) == (0, 40, 40)
    assert len(summaries) == 2
    assert [replica.read(t).count() for t in tables] == [n + 1 for n in range(12)]


_LARGE = """
import sys
from pyspark.sql import SparkSession, functions as F
from tests.messages import change, reading
from tidemark.operators.apply import apply_batch
from tidemark.operators.replica import Replica

path, memory = sys.argv[1:]
spark = (SparkSession.builder.master("local[2]").config("spark.driver.memory", memory).config("spark.local.dir", path)
         .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate())
topic, key, value, _, _ = change("u", reading(1), 0, query="q" * 4_000)
n = F.col("id")
messages = spark.range(0, 200_000, 1, 2).select(
    F.lit(topic).alias("topic"), F.lit(key).alias("key"),
    F.replace(F.lit(value), F.lit('"pos":0'), F.concat(F.lit('"pos":'), n.cast("string"))).alias("value"),
    F.lit(0).alias("partition"), n.alias("offset"))
replica = Replica(spark, path + "/replica")
r = apply_batch(replica, messages)
assert (r.received, r.deduped, r.applied, r.stale) == (200_000, 199_999, 1, 0), r
assert [x._src_pos for x in replica.read("readings").collect()] == [199_999]
spark.stop()
"""


def test_a_batch_needs_no_memory_for_its_messages(tmp_path):
    """Nearly 1 GB of messages in two tasks, with 700 MB for both."""
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_", "SPARK_"))}
    env |= {"PYTHONPATH": str(Path(__file__).parents[1])}
    ran = subprocess.run([sys.executable, "-c", _LARGE, str(tmp_path), "700m"], env=env, capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0, ran.stderr[-3_000:]
    assert not list(Path(tmp_path, "replica", "_scratch").glob("*"))


#: Tables with the same columns, of names that paths don't take as they are, and two with others.
LIKE = ["north", "south", "east 1%41=ü"]
PLANT = [
    change(op, reading(slot, state, meter=f"m{slot}"), pos, file=file, table=t, offset=1_000 * n + i, fields=f)
    for n, (t, f) in enumerate([*((t, FIRST) for t in LIKE), ("newer", LATER), ("later", LATER)])
    for i, (op, slot, state, file, pos) in enumerate(
        [("c", 1, "raw", 11, 10 + n), ("u", 1, "fixed", 11, 20 + n), ("c", 2, "raw", 11, 30), ("d", 2, "raw", 12, 5 - n // 2),
         ("u", 3 + n, "late", 11, 40), ("u", 1, "old", 11, 15)]
    )
]


@pytest.mark.parametrize(
    "batches, many_stored",
    [
        ([PLANT[1::2], PLANT[::2] * 2], 4),
        ([PLANT[9:][::-1], PLANT], 0),
    ],
)
def test_tables_that_are_alike_end_as_by_themselves(spark, tmp_path, monkeypatch, batches, many_stored):
    monkeypatch.setattr(applying, "MUCH_LARGER", many_stored)
    ends = []
    for most in (applying.ONE_TASK, 0):
        monkeypatch.setattr(applying, "ONE_TASK", most)
        replica = Replica(spark, str(tmp_path / f"of-{most}"))
        counts = [send(replica, *batch) for batch in batches]
        rows = {t: sorted(map(str, replica.read(t).drop("_applied_at").collect())) for t in replica.tables()}
        kept = {t: [c.rows for c in s.commits] for t, s in replica.version().tables.items()}
        bytes_ = {t: [(c.newest, c.key_bytes) for c in s.commits] for t, s in replica.version().tables.items()}
        stats = [r[1:] for r in batch_stats(replica).select("version", "received", "deduped", "applied", "stale", "ops").orderBy("version").collect()]
        ends.append((counts, rows, kept, bytes_, stats))
    assert ends[0] == ends[1]
    assert sorted(ends[0][1]) == sorted([*LIKE, "newer", "later"])


def test_tables_that_are_alike_share_jobs(replica, monkeypatch):
    """However many they are; a table of other columns goes by itself, and so does a large one."""
    groups, own = [], []
    alike, by_itself = applying._Batch._apply_alike, applying._Batch._apply_table
    monkeypatch.setattr(
        applying._Batch, "_apply_alike", lambda self, p, g: groups.append(sorted(a.table for a in g)) or alike(self, p, g))
    monkeypatch.setattr(
        applying._Batch, "_apply_table", lambda self, n, *a: own.append(n) or by_itself(self, n, *a))
    monkeypatch.setattr(applying, "ONE_TASK", 6)
    wide = [change("c", reading(k), 90 + k, table="south", offset=9_000 + k) for k in range(30, 40)]
    other = change("c", {"meter": "x", "slot": 1}, 7, table="other", fields=(METER, SLOT))
    send(replica, *PLANT, *wide, other)
    assert sorted(groups) == sorted([sorted(set(LIKE) - {"south"}), ["later", "newer"]])
    assert sorted(own) == ["other", "south"]
    assert [len(list(Path(replica.path.removeprefix("file:"), "later").glob("_commit=*/*.parquet")))] == [1]
    assert not list(Path(replica.path.removeprefix("file:"), "_scratch").glob("*"))


def test_a_schema_that_moves_on_leaves_its_group(replica):
    """Tables are alike by what they become, not only by what comes."""
    send(replica, *(change("c", reading(1), n, table=t) for n, t in enumerate(["a", "b", "c"])))
    send(replica, change("u", reading(1) | {"note": "n"}, 50, table="c", fields=LATER))
    assert send(replica, *(change("u", reading(2), 60 + n, table=t) for n, t in enumerate(["a", "b", "c"]))) == (3, 0, 0)
    assert "note" not in replica.read("a").columns
    assert {(r.slot, r.note) for r in replica.read("c").collect()} == {(1, "n"), (2, None)}


def test_statistics(replica):
    send(replica, change("r", reading(1), 1), change("c", reading(2), 2, ts_us=COMMIT_US), change("d", reading(2), 3, ts_us=COMMIT_US),
         run_id="one", consumer_id="c1")
    send(replica, change("c", reading(2), 2, ts_us=COMMIT_US), run_id="one", consumer_id="c2")
    first, second = batch_stats(replica).orderBy("version").collect()
    assert (first.received, first.deduped, first.applied, first.stale) == (3, 1, 2, 0)
    assert first.ops == {"r": 1, "c": 1, "d": 1}
    assert (second.received, second.deduped, second.applied, second.stale) == (1, 0, 0, 1)
    lags = lag_stats(replica).collect()
    assert sum(r.n for r in lags) == 3  # snapshot rows do not count
    assert all(r.lag_ms > 0 for r in lags)
    assert first.started_at <= first.updated_at <= datetime.now()


# ---- any order, repetition and batching leads to the same replica


@st.composite
def deliveries(draw):
    n = draw(st.integers(4, 10))
    log = []
    for pos in range(n):
        key = draw(st.integers(1, 3))
        op = draw(st.sampled_from("cud"))
        fields = LATER if pos > n // 2 else FIRST
        more = {"note": f"t{pos}"} if fields is LATER else {}
        log.append(change(op, reading(key, f"v{pos}", **more), pos, fields=fields))
    delivered = draw(st.permutations(log + draw(st.lists(st.sampled_from(log), max_size=3))))
    cut = draw(st.integers(1, len(delivered)))
    return log, [b for b in (delivered[:cut], delivered[cut:]) if b]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(deliveries())
def test_delivery_does_not_matter(spark, tmp_path_factory, delivery):
    log, batches = delivery
    shuffled = Replica(spark, str(tmp_path_factory.mktemp("a") / "r"))
    for b in batches:
        send(shuffled, *b)
    newest = {}
    for topic, key, value, p, o in log:
        payload = json.loads(value)["payload"]
        image = payload["before"] or payload["after"]
        newest[image["slot"]] = (image["state"], image.get("note"), payload["op"] == "d", o)
    rows = shuffled.read("readings")
    got = {r.slot: (r.state, r.asDict().get("note"), r._deleted, r._src_pos) for r in rows.collect()}
    assert got == newest
