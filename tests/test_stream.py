from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.messages import LATER, change, reading
from tidemark.operators.apply import (
    apply_batch,
    apply_events,
    bad_messages,
    batch_stats,
    run_report,
    write_report,
)
from tidemark.operators.merge import drop_stale, stored_for
from tidemark.operators.reduce import latest_state, newest_per_key
from tidemark.operators.replica import Replica
from tidemark.operators.schema import version_of
from tidemark.operators.stats import run_summary
from tidemark.operators.verify import consumer_lag, verify, verify_examples
from tidemark.sources.changes import RAW_SCHEMA, read_changes, snapshot_events
from tidemark.streaming.runner import progress_offsets, run_state_stream, run_stream, wait_caught_up


@pytest.fixture
def place(spark, tmp_path):
    """Delivers messages as files, and runs the stream over them."""

    class Place:
        messages = tmp_path / "messages"
        replica = Replica(spark, str(tmp_path / "replica"))
        n = 0

        def deliver(self, *batch):
            Place.n += 1
            df = spark.createDataFrame(list(batch), RAW_SCHEMA).coalesce(1)
            df.write.mode("append").parquet(str(self.messages))

        def run(self, **options):
            source = read_changes(spark, str(self.messages), streaming=True, max_per_trigger=1)
            query = run_stream(source, self.replica, str(tmp_path / "progress"), **options)
            query.awaitTermination()

    return Place()


def log(n):
    """Changes of two tables, a column added halfway."""
    out = []
    for pos in range(1, n + 1):
        key = pos * 7 % 5
        op = "d" if pos % 6 == 0 else "u"
        late = pos > n // 2
        image = reading(key, f"v{pos}", **({"note": f"t{pos}"} if late else {}))
        fields = {"fields": LATER} if late else {}
        out.append(change(op, image, pos, table=("readings", "others")[pos % 2], **fields))
    return out


def expected(messages):
    import json

    state = {}
    for topic, _, value, _, pos in messages:
        payload = json.loads(value)["payload"]
        image = payload["before"] or payload["after"]
        key = (topic.rsplit(".", 1)[1], image["slot"])
        if key not in state or state[key][-1] < pos:
            state[key] = (image["state"], image.get("note"), payload["op"] == "d", pos)
    return state


def actual(replica):
    return {
        (t, r.slot): (r.state, r.note, r._deleted, r._src_pos)
        for t in replica.tables()
        for r in replica.read(t).collect()
    }


def test_a_schema_change_mid_stream(place):
    messages = log(24)
    for start in range(0, 24, 6):
        place.deliver(*messages[start : start + 6])
    place.run(run_id="r", consumer_id="one")
    assert actual(place.replica) == expected(messages)
    totals = run_summary(batch_stats(place.replica)).first()
    assert (totals.batches, totals.received, totals.stale) == (4, 24, 0)

    place.deliver(*messages[3:9])  # sent again by the source
    place.run(run_id="r", consumer_id="two")
    assert actual(place.replica) == expected(messages)
    totals = run_summary(batch_stats(place.replica)).first()
    assert (totals.received, totals.consumers) == (30, 2) and totals.stale > 0


class Killed(RuntimeError):
    pass


def killer():
    """Kills the second batch."""
    calls = []

    def kill(*_):
        calls.append(1)
        if len(calls) == 2:
            raise Killed

    return kill


@pytest.mark.parametrize("point", ["before_publish", "after_publish"])
def test_killed_and_restarted(place, point):
    """Before the publish nothing of the batch is visible, and it is applied again. After it the batch
    comes again and is stale as a whole."""
    messages = log(18)
    for start in range(0, 18, 6):
        place.deliver(*messages[start : start + 6])
    with pytest.raises(Exception, match="Killed"):
        place.run(**{point: killer()})
    visible = batch_stats(place.replica).count()
    assert visible == (1 if point == "before_publish" else 2)
    place.run()
    assert actual(place.replica) == expected(messages)
    stale = run_summary(batch_stats(place.replica)).first().stale
    assert (stale > 0) == (point == "after_publish")


def test_a_lost_checkpoint_is_harmless(place, spark, tmp_path):
    messages = log(12)
    place.deliver(*messages[:6])
    place.deliver(*messages[6:])
    place.run()
    source = read_changes(spark, str(place.messages), streaming=True)
    run_stream(source, place.replica, str(tmp_path / "other")).awaitTermination()
    assert actual(place.replica) == expected(messages)


def test_reports(place, spark, tmp_path):
    messages = log(12)
    place.deliver(*messages)
    place.run(run_id="r7")
    sources = {t: place.replica.live(t) for t in ("readings", "others")}
    reports = verify(place.replica, sources, {"readings": ["meter", "slot"], "others": ["meter", "slot"]})
    keys = {"readings": ["meter", "slot"], "others": ["meter", "slot"]}
    more = {**sources, "gone": sources["others"]}
    examples = verify_examples(place.replica, more, {**keys, "gone": ["slot"]}, n=1)
    report = run_report(place.replica, "r7", reports, examples)
    assert [(e["table"], e["kind"]) for e in report["examples"]] == [("gone", "missing")]
    assert report["totals"]["received"] == 12 and report["all_ok"]
    assert sum(report["events_by_op"].values()) == report["lag_ms"]["events"] == 12
    write_report(place.replica, report, str(tmp_path / "report"))
    assert '"run_id": "r7"' in spark.read.text(str(tmp_path / "report")).first()[0]
    assert place.replica.create_views("now_") == ["now_others", "now_readings"]
    assert set(spark.table("now_readings").columns) == {f["field"] for f in LATER}


def cut(message, n=25):
    return (*message[:2], message[2][:-n], *message[3:])


def poisoned():
    """Good changes, and one of each kind that can't be decoded, by offset."""
    bad = [
        cut(change("u", reading(1), 11)),
        change("x", reading(2), 12),
        change("u", reading(3, kwh="9999999.5"), 13),
        change("u", reading(4, taken="yesterday"), 14),
        change("u", reading(5) | {"slot": "five"}, 15),
        change("u", None, 16),
        change("u", reading(7), 17, keys=()),
        ("plant.db.readings", None, "no message at all", 0, 18),
        change("u", reading(9, note=1), 19, fields=LATER, file=0),
    ]
    whys = [
        "broken JSON", "unsupported op x", "kwh does not fit decimal(9,3)", "taken does not fit timestamp",
        "broken JSON", "no row image", "unusable schema", "unusable schema", None,
    ]
    return bad, dict(zip(range(11, 20), whys, strict=True))


def test_bad_messages_are_set_apart(place, spark):
    bad, whys = poisoned()
    good = [change("c", reading(i), 100 + i) for i in range(20, 24)]
    place.deliver(*good[:2], *bad, *bad[:2])
    place.deliver(*good[2:], change("u", reading(20, "new", note="x"), 200, fields=LATER))
    with pytest.raises(Exception, match="plant.db.readings|unsupported|schema|MALFORMED|cut"):
        place.run()
    place.run(run_id="q", on_bad="quarantine")
    rows = {r.slot: r.state for r in place.replica.live("readings").collect()}
    assert rows == {9: "raw", 20: "new", 21: "raw", 22: "raw", 23: "raw"}
    apart = {r.offset: r for r in bad_messages(place.replica).collect()}
    assert set(apart) == {at for at, why in whys.items() if why}
    assert all(why in apart[at].why for at, why in whys.items() if why), apart
    by_offset = {m[4]: m for m in bad}
    assert all((r.topic, r.key, r.value) == by_offset[at][:3] for at, r in apart.items())
    totals = run_summary(batch_stats(place.replica)).first()
    assert (totals.received, totals.bad) == (6, 10)


def test_superseded_versions_and_bad_messages(spark, tmp_path):
    """Versions none of whose events survives only count, and their bad messages are still set apart."""
    replica = Replica(spark, str(tmp_path / "replica"))
    batch = [
        change("c", reading(1, "a"), 1),
        change("x", reading(2, "a"), 2),
        change("u", reading(1, "b", note="n"), 3, fields=LATER),
        cut(change("u", reading(3, "b", note="n"), 4, fields=LATER)),
    ]
    result = apply_batch(replica, spark.createDataFrame(batch, RAW_SCHEMA), on_bad="quarantine")
    assert (result.received, result.deduped, result.applied, result.bad) == (2, 1, 1, 2)
    assert sorted(r.offset for r in bad_messages(replica).collect()) == [2, 4]
    only_bad = spark.createDataFrame([cut(change("c", reading(8), 9))], RAW_SCHEMA)
    assert apply_batch(replica, only_bad, on_bad="quarantine").bad == 1
    assert {r.slot: r.note for r in replica.live("readings").collect()} == {1: "n"}


def test_state_kept_by_the_stream(spark, tmp_path):
    rows = [(pos % 3, f"v{pos}", "u", 1, pos, 0, False) for pos in range(20)]
    names = "id int, name string, _op string, _src_file int, _src_pos long, _src_row int, _deleted boolean"
    events = spark.createDataFrame(rows, names).withColumn("_src_commit_at", F.timestamp_micros(F.lit(0)))
    for part in (events.where("_src_pos >= 10"), events.where("_src_pos < 10")):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "events"))
    replica = Replica(spark, str(tmp_path / "state"))
    for progress in ("progress", "another"):  # a lost checkpoint changes nothing
        run_state_stream(stream, ("id",), replica, "named", str(tmp_path / progress)).awaitTermination()
        assert {(r.id, r.name) for r in replica.live("named").collect()} == {(0, "v18"), (1, "v19"), (2, "v17")}
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) or "")


def test_waiting_until_caught_up(place, spark, tmp_path):
    """The stream starts before there is a directory; a marker arrives with a second file."""
    source = read_changes(spark, str(place.messages), streaming=True)
    query = run_stream(source, place.replica, str(tmp_path / "progress"), trigger={"processingTime": "1 second"})
    try:
        marker = spark.createDataFrame([(77,)], "slot int")
        place.deliver(change("c", reading(1), 5))
        with pytest.raises(TimeoutError, match="1 of 1 markers"):
            wait_caught_up(query, place.replica, "readings", marker, 1, key="slot")
        place.deliver(change("c", reading(77), 6))
        wait_caught_up(query, place.replica, "readings", marker, 90, key="slot")
        assert {r.slot for r in place.replica.live("readings").collect()} == {1, 77}
    finally:
        query.stop()


def test_offsets_out_of_the_progress(spark):
    kafka = SimpleNamespace(latestOffset='{"a.t":{"0":9,"1":4}}', endOffset='{"a.t":{"0":7}}')
    files = SimpleNamespace(latestOffset="null", endOffset='{"logOffset":3}')
    high, committed = progress_offsets(spark, SimpleNamespace(sources=[kafka, files]))
    assert consumer_lag(high, committed).first().lag == 6
    assert consumer_lag(*progress_offsets(spark, None)).first().lag == 0


def test_a_snapshot_of_typed_rows(spark, tmp_path):
    replica = Replica(spark, str(tmp_path / "replica"))
    batch = spark.createDataFrame([change("u", reading(1, "new"), 500)], RAW_SCHEMA)
    apply_batch(replica, batch)
    rows = replica.live("readings").union(replica.live("readings").withColumn("slot", F.col("slot") + 1))
    before = rows.withColumn("state", F.lit("old"))
    events = snapshot_events(before, ["meter", "slot"], (11, 100, 0))
    result = apply_events(replica, {"readings": (events, version_of("readings", before.schema, ["meter", "slot"]))})
    assert (result.applied, result.stale, result.ops) == (1, 1, {"r": 2})
    assert {r.slot: r.state for r in replica.live("readings").collect()} == {1: "new", 2: "old"}


# ---- plans


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    events = spark.sql("select if(id % 3 = 0, 0, id) as k, 1 as _src_file, id as _src_pos, 0 as _src_row from range(9000)")
    newest = newest_per_key(events, ["k"])
    assert newest.where("k = 0").first()._src_pos == 8997
    plan = plan_of(newest).split("Initial Plan")[0]
    top, below = plan.split("Exchange", 1)
    assert "WindowGroupLimit" in top and "WindowGroupLimit" in below
    assert sorted(latest_state(events, ["k"]).collect()) == sorted(newest.collect())


@pytest.mark.parametrize("key_bytes", [1 << 40, 100])
def test_the_guard_shuffles_each_side_once(spark, key_bytes):
    """Without broadcasts, as with large tables: the staged rows stay where the ranking put them."""
    sql = "select id as k, 1 as _src_file, {} as _src_pos, 0 as _src_row, 'x' as wide from range({})"
    stored = spark.sql(sql.format("if(id < 20, 5, 50)", 100)).union(spark.sql(sql.format("7", 10)))
    events = spark.sql(sql.format("10", 60))
    staged = newest_per_key(events, ["k"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        fresh = drop_stale(staged, stored_for(events, stored, ["k"], key_bytes), ["k"])
        assert sorted(r.k for r in fresh.collect()) == list(range(20))
        plan = plan_of(fresh).split("Initial Plan")[0]
        assert "SortMergeJoin" in plan and plan.count("Window [row_number") == 1
        if key_bytes == 100:
            assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
        else:
            assert plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
