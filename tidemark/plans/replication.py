"""Queries on replicas: guarded merge, replays, late and reordered batches, schema changes, streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.text import field_text
from tidemark.functions.wire import JSON, MICROS_PER_DAY, TYPED_LOGICAL_TYPES
from tidemark.operators.apply import apply_batch, apply_events, bad_messages, batch_stats, lag_stats
from tidemark.operators.decode import BROKEN_JSON
from tidemark.operators.merge import guarded_merge, live_view, merge_counts
from tidemark.operators.reduce import newest_per_key
from tidemark.operators.replica import Replica
from tidemark.operators.schema import version_of
from tidemark.operators.snapshot import key_ranges, snapshot_in_chunks as take_chunks
from tidemark.operators.stats import run_ops, run_summary
from tidemark.operators.verify import verify
from tidemark.plans.decoding import (
    ACTIVITY_COLUMNS,
    ACTIVITY_STATE,
    ORDER_COLUMNS,
    ORDERING_STATE,
    activity_messages,
    order_messages,
    places,
    shipping_messages,
    two_versions,
)
from tidemark.plans.feeds import (
    ACTIVITY_KEYS,
    ACTIVITY_SQL,
    ORDERING_KEYS,
    ORDERING_SQL,
    SHIPPING_SQL,
    activity,
    newest_sql,
    ordering,
    table,
)
from tidemark.plans.registry import query
from tidemark.plans.workspace import fresh_dir
from tidemark.sources.changes import read_changes, snapshot_events
from tidemark.sources.feeds import encode
from tidemark.streaming.runner import run_state_stream, run_stream
from tidemark.streaming.state import verify_state

NEWEST_ORDERS = newest_sql("ordering", "o_orderkey")
NEWEST_ACTIVITY = newest_sql("activity", "user_id")


def new_replica(spark: SparkSession, name: str) -> Replica:
    return Replica(spark, fresh_dir(spark, name))


def order_state(rows: DataFrame) -> DataFrame:
    return rows.select(*ORDER_COLUMNS, *places())


def only(events: DataFrame, *ops: str) -> DataFrame:
    return events.where(F.col("_op").isin(*ops))


def _messages(events: DataFrame) -> DataFrame:
    return encode(events, "orders", ORDERING_KEYS)


# ---- the merge as a plain query


@query(f"WITH {ORDERING_SQL} SELECT {ORDERING_STATE} FROM {NEWEST_ORDERS}")
def guarded_merge_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the orders after their updates. Staged: the newest of creations and deletions, so some
    staged rows are older than the target's."""
    events = ordering(spark, sf_dir)
    target = newest_per_key(only(events, "c", "u"), ORDERING_KEYS)
    staged = newest_per_key(only(events, "c", "d"), ORDERING_KEYS)
    return order_state(guarded_merge(target, staged, ORDERING_KEYS))


@query(
    f"""WITH {ORDERING_SQL}
    SELECT count(*) FILTER (staged > target) AS applied, count(*) FILTER (staged <= target) AS stale
    FROM (SELECT o_orderkey, max(p) FILTER (op IN ('c', 'd')) AS staged, max(p) FILTER (op IN ('c', 'u')) AS target
          FROM ordering GROUP BY o_orderkey)"""
)
def guarded_merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = ordering(spark, sf_dir)
    target = newest_per_key(only(events, "c", "u"), ORDERING_KEYS)
    staged = newest_per_key(only(events, "c", "d"), ORDERING_KEYS)
    return merge_counts(target, staged, ORDERING_KEYS)


# ---- replicas


@query(f"WITH {ORDERING_SQL} SELECT {ORDERING_STATE} FROM {NEWEST_ORDERS}")
def guarded_merge_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping batches."""
    events = ordering(spark, sf_dir)
    replica = new_replica(spark, "merge")
    apply_batch(replica, _messages(only(events, "c", "u")))
    apply_batch(replica, _messages(only(events, "u", "d")))
    return order_state(replica.read("orders"))


_COUNTS = "CAST({} AS BIGINT) AS received, CAST({} AS BIGINT) AS deduped, CAST({} AS BIGINT) AS applied, CAST({} AS BIGINT) AS stale"


@query(
    f"""WITH {ORDERING_SQL},
    n AS (SELECT count(*) AS events, count(DISTINCT o_orderkey) AS keys FROM ordering)
    SELECT 1::BIGINT AS batch, {_COUNTS.format('events', 'events - keys', 'keys', '0')} FROM n
    UNION ALL
    SELECT 2::BIGINT, {_COUNTS.format('events', 'events - keys', '0', 'keys')} FROM n"""
)
def replay_is_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    replica = new_replica(spark, "replay")
    messages = order_messages(spark, sf_dir)
    apply_batch(replica, messages)
    apply_batch(replica, messages)
    return _counters(replica)


def _counters(replica: Replica) -> DataFrame:
    return batch_stats(replica).select(
        F.col("version").alias("batch"), "received", "deduped", "applied", "stale"
    )


@query(f"WITH {ORDERING_SQL} SELECT {ORDERING_STATE} FROM {NEWEST_ORDERS}")
def out_of_order_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletions first, creations last."""
    events = ordering(spark, sf_dir)
    replica = new_replica(spark, "reordered")
    for op in ("d", "u", "c"):
        apply_batch(replica, _messages(only(events, op)))
    return order_state(replica.read("orders"))


@query(
    f"""WITH {ORDERING_SQL} SELECT o_orderkey, o_orderstatus, f, p
    FROM {NEWEST_ORDERS} WHERE op = 'd'"""
)
def soft_delete_blocks_resurrection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All creations come again after the deletions."""
    events = ordering(spark, sf_dir)
    replica = new_replica(spark, "resurrection")
    apply_batch(replica, _messages(events))
    apply_batch(replica, _messages(only(events, "c")))
    deleted = replica.read("orders").where("_deleted")
    return deleted.select("o_orderkey", "o_orderstatus", *places()[:2])


@query(
    f"WITH {ORDERING_SQL} SELECT {', '.join(ORDER_COLUMNS)} FROM {NEWEST_ORDERS} WHERE op <> 'd'",
    name="live_view",
)
def live_view_of_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    replica = new_replica(spark, "live")
    apply_batch(replica, order_messages(spark, sf_dir))
    return replica.live("orders")


@query(f"WITH {ACTIVITY_SQL} SELECT {ACTIVITY_STATE} FROM {NEWEST_ACTIVITY}")
def folded_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch per two days of the week, then the table as one commit."""
    replica = _by_weekday(spark, sf_dir)
    replica.rewrite()
    return replica.read("activity").select(*ACTIVITY_COLUMNS, *places())


def _by_weekday(spark: SparkSession, sf_dir: str) -> Replica:
    """Two days of the week are a batch, so the log comes out of order. Two consumers share the four."""
    replica = new_replica(spark, "by-weekday")
    for n in range(4):
        events = activity(spark, sf_dir).where(F.floor(F.weekday("ts") / 2) == n)
        messages = encode(events, "activity", ACTIVITY_KEYS)
        apply_batch(replica, messages, run_id="r1", consumer_id="c1" if n < 2 else "c2")
    return replica


_BATCHES = f"""{ACTIVITY_SQL},
    numbered AS (SELECT *, (isodow(ts) + 1) // 2 AS batch,
                        f * 1000000000000 + p AS pos FROM activity),
    staged AS (SELECT batch, user_id, max(pos) AS pos, count(*) AS n FROM numbered GROUP BY ALL),
    guarded AS (SELECT *, max(pos) OVER (PARTITION BY user_id ORDER BY batch
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stored FROM staged),
    counted AS (
      SELECT batch, sum(n) AS received, sum(n - 1) AS deduped,
             count(*) FILTER (stored IS NULL OR stored < pos) AS applied,
             count(*) FILTER (stored >= pos) AS stale
      FROM guarded GROUP BY batch)"""


@query(
    f"""WITH {_BATCHES}
    SELECT CAST(batch AS BIGINT) AS batch, {_COUNTS.format('received', 'deduped', 'applied', 'stale')} FROM counted"""
)
def batch_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counters(_by_weekday(spark, sf_dir))


@query(
    f"""WITH {_BATCHES}
    SELECT 'r1' AS run_id, CAST(2 AS BIGINT) AS consumers, count(*) AS batches,
           {_COUNTS.format('sum(received)', 'sum(deduped)', 'sum(applied)', 'sum(stale)')} FROM counted""",
    name="run_summary",
)
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = run_summary(batch_stats(_by_weekday(spark, sf_dir)))
    return summary.drop("started_at", "updated_at", "bad")


@query(f"WITH {ACTIVITY_SQL} SELECT 'r1' AS run_id, op, count(*) AS n FROM activity GROUP BY op")
def run_ops_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_ops(batch_stats(_by_weekday(spark, sf_dir)))


@query(
    """SELECT CASE WHEN isodow(ts) <= 4 THEN 'c1' ELSE 'c2' END AS consumer_id,
              count(*) AS events FROM events GROUP BY ALL"""
)
def run_lag_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is in its run's lag histogram (the lags themselves depend on the clock)."""
    lags = lag_stats(_by_weekday(spark, sf_dir))
    return lags.groupBy("consumer_id").agg(F.sum("n").alias("events"))


@query(
    """WITH balances AS (
      SELECT c_custkey, c_mktsegment, CAST(round(c_acctbal, 2) AS DECIMAL(12,2)) AS balance, 1 AS f, CAST(0 AS BIGINT) AS p
      FROM customer
      UNION ALL
      SELECT o_custkey, o_orderpriority, CAST(round(o_totalprice, 2) AS DECIMAL(12,2)), CAST(year(o_orderdate) AS INTEGER), o_orderkey
      FROM orders)
    SELECT c_custkey, c_mktsegment, balance, f, p FROM balances
    QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY f DESC, p DESC) = 1"""
)
def snapshot_then_stream_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream is applied first; the snapshot it started from comes later and only adds the rows
    the stream did not touch."""
    keys = ("c_custkey",)
    orders = table(spark, sf_dir, "orders")
    stream = orders.select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderpriority").alias("c_mktsegment"),
        F.round("o_totalprice", 2).cast("decimal(12,2)").alias("balance"),
        F.lit("u").alias("_op"),
        F.year("o_orderdate").alias("_src_file"),
        F.col("o_orderkey").alias("_src_pos"),
        F.lit(0).alias("_src_row"),
        F.col("o_orderdate").cast("timestamp").alias("_src_commit_at"),
    )
    before = table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_mktsegment",
        F.round("c_acctbal", 2).cast("decimal(12,2)").alias("balance"),
    )
    replica = new_replica(spark, "snapshot")
    apply_batch(replica, encode(stream, "customer", keys))
    events = snapshot_events(before, keys, (1, 0, 0))
    apply_events(replica, {"customer": (events, version_of("customer", before.schema, keys))})
    rows = replica.read("customer")
    return rows.select("c_custkey", "c_mktsegment", "balance", *places()[:2])


# Where the log begins (a log file), and where it stands when the chunks of a snapshot are read.
_LOG_FROM, _LOG_AT = 4, (4, 5, 7, 8)


@query(
    f"""WITH {ORDERING_SQL}
    SELECT {', '.join(ORDER_COLUMNS)}, op = 'd' AS deleted FROM {NEWEST_ORDERS}
    WHERE NOT (op = 'd' AND f <= {_LOG_FROM})"""
)
def snapshot_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four ranges of orders, read while the log moves on from file to file; its batches are applied in between. What happened
    before the log begins is known from the rows alone."""
    events = ordering(spark, sf_dir)
    replica, log = new_replica(spark, "chunks"), iter((*_LOG_AT[1:], 99))
    now = _LOG_FROM

    def position() -> tuple[int, int, int]:
        return (now, 1 << 62, 0)

    def read(condition: Column) -> DataFrame:
        # The log moves on while a chunk is read, so some rows are ahead of the position that was noted.
        nonlocal now
        now += 1
        happened = newest_per_key(events.where(F.col("_src_file") <= now), ORDERING_KEYS)
        return live_view(happened, ORDER_COLUMNS).where(condition)

    def moved(after: tuple[int, int, int], upto: tuple[int, int, int]) -> DataFrame:
        return events.where((F.col("_src_file") > after[0]) & (F.col("_src_file") <= upto[0]))

    def apply_log() -> None:
        nonlocal now
        before, now = now, max(now, next(log))
        apply_batch(replica, _messages(events.where((F.col("_src_file") > before) & (F.col("_src_file") <= now))))

    ranges = key_ranges(events, "o_orderkey", len(_LOG_AT))
    take_chunks(replica, "orders", ORDERING_KEYS, read, ranges, position, moved, apply_log)
    # What came while chunks were read is applied last.
    apply_batch(replica, _messages(events.where(F.col("_src_file") > _LOG_FROM)))
    return replica.read("orders").select(*ORDER_COLUMNS, F.col("_deleted").alias("deleted"))


# ---- schema changes


@query(
    f"""WITH {ORDERING_SQL} SELECT o_orderkey, o_orderstatus,
    CASE WHEN op <> 'c' THEN o_orderpriority END AS tier, f, p, r, op = 'd' AS deleted FROM {NEWEST_ORDERS}"""
)
def evolve_add_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both versions of the table in one batch."""
    replica = new_replica(spark, "added")
    apply_batch(replica, two_versions(spark, sf_dir))
    return replica.read("orders").select("o_orderkey", "o_orderstatus", "tier", *places())


@query(
    f"""WITH {ORDERING_SQL} SELECT o_orderkey, o_orderstatus,
    CASE WHEN op = 'c' THEN o_orderpriority END AS o_orderpriority, f, p, r, op = 'd' AS deleted FROM {NEWEST_ORDERS}"""
)
def evolve_drop_column_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later version lacks a column: it stays, and is NULL from then on."""
    events = ordering(spark, sf_dir)
    replica = new_replica(spark, "dropped")
    apply_batch(replica, _messages(only(events, "c")))
    apply_batch(replica, _messages(only(events, "u", "d").drop("o_orderpriority")))
    return replica.read("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", *places())


@query(
    f"""WITH {ORDERING_SQL} SELECT o_orderkey,
    CAST(CASE WHEN op = 'c' THEN o_totalprice ELSE o_totalprice * 1000 + 0.0625 END AS DECIMAL(17,4)) AS o_totalprice,
    f, p, r, op = 'd' AS deleted FROM {NEWEST_ORDERS}"""
)
def evolve_widen_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """decimal(12,2), then decimal(17,4): files of the first are read as the second; then the first
    version is replayed."""
    events = ordering(spark, sf_dir)
    larger = (F.col("o_totalprice") * 1000 + F.lit("0.0625").cast("decimal(5,4)")).cast("decimal(17,4)")
    early = _messages(only(events, "c"))
    replica = new_replica(spark, "widened")
    apply_batch(replica, early)
    apply_batch(replica, _messages(only(events, "u", "d").withColumn("o_totalprice", larger)))
    apply_batch(replica, early)
    return replica.read("orders").select("o_orderkey", "o_totalprice", *places())


@query(
    """SELECT 'orders' AS "table", CAST(row_number() OVER () - 1 AS INTEGER) AS position, name AS "column", type,
              name = 'o_orderkey' AS is_key
    FROM (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'),
                 ('o_totalprice', 'decimal(12,2)'), ('o_orderdate', 'timestamp_ntz'), ('o_day', 'date'),
                 ('tier', 'string')) AS t(name, type)"""
)
def replica_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the replica looks like after a column was added."""
    replica = new_replica(spark, "catalog")
    apply_batch(replica, two_versions(spark, sf_dir))
    return replica.catalog()


@query(
    f"""WITH {ACTIVITY_SQL}
    SELECT user_id, strftime(ts, '%H:%M:%S.%f') AS at, '{{"kind":"' || event_type || '","n":[' || event_id || ',null]}}' AS doc
    FROM {NEWEST_ACTIVITY}"""
)
def typed_times_and_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of day as TIME, JSON as VARIANT, through messages and files and back to the texts they compare by."""
    spark.conf.set("spark.sql.timeType.enabled", "true")
    events = activity(spark, sf_dir)
    micros = F.pmod(F.unix_micros("_src_commit_at"), F.lit(MICROS_PER_DAY))
    # Written in another order, with blanks.
    doc = F.format_string('{"n": [%d, null],  "kind": "%s"}', "event_id", "event_type")
    events = events.select("user_id", micros.alias("at"), doc.alias("doc"), *(c for c in events.columns if c.startswith("_")))
    logical = {"at": "io.debezium.time.MicroTime", "doc": JSON}
    replica = new_replica(spark, "typed")
    apply_batch(replica, encode(events, "activity", ACTIVITY_KEYS, logical=logical), logical_types=TYPED_LOGICAL_TYPES)
    rows = replica.read("activity")
    kinds = [rows.schema[c].dataType.simpleString() for c in ("at", "doc")]
    assert kinds == ["time(6)", "variant"], kinds
    return rows.select("user_id", *(field_text(rows.schema[c]).alias(c) for c in ("at", "doc")))


# ---- several tables


@query(
    f"""WITH {ACTIVITY_SQL}, {ORDERING_SQL}, {SHIPPING_SQL}
    SELECT 'activity' AS "table", count(*) AS rows, count(*) FILTER (op = 'd') AS deleted FROM {NEWEST_ACTIVITY}
    UNION ALL
    SELECT 'orders', count(*), count(*) FILTER (op = 'd') FROM {NEWEST_ORDERS}
    UNION ALL
    SELECT 'shipping', count(*), count(*) FILTER (op = 'd') FROM {newest_sql('shipping', 'l_orderkey, l_linenumber')}"""
)
def multi_table_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All feeds in one batch, visible at once."""
    replica = new_replica(spark, "several")
    feeds = (activity_messages, order_messages, shipping_messages)
    apply_batch(replica, reduce(DataFrame.unionByName, (f(spark, sf_dir) for f in feeds)))
    assert replica.latest() == 1
    counts = [
        replica.read(t).agg(
            F.lit(t).alias("table"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if("_deleted").alias("deleted"),
        )
        for t in replica.tables()
    ]
    return reduce(DataFrame.unionByName, counts)


TABLES = 40


def spread(messages: DataFrame, tables: int = TABLES) -> DataFrame:
    """Messages of one table as those of many, by key."""
    return messages.withColumn(
        "topic", F.concat("topic", F.lit("_"), F.pmod(F.get_json_object("key", "$.payload.user_id").cast("int"), F.lit(tables))))


@query(
    f"""WITH {ACTIVITY_SQL}
    SELECT 'activity_' || (user_id % {TABLES}) AS "table", count(*) AS rows, count(*) FILTER (op = 'd') AS deleted
    FROM {NEWEST_ACTIVITY} GROUP BY ALL"""
)
def many_tables_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty tables in one batch: one pass over the messages, then a job per table."""
    replica = new_replica(spark, "many")
    apply_batch(replica, spread(activity_messages(spark, sf_dir)))
    counts = [
        replica.read(t).select(F.lit(t).alias("table"), "_deleted") for t in replica.tables()
    ]
    rows = reduce(DataFrame.unionByName, counts)
    return rows.groupBy("table").agg(F.count(F.lit(1)).alias("rows"), F.count_if("_deleted").alias("deleted"))


@query(
    f"""WITH {ORDERING_SQL}, n AS (SELECT count(*) AS rows FROM {NEWEST_ORDERS} WHERE op <> 'd')
    SELECT 'orders' AS "table", rows AS source_rows, rows AS target_rows, 0::BIGINT AS missing, 0::BIGINT AS extra,
           0::BIGINT AS mismatched, true AS ok FROM n"""
)
def verify_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replica of a reordered, repeated feed equals the source's rows."""
    events = ordering(spark, sf_dir)
    replica = new_replica(spark, "verified")
    apply_batch(replica, _messages(only(events, "u", "d")))
    apply_batch(replica, _messages(events))
    source = live_view(newest_per_key(events, ORDERING_KEYS), ORDER_COLUMNS)
    report = verify(replica, {"orders": source}, {"orders": ORDERING_KEYS})
    return report.select(
        "table", "source_rows", "target_rows", "missing", "extra", "mismatched", "ok"
    )


@query(
    f"""WITH {ORDERING_SQL}, n AS (SELECT count(*) AS rows FROM {NEWEST_ORDERS} WHERE op <> 'd')
    SELECT 'archive' AS "table", rows AS source_rows, 0::BIGINT AS target_rows, rows AS missing, false AS ok FROM n
    UNION ALL
    SELECT 'orders', rows, rows, 0, true FROM n"""
)
def verify_missing_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table the replica has never seen counts as empty."""
    events = ordering(spark, sf_dir)
    replica = new_replica(spark, "missing")
    apply_batch(replica, _messages(events))
    source = live_view(newest_per_key(events, ORDERING_KEYS), ORDER_COLUMNS)
    keys = {"orders": ORDERING_KEYS, "archive": ORDERING_KEYS}
    report = verify(replica, {"orders": source, "archive": source}, keys)
    return report.select("table", "source_rows", "target_rows", "missing", "ok")


# ---- streams


def files_of(df: DataFrame, name: str) -> str:
    """Rows as a directory a file stream can read, in no particular order."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    spread = df.repartition(2 * spark.sparkContext.defaultParallelism)
    spread.write.option("maxRecordsPerFile", 1_000_000).parquet(path)
    return path


@query(f"WITH {ORDERING_SQL} SELECT {ORDERING_STATE} FROM {NEWEST_ORDERS}")
def stream_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in no order, batch by batch, until nothing is left."""
    source = read_changes(
        spark,
        files_of(order_messages(spark, sf_dir), "messages"),
        streaming=True,
        max_per_trigger=spark.sparkContext.defaultParallelism,
    )
    replica = new_replica(spark, "streamed")
    run_stream(source, replica, fresh_dir(spark, "progress")).awaitTermination()
    return order_state(replica.read("orders"))


def _state_stream(spark: SparkSession, sf_dir: str) -> tuple[Replica, str]:
    events, replica = activity(spark, sf_dir), new_replica(spark, "state")
    at_once = spark.sparkContext.defaultParallelism
    stream = (
        spark.readStream.schema(events.schema)
        .option("maxFilesPerTrigger", at_once)
        .parquet(files_of(events, "events"))
    )
    progress = fresh_dir(spark, "progress")
    run_state_stream(stream, ACTIVITY_KEYS, replica, "activity", progress).awaitTermination()
    return replica, progress


@query(f"WITH {ACTIVITY_SQL} SELECT {ACTIVITY_STATE} FROM {NEWEST_ACTIVITY}")
def stream_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming query itself keeps the positions, and lets newer events through."""
    replica, _ = _state_stream(spark, sf_dir)
    return replica.read("activity").select(*ACTIVITY_COLUMNS, *places())


@query(
    f"""WITH {ACTIVITY_SQL}, n AS (SELECT count(*) AS rows FROM {NEWEST_ACTIVITY})
    SELECT 'activity' AS "table", rows AS source_rows, rows AS target_rows, 0::BIGINT AS missing, 0::BIGINT AS extra,
           0::BIGINT AS mismatched, true AS ok FROM n"""
)
def verify_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of that query, read back from its checkpoint, has the replica's keys and positions."""
    replica, progress = _state_stream(spark, sf_dir)
    report = verify_state(replica, "activity", progress)
    return report.select("table", "source_rows", "target_rows", "missing", "extra", "mismatched", "ok")


@query(
    f"""WITH {ACTIVITY_SQL}, good AS (SELECT * FROM activity WHERE event_type NOT IN ('view', 'purchase'))
    SELECT user_id, event_id, NULL AS why FROM {newest_sql('good', 'user_id')}
    UNION ALL
    SELECT user_id, event_id, CASE event_type WHEN 'view' THEN 'unsupported op t' ELSE '{BROKEN_JSON}' END
    FROM activity WHERE event_type IN ('view', 'purchase')"""
)
def stream_with_bad_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views are of a kind nobody knows, and purchases are cut off. The rest arrives."""
    events = activity(spark, sf_dir)
    odd = F.when(F.col("event_type") == "view", "t").otherwise(F.col("_op"))
    messages = encode(events.withColumn("_op", odd), "activity", ACTIVITY_KEYS)
    bought = F.get_json_object("value", "$.payload.after.event_type") == "purchase"
    cut_off = F.expr("left(value, char_length(value) - 20)")
    messages = messages.withColumn("value", F.when(bought, cut_off).otherwise(F.col("value")))
    source = read_changes(
        spark,
        files_of(messages, "messages"),
        streaming=True,
        max_per_trigger=spark.sparkContext.defaultParallelism,
    )
    replica = new_replica(spark, "quarantined")
    run_stream(source, replica, fresh_dir(spark, "progress"), on_bad="quarantine").awaitTermination()
    rows = replica.read("activity").select("user_id", "event_id", F.lit(None).cast("string").alias("why"))
    user = F.get_json_object("key", "$.payload.user_id").cast("bigint").alias("user_id")
    event = F.pmod("offset", F.lit(10**12)).alias("event_id")
    return rows.unionByName(bad_messages(replica).select(user, event, "why"))
