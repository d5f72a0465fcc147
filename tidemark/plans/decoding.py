"""Queries on messages: decode, versions, validation, snapshot, newest per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.columns import POSITION, cols, position
from tidemark.functions.wire import JSON, epoch_to_ntz
from tidemark.operators.decode import (
    DecodedTable,
    decode_rows,
    drop_tombstones,
    schema_versions,
    split_messages,
    table_of,
    validate_ops,
)
from tidemark.operators.merge import live_view
from tidemark.operators.reduce import latest_state, newest_per_key
from tidemark.operators.stats import ops_counts
from tidemark.plans.feeds import (
    ACTIVITY_KEYS,
    ACTIVITY_SQL,
    ORDERING_KEYS,
    ORDERING_SQL,
    SHIPPING_KEYS,
    SHIPPING_SQL,
    activity,
    newest_sql,
    ordering,
    shipping,
    table,
)
from tidemark.plans.registry import query
from tidemark.sources.changes import snapshot_events
from tidemark.sources.feeds import encode

ORDER_COLUMNS = (
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderdate",
    "o_day",
    "o_orderpriority",
)
ACTIVITY_COLUMNS = ("user_id", "event_id", "event_type", "value")
SHIPPING_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_returnflag")


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(ordering(spark, sf_dir), "orders", ORDERING_KEYS)


def activity_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(activity(spark, sf_dir), "activity", ACTIVITY_KEYS)


def shipping_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(shipping(spark, sf_dir), "shipping", SHIPPING_KEYS)


def decoded(raw: DataFrame) -> dict[str, DecodedTable]:
    parts = split_messages(drop_tombstones(raw))
    return decode_rows(parts, schema_versions(parts))


def places() -> list[Column]:
    """Position and state under the short names the SQL uses."""
    return [
        F.col("_src_file").alias("f"),
        F.col("_src_pos").alias("p"),
        F.col("_src_row").alias("r"),
        F.col("_deleted").alias("deleted"),
    ]


_ORDERS_SELECTED = (
    ", ".join(ORDER_COLUMNS)
    + ", op, f, p, r, epoch_us(o_orderdate) AS commit_us, op = 'd' AS deleted"
)


def _decoded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = decoded(order_messages(spark, sf_dir))["orders"].events
    return events.select(
        *ORDER_COLUMNS,
        F.col("_op").alias("op"),
        *places(),
        F.unix_micros("_src_commit_at").alias("commit_us"),
    )


@query(f"WITH {ORDERING_SQL} SELECT {_ORDERS_SELECTED} FROM ordering")
def decode_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded_orders(spark, sf_dir)


# Days by which every other time is earlier, so that half of them are before 1970.
_EARLIER = 21_900

_TIMES_SQL = f"""times AS (
  SELECT event_id, epoch_us(ts) - CASE WHEN event_id % 2 = 1 THEN {_EARLIER} * 86400000000 ELSE 0 END AS us FROM events)"""


@query(
    f"""WITH {_TIMES_SQL}
    SELECT event_id, make_timestamp(us - (us % 1000 + 1000) % 1000) AS from_millis, make_timestamp(us) AS from_micros,
           make_timestamp(us) AS from_nanos, strftime(make_timestamp(us), '%H:%M:%S.%f') AS time_of_day,
           us AS zoned_us, CAST(year(make_timestamp(us)) AS INTEGER) AS of_year, CAST(make_timestamp(us) AS DATE) AS of_day
    FROM times"""
)
def decode_temporal_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times in every form a message may have, half of them before 1970."""
    back = F.when(F.col("event_id") % 2 == 1, _EARLIER * 86_400_000_000).otherwise(0)
    us = F.unix_micros("_src_commit_at") - back
    at = epoch_to_ntz(us)
    utc, east = (F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") for t in (at, epoch_to_ntz(us + 7_200_000_000)))
    zoned = F.when(F.col("event_id") % 3 == 0, F.concat(east, F.lit("+02:00"))).otherwise(F.concat(utc, F.lit("Z")))
    events = activity(spark, sf_dir).select(
        "event_id",
        F.floor(us / 1000).alias("from_millis"),
        us.alias("from_micros"),
        (us * 1000 + F.pmod("event_id", F.lit(1000))).alias("from_nanos"),
        F.pmod(us, F.lit(86_400_000_000)).alias("time_of_day"),
        zoned.alias("zoned"),
        F.year(at).alias("of_year"),
        at.cast("date").alias("of_day"),
        *("_op", *POSITION, "_src_commit_at"),
    )
    logical = {
        "from_millis": "io.debezium.time.Timestamp",
        "from_micros": "io.debezium.time.MicroTimestamp",
        "from_nanos": "io.debezium.time.NanoTimestamp",
        "time_of_day": "io.debezium.time.MicroTime",
        "zoned": "io.debezium.time.ZonedTimestamp",
        "of_year": "io.debezium.time.Year",
    }
    rows = decoded(encode(events, "times", ("event_id",), logical=logical))["times"].events
    return rows.select(
        *("event_id", "from_millis", "from_micros", "from_nanos", "time_of_day", "of_year", "of_day"),
        F.unix_micros("zoned").alias("zoned_us"),
    )


# Factors that make prices use up all digits.
_WIDE = {"d19": (19, 2, "10000001"), "d28": (28, 6, "-100000000000001"), "d38": (38, 10, "1000000000000000001")}


@query(
    "SELECT o_orderkey, "
    + ", ".join(
        f"CAST(CASE WHEN o_orderkey % 2 = 1 THEN -price ELSE price END * CAST('{by}' AS DECIMAL(38,0))"
        f" AS DECIMAL({digits},{scale}))::VARCHAR AS {name}"
        for name, (digits, scale, by) in _WIDE.items()
    )
    + " FROM (SELECT o_orderkey, CAST(CAST(round(o_totalprice, 2) AS DECIMAL(12,2)) AS DECIMAL(38,2)) AS price FROM orders)"
)
def decode_wide_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals of 19 to 38 digits of both signs, as text."""
    sign = F.when(F.col("o_orderkey") % 2 == 1, -1).otherwise(1).cast("decimal(1,0)")
    wide = [
        (sign * F.col("o_totalprice") * F.lit(by).cast("decimal(20,0)")).cast(f"decimal({digits},{scale})").alias(name)
        for name, (digits, scale, by) in _WIDE.items()
    ]
    events = ordering(spark, sf_dir).where(F.col("_op") == "c")
    events = events.select("o_orderkey", *wide, "_op", *POSITION, "_src_commit_at")
    rows = decoded(encode(events, "wide", ORDERING_KEYS))["wide"].events
    return rows.select("o_orderkey", *(F.col(name).cast("string").alias(name) for name in _WIDE))


@query(
    """SELECT event_id, hex(encode(event_type)) AS raw, value > 10 AS flag, CAST(user_id % 100 AS SMALLINT) AS tiny,
              CAST(user_id % 30000 AS SMALLINT) AS small, CAST(user_id AS INTEGER) AS plain,
              CAST(CAST(value AS FLOAT) AS DOUBLE) AS single, value AS double_, event_type AS choice,
              '{"a":["' || event_type || '"],"k":' || replace(props, ' ', '') || ',"z":' || event_id || '}' AS document
       FROM events"""
)
def decode_other_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, flags, numbers of all sizes, choices and documents, whose members come in any order."""
    document = F.format_string('{ "z" : %d, "k": %s , "a": ["%s"]}', "event_id", "props", "event_type")
    events = activity(spark, sf_dir).join(table(spark, sf_dir, "events").select("event_id", "props"), "event_id")
    events = events.select(
        "event_id",
        F.encode("event_type", "UTF-8").alias("raw"),
        (F.col("value") > 10).alias("flag"),
        (F.col("user_id") % 100).cast("tinyint").alias("tiny"),
        (F.col("user_id") % 30000).cast("smallint").alias("small"),
        F.col("user_id").cast("int").alias("plain"),
        F.col("value").cast("float").alias("single"),
        F.col("value").alias("double_"),
        F.col("event_type").alias("choice"),
        document.alias("document"),
        *("_op", *POSITION, "_src_commit_at"),
    )
    logical = {"choice": "io.debezium.data.Enum", "document": JSON}
    rows = decoded(encode(events, "others", ("event_id",), logical=logical))["others"].events
    return rows.select(
        *("event_id", F.hex("raw").alias("raw"), "flag", "tiny", "small", "plain"),
        *(F.col("single").cast("double").alias("single"), "double_", "choice", "document"),
    )


@query(f"WITH {ORDERING_SQL} SELECT {_ORDERS_SELECTED} FROM ordering WHERE op = 'd'")
def decode_delete_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded_orders(spark, sf_dir).where("deleted")


@query(
    f"WITH {SHIPPING_SQL} SELECT {', '.join(SHIPPING_COLUMNS)}, l_suppkey, op, f, p, r,"
    " epoch_us(l_shipdate) AS commit_us FROM shipping"
)
def decode_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = decoded(shipping_messages(spark, sf_dir))["shipping"].events
    return events.select(
        *SHIPPING_COLUMNS,
        "l_suppkey",
        F.col("_op").alias("op"),
        *places()[:3],
        F.unix_micros("_src_commit_at").alias("commit_us"),
    )


@query(
    f"WITH {ORDERING_SQL} SELECT op, count(*) AS n, count(*) FILTER (op = 'd') AS tombstones"
    " FROM ordering GROUP BY op"
)
def tombstones_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each delete is followed by a message without a value."""
    messages = order_messages(spark, sf_dir)
    deleted = F.get_json_object("value", "$.payload.op") == "d"
    copies = F.when(deleted, F.array(F.col("value"), F.lit(None))).otherwise(F.array("value"))
    with_tombstones = messages.withColumn("value", F.explode(copies))
    events = decoded(with_tombstones)["orders"].events
    empty = with_tombstones.where(F.col("value").isNull())
    both = events.select(F.col("_op").alias("op"), F.lit(True).alias("_is_event")).unionByName(
        empty.select(F.lit("d").alias("op"), F.lit(False).alias("_is_event"))
    )
    return both.groupBy("op").agg(
        F.count_if("_is_event").alias("n"), F.count_if(~F.col("_is_event")).alias("tombstones")
    )


@query(
    """SELECT CASE WHEN event_type = 'view' THEN 'bad' ELSE 'good' END AS outcome,
              CASE event_type WHEN 'view' THEN 't' WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
              count(*) AS n
       FROM events GROUP BY ALL"""
)
def op_validation_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.when(F.col("event_type") == "view", "t").otherwise(F.col("_op"))
    events = activity(spark, sf_dir).withColumn("_op", odd)
    good, bad = validate_ops(encode(events, "activity", ACTIVITY_KEYS), on_bad="quarantine")
    op = F.get_json_object("value", "$.payload.op")
    both = good.select(F.lit("good").alias("outcome"), op.alias("op")).unionByName(
        bad.select(F.lit("bad").alias("outcome"), "op")
    )
    return both.groupBy("outcome", "op").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT event_type = 'view' AS bad, CASE WHEN event_type = 'view' THEN 'unsupported op t' END AS why,
              count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids
       FROM events GROUP BY ALL"""
)
def decode_flags_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.when(F.col("event_type") == "view", "t").otherwise(F.col("_op"))
    events = activity(spark, sf_dir).withColumn("_op", odd)
    parts = split_messages(encode(events, "activity", ACTIVITY_KEYS))
    flagged = decode_rows(parts, schema_versions(parts), on_bad="flag")["activity"].events
    return flagged.groupBy(F.col("_bad").isNotNull().alias("bad"), F.col("_bad").alias("why")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids")
    )


def two_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are created under one version of the table, and changed under a later one, which
    has the priority as a column ``tier``."""
    events = ordering(spark, sf_dir)
    early = events.where(F.col("_op") == "c").drop("o_orderpriority")
    late = events.where(F.col("_op") != "c").withColumnRenamed("o_orderpriority", "tier")
    return encode(early, "orders", ORDERING_KEYS).unionByName(
        encode(late, "orders", ORDERING_KEYS)
    )


@query(
    f"""WITH {ORDERING_SQL}
    SELECT 'orders' AS "table", 'o_orderkey' AS keys,
           'o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice decimal(12,2), '
           || 'o_orderdate timestamp_ntz, o_day date'
           || CASE WHEN op = 'c' THEN '' ELSE ', tier string' END AS columns,
           count(*) AS messages
    FROM ordering GROUP BY ALL""",
    name="schema_versions",
)
def versions_in_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = split_messages(two_versions(spark, sf_dir))
    versions = schema_versions(parts)
    described = [
        (
            i,
            v.table,
            ", ".join(v.keys),
            ", ".join(f"{c.name} {c.target.simpleString()}" for c in v.columns),
        )
        for i, v in versions.items()
    ]
    known = spark.createDataFrame(described, "_version long, table string, keys string, columns string")
    counts = parts.groupBy("_version").agg(F.count(F.lit(1)).alias("messages"))
    return counts.join(F.broadcast(known), "_version").drop("_version")


@query(
    f"""WITH {ORDERING_SQL}
    SELECT o_orderkey, o_orderstatus, CASE WHEN op <> 'c' THEN o_orderpriority END AS tier, op, p
    FROM ordering"""
)
def decode_two_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = decoded(two_versions(spark, sf_dir))["orders"].events
    return events.select(
        "o_orderkey", "o_orderstatus", "tier", F.col("_op").alias("op"), F.col("_src_pos").alias("p")
    )


@query(
    """SELECT 'feed.db.' || event_type AS topic, event_type AS "table", count(*) AS n
       FROM events GROUP BY event_type"""
)
def table_of_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    topic = F.concat(F.lit("feed.db."), F.col("event_type"))
    return events.groupBy(topic.alias("topic")).agg(F.count(F.lit(1)).alias("n")).select(
        "topic", table_of(F.col("topic")).alias("table"), "n"
    )


@query(
    f"""WITH {ACTIVITY_SQL}
    SELECT user_id, arg_min(event_id, f * 1000000000000 + p) AS first_event,
           arg_max(event_id, f * 1000000000000 + p) AS last_event
    FROM activity GROUP BY user_id"""
)
def position_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last event of each user in log order."""
    events = activity(spark, sf_dir)
    return events.groupBy("user_id").agg(
        F.min_by("event_id", position()).alias("first_event"),
        F.max_by("event_id", position()).alias("last_event"),
    )


@query(
    """SELECT c_custkey, c_name, CAST(round(c_acctbal, 2) AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment,
              'r' AS op, 1 AS f, CAST(0 AS BIGINT) AS p, 0 AS r, false AS deleted
       FROM customer""",
    name="snapshot_events",
)
def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        F.round("c_acctbal", 2).cast("decimal(12,2)").alias("c_acctbal"),
        "c_mktsegment",
    )
    events = snapshot_events(customers, ["c_custkey"], (1, 0, 0))
    return events.select(*cols(customers.columns), F.col("_op").alias("op"), *places())


@query(
    """WITH balances AS (
      SELECT c_custkey, CAST(round(c_acctbal, 2) AS DECIMAL(12,2)) AS balance, 'r' AS op, 1 AS f, CAST(0 AS BIGINT) AS p
      FROM customer
      UNION ALL
      SELECT o_custkey, CAST(round(o_totalprice, 2) AS DECIMAL(12,2)), 'u', CAST(year(o_orderdate) AS INTEGER), o_orderkey
      FROM orders)
    SELECT c_custkey, balance, op, f, p FROM balances
    QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY f DESC, p DESC) = 1"""
)
def snapshot_plus_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances as of a snapshot, then changed by the stream."""
    before = table(spark, sf_dir, "customer").select(
        "c_custkey", F.round("c_acctbal", 2).cast("decimal(12,2)").alias("balance")
    )
    orders = table(spark, sf_dir, "orders")
    stream = orders.select(
        F.col("o_custkey").alias("c_custkey"),
        F.round("o_totalprice", 2).cast("decimal(12,2)").alias("balance"),
        F.lit("u").alias("_op"),
        F.year("o_orderdate").alias("_src_file"),
        F.col("o_orderkey").alias("_src_pos"),
        F.lit(0).alias("_src_row"),
    )
    events = snapshot_events(before, ["c_custkey"], (1, 0, 0)).drop("_src_commit_at", "_deleted")
    newest = newest_per_key(events.unionByName(stream), ["c_custkey"])
    return newest.select("c_custkey", "balance", F.col("_op").alias("op"), *places()[:2])


def _activity_state(rows: DataFrame) -> DataFrame:
    return rows.select(*ACTIVITY_COLUMNS, *places())


ACTIVITY_STATE = f"{', '.join(ACTIVITY_COLUMNS)}, f, p, r, op = 'd' AS deleted"
SHIPPING_STATE = f"{', '.join(SHIPPING_COLUMNS)}, f, p, r, op = 'd' AS deleted"
ORDERING_STATE = f"{', '.join(ORDER_COLUMNS)}, f, p, r, op = 'd' AS deleted"


@query(f"WITH {ACTIVITY_SQL} SELECT {ACTIVITY_STATE} FROM {newest_sql('activity', 'user_id')}", name="newest_per_key")
def newest_per_key_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _activity_state(newest_per_key(activity(spark, sf_dir), ACTIVITY_KEYS))


@query(f"WITH {ACTIVITY_SQL} SELECT {ACTIVITY_STATE} FROM {newest_sql('activity', 'user_id')}")
def newest_by_aggregation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _activity_state(latest_state(activity(spark, sf_dir), ACTIVITY_KEYS))


@query(
    f"WITH {SHIPPING_SQL} SELECT {SHIPPING_STATE} FROM {newest_sql('shipping', 'l_orderkey, l_linenumber')}"
)
def newest_per_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = newest_per_key(shipping(spark, sf_dir), SHIPPING_KEYS)
    return newest.select(*SHIPPING_COLUMNS, *places())


@query(
    f"""WITH {ACTIVITY_SQL} SELECT {', '.join(ACTIVITY_COLUMNS)}
    FROM {newest_sql('activity', 'user_id')} WHERE op <> 'd'"""
)
def live_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first slice: events -> newest per user -> live rows."""
    newest = newest_per_key(activity(spark, sf_dir), ACTIVITY_KEYS)
    return live_view(newest, ACTIVITY_COLUMNS)
