"""Change feeds over the given tables. Each is a table of events: source columns, ``_op``, position,
commit time, ``_deleted``.

activity    ``events`` keyed by user: many changes per key, hot keys
ordering    ``orders`` keyed by order: created, some updated, some deleted
shipping    ``lineitem`` under a composite key that repeats, so that repeats are changes
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ACTIVITY_KEYS = ("user_id",)
ORDERING_KEYS = ("o_orderkey",)
SHIPPING_KEYS = ("l_orderkey", "l_linenumber")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _utc(ntz: Column) -> Column:
    """A zone-less time read as UTC, whatever the session's zone."""
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, ntz))


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    op = F.when(kind == "signup", "c").when(kind == "error", "d").otherwise("u")
    return table(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        "event_type",
        "value",
        op.alias("_op"),
        (F.year("ts") * 1000 + F.dayofyear("ts")).alias("_src_file"),
        F.col("event_id").alias("_src_pos"),
        F.lit(0).alias("_src_row"),
        _utc(F.col("ts")).alias("_src_commit_at"),
        (kind == "error").alias("_deleted"),
    )


def ordering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders get finished, orders of low priority get deleted; each a log file later."""

    def step(op: str, nth: int, status: Column, when: Column | None = None) -> Column:
        made = F.struct(F.lit(op).alias("op"), F.lit(nth).alias("nth"), status.alias("status"))
        return made if when is None else F.when(when, made)

    status = F.col("o_orderstatus")
    steps = F.array(
        step("c", 0, status),
        step("u", 1, F.lit("F"), status == "O"),
        step("d", 2, F.when(status == "O", "F").otherwise(status), F.col("o_orderpriority") == "5-LOW"),
    )
    changes = table(spark, sf_dir, "orders").withColumn("_step", F.explode(F.array_compact(steps)))
    nth = F.col("_step.nth")
    return changes.select(
        "o_orderkey",
        "o_custkey",
        F.col("_step.status").alias("o_orderstatus"),
        F.round("o_totalprice", 2).cast("decimal(12,2)").alias("o_totalprice"),
        "o_orderdate",
        F.col("o_orderdate").cast("date").alias("o_day"),
        "o_orderpriority",
        F.col("_step.op").alias("_op"),
        (F.year("o_orderdate") - 1990 + nth).alias("_src_file"),
        (F.col("o_orderkey") * 10 + nth).alias("_src_pos"),
        F.lit(0).alias("_src_row"),
        _utc(F.col("o_orderdate")).alias("_src_commit_at"),
        (F.col("_step.op") == "d").alias("_deleted"),
    )


def shipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    op = F.when(flag == "N", "c").when(flag == "R", "d").otherwise("u")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.round("l_extendedprice", 2).cast("decimal(12,2)").alias("l_extendedprice"),
        "l_returnflag",
        op.alias("_op"),
        (F.year("l_shipdate") * 1000 + F.dayofyear("l_shipdate")).alias("_src_file"),
        F.col("l_partkey").alias("_src_pos"),
        F.col("l_suppkey").cast("int").alias("_src_row"),
        _utc(F.col("l_shipdate")).alias("_src_commit_at"),
        (flag == "R").alias("_deleted"),
    )


# ---- the same feeds for DuckDB

ACTIVITY_SQL = """
activity AS (
  SELECT user_id, event_id, event_type, value, ts,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         CAST(year(ts) * 1000 + dayofyear(ts) AS INTEGER) AS f, event_id AS p, 0 AS r
  FROM events)"""

ORDERING_SQL = """
ordering AS (
  SELECT o_orderkey, o_custkey, status AS o_orderstatus,
         CAST(round(o_totalprice, 2) AS DECIMAL(12,2)) AS o_totalprice, o_orderdate,
         CAST(o_orderdate AS DATE) AS o_day, o_orderpriority, op,
         CAST(year(o_orderdate) - 1990 + nth AS INTEGER) AS f, o_orderkey * 10 + nth AS p, 0 AS r
  FROM (
    SELECT *, o_orderstatus AS status, 'c' AS op, 0 AS nth FROM orders
    UNION ALL
    SELECT *, 'F', 'u', 1 FROM orders WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT *, CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END, 'd', 2
    FROM orders WHERE o_orderpriority = '5-LOW'))"""

SHIPPING_SQL = """
shipping AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(round(l_extendedprice, 2) AS DECIMAL(12,2)) AS l_extendedprice, l_returnflag,
         CASE l_returnflag WHEN 'N' THEN 'c' WHEN 'R' THEN 'd' ELSE 'u' END AS op,
         CAST(year(l_shipdate) * 1000 + dayofyear(l_shipdate) AS INTEGER) AS f, l_partkey AS p,
         CAST(l_suppkey AS INTEGER) AS r, l_shipdate
  FROM lineitem)"""


def newest_sql(feed: str, keys: str) -> str:
    return (
        f"(SELECT * FROM {feed} QUALIFY row_number() OVER"
        f" (PARTITION BY {keys} ORDER BY f DESC, p DESC, r DESC) = 1)"
    )
