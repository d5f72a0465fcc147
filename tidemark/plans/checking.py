"""Queries that compare tables, digest them, and summarise runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.text import normalise, row_text
from tidemark.operators.stats import (
    explode_counts,
    histogram_percentiles,
    lag_histogram,
    merge_histograms,
    ops_counts,
)
from tidemark.operators.verify import (
    caught_up,
    compare_localised,
    compare_tables,
    consumer_lag,
    diff_examples,
    partition_lag,
    table_digest,
    verdict,
)
from tidemark.plans.feeds import ACTIVITY_SQL, activity, table
from tidemark.plans.registry import query

# ---- comparison


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.round("o_totalprice", 2).cast("decimal(12,2)").alias("o_totalprice"),
        "o_orderdate",
    )


def _perturbed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bad replica of orders: finished ones of low priority are lost, urgent ones have another price, pending
    ones have a twin under another key."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    orders = table(spark, sf_dir, "orders")
    price = F.round("o_totalprice", 2).cast("decimal(12,2)")
    lost = (priority == "5-LOW") & (status == "F")
    twin = F.array(F.lit(0), F.lit(1_000_000_000))
    shifts = F.when(lost, F.array(F.lit(0)).cast("array<int>")).when(status == "P", twin).otherwise(
        F.array(F.lit(0))
    )
    kept = orders.where(~lost).withColumn("_shift", F.explode(shifts))
    return kept.select(
        (F.col("o_orderkey") + F.col("_shift")).alias("o_orderkey"),
        "o_custkey",
        "o_orderstatus",
        F.when(priority == "1-URGENT", (price + 1).cast("decimal(12,2)")).otherwise(price).alias("o_totalprice"),
        "o_orderdate",
    )


_SIDES = """
src AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice, 2) AS DECIMAL(12,2)) AS o_totalprice,
               o_orderdate FROM orders),
dst AS (
  SELECT o_orderkey + shift AS o_orderkey, o_custkey, o_orderstatus,
         CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(round(o_totalprice, 2) AS DECIMAL(12,2)) + 1
              ELSE CAST(round(o_totalprice, 2) AS DECIMAL(12,2)) END AS DECIMAL(12,2)) AS o_totalprice, o_orderdate
  FROM (SELECT *, 0 AS shift FROM orders
        UNION ALL SELECT *, 1000000000 FROM orders WHERE o_orderstatus = 'P')
  WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'F'))"""

_LINE = (
    "concat_ws(chr(31), CAST(o_orderkey AS VARCHAR), coalesce(CAST(o_custkey AS VARCHAR), '\\N'),"
    " coalesce(o_orderstatus, '\\N'), coalesce(CAST(o_totalprice AS VARCHAR), '\\N'),"
    " coalesce(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f'), '\\N'))"
)


#: What is hashed of a row: each field after its length.
_FORM = (
    "concat_ws(',', "
    + ", ".join(
        f"coalesce(length({t}) || ':' || {t}, '-')"
        for t in (
            "CAST(o_orderkey AS VARCHAR)", "CAST(o_custkey AS VARCHAR)", "o_orderstatus", "CAST(o_totalprice AS VARCHAR)",
            "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f')",
        )
    )
    + ")"
)


def _sums_sql(hashes: str) -> str:
    sums = ", ".join(
        f"coalesce(sum(CAST(CAST('0x' || substr(h, {1 + 16 * i}, 16) AS UBIGINT) AS HUGEINT)), 0)"
        for i in range(4)
    )
    return f"(SELECT sha256(concat_ws(':', count(*), {sums})) FROM {hashes})"


_COMPARED = f"""{_SIDES},
s AS (SELECT o_orderkey, sha256({_FORM}) AS h FROM src),
t AS (SELECT o_orderkey, sha256({_FORM}) AS h FROM dst),
c AS (SELECT count(s.h) AS source_rows, count(t.h) AS target_rows,
             count(*) FILTER (t.h IS NULL) AS missing, count(*) FILTER (s.h IS NULL) AS extra,
             count(*) FILTER (s.h <> t.h) AS mismatched
      FROM s FULL JOIN t ON s.o_orderkey = t.o_orderkey)"""


@query(
    f"""WITH {_COMPARED}
    SELECT 'orders' AS "table", c.*, 0::BIGINT AS source_duplicates, 0::BIGINT AS target_duplicates,
           {_sums_sql('s')} AS source_sha256, {_sums_sql('t')} AS target_sha256, false AS ok FROM c""",
    name="compare_tables",
)
def compare_perturbed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_tables(
        _orders(spark, sf_dir), _perturbed(spark, sf_dir), ["o_orderkey"], "orders"
    )


@query(
    f"""WITH {_COMPARED}
    SELECT 'orders' AS "table", c.source_rows, c.source_rows AS target_rows, 0::BIGINT AS missing, 0::BIGINT AS extra,
           0::BIGINT AS mismatched, 0::BIGINT AS source_duplicates, 0::BIGINT AS target_duplicates,
           {_sums_sql('s')} AS source_sha256, {_sums_sql('s')} AS target_sha256, true AS ok FROM c"""
)
def compare_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other side holds the keys as text and the rows in another order."""
    orders = _orders(spark, sf_dir)
    other = orders.withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
    return compare_tables(orders, other.orderBy("o_custkey"), ["o_orderkey"], "orders")


@query(
    f"""WITH {_COMPARED}
    SELECT 'orders' AS "table", c.*, 0::BIGINT AS source_duplicates, 0::BIGINT AS target_duplicates,
           {_sums_sql('s')} AS source_sha256, {_sums_sql('t')} AS target_sha256, false AS ok FROM c
    UNION ALL
    SELECT 'same', c.source_rows, c.source_rows, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT,
           {_sums_sql('s')}, {_sums_sql('s')}, true FROM c""",
    name="compare_localised",
)
def compare_by_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums by bucket of keys first, rows only of buckets that differ."""
    orders = _orders(spark, sf_dir)
    perturbed = compare_localised(orders, _perturbed(spark, sf_dir), ["o_orderkey"], "orders")
    return perturbed.unionByName(compare_localised(orders, orders.orderBy("o_custkey"), ["o_orderkey"], "same"))


@query(
    """WITH dup AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT count(*) AS source_rows, count(*) AS target_rows, CAST(sum(n - 1) AS BIGINT) AS source_duplicates,
           CAST(sum(n - 1) AS BIGINT) AS target_duplicates, true AS ok FROM dup"""
)
def compare_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    report = compare_tables(items, items, ["l_orderkey", "l_linenumber"], "lineitem")
    return report.select(
        "source_rows", "target_rows", "source_duplicates", "target_duplicates", "ok"
    )


@query(
    f"""WITH {_SIDES},
    s AS (SELECT o_orderkey AS k, {_LINE} AS line FROM src),
    t AS (SELECT o_orderkey AS k, {_LINE} AS line FROM dst),
    d AS (SELECT CASE WHEN t.k IS NULL THEN 'missing' WHEN s.k IS NULL THEN 'extra' ELSE 'mismatched' END AS kind,
                 coalesce(s.k, t.k) AS k, s.line AS source_row, t.line AS target_row
          FROM s FULL JOIN t ON s.k = t.k WHERE s.line IS DISTINCT FROM t.line)
    SELECT kind, CAST(k AS VARCHAR) AS key, source_row, target_row FROM d
    QUALIFY row_number() OVER (PARTITION BY kind ORDER BY k) <= 2""",
    name="diff_examples",
)
def difference_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff_examples(_orders(spark, sf_dir), _perturbed(spark, sf_dir), ["o_orderkey"])


@query(
    f"""WITH {_COMPARED}
    SELECT 2::BIGINT AS tables, (SELECT missing + extra + mismatched = 0 FROM c) AS all_ok""",
    name="verdict",
)
def verdict_of_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    reports = [
        compare_tables(orders, orders, ["o_orderkey"], "same"),
        compare_tables(orders, _perturbed(spark, sf_dir), ["o_orderkey"], "perturbed"),
    ]
    return verdict(reduce(DataFrame.unionByName, reports))


@query(f"WITH {_SIDES} SELECT o_orderkey, {_LINE} AS line FROM src")
def normalise_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    return orders.select("o_orderkey", row_text(orders).alias("line"))


@query(
    """SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
              CASE WHEN event_type = 'view' THEN '1' ELSE '0' END AS seen, strftime(ts, '%Y-%m-%d') AS day,
              CASE WHEN event_type = 'error' THEN '\\N' ELSE lower(hex(event_type)) END AS raw,
              CAST(CAST(round(value, 2) AS DECIMAL(12,2)) AS VARCHAR) AS value
       FROM events"""
)
def normalise_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    typed = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        (kind == "view").alias("seen"),
        F.col("ts").cast("date").alias("day"),
        F.when(kind != "error", kind.cast("binary")).alias("raw"),
        F.round("value", 2).cast("decimal(12,2)").alias("value"),
    )
    return normalise(typed)


_FOUND = ("missing", "extra", "mismatched", "source_duplicates", "target_duplicates", "ok")


@query("""SELECT 0 AS missing, 0 AS extra, count(*) AS mismatched, 0 AS source_duplicates, count(*) AS target_duplicates,
          count(*) = 0 AS ok FROM orders WHERE o_orderstatus = 'P'""")
def compare_detects_target_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replica that has pending orders twice."""
    source = _orders(spark, sf_dir)
    target = source.unionByName(source.where("o_orderstatus = 'P'"))
    return compare_tables(source, target, ["o_orderkey"]).select(*_FOUND)


@query("""SELECT 0 AS missing, 0 AS extra, count(*) AS mismatched, 0 AS source_duplicates, 0 AS target_duplicates,
          count(*) = 0 AS ok FROM orders""")
def compare_detects_shifted_separators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same characters, cut into fields at another place."""
    status, priority, mark = F.col("o_orderstatus"), F.col("o_orderpriority"), F.lit("\x1f")
    orders = table(spark, sf_dir, "orders")
    source = orders.select("o_orderkey", F.concat(status, mark, priority).alias("a"), F.lit("x").alias("b"))
    target = orders.select("o_orderkey", status.alias("a"), F.concat(priority, mark, F.lit("x")).alias("b"))
    return compare_tables(source, target, ["o_orderkey"]).select(*_FOUND)


# ---- digests


def _levels_sql() -> str:
    """Groups of entries under ever shorter prefixes, from eight digits to none."""
    level, names = [], ["e"]
    for digits in range(8, -1, -2):
        level.append(
            f"g{digits} AS (SELECT substr(h, 1, {digits}) AS h, sha256(string_agg(entry, chr(10) ORDER BY h)"
            f" || chr(10)) AS entry FROM {names[-1]} GROUP BY ALL)"
        )
        names.append(f"g{digits}")
    return ", ".join(level)


@query(
    f"""WITH {_SIDES},
    e AS (SELECT h, h || ':' || count(*) AS entry FROM (SELECT sha256({_FORM}) AS h FROM src) GROUP BY h),
    {_levels_sql()}
    SELECT (SELECT count(*) FROM src) AS rows, entry AS sha256 FROM g0"""
)
def table_digest_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_digest(_orders(spark, sf_dir), "bucketed")


@query(
    f"""WITH {_SIDES}, s AS (SELECT sha256({_FORM}) AS h FROM src)
    SELECT (SELECT count(*) FROM s) AS rows, {_sums_sql('s')} AS sha256"""
)
def table_digest_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_digest(_orders(spark, sf_dir))


# ---- statistics


def _applied_at() -> Column:
    """A made-up apply time: a while after the commit, longer for later events; before it for views."""
    delay = F.when(F.col("event_type") == "view", -5000).otherwise(F.col("event_id") * 1370)
    return F.timestamp_add("MICROSECOND", delay.cast("bigint"), F.col("_src_commit_at"))


_LAG = """CASE WHEN event_type = 'view' THEN 0 ELSE event_id * 1370 // 1000 END AS lag_ms"""
_STREAMED = "op <> 'r'"


def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups count as snapshot rows here."""
    op = F.when(F.col("event_type") == "signup", "r").otherwise(F.col("_op"))
    return activity(spark, sf_dir).withColumn("_op", op)


@query("""SELECT CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op, count(*) AS n
          FROM events GROUP BY ALL""", name="ops_counts")
def events_per_op(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops_counts(activity(spark, sf_dir)).withColumnRenamed("_op", "op")


@query(f"SELECT {_LAG}, count(*) AS n FROM events WHERE event_type <> 'signup' GROUP BY ALL", name="lag_histogram")
def lag_histogram_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lag_histogram(_streamed(spark, sf_dir), _applied_at())


@query(f"SELECT {_LAG}, count(*) AS n FROM events WHERE event_type <> 'signup' GROUP BY ALL", name="merge_histograms")
def merged_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One histogram per consumer, then all together."""
    per_consumer = lag_histogram(_streamed(spark, sf_dir), _applied_at(), by=["event_type"])
    return merge_histograms(per_consumer)


@query("""SELECT CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op, count(*) AS n
          FROM events GROUP BY ALL""")
def merged_op_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map of counts per day (at most four entries), then all together."""
    ops = ("c", "u", "d", "r")
    per_day = activity(spark, sf_dir).groupBy("_src_file").agg(
        F.create_map(*(c for op in ops for c in (F.lit(op), F.count_if(F.col("_op") == op)))).alias("ops")
    )
    merged = merge_histograms(explode_counts(per_day, "ops", "op"), "op")
    return merged.where(F.col("n") > 0)


_QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99, "p999": 0.999}


def _percentiles_sql(lags: str) -> str:
    picked = ", ".join(
        f"min(lag_ms) FILTER (upto >= {q}::DOUBLE * total) AS {name}" for name, q in _QUANTILES.items()
    )
    return f"""
    h AS (SELECT lag_ms, count(*) AS n FROM ({lags}) GROUP BY lag_ms),
    w AS (SELECT lag_ms, sum(n) OVER (ORDER BY lag_ms) AS upto, sum(n) OVER () AS total FROM h)
    SELECT {picked}, max(lag_ms) AS max, CAST(max(total) AS BIGINT) AS events FROM w"""


@query("WITH " + _percentiles_sql(f"SELECT {_LAG} FROM events WHERE event_type <> 'signup'"))
def lag_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = lag_histogram(_streamed(spark, sf_dir), _applied_at())
    return histogram_percentiles(histogram, _QUANTILES)


@query(
    "WITH "
    + _percentiles_sql("SELECT greatest(0, CAST(epoch_ms(l_shipdate) - epoch_ms(TIMESTAMP '1995-01-01') AS BIGINT)) AS lag_ms FROM lineitem")
)
def lag_percentiles_over_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags of years, as when a log is replayed from its start. What was shipped before counts as no lag."""
    start = F.expr("TIMESTAMP_NTZ'1995-01-01 00:00:00'")
    items = table(spark, sf_dir, "lineitem")
    lag = F.greatest(F.lit(0), F.timestamp_diff("MILLISECOND", start, F.col("l_shipdate")))
    histogram = items.groupBy(lag.alias("lag_ms")).agg(F.count(F.lit(1)).alias("n"))
    return histogram_percentiles(histogram, _QUANTILES)


# ---- catching up


def _offsets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Views were never committed, signups' commit was reset, errors are not consumed yet."""
    kind = F.col("event_type")
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("feed.db."), kind).alias("topic"),
        F.dayofmonth("ts").alias("partition"),
        "event_id",
        "event_type",
    )
    by = ["topic", "partition"]
    high = events.groupBy(*by).agg((F.max("event_id") + 1).alias("high"))
    position = F.when(kind == "signup", F.lit(-1)).when(kind == "error", F.col("event_id"))
    committed = (
        events.where(kind != "view")
        .groupBy(*by)
        .agg(
            F.max(F.when(kind == "signup", F.lit(-1)).otherwise(F.col("event_id") + 1)).alias("_upto"),
            F.min(position).alias("_from"),
        )
    )
    return high, committed.select(*by, F.coalesce("_from", "_upto").cast("bigint").alias("committed"))


_OFFSETS = """
high AS (SELECT 'feed.db.' || event_type AS topic, CAST(day(ts) AS INTEGER) AS partition, max(event_id) + 1 AS high
         FROM events GROUP BY ALL),
committed AS (SELECT 'feed.db.' || event_type AS topic, CAST(day(ts) AS INTEGER) AS partition,
                CASE event_type WHEN 'signup' THEN -1 WHEN 'error' THEN min(event_id) ELSE max(event_id) + 1 END AS committed
              FROM events WHERE event_type <> 'view' GROUP BY event_type, day(ts)),
lags AS (SELECT topic, partition, greatest(0, high - greatest(0, coalesce(committed, 0))) AS lag
         FROM high LEFT JOIN committed USING (topic, partition))"""


@query(f"WITH {_OFFSETS} SELECT topic, partition, CAST(lag AS BIGINT) AS lag FROM lags")
def lag_per_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partition_lag(*_offsets(spark, sf_dir))


@query(f"WITH {_OFFSETS} SELECT CAST(sum(lag) AS BIGINT) AS lag FROM lags WHERE topic LIKE 'feed.db.s%'", name="consumer_lag")
def consumer_lag_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consumer_lag(*_offsets(spark, sf_dir), topic_prefix="feed.db.s")


@query(
    f"""WITH {_OFFSETS}, {ACTIVITY_SQL}
    SELECT (SELECT count(*) FROM activity WHERE op <> 'd') AS markers,
           (SELECT count(*) FROM activity WHERE op = 'c') AS waiting,
           (SELECT CAST(sum(lag) AS BIGINT) FROM lags) AS lag, false AS caught_up"""
)
def catch_up_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups have not arrived."""
    events = activity(spark, sf_dir).select(F.col("event_id").alias("id"), "_op")
    markers, arrived = events.where("_op <> 'd'"), events.where("_op <> 'c'")
    return caught_up(markers.select("id"), arrived.select("id"), consumer_lag(*_offsets(spark, sf_dir)))


@query(
    "SELECT count(*) AS markers, 0::BIGINT AS waiting, 0::BIGINT AS lag, true AS caught_up FROM events",
    name="caught_up",
)
def catch_up_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    high, _ = _offsets(spark, sf_dir)
    done = high.withColumnRenamed("high", "committed")
    return caught_up(ids, ids, consumer_lag(high, done))
