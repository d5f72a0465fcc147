"""Times the stages of a replication job and prints one JSON line.

Messages are made from the tables first (not timed); then each stage runs on all of them.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.apply import apply_batch
from tidemark.operators.decode import decode_rows, schema_versions, split_messages
from tidemark.operators.merge import guarded_merge, live_view
from tidemark.operators.reduce import newest_per_key
from tidemark.operators.verify import compare_tables, table_digest, verdict, verify
from tidemark.plans import checking
from tidemark.plans.decoding import (
    ORDER_COLUMNS,
    activity_messages,
    order_messages,
    shipping_messages,
)
from tidemark.plans.feeds import (
    ACTIVITY_KEYS,
    ORDERING_KEYS,
    SHIPPING_KEYS,
    activity,
    ordering,
    shipping,
)
from tidemark.plans.replication import files_of, new_replica, only, spread
from tidemark.plans.workspace import fresh_dir
from tidemark.sources.changes import read_changes
from tidemark.streaming.runner import run_stream

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    paths = {
        name: files_of(make(spark, SF_DIR), "messages")
        for name, make in (
            ("activity", activity_messages),
            ("orders", order_messages),
            ("shipping", shipping_messages),
        )
    }
    raws = {name: read_changes(spark, path) for name, path in paths.items()}
    counts = {name: raw.count() for name, raw in raws.items()}
    everything = reduce(DataFrame.unionByName, raws.values())
    total = sum(counts.values())

    queries: dict[str, float] = {}
    rates: dict[str, float] = {}

    def timed(name: str, run: Callable[[], object], rows: int = 0, repeats: int = REPEATS) -> None:
        """Best of some runs, the first of which also warms up."""
        best = min(_seconds(run) for _ in range(repeats))
        queries[name] = round(best, 3)
        if rows:
            rates[f"{name}_rows_per_s"] = round(rows / best)

    def decode() -> None:
        parts = split_messages(raws["shipping"])
        noop(decode_rows(parts, schema_versions(parts))["shipping"].events)

    timed("decode", decode, counts["shipping"])
    timed(
        "newest_per_key_hot",
        lambda: noop(newest_per_key(activity(spark, SF_DIR), ACTIVITY_KEYS)),
        counts["activity"],
    )
    timed(
        "newest_per_composite_key",
        lambda: noop(newest_per_key(shipping(spark, SF_DIR), SHIPPING_KEYS)),
        counts["shipping"],
    )
    events = ordering(spark, SF_DIR)
    target = newest_per_key(only(events, "c", "u"), ORDERING_KEYS)
    staged = newest_per_key(only(events, "c", "d"), ORDERING_KEYS)
    timed(
        "guarded_merge",
        lambda: noop(guarded_merge(target, staged, ORDERING_KEYS)),
        counts["orders"],
    )
    timed(
        "apply_multi_table_batch",
        lambda: apply_batch(new_replica(spark, "bench"), everything),
        total,
    )
    # The same messages as one table's and as forty tables'.
    many = fresh_dir(spark, "messages-of-many")
    spread(raws["activity"]).write.parquet(many)
    one_table, many_tables = raws["activity"], read_changes(spark, many)
    timed("apply_one_table", lambda: apply_batch(new_replica(spark, "bench"), one_table), counts["activity"])
    timed("apply_40_tables", lambda: apply_batch(new_replica(spark, "bench"), many_tables), counts["activity"])
    replica = new_replica(spark, "bench")
    apply_batch(replica, everything)
    timed("apply_replay_all_stale", lambda: apply_batch(replica, everything), total)
    timed("read_live", lambda: noop(replica.live("shipping")), counts["shipping"])

    source = live_view(newest_per_key(ordering(spark, SF_DIR), ORDERING_KEYS), ORDER_COLUMNS)
    truth = fresh_dir(spark, "truth")
    source.write.parquet(truth)
    source = spark.read.parquet(truth)

    def check() -> None:
        report = verify(replica, {"orders": source}, {"orders": ORDERING_KEYS})
        assert verdict(report).first()["all_ok"], report.collect()

    timed("verify_replica", check, 2 * source.count())

    def check_localised() -> None:
        report = verify(replica, {"orders": source}, {"orders": ORDERING_KEYS}, localised=True)
        assert verdict(report).first()["all_ok"], report.collect()

    timed("verify_replica_localised", check_localised, 2 * source.count())
    orders = checking._orders(spark, SF_DIR)
    timed("digest_sums", lambda: table_digest(orders).collect(), orders.count())
    timed("digest_bucketed", lambda: table_digest(orders, "bucketed").collect(), orders.count())
    timed(
        "compare_perturbed",
        lambda: noop(
            compare_tables(orders, checking._perturbed(spark, SF_DIR), ["o_orderkey"], "orders")
        ),
        2 * orders.count(),
    )
    timed(
        "lag_percentiles",
        lambda: checking.lag_percentiles(spark, SF_DIR).collect(),
        counts["activity"],
    )

    def stream() -> None:
        messages = read_changes(spark, paths["orders"], streaming=True, max_per_trigger=4)
        replica, progress = new_replica(spark, "bench"), fresh_dir(spark, "progress")
        run_stream(messages, replica, progress).awaitTermination()

    timed("stream_replica", stream, counts["orders"], repeats=2)

    print(
        json.dumps(
            {
                "metric": "replication_stages_total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "rates": rates,
                "messages": counts,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


def _seconds(run: Callable[[], object]) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


if __name__ == "__main__":
    main()
