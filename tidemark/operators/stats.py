"""What a run did: events per kind, replication lag, totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

# Lags are ranked in two steps so that no task ever orders all of them: first by block of this many
# milliseconds (about 17 minutes), then within the blocks that matter.
LAG_BLOCK_MS = 1 << 20


def ops_counts(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return events.groupBy(*by, "_op").agg(F.count(F.lit(1)).alias("n"))


def lag_ms(commit_at: Column, applied_at: Column) -> Column:
    """Whole milliseconds from commit to apply, never negative."""
    micros = F.unix_micros(applied_at) - F.unix_micros(commit_at)
    return F.greatest(F.lit(0).cast("bigint"), F.call_function("div", micros, F.lit(1000)))


def lag_histogram(events: DataFrame, applied_at: Column, by: Sequence[str] = ()) -> DataFrame:
    """Events per whole millisecond of lag, superseded and stale ones included. Rows of a snapshot
    were committed long before it was taken, so their age says nothing and they do not count."""
    streamed = events.where(F.col("_op") != "r")
    lag = lag_ms(F.col("_src_commit_at"), applied_at).alias("lag_ms")
    return streamed.groupBy(*by, lag).agg(F.count(F.lit(1)).alias("n"))


def merge_histograms(histograms: DataFrame, value: str = "lag_ms", count: str = "n") -> DataFrame:
    """Adds up the histograms (or counts by name) of several consumers."""
    return histograms.groupBy(value).agg(F.sum(count).alias(count))


def explode_counts(df: DataFrame, column: str, value: str, count: str = "n") -> DataFrame:
    """A map of counts per row -> one row per entry."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.explode(column).alias(value, count))


def histogram_percentiles(
    histogram: DataFrame,
    quantiles: Mapping[str, float],
    value: str = "lag_ms",
    count: str = "n",
) -> DataFrame:
    """Nearest-rank percentiles, weighted: the smallest value at which the cumulated count reaches
    q times the total. One row: a column per quantile, ``max`` (NULL if empty) and ``events``. A
    percentile of nothing is 0."""
    fine = merge_histograms(histogram.select(value, count), value, count).withColumn(
        "_block", F.call_function("div", F.col(value), F.lit(LAG_BLOCK_MS))
    )
    blocks = fine.groupBy("_block").agg(
        F.sum(count).alias("_in_block"), F.max(value).alias("_max")
    )
    # One row per 17 minutes of lag: 30,000 for a year.
    ordered = Window.orderBy("_block")
    running = ordered.rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy(F.lit(1))
    ranked = blocks.select(
        "_block",
        (F.sum("_in_block").over(running) - F.col("_in_block")).alias("_before"),
        F.sum("_in_block").over(running).alias("_upto"),
        F.sum("_in_block").over(everything).alias("_total"),
        F.max("_max").over(everything).alias("_max"),
    )
    total = F.col("_total")
    hit = F.lit(False)
    for q in quantiles.values():
        target = F.lit(q) * total
        hit = hit | ((F.col("_before") < target) & (F.col("_upto") >= target)) | (
            (target <= 0) & (F.col("_before") == 0)
        )
    cumulated = F.col("_before") + F.sum(count).over(
        Window.partitionBy("_block").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    )
    # Only blocks in which a percentile falls, one per quantile at most.
    within = (
        fine.join(ranked.where(hit), "_block")
        .select(F.col(value).alias("_value"), cumulated.alias("_cumulated"), "_total", "_max")
    )
    return within.agg(
        *(
            F.coalesce(
                F.min(F.when(F.col("_cumulated") >= F.lit(q) * total, F.col("_value"))),
                F.lit(0).cast("bigint"),
            ).alias(name)
            for name, q in quantiles.items()
        ),
        F.max("_max").alias("max"),
        F.coalesce(F.max("_total"), F.lit(0).cast("bigint")).alias("events"),
    )


# ---- statistics kept with a replica

BATCH_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("consumer_id", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("batches", T.LongType()),
        T.StructField("received", T.LongType()),
        T.StructField("deduped", T.LongType()),
        T.StructField("applied", T.LongType()),
        T.StructField("stale", T.LongType()),
        T.StructField("ops", T.MapType(T.StringType(), T.LongType())),
        T.StructField("bad", T.LongType()),
    ]
)
LAG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("consumer_id", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("lag_ms", T.LongType()),
        T.StructField("n", T.LongType()),
    ]
)

# Messages set apart, with the reason.
BAD_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("consumer_id", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("why", T.StringType()),
    ]
)

COUNTERS = ("batches", "received", "deduped", "applied", "stale", "bad")


def run_summary(batches: DataFrame) -> DataFrame:
    """Totals per run over all its batches and consumers."""
    return batches.groupBy("run_id").agg(
        F.count_distinct("consumer_id").alias("consumers"),
        *(F.sum(c).alias(c) for c in COUNTERS),
        F.min("started_at").alias("started_at"),
        F.max("updated_at").alias("updated_at"),
    )


def run_ops(batches: DataFrame) -> DataFrame:
    """Events per run and kind of change."""
    return (
        explode_counts(batches.select("run_id", "ops"), "ops", "op")
        .groupBy("run_id", "op")
        .agg(F.sum("n").alias("n"))
    )
