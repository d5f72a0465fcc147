import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators.stats import (
    LAG_BLOCK_MS,
    explode_counts,
    histogram_percentiles,
    lag_ms,
    merge_histograms,
)


@pytest.mark.parametrize(
    ("commit_us", "applied_us", "expected"),
    [(0, 999, 0), (0, 1000, 1), (0, 1999, 1), (5000, 0, 0), (1, 1000, 0), (0, 10**15, 10**12)],
)
def test_lag_is_whole_milliseconds(spark, commit_us, applied_us, expected):
    lag = lag_ms(F.timestamp_micros(F.lit(commit_us)), F.timestamp_micros(F.lit(applied_us)))
    assert spark.range(1).select(lag).first()[0] == expected


def nearest_rank(counts, q):
    total, seen = sum(counts.values()), 0
    for value in sorted(counts):
        seen += counts[value]
        if seen >= q * total:
            return value
    return 0


QS = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p999": 0.999, "p100": 1.0}


@pytest.mark.parametrize("spread", [1, 50, 3 * LAG_BLOCK_MS, 40 * 365 * 86_400_000])
def test_percentiles(spark, spread):
    rnd = random.Random(spread)
    counts = Counter({rnd.randrange(spread): rnd.randrange(1, 20) for _ in range(300)})
    histogram = spark.createDataFrame(list(counts.items()), "lag_ms long, n long")
    row = histogram_percentiles(histogram, QS).first()
    assert {name: row[name] for name in QS} == {name: nearest_rank(counts, q) for name, q in QS.items()}
    assert (row.max, row.events) == (max(counts), sum(counts.values()))


def test_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([], "lag_ms long, n long")
    row = histogram_percentiles(empty, QS).first()
    assert (row.p50, row.max, row.events) == (0, None, 0)


def test_percentiles_of_many_histograms_add_up(spark):
    rows = [(5, 1), (7, 1), (5, 3), (9, 1)]
    histogram = spark.createDataFrame(rows, "lag_ms long, n long")
    assert histogram_percentiles(histogram, {"p50": 0.5, "p99": 0.99}).first().p50 == 5
    merged = {r.lag_ms: r.n for r in merge_histograms(histogram).collect()}
    assert merged == {5: 4, 7: 1, 9: 1}


def test_counts_in_maps(spark):
    df = spark.createDataFrame([("a", {"c": 1, "u": 2}), ("b", {"c": 4})], "who string, ops map<string,long>")
    merged = merge_histograms(explode_counts(df, "ops", "op"), "op").collect()
    assert {r.op: r.n for r in merged} == {"c": 5, "u": 2}
