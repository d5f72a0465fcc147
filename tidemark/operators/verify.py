"""Is the replica equal to its source? Row by row, at scale.

For each key, the rows of both sides are compared as multisets: *missing* keys are only in the source, *extra* ones only
in the replica, *mismatched* ones in both with other rows, or with more copies of one.

What is shuffled is keys and SHA-256 hashes of rows, as numbers that add up: copies of a key collapse to sums before the
shuffle, and a table's digest is made of the same sums. The hashed form gives each field's length and tells NULL from
any text, so different rows have different forms. Tables that hardly differ needn't be shuffled at all, see
``compare_localised``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions.columns import cols, quoted, same_keys
from tidemark.functions.text import field_text, row_text
from tidemark.operators.replica import Replica

# Hex digits of a hash that the groups of the bucketed digest share, at the lowest level.
_DEPTH = 8

# A row's hash as eight numbers of 32 bits; a 64-bit sum holds two billion of them.
_PARTS = [f"_h{i}" for i in range(8)]
# Groups that totals are added up in before they become decimals.
_GROUPS = 256

# Groups of keys whose sums are compared before any rows are.
LOCAL_BUCKETS = 65_536


# ---- comparison


def compare_tables(
    source: DataFrame, target: DataFrame, keys: Sequence[str], table: str = ""
) -> DataFrame:
    """One row of counts and digests for a table. Only the source's columns are compared; one the
    target lacks counts as NULL. Rows that share a key count once, as in a keyed table; how many
    more there are is reported."""
    joined = _joined_by_key(source, target, keys)
    group = F.pmod(F.xxhash64(*(F.coalesce(F.col(f"s.{quoted(k)}"), F.col(f"t.{quoted(k)}")) for k in keys)), F.lit(_GROUPS))
    grouped = joined.groupBy(group.alias("_group")).agg(
        F.count("s._copies").alias("source_rows"),
        F.count("t._copies").alias("target_rows"),
        F.count_if(_missing()).alias("missing"),
        F.count_if(_extra()).alias("extra"),
        F.count_if(_mismatched()).alias("mismatched"),
        F.sum(F.col("s._copies") - 1).alias("source_duplicates"),
        F.sum(F.col("t._copies") - 1).alias("target_duplicates"),
        *(F.sum(f"{side}.{p}").alias(f"_{side}{p}") for side in "st" for p in _PARTS),
    )
    none = F.lit(0).cast("bigint")
    counts = [c for c in grouped.columns if not c.startswith("_")]
    totals = grouped.agg(*(F.coalesce(F.sum(c), none).alias(c) for c in counts), *_totals("_s"), *_totals("_t"))
    return _report(totals, table)


def _report(totals: DataFrame, table: str) -> DataFrame:
    report = totals.select(
        F.lit(table).alias("table"),
        "source_rows",
        "target_rows",
        "missing",
        "extra",
        "mismatched",
        "source_duplicates",
        "target_duplicates",
        _digest(F.col("source_rows") + F.col("source_duplicates"), "_s").alias("source_sha256"),
        _digest(F.col("target_rows") + F.col("target_duplicates"), "_t").alias("target_sha256"),
    )
    differences = F.col("missing") + F.col("extra") + F.col("mismatched")
    return report.withColumn(
        "ok", (differences == 0) & (F.col("source_sha256") == F.col("target_sha256"))
    )


def compare_localised(
    source: DataFrame, target: DataFrame, keys: Sequence[str], table: str = "", buckets: int = LOCAL_BUCKETS
) -> DataFrame:
    """The report of ``compare_tables`` for tables that hardly differ: rows are compared only where they do.

    Keys are dealt by hash into ``buckets``, and both sides' rows are added up by bucket: that shuffles sums, ``buckets`` rows at most
    from a task, and finds the buckets that differ. Only their rows are compared key by key; of equal tables none. Sums of row
    hashes are equal for equal multisets of rows, and for others but by collision. Row counts of buckets that are equal are
    those of rows, so copies of a key that are on both sides alike count as rows, not as duplicates.
    """
    sides = _hashed_sides(source, target, keys, buckets)
    sums = [
        side.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"), *(F.sum(p).alias(p) for p in _PARTS))
        for side in sides
    ]
    same = F.lit(True)
    for c in ("_rows", *_PARTS):
        same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}"))
    both = sums[0].alias("s").join(sums[1].alias("t"), F.col("s._bucket") == F.col("t._bucket"), "full_outer").select(
        F.coalesce("s._bucket", "t._bucket").alias("_bucket"), same.alias("_same"),
        *(F.col(f"{side}.{c}").alias(f"_{side}{c}") for side in "st" for c in ("_rows", *_PARTS)),
    )
    none = F.lit(0).cast("bigint")
    rows = [F.coalesce(F.sum(F.when(F.col("_same"), F.col(f"_{side}_rows"))), none) for side in "st"]
    found = both.agg(
        rows[0].alias("source_rows"), rows[1].alias("target_rows"),
        *(none.alias(c) for c in ("missing", "extra", "mismatched", "source_duplicates", "target_duplicates")),
        *_totals("_s"), *_totals("_t"), F.collect_list(F.when(~F.col("_same"), F.col("_bucket"))).alias("open"),
    )
    *values, open_ = found.first()  # one row, and at most a number per bucket
    spark = source.sparkSession
    totals = spark.createDataFrame([tuple(values)], T.StructType(found.schema.fields[:-1]))
    if not open_:
        return _report(totals, table)
    few = F.broadcast(spark.createDataFrame([(b,) for b in open_], "_bucket int"))
    opened = [side.join(few, "_bucket", "left_semi") for side in sides]
    joined = _one_per_key(opened, keys)
    counted = joined.agg(
        F.count("s._copies").alias("source_rows"),
        F.count("t._copies").alias("target_rows"),
        F.count_if(_missing()).alias("missing"),
        F.count_if(_extra()).alias("extra"),
        F.count_if(_mismatched()).alias("mismatched"),
        F.coalesce(F.sum(F.col("s._copies") - 1), none).alias("source_duplicates"),
        F.coalesce(F.sum(F.col("t._copies") - 1), none).alias("target_duplicates"),
    )
    # The digests' sums are known; the counts of equal and of opened buckets add up.
    digests = [c for c in totals.columns if c.startswith("_")]
    both = totals.unionByName(
        counted.select("*", *(F.lit(0).cast("decimal(38,0)").alias(c) for c in digests)))
    return _report(both.agg(*(F.sum(c).cast(both.schema[c].dataType).alias(c) for c in both.columns)), table)


def diff_examples(
    source: DataFrame, target: DataFrame, keys: Sequence[str], n: int = 2
) -> DataFrame:
    """The first ``n`` differences of each kind by key: (kind, key, source_row, target_row)."""
    joined = _joined_by_key(source, target, keys)
    kind = (
        F.when(_missing(), F.lit("missing"))
        .when(_extra(), F.lit("extra"))
        .when(_mismatched(), F.lit("mismatched"))
    )
    key_columns = [
        F.coalesce(F.col(f"s.{quoted(k)}"), F.col(f"t.{quoted(k)}")).alias(k) for k in keys
    ]
    found = joined.select(kind.alias("_kind"), *key_columns).where(F.col("_kind").isNotNull())
    by_key = Window.partitionBy("_kind").orderBy(*cols(keys))
    first = found.withColumn("_nth", F.row_number().over(by_key)).where(F.col("_nth") <= n)
    # At most 3n rows: small enough to look their texts up by broadcast.
    few = F.broadcast(first).alias("d")
    lines = []
    for df in (source, _with_columns_of(target, source)):
        keyed = _keyed(df, source, target, keys, row_text(df, source.columns).alias("_line"))
        lines.append(
            keyed.alias("r")
            .join(few, same_keys("r", "d", keys))
            .groupBy("d._kind", *(F.col(f"d.{quoted(k)}") for k in keys))
            .agg(F.min("_line").alias("_line"))
        )
    both = ["_kind", *keys]
    found = first.drop("_nth")
    for df, side in zip(lines, ("source_row", "target_row"), strict=True):
        found = found.join(df.withColumnRenamed("_line", side), both, "left")
    return found.select(
        F.col("_kind").alias("kind"),
        F.concat_ws(",", *(field_text(first.schema[k]) for k in keys)).alias("key"),
        "source_row",
        "target_row",
    )


def _missing() -> Column:
    return F.col("t._copies").isNull()


def _extra() -> Column:
    return F.col("s._copies").isNull()


def _mismatched() -> Column:
    differ = [F.col(f"s.{p}") != F.col(f"t.{p}") for p in ("_copies", *_PARTS)]
    return reduce(Column.__or__, differ)


def _joined_by_key(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _one_per_key(_hashed_sides(source, target, keys), keys)


def _hashed_sides(
    source: DataFrame, target: DataFrame, keys: Sequence[str], buckets: int | None = None
) -> list[DataFrame]:
    """Keys and hashes of both sides' rows, and a bucket by key if asked for."""
    sides = []
    for df in (source, _with_columns_of(target, source)):
        row_hash = F.sha2(_distinct_form(df, source.columns), 256).alias("_hash")
        keyed = _keyed(df, source, target, keys, row_hash)
        bucket = [F.pmod(F.hash(*cols(keys)), F.lit(buckets)).alias("_bucket")] if buckets else []
        sides.append(keyed.select(*cols(keys), *bucket, *_parts_of("_hash")))
    return sides


def _one_per_key(sides: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    # Partial aggregation collapses copies of a key before the shuffle the join needs anyway. On
    # numbers it hashes; on texts it would sort.
    source, target = (
        side.groupBy(*cols(keys)).agg(
            *(F.sum(p).alias(p) for p in _PARTS), F.count(F.lit(1)).alias("_copies")
        ).alias(name)
        for name, side in zip("st", sides, strict=True)
    )
    return source.join(target, same_keys("s", "t", keys), "full_outer")


def _keyed(
    df: DataFrame, source: DataFrame, target: DataFrame, keys: Sequence[str], *more: Column
) -> DataFrame:
    """Keys as they are if both sides store them alike, else as text."""
    picked = [
        F.col(quoted(k))
        if source.schema[k].dataType == target.schema[k].dataType
        else field_text(df.schema[k]).alias(k)
        for k in keys
    ]
    return df.select(*picked, *more)


def _with_columns_of(target: DataFrame, source: DataFrame) -> DataFrame:
    have = set(target.columns)
    return target.select(
        *(
            F.col(quoted(f.name)) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in source.schema.fields
        )
    )


# ---- digests


def table_digest(df: DataFrame, mode: str = "sums") -> DataFrame:
    """One row (``rows``, ``sha256``) that does not depend on the order of rows.

    ``sums``      adds up the row hashes, as numbers; needs no shuffle of rows
    ``bucketed``  hashes sorted row hashes, grouped by their first eight hex digits, then the groups'
                  hashes, two digits shorter at a time

    Both are the same formula at every size: 10^12 rows make some 230 entries a group.
    """
    hashed = df.select(F.sha2(_distinct_form(df, df.columns), 256).alias("_hash"))
    if mode == "sums":
        group = F.pmod(F.xxhash64("_hash"), F.lit(_GROUPS)).alias("_group")
        grouped = hashed.select(group, *_parts_of("_hash")).groupBy("_group").agg(
            F.count(F.lit(1)).alias("rows"), *(F.sum(p).alias(p) for p in _PARTS))
        sums = grouped.agg(F.coalesce(F.sum("rows"), F.lit(0).cast("bigint")).alias("rows"), *_totals(""))
        return sums.select("rows", _digest(F.col("rows"), "").alias("sha256"))
    if mode != "bucketed":
        raise ValueError(f"unknown digest mode {mode!r}")
    return _bucketed_digest(hashed.withColumnRenamed("_hash", "_prefix"))


def _bucketed_digest(hashes: DataFrame) -> DataFrame:
    # Equal rows become one entry with a count, so that many copies do not fill a group.
    level = hashes.groupBy("_prefix").agg(F.count(F.lit(1)).alias("_rows"))
    level = level.withColumn("_entry", F.concat_ws(":", "_prefix", "_rows"))
    for digits in range(_DEPTH, -1, -2):
        level = (
            level.groupBy(F.substring("_prefix", 1, digits).alias("_prefix"))
            .agg(
                F.sum("_rows").alias("_rows"),
                F.sort_array(F.collect_list(F.struct("_prefix", "_entry"))).alias("_sorted"),
            )
            .select(
                "_prefix",
                "_rows",
                F.sha2(
                    F.concat(F.array_join(F.col("_sorted._entry"), "\n"), F.lit("\n")), 256
                ).alias("_entry"),
            )
        )
    return level.agg(
        F.coalesce(F.sum("_rows"), F.lit(0).cast("bigint")).alias("rows"),
        F.coalesce(F.max("_entry"), F.sha2(F.lit(""), 256)).alias("sha256"),
    )


def _distinct_form(df: DataFrame, columns: Sequence[str]) -> Column:
    """A text that no other row has: each field with its length, or a mark of its own for NULL."""
    fields = []
    for c in columns:
        text = field_text(df.schema[c])
        sized = F.concat(F.char_length(text).cast("string"), F.lit(":"), text)
        fields.append(F.when(F.col(quoted(c)).isNull(), F.lit("-")).otherwise(sized))
    return F.concat_ws(",", *fields)


def _parts_of(row_hash: str) -> list[Column]:
    """All 64 digits of a row hash, as numbers that can be summed."""
    return [F.conv(F.substring(row_hash, 1 + i * 8, 8), 16, 10).cast("bigint").alias(p) for i, p in enumerate(_PARTS)]


def _totals(prefix: str) -> list[Column]:
    """Sums of sums, in 38 digits, so for 10^18 rows."""
    zero = F.lit(0).cast("decimal(38,0)")
    return [
        F.coalesce(F.sum(F.col(prefix + p).cast("decimal(28,0)")), zero).alias(prefix + p) for p in _PARTS
    ]


def _digest(rows: Column, prefix: str) -> Column:
    """SHA-256 over the number of rows and the sums of each 16 digits of their hashes."""
    parts = [rows.cast("string")]
    for high, low in zip(_PARTS[::2], _PARTS[1::2], strict=True):
        whole = F.col(prefix + high) * F.lit(1 << 32).cast("decimal(10,0)") + F.col(prefix + low)
        parts.append(whole.cast("decimal(38,0)").cast("string"))
    return F.sha2(F.concat_ws(":", *parts), 256)


# ---- verdicts


def verdict(reports: DataFrame) -> DataFrame:
    """One row: are all tables equal?"""
    return reports.agg(
        F.count(F.lit(1)).alias("tables"),
        F.coalesce(F.bool_and("ok"), F.lit(True)).alias("all_ok"),
    )


def verify(
    replica: Replica,
    sources: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    version: int | None = None,
    localised: bool = False,
) -> DataFrame:
    """A report per source table, in name order. A table the replica does not have counts as empty. ``localised`` compares rows only
    where sums differ, for tables that hardly do."""
    targets = _targets(replica, sources, version)
    compare = compare_localised if localised else compare_tables
    reports = [compare(sources[t], target, keys[t], t) for t, target in targets.items()]
    return reduce(DataFrame.unionByName, reports)


def verify_examples(
    replica: Replica,
    sources: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    n: int = 2,
    version: int | None = None,
) -> DataFrame:
    """The first ``n`` differences of each kind and table: (table, kind, key, source_row, target_row)."""
    found = []
    for t, target in _targets(replica, sources, version).items():
        examples = diff_examples(sources[t], target, keys[t], n)
        found.append(examples.select(F.lit(t).alias("table"), "*"))
    return reduce(DataFrame.unionByName, found)


def _targets(
    replica: Replica, sources: Mapping[str, DataFrame], version: int | None
) -> dict[str, DataFrame]:
    """Live rows of the source's tables, all of one version, whatever is published meanwhile."""
    version = replica.latest() if version is None else version
    here = replica.version(version).tables
    return {
        t: replica.live(t, version) if t in here else sources[t].limit(0) for t in sorted(sources)
    }


def partition_lag(
    high: DataFrame, committed: DataFrame, topic_prefix: str | None = None
) -> DataFrame:
    """Messages per topic partition that are not committed yet. No commit (absent, or negative)
    counts as 0."""
    if topic_prefix is not None:
        high = high.where(F.col("topic").startswith(topic_prefix))
    done = F.greatest(F.coalesce(F.col("committed"), F.lit(0)), F.lit(0))
    joined = high.select("topic", "partition", "high").join(
        committed.select("topic", "partition", "committed"), ["topic", "partition"], "left"
    )
    return joined.select(
        "topic", "partition", F.greatest(F.lit(0), F.col("high") - done).alias("lag")
    )


def consumer_lag(
    high: DataFrame, committed: DataFrame, topic_prefix: str | None = None
) -> DataFrame:
    """One row: messages not committed yet over all partitions."""
    lags = partition_lag(high, committed, topic_prefix)
    return lags.agg(F.coalesce(F.sum("lag"), F.lit(0).cast("bigint")).alias("lag"))


def caught_up(
    markers: DataFrame, replica_markers: DataFrame, lag: DataFrame, key: str = "id"
) -> DataFrame:
    """One row: has every marker arrived, and is nothing left to consume?"""
    arrived = replica_markers.select(F.col(quoted(key)), F.lit(True).alias("_arrived"))
    waiting = markers.join(arrived, key, "left").agg(
        F.count(F.lit(1)).alias("markers"),
        F.count_if(F.col("_arrived").isNull()).alias("waiting"),
    )
    # Two single rows into one.
    none = F.lit(0).cast("bigint")
    both = waiting.withColumn("lag", none).unionByName(
        lag.select(none.alias("markers"), none.alias("waiting"), "lag")
    )
    totals = both.agg(*(F.sum(c).alias(c) for c in ("markers", "waiting", "lag")))
    return totals.withColumn("caught_up", (F.col("waiting") == 0) & (F.col("lag") == 0))
