import pytest
from pyspark.sql import functions as F

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


@pytest.fixture(scope="module")
def tables(spark):
    source = spark.sql("select id, concat('n', id) as name, if(id = 3, null, id / 2BD) as x from range(10)")
    target = spark.sql(
        "select id, if(id = 5, 'other', concat('n', id)) as name, if(id = 3, null, id / 2BD) as x, 1 as more"
        " from range(2, 12)"
    )
    return source, target


def test_compare(tables):
    r = compare_tables(*tables, ["id"], "t").first()
    assert (r.table, r.source_rows, r.target_rows) == ("t", 10, 10)
    assert (r.missing, r.extra, r.mismatched, r.ok) == (2, 2, 1, False)
    assert r.source_sha256 != r.target_sha256


def test_compare_equal_in_another_order_type_and_column_order(tables):
    source, _ = tables
    target = source.orderBy(F.desc("id")).select("x", "name", F.col("id").cast("int").alias("id"))
    r = compare_tables(source, target, ["id"]).first()
    assert (r.missing, r.extra, r.mismatched, r.ok) == (0, 0, 0, True)


def test_null_is_not_an_empty_text(spark):
    a, b = spark.sql("select 1 as id, '' as x"), spark.sql("select 1 as id, cast(null as string) as x")
    assert compare_tables(a, b, ["id"]).first().mismatched == 1


def test_a_missing_column_counts_as_null(spark):
    a, b = spark.sql("select 1 as id, 'x' as x"), spark.sql("select 1 as id")
    assert compare_tables(a, b, ["id"]).first().mismatched == 1
    assert compare_tables(a.withColumn("x", F.lit(None).cast("string")), b, ["id"]).first().ok


def test_compare_empty(tables):
    source, _ = tables
    r = compare_tables(source, source.limit(0), ["id"]).first()
    assert (r.source_rows, r.target_rows, r.missing, r.ok) == (10, 0, 10, False)
    r = compare_tables(source.limit(0), source.limit(0), ["id"]).first()
    assert (r.source_rows, r.missing, r.ok) == (0, 0, True)


def test_copies_of_a_key_are_told(spark):
    """Also when one key holds most rows."""
    many = spark.sql("select 1 as id, 'x' as x from range(5000) union all select id + 2, 'y' from range(10)")
    few = many.distinct()
    r = compare_tables(many, few, ["id"]).first()
    assert (r.source_rows, r.target_rows, r.source_duplicates, r.target_duplicates) == (11, 11, 4999, 0)
    assert (r.missing, r.extra, r.mismatched, r.ok) == (0, 0, 1, False)
    assert compare_tables(many, many, ["id"]).first().ok


@pytest.mark.parametrize(
    ("source", "target"),
    [
        ([(1, "a", "c")], [(1, "a", "c"), (1, "wrong", "c")]),
        ([(1, "a", "c")], [(1, "a", "c"), (1, "a", "c")]),
        ([(1, "a\x1fb", "c")], [(1, "a", "b\x1fc")]),
        ([(1, None, "c")], [(1, "\\N", "c")]),
        ([(1, "a", "c"), (1, "b", "d")], [(1, "a", "d"), (1, "b", "c")]),
    ],
)
def test_rows_that_look_alike_differ(spark, source, target):
    sides = [spark.createDataFrame(rows, "id int, x string, y string") for rows in (source, target)]
    r = compare_tables(*sides, ["id"]).first()
    assert (r.mismatched, r.ok) == (1, False)


@pytest.mark.parametrize("buckets", [1, 7, 65_536])
def test_localised_reports_are_the_same(tables, spark, buckets):
    source, target = tables
    cases = [(source, target), (target.drop("more"), source), (source, source.orderBy(F.desc("id"))), (source, source.limit(0)),
             (source.limit(0), source), (source.limit(0), source.limit(0)),
             (source, source.withColumn("id", F.col("id").cast("string"))), (source, source.drop("x"))]
    for a, b in cases:
        assert compare_localised(a, b, ["id"], "t", buckets).collect() == compare_tables(a, b, ["id"], "t").collect()
    many = source.union(source.where("id = 4"))
    r = compare_localised(source, many, ["id"], buckets=buckets).first()
    assert (r.missing, r.extra, r.mismatched, r.target_duplicates, r.ok) == (0, 0, 1, 1, False)
    assert compare_localised(many, many, ["id"], buckets=buckets).first().ok


def test_only_buckets_that_differ_are_opened(spark, monkeypatch):
    """Of equal tables no rows are shuffled; of others, those of few buckets."""
    from tidemark.operators import verify as module

    opened = []
    one_per_key = module._one_per_key
    monkeypatch.setattr(module, "_one_per_key", lambda sides, keys: opened.append(sides) or one_per_key(sides, keys))
    a = spark.range(5000).select("id", F.concat(F.lit("n"), "id").alias("name"))
    assert compare_localised(a, a, ["id"]).first().ok and opened == []
    b = a.withColumn("name", F.when(F.col("id") == 77, "x").otherwise(F.col("name")))
    r = compare_localised(a, b, ["id"]).first()
    assert (r.mismatched, r.source_rows, r.target_rows, r.ok) == (1, 5000, 5000, False)
    assert all(side.count() < 5 for side in opened[0])


def test_json_and_times_compare(spark):
    a = spark.sql("select 1 as id, '{\"b\":1, \"a\":2}' as doc, timestamp'2024-01-01 00:00:00Z' as at")
    b = spark.sql("select 1 as id, '{\"a\":2,\"b\":1}' as doc, timestamp'2024-01-01 01:00:00+01:00' as at")

    def as_json(df):
        return df.withMetadata("doc", {"kind": "json"})

    assert compare_tables(as_json(a), as_json(b), ["id"]).first().ok
    assert not compare_tables(a, b, ["id"]).first().ok


def test_typed_times_and_documents_compare(spark):
    """As the texts they would be kept as: a replica with types against a source with texts, and against itself."""
    spark.conf.set("spark.sql.timeType.enabled", "true")
    typed = spark.sql("""select 1 as id, time'12:30:00.5' as at, parse_json('{"b":1, "a":[2, null]}') as doc
        union all select 2, time'23:59:59.000001', null union all select 3, null, parse_json('"x"')""")
    texts = spark.sql("""select 1 as id, '12:30:00.500000' as at, '{"a":[2,null],"b":1}' as doc
        union all select 2, '23:59:59.000001', null union all select 3, null, '"x"'""")
    assert compare_tables(typed, typed, ["id"]).first().ok
    assert compare_tables(texts, typed, ["id"]).first().ok and compare_tables(typed, texts, ["id"]).first().ok
    other = typed.withColumn("doc", F.parse_json(F.lit('{"b":1}')))
    assert compare_tables(typed, other, ["id"]).first().mismatched == 3


def test_examples_are_the_first_of_each_kind(tables):
    found = sorted(diff_examples(*tables, ["id"], n=1).collect())
    assert [(r.kind, r.key) for r in found] == [("extra", "10"), ("mismatched", "5"), ("missing", "0")]
    assert found[1].source_row == "5\x1fn5\x1f2.500000" and found[1].target_row == "5\x1fother\x1f2.500000"
    assert found[0].source_row is None and found[2].target_row is None


def test_examples_on_composite_keys(spark):
    a = spark.sql("select 1 as i, 'a' as j, 5 as x union all select 1, 'b', 6")
    b = spark.sql("select 1 as i, 'a' as j, 5 as x union all select 1, 'b', 7")
    assert [(r.kind, r.key) for r in diff_examples(a, b, ["i", "j"]).collect()] == [("mismatched", "1,b")]


@pytest.mark.parametrize("mode", ["sums", "bucketed"])
def test_digests_see_rows_not_their_order(tables, mode):
    source, target = tables

    def digest(df):
        r = table_digest(df, mode).first()
        return r.rows, r.sha256

    assert digest(source) == digest(source.orderBy(F.desc("name")).repartition(3))
    assert digest(source) != digest(target.drop("more"))
    assert digest(source) != digest(source.union(source.where("id = 1")))
    assert digest(source) != digest(source.where("id <> 1"))


def test_bucketed_digest_of_many_copies(spark):
    df = spark.range(3000).union(spark.range(1).crossJoin(spark.range(2000)).select(F.lit(7).alias("id")))
    first, again = (table_digest(d, "bucketed").first() for d in (df, df.repartition(5)))
    assert first == again and first.rows == 5000


def test_verdict(tables):
    source, target = tables
    good, bad = compare_tables(source, source, ["id"]), compare_tables(source, target, ["id"])
    assert verdict(good).first().all_ok is True
    assert verdict(good.unionByName(bad)).first().all_ok is False


def test_consumer_lag(spark):
    high = spark.createDataFrame(
        [("cdc.a", 0, 10), ("cdc.a", 1, 10), ("cdc.b", 0, 10), ("cdc.b", 1, 5), ("other", 0, 99)],
        "topic string, partition int, high long",
    )
    done = spark.createDataFrame(
        [("cdc.a", 0, 4), ("cdc.a", 1, -1001), ("cdc.b", 1, 7)],
        "topic string, partition int, committed long",
    )
    lags = {(r.topic, r.partition): r.lag for r in partition_lag(high, done, "cdc.").collect()}
    assert lags == {("cdc.a", 0): 6, ("cdc.a", 1): 10, ("cdc.b", 0): 10, ("cdc.b", 1): 0}
    assert consumer_lag(high, done, "cdc.").first().lag == 26
    assert consumer_lag(high.limit(0), done).first().lag == 0


def test_caught_up(spark):
    markers = spark.createDataFrame([("m1",), ("m2",)], "id string")
    zero, one = (spark.sql(f"select {n}L as lag") for n in (0, 1))
    assert caught_up(markers, markers, zero).first().caught_up is True
    assert caught_up(markers, markers, one).first().caught_up is False
    r = caught_up(markers, markers.limit(1), zero).first()
    assert (r.markers, r.waiting, r.caught_up) == (2, 1, False)
