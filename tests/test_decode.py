from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.messages import COMMIT_US, FIRST, KEY, LATER, change, column, digits, number, reading
from tidemark.functions.wire import LOGICAL_TYPES, LogicalType, SchemaConflict, column_type
from tidemark.operators.decode import (
    decode_rows,
    drop_tombstones,
    schema_versions,
    split_messages,
    validate_ops,
)
from tidemark.sources.changes import RAW_SCHEMA, read_changes, read_table, topic_pattern


def raw(spark, *messages):
    return spark.createDataFrame(list(messages), RAW_SCHEMA)


def decoded(spark, *messages, **options):
    parts = split_messages(raw(spark, *messages))
    tables = decode_rows(parts, schema_versions(parts), **options)
    assert len(tables) == 1
    return next(iter(tables.values()))


def rows(spark, *messages, **options):
    return decoded(spark, *messages, **options).events.orderBy("_src_pos").collect()


LOG = [
    change("r", reading(0, "raw", "12.5"), 700, file=9, row=0),
    change("c", reading(1, "raw", "-0.001", ok=None), 800, file=9, row=4),
    change("u", reading(1, "fixed", "999999.999"), 30, file=10),
    change("d", reading(0, "void", "0"), 31, file=10, offset=5),
]


def test_a_log_of_all_kinds(spark):
    """Every kind of change, over two log files, and the empty message that follows a delete."""
    topic, key, _, p, _ = LOG[-1]
    empty = (topic, key, None, p, 6)
    d = decoded(spark, *LOG, empty)
    assert (d.table, d.keys, len(d.versions)) == ("readings", ("meter", "slot"), 1)
    events = d.events.withColumn("taken_us", F.unix_micros("taken")).orderBy("_src_file", "_src_pos").collect()
    assert [(r._op, r._deleted, r.slot, r.state, str(r.kwh), r.ok) for r in events] == [
        ("r", False, 0, "raw", "12.500", True),
        ("c", False, 1, "raw", "-0.001", None),
        ("u", False, 1, "fixed", "999999.999", False),
        ("d", True, 0, "void", "0.000", True),  # all a delete has is the row before
    ]
    assert [(r._src_file, r._src_pos, r._src_row, r._offset) for r in events] == [
        (9, 700, 0, 700), (9, 800, 4, 800), (10, 30, 0, 30), (10, 31, 0, 5)
    ]
    assert [r.taken_us - COMMIT_US for r in events] == [m * 60_000_000 for m in (-15, -14, -14, -15)]
    messages = raw(spark, *LOG, empty)
    assert drop_tombstones(messages).count() == split_messages(messages).count() == len(LOG)


@pytest.mark.parametrize("picked", ["slot", "state", "kwh", "_op", "_deleted", "_src_commit_at"])
def test_no_column_is_read_past_a_bad_message(spark, picked):
    with pytest.raises(Exception, match="unsupported op t at plant.db.readings:0:44"):
        decoded(spark, *LOG, change("t", reading(3), 44)).events.select(picked).collect()


@pytest.mark.parametrize(
    ("described", "expected", "kind"),
    [
        ({"type": "int8"}, "smallint", "short"),
        ({"type": "int16"}, "smallint", "short"),
        ({"type": "int32"}, "int", "integer"),
        ({"type": "int64"}, "bigint", "long"),
        ({"type": "float32"}, "float", "float"),
        ({"type": "float64"}, "double", "double"),
        ({"type": "boolean"}, "boolean", "boolean"),
        ({"type": "string"}, "string", "string"),
        ({"type": "bytes"}, "binary", "binary"),
        ({"type": "string", "name": "io.debezium.time.ZonedTimestamp"}, "timestamp", "timestamptz"),
        ({"type": "string", "name": "io.debezium.data.Json"}, "string", "json"),
        ({"type": "string", "name": "io.debezium.data.Enum"}, "string", "string"),
        ({"type": "string", "name": "io.debezium.data.EnumSet"}, "string", "string"),
        ({"type": "int64", "name": "io.debezium.time.MicroTime"}, "string", "time"),
        ({"type": "int32", "name": "io.debezium.time.Date"}, "date", "date"),
        (number("x", 3), "decimal(38,3)", "decimal"),
        (number("x", 4, 12), "decimal(12,4)", "decimal"),
    ],
)
def test_type_map(described, expected, kind):
    c = column_type("t", {**described, "field": "x"})
    assert (c.target.simpleString(), c.kind) == (expected, kind)


def test_year_is_a_plain_integer():
    plain = column_type("t", {"type": "int32", "field": "x"})
    year = column_type("t", {"type": "int32", "name": "io.debezium.time.Year", "field": "x"})
    assert (plain.target, plain.kind) == (year.target, year.kind)


@pytest.mark.parametrize("primitive", ["struct", "array", "map"])
def test_nested_columns_are_rejected(primitive):
    with pytest.raises(SchemaConflict, match=r"t\.x"):
        column_type("t", {"type": primitive, "field": "x"})


WIDE = (
    *KEY,
    {"type": "int64", "name": "io.debezium.time.Timestamp", "field": "ms"},
    {"type": "int64", "name": "io.debezium.time.NanoTimestamp", "field": "ns"},
    {"type": "int64", "name": "io.debezium.time.MicroTime", "field": "tod"},
    {"type": "string", "name": "io.debezium.time.ZonedTimestamp", "field": "at"},
    {"type": "string", "name": "io.debezium.data.Json", "field": "doc"},
    {"type": "bytes", "field": "raw"},
    {"type": "boolean", "field": "yes"},
    {"type": "float64", "field": "x"},
    number("big", 10, 38),
)


def wide(**values):
    blank = {f["field"]: None for f in WIDE}
    return change("c", {**blank, "meter": "m", "slot": 1, **values}, 1, fields=WIDE)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_values_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        m = wide(
            ms=1_700_000_000_250,
            ns=-1,
            tod=86_400_000_000 + 3_600_000_001,
            at="2024-11-03T01:30:00-05:00",
            doc='{"b": 1, "a": [1, null]}',
            raw="AP8=",
            yes=True,
            x=1.5,
        )
        events = decoded(spark, m).events
        r = events.withColumn("at_us", F.unix_micros("at")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r.ms == datetime(2023, 11, 14, 22, 13, 20, 250000)
    assert r.ns == datetime(1969, 12, 31, 23, 59, 59, 999999)
    assert r.tod == "01:00:00.000001"
    assert r.at_us == datetime(2024, 11, 3, 6, 30, tzinfo=timezone.utc).timestamp() * 1_000_000
    assert r.doc == '{"a":[1,null],"b":1}'
    assert (bytes(r.raw), r.yes, r.x) == (b"\x00\xff", True, 1.5)


@pytest.mark.parametrize(
    "text",
    ["0", "1", "-1", "1.28", "-1.28", "-1.29", "92233720368547758.07", "-92233720368547758.09"]
    + ["9999999999999999999999999999.9999999999", "-9999999999999999999999999999.9999999999"],
)
def test_decimals_are_exact(spark, text):
    import decimal

    with decimal.localcontext(prec=60):
        (r,) = rows(spark, wide(big=digits(text, 10)))
        assert r.big == Decimal(text)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_that_do_not_fit_stop(spark, ansi):
    import decimal

    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with decimal.localcontext(prec=60):
            for text in ("1" + "0" * 28, "1" + "0" * 40, "-1" + "0" * 28):
                with pytest.raises(Exception, match="does not fit decimal|OUT_OF_RANGE"):
                    rows(spark, wide(big=digits(text, 10)))
            with pytest.raises(Exception, match="does not fit timestamp"):
                rows(spark, wide(at="yesterday-ish"))
            (r,) = rows(spark, wide(big=digits("1.5", 10)))
            assert r.big == Decimal("1.5")
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_nulls_stay_null(spark):
    (r,) = rows(spark, wide())
    assert all(r[f["field"]] is None for f in WIDE[2:])


def test_a_field_the_image_lacks_is_null(spark):
    image = reading(1)
    del image["ok"]
    (r,) = rows(spark, change("c", image, 1))
    assert r.ok is None


def test_commit_time_falls_back_to_milliseconds(spark):
    (r,) = rows(spark, change("c", reading(1), 1, ts_us=0, ts_ms=COMMIT_US // 1000 + 5))
    assert r._src_commit_at == datetime(2025, 3, 30, 1, 15, 0, 5000)


def test_a_null_row_number_is_zero(spark):
    (r,) = rows(spark, change("c", reading(1), 1, row=None))
    assert r._src_row == 0


def test_messages_with_blanks_decode_alike(spark):
    a, b = rows(spark, change("c", reading(1), 1), change("c", reading(1), 2, blanks=True))
    assert a[:5] == b[:5]


def test_unknown_ops_stop(spark):
    with pytest.raises(Exception, match="unsupported op t at plant.db.readings:0:1"):
        rows(spark, change("t", reading(1), 1))
    with pytest.raises(Exception, match="unsupported op t"):
        validate_ops(raw(spark, change("t", reading(1), 1))).collect()


def test_unknown_ops_in_quarantine(spark):
    messages = raw(spark, change("t", reading(1), 1), change("c", reading(1), 2))
    good, bad = validate_ops(messages, on_bad="quarantine")
    assert good.count() == 1
    assert [r.op for r in bad.collect()] == ["t"]


@pytest.mark.parametrize(
    ("message", "why"),
    [
        (change("c", None, 1), "no row image"),
        (change("c", {**reading(1), "slot": None}, 1), "no key"),
        (change("c", reading(1), None, offset=1), "no position"),
    ],
)
def test_missing_parts(spark, message, why):
    with pytest.raises(Exception, match=why):
        rows(spark, message)
    (r,) = rows(spark, message, on_bad="flag")
    assert r._bad == why


def test_broken_json_and_wrong_types_stop(spark):
    topic, key, value, p, o = change("c", reading(1), 1)
    with pytest.raises(Exception, match="MALFORMED"):
        rows(spark, (topic, key, value[:-3], p, o))
    with pytest.raises(Exception, match="MALFORMED|PARSE"):
        rows(spark, change("c", {**reading(1), "state": 1, "ok": "x"}, 1))


def test_tables_without_a_key_are_rejected(spark):
    with pytest.raises(SchemaConflict, match="primary key"):
        decoded(spark, change("c", reading(1), 1, keys=()))


def test_messages_without_a_schema_are_rejected(spark):
    topic, key, value, p, o = change("c", reading(1), 1)
    cut = value.index(',"payload":')
    for bare in ('{"schema":null' + value[cut:], "{" + value[cut + 1 :]):
        with pytest.raises(SchemaConflict, match="no schema"):
            decoded(spark, (topic, key, bare, p, o))


def test_a_column_may_be_named_payload(spark):
    fields = (*FIRST, column("payload", "string"))
    image = reading(1, payload=',"payload":{}')
    for blanks in (False, True):
        (r,) = rows(spark, change("c", image, 1, fields=fields, blanks=blanks))
        assert (r.payload, r.state) == (',"payload":{}', "raw")


def test_reserved_names_are_rejected(spark):
    field = {"type": "string", "field": "_deleted"}
    with pytest.raises(SchemaConflict, match="_deleted"):
        decoded(spark, change("c", reading(1, _deleted="x"), 1, fields=(*FIRST, field)))
    field = {"type": "string", "field": "STATE"}
    with pytest.raises(SchemaConflict, match="case"):
        decoded(spark, change("c", reading(1, STATE="x"), 1, fields=(*FIRST, field)))


def test_versions_of_one_batch(spark):
    wider = tuple(number("kwh", 4, 14) if f["field"] == "kwh" else f for f in LATER)
    a, b, c = rows(
        spark,
        change("c", reading(1, kwh="1.25"), 1),
        change("c", reading(2, note="gold"), 2, fields=LATER),
        change("c", {**reading(3, note="x"), "kwh": digits("9999999999.1234", 4)}, 3, fields=wider),
    )
    assert [r.note for r in (a, b, c)] == [None, "gold", "x"]
    assert [r.kwh for r in (a, b, c)] == [Decimal("1.25"), Decimal("0.375"), Decimal("9999999999.1234")]


def test_names_with_dots_and_ticks(spark):
    field = {"type": "string", "field": "a.b`c"}
    (r,) = rows(spark, change("c", reading(1, **{"a.b`c": "x"}), 1, fields=(*FIRST, field)))
    assert r["a.b`c"] == "x"


def test_more_logical_types_can_be_given(spark):
    from pyspark.sql import types as T

    more = {**LOGICAL_TYPES, "my.Upper": LogicalType(T.StringType(), T.StringType(), "string", F.upper)}
    field = {"type": "string", "name": "my.Upper", "field": "loud"}
    parts = split_messages(raw(spark, change("c", reading(1, loud="x"), 1, fields=(*FIRST, field))))
    assert decode_rows(parts, schema_versions(parts, more))["readings"].events.first().loud == "X"


def test_reading_source_tables(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert read_table(spark, str(tmp_path / "t")).count() == 3
    spark.range(3).write.csv(str(tmp_path / "csv"))
    options = {"format": "csv", "path": str(tmp_path / "csv"), "inferSchema": "true"}
    assert read_table(spark, options).count() == 3


def test_reading_messages(spark, tmp_path):
    assert read_changes(spark, str(tmp_path / "none")).count() == 0
    raw(spark, change("c", reading(1), 1)).write.parquet(str(tmp_path / "some"))
    assert read_changes(spark, str(tmp_path / "some")).schema == RAW_SCHEMA
    raw(spark, change("c", reading(1), 1)).write.json(str(tmp_path / "json"))
    assert read_changes(spark, str(tmp_path / "json"), file_format="json").count() == 1
    assert topic_pattern("feed", "db") == r"^feed\.db\..*"
