from itertools import permutations

import pytest
from pyspark.sql import types as T

from tests.messages import FIRST, LATER, OK, SLOT, STATE, TAKEN, number
from tidemark.functions.wire import SchemaConflict, column_type
from tidemark.operators.schema import TableVersion, align_to, evolve_schema, version_of


def version(*fields, keys=("slot",)):
    return TableVersion("readings", tuple(column_type("readings", f) for f in fields), keys)


def test_keys_are_not_null_and_everything_else_is():
    schema = evolve_schema(None, [version(*FIRST)])
    assert {f.name: f.nullable for f in schema.fields} == {
        "meter": True, "slot": False, "kwh": True, "state": True, "taken": True, "ok": True
    }


def test_a_known_version_changes_nothing():
    schema = evolve_schema(None, [version(*LATER)])
    assert evolve_schema(schema, [version(*FIRST), version(*LATER)]) == schema


def test_the_order_of_versions_does_not_matter():
    versions = [
        version(SLOT, STATE, number("kwh", 2, 10)),
        version(SLOT, STATE, number("kwh", 4, 12)),
        version(SLOT, STATE, number("kwh", 0, 9), OK),
    ]
    results = {
        tuple(sorted((f.name, f.dataType.simpleString()) for f in evolve_schema(None, p).fields))
        for p in permutations(versions)
    }
    assert results == {
        (("kwh", "decimal(13,4)"), ("ok", "boolean"), ("slot", "int"), ("state", "string"))
    }


def test_decimals_without_precision_hold_the_others():
    schema = evolve_schema(None, [version(SLOT, number("kwh", 3, 9)), version(SLOT, number("kwh", 3))])
    assert schema["kwh"].dataType == T.DecimalType(38, 3)


def test_decimals_beyond_38_digits_conflict():
    with pytest.raises(SchemaConflict, match=r"readings\.kwh"):
        evolve_schema(None, [version(SLOT, number("kwh", 0, 38)), version(SLOT, number("kwh", 10, 38))])


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ({"type": "int32"}, {"type": "int64"}),
        ({"type": "int32"}, {"type": "string"}),
        ({"type": "float32"}, {"type": "float64"}),
        ({"type": "string"}, {"type": "string", "name": "io.debezium.data.Json"}),
        ({"type": "string"}, {"type": "int64", "name": "io.debezium.time.MicroTime"}),
        ({"type": "int64"}, {"type": "int64", "name": "io.debezium.time.MicroTimestamp"}),
    ],
)
def test_other_types_conflict(a, b):
    for x, y in ((a, b), (b, a)):
        with pytest.raises(SchemaConflict, match=r"readings\.x is kept as .* and comes as "):
            evolve_schema(None, [version(SLOT, {**x, "field": "x"}), version(SLOT, {**y, "field": "x"})])


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ({"type": "int8"}, {"type": "int16"}),
        ({"type": "string"}, {"type": "string", "name": "io.debezium.data.Enum"}),
        (
            {"type": "int64", "name": "io.debezium.time.Timestamp"},
            {"type": "int64", "name": "io.debezium.time.MicroTimestamp"},
        ),
    ],
)
def test_types_stored_alike_agree(a, b):
    evolve_schema(None, [version(SLOT, {**a, "field": "x"}), version(SLOT, {**b, "field": "x"})])


def test_align(spark):
    schema = evolve_schema(None, [version(SLOT, STATE, number("kwh", 3, 12), TAKEN)])
    df = align_to(spark.sql("select 1.25BD as kwh, 7 as slot, true as _deleted, 'u' as _op, 1 as other"), schema)
    assert df.columns == ["slot", "state", "kwh", "taken", "_deleted", "_op"]
    row = df.first()
    assert (row.slot, row.state, str(row.kwh)) == (7, None, "1.250")


def test_align_stops_at_values_that_do_not_fit(spark):
    narrow = evolve_schema(None, [version(SLOT, number("kwh", 2, 4))])
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        align_to(spark.sql("select 1 as slot, 123456.78BD as kwh"), narrow).collect()


def test_a_table_read_with_its_types_fits_its_messages():
    schema = evolve_schema(None, [version(*FIRST)])
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    assert evolve_schema(schema, [version_of("readings", plain, ["slot"])]) == schema
