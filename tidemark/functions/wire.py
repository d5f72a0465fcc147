"""Wire types of change messages and their exact Spark types.

A message carries its own schema. Each column of it names a primitive type and, optionally, a
logical type; the logical type decides first. This module turns one such column description into a
``ColumnType``: the type ``from_json`` reads, the type the replica stores, and the built-in
expression between the two. No UDF is involved.

Differences from a row store that has unbounded types:

* decimals are exact up to 38 digits, beyond that the job stops;
* a time of day is kept as text ``HH:mm:ss.SSSSSS``, JSON documents as canonical text (keys sorted, no blanks), so equal
  documents compare equal. With ``TYPED_LOGICAL_TYPES`` they are kept as TIME, which Spark has behind the flag
  ``spark.sql.timeType.enabled``, and VARIANT, and compare by the same texts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F, types as T

DECIMAL = "org.apache.kafka.connect.data.Decimal"
JSON = "io.debezium.data.Json"

# Metadata of a replica column: what it is in the source. Columns of different kinds never mix, even
# where Spark stores them alike (JSON and text, say).
KIND = "kind"

# Kinds that are not named like the Spark type.
KINDS = {"timestamp_ntz": "timestamp", "timestamp": "timestamptz", "variant": "json"}

MICROS_PER_DAY = 86_400_000_000
MAX_DECIMAL_DIGITS = 38

Convert = Callable[[Column], Column]


class SchemaConflict(RuntimeError):
    """The source schema cannot be reconciled with the replica's."""


@dataclass(frozen=True)
class LogicalType:
    """How one logical type is read from JSON, stored, and converted. With ``partial``, a value that
    can't be converted becomes NULL, and is an error of its message."""

    wire: T.DataType
    target: T.DataType
    kind: str
    convert: Convert
    partial: bool = False


@dataclass(frozen=True)
class ColumnType:
    """One column of one table version. ``rule`` identifies the conversion, so that two versions of
    a table can share it when it did not change."""

    name: str
    wire: T.DataType
    target: T.DataType
    kind: str
    rule: str
    convert: Convert = field(compare=False, hash=False, repr=False)
    partial: bool = False


def _same(value: Column) -> Column:
    return value


def epoch_to_ntz(value: Column, unit: str = "MICROSECOND") -> Column:
    """Epoch count -> timestamp without zone. 1970-01-01 has no zone here, so adding the count is
    plain arithmetic and does not depend on the session time zone."""
    return F.timestamp_add(unit, value, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def _millis_to_ntz(value: Column) -> Column:
    most = (2**63 - 1) // 1000
    return F.when(value.between(-most, most), epoch_to_ntz(value, "MILLISECOND"))


def _nanos_to_ntz(value: Column) -> Column:
    # Rounds towards minus infinity; integer division would round towards zero.
    down = F.call_function("div", value - F.pmod(value, F.lit(1000)), F.lit(1000))
    return F.when(value >= -(2**63) + 1000, epoch_to_ntz(down))


def _time_of_day(value: Column) -> Column:
    return F.date_format(epoch_to_ntz(F.pmod(value, F.lit(MICROS_PER_DAY))), "HH:mm:ss.SSSSSS")


def canonical_json(value: Column) -> Column:
    return F.to_json(F.parse_json(value))


def _json_or_null(value: Column) -> Column:
    return F.to_json(F.try_parse_json(value))


def decimal_from_bytes(precision: int, scale: int) -> Convert:
    """Big-endian two's complement integer -> decimal(precision, scale). Up to 18 digits it fits eight
    bytes, beyond that sixteen; anything longer does not fit."""
    target = T.DecimalType(precision, scale)

    def convert(value: Column) -> Column:
        digits = F.hex(value)
        sign = F.when(F.substring(digits, 1, 1) >= "8", "F").otherwise("0")
        short = F.conv(F.lpad(digits, 16, sign), 16, -10)
        unscaled = F.when(F.length(digits) <= 16, short)
        if precision > 18:
            unscaled = unscaled.when(F.length(digits) <= 32, wide(F.lpad(digits, 32, sign)))
        number = F.concat(unscaled, F.lit(f"E{-scale}"))
        return number.try_cast(target)

    def wide(digits: Column) -> Column:
        high = F.conv(F.substring(digits, 1, 16), 16, -10).cast("decimal(20,0)")
        low = F.conv(F.substring(digits, 17, 16), 16, 10).cast("decimal(20,0)")
        two_64 = F.lit("18446744073709551616").cast("decimal(20,0)")
        # Borrow from the low half when negative: high * 2^64 alone may leave the 38 digits.
        borrow = high < 0
        high = F.when(borrow, high + 1).otherwise(high)
        low = F.when(borrow, low - two_64).otherwise(low)
        return (high * two_64 + low).cast("string")

    return convert


def strictly(value: Column, converted: Column, target: T.DataType) -> Column:
    """A value that cannot be converted stops the job, also in a session without ANSI mode."""
    shown = F.hex(value) if isinstance(target, T.DecimalType) else value
    failure = F.raise_error(F.concat(shown, F.lit(f" does not fit {target.simpleString()}")))
    return F.coalesce(converted, F.when(value.isNotNull(), failure.cast(target)))


# Primitive wire type -> Spark type. The JSON reader decodes base64 into bytes itself.
PRIMITIVES: dict[str, T.DataType] = {
    "int8": T.ShortType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "bytes": T.BinaryType(),
}

# Logical type name -> how it is read and stored.
LOGICAL_TYPES: dict[str, LogicalType] = {
    "io.debezium.time.Date": LogicalType(
        T.IntegerType(), T.DateType(), "date", F.date_from_unix_date
    ),
    "io.debezium.time.Timestamp": LogicalType(
        T.LongType(),
        T.TimestampNTZType(),
        "timestamp",
        _millis_to_ntz,
        partial=True,
    ),
    "io.debezium.time.MicroTimestamp": LogicalType(
        T.LongType(), T.TimestampNTZType(), "timestamp", epoch_to_ntz
    ),
    "io.debezium.time.NanoTimestamp": LogicalType(
        T.LongType(), T.TimestampNTZType(), "timestamp", _nanos_to_ntz, partial=True
    ),
    "io.debezium.time.ZonedTimestamp": LogicalType(
        T.StringType(),
        T.TimestampType(),
        "timestamptz",
        lambda v: v.try_cast("timestamp"),
        partial=True,
    ),
    "io.debezium.time.MicroTime": LogicalType(T.LongType(), T.StringType(), "time", _time_of_day),
    "io.debezium.time.Year": LogicalType(T.IntegerType(), T.IntegerType(), "integer", _same),
    JSON: LogicalType(T.StringType(), T.StringType(), "json", _json_or_null, partial=True),
    "io.debezium.data.Enum": LogicalType(T.StringType(), T.StringType(), "string", _same),
}


# The same, with a type of its own for times of day and JSON.
TYPED_LOGICAL_TYPES: dict[str, LogicalType] = {
    **LOGICAL_TYPES,
    "io.debezium.time.MicroTime": LogicalType(
        T.LongType(), T.TimeType(6), "time", lambda v: _time_of_day(v).cast(T.TimeType(6))
    ),
    JSON: LogicalType(T.StringType(), T.VariantType(), "json", F.try_parse_json, partial=True),
}


def column_type(
    table: str,
    described: Mapping[str, object],
    logical_types: Mapping[str, LogicalType] = LOGICAL_TYPES,
) -> ColumnType:
    """Column description out of a message schema -> ``ColumnType``."""
    name = str(described["field"])
    logical = described.get("name")
    if logical == DECIMAL:
        parameters = dict(described.get("parameters") or {})  # type: ignore[call-overload]
        scale = int(parameters["scale"])
        precision = int(parameters.get("connect.decimal.precision") or MAX_DECIMAL_DIGITS)
        if precision > MAX_DECIMAL_DIGITS or scale > precision:
            raise SchemaConflict(f"{table}.{name}: decimal({precision},{scale}) is not supported")
        target = T.DecimalType(precision, scale)
        return ColumnType(
            name,
            T.BinaryType(),
            target,
            "decimal",
            f"decimal({precision},{scale})",
            decimal_from_bytes(precision, scale),
            partial=True,
        )
    if logical in logical_types:
        lt = logical_types[str(logical)]
        return ColumnType(name, lt.wire, lt.target, lt.kind, str(logical), lt.convert, lt.partial)
    primitive = str(described.get("type"))
    if primitive not in PRIMITIVES:
        raise SchemaConflict(f"{table}.{name}: {primitive} columns are not supported")
    target = PRIMITIVES[primitive]
    return ColumnType(name, target, target, target.typeName(), target.typeName(), _same)


def replica_field(column: ColumnType, nullable: bool) -> T.StructField:
    return T.StructField(column.name, column.target, nullable, {KIND: column.kind})
