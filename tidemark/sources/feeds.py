"""Change messages made from tables, for tests and measurements."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.columns import EVENT_COLUMNS, META_COLUMNS, cols, quoted
from tidemark.functions.wire import DECIMAL, epoch_to_ntz

# Spark type -> (primitive wire type, logical type).
_WIRE = {
    "tinyint": ("int8", None),
    "smallint": ("int16", None),
    "int": ("int32", None),
    "bigint": ("int64", None),
    "float": ("float32", None),
    "double": ("float64", None),
    "boolean": ("boolean", None),
    "string": ("string", None),
    "binary": ("bytes", None),
    "date": ("int32", "io.debezium.time.Date"),
    "timestamp_ntz": ("int64", "io.debezium.time.MicroTimestamp"),
    "timestamp": ("string", "io.debezium.time.ZonedTimestamp"),
}


def column_schema(f: T.StructField, logical_type: str | None = None) -> dict[str, object]:
    """How a message describes a column, of the given logical type or the one its Spark type has."""
    if logical_type:
        described: dict[str, object] = {"type": _WIRE[f.dataType.simpleString()][0], "name": logical_type}
    elif isinstance(f.dataType, T.DecimalType):
        parameters = {
            "scale": str(f.dataType.scale),
            "connect.decimal.precision": str(f.dataType.precision),
        }
        described = {"type": "bytes", "name": DECIMAL, "parameters": parameters}
    else:
        primitive, logical = _WIRE[f.dataType.simpleString()]
        described = {"type": primitive, **({"name": logical} if logical else {})}
    return {**described, "optional": f.nullable, "field": f.name}


def wire_value(column: Column, data_type: T.DataType) -> Column:
    """How a message writes a value."""
    if isinstance(data_type, T.DecimalType):
        if data_type.precision > 18:
            return F.base64(F.unhex(_wide_hex(column, data_type.scale)))
        unscaled = (column * F.lit(10**data_type.scale)).cast("decimal(20,0)").cast("string")
        return F.base64(F.unhex(F.lpad(F.conv(unscaled, 10, 16), 16, "0")))
    if isinstance(data_type, T.BinaryType):
        return F.base64(column)
    if isinstance(data_type, T.DateType):
        return F.unix_date(column)
    if isinstance(data_type, T.TimestampNTZType):
        epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
        return F.timestamp_diff("MICROSECOND", epoch, column)
    if isinstance(data_type, T.TimestampType):
        return F.date_format(epoch_to_ntz(F.unix_micros(column)), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return column


def _wide_hex(column: Column, scale: int) -> Column:
    """A decimal's digits as a signed number of sixteen bytes: its two halves, the high one rounded
    down so that the low one is never negative."""
    plain = F.translate(F.format_number(column, scale), ",.", "").cast("decimal(38,0)")
    two_64 = F.lit("18446744073709551616").cast("decimal(20,0)")
    low = F.pmod(plain, two_64).cast("decimal(20,0)")
    high = F.call_function("div", plain, two_64) - F.when((plain < 0) & (low != 0), 1).otherwise(0)
    halves = (F.hex(high.cast("bigint")), F.conv(low.cast("string"), 10, 16))
    return F.concat(*(F.lpad(half, 16, "0") for half in halves))


def encode(
    events: DataFrame,
    table: str,
    keys: Sequence[str],
    prefix: str = "feed.db",
    logical: Mapping[str, str] | None = None,
) -> DataFrame:
    """Events (source columns, ``_op``, position, ``_src_commit_at``) -> messages as the Kafka source
    gives them. Partition and offset are derived from key and position. Columns in ``logical`` hold
    what a message writes for a value of that logical type."""
    logical = logical or {}
    extra = {*META_COLUMNS, *EVENT_COLUMNS}
    fields = [f for f in events.schema.fields if f.name not in extra]
    key_fields = [f for f in fields if f.name in keys]
    described = [column_schema(f, logical.get(f.name)) for f in fields]
    row = {"type": "struct", "fields": described, "optional": True}
    schema = {
        "type": "struct",
        "fields": [
            {**row, "field": "before"},
            {**row, "field": "after"},
            {"type": "struct", "fields": [], "optional": False, "field": "source"},
            {"type": "string", "optional": False, "field": "op"},
        ],
        "optional": False,
    }
    key_schema = {
        "type": "struct",
        "fields": [{**column_schema(f, logical.get(f.name)), "optional": False} for f in key_fields],
        "optional": False,
    }

    def values(of: list[T.StructField]) -> Column:
        return F.struct(*(wire_value(F.col(quoted(f.name)), f.dataType).alias(f.name) for f in of))

    # A column of its own, so that the values, which cost the most, are written once for both sides and the key.
    events = events.withColumn("_wire", values(fields))
    image = F.col("_wire")
    nothing = F.lit(None)
    deleted = F.col("_op") == "d"
    payload = F.struct(
        F.when(deleted, image).otherwise(nothing).alias("before"),
        F.when(~deleted, image).otherwise(nothing).alias("after"),
        F.struct(
            F.format_string("mysql-bin.%06d", "_src_file").alias("file"),
            F.col("_src_pos").alias("pos"),
            F.col("_src_row").alias("row"),
            F.unix_micros("_src_commit_at").alias("ts_us"),
        ).alias("source"),
        F.col("_op").alias("op"),
    )
    return events.select(
        F.lit(f"{prefix}.{table}").alias("topic"),
        _message(key_schema, F.struct(*(image[f.name].alias(f.name) for f in key_fields))).alias("key"),
        _message(schema, payload).alias("value"),
        F.pmod(F.hash(*cols(keys)), F.lit(3)).alias("partition"),
        (F.col("_src_file").cast("bigint") * 10**12 + F.col("_src_pos")).alias("offset"),
    )


def _message(schema: dict[str, object], payload: Column) -> Column:
    head = '{"schema":' + json.dumps(schema, separators=(",", ":")) + ',"payload":'
    # A struct's text is never null. Said so, a condition that messages aren't null needs no text of its own.
    body = F.coalesce(F.to_json(payload, {"ignoreNullFields": "false"}), F.lit("null"))
    return F.concat(F.lit(head), body, F.lit("}"))
