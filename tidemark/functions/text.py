"""One text form per value, so that two systems' rows can be compared byte by byte."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.columns import quoted
from tidemark.functions.wire import KIND, canonical_json, epoch_to_ntz

# Fixed values of the normalised form.
NULL_TEXT = "\\N"
SEPARATOR = "\x1f"

_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def text_of(column: Column, data_type: T.DataType, kind: str | None = None) -> Column:
    """Exact decimals, times and timestamps to the microsecond without zone, booleans as 0/1, bytes as
    lower-case hex, JSON in canonical form, NULL as a marker."""
    if isinstance(data_type, T.VariantType):
        text = F.to_json(column)
    elif kind == "json":
        text = canonical_json(column)
    elif isinstance(data_type, T.TimeType):
        # Its text leaves zeros at the end out.
        short = column.cast("string")
        text = F.rpad(F.when(F.instr(short, ".") > 0, short).otherwise(F.concat(short, F.lit("."))), 15, "0")
    elif isinstance(data_type, T.StringType):
        text = column
    elif isinstance(data_type, T.TimestampNTZType):
        text = F.date_format(column, _MICROS)
    elif isinstance(data_type, T.TimestampType):
        text = F.date_format(epoch_to_ntz(F.unix_micros(column)), _MICROS)
    elif isinstance(data_type, T.BooleanType):
        text = column.cast("int").cast("string")
    elif isinstance(data_type, T.BinaryType):
        text = F.lower(F.hex(column))
    elif isinstance(data_type, (T.NumericType, T.DateType)):
        text = column.cast("string")
    else:
        raise TypeError(f"no text form for {data_type.simpleString()}")
    return F.coalesce(text, F.lit(NULL_TEXT))


def field_text(field: T.StructField, column: Column | None = None) -> Column:
    kind = (field.metadata or {}).get(KIND)
    return text_of(F.col(quoted(field.name)) if column is None else column, field.dataType, kind)


def normalise(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The same columns, each in its text form."""
    names = columns or df.columns
    return df.select(*(field_text(df.schema[c]).alias(c) for c in names))


def row_text(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """The whole row as one line."""
    names = columns or df.columns
    return F.concat_ws(SEPARATOR, *(field_text(df.schema[c]) for c in names))
