"""Table versions out of message schemas, and how a replica's schema follows them."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.columns import EVENT_COLUMNS, META_COLUMNS, META_FIELDS, cols, quoted
from tidemark.functions.wire import (
    KIND,
    KINDS,
    LOGICAL_TYPES,
    MAX_DECIMAL_DIGITS,
    ColumnType,
    LogicalType,
    SchemaConflict,
    column_type,
    replica_field,
)


@dataclass(frozen=True)
class TableVersion:
    """One version of a table: its columns in source order and its primary key."""

    table: str
    columns: tuple[ColumnType, ...]
    keys: tuple[str, ...]

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


def parse_version(
    table: str,
    value_schema: str | None,
    key_schema: str | None,
    logical_types: Mapping[str, LogicalType] = LOGICAL_TYPES,
) -> TableVersion:
    """The schema parts of a message's value and key (JSON without the closing brace) ->
    ``TableVersion``."""
    described = json.loads(value_schema + "}")["schema"] if value_schema else None
    key = json.loads(key_schema + "}")["schema"] if key_schema else None
    row = [f for f in described["fields"] if f["field"] == "after"] if described else []
    if not row:
        raise SchemaConflict(f"{table}: a message carries no schema of its rows")
    if not key:
        raise SchemaConflict(f"{table}: tables without a primary key are not supported")
    columns = tuple(column_type(table, f, logical_types) for f in row[0]["fields"])
    keys = tuple(f["field"] for f in key["fields"])
    version = TableVersion(table, columns, keys)
    _check_names(version)
    return version


def version_of(table: str, schema: T.StructType, keys: Sequence[str]) -> TableVersion:
    """The version of a table that is read with its types already, such as a snapshot."""
    columns = []
    for f in schema.fields:
        name = f.dataType.typeName()
        kind = (f.metadata or {}).get(KIND) or KINDS.get(name, name)
        rule = f.dataType.simpleString()
        columns.append(ColumnType(f.name, f.dataType, f.dataType, kind, rule, lambda v: v))
    version = TableVersion(table, tuple(columns), tuple(keys))
    _check_names(version)
    return version


def _check_names(version: TableVersion) -> None:
    taken = {n.lower() for n in (*META_COLUMNS, *EVENT_COLUMNS)}
    seen: set[str] = set()
    for name in version.names:
        if name.lower() in taken:
            raise SchemaConflict(f"{version.table}.{name}: the name is reserved")
        if name.lower() in seen:
            raise SchemaConflict(f"{version.table}.{name}: names differ only in case")
        seen.add(name.lower())
    if not version.keys or not set(version.keys) <= set(version.names):
        raise SchemaConflict(f"{version.table}: the key {version.keys} is not among its columns")


def widen(table: str, have: T.StructField, come: T.StructField) -> T.DataType:
    """Least type that holds both. Only decimals widen; any other difference is a conflict."""
    a, b = have.dataType, come.dataType
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        if digits <= MAX_DECIMAL_DIGITS:
            return T.DecimalType(digits, scale)
    elif a == b and (have.metadata or {}).get(KIND) == (come.metadata or {}).get(KIND):
        return a
    raise SchemaConflict(
        f"{table}.{have.name} is kept as {_spelled(have)} and comes as {_spelled(come)}"
    )


def _spelled(f: T.StructField) -> str:
    kind = (f.metadata or {}).get(KIND)
    return f"{f.dataType.simpleString()} ({kind})" if kind else f.dataType.simpleString()


def evolve_schema(
    current: T.StructType | None,
    versions: Iterable[TableVersion],
    keys: Sequence[str] | None = None,
) -> T.StructType:
    """Source columns of the replica once it has seen ``versions``.

    New columns are added, nullable. Decimals widen and never narrow, so replaying events of an
    older version changes nothing. Columns a version lacks stay. Everything else raises
    ``SchemaConflict``. Only the order of columns depends on the order of the versions.
    """
    fields = {f.name: f for f in current.fields} if current else {}
    for version in versions:
        keys = keys or version.keys
        if tuple(keys) != version.keys:
            raise SchemaConflict(
                f"the key of {version.table} was {', '.join(keys)} and now is {', '.join(version.keys)}"
            )
        for column in version.columns:
            come = replica_field(column, column.name not in keys)
            have = fields.get(column.name)
            if have is None:
                clash = [n for n in fields if n.lower() == column.name.lower()]
                if clash:
                    raise SchemaConflict(
                        f"{version.table}.{column.name}: differs from {clash[0]} only in case"
                    )
                fields[column.name] = come
            else:
                fields[column.name] = T.StructField(
                    have.name, widen(version.table, have, come), have.nullable, have.metadata
                )
    return T.StructType(list(fields.values()))


def with_meta(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, *META_FIELDS])


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types. A column ``df`` lacks did not
    exist in the source at that position, so it is NULL. Values that do not fit raise."""
    here = set(df.columns)
    kept = [
        (
            F.col(quoted(f.name)).cast(f.dataType)
            if f.name in here
            else F.lit(None).cast(f.dataType)
        ).alias(f.name, metadata=f.metadata)
        for f in schema.fields
    ]
    extra = [c for c in (*META_COLUMNS, *EVENT_COLUMNS) if c in here and c not in schema.names]
    return df.select(*kept, *cols(extra))
