"""Names of the columns this package adds to rows, and small column helpers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F, types as T

# Position of the event that produced a row: log file number, offset in it, row within the event.
POSITION = ("_src_file", "_src_pos", "_src_row")

# Columns every replica table carries after the source's own.
META_FIELDS = [
    T.StructField("_src_file", T.IntegerType(), False),
    T.StructField("_src_pos", T.LongType(), False),
    T.StructField("_src_row", T.IntegerType(), False),
    T.StructField("_src_commit_at", T.TimestampType(), False),
    T.StructField("_deleted", T.BooleanType(), False),
    T.StructField("_applied_at", T.TimestampType(), False),
]
META_COLUMNS = tuple(f.name for f in META_FIELDS)

# Columns decoded events carry on top; they never reach a replica.
EVENT_COLUMNS = ("_op", "_version", "_partition", "_offset")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def position(of: str | None = None) -> Column:
    """The position as one struct; structs compare field by field."""
    prefix = f"{of}." if of else ""
    return F.struct(*(F.col(prefix + c) for c in POSITION))


def cols(names: Iterable[str], of: str | None = None) -> list[Column]:
    prefix = f"{of}." if of else ""
    return [F.col(prefix + quoted(n)) for n in names]


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & (F.col(f"{left}.{quoted(k)}") == F.col(f"{right}.{quoted(k)}"))
    return condition
