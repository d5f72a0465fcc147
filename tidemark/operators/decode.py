"""Change messages -> typed events, with built-in expressions only."""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from tidemark.functions.wire import LOGICAL_TYPES, ColumnType, LogicalType, SchemaConflict, strictly
from tidemark.operators.schema import TableVersion, evolve_schema, parse_version

# Fixed values of the message format.
PAYLOAD_MARK = ',"payload":'
OPS = ("c", "u", "d", "r")

# Default of ``max_versions``.
MAX_VERSIONS = 10_000
# Messages looked up by one condition.
LOOKUPS = 100

# Where the JSON reader leaves what it can't read.
_BROKEN = "_broken_record"
BROKEN_JSON = "broken JSON or a value of another type"

# Table, and the schema parts of value and key.
SchemaText = tuple[str, str | None, str | None]


@dataclass(frozen=True)
class DecodedTable:
    """Typed events of one table: source columns, ``_op``, position, commit time, ``_deleted``,
    ``_version``, ``_partition``, ``_offset``."""

    table: str
    events: DataFrame
    keys: tuple[str, ...]
    versions: Mapping[int, TableVersion]


def table_of(topic: Column) -> Column:
    return F.substring_index(topic, ".", -1)


def drop_tombstones(raw: DataFrame) -> DataFrame:
    """A null value follows a delete so that the log can forget the key; it carries no change."""
    return raw.where(F.col("value").isNotNull())


def validate_ops(
    raw: DataFrame, on_bad: str = "fail"
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Checks the kind of change. ``fail`` stops the job at the first unknown one; ``quarantine``
    returns (good messages, bad messages with their ``op``)."""
    op = F.get_json_object(F.col("value").cast("string"), "$.payload.op")
    known = F.coalesce(op.isin(*OPS), F.lit(False)) | F.col("value").isNull()
    if on_bad == "quarantine":
        return raw.where(known), raw.withColumn("op", op).where(~known)
    if on_bad != "fail":
        raise ValueError(f"on_bad must be 'fail' or 'quarantine', not {on_bad!r}")
    checked = F.when(known, F.col("value")).otherwise(_stop(_unsupported(op), "string"))
    return raw.withColumn("value", checked)


def split_messages(raw: DataFrame) -> DataFrame:
    """Cuts each message at its payload: the schema part (the same text in every message of a table
    version) becomes ``_value_schema``, the rest ``_message``. ``_version`` is a hash of the schema
    texts and the topic."""
    cut = raw.where(F.col("value").isNotNull()).select(
        "topic",
        "partition",
        "offset",
        F.col("value").cast("string").alias("_value"),
        F.col("key").cast("string").alias("_key"),
        # Once per message: the texts are long, and mostly schema.
        F.split(F.col("value").cast("string"), PAYLOAD_MARK, 2).alias("_value_cut"),
        F.split(F.col("key").cast("string"), PAYLOAD_MARK, 2).alias("_key_cut"),
    )
    payload = F.get(F.col("_value_cut"), F.lit(1))
    key_payload = F.coalesce(F.get(F.col("_key_cut"), F.lit(1)), F.col("_key"))
    parts = cut.select(
        "topic",
        "partition",
        "offset",
        F.coalesce(F.octet_length(key_payload), F.lit(0)).alias("_key_bytes"),
        table_of(F.col("topic")).alias("_table"),
        _schema_part("_value").alias("_value_schema"),
        _schema_part("_key").alias("_key_schema"),
        F.when(payload.isNotNull(), F.concat(F.lit('{"payload":'), payload))
        .otherwise(F.col("_value"))
        .alias("_message"),
    )
    return parts.withColumn("_version", F.xxhash64("topic", "_value_schema", "_key_schema"))


def _schema_part(text: str) -> Column:
    """JSON text up to the end of the schema, the closing brace left out. Messages written with
    blanks, or in another order, are parsed for it."""
    parts = F.col(f"{text}_cut")
    parsed = F.concat(F.lit('{"schema":'), F.get_json_object(text, "$.schema"))
    return F.when(F.size(parts) == 2, F.get(parts, F.lit(0))).otherwise(parsed)


def schema_texts(parts: DataFrame, max_versions: int = MAX_VERSIONS) -> dict[int, SchemaText]:
    """Distinct schema texts in a batch, by version: the only part of it that reaches the driver, one
    row per version. More than ``max_versions`` are an error."""
    texts = (
        parts.select("_version", "_table", "_value_schema", "_key_schema")
        .distinct()
        .limit(max_versions + 1)
        .collect()
    )
    if len(texts) > max_versions:
        raise _too_many(max_versions, [t[1] for t in texts])
    if len({t[0] for t in texts}) != len(texts):
        raise SchemaConflict("two schema versions share a hash")
    return {t[0]: (t[1], t[2], t[3]) for t in texts}


def _too_many(max_versions: int, names: Iterable[str]) -> SchemaConflict:
    most = ", ".join(f"{name} ({n})" for name, n in Counter(names).most_common(3))
    return SchemaConflict(f"more than {max_versions} schema versions in one batch, most of {most}")


def parse_versions(
    texts: Mapping[int, SchemaText], logical_types: Mapping[str, LogicalType] = LOGICAL_TYPES
) -> dict[int, TableVersion]:
    return {i: parse_version(*text, logical_types) for i, text in texts.items()}


def usable_versions(
    texts: Mapping[int, SchemaText], logical_types: Mapping[str, LogicalType] = LOGICAL_TYPES
) -> tuple[dict[int, TableVersion], dict[int, str]]:
    """The same, and apart from them what is wrong with those that can't be read."""
    versions, unusable = {}, {}
    for i, text in texts.items():
        try:
            versions[i] = parse_version(*text, logical_types)
        except (SchemaConflict, ValueError, LookupError, TypeError, AttributeError) as e:
            unusable[i] = f"unusable schema: {e}"
    return versions, unusable


def schema_versions(
    parts: DataFrame, logical_types: Mapping[str, LogicalType] = LOGICAL_TYPES
) -> dict[int, TableVersion]:
    """Distinct table versions in a batch."""
    return parse_versions(schema_texts(parts), logical_types)


def versions_of_batch(
    raw: DataFrame,
    parts: DataFrame,
    known: Mapping[int, SchemaText],
    max_versions: int = MAX_VERSIONS,
) -> dict[int, SchemaText]:
    """The same, given versions that are known already. Their messages need not be looked at again;
    of the others, one message each is."""
    # By partition first: a minimum of numbers is hashed, one of structs would sort all messages.
    by_partition = parts.groupBy("_version", "topic", "partition").agg(
        F.min("offset").alias("offset")
    )
    first = F.min(F.struct("topic", "partition", "offset")).alias("first")
    seen = by_partition.groupBy("_version").agg(first).limit(max_versions + 1).collect()
    return texts_of(raw, {r[0]: r["first"] for r in seen}, known, max_versions)


def texts_of(
    raw: DataFrame, firsts: Mapping[int, Row], known: Mapping[int, SchemaText], max_versions: int = MAX_VERSIONS
) -> dict[int, SchemaText]:
    """Schema texts by version, given where one message of each is (topic, partition, offset)."""
    if len(firsts) > max_versions:
        raise _too_many(max_versions, [m["topic"] for m in firsts.values()])
    texts = {i: known[i] for i in firsts if i in known}
    new = [m for i, m in firsts.items() if i not in known]
    for start in range(0, len(new), LOOKUPS):
        first = F.lit(False)
        for m in new[start : start + LOOKUPS]:
            same = [F.col(c).eqNullSafe(F.lit(m[c])) for c in ("topic", "partition", "offset")]
            first = first | (same[0] & same[1] & same[2])
        texts.update(schema_texts(split_messages(raw.where(first))))
    return texts


def with_places(parts: DataFrame) -> DataFrame:
    """Cut messages with what is the same in all tables: ``_op`` (null if it is none of ``OPS``), ``_src_file``,
    ``_src_pos`` and ``_src_commit_at``. Row images aren't parsed."""
    read = F.from_json("_message", _envelope(None, True))
    file_number, commit_micros = _source(F.col("_p.source"))
    places = parts.withColumn("_p", read["payload"]).withColumns(
        {
            "_op": F.when(F.col("_p.op").isin(*OPS), F.col("_p.op")),
            "_src_file": file_number,
            "_src_pos": F.col("_p.source.pos"),
            "_src_commit_at": F.timestamp_micros(commit_micros),
        }
    )
    return places.drop("_p")


def batch_summary(places: DataFrame, max_versions: int = MAX_VERSIONS) -> list[Row]:
    """Of all tables at once, a row per version and kind of change: ``_version``, ``_op``, ``n``, ``oldest`` (log file, offset),
    ``key_bytes``, ``first`` (topic, partition, offset of a message). Not more rows than for ``max_versions`` + 1."""
    # Minima of numbers are hashed, those of structs would sort all messages.
    by_partition = places.groupBy("_version", "topic", "partition", "_op", "_src_file").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("_src_pos").alias("_src_pos"),
        F.min("offset").alias("offset"),
        F.sum("_key_bytes").alias("key_bytes"),
    )
    by_op = by_partition.groupBy("_version", "_op").agg(
        F.sum("n").alias("n"),
        F.min(F.struct("_src_file", "_src_pos")).alias("oldest"),
        F.sum("key_bytes").alias("key_bytes"),
        F.min(F.struct("topic", "partition", "offset")).alias("first"),
    )
    return by_op.limit((len(OPS) + 1) * (max_versions + 1)).collect()


def versions_by_table(versions: Mapping[int, TableVersion]) -> dict[str, dict[int, TableVersion]]:
    tables: dict[str, dict[int, TableVersion]] = {}
    for version_id, version in sorted(versions.items(), key=lambda v: (v[1].table, v[0])):
        tables.setdefault(version.table, {})[version_id] = version
    return tables


def decode_rows(
    parts: DataFrame, versions: Mapping[int, TableVersion], on_bad: str = "fail"
) -> dict[str, DecodedTable]:
    """Typed events per table, tables in name order. Versions of a table must be reconcilable."""
    return {
        table: decode_table(parts, table, of_table, on_bad=on_bad)
        for table, of_table in versions_by_table(versions).items()
    }


def decode_table(
    parts: DataFrame,
    table: str,
    versions: Mapping[int, TableVersion],
    *,
    keys_only: bool = False,
    only_these: bool = False,
    on_bad: str = "fail",
    alike: Collection[str] = (),
) -> DecodedTable:
    """Typed events of one table. Each message is parsed once, whatever the number of versions. With it come those of tables
    that are ``alike``, whose ``versions`` have the same columns; ``_version`` tells them apart.

    ``only_these`` leaves out messages of other versions; else they are an error, like the rest:
    decoding is strict. Broken JSON, a value of the wrong type, an unknown kind of change or a
    missing image, key or position stops the job, unless ``on_bad='flag'``, which keeps such rows with
    their ``_topic`` and says why in ``_bad``.
    """
    if on_bad not in ("fail", "flag"):
        raise ValueError(f"on_bad must be 'fail' or 'flag', not {on_bad!r}")
    strict = on_bad == "fail"
    keys = next(iter(versions.values())).keys
    if any(v.keys != keys for v in versions.values()):
        raise SchemaConflict(f"{table}: the primary key differs between versions")
    wanted = {
        i: [c for c in v.columns if not keys_only or c.name in keys] for i, v in versions.items()
    }
    schema = evolve_schema(
        None, [TableVersion(table, tuple(wanted[i]), keys) for i in wanted], keys
    )
    by_name: dict[str, dict[int, ColumnType]] = {f.name: {} for f in schema.fields}
    for version_id, columns in wanted.items():
        for column in columns:
            by_name[column.name][version_id] = column

    image_type = T.StructType([_wire_field(table, n, of.values()) for n, of in by_name.items()])
    known = F.col("_version").isin(*versions)
    of_table = parts.where(F.col("_table").isin(table, *alike))
    if only_these:
        of_table = of_table.where(known)
    mode = {"mode": "FAILFAST" if strict else "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    read = F.from_json("_message", _envelope(image_type, strict), mode)
    parsed = of_table.select(
        "topic",
        F.col("partition").alias("_partition"),
        F.col("offset").alias("_offset"),
        "_version",
        read.alias("_read"),
    ).select(
        *("topic", "_partition", "_offset", "_version"),
        F.col("_read.payload").alias("_p"),
        *([] if strict else [F.col(f"_read.{_BROKEN}").isNotNull().alias("_broken")]),
    )
    op = F.col("_p.op")
    # The row before the change is all a delete has; otherwise the row after it counts.
    imaged = parsed.withColumn(
        "_image", F.when(op == "d", F.col("_p.before")).otherwise(F.col("_p.after"))
    )
    source = F.col("_p.source")
    file_number, commit_micros = _source(source)
    bad = (
        F.when(F.lit(False) if strict else F.col("_broken"), F.lit(BROKEN_JSON))
        .when(~F.coalesce(op.isin(*OPS), F.lit(False)), _unsupported(op))
        .when(~known, F.lit("unknown schema version"))
        .when(F.col("_image").isNull(), F.lit("no row image"))
        .when(_any_null([F.col("_image").getField(k) for k in keys]), F.lit("no key"))
        .when(_any_null([file_number, source.getField("pos")]), F.lit("no position"))
        .when(commit_micros.isNull(), F.lit("no commit time"))
    )
    if strict:
        # Every value comes out of one of the two, so a consumer can't read one without the check.
        where = F.concat_ws(":", "topic", "_partition", "_offset")
        why = F.concat(bad, F.lit(" at "), where)
        imaged = imaged.withColumns(
            {
                c: F.when(bad.isNull(), F.col(c)).otherwise(_stop(why, imaged.schema[c].dataType))
                for c in ("_image", "_p")
            }
        )
    converted = {f.name: _converted(f, by_name[f.name], len(versions), strict) for f in schema.fields}
    for f in schema.fields:
        if not strict and any(c.partial for c in by_name[f.name].values()):
            lost = F.col("_image").getField(f.name).isNotNull() & converted[f.name].isNull()
            bad = bad.when(lost, F.lit(f"{f.name} does not fit {f.dataType.simpleString()}"))
    events = imaged.select(
        *(converted[f.name].alias(f.name, metadata=f.metadata) for f in schema.fields),
        op.alias("_op"),
        file_number.alias("_src_file"),
        source.getField("pos").alias("_src_pos"),
        F.coalesce(source.getField("row"), F.lit(0)).alias("_src_row"),
        F.timestamp_micros(commit_micros).alias("_src_commit_at"),
        (op == "d").alias("_deleted"),
        "_version",
        "_partition",
        "_offset",
        *([] if strict else [F.col("topic").alias("_topic"), bad.alias("_bad")]),
    )
    return DecodedTable(table, events, keys, dict(versions))


def _source(source: Column) -> tuple[Column, Column]:
    """Number of the log file, and microseconds of the commit, of a message's ``source``."""
    name = source.getField("file")
    number = F.when(F.instr(name, ".") > 0, F.substring_index(name, ".", -1)).try_cast("int")
    micros = F.coalesce(F.nullif(source.getField("ts_us"), F.lit(0)), source.getField("ts_ms") * 1000)
    return number, micros


def _envelope(image: T.StructType | None, strict: bool) -> T.StructType:
    source = T.StructType(
        [
            T.StructField("file", T.StringType()),
            T.StructField("pos", T.LongType()),
            T.StructField("row", T.IntegerType()),
            T.StructField("ts_us", T.LongType()),
            T.StructField("ts_ms", T.LongType()),
        ]
    )
    payload = T.StructType(
        [
            *(T.StructField(side, image) for side in ("before", "after") if image),
            T.StructField("op", T.StringType()),
            T.StructField("source", source),
        ]
    )
    broken = [] if strict else [T.StructField(_BROKEN, T.StringType())]
    return T.StructType([T.StructField("payload", payload), *broken])


def _wire_field(table: str, name: str, of: Iterable[ColumnType]) -> T.StructField:
    wires = {c.wire for c in of}
    if len(wires) > 1:
        raise SchemaConflict(f"{table}.{name}: versions of one batch encode it differently")
    return T.StructField(name, wires.pop())


def _converted(
    target: T.StructField, of: Mapping[int, ColumnType], n_versions: int, strict: bool
) -> Column:
    """One conversion where all versions agree, else one per version."""
    value = F.col("_image").getField(target.name)

    def convert(column: ColumnType) -> Column:
        converted = column.convert(value)
        if strict and column.partial:
            converted = strictly(value, converted, column.target)
        return converted.cast(target.dataType)

    by_rule: dict[str, list[int]] = {}
    for version_id, column in of.items():
        by_rule.setdefault(column.rule, []).append(version_id)
    if len(by_rule) == 1 and len(of) == n_versions:
        return convert(next(iter(of.values())))
    result = None
    for ids in by_rule.values():
        when = F.col("_version").isin(*ids)
        converted = convert(of[ids[0]])
        result = F.when(when, converted) if result is None else result.when(when, converted)
    assert result is not None
    return result


def _any_null(values: Sequence[Column]) -> Column:
    result = F.lit(False)
    for v in values:
        result = result | v.isNull()
    return result


def _unsupported(op: Column) -> Column:
    return F.concat(F.lit("unsupported op "), F.coalesce(op, F.lit("null")))


def _stop(message: Column, data_type: T.DataType | str) -> Column:
    return F.raise_error(message).cast(data_type)

