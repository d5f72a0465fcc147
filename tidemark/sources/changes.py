"""Where change messages and source tables come from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.columns import cols

# The Kafka source's own columns. A null value is a tombstone.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)


def topic_pattern(prefix: str, database: str) -> str:
    """Pattern of the topics of all tables of a database; a topic's last part is the table."""
    return rf"^{prefix}\.{database}\..*"


def read_changes(
    spark: SparkSession,
    source: str | Mapping[str, str],
    *,
    streaming: bool = False,
    max_per_trigger: int | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """Change messages as a table or a stream.

    ``source`` is a directory of message files, or the options of the Kafka source (for example
    ``kafka.bootstrap.servers`` and ``subscribePattern``). A directory or topic set that does not
    exist yet is an empty input, not an error (a stream creates the directory). ``max_per_trigger`` bounds a micro-batch: messages for Kafka,
    files for a directory.
    """
    if not isinstance(source, str):
        options = {"startingOffsets": "earliest", **source}
        if streaming:
            if max_per_trigger:
                options["maxOffsetsPerTrigger"] = str(max_per_trigger)
            df = spark.readStream.format("kafka").options(**options).load()
        else:
            df = spark.read.format("kafka").options(**options).load()
        return df.select(
            "topic",
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "partition",
            "offset",
        )
    if streaming:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
        stream = spark.readStream.schema(RAW_SCHEMA).format(file_format)
        if max_per_trigger:
            stream = stream.option("maxFilesPerTrigger", max_per_trigger)
        return stream.load(source)
    try:
        return spark.read.schema(RAW_SCHEMA).format(file_format).load(source)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RAW_SCHEMA)


def read_table(spark: SparkSession, source: str | Mapping[str, str]) -> DataFrame:
    """A source table: a Parquet path, or reader options with ``format`` (for example ``jdbc``)."""
    if isinstance(source, str):
        return spark.read.parquet(source)
    options = dict(source)
    return spark.read.format(options.pop("format")).options(**options).load()


def snapshot_events(
    df: DataFrame,
    keys: Sequence[str],
    position: tuple[int, int, int],
    commit_at: datetime | None = None,
) -> DataFrame:
    """The rows a table had before the change log starts, as events of kind ``r``. All of them get
    the one position at which the snapshot was taken."""
    file_number, offset, row = position
    at = F.lit(commit_at).cast("timestamp") if commit_at else F.timestamp_micros(F.lit(0))
    return df.select(
        *cols(df.columns),
        F.lit("r").alias("_op"),
        F.lit(file_number).cast("int").alias("_src_file"),
        F.lit(offset).cast("bigint").alias("_src_pos"),
        F.lit(row).cast("int").alias("_src_row"),
        at.alias("_src_commit_at"),
        F.lit(False).alias("_deleted"),
    )
