"""Tables the operators keep on the way, and the size check before a broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.workspace import fresh_dir

#: Most rows of a side that is broadcast, and most bytes of them.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and there for every executor that is lost later."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits(df: DataFrame) -> bool:
    """Whether ``df`` is small enough to be broadcast: at most ``BROADCAST_ROWS`` rows and ``BROADCAST_BYTES``, as text. Reads
    ``df``, so it should be a stored table."""
    if df.count() > BROADCAST_ROWS:
        return False
    size = F.octet_length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))))
    return df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] <= BROADCAST_BYTES


def bounded(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it fits; else as it is, for a shuffled join."""
    return F.broadcast(df) if fits(df) else df
