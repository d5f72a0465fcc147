"""Sharding by a hierarchical weighted hash tree."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.tables import stored

#: Regions of the tree, and racks of a region. Shard s stands in region s mod REGIONS, rack s div REGIONS mod RACKS.
REGIONS, RACKS = 4, 5
#: Rows numbered by one task at most, about.
SLOT_ROWS = 20_000


def tree(weights: Sequence[float], regions: int = REGIONS, racks: int = RACKS) -> list[list[list[tuple[int, float]]]]:
    """Shards (number, weight) by region and rack. A shard keeps its place when more follow."""
    out: list[list[list[tuple[int, float]]]] = [[[] for _ in range(racks)] for _ in range(regions)]
    for s, w in enumerate(weights):
        out[s % regions][s // regions % racks].append((s, w))
    return out


def place(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key (bigint column).

    A shard's draw is an exponential waiting time at the rate of its weight, from a hash of key and shard. A rack's
    draw is the least of its shards', a region's the least of its racks': waiting times at the rates of their summed
    weights, so each level is a weighted hash draw, and the descent takes the least at each. A draw of a
    subtree only changes with the weights inside it. So a weight that grows draws keys into that shard alone, and one
    that shrinks sends only its own keys away; a shard of weight 0 gets none.
    """

    def draw(s: int, w: float) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(s)), 11).cast("double") + 0.5) / float(1 << 53)
        return -F.log(u) / w

    def least(nodes: list[Column]) -> Column:
        return F.array_min(F.array(*nodes))

    regions = []
    for region in tree(weights):
        racks = [[(s, w) for s, w in rack if w > 0] for rack in region]
        drawn = [
            least([F.struct(draw(s, w).alias("wait"), F.lit(s).alias("shard")) for s, w in rack])
            for rack in racks if rack
        ]
        if drawn:
            regions.append(least(drawn))
    return least(regions)["shard"]


def shards(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None) -> DataFrame:
    """docs (doc_id, text) to: doc_id, size, text_crc32, shard, slot, grown_shard (the shard under the weights ``grown``).

    The doc_id and the weights decide; rows without a doc_id go by their text's checksum. A null text counts as empty,
    equal rows share a shard, further columns don't matter, an empty table gives none.

    Slots number a shard's rows without gaps. Rows are first stored with a number of their own; that number
    deals each shard into blocks of bounded size, blocks are counted, and a row's slot is its place in its block after
    all earlier blocks. No task orders a whole shard, and equal rows don't meet in one block.
    """
    text = F.coalesce("text", F.lit(""))
    crc = F.crc32(text.cast("binary"))
    by_text = F.xxhash64("text_crc32", F.lit("text"))
    key = F.when(F.col("doc_id").isNull(), by_text).otherwise(F.xxhash64("doc_id"))
    rows = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), crc.alias("text_crc32"))
    rows = rows.withColumn("_key", key)
    rows = rows.select(
        "doc_id", "size", "text_crc32", place(F.col("_key"), weights).alias("shard"),
        (place(F.col("_key"), grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = stored(rows, "placed")
    blocks = max(8, ceil(rows.count() / max(len(weights), 1) / SLOT_ROWS))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)).cast("int"))
    counts = rows.groupBy("shard", "_block").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("_block")
    counts = counts.select("shard", "_block", (F.sum("n").over(ahead) - F.col("n")).alias("_before"))
    within = Window.partitionBy("shard", "_block").orderBy("_row")
    return (
        rows.join(F.broadcast(counts) if blocks * len(weights) <= 500_000 else counts, ["shard", "_block"])
        .withColumn("slot", F.col("_before") + F.row_number().over(within) - 1)
        .select("doc_id", "size", "text_crc32", "shard", "slot", "grown_shard")
    )
