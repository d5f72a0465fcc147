"""URL filters: rules on hosts and paths, and a Bloom filter cascade for exact membership in a list of keys."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import stored

#: (verdict, host, path): a rule fits its host and all below it where the path starts with the rule's.
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
#: False positive rate of the first level and of the others.
FIRST_RATE, RATE = 0.05, 0.5
#: Hashes of a level at most.
MOST_HASHES = 8
#: Most bits of all levels together that are sent to every executor (64 MB).
CASCADE_BITS = 1 << 29
#: Labels of a host that mark it as one of adverts and trackers.
ADVERT = r"(?:^|[.-])(?:ads?|adserver|advert|banner|click|track|tracker|tracking|promo)(?:[.-]|$)"


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null where none does. Rules are few: one expression."""
    tests = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        tests = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(tests)
    return tests


@dataclass
class Level:
    number: int
    bits: int
    hashes: int
    words: np.ndarray


def _plain(level: Level) -> tuple:
    """What is broadcast: executors need not have this package."""
    return level.number, level.bits, level.hashes, level.words


def _halves(key: Column) -> list[Column]:
    """Two hashes of 44 bits, so that sums of a few of them stay within 64 bits."""
    second = F.xxhash64(key, F.lit("second"))
    return [F.shiftrightunsigned(F.xxhash64(key), 20).alias("h1"), F.shiftrightunsigned(second, 20).alias("h2")]


def _place(i: int, bits: int) -> Column:
    return F.pmod(F.col("h1") + (F.col("h2").bitwiseOR(F.lit(1))) * i, F.lit(bits))


def _turns(level: int, hashes: int) -> range:
    """Each level takes other hashes, so keys that one can't tell apart differ in a later one."""
    return range(MOST_HASHES * level, MOST_HASHES * level + hashes)


def _size(n: int, rate: float, level: int = 0) -> tuple[int, int]:
    hashes = max(1, min(MOST_HASHES, round(-log(rate) / log(2))))
    return (ceil(n * hashes / log(2) / 64) + level) * 64, hashes


def _encode(keys: DataFrame, n: int, rate: float, level: int) -> Level:
    """A Bloom filter of keys (h1, h2). Its words are put together by a grouped OR; only non-zero ones reach the driver."""
    bits, hashes = _size(n, rate, level)
    at = keys.select(F.explode(F.array(*[_place(i, bits) for i in _turns(level, hashes)])).alias("at"))
    word = at.groupBy(F.floor(F.col("at") / 64).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("bits"))
    found = word.toPandas()
    words = np.zeros(bits // 64, np.int64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    return Level(level, bits, hashes, words.view(np.uint64))


def _holds(level: Level, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    out = np.ones(len(h1), bool)
    step = h2 | np.int64(1)
    for i in _turns(level.number, level.hashes):
        at = (h1 + step * i) % level.bits
        out &= (level.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0
    return out


def _member(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the keys are listed, and whether they pass all levels."""
    listed, open_ = np.zeros(len(h1), bool), np.ones(len(h1), bool)
    for k, level in enumerate(levels):
        holds = open_.copy()
        holds[open_] = _holds(level, h1[open_], h2[open_])
        listed[open_ & ~holds] = k % 2 == 1
        open_ = holds
    listed[open_] = len(levels) % 2 == 1
    return listed, open_


class Cascade:
    """Exact membership of any key of the universe it was built over.

    The first level encodes the listed keys, the second those of the universe that the first holds falsely, the
    third the listed ones that the second holds falsely, and so on, until nothing is held falsely. A key is looked
    up level by level: the first level that doesn't hold it decides.
    """

    def __init__(self, spark: SparkSession, levels: list[Level]):
        self.levels = levels
        self.shared = spark.sparkContext.broadcast([_plain(x) for x in levels])

    def listed(self, key: Column) -> Column:
        """Whether ``key``, one of the universe, is listed. A null key isn't."""
        return F.when(key.isNotNull(), _lookup(self.shared)(*_halves(key))).otherwise(F.lit(False))


def _lookup(shared):
    @F.pandas_udf("boolean")
    def look(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(_member([Level(*x) for x in shared.value], h1.to_numpy(np.int64), h2.to_numpy(np.int64))[0])

    return look


def _held(shared):
    @F.pandas_udf("boolean")
    def held(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(_holds(Level(*shared.value), h1.to_numpy(np.int64), h2.to_numpy(np.int64)))

    return held


def cascade(universe: DataFrame, listed: DataFrame) -> Cascade | None:
    """A cascade over the keys (column ``key``) of both tables; repeated and null keys don't matter. None if the
    bits for all levels may exceed ``CASCADE_BITS``: then a join is the way."""
    spark = universe.sparkSession
    mine = listed.where("key IS NOT NULL").select("key").distinct().withColumn("mine", F.lit(1))
    all_keys = universe.where("key IS NOT NULL").select("key", F.lit(0).alias("mine")).unionByName(mine)
    keys = stored(all_keys.groupBy("key").agg(F.max("mine").alias("mine")).select("mine", *_halves(F.col("key"))), "keys")
    n, total = keys.agg(F.coalesce(F.sum("mine"), F.lit(0)), F.count("*")).first()
    if _size(n, FIRST_RATE)[0] + 4 * (_size(n, RATE)[0] + _size(int(FIRST_RATE * total) + 1, RATE)[0]) > CASCADE_BITS:
        return None
    levels: list[Level] = []
    encode, other = keys.where("mine = 1"), keys.where("mine = 0")
    while n:
        levels.append(_encode(encode, n, RATE if levels else FIRST_RATE, len(levels)))
        shared = spark.sparkContext.broadcast(_plain(levels[-1]))
        false = stored(other.where(_held(shared)("h1", "h2")), "held-falsely")
        encode, other, n = false, encode, false.count()
    return Cascade(spark, levels)


def advert_hosts(pages: DataFrame) -> DataFrame:
    """The list that the query uses: hosts of pages with a label of adverts or trackers (column key)."""
    hosts = pages.select(host(F.col("url")).alias("key")).distinct()
    return hosts.where(F.col("key").rlike(ADVERT))


def judge(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """A row per page: page_id, host, path, rule, verdict. The longest rule that fits decides; without one, a page is
    blocked if its host is listed (column key), and allowed else.

    Null urls and such without :// have an empty host and path, fit no rule and aren't listed unless '' is. Equal rows each
    get a row, further columns don't matter, an empty table gives none and an empty list blocks nothing.
    """
    hosts = pages.select(host(F.col("url")).alias("key")).distinct()
    rows = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rows = rows.withColumn("_rule", longest_rule(F.col("host"), F.col("path"), rules))
    built = cascade(hosts, listed)
    if built:
        rows = rows.withColumn("_listed", built.listed(F.col("host")))
    else:
        keys = listed.where("key IS NOT NULL").select(F.col("key").alias("host"), F.lit(True).alias("_found")).distinct()
        rows = rows.join(keys, "host", "left").withColumn("_listed", F.coalesce("_found", F.lit(False)))
    other = F.when(F.col("_listed"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), other).alias("verdict"),
    )


ORACLE = """
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r AS (SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
             ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) t(v, h, b)),
m AS (SELECT page_id, host, path, arg_max(h || b, length(h || b)) AS rule, arg_max(v, length(h || b)) AS v
      FROM p LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, b) GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN regexp_matches(host,
  '(?:^|[.-])(?:ads?|adserver|advert|banner|click|track|tracker|tracking|promo)(?:[.-]|$)') THEN 'block' ELSE 'allow' END)
  AS verdict FROM m
"""
