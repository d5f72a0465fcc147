"""A trie of conversations' turns by vertical bitmaps."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import stored

#: Conversations that share their first turns with the first of them, and turns that are shared at most.
GROUP, SHARED = 20, 3
#: Conversations and turns of a shard at most.
CONVERSATIONS, TURNS = 1_024, 200_000
#: A node with more than this share of all nodes as children is heavy, so there are fewer than 1,000.
HEAVY = 0.001

_NODE = "k1 long, k2 long, p1 long, p2 long, depth int, words long, n long, least long, first_end long, ends binary"


def _narrow(conversations: DataFrame) -> DataFrame:
    """conv, base (the conversation whose first turns it takes over), turn, digest (of role and text), words."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    conv = F.col("conv_id").cast("long")
    return conversations.where(F.col("conv_id").isNotNull()).select(
        conv.alias("conv"), (conv - conv % GROUP).alias("base"), "turn",
        F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """A row per prefix of every rebuilt conversation: conv, depth (from 0), h1, h2 (a hash of the depth and its turn), k1, k2
    (of the whole prefix: all its turns' hashes, by exclusive or), words, last (no turn follows).

    All rows of a group of conversations lie together, ordered by conversation and depth; no text is shuffled."""
    turns = stored(_narrow(conversations), "turns").repartitionByRange("base")
    of_conv, of_base = Window.partitionBy("base", "conv"), Window.partitionBy("base")
    turns = turns.withColumn("at", F.row_number().over(of_conv.orderBy(F.col("turn").asc_nulls_first(), "digest")))
    turns = turns.withColumn("own", F.count("*").over(of_conv))
    content = F.struct("digest", "words")
    firsts = [
        F.max(F.when((F.col("conv") == F.col("base")) & (F.col("at") == i), content)).over(of_base)
        for i in range(1, SHARED + 1)
    ]
    turns = turns.withColumn("firsts", F.filter(F.array(*firsts), lambda t: t.isNotNull()))
    share = (F.crc32(F.col("conv").cast("string").cast("binary")) % (SHARED + 1)).cast("int")
    turns = turns.withColumn("share", share).withColumn("taken", F.least("share", F.size("firsts")))

    def row(depth: Column, digest: Column, words: Column) -> Column:
        return F.struct(depth.cast("int").alias("depth"), digest.alias("digest"), words.alias("words"))

    none = F.array().cast("array<struct<depth:int,digest:binary,words:bigint>>")
    root = row(F.lit(0), F.lit(None).cast("binary"), F.lit(0).cast("long"))
    over = F.transform(F.slice("firsts", F.lit(1), F.col("taken")), lambda t, i: row(i + 1, t["digest"], t["words"]))
    own = row(F.col("taken") + F.col("at") - F.col("share"), F.col("digest"), F.col("words"))
    here = F.concat(
        F.when(F.col("at") == 1, F.concat(F.array(root), over)).otherwise(none),
        F.when(F.col("at") > F.col("share"), F.array(own)).otherwise(none))
    size = F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("share"))
    rows = turns.select("base", "conv", size.alias("size"), F.explode(here).alias("t")).select("base", "conv", "size", "t.*")
    hashes = [F.xxhash64("depth", "digest"), F.xxhash64("digest", F.lit("second"), "depth")]
    for i, h in enumerate(hashes, 1):
        rows = rows.withColumn(f"h{i}", F.when(F.col("depth") > 0, h).otherwise(F.lit(0).cast("long")))
    so_far = of_conv.orderBy("depth")
    keys = [F.bit_xor(h).over(so_far).alias(k) for h, k in (("h1", "k1"), ("h2", "k2"))]
    return rows.select(
        "conv", "depth", "h1", "h2", *keys, "words", (F.col("depth") == F.col("size")).alias("last"))


def climb(rows: list[tuple]) -> Iterator[tuple]:
    """The trie over one shard's rows (conv, depth, h1, h2, k1, k2, words, last), ordered by conversation and depth, none
    of whose depths are left out; a conversation may begin or end amid its turns. Yields per node: its key, its parent's, depth,
    words, members, least member, the least of those that end there, and all of these (ascending 64-bit integers; None if none).

    Bitmaps are integers with a bit per conversation. The index has one for each depth and turn; a node's members, intersected
    with the index at the next depth, are a child's. Only turns that members have there are looked at, so each
    intersection is a node. Depth first, on a stack of its own.
    """
    starts: dict[tuple, int] = {}
    index: dict[tuple, int] = {}
    ends: dict[int, int] = {}
    stops: dict[int, int] = {}
    first: list[int] = []
    conversations: list[int] = []
    for at, (conv, depth, h1, h2, k1, k2, _, last) in enumerate(rows):
        if not conversations or conversations[-1] != conv:
            conversations.append(conv)
            first.append(at)
            bit = 1 << len(conversations) - 1
            starts[depth, k1, k2] = starts.get((depth, k1, k2), 0) | bit
        index[depth, h1, h2] = index.get((depth, h1, h2), 0) | bit
        if last:
            ends[depth] = ends.get(depth, 0) | bit
        if at + 1 == len(rows) or rows[at + 1][0] != conv:
            stops[depth] = stops.get(depth, 0) | bit
    base = [at - rows[at][1] for at in first]
    stack = [(depth, members) for (depth, _, _), members in starts.items()]
    while stack:
        depth, members = stack.pop()
        least = (members & -members).bit_length() - 1
        _, _, h1, h2, k1, k2, words, _ = rows[base[least] + depth]
        ended, first_end, listed = members & ends.get(depth, 0), None, None
        if ended:
            bits = np.frombuffer(ended.to_bytes(-(-ended.bit_length() // 8), "little"), np.uint8)
            here = np.flatnonzero(np.unpackbits(bits, bitorder="little"))
            listed = np.array([conversations[j] for j in here], np.int64).tobytes()
            first_end = conversations[here[0]]
        yield k1, k2, k1 ^ h1, k2 ^ h2, depth, words, members.bit_count(), conversations[least], first_end, listed
        rest = members & ~stops.get(depth, 0)
        while rest:
            one = (rest & -rest).bit_length() - 1
            _, _, h1, h2, *_ = rows[base[one] + depth + 1]
            child = members & index[depth + 1, h1, h2]
            stack.append((depth + 1, child))
            rest &= ~child


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv", "depth", "h1", "h2", "k1", "k2", "words", "last", "part"]
    types = [pa.int64()] * 4 + [pa.int32()] + [pa.int64()] * 4 + [pa.binary()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*climb(rows), strict=True)
        of = ["k1", "k2", "p1", "p2", "depth", "words", "n", "least", "first_end", "ends"]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], of)

    rows: list[tuple] = []
    now = conv = None
    n = 0
    for batch in batches:
        for *row, part in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            # A shard is a run of neighbouring conversations; another part of the table needn't follow on.
            if rows and (part != now or len(rows) >= TURNS or (row[0] != conv and n >= CONVERSATIONS)):
                yield made(rows)
                rows, n = [], 0
            n += not rows or row[0] != conv
            now, conv = part, row[0]
            rows.append(tuple(row))
    if rows:
        yield made(rows)


def _digests(ends: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256 of nodes that conversations end at. Shards' lists follow on each other, so a node's digest is taken
    as they stream by, whatever their number."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def made() -> tuple:
            return (*now, state.hexdigest())

        for batch in batches:
            out = []
            for k1, k2, listed in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ends")), strict=True):
                text = ",".join(map(str, np.frombuffer(listed, np.int64).tolist()))
                if (k1, k2) != now:
                    if now:
                        out.append(made())
                    now, state = (k1, k2), sha256()
                else:
                    text = "," + text
                state.update(text.encode())
            yield _rows(out)
        if now:
            yield _rows([made()])

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [[]] * 3
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.string()], strict=True)],
                               ["k1", "k2", "ends_sha256"])

    ordered = ends.select("k1", "k2", "first_end", "ends").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first_end")
    return ordered.select("k1", "k2", "ends").mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, heavy_share: float = HEAVY) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null roles and texts are empty. Turns of one number are ordered by the MD5 of their role and text, so equal rows are
    two equal turns; null numbers come first. Rows without a conv_id take no part; further columns don't matter; an empty
    table has no nodes. Nodes are told apart by 128 bits of hashes. A conversation's turns are sorted in one task, as rows of
    some 40 bytes, and the ids that end at one node are hashed in one, as the digest runs over all of them in order.

    A shard is a run of conversations; each gives its part of the trie, and parts are added up by node. Sums over subtrees need no
    climbing: the least member of a node, its owner, owns all nodes on its way from there on. So a node's subtree
    holds what its owner owns from there on, and all that its other members own.
    """
    prefixes = stored(rebuilt(conversations), "prefixes")
    part = F.xxhash64(F.input_file_name(), F.input_file_block_start()).alias("part")
    parts = stored(prefixes.select("*", part).mapInArrow(_shards, _NODE), "shards")
    key = ["k1", "k2"]
    nodes = parts.groupBy(*key).agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("depth").alias("depth"), F.max("words").alias("words"),
        F.sum("n").alias("n"), F.min("least").alias("owner"))
    nodes = stored(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children"))
    nodes = nodes.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    own = (F.col("n") - 1) * F.col("words")
    of_owner = Window.partitionBy("owner")
    nodes = nodes.withColumns({
        "from_here": F.sum(own).over(of_owner.orderBy(F.desc("depth"))), "owned": F.sum(own).over(of_owner),
        "leaf": F.max((F.col("n_children") == 0).cast("long")).over(of_owner),
        "top": F.min("depth").over(of_owner) == F.col("depth")})
    nodes = stored(nodes, "owned-nodes")
    owners = nodes.where("top").select(F.col("owner").alias("conv"), "owned", "leaf")
    members = prefixes.select("conv", *key).join(owners, "conv").groupBy(*key).agg(
        F.sum("owned").alias("all_owned"), F.sum("leaf").alias("n_leaves"))
    # A node that isn't its owner's first has a parent of the same owner. Others look it up: of few heavy parents by
    # broadcast, so that no task gets all their children.
    total = nodes.count()
    parents = nodes.where("n_children > 0").select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("owner").alias("above"), "n_children")
    is_heavy = F.col("n_children") > heavy_share * total
    heavy = F.broadcast(parents.where(is_heavy).drop("n_children"))
    below = nodes.where("top").drop("top").join(heavy, ["p1", "p2"], "left")
    # The root stands for its own parent in key.
    below = below.withColumn("above", F.when(F.col("depth") > 0, F.col("above")))
    found = below.where("depth = 0 OR above IS NOT NULL")
    rest = below.where("depth > 0 AND above IS NULL").drop("above").join(
        parents.where(~is_heavy).drop("n_children"), ["p1", "p2"])
    within = nodes.where(~F.col("top")).drop("top").withColumn("above", F.col("owner"))
    nodes = found.unionByName(rest).unionByName(within)
    out = nodes.join(members, key).join(_digests(parts.where(F.col("ends").isNotNull())), key, "left")
    return out.select(
        F.col("owner").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("above").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), "n_children", "n_leaves",
        (F.col("from_here") + F.col("all_owned") - F.col("owned")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(sha256().hexdigest())).alias("ends_sha256"))


ORACLE = rf"""
WITH RECURSIVE c AS (SELECT conv_id AS c, conv_id - conv_id % {GROUP} AS base, count(*) AS own FROM conversations
    WHERE conv_id IS NOT NULL GROUP BY conv_id),
crc(c, i, v) AS (
  SELECT c, 0, CAST(4294967295 AS BIGINT) FROM c
  UNION ALL
  SELECT c, i + 1, (SELECT CASE WHEN w % 2 = 1 THEN xor(w // 2, CAST(3988292384 AS BIGINT)) ELSE w // 2 END
    FROM (SELECT CASE WHEN i % 8 = 0 THEN xor(v, CAST(ord(CAST(c AS VARCHAR)[i // 8 + 1]) AS BIGINT)) ELSE v END AS w))
  FROM crc WHERE i < 8 * length(CAST(c AS VARCHAR))),
h AS (SELECT c, xor(v, CAST(4294967295 AS BIGINT)) % {SHARED + 1} AS h FROM crc WHERE i = 8 * length(CAST(c AS VARCHAR))),
t AS (SELECT conv_id AS c, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, m) AS at FROM conversations WHERE conv_id IS NOT NULL),
r AS (SELECT c.c, t.at AS part, 0 AS own, m, w FROM c JOIN h USING (c) JOIN t ON t.c = c.base AND t.at <= h
      UNION ALL SELECT t.c, t.at, 1, m, w FROM t JOIN h ON t.c = h.c AND t.at > h),
p AS (SELECT c, row_number() OVER o AS d, w, list(m) OVER o AS path FROM r WINDOW o AS (PARTITION BY c ORDER BY own, part)
      UNION ALL SELECT c, 0, 0, [] FROM c),
l AS (SELECT c, max(d) AS d FROM p GROUP BY c),
n AS (SELECT path, p.d AS d, any_value(w) AS w, count(*) AS n, min(p.c) AS conv,
        sha256(coalesce(string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) FILTER (l.d = p.d), '')) AS ends
      FROM p JOIN l USING (c) GROUP BY path, p.d),
k AS (SELECT path[:d - 1] AS path, count(*) AS k FROM n WHERE d > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(k, 0) AS k FROM n LEFT JOIN k USING (path))
SELECT a.conv AS conv_id, CAST(a.d AS BIGINT) AS depth, any_value(u.conv) AS parent_conv_id, a.n AS n_convs, a.k AS n_children,
  count(*) FILTER (b.k = 0) AS n_leaves, CAST(sum((b.n - 1) * b.w) AS BIGINT) AS saved_tokens, a.ends AS ends_sha256
FROM f AS a JOIN f AS b ON b.path[:a.d] = a.path LEFT JOIN f AS u ON a.d > 0 AND u.path = a.path[:a.d - 1]
GROUP BY a.path, a.conv, a.d, a.n, a.k, a.ends
"""
