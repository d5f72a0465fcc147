"""Whitening, exact search and the trie against brute force: given tables and odd ones."""

import hashlib
import math
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import search, trie, whitening

VECTORS = "vec_id long, embedding array<double>, label int, n long, rank int"


def steps(vector):
    """Components as integers; None for a vector that doesn't count."""
    if vector is None or not len(vector) or any(c is None or not math.isfinite(c) for c in vector):
        return None
    ends = -(1 << 63), (1 << 63) - 1
    return tuple(min(max(math.floor(Fraction(c) * 256), ends[0]), ends[1]) for c in vector)


# ---- whitening


def whitened(rows):
    """Rows' (vec_id, whitened per component), explained, n, and exact deviations, by a full decomposition."""
    taken = [(i, x) for i, v in rows if (x := steps(v))]
    distinct = sorted({x for _, x in taken})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
    mean = np.array([s / n for s in sums])
    values, vectors = np.linalg.eigh(np.cov(np.array(distinct, float).T, bias=True).reshape(len(sums), -1))
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(4, int((values > 1e-9 * values[0]).sum()) if values[0] > 0 else 0)
    white = [(i, (np.array(x, float) - mean) @ vectors[:, :k] / np.sqrt(values[:k])) for i, x in taken]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)) for _, x in taken]
    return white, values[:k] / values.sum() if k else [], n, deviation


def check_whitening(spark, rows):
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], VECTORS)
    got = defaultdict(list)
    for r in whitening.whiten(df).collect():
        got[r["component"]].append(r)
    white, explained, n, deviation = whitened(rows)
    assert sorted(got) == [j + 1 for j in range(len(explained))]
    for j, share in enumerate(explained):
        ours = sorted((-1 if r["vec_id"] is None else r["vec_id"], r["whitened"]) for r in got[j + 1])
        theirs = sorted((-1 if i is None else i, w[j]) for i, w in white)
        sign = 1 if np.dot([x for _, x in ours], [x for _, x in theirs]) >= 0 else -1
        theirs = sorted((i, sign * x) for i, x in theirs)
        assert [i for i, _ in ours] == [i for i, _ in theirs]
        assert np.allclose([x for _, x in ours], [x for _, x in theirs], rtol=0, atol=1e-9)
        assert all(r["n"] == n and abs(r["explained"] / share - 1) < 1e-9 and r["identity_error"] < 1e-9 for r in got[j + 1])
        fits = [d if d < 1 << 63 else None for d in deviation]
        assert sorted((r["deviation"] or -1) for r in got[j + 1]) == sorted(d or -1 for d in fits)


def test_whitening_of_given_vectors(spark, table):
    check_whitening(spark, table("embeddings", "vec_id", "embedding"))


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, list(map(float, v))) for i, v in enumerate(rng.normal(size=(60, 5)) * [9, 7, 5, 3, 1])]
    odd = [(90, None), (91, [1.0, None, 1.0, 1.0, 1.0]), (92, [math.nan] + [0.0] * 4), (93, [math.inf] * 5), (None, [1.5] * 5), (94, [])]
    check_whitening(spark, rows + odd + rows[:20] * 3)  # copies count once, but each has its rows


def test_whitening_needs_more_columns_and_more_rounds(spark):
    """Forty dimensions of nearly one variance: few steps don't part them."""
    rng = np.random.default_rng(2)
    check_whitening(spark, [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(3000, 40)))])


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 0.5])], [(1, [0.5, 0.5]), (2, [0.5, 0.5])], [(1, None)]])
def test_nothing_to_whiten(spark, rows):
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], VECTORS)
    assert whitening.whiten(df).collect() == []


def test_whitening_with_few_dimensions_and_huge_components(spark):
    check_whitening(spark, [(i, [float(i), 0.0]) for i in range(9)])  # one component has variance
    rows = [(i, [math.ldexp(i % 3, 50), math.ldexp(i % 5, 48), float(i)]) for i in range(30)]
    assert all(r["deviation"] is None or r["deviation"] >= 0 for r in whitening.whiten(
        spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], VECTORS)).collect())


def test_lengths_are_whitened_by_themselves(spark):
    rng = np.random.default_rng(3)
    a = [(i, list(map(float, v))) for i, v in enumerate(rng.normal(size=(20, 3)))]
    b = [(100 + i, list(map(float, v))) for i, v in enumerate(rng.normal(size=(20, 6)))]
    both = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in a + b], VECTORS)
    rows = [r for r in whitening.whiten(both).collect() if r["vec_id"] < 100]
    alone = whitening.whiten(spark.createDataFrame([(i, v, 1, 2, 3) for i, v in a], VECTORS)).collect()
    assert {(r["vec_id"], r["component"], round(r["whitened"], 9)) for r in rows} == {
        (r["vec_id"], r["component"], round(r["whitened"], 9)) for r in alone}


def test_filter_finds_what_a_decomposition_finds():
    """The iteration alone, also where the block has to grow: 40 equal eigenvalues below the fourth."""
    rng = np.random.default_rng(4)
    q = np.linalg.qr(rng.standard_normal((100, 100)))[0]
    for values in (
        np.r_[9, 7, 5, 3, np.full(96, 2.9)], np.linspace(1, 2, 100), np.r_[1e6, 10, 9, 8, np.linspace(0, 7, 96)],
        np.r_[5, 5, 5, 5, np.zeros(96)], np.zeros(100),
    ):
        v = (q * values) @ q.T
        theta, vectors = whitening.principal(lambda x, v=v: v @ x, 100, 4)
        want = np.sort(values)[::-1][: len(theta)]
        assert len(theta) == min(4, int((values > 0).sum()))
        assert np.allclose(theta, want, rtol=1e-12)
        assert np.linalg.norm(v @ vectors - vectors * theta) <= 1e-9 * max(1, theta.max(initial=0))


# ---- search


def best(rows, every=50, k=5):
    taken = [(i, x) for i, v in rows if i is not None and (x := steps(v))]
    out = []
    for at, (q, x) in enumerate(taken):
        if q % every == 0:
            scores = [
                (-min(max(sum(a * b for a, b in zip(x, y, strict=True)), -(1 << 63)), (1 << 63) - 1), i)
                for n, (i, y) in enumerate(taken) if n != at and len(y) == len(x)
            ]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def found(spark, rows, every=50, k=5):
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], VECTORS)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in search.search(df, every, k).collect())


def test_search_of_given_vectors(spark, table):
    rows = table("embeddings", "vec_id", "embedding")
    assert found(spark, rows, 7) == best(rows, 7)


def test_search_of_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.integers(-3, 3, size=(300, 3)) / 256)]  # many ties
    odd = [
        (500, None), (550, [None, 1.0, 1.0]), (600, [math.nan, 1.0, 1.0]), (650, [math.inf, 1.0, 1.0]), (None, [9.0, 9.0, 9.0]),
        (700, []), (750, [1.0]), (800, [1.0, 2.0]), (801, [1.0, 3.0]), (-50, [0.5, 0.5, 0.5]),
        (850, [1e300, 0.0, 1.0]), (851, [-1e300, 1.0, 0.0]), (852, [1e17, 1.0, 0.0]), (853, [3e14, 1.0, 0.0]),
    ]
    rows = rows + odd + rows[:60]  # some ids and rows twice
    assert found(spark, rows) == best(rows)
    assert found(spark, rows[:3]) == best(rows[:3]) and len(best(rows[:3])) == 2
    assert found(spark, []) == []


def test_search_over_many_shards_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD", 64)
    monkeypatch.setattr(search, "LEAF", 8)
    monkeypatch.setattr(search, "QUERY_BYTES", 2_000)
    monkeypatch.setattr(search, "SIDE_BY_SIDE", 5)
    rng = np.random.default_rng(6)
    middles = rng.normal(size=(6, 8))
    rows = [(i, [float(c) for c in middles[i % 6] + 0.05 * rng.normal(size=8)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # a third are copies
    assert found(spark, rows, 10) == best(rows, 10)


def test_bounds_drop_nodes(monkeypatch):
    """In clusters, few leaves are multiplied out, and a shared score leaves fewer."""
    rng = np.random.default_rng(7)
    middles = 200 * rng.normal(size=(40, 8))
    x = np.floor(np.repeat(middles, 100, axis=0) + rng.normal(size=(4000, 8))).astype(np.int64)
    ids = np.arange(4000)
    order, nodes, centres = search.ball_tree(x, ids)
    tree = {"x": x[order], "ids": ids[order], "rows": ids[order], "nodes": nodes, "centres": centres}
    scored = []
    products = search._products
    monkeypatch.setattr(search, "_products", lambda q, y, exact: scored.append(len(q) * len(y)) or products(q, y, exact))
    q = x[::100]
    tops = search._Tops(np.tile([search.LEAST, search.MOST], (len(q), 1)), 5)
    search.descend(tree, q, ids[::100], tops, False)
    alone = sum(scored)
    assert alone < 0.4 * len(q) * len(x)
    scored.clear()
    again = search._Tops(np.stack([tops.least, tops.last], axis=1), 5)
    search.descend(tree, q, ids[::100], again, False)
    assert sum(scored) <= alone and (again.id == tops.id).all() and (again.score == tops.score).all()


# ---- trie


def nodes_of(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[c].append(((turn is not None, turn or 0), tie, role, text))
    members = defaultdict(list)
    for c, own in convs.items():
        base, h = c - int(math.fmod(c, 20)), zlib.crc32(str(c).encode()) % 4
        turns = [t[2:] for t in sorted(convs.get(base, []))[:h]] + [t[2:] for t in sorted(own)[h:]]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append((c, d == len(turns)))
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            if p:
                saved[p[:d]] += (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1]))
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c, end in m if end)))
        above = min(c for c, _ in members[p[:-1]]) if p else None
        out.append((min(c for c, _ in m), len(p), above, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_of(spark, rows, **how):
    schema = "conv_id long, turn long, role string, text string, n long, depth int"
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], schema)
    return sorted((tuple(r[c] for c in COLUMNS) for r in trie.prefix_trie(df, **how).collect()), key=str)


def test_trie_of_given_conversations(spark, table):
    rows = table("conversations", "conv_id", "turn", "role", "text", sf="/root/testdata/sf0.01")
    assert trie_of(spark, rows) == nodes_of(rows)


def odd_conversations():
    rng = np.random.default_rng(8)
    rows = []
    for c in [*range(-45, 130), 10**15, 10**15 + 1, -(1 << 63), (1 << 63) - 1]:
        for t in range(int(rng.integers(1, 6))):
            rows.append((c, t, ("user", "assistant")[t % 2], ("hi", "a  b\tc", "x" * 50, "")[int(rng.integers(4))]))
    rows += [(7, t, "user", "same") for t in range(400)]  # a long one
    rows += [(c, t, "user", f"common {t}") for c in range(200, 300) for t in range(4)]  # many alike
    rows += [(140, None, None, None), (140, None, "user", None), (140, 0, None, "x"), (None, 0, "user", "lost")]
    return rows + rows[:10]  # repeated rows


def test_trie_of_odd_conversations(spark):
    assert trie_of(spark, odd_conversations()) == nodes_of(odd_conversations())
    assert trie_of(spark, []) == []
    # A conversation whose few turns all belong to its group's absent first one is a member of the root alone.
    lonely = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    assert trie_of(spark, [(lonely, 0, "user", "a b")]) == nodes_of([(lonely, 0, "user", "a b")])


@pytest.mark.parametrize("conversations,turns", [(1, 1 << 30), (7, 1 << 30), (1 << 30, 1), (5, 13)])
def test_shards_don_t_matter(spark, monkeypatch, conversations, turns):
    """Shards of one conversation, and such that end amid one; and with every inner node heavy."""
    monkeypatch.setattr(trie, "CONVERSATIONS", conversations)
    monkeypatch.setattr(trie, "TURNS", turns)
    rows = odd_conversations()
    assert trie_of(spark, rows, heavy_share=0.0 if turns == 13 else 0.001) == nodes_of(rows)
