"""The operators' contracts in plain Python, without Spark."""

import re
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SECRETS = {
    "assign": (
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
        r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[2]) >= 6,
    ),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m[0])


PERSONAL = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
}


def base_spans(text, kinds):
    """(start, kind's place, end, kind) of all matches that stand."""
    out = []
    for at, (kind, (pattern, stands)) in enumerate(kinds.items()):
        out += [(m.start(), at, m.end(), kind) for m in re.finditer(pattern, text or "") if stands(m)]
    return sorted(out)


def spans_text(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))


def spans_row(doc_id, text, kinds):
    spans = base_spans(text, kinds)
    counts = {f"n_{k}": sum(s[3] == k for s in spans) for k in kinds}
    return {"doc_id": doc_id, **counts, "base_sha256": sha256(spans_text(spans).encode()).hexdigest()}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(docs, items, n=10):
    windows = defaultdict(set)
    for item_id, text in items:
        w = words(text)
        k = min(n, len(w))
        for p in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[p : p + k])].add(item_id)
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for k in sizes:
            for p in range(len(w) - k + 1):
                ids = windows.get(tuple(w[p : p + k]))
                if ids:
                    hit |= set(range(p, p + k))
                    found |= ids
        names = ",".join(sorted(str(i) for i in found if i is not None))
        out.append((doc_id, len(w), len(hit), len(found - {None}), sha256(names.encode()).hexdigest(), bool(hit)))
    return out


def reach(ids, links):
    """Least id reachable from each id."""
    least = {i: i for i in ids}

    def top(i):
        while least[i] != i:
            i = least[i]
        return i

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        least[y] = x
    return {i: top(i) for i in ids}


def shingles(text, k=5):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1)))


def near_duplicates(docs):
    """docs: pairs of a doc_id and a text. (doc_id, n_shingles, component, kept), a row each."""
    sets = [(i, shingles(t)) for i, t in docs]
    usable = [(i, s) for i, s in sets if s and i is not None]
    links = []
    for x, (a, s) in enumerate(usable):
        for b, t in usable[:x]:
            both = len(s & t)
            if 100 * both >= 85 * (len(s) + len(t) - both):
                links.append((a, b))
    least = reach({i for i, _ in sets if i is not None}, links)
    return [(i, len(s), least.get(i), i is None or least[i] == i) for i, s in sets]


def similar_vectors(rows):
    """rows: pairs of a vec_id and a list or None. (vec_id, n_links, component, kept), a row each."""
    def direction(v):
        x = None if v is None or any(c is None for c in v) else np.array(v, np.float64)
        return x / np.linalg.norm(x) if x is not None and len(x) and np.isfinite(x).all() and x.any() else None

    units = [(i, direction(v)) for i, v in rows]
    n, links = [0] * len(units), []
    for x, (a, u) in enumerate(units):
        for y in range(x):
            b, v = units[y]
            if u is None or v is None or len(u) != len(v) or a is None or b is None:
                continue
            if u @ v >= 0.9:
                n[x] += 1
                n[y] += 1
                links.append((a, b))
    least = reach({i for i, _ in units if i is not None}, links)
    return [(i, k, least.get(i), i is None or least[i] == i) for (i, _), k in zip(units, n, strict=True)]


def crc(text):
    return zlib.crc32((text or "").encode())
