"""Main text of web pages by wrappers that are inferred from the pages of a host."""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import bounded, stored
from tidemark.llm.urls import host

# Names of HTML, fixed by its standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style noscript template textarea title iframe noembed noframes xmp select object svg math"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
#: An element that is opened closes an open one of these, up to the first of those.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Elements whose text is rarely an article's, and words in classes, ids and roles that say the same.
ASIDE = frozenset("nav footer aside form button menu dialog head fieldset".split())
ASIDE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist"
    " complementary contentinfo consent cookie cookies copyright disqus footer form header login masthead menu menubar modal"
    " nav navbar navigation newsletter notice notification pager pagination popup promo promoted related replies"
    " reply respond search share sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget widgets".split()
)
MAIN = frozenset(["article", "main"])
#: Share of a page's weight from which on an element isn't set aside, whatever its name and words.
OVERRULED = 0.5
#: Different main texts beside which the same text has to stand at the same place before it counts as the template's.
SAME = 3
#: What running text in a main element weighs against other text, and an h1 when the main place is chosen.
EVIDENCE = 16
#: Share of a page's weight that the main place holds at least.
HELD = 0.9
#: Words of a block that make it a sentence rather than a label.
SENTENCE = 8
#: Open elements that make a place at most. What is nested deeper stands at the place of that depth.
DEPTH = 64
#: Pairs of items up to which lists are aligned by their longest common sequence.
PAIRS = 250_000
#: Wrappers that are aligned in one task at most, about.
TOGETHER = 1_024
#: Bytes of all hosts' rules that are broadcast at most.
RULE_BYTES = 32 << 20

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s>/<]*)(?P<attrs>(?:\"[^\"<]*+\"|'[^'<]*+'|[^'\"<>]|['\"])*?)>",
    re.DOTALL,
)
RAW_END = {x: re.compile(rf"</{x}\s*(?:>|\Z)", re.IGNORECASE) for x in RAW.split()}
ATTR = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)


def label(name: str, attrs: str, in_main: bool = False) -> str:
    """An element's place in a wrapper: name, first class without digits; main: before it, for the role main; and after it
    ! with the words that speak for setting it aside, if any do. A page's frame and main elements have none."""
    found = [(k.lower(), a or b or c) for k, a, b, c in ATTR.findall(attrs)] if attrs.strip() else []
    classes = " ".join(v for k, v in found if k == "class").split()
    first = re.sub(r"\d+", "", classes[0]) if classes else ""
    role = ("role", "main") in [(k, v.strip().lower()) for k, v in found]
    own = ("main:" if role else "") + name + (f".{first}" if first else "")
    if role or name in MAIN or name in ("html", "body"):
        return own.replace("!", "")
    words = {w for _, v in found for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", v).lower())}
    against = words & ASIDE_WORDS | ({name} & ASIDE)
    if name == "header":
        # Of the page it is set aside, of an article it holds the heading.
        against = against - {name} if in_main else against | {name}
    return own.replace("!", "") + ("!" + "+".join(sorted(against)) if against else "")


def is_main(label_: str) -> bool:
    """Whether an element with this label is article, main or has the role main."""
    return re.split("[.:]", label_, maxsplit=1)[0] in MAIN


def in_main(place: tuple) -> bool:
    """Whether a place is in a main element, and in nothing there that is to be set aside."""
    inner = next((place[i:] for i in range(len(place) - 1, -1, -1) if is_main(place[i])), ())
    return bool(inner) and not any("!" in name for name in inner)


class Block:
    """Text of one block: its place (labels of open elements), and its length within links."""

    __slots__ = ("place", "text", "linked")

    def __init__(self, place, text, linked):
        self.place, self.text, self.linked = place, text, linked


def blocks(html: str | None) -> list[Block]:
    """A page's non-empty blocks, in order. Unclosed elements end with their parent or the page; an end without a start is
    passed over."""
    html = html or ""
    # Open elements: name, label, whether in a main element. Inline ones aren't kept, but open links are counted.
    stack: list[tuple[str, str, bool]] = []
    opened: Counter[str] = Counter()
    out: list[Block] = []
    text: list[str] = []
    link = linked = 0

    def flush() -> None:
        nonlocal linked
        joined = " ".join(unescape("".join(text)).split())
        if joined:
            out.append(Block(tuple(x[1] for x in stack[:DEPTH]), joined, linked))
        text.clear()
        linked = 0

    def leave(i: int) -> None:
        opened.subtract(x[0] for x in stack[i:])
        del stack[i:]

    def close(names, until) -> None:
        if not any(opened[x] for x in names):
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in until:
                return
            if stack[i][0] in names:
                leave(i)
                return

    at = 0
    while at < len(html):
        m = TOKEN.search(html, at)
        piece = html[at : m.start()] if m else html[at:]
        if piece:
            text.append(piece)
            if link:
                linked += len(piece)
        if not m:
            break
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["end"]:
            if name == "a":
                link = 0
            elif name == "br":
                text.append(" ")
            elif name not in INLINE:
                flush()
                if opened[name]:
                    i = len(stack) - 1
                    while stack[i][0] != name:
                        i -= 1
                    leave(i)
            continue
        if name in RAW_END and not m["attrs"].endswith("/"):
            end = RAW_END[name].search(html, at)
            at = end.end() if end else len(html)
            continue
        if name == "a":
            link = 1
        elif name in INLINE:
            if name == "br":
                text.append(" ")
            continue
        else:
            flush()
            if name in VOID or m["attrs"].endswith("/"):
                continue
            if name in CLOSES:
                close(*CLOSES[name])
            else:
                close({"p"}, {"article", "section", "div", "td", "th", "li", "blockquote", "main", "body"})
            inside = bool(stack) and stack[-1][2]
            own = label(name, m["attrs"], inside)
            stack.append((name, own, inside or is_main(own)))
            opened[name] += 1
    flush()
    return out


# A wrapper is a union-free regular expression over a host's pages: a list of items [label, optional, repeated, content].
# Content is, for an element, its list of items; for a text slot, [hashes of main texts of pages that show it, SAME at most,
# hash of the one text or "" if texts differ, running text]. Merging a copy changes nothing. Running text is the most that a page shows there, in characters less two for each in links. "#" labels a slot.


def _digest(text: str) -> str:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=6).hexdigest()


def _leaf(b: Block) -> list:
    return ["#", 0, 0, [[], _digest(b.text), len(b.text) - 2 * b.linked]]


def _tree(page: list[Block]) -> list:
    """A page as a wrapper of its own, repetitions folded."""
    root: list = []
    open_: list[tuple[str, list]] = []
    for b in page:
        k = 0
        while k < min(len(open_), len(b.place)) and open_[k][0] == b.place[k] and k < len(b.place) - 1:
            k += 1
        del open_[k:]
        for name in b.place[k:]:
            items = open_[-1][1] if open_ else root
            items.append([name, 0, 0, []])
            open_.append((name, items[-1][3]))
        (open_[-1][1] if open_ else root).append(_leaf(b))
    own = _digest("\n\n".join(b.text for b in _main_blocks(page, rules(root))))

    def mark(items: list) -> None:
        for name, _, _, content in items:
            if name == "#":
                content[0] = [own]
            else:
                mark(content)

    mark(root)
    return _fold(root)


def _fold(items: list) -> list:
    """Neighbours with the same label become one repeated item, then neighbouring pairs one after the other."""
    out: list = []
    for label_, opt, rep, content in items:
        content = content if label_ == "#" else _fold(content)
        if out and out[-1][0] == label_:
            out[-1] = _merge(out[-1], [label_, opt, 1, content], True)
            out[-1][2] = 1
        else:
            out.append([label_, opt, rep, content])
    i = 0
    while i + 3 < len(out):
        if out[i][0] == out[i + 2][0] and out[i + 1][0] == out[i + 3][0]:
            out[i : i + 4] = [_merge(out[i], out[i + 2], True), _merge(out[i + 1], out[i + 3], True)]
            out[i][2] = out[i + 1][2] = 1
        else:
            i += 1
    return out


def _merge(a: list, b: list, folded: bool = False) -> list:
    """Two items as one, of different pages, or folded, of the same: texts that differ leave a slot, elements align within."""
    if a[0] == "#":
        x, y = a[3], b[3]
        one = x[1] if x[1] == y[1] else ""
        beside = sorted({*x[0], *y[0]})[:SAME]
        content = [beside, one, x[2] + y[2] if folded else max(x[2], y[2])]
    else:
        content = align(a[3], b[3], folded)
    return [a[0], a[1] | b[1], a[2] | b[2], content]


def align(a: list, b: list, folded: bool = False) -> list:
    """The least general wrapper of both: what matches in order is merged, what has no partner becomes optional."""
    partners = _common(a, b) if len(a) * len(b) <= PAIRS else _by_occurrence(a, b)
    out, i, j = [], 0, 0
    for k, m in [*partners, (len(a), len(b))]:
        out += [[x[0], 1, x[2], x[3]] for x in (*a[i:k], *b[j:m])]
        if k < len(a):
            out.append(_merge(a[k], b[m], folded))
        i, j = k + 1, m + 1
    return _fold(out)


def _common(a: list, b: list) -> list[tuple[int, int]]:
    """Places of a longest common sequence of labels."""
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = (
                best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
            )
    out, i, j = [], 0, 0
    while i < n and j < m:
        if a[i][0] == b[j][0]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def _by_occurrence(a: list, b: list) -> list[tuple[int, int]]:
    """The same for long lists, where only equal occurrences of a label are partners, the third with the third: the longest
    run of them that is in order on both sides."""

    def numbered(items: list) -> list[tuple[str, int]]:
        seen: Counter[str] = Counter()
        out = []
        for name, *_ in items:
            out.append((name, seen[name]))
            seen[name] += 1
        return out

    at = {x: j for j, x in enumerate(numbered(b))}
    pairs = [(i, at[x]) for i, x in enumerate(numbered(a)) if x in at]
    # The least end of a rising run of each length, and each pair's predecessor.
    ends: list[int] = []
    runs: list[int] = []
    before: list[int] = []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(ends, j)
        ends[k : k + 1], runs[k : k + 1] = [j], [n]
        before.append(runs[k - 1] if k else -1)
    out, n = [], runs[-1] if runs else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def rules(wrapper: list) -> dict:
    """What extraction needs of a wrapper: what the slots at each place weigh, and the texts that are the template's."""
    weight: dict[str, int] = {}
    same: list[str] = []

    def walk(items: list, place: tuple) -> None:
        for name, _, _, content in items:
            if name != "#":
                walk(content, place + (name,))
                continue
            beside, one, running = content
            key = "/".join(place)
            if one and len(beside) >= SAME:
                same.append(f"{key}:{one}")
            elif running > 0:
                weight[key] = weight.get(key, 0) + running * (EVIDENCE if in_main(place) else 1)

    walk(wrapper, ())
    return {"weight": weight, "same": sorted(same)}


def main_places(weight: dict[tuple, float]) -> list[tuple]:
    """The main place, given what the text at each of a page's places weighs: the deepest one that holds ``HELD`` of all and
    isn't below a main element. Main elements beside each other can be it together."""
    root: list = [0, {}]
    for place, w in weight.items():
        w *= EVIDENCE if place and place[-1].split(".")[0] == "h1" else 1
        node = root
        node[0] += w
        for name in place if w else ():
            node = node[1].setdefault(name, [0, {}])
            node[0] += w
    held, node, at = HELD * root[0], root, ()
    while not (at and is_main(at[-1])):
        mains = sorted(name for name in node[1] if is_main(name))
        if mains and sum(node[1][name][0] for name in mains) >= held:
            return [(*at, name) for name in mains]
        best = max(node[1], key=lambda name: (node[1][name][0], name), default=None)
        # A paragraph counts for the element that holds it, so one isn't taken for all.
        if best is None or not node[1][best][1] or node[1][best][0] < held:
            break
        node, at = node[1][best], (*at, best)
    return [at]


def _asides(weight: dict[tuple, float]) -> set[tuple]:
    """Elements, by their places, that are set aside: those with a word against them, unless the text in them weighs
    ``OVERRULED`` of all."""
    below: dict[tuple, float] = {}
    for place, w in weight.items():
        for k, name in enumerate(place):
            if "!" in name:
                below[place[: k + 1]] = below.get(place[: k + 1], 0) + w
    least = OVERRULED * sum(weight.values())
    return {place for place, w in below.items() if not w or w < least}


def _main_blocks(page: list[Block], rule: dict) -> list[Block]:
    """Blocks below the main place, by the weight of the wrapper's slots, that aren't the template's."""
    same = set(rule["same"])
    weight = {b.place: rule["weight"].get("/".join(b.place), 0) for b in page}
    aside = _asides(weight)
    weight = {p: w for p, w in weight.items() if not any("!" in x and p[: k + 1] in aside for k, x in enumerate(p))}
    places = main_places(weight)
    # Only a main element ends the text: beyond another main place, sentences are the page's too.
    whole = not any(p and is_main(p[-1]) for p in places)

    def chosen(b: Block) -> bool:
        if b.place not in weight or f"{'/'.join(b.place)}:{_digest(b.text)}" in same:
            return False
        sentence = whole and weight[b.place] > 0 and len(b.text.split()) >= SENTENCE
        return sentence or any(b.place[: len(p)] == p for p in places)

    return [b for b in page if chosen(b)]


def text_of(html: str | None, rule: dict | None) -> str:
    """The main text of one page: blocks below the main place that the host's wrapper chooses, without what stands
    aside or is the template's. Without a rule, the page is a wrapper of its own."""
    page = blocks(html)
    return "\n\n".join(b.text for b in _main_blocks(page, rule or rules(_tree(page))))


def wrappers(pages: DataFrame) -> DataFrame:
    """A row per host: host, rule (JSON). A host's distinct pages are aligned in the order of their digests, ``TOGETHER`` in a
    task at most, by digest; then what comes of these is aligned in the same way. So the result doesn't depend on how rows are
    dealt to tasks, and copies don't count."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # A task sends a copy once per batch.
            found = {}
            for h, html in batch[["host", "html"]].drop_duplicates().itertuples(index=False):
                text = json.dumps(_tree(blocks(html)))
                digest = int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), signed=True)
                found[h, digest] = text
            yield pd.DataFrame([(*k, t) for k, t in found.items()], columns=["host", "digest", "wrapper"])

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        whole = last = None
        for digest, w in sorted(zip(frame["digest"], frame["wrapper"], strict=True)):
            if (digest, w) != last:
                whole = json.loads(w) if whole is None else align(whole, json.loads(w))
            last = digest, w
        first = frame.iloc[0]
        made = {"host": [first["host"]], "digest": [first["part"]], "wrapper": [json.dumps(whole)]}
        return pd.DataFrame(made | {"rule": [json.dumps(rules(whole))]})

    rows = pages.select(host(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    trees = stored(rows.mapInPandas(parse, "host string, digest long, wrapper string"), "page-trees")
    large = trees.select("host", "digest").distinct().groupBy("host").agg(F.count("*").alias("n"))
    large = stored(large.where(F.col("n") > TOGETHER), "large-hosts")
    most = large.agg(F.max("n")).first()[0] or 1
    parts = F.coalesce(F.ceil(F.col("n") / TOGETHER), F.lit(1)).cast("long")
    now = trees.join(bounded(large), "host", "left").withColumn("part", F.pmod("digest", parts)).drop("n")
    schema = "host string, digest long, wrapper string, rule string"
    done = now.groupBy("host", "part").applyInPandas(join, schema)
    while most > TOGETHER:
        most = -(-most // TOGETHER)
        done = stored(done.drop("rule"), "wrappers").withColumn("part", F.expr(f"digest div {TOGETHER}"))
        done = done.groupBy("host", "part").applyInPandas(join, schema)
    return done.select("host", "rule")


def extract(pages: DataFrame) -> DataFrame:
    """A row per page: page_id, url, text, n_chars.

    A null, empty or blank html has the empty text. Pages without a url, or with one without a host, share the host ''. Equal rows
    each get a row, further columns don't matter, an empty table gives none.

    Wrappers are inferred over all pages first. Their rules are broadcast if they are small, else joined by host.
    """
    known = stored(wrappers(pages), "rules")
    size = known.agg(F.coalesce(F.sum(F.length("rule") + F.length("host")), F.lit(0))).first()[0]
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    rows = rows.join(F.broadcast(known) if size <= RULE_BYTES else known, "host", "left").drop("host")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsed: dict[str | None, dict | None] = {}
        for batch in batches:
            out = []
            for html, r in zip(batch.column("html"), batch.column("rule"), strict=True):
                r = r.as_py()
                if r not in parsed:
                    parsed[r] = json.loads(r) if r else None
                out.append(text_of(html.as_py(), parsed[r]))
            yield pa.record_batch({
                "page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(out, pa.string()),
                "n_chars": pa.array([len(t) for t in out], pa.int64()),
            })

    return rows.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", "rule").mapInArrow(
        apply, "page_id long, url string, text string, n_chars long")
