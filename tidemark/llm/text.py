"""Column expressions on texts: words, and the places of regular expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.tables import bounded, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, other letters as they are. ``lower`` does that fast where all is ASCII."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """Words of ASCII letters (lower-cased), digits and all characters beyond ASCII. Null has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN, -1), "")


def matches(docs: DataFrame, patterns: dict[str, str], may: dict[str, Column], context: int = 0) -> DataFrame:
    """Leftmost non-overlapping matches of each pattern in the column ``text``, by position.

    docs: ``text``, and any further columns, which stay; ``row``, one of them, numbers the rows. ``may`` has a cheap
    condition for each kind without which there is no match. Returns, beside the columns of docs but ``text``: kind,
    start, end (code points, end exclusive), match, before and after (the text up to the neighbours of the same
    kind, at most ``context`` characters of it), and for each row of docs one row more, with kind null.

    Spark has no function for places, so a text is split at its matches and the lengths of the pieces add up.
    """
    parts = [F.array(F.lit(None).cast(_PIECE))]
    for kind, pattern in patterns.items():
        found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        gaps = F.split("text", pattern, -1)
        zipped = F.zip_with(
            F.transform(found, lambda m, i: F.struct(i.alias("i"), m.alias("m"))),
            gaps,
            lambda m, g: F.struct(
                F.lit(kind).alias("kind"), m["i"].alias("i"), m["m"].alias("match"),
                F.char_length(g).alias("gap"), F.right(g, F.lit(context)).alias("before"),
                F.substring(g, 1, context).alias("head"),
            ),
        )
        parts.append(F.when(may[kind], zipped).otherwise(F.array().cast(f"array<{_PIECE}>")))
    others = [c for c in docs.columns if c != "text"]
    pieces = docs.select(*others, F.explode(F.concat(*parts)).alias("p"))
    in_text = Window.partitionBy("row", "p.kind").orderBy(F.col("p.i").asc_nulls_last())
    size = F.col("p.gap") + F.coalesce(F.char_length("p.match"), F.lit(0))
    placed = pieces.select(
        "*", F.sum(size).over(in_text.rowsBetween(Window.unboundedPreceding, 0)).alias("end"),
        F.lead("p.head").over(in_text).alias("after"),
    )
    # The piece after the last match has no match of its own: it only closes the text.
    return placed.where("p.kind IS NULL OR p.match IS NOT NULL").select(
        *others, "p.kind", F.col("p.match").alias("match"),
        (F.col("end") - F.char_length("p.match")).alias("start"), "end",
        F.col("p.before").alias("before"), "after",
    )


_PIECE = "struct<kind:string,i:int,match:string,gap:int,before:string,head:string>"


def spans_text(kinds: list[str], spans: Column) -> Column:
    """Spans (structs of start, end, kind) as kind:start:end by start, then kind as listed, comma-joined."""
    order = F.create_map(*[x for i, k in enumerate(kinds) for x in (F.lit(k), F.lit(i))])
    ranked = F.transform(spans, lambda s: F.struct(s["start"], order[s["kind"]].alias("o"), s["end"], s["kind"]))
    return F.array_join(
        F.transform(F.array_sort(ranked), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


#: Code points of a block that a long text is taken apart into, so that a place in it is near the start of one.
BLOCK = 1024


def cuts(spans: DataFrame, by: list[str], whole: bool = False) -> DataFrame:
    """From a row per key (columns ``by``) with ``_spans`` (structs of start, end, mark; any order) to what stays between them:
    ``by``, _cuts (structs of start and end of what stays and the mark after it, in order) and _tail (where the last span ends).

    Of spans that overlap, the first leaves its mark and all are cut out; with ``whole`` each leaves its mark."""
    rows = spans.select(*by, F.inline("_spans"))
    in_text = Window.partitionBy(*by).orderBy("start", "end", "mark")
    before = F.max("end").over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("at", F.coalesce(before, F.lit(0)).cast("int"))
    stays = F.struct("at", F.greatest("at", F.col("start").cast("int")).alias("to"), "mark")
    kept = F.lit(True) if whole else F.col("start") >= F.col("at")
    return rows.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.when(kept, stays))).alias("_cuts"), F.max("end").cast("int").alias("_tail"))


def blocks(text: Column) -> Column:
    """``text`` in blocks, as ``put_together`` takes it: a column of its own, so that it is made once per row."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def put_together(of: Column, length: Column, cuts: Column, tail: Column) -> Column:
    """The text whose ``blocks`` are given, with what ``cuts`` leave of it. Each piece is looked up in its own blocks, so a text
    with many spans takes time in proportion to them."""

    def piece(start: Column, end: Column) -> Column:
        first, last = (F.floor(x / BLOCK).cast("int") for x in (start, end - 1))
        here, there = (start % BLOCK + 1).cast("int"), ((end - 1) % BLOCK + 1).cast("int")
        one = F.substring(F.get(of, first), here, (end - start).cast("int"))
        more = F.concat(
            F.substring(F.get(of, first), here, F.lit(BLOCK)), F.array_join(F.slice(of, first + 2, last - first - 1), ""),
            F.substring(F.get(of, last), F.lit(1), there))
        return F.when(end <= start, F.lit("")).when(first == last, one).otherwise(more)

    return F.concat(
        F.array_join(F.transform(cuts, lambda c: F.concat(piece(c["at"], c["to"]), c["mark"])), ""), piece(tail, length))


def rewrite(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """docs (doc_id, text, n_chars if there, more) with the spans (_id, _key, _spans: one row per key) cut out. _key
    is xxhash64(doc_id, text). Rows without spans, and columns other than text and n_chars, stay as they are."""
    found = bounded(stored(cuts(spans, ["_id", "_key"]), "cuts"))
    same = docs["doc_id"].eqNullSafe(found["_id"]) & (F.xxhash64(docs["doc_id"], docs["text"]) == found["_key"])
    joined = docs.join(found, same, "left").withColumn("_blocks", F.when(F.col("_tail").isNotNull(), blocks(F.col("text"))))
    cut = put_together(F.col("_blocks"), F.char_length("text"), F.col("_cuts"), F.col("_tail"))
    out = joined.withColumn("text", F.when(F.col("_tail").isNull(), F.col("text")).otherwise(cut))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("_tail").isNull(), F.col("n_chars")).otherwise(
            F.char_length("text").cast(kind)))
    return out.select(*docs.columns)
