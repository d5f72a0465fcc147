"""Personal data by pattern, and terms that reveal it by how they co-occur with it in the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import bounded, fits, stored
from tidemark.llm.text import blocks, cuts, lower_ascii, matches, put_together, rewrite, spans_text, words

#: Share of an entity's information that a term may give away.
DISCLOSURE = 0.85
#: Rows in which a term stands with an entity before its co-occurrence counts as measured.
SUPPORT = 2

# Maximal runs are tried once (look-behind, possessive repeats), so long runs cost linear time; matches are the same.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BASE = tuple(PATTERNS)
KINDS = [*PATTERNS, "term"]
#: A word as words() has them, in text that isn't lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _may() -> dict[str, Column]:
    text = F.col("text")
    return {
        "email": text.contains("@"),
        "ip": text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"),
        "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"),
        "phone": text.rlike(r"\+[0-9]"),
    }


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)

    def step(total: Column, i: Column) -> Column:
        d = F.substring(turned, i, F.lit(1)).cast("int")
        twice = F.when(d >= 5, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), step) % 10 == 0


def _stands() -> Column:
    m = F.col("match")
    byte = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    digits = F.regexp_replace(m, "[^0-9]", "")
    size = F.char_length(digits)
    return (
        F.col("kind").isNull() | (F.col("kind") == "email")
        | ((F.col("kind") == "ip") & m.rlike(rf"^{byte}\.{byte}\.{byte}\.{byte}$"))
        | ((F.col("kind") == "card") & size.between(12, 19) & F.when(size.between(12, 19), _luhn(digits)))
        | ((F.col("kind") == "phone") & size.between(9, 15))
    )


def entities(docs: DataFrame) -> DataFrame:
    """Base matches in docs (doc_id, text) as a stored table: row, doc_id, key, kind, start, end, entity (a hash). Each
    row of docs has one row more, with kind null."""
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("doc_id", "text").alias("key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    found = matches(numbered, PATTERNS, _may()).where(_stands())
    entity = F.when(F.col("kind").isNotNull(), F.xxhash64("kind", F.lower("match")))
    return stored(found.select("row", "doc_id", "key", "kind", "start", "end", entity.alias("entity")), "entities")


def _apart(held: DataFrame) -> DataFrame:
    """key, start, end of entities, where they overlap without what lies in an earlier one."""
    before = F.max("end").over(
        Window.partitionBy("key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    rows = held.select("key", "start", "end").distinct().withColumn("before", F.coalesce(before, F.lit(0)))
    rows = rows.where("end > before")
    return rows.select("key", F.greatest("start", "before").alias("start"), "end")


def revealing(docs: DataFrame, found: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """Terms that disclose an entity of their row, wherever they stand in it: row, doc_id, key, start, end.

    Terms are words as ``text.words`` has them, outside the row's entities. Over all documents, with N rows, n(e) that hold entity
    e, n(t) that hold term t and n(e,t) that hold both: the term gives away
    PMI(e;t) = log N n(e,t) / (n(e) n(t)) of the entity's information log N / n(e). It is
    revealing if that is at least ``disclosure`` of it, with n(e,t) at least ``support``.

    Paired are only entities and terms of ``support`` rows or more, and terms of at most n(e) (N / n(e)) ^ (1 - disclosure)
    rows: as n(e,t) <= n(e), a more frequent one can't reveal e.
    """
    # The rows that the entity table has with no kind are the rows of docs.
    rows = found.where("kind IS NULL").select("row", "doc_id", "key")
    n, held = rows.count(), found.where("kind IS NOT NULL")
    n_entity = held.select("entity", "row").distinct().groupBy("entity").agg(F.count("*").alias("n_e"))
    n_entity = n_entity.where((F.col("n_e") >= support) & (F.col("n_e") < n))
    most = F.col("n_e") * F.pow(F.lit(float(n)) / F.col("n_e"), F.lit(1 - disclosure)) * (1 + 1e-9)
    in_rows = stored(held.select("key", "entity").distinct().join(n_entity, "entity").withColumn("most", most), "held")
    most = bounded(stored(in_rows.groupBy("key").agg(F.max("most").alias("most")), "most"))
    # An entity's place becomes as many blanks.
    size = (F.col("end") - F.col("start")).cast("int")
    blank = F.struct("start", "end", F.repeat(F.lit(" "), size).alias("mark"))
    blank = cuts(_apart(held).groupBy("key").agg(F.collect_set(blank).alias("_spans")), ["key"], True)
    texts = docs.select(F.xxhash64("doc_id", "text").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(bounded(stored(blank, "blank")), "key", "left")
    texts = texts.withColumn("_blocks", F.when(F.col("_tail").isNotNull(), blocks(F.col("text"))))
    blanked = put_together(F.col("_blocks"), F.char_length("text"), F.col("_cuts"), F.col("_tail"))
    texts = texts.select("key", F.when(F.col("_tail").isNull(), F.col("text")).otherwise(blanked).alias("text"))
    # Each of several equal rows has its words.
    terms = texts.select("key", F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    near = stored(terms.join(most, "key"), "words")
    known, many = stored(near.select("term").distinct(), "terms"), F.count("*").alias("n_t")
    if fits(known):
        n_term = terms.join(F.broadcast(known), "term", "left_semi").groupBy("term").agg(many)
    else:
        # Counted before the join, so that a frequent term is a row per task.
        n_term = terms.groupBy("term").agg(many).join(known, "term", "left_semi")
    n_term = bounded(stored(n_term.where(F.col("n_t") >= support), "term-rows"))
    near = near.join(n_term, "term").where(F.col("n_t") <= F.col("most")).drop("most")
    pairs = stored(near.join(in_rows, "key").where(F.col("n_t") <= F.col("most")), "pairs")
    both = pairs.groupBy("entity", "term", "n_e", "n_t").agg(F.count("*").alias("n_et")).where(F.col("n_et") >= support)
    given = F.log2(F.lit(float(n)) * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    telling = both.where(given >= disclosure * F.log2(F.lit(float(n)) / F.col("n_e"))).select("entity", "term")
    told = pairs.join(bounded(stored(telling, "telling")), ["entity", "term"], "left_semi").select("key", "term").distinct()
    told = stored(told, "told")
    # Only rows that hold a revealing term are taken apart into places.
    some = texts.join(bounded(stored(told.select("key").distinct(), "told-rows")), "key", "left_semi")
    some = some.select(F.monotonically_increasing_id().alias("row"), "key", "text")
    placed = matches(some, {"term": TERM}, {"term": F.lit(True)}).where("kind IS NOT NULL")
    placed = placed.select("key", lower_ascii(F.col("match")).alias("term"), "start", "end")
    placed = placed.join(bounded(told), ["key", "term"], "left_semi").select("key", "start", "end").distinct()
    return rows.join(placed, "key").select("row", "doc_id", "key", "start", "end")


def scan(docs: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """A row per document: doc_id, key, n_email, n_ip, n_card, n_phone, base_spans, spans (arrays of start, end, kind; those
    of revealing terms have the kind term).

    A null or empty text has none; equal rows each get a row, and count each in the corpus; further columns don't
    matter. An empty table gives none.
    """
    found = entities(docs)
    base = found.select("row", "doc_id", "key", "kind", "start", "end")
    terms = revealing(docs, found, disclosure, support).withColumn("kind", F.lit("term"))
    span = F.struct("start", "end", "kind")
    return base.unionByName(terms).groupBy("row", "doc_id", "key").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE],
        F.collect_list(F.when(F.col("kind").isin(*BASE), span)).alias("base_spans"),
        F.collect_list(F.when(F.col("kind").isNotNull(), span)).alias("spans"),
    )


def report(docs: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """``scan`` with spans as text, and the base ones as one SHA-256."""
    return scan(docs, disclosure, support).select(
        "doc_id", *[f"n_{k}" for k in BASE], F.sha2(spans_text(KINDS, F.col("base_spans")), 256).alias("base_sha256"),
        spans_text(KINDS, F.col("spans")).alias("spans"),
    )


def sanitise(docs: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """docs with entities generalised to their kind ([EMAIL] and so on) and revealing terms removed."""
    found = scan(docs, disclosure, support).where("size(spans) > 0").dropDuplicates(["doc_id", "key"])
    mark = lambda s: F.when(s["kind"] == "term", F.lit("")).otherwise(
        F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    marked = F.transform("spans", lambda s: F.struct(s["start"], s["end"], mark(s).alias("mark")))
    spans = found.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), marked.alias("_spans"))
    return rewrite(docs, spans)
