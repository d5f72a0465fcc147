"""Secret scans: keys and passwords by pattern, and parts of credentials linked within a scope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored
from tidemark.llm.text import matches, rewrite, spans_text

#: Code points within which parts of one credential stand.
SCOPE = 300

ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
#: What names an identifier, and what stands between it and its value.
NAMED = r"""(?i:user_?name|user|login|account|client_?id|key_?id)["']?\x20*[:=]"""
PATTERNS = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}+",
    "login": NAMED + r"""\x20*["']?[A-Za-z0-9._@-]+""",
    "endpoint": r"""(?i:https?|ftps?|s3|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]+""",
    "weak": r"[A-Za-z0-9+/_-]{24,}+",
}
BASE = ("assign", "access", "hex")
KINDS = list(PATTERNS)
#: What a part is of a credential.
ROLES = {
    "assign": "secret", "hex": "secret", "weak": "secret", "access": "identifier", "login": "identifier",
    "endpoint": "endpoint",
}


def _may() -> dict[str, Column]:
    text = F.col("text")
    return {
        "assign": text.rlike(r"(?i)(?:passw|secret|token|api_?key)"),
        "access": text.contains("AKIA"),
        "hex": text.rlike(PATTERNS["hex"]),
        "login": text.rlike(NAMED),
        "endpoint": text.contains("://"),
        "weak": text.rlike(PATTERNS["weak"]),
    }


def _stands() -> Column:
    """Whether a match is long enough, and for a weak one, mixed enough to be a key."""
    m, size = F.col("match"), F.char_length("match")
    mixed = (
        m.rlike("[0-9]") & m.rlike("[A-Za-z]") & m.rlike("[^0-9a-f]") & ~m.startswith("AKIA")
        & (F.size(F.array_distinct(F.split(m, ""))) >= 12)
    )
    value = F.char_length(F.regexp_extract(m, "^" + ASSIGN, 1))
    return (
        F.col("kind").isNull() | F.col("kind").isin("hex", "endpoint", "login")
        | ((F.col("kind") == "assign") & (value >= 6))
        | ((F.col("kind") == "access") & (size >= 20))
        | ((F.col("kind") == "weak") & mixed)
    )


def parts(docs: DataFrame) -> DataFrame:
    """All parts of credentials in docs (doc_id, text), strong and weak, as a stored table: row, doc_id, key, kind,
    start, end. Each row of docs has one row more, with kind null."""
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("doc_id", "text").alias("key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    found = matches(numbered, PATTERNS, _may()).where(_stands())
    return stored(found.select("row", "doc_id", "key", "kind", "start", "end"), "secret-parts")


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts (login, endpoint, weak) that have their complement within ``scope``: a weak secret an identifier, an
    identifier a secret, an endpoint both. Same columns as ``parts``.

    An interval join: a weak part stands in every block of ``scope`` code points that its span touches, another in every
    block that its span, ``scope`` longer at both ends, touches. A pair counts in the first block they share. Within a
    block stand few parts, and a part's blocks grow with its length, so pairs stay linear in the text.
    """
    role = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    placed = found.where("kind IS NOT NULL")

    def spread(lo: Column, hi: Column) -> list[Column]:
        first, last = F.floor(lo / scope), F.floor(hi / scope)
        return [first.alias("first"), F.explode(F.sequence(first, last)).alias("block")]

    weak = placed.where(~F.col("kind").isin(*BASE)).select("*", *spread(F.col("start"), F.col("end")))
    others = placed.select(
        "row", *spread(F.col("start") - scope, F.col("end") + scope),
        F.col("start").alias("s2"), F.col("end").alias("e2"), role[F.col("kind")].alias("other"),
    ).withColumnRenamed("first", "first2")
    near = (F.col("s2") - F.col("end") <= scope) & (F.col("start") - F.col("e2") <= scope)
    apart = (F.col("s2") >= F.col("end")) | (F.col("e2") <= F.col("start"))
    once = F.col("block") == F.greatest("first", "first2")
    met = weak.join(others, ["row", "block"]).where(once & near & apart).groupBy(
        "row", "doc_id", "key", "kind", "start", "end"
    ).agg(F.max(F.expr("other = 'secret'")).alias("secret"), F.max(F.expr("other = 'identifier'")).alias("identifier"))
    own = role[F.col("kind")]
    return met.where(
        ((own == "secret") & F.col("identifier")) | ((own == "identifier") & F.col("secret"))
        | ((own == "endpoint") & F.col("identifier") & F.col("secret"))
    ).drop("secret", "identifier")


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """A row per document: doc_id, key, n_assign, n_access, n_hex, base_spans and spans (arrays of start, end, kind).

    A null or empty text has none; equal rows each get a row; further columns of docs don't matter. Texts are scanned
    whole, once.
    """
    found = parts(docs)
    kept = found.where(F.col("kind").isNull() | F.col("kind").isin(*BASE)).unionByName(linked(found, scope))
    is_base = F.col("kind").isin(*BASE)
    span = F.struct("start", "end", "kind")
    return kept.groupBy("row", "doc_id", "key").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE],
        F.collect_list(F.when(is_base, span)).alias("base_spans"),
        F.collect_list(F.when(F.col("kind").isNotNull(), span)).alias("spans"),
    )


def report(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``scan`` with spans as text, and the base ones as one SHA-256."""
    return scan(docs, scope).select(
        "doc_id", *[f"n_{k}" for k in BASE], F.sha2(spans_text(KINDS, F.col("base_spans")), 256).alias("base_sha256"),
        spans_text(KINDS, F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """docs with every found span replaced by [SECRET], and n_chars set anew where it is a column."""
    found = scan(docs, scope).where("size(spans) > 0").dropDuplicates(["doc_id", "key"])
    marked = F.transform("spans", lambda s: F.struct(s["start"], s["end"], F.lit("[SECRET]").alias("mark")))
    spans = found.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), marked.alias("_spans"))
    return rewrite(docs, spans)
