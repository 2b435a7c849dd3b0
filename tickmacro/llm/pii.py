"""Personal data: fixed forms, and terms that the corpus shows to give them away."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmacro.llm.common import masked, matches, packed, spans_text, staged

#: The forms of personal data. Possessive runs and the bounds at their
#: start change no match, and a run of too few digits has no longer one inside it; they
#: keep long texts linear and the stack flat.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
RANKS = {"email": 0, "ip": 1, "card": 2, "phone": 3, "generalise": 4, "remove": 5}
MARKS = {"generalise": "[term]", "remove": ""}
#: A term is a run of letters; those nearest to an entity on either side count.
TERM = r"[\p{L}\p{M}]{2,}"
EDGE = r"[\p{L}\p{M}]"
NEAR_CHARS, NEAR_TERMS = 120, 5


@dataclass(frozen=True)
class Disclosure:
    """When a term gives an entity away.

    ``support``: in that many different contexts of the entity, at least. A term is
    generalised if the chance to meet the entity in a document that has the term is
    ``generalise`` or more, removed from ``remove`` on, provided that the term tells
    ``bits`` more about it than no term at all.
    """

    support: int = 3
    generalise: float = 0.5
    remove: float = 0.9
    bits: float = 1.0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, d: Column, i: Column) -> Column:
        twice = d * 2
        return total + F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    numbered = F.transform(
        F.split(F.reverse(digits), ""), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i"))
    )
    return F.aggregate(numbered, F.lit(0), lambda acc, x: add(acc, x["d"], x["i"])) % 10 == 0


def base_spans(text: Column) -> Column:
    """Spans of the fixed forms, failing matches dropped."""
    within = lambda value, low, high: F.length(_digits(value)).between(low, high)
    ip = F.filter(matches(text, "ip", IP), lambda s: s["value"].rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"))
    card = F.filter(
        matches(text, "card", CARD),
        lambda s: F.when(within(s["value"], 14, 19), _luhn(_digits(s["value"]))).otherwise(False),
    )
    phone = F.filter(matches(text, "phone", PHONE), lambda s: within(s["value"], 10, 15))
    return F.concat(matches(text, "email", EMAIL), ip, card, phone)


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` as (row, rid, text, base), staged; a null text is empty."""
    rows = packed(
        docs,
        keep or docs.columns,
        rid=F.monotonically_increasing_id(),
        text=F.coalesce(docs[f"`{text}`"].cast("string"), F.lit("")),
    )
    return staged(rows.withColumn("base", base_spans(F.col("text"))), "pii")


def contexts(scanned: DataFrame) -> DataFrame:
    """(rid, entity, context, term): terms beside each mention of an entity."""
    start = (F.col("s.start") - NEAR_CHARS).cast("int")
    left = F.substring("text", F.greatest(start, F.lit(0)) + 1, F.least(F.col("s.start").cast("int"), F.lit(NEAR_CHARS)))
    right = F.substring("text", F.col("s.end").cast("int") + 1, F.lit(NEAR_CHARS))
    # A word that the cut may have split is no term.
    left = F.when(start > 0, F.regexp_replace(left, rf"^{EDGE}+", "")).otherwise(left)
    right = F.when(F.length(right) == NEAR_CHARS, F.regexp_replace(right, rf"{EDGE}+$", "")).otherwise(right)
    terms = lambda part: F.regexp_extract_all(F.lower(part), F.lit(TERM), F.lit(0))
    mentions = scanned.where(F.size("base") > 0).select("rid", "text", F.explode("base").alias("s"))
    value = F.when(F.col("s.kind") == "email", F.lower("s.value")).otherwise(_digits(F.col("s.value")))
    sides = mentions.select(
        "rid",
        F.concat_ws(":", "s.kind", value).alias("entity"),
        terms(left).alias("l"),
        F.slice(terms(right), 1, NEAR_TERMS).alias("r"),
    )
    sides = sides.withColumn("l", F.slice("l", F.greatest(F.size("l") - NEAR_TERMS + 1, F.lit(1)), NEAR_TERMS))
    near = F.concat("l", F.array(F.lit("|")), "r")
    sides = sides.select("rid", "entity", F.xxhash64(near).alias("context"), F.array_union("l", "r").alias("terms"))
    return sides.select("rid", "entity", "context", F.explode("terms").alias("term"))


def _terms_of(scanned: DataFrame) -> DataFrame:
    """(rid, term): each term of a text once."""
    found = F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0))
    return scanned.select("rid", F.explode(F.array_distinct(found)).alias("term"))


def disclosing(scanned: DataFrame, limits: Disclosure = Disclosure()) -> DataFrame:
    """(term, kind): terms that give an entity away, to be generalised or removed.

    From co-occurrence over the corpus: of the documents with a term, the share that
    has it beside the entity, and its ratio to the share of all documents that
    mention the entity. Contexts count once however often they were copied. Document
    counts are taken for terms with enough support only, from all documents.
    """
    near = contexts(scanned)
    distinct = near.select("entity", "term", "context").distinct()
    pairs = distinct.groupBy("entity", "term").agg(F.count("*").alias("support"))
    pairs = pairs.where(F.col("support") >= limits.support).select("entity", "term")
    both = near.join(pairs, ["entity", "term"]).select("entity", "term", "rid").distinct()
    both = both.groupBy("entity", "term").agg(F.count("*").alias("n_both"))
    # A term has no fewer documents than those where it stands beside an entity, so
    # common words go before any text is read again.
    beside = near.select("term", "rid").distinct().groupBy("term").agg(F.count("*").alias("n_beside"))
    both = both.join(beside, "term").where(F.col("n_both") >= F.col("n_beside") * limits.generalise)
    pairs = both = staged(both.select("entity", "term", "n_both"), "pairs")
    entities = near.select("entity", "rid").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    terms = staged(pairs.select("term").distinct(), "terms")
    holders = _terms_of(scanned).join(terms, "term").groupBy("term").agg(F.count("*").alias("n_term"))
    rated = both.join(holders, "term").join(entities, "entity")
    rated = rated.withColumn("n", scanned.select(F.count("*")).scalar())
    chance = F.col("n_both") / F.col("n_term")
    bits = F.log2(chance / (F.col("n_entity") / F.col("n")))
    rated = rated.where(bits >= limits.bits).groupBy("term").agg(F.max(chance).alias("chance"))
    kind = F.when(F.col("chance") >= limits.remove, "remove").when(F.col("chance") >= limits.generalise, "generalise")
    return staged(rated.select("term", kind.alias("kind")).where("kind is not null"), "disclosing")


def find_personal_data(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, limits: Disclosure = Disclosure()
) -> DataFrame:
    """(row, text, base, spans): spans of the fixed forms, and with them every occurrence
    of a term that gives an entity away, wherever it stands outside of them.

    Repeated rows are judged alike, each by itself. A corpus without entities, or with
    none in enough contexts, has no such terms.
    """
    scanned = scan(docs, text, keep)
    flagged = disclosing(scanned, limits)
    held = _terms_of(scanned).join(flagged, "term").groupBy("rid", "kind").agg(
        F.array_join(F.array_sort(F.collect_set("term")), "|").alias("terms")
    )
    pick = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("terms"))).alias(kind)
    held = staged(held.groupBy("rid").agg(pick("generalise"), pick("remove")), "held")
    rows = scanned.join(held, "rid", "left")
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,value:string>>")

    def found(kind: str) -> Column:
        pattern = F.concat(F.lit(rf"(?iu)(?<!{EDGE})(?:"), F.col(kind), F.lit(rf")(?!{EDGE})"))
        return F.when(F.col(kind).isNotNull(), matches(F.col("text"), kind, pattern)).otherwise(none)

    terms = F.concat(found("generalise"), found("remove"))
    free = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return rows.select("row", "text", "base", F.concat("base", F.filter(terms, free)).alias("spans"))


def sanitise(docs: DataFrame, text: str = "text", limits: Disclosure = Disclosure()) -> DataFrame:
    """``docs`` with personal data replaced by its kind in brackets, terms that give it
    away by ``[term]`` or nothing."""
    found = find_personal_data(docs, text, limits=limits)
    clean = F.when(F.size("spans") > 0, masked(F.col("text"), F.col("spans"), MARKS)).otherwise(F.col("text"))
    columns = [clean.alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns]
    return found.select(*columns)


def digest(spans: Column) -> Column:
    return spans_text(spans, RANKS)
