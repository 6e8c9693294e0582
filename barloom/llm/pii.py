"""Personal data and the terms that disclose it (operator 4). DataFrame and SQL functions only.

Entities are the values of the pattern kinds (e-mail, IP address, card, phone). Terms are words of TERM_LETTERS letters
or more; the CONTEXT terms before an entity and those after it, however far away, stand near it. Over the whole corpus, n(t) documents hold term t, n(e) hold entity e
and n(t, e) hold t near e. A term discloses an entity if seeing it makes the entity likely, P(e | t) =
n(t, e) / n(t) at REVEAL or more, if that is information, log2(P(e | t) / P(e)) at BITS or more, and if
SUPPORT documents show it. In texts that hold the entity (a term alone, elsewhere, protects nobody and stays), every
occurrence of such a term is a further span: it is removed where P(e | t) is at REMOVE or more and generalised to its first letter below.

Counts are aggregated before each exchange, so an entity or a term that a third of all rows share is one row of a map
task; nothing is collected. Spans follow from the text alone: they are found once, stored under the text's digest and
joined to all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm import spans
from barloom.llm.common import keep_where, materialize, whole_texts

KINDS = ["email", "ip", "card", "phone"]
REMOVED, GENERALISED = 4, 5
NAMES = [*KINDS, "removed", "generalised"]

CONTEXT, TERM_LETTERS = 8, 4
SUPPORT, REVEAL, REMOVE, BITS = 3, 0.5, 0.9, 4.0

#: The base patterns. Where a class could be entered in the middle of a run, a look-behind (or the end of the last match,
#: \G) keeps matching linear; possessive repeats end patterns that nothing follows, so they match the same texts.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
LETTERS = r"\p{L}"


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _small_parts(v: Column) -> Column:
    parts = F.transform(F.split(v, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(999)) <= 255))


def _luhn(v: Column) -> Column:
    d = F.filter(F.split(F.reverse(_digits(v)), ""), lambda c: c != "")

    def worth(c: Column, i: Column) -> Column:
        x = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(x > 9, x - 9).otherwise(x)

    total = F.aggregate(F.transform(d, worth), F.lit(0), lambda a, x: a + x)
    n = F.length(_digits(v))
    return F.when((n >= 12) & (n <= 19), total % 10 == 0).otherwise(F.lit(False))


def _phone_digits(v: Column) -> Column:
    return F.length(_digits(v)).between(9, 15)


def base_spans(text: Column) -> Column:
    found = [
        spans.find(text, EMAIL, 0),
        spans.find(text, IP, 1, _small_parts),
        spans.find(text, CARD, 2, _luhn),
        spans.find(text, PHONE, 3, _phone_digits),
    ]
    return F.sort_array(F.concat(*found))


def _entity(s: Column) -> Column:
    """The kind and the normal form of a value."""
    return F.concat(s["kind"].cast("string"), F.lit(":"), F.when(s["kind"] >= 1, F.regexp_replace(s["value"], "[^0-9.]", "")).otherwise(F.lower(s["value"])))


def _folded(word: Column) -> Column:
    """A word in lower case, letter by letter: of the one letter whose lower case is two code points, the first of them."""
    return F.lower(F.translate(word, "\u0130", "i"))


def _terms(text: Column) -> Column:
    """The terms of a text. Words are cut before letters change their case, as in `contexts`."""
    return F.transform(F.filter(F.split(text, rf"[^{LETTERS}]+"), lambda w: F.length(w) >= TERM_LETTERS), _folded)


def contexts(found: DataFrame) -> DataFrame:
    """Each row's different pairs, entity and term joined by a line feed, from (text, base).

    Terms, and the two ends of each entity, are sorted by place once. The place of an end in that order, less the ends
    before it, is the number of terms before it: no search through the text for each entity.
    """
    ends = F.flatten(F.transform("base", lambda s: F.array(*[F.struct(s[side].alias("at"), F.lit(0).alias("term"), _entity(s).alias("entity"), F.lit(side).alias("side")) for side in ("start", "end")])))

    def pairs(terms: Column) -> Column:
        places = F.transform(terms, lambda t: F.struct(t["start"].alias("at"), F.lit(1).alias("term"), F.lit("").alias("entity"), F.lit("").alias("side")))
        order = F.transform(F.sort_array(F.concat(ends, places)), lambda x, i: F.struct(x["term"].alias("term"), x["entity"].alias("entity"), x["side"].alias("side"), i.alias("i")))

        def near(x: Column, k: Column) -> Column:
            n, before = x["i"] - k, x["side"] == "start"
            first, size = F.when(before, F.greatest(n - CONTEXT, F.lit(0))).otherwise(n), F.when(before, F.least(n, F.lit(CONTEXT))).otherwise(CONTEXT)
            return F.transform(F.slice(terms, first + 1, size), lambda t: F.concat(x["entity"], F.lit("\n"), _folded(t["value"])))

        return F.flatten(F.transform(F.filter(order, lambda x: x["term"] == 0), near))

    terms = F.sort_array(spans.find(F.col("text"), rf"{LETTERS}{{{TERM_LETTERS},}}", 0))
    return found.select(F.array_distinct(spans.let(terms, pairs)).alias("pairs"))


def disclosing_terms(found: DataFrame, docs: DataFrame) -> DataFrame:
    """(entity, term, reveal, bits) at or over the thresholds; `found`: documents with entities, `docs`: all."""
    near = contexts(found).select(F.explode("pairs").alias("p")).groupBy("p").agg(F.count("*").alias("n_near")).filter(F.col("n_near") >= SUPPORT)
    near = materialize(near.select(F.substring_index("p", "\n", 1).alias("entity"), F.substring_index("p", "\n", -1).alias("term"), "n_near"), "disclosure")
    holders = found.select(F.explode(F.array_distinct(F.transform("base", _entity))).alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    words = docs.select(F.explode(F.array_distinct(_terms(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    scored = near.join(holders, "entity").join(words, "term").withColumn("_docs", F.lit(docs.count()))
    reveal = F.col("n_near") / F.col("n_term")
    bits = F.log2(reveal * F.col("_docs") / F.col("n_entity"))
    return scored.select("entity", "term", reveal.alias("reveal"), bits.alias("bits")).filter((F.col("reveal") >= REVEAL) & (F.col("bits") >= BITS))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, text, base (spans of the pattern kinds) and spans (with those of disclosing terms), both sorted.

    NULL and empty texts have no spans, texts of any length are scanned whole, repeated rows each have the spans of
    their text (and count as documents), an empty table gives no rows, other columns are not read. Rows of one
    doc_id, or without one, are judged by their own texts.
    """
    texts = whole_texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.unhex(F.md5("text")).alias("_digest"))
    based = texts.select("_digest", "text", base_spans(F.col("text")).alias("base"))
    found = materialize(keep_where(based, F.size("base") > 0), "entities")
    disclosed = disclosing_terms(found, texts)
    held = found.select("_digest", F.explode(F.array_distinct(F.transform("base", _entity))).alias("entity")).distinct()
    terms_of = held.join(disclosed, "entity").groupBy("_digest", "term").agg(F.max("reveal").alias("reveal"))
    strong = F.col("reveal") >= REMOVE

    def listed(which: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_list(F.when(which, F.col("term")))), "|")

    terms_of = terms_of.groupBy("_digest").agg(listed(strong).alias("_remove"), listed(~strong).alias("_soften"))
    different = found.groupBy("_digest").agg(F.first("text").alias("text"), F.first("base").alias("base"))

    def terms(words: str, kind: int) -> Column:
        pattern = F.concat(F.lit(rf"(?iu)(?<!{LETTERS})(?:"), F.col(words), F.lit(rf")(?!{LETTERS})"))
        return F.when(F.length(words) > 0, spans.find(F.col("_rest"), pattern, kind)).otherwise(spans.no_spans())

    # terms are looked for beside the entities: those are blanked out, each place stays where it is
    rest = spans.replace(F.col("text"), F.col("base"), lambda s: F.repeat(F.lit("\n"), s["end"] - s["start"]))
    marked = different.join(terms_of, "_digest", "left").withColumn("_rest", F.when(F.col("_remove").isNotNull(), rest))
    free = F.concat(terms("_remove", REMOVED), terms("_soften", GENERALISED))
    # stored, so that no aggregation stands before the join and the rows of a hot text can be split
    marked = materialize(marked.select("_digest", "base", F.sort_array(F.concat("base", free)).alias("spans")), "spans")
    out = texts.join(marked, "_digest", "left")
    return out.select("doc_id", "text", *[F.coalesce(c, spans.no_spans()).alias(c) for c in ("base", "spans")])


def sanitised(scanned: DataFrame) -> Column:
    """The text with entities as <KIND>, disclosing terms removed, or generalised to their first letter and a dot."""
    kinds = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS], F.lit("<TERM>"))
    return spans.replace(F.col("text"), F.col("spans"), lambda s: F.when(s["kind"] == GENERALISED, F.concat(F.substring(s["value"], 1, 1), F.lit("."))).otherwise(F.get(kinds, s["kind"])))


def digest(scanned: DataFrame) -> DataFrame:
    return scanned.select(
        "doc_id",
        *[spans.count_of(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(spans.text_of(F.col("base"), NAMES), 256).alias("base_sha256"),
        spans.text_of(F.col("spans"), NAMES).alias("spans"),
    )
