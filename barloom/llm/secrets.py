"""Secret scans over a trigram inverted index (operator 3). DataFrame and SQL functions only.

1. Each rule's regex is parsed on the driver into a Boolean query over the trigrams that every match must hold
   (an OR of ANDs). A rule without mandatory trigrams scans every text.
2. The index is cut by document: a shard of about SHARD_DOCS documents has one posting list for each trigram that
   some query needs, so no list grows with the corpus however common its trigram. Every AND has an anchor, its
   rarest trigram, without which none of its lists is of use: a text is tested for the others only behind it.
3. Posting lists are intersected and united inside each shard; what comes out are (document, rule) candidates.
4. Candidates are verified by the regex itself on the whole text, which also gives the spans.

Texts are indexed in lower case, so one query serves rules with and without case.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import product
from re import _constants as sre
from re import _parser as sre_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm import spans
from barloom.llm.common import whole_texts

SHARD_DOCS = 4096
#: Strings that a part of a regex may stand for before it counts as unknown.
MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A match is kept if its `group` has at least `least` characters."""

    name: str
    regex: str
    group: int = 0
    least: int = 0


#: The three base kinds, in their order. A run of [0-9a-f] of 24 or more is what remains of [0-9a-f]+ once shorter
#: runs are dropped, and the same holds for AKIA keys, as neither can begin inside a longer run.
BASE = [
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
]
#: Further published token formats.
MORE = [
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
]


def trigram_query(regex: str) -> list[frozenset[str]] | None:
    """An OR of ANDs of lower-case trigrams that any text with a match satisfies; None where there is no such query."""

    def strings(node) -> set[str] | None:
        """All strings that a node can stand for, or None if they are too many."""
        op, arg = node
        if op is sre.LITERAL:
            return {chr(arg).lower()}
        if op is sre.IN:
            if any(o is sre.NEGATE or o is sre.CATEGORY for o, _ in arg):
                return None
            found: set[str] = set()
            for o, a in arg:
                if o is sre.RANGE and a[1] - a[0] >= MAX_STRINGS:
                    return None
                found |= {chr(c).lower() for c in (range(a[0], a[1] + 1) if o is sre.RANGE else [a])}
            return found if len(found) <= 8 else None
        if op is sre.SUBPATTERN:
            return joined(arg[3])
        if op is sre.BRANCH:
            parts = [joined(x) for x in arg[1]]
            return None if any(p is None for p in parts) else set().union(*parts)
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] == 1 and arg[0] == 0:
            inner = joined(arg[2])
            return None if inner is None else inner | {""}
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] == arg[1] and arg[0] <= 4:
            inner = joined(arg[2])
            return None if inner is None or len(inner) ** arg[0] > MAX_STRINGS else {"".join(p) for p in product(inner, repeat=arg[0])}
        return None

    def joined(nodes) -> set[str] | None:
        out = {""}
        for n in nodes:
            s = strings(n)
            if s is None or len(out) * len(s) > MAX_STRINGS:
                return None
            out = {a + b for a in out for b in s}
        return out

    def clauses(of: set[str]) -> list[frozenset[str]] | None:
        sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in of}
        if frozenset() in sets:
            return None
        return [s for s in sets if not any(o < s for o in sets)]

    def both(a, b):
        if a is None or b is None:
            return a if b is None else b
        if len(a) * len(b) > MAX_STRINGS:
            return a
        sets = {x | y for x in a for y in b}
        return [s for s in sets if not any(o < s for o in sets)]

    query, run = None, {""}
    for node in sre_parser.parse(regex):
        s = strings(node)
        if s is not None and len(run) * len(s) <= MAX_STRINGS:
            run = {a + b for a in run for b in s}
            continue
        query = both(query, clauses(run))
        run = s if s is not None else {""}
    query = both(query, clauses(run))
    return None if query is None else sorted(query, key=sorted)


#: Letters of running text, the common ones first; what is not among them is rarer still.
_COMMON = "etaoinshrdlcumwfgypbvkjxqz"


def anchors(queries: dict[str, list[frozenset[str]]]) -> dict[str, list[str]]:
    """anchor: the further trigrams of its ANDs. Every AND holds an anchor; one that serves several counts once."""
    waiting = [c for q in queries.values() for c in q]

    def worth(t: str) -> tuple:
        return sum(t in c for c in waiting), sum(_COMMON.find(x) % len(f"{_COMMON} ") for x in t), t

    found: dict[str, set[str]] = {}
    while waiting:
        best = max(sorted(set().union(*waiting)), key=worth)
        found[best] = set().union(*[c for c in waiting if best in c]) - {best}
        waiting = [c for c in waiting if best not in c]
    return {a: sorted(more) for a, more in found.items()}


def build_index(docs: DataFrame, queries: dict[str, list[frozenset[str]]], shard_docs: int = SHARD_DOCS) -> DataFrame:
    """(shard, postings): postings maps each trigram to the rows (doc_id, text_id) of the shard that hold it behind an
    anchor; rows are named by doc_id and a digest of the text."""
    shards = max(1, math.ceil(docs.count() / shard_docs))
    low = docs.select("doc_id", "text_id", F.lower("text").alias("_low"))
    no = F.array().cast("array<string>")

    def held(t: str) -> Column:
        return F.contains("_low", F.lit(t))

    behind = [F.when(held(a), F.array_compact(F.array(F.lit(a), *[F.when(held(t), F.lit(t)) for t in more]))).otherwise(no) for a, more in anchors(queries).items()]
    entries = low.select(F.pmod(F.xxhash64("doc_id", "text_id"), F.lit(shards)).alias("shard"), F.struct("doc_id", "text_id").alias("row"), F.explode(F.flatten(F.array(*behind))).alias("trigram"))
    lists = entries.groupBy("shard", "trigram").agg(F.collect_set("row").alias("ids"))
    return lists.groupBy("shard").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "ids"))).alias("postings"))


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(doc_id, text_id, rules): rows whose trigrams satisfy the query of at least one rule."""
    empty = F.array().cast("array<struct<doc_id:bigint,text_id:bigint>>")

    def postings(t: str) -> Column:
        return F.coalesce(F.try_element_at("postings", F.lit(t)), empty)

    def all_of(clause: frozenset[str]) -> Column:
        out = None
        for t in sorted(clause):
            out = postings(t) if out is None else F.array_intersect(out, postings(t))
        return out

    found = []
    for name, query in queries.items():
        ids = None
        for clause in query:
            ids = all_of(clause) if ids is None else F.array_union(ids, all_of(clause))
        found.append(F.struct(F.lit(name).alias("rule"), ids.alias("ids")))
    by_rule = index.select(F.explode(F.array(*found)).alias("f")).select("f.rule", F.explode("f.ids").alias("d"))
    return by_rule.groupBy("d.doc_id", "d.text_id").agg(F.collect_set("rule").alias("rules"))


def scan(docs: DataFrame, more: list[Rule] | None = None, carry: bool = False) -> DataFrame:
    """doc_id, text, base (spans of the base kinds) and spans (all), both sorted; with `carry` the input row as _row.

    NULL and empty texts have no spans, texts of any length are scanned whole, a NULL doc_id is a value like others,
    repeated rows are scanned each, an empty table gives no rows, other columns are not read.
    """
    rules = BASE + (MORE if more is None else more)
    queries = {r.name: q for r in rules if (q := trigram_query(r.regex)) is not None}
    rest = ["_row"] if carry else []
    texts = whole_texts(docs, carry).withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text_id", F.xxhash64("text"))
    found = candidates(build_index(texts.select("doc_id", "text", "text_id"), queries), queries).withColumnRenamed("doc_id", "_id").withColumnRenamed("text_id", "_text")
    d = texts.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_id") == F.col("_text")), "left").select("doc_id", "text", *rest, "rules")
    parts = []
    for k, r in enumerate(rules):
        accept = (lambda v, n=r.least: F.length(v) >= n) if r.least else None
        part = spans.find(F.col("text"), r.regex, k, accept, r.group)
        if r.name in queries:
            part = F.when(F.array_contains("rules", r.name), part).otherwise(spans.no_spans())
        parts.append(part)
    d = d.select("doc_id", "text", *rest, F.concat(*parts[: len(BASE)]).alias("_base"), F.concat(*parts[len(BASE) :]).alias("_more"))
    return d.select("doc_id", "text", *rest, F.sort_array("_base").alias("base"), F.sort_array(F.concat("_base", "_more")).alias("spans"))


def redact(scanned: DataFrame) -> Column:
    """The text with every span replaced by <KIND>."""
    kinds = F.array(*[F.lit(f"<{r.name.upper()}>") for r in BASE + MORE])
    return spans.replace(F.col("text"), F.col("spans"), lambda s: F.get(kinds, s["kind"]))


def digest(scanned: DataFrame) -> DataFrame:
    names = [r.name for r in BASE + MORE]
    return scanned.select(
        "doc_id",
        *[spans.count_of(F.col("base"), k).alias(f"n_{r.name}") for k, r in enumerate(BASE)],
        F.sha2(spans.text_of(F.col("base"), names), 256).alias("base_sha256"),
        spans.text_of(F.col("spans"), names).alias("spans"),
    )


def _oracle() -> str:
    """The same spans by one full scan for each rule."""

    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def column(k: int, r: Rule) -> str:
        p, g = quoted(r.regex), r.group
        return (
            f"list_filter(list_transform(range(1, len(regexp_extract_all(t, {p})) + 1), lambda i: {{'s': "
            f"list_sum(list_transform(string_split_regex(t, {p})[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(regexp_extract_all(t, {p})[1:i-1], lambda x: length(x))), 0), "
            f"'k': {k}, 'n': length(regexp_extract_all(t, {p})[i]), 'g': length(regexp_extract_all(t, {p}, {g})[i])}}), lambda z: z.g >= {r.least})"
        )

    columns = ",\n  ".join(f"{column(k, r)} AS c{k}" for k, r in enumerate(BASE + MORE))
    names = "[" + ", ".join(quoted(r.name) for r in BASE + MORE) + "]"
    joined = f"coalesce(array_to_string(list_transform(list_sort({{}}), lambda z: {names}[z.k + 1] || ':' || z.s::BIGINT || ':' || (z.s + z.n)::BIGINT), ','), '')"
    base = "list_concat(list_concat(c0, c1), c2)"
    every = base
    for k in range(3, len(BASE + MORE)):
        every = f"list_concat({every}, c{k})"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (SELECT doc_id,
  {columns}
FROM d)
SELECT doc_id, len(c0)::BIGINT AS n_assign, len(c1)::BIGINT AS n_access, len(c2)::BIGINT AS n_hex,
  sha256({joined.format(base)}) AS base_sha256, {joined.format(every)} AS spans FROM m
"""


ORACLE = _oracle()
