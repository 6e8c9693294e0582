"""Ranked search for the words of items, by a bit-sliced impact index (operator 11).

1. `postings`: one scan of the documents leaves, for each, its length and the counts of the terms that the items use, and
   for each batch one row of totals, from which the statistics of the whole corpus are added up.
2. `SlicedIndex`: a block of documents becomes bitmaps. The impact of a term in a document is a whole number; slice b of a
   term holds bit b of its impacts, one document a bit. The slices of an item's terms are added like binary numbers, 64
   documents at a time, by a ripple of carries; all items of a group are added together.
3. `top`: the best documents of each item are found from the most significant slice down: a slice either has enough
   candidates with its bit set, and the others fall away, or too few, and these are in.
4. A task keeps the best of all its blocks for each item; these meet by item in two steps, so that no task reads
   more than a share of the blocks.

Items are taken by at most about SHARD_BYTES of text at a time, each share with a scan of its own: what is sent to the
workers has a bound whatever the number of items.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import materialize, numbered_texts, with_missing_ids

SHARD_BYTES = 16 << 20
#: Documents of a block of the index, and items whose sums are held at once.
BLOCK = 4096
GROUP = 128
#: Bytes of a text whose terms are counted at once.
PART = 1 << 20
#: Buckets in which the bests of all tasks meet first.
MEET = 32

_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_ONE = np.uint64(1)


def term_parts(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in order, by about PART bytes at a time."""
    raw, at = text.encode().translate(_FOLD), 0
    while at < len(raw):
        cut = raw.find(b" ", at + PART)
        end = len(raw) if cut < 0 else cut
        yield raw[at:end].split()
        at = end


def postings(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """(total, doc_id, no_id, n, term, tf): of each document with a term its number of terms and the counts of those in
    `terms`; of each batch a row with `total` set: doc_id the number of its documents, n of their terms, term and tf the
    terms met and the numbers of documents that hold them."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = shared.value.get
        for b in batches:
            rows, held = [], Counter()
            for doc_id, no_id, text in zip(b["doc_id"], b["no_id"], b["text"], strict=True):
                met: Counter = Counter()
                for part in term_parts(text):
                    met.update(map(find, part))
                n = met.total()
                met.pop(None, None)
                if n:
                    held.update(met.keys())
                    rows.append((False, doc_id, no_id, n, list(met), list(met.values())))
            rows.append((True, len(rows), False, sum(r[3] for r in rows), list(held), list(held.values())))
            yield pd.DataFrame(rows, columns=["total", "doc_id", "no_id", "n", "term", "tf"])

    return numbered_texts(docs).mapInPandas(run, "total boolean, doc_id long, no_id boolean, n long, term array<int>, tf array<long>")


class SlicedIndex:
    """Bitmaps of the impact bits of one block; `term`, `doc` and `impact` are parallel, a document at most once a term."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_docs: int):
        order = np.lexsort((doc, term))
        term, doc, impact = term[order], doc[order], impact[order].astype(np.uint64)
        self.n_docs, self.words = n_docs, -(-n_docs // 64)
        self.terms, number = np.unique(term, return_inverse=True)
        cell = number * self.words + doc // 64
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])[: len(cell)])
        bit = _ONE << (doc % 64).astype(np.uint64)
        self.slices = np.zeros((int(impact.max(initial=0)).bit_length(), len(self.terms) + 1, self.words), np.uint64)
        flat = self.slices.reshape(len(self.slices), -1)
        for b in range(len(self.slices)):
            flat[b, cell[first]] = np.bitwise_or.reduceat(np.where(impact >> np.uint64(b) & _ONE, bit, np.uint64(0)), first)

    def rows(self, terms: np.ndarray) -> np.ndarray:
        """The row of each term in a slice; that of a term which no document holds is empty."""
        if not len(self.terms):
            return np.zeros(terms.shape, np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, len(self.terms))

    def sums(self, items: np.ndarray, bits: int) -> np.ndarray:
        """(bits, items, words): slices of the scores. `items` holds a row of terms for each item, longest first, -1 beyond
        its end; no score may need more than `bits` bits."""
        total = np.zeros((bits, len(items), self.words), np.uint64)
        where = self.rows(items)
        for k in range(items.shape[1]):
            n = int((items[:, k] >= 0).sum())
            row = where[:n, k]
            if (row == len(self.terms)).all():
                continue
            carry = np.zeros((n, self.words), np.uint64)
            for b in range(bits):
                have = total[b, :n]
                if b < len(self.slices):
                    add = self.slices[b, row]
                    half = have ^ add
                    carry, total[b, :n] = (have & add) | (half & carry), half ^ carry
                else:
                    if not carry.any():
                        break
                    carry, total[b, :n] = have & carry, have ^ carry
        return total


def top(total: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, document, score) of the k greatest scores above zero of each item; equal ones by ascending document."""
    open_ = np.bitwise_or.reduce(total, axis=0) if len(total) else np.zeros(total.shape[1:], np.uint64)
    sure = np.zeros_like(open_)
    for b in reversed(range(len(total))):
        with_bit = sure | (open_ & total[b])
        n = np.bitwise_count(with_bit).sum(1, np.int64)[:, None]
        sure, open_ = np.where(n <= k, with_bit, sure), np.where(n > k, open_ & total[b], open_ & ~total[b])
    item, doc = _set_bits(sure)
    tied_item, tied_doc = _set_bits(open_)  # those still open have equal scores
    room = k - np.bincount(item, minlength=total.shape[1])
    start = np.searchsorted(tied_item, tied_item, "left")
    fits = np.arange(len(tied_item)) - start < room[tied_item]
    item, doc = np.concatenate([item, tied_item[fits]]), np.concatenate([doc, tied_doc[fits]])
    at, shift = doc // 64, (doc % 64).astype(np.uint64)
    score = np.zeros(len(item), np.int64)
    for b in range(len(total)):
        score |= (total[b, item, at] >> shift & _ONE).astype(np.int64) << b
    return item, doc, score


def _set_bits(bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    item, word = np.nonzero(bitmap)
    bits = np.unpackbits(bitmap[item, word].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, bit = np.nonzero(bits)
    return item[row], word[row] * 64 + bit


def best(hits: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of each item."""
    hits = hits.sort_values(["item", "score", "no_id", "doc_id"], ascending=[True, False, True, True], ignore_index=True)
    return hits[hits.groupby("item").cumcount() < k]


def scored(posted: DataFrame, items: list[list[int]], weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, no_id, score): the k best documents of each partition of postings for each item (a list of terms)."""
    longest = sorted(range(len(items)), key=lambda i: -len(items[i]))
    groups = []
    for g in range(0, len(longest), GROUP):
        part = longest[g : g + GROUP]
        rows = np.full((len(part), len(items[part[0]])), -1, np.int64)
        for r, i in enumerate(part):
            rows[r, : len(items[i])] = items[i]
        most = max(sum(int(weight[t]) for t in items[i]) for i in part) * 1_000_000
        groups.append((np.array(part), rows, most.bit_length()))
    shared = posted.sparkSession.sparkContext.broadcast((groups, weight))

    def search(b: pd.DataFrame) -> Iterator[pd.DataFrame]:
        groups, weight = shared.value
        b = b.sort_values(["no_id", "doc_id"], ignore_index=True)
        size = b["term"].str.len().to_numpy(np.int64)
        doc = np.repeat(np.arange(len(b)), size)
        term, tf = np.concatenate(b["term"].to_list()).astype(np.int64), np.concatenate(b["tf"].to_list()).astype(np.int64)
        m = 100 - 75 + (75 * b["n"].to_numpy(np.int64) * n_docs) // n_terms
        index = SlicedIndex(term, doc, weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])), len(b))
        ids, none = b["doc_id"].to_numpy(np.int64), b["no_id"].to_numpy(bool)
        for part, rows, bits in groups:
            item, at, score = top(index.sums(rows, bits), k)
            yield pd.DataFrame({"item": part[item], "doc_id": ids[at], "no_id": none[at], "score": score})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, kept = [], []
        for b in batches:
            for cut in range(0, len(b), BLOCK):
                held.append(b[cut : cut + BLOCK])
                if sum(map(len, held)) >= BLOCK:
                    kept = [best(pd.concat([*kept, *search(pd.concat(held))]), k)]
                    held = []
        if held:
            kept = [best(pd.concat([*kept, *search(pd.concat(held))]), k)]
        yield from kept

    return posted.filter(~F.col("total") & (F.size("term") > 0)).select("doc_id", "no_id", "n", "term", "tf").mapInPandas(run, "item int, doc_id long, no_id boolean, score long")


def shards(items: DataFrame, limit: int) -> list[DataFrame]:
    """`items` (item_id, text), distinct, cut so that none of the parts but those of one item exceeds 2 * limit bytes."""
    sized = items.withColumn("_bytes", F.octet_length("text"))
    n = max(1, -(-(sized.agg(F.sum("_bytes")).first()[0] or 0) // limit))
    while True:
        part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
        large = sized.groupBy(part.alias("part")).agg(F.sum("_bytes").alias("bytes"), F.count("*").alias("rows")).filter((F.col("bytes") > 2 * limit) & (F.col("rows") > 1))
        if n == 1 or large.isEmpty():
            return [items.filter(part == i) for i in range(n)] if n > 1 else [items]
        n *= 2


def search(docs: DataFrame, items: DataFrame, k: int = 10, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the k highest-scoring documents of each item.

    Whole texts are read, however long. NULL, empty and termless texts are no documents (they do not count towards N) and no
    items; equal scores go by ascending doc_id, a NULL doc_id last and kept. Rows that repeat a document are documents of
    their own; rows that repeat an item with its text are one item, two texts under one item_id two. Empty tables give no
    rows. Other columns of both tables are not read. The search runs when the function is called.
    """
    spark = docs.sparkSession
    named = materialize(items.select("item_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).distinct(), "search-items")
    found = None
    for part in shards(named, shard_bytes):
        rows = part.select("item_id", "text").collect()  # at most about 2 * shard_bytes of text
        terms: dict[bytes, int] = {}
        queries = [[terms.setdefault(t, len(terms)) for p in term_parts(r["text"]) for t in p] for r in rows]
        posted = materialize(postings(docs, terms), "postings")
        totals = posted.filter("total")
        n_docs, n_terms = (int(x or 0) for x in totals.agg(F.sum("doc_id"), F.sum("n")).first())
        df = totals.select(F.explode(F.arrays_zip("term", "tf")).alias("e")).groupBy(F.col("e.term").alias("term")).agg(F.sum("e.tf").alias("df"))
        df = df.select("term", F.floor(F.lit(1000) * F.log((F.lit(2.0) * n_docs + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("long").alias("w")).toPandas()
        weight = np.zeros(max(1, len(terms)), np.int64)
        weight[df["term"].to_numpy(np.int64)] = df["w"].to_numpy(np.int64)
        hits = scored(posted, queries, weight, n_docs, max(1, n_terms), k)
        order = [F.col("score").desc(), "no_id", "doc_id"]
        for keys in (["item", F.pmod(F.xxhash64("doc_id"), F.lit(MEET))], ["item"]):
            hits = hits.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item int, item_id {named.schema['item_id'].dataType.simpleString()}")
        hits = materialize(with_missing_ids(hits.join(names, "item")).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "hits")
        found = hits if found is None else found.unionByName(hits)
    return found


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE text IS NOT NULL),
asked AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY ALL),
s AS (SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM d) GROUP BY ALL),
q AS (SELECT doc_id, n, term, tf FROM p WHERE term IN (SELECT term FROM asked)),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w FROM q, s GROUP BY term, n_docs),
scored AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN q USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 10
"""
