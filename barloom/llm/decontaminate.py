"""Benchmark decontamination by a BM25 index with block-max WAND (operator 1).

The index holds the test items: its terms are pairs of neighbouring words, its weights BM25 divided by the score that
the item gives itself, so a score is the share of an item's own BM25 mass that a passage holds. Every training
document is cut into overlapping passages, each at least twice as long as the longest item, and each passage is a
query that retrieves all items at or above the threshold. A passage whose term maxima cannot reach the threshold is
answered without opening a list; the others run block-max WAND. Hits are verified by the share of the
item's five-word shingles, of its question (all sentences but the last) and its answer (the last one), that the
passage holds; every retrieved passage is judged.

The index is broadcast in shards of about SHARD_BYTES of item text, one pass over the documents for each shard (so a
benchmark of n shards costs n scans). Document frequencies, mean length and passage length come from all items, so
results do not depend on the number of shards. Documents are never moved.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import materialize, numbered_texts, with_missing_ids

SHARD_BYTES = 16 << 20
K1, B = 1.2, 0.75
BLOCK = 16
SHINGLE = 5
_words = re.compile(r"[^\t-\r ]+").findall
_edges = re.compile(r"^\W+|\W+$")
_sentence = re.compile(r"(?<=[.!?])\s+")

RESULT = "item_id long, score double, question_overlap double, answer_overlap double, item_overlap double"


def normal(text: str) -> list[str]:
    return [c for w in _words(text) if (c := _edges.sub("", w).lower())]


def question_and_answer(text: str) -> tuple[int, int]:
    """(number of words of the question, of the whole item): the last sentence with a word is the answer."""
    sizes = [n for s in _sentence.split(text) if (n := len(normal(s)))]
    total = sum(sizes)
    return (total - sizes[-1] if len(sizes) > 1 else (2 * total + 2) // 3), total


def _shingles(ids: list[int]) -> set[tuple[int, ...]]:
    return _shingles_of(ids, min(SHINGLE, len(ids))) if ids else set()


def _shingles_of(ids: list[int], n: int) -> set[tuple[int, ...]]:
    return {tuple(ids[i : i + n]) for i in range(len(ids) - n + 1)}


def item_terms(words: list) -> list[tuple]:
    """Pairs of neighbours; an item of one word is the pair with no word."""
    return list(zip(words, words[1:] or [None]))


@dataclass(frozen=True)
class Statistics:
    """Of all items, whatever shard they are in: their number, total terms, words of the longest, items by term."""

    n: int
    terms: int
    longest: int
    frequency: dict[tuple[str, str | None], int]

    @staticmethod
    def of(texts: list[str]) -> Statistics:
        words = [w for t in texts if (w := normal(t))]
        frequency = Counter(t for w in words for t in set(item_terms(w)))
        return Statistics(len(words), sum(len(item_terms(w)) for w in words), max(map(len, words), default=1), frequency)


class Index:
    def __init__(self, items: list[tuple[int | None, str]], of: Statistics | None = None):
        items = sorted(((i, t) for i, t in items if t and normal(t)), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        of = of or Statistics.of([t for _, t in items])
        self.ids = [i for i, _ in items]
        self.vocabulary: dict[str, int] = {}
        words = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in normal(t)] for _, t in items]
        self.base = len(self.vocabulary) + 1
        self.parts = []
        for (_, t), w in zip(items, words, strict=True):
            q, _ = question_and_answer(t)
            self.parts.append((_shingles(w[:q]), _shingles(w[q:]), _shingles(w)))
        self.longest = of.longest
        terms: dict[int, dict[int, int]] = {}
        sizes = [max(1, len(w) - 1) for w in words]
        for k, w in enumerate(words):
            for a, b in item_terms(w):
                at = terms.setdefault(a * self.base + (self.base - 1 if b is None else b), {})
                at[k] = at.get(k, 0) + 1
        mean = of.terms / max(1, of.n)
        parts: list[list[float]] = [[] for _ in items]
        raw = {}
        known = [*self.vocabulary, None]
        for t, at in terms.items():
            held = of.frequency[known[t // self.base], known[t % self.base]]
            idf = math.log(1 + (of.n - held + 0.5) / (held + 0.5))
            raw[t] = {k: idf * f * (K1 + 1) / (f + K1 * (1 - B + B * sizes[k] / mean)) for k, f in at.items()}
            for k, x in raw[t].items():
                parts[k].append(x)
        own = list(map(math.fsum, parts))  # exact, so that no order of terms or shards shows
        self.keys = np.array(sorted(raw), np.int64)
        self.lists, self.top = [], np.zeros(len(self.keys))
        for j, t in enumerate(self.keys.tolist()):
            docs = sorted(raw[t])
            weights = [raw[t][k] / own[k] for k in docs]
            blocks: dict[int, float] = {}
            for k, x in zip(docs, weights, strict=True):
                blocks[k // BLOCK] = max(blocks.get(k // BLOCK, 0.0), x)
            self.lists.append((docs, weights, blocks))
            self.top[j] = max(weights)

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All (item, score) with a score of at least `threshold`: block-max WAND, document at a time."""
        end = len(self.ids)
        cursors = [[self.lists[t][0][0], 0, float(self.top[t]), *self.lists[t]] for t in terms]
        found, reach = [], threshold - 1e-9
        while cursors:
            cursors.sort(key=lambda c: c[0])
            total, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                total += c[2]
                if total >= reach:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block = item // BLOCK
            if sum(c[5].get(block, 0.0) for c in cursors[: pivot + 1]) < reach:
                aim = (block + 1) * BLOCK  # no item of this block up to the next list's place can reach it
                if pivot + 1 < len(cursors):
                    aim = min(aim, cursors[pivot + 1][0])
                moved = cursors[: pivot + 1]
            elif cursors[0][0] == item:
                score = math.fsum(c[4][c[1]] for c in cursors[: pivot + 1])
                if score >= reach:
                    found.append((item, score))
                aim, moved = item + 1, cursors[: pivot + 1]
            else:
                aim, moved = item, [c for c in cursors[:pivot] if c[0] < item]
            for c in moved:
                c[1] = bisect_left(c[3], aim, c[1])
                c[0] = c[3][c[1]] if c[1] < len(c[3]) else end
            cursors = [c for c in cursors if c[0] < end]
        return found


class Prober:
    def __init__(self, index: Index, threshold: float):
        self.index, self.threshold, self.known = index, threshold, {}
        self.passage = 2 * max(index.longest, 32)

    def _word(self, word: str) -> int:
        """The word's number; -1 for one that no item holds, -2 for what is no word."""
        core = _edges.sub("", word).lower()
        return self.index.vocabulary.get(core, -1) if core else -2

    def probe(self, texts: list[str]) -> Iterator[tuple[int, int, float, float, float, float]]:
        """(row, item, score, question, answer, item overlap) of all retrieved pairs: of each, the passage whose least
        overlap is the greatest, so that a pair with any passage over a limit shows it."""
        known, index = self.known, self.index
        if not len(index.ids):
            return
        if len(known) > 700_000:
            known.clear()
        parts = []
        for t in texts:
            ws = _words(t)
            for w in ws:
                if w not in known:
                    known[w] = self._word(w)
            x = np.fromiter(map(known.__getitem__, ws), np.int64, len(ws))
            parts.append(x[x > -2])
        lengths = np.array([len(x) for x in parts], np.int64)
        ends = np.cumsum(lengths)
        x = np.concatenate([*parts, np.empty(0, np.int64)])
        if not len(x):
            return
        nxt = np.append(x[1:], -1)
        nxt[ends[lengths > 0] - 1] = -1
        pair = np.flatnonzero((x >= 0) & (nxt >= 0))
        key = x[pair] * index.base + nxt[pair]
        single = np.flatnonzero(x >= 0)
        lone = x[single] * index.base + index.base - 1
        at, key = np.concatenate([pair, single]), np.concatenate([key, lone])
        j = np.minimum(np.searchsorted(index.keys, key), len(index.keys) - 1)
        hit = index.keys[j] == key
        at, term = at[hit], j[hit]
        order = np.argsort(at, kind="stable")
        at, term = at[order], term[order]
        bound = np.concatenate([[0.0], np.cumsum(index.top[term])])
        stride = self.passage // 2
        count = np.where(lengths > 0, np.maximum(1, -(-(lengths - stride) // stride)), 0)
        row = np.repeat(np.arange(len(texts)), count)
        begin = (ends - lengths)[row] + stride * (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count))
        stop = np.minimum(begin + self.passage, ends[row])
        lo, hi = np.searchsorted(at, begin), np.searchsorted(at, stop)
        best: dict[tuple[int, int], tuple] = {}
        for k in np.flatnonzero(bound[hi] - bound[lo] >= self.threshold - 1e-9):
            terms = np.unique(term[lo[k] : hi[k]])
            if index.top[terms].sum() < self.threshold - 1e-9:
                continue
            got = index.search(terms.tolist(), self.threshold)
            if not got:
                continue
            ids = x[begin[k] : stop[k]].tolist()
            held: dict[int, set] = {}

            def share(part: set, ids=ids, held=held) -> float:
                if not part:
                    return 1.0
                n = len(next(iter(part)))
                if n not in held:
                    held[n] = _shingles_of(ids, n)
                return len(part & held[n]) / len(part)

            for item, s in got:
                q, a, whole = map(share, index.parts[item])
                old = best.get((int(row[k]), item))
                if old is None or (min(q, a, whole), q + a, s) > (min(old[3:]), old[3] + old[4], old[2]):
                    best[int(row[k]), item] = (int(row[k]), item, s, q, a, whole)
        yield from best.values()


def shards_of(benchmark: DataFrame, shard_bytes: int) -> Iterator[tuple[list[tuple[int | None, str]], Statistics]]:
    """The test items in lists of about `shard_bytes` of text, one list at a time, each with the statistics of all items
    (of the terms, those that it holds)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL").dropDuplicates()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = Statistics.of(b["text"].tolist())
            rows = [("", s.n, s.terms, s.longest), *((" ".join(w or "" for w in t), n, 0, 0) for t, n in s.frequency.items())]
            yield pd.DataFrame(rows, columns=["term", "n", "terms", "longest"])

    def counted(of: DataFrame) -> DataFrame:
        return of.select("text").mapInPandas(count, "term string, n long, terms long, longest long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("terms").alias("terms"), F.max("longest").alias("longest"))

    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / shard_bytes))
    every = counted(items)
    every = materialize(every, "item-terms") if n > 1 else every
    for k in range(n):
        shard = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        rows = every.join(counted(shard).select("term"), "term", "left_semi") if n > 1 else every
        found, size, terms, longest = {}, 0, 0, 1
        for r in rows.toLocalIterator():
            if r["term"]:
                a, b = r["term"].split(" ")
                found[a, b or None] = r["n"]
            else:
                size, terms, longest = r["n"], r["terms"], r["longest"]
        yield [(r["item_id"], r["text"]) for r in shard.toLocalIterator()], Statistics(size, terms, longest, found)


def overlaps(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, carry: bool = False, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """All (document, item) pairs with a passage that scores `threshold` or more, and the overlaps of the passage whose
    least overlap is the greatest, not yet judged. With `carry` also text_md5, which names the text of the document.

    NULL and empty texts, and items without a word, match nothing, so empty tables give no rows; texts of any length are
    read whole, passage by passage; equal items count once, an item_id with several texts may give several rows; a
    NULL doc_id or item_id is kept as it is; repeated documents give a row each; other columns are not read.
    """
    spark, out = docs.sparkSession, None
    texts = numbered_texts(docs)
    names = ["doc_id", "no_id", *(["text_md5"] if carry else [])]
    if carry:
        texts = texts.withColumn("text_md5", F.md5("text"))
    schema = "doc_id long, no_id boolean, " + ("text_md5 string, " if carry else "") + RESULT
    for items, of in shards_of(benchmark, shard_bytes):
        shared = spark.sparkContext.broadcast(Index(items, of))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            prober = Prober(shared.value, threshold)
            for whole in batches:
                for at in range(0, len(whole), 1000):
                    b = whole.iloc[at : at + 1000]
                    rows = list(prober.probe(b["text"].tolist()))
                    found = b[names].iloc[[r[0] for r in rows]].reset_index(drop=True)
                    found["item_id"] = pd.array([prober.index.ids[r[1]] for r in rows], "Int64")
                    for k, c in enumerate(("score", "question_overlap", "answer_overlap", "item_overlap"), 2):
                        found[c] = np.array([r[k] for r in rows], float)
                    yield found

        part = texts.mapInPandas(run, schema)
        out = part if out is None else out.unionByName(part)
    return with_missing_ids(out)


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, similar: float = 0.8, carry: bool = False, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The verified pairs: a passage holds at least `similar` of the shingles of the question, of the answer and of the item."""
    ok = (F.col("question_overlap") >= similar) & (F.col("answer_overlap") >= similar) & (F.col("item_overlap") >= similar)
    return overlaps(docs, benchmark, threshold, carry, shard_bytes).filter(ok)
