"""Near-duplicate classes by consistent weighted sampling (operator 2).

A document is the weighted set of its five-word shingles: term frequency times an inverse document frequency. The
frequency of a shingle is taken from its words (the mean over the five) and damped to 1 .. 1 + IDF_SHARE, so
that one rare edit does not outweigh a page of common text and 0.8 keeps its meaning. Frequencies are counted over
all documents; only words in at least one of IDF_FLOOR documents, and of them the IDF_WORDS most frequent ones, weigh less
than a word met once: this is the weight's definition, and it bounds the table that is broadcast to 4 MB.

Each set is sketched by improved consistent weighted sampling (two sets agree in a sample with the probability of
their weighted Jaccard similarity), cut into bands. Equal texts are one item from the start, named by their digest and
a number: doc_ids, which may be missing or shared, play no part until the end. Items that
share a band meet in chunks of bounded size, drawn anew for each band, and are compared by a byte of each sample and by
short outlines. A chunk
gives the pairs that hold its likely classes together (to hubs, among hubs, and to the most similar ones), a few a
document and never all pairs of a large group; hubs of several chunks of one band value meet again. Each pair is
verified by the exact weighted Jaccard similarity of the two whole texts. Classes are the connected components of
the verified links, found by contraction on tables. Then all pairs of different classes that share a large band
value are compared, block against block, and the possible ones verified where they meet, so that what the chunks leave
out parts no class. That step grows with the square of the different classes that share a band value; only links
become rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.byterepeats import grouped
from barloom.llm.common import materialize, whole_texts, width
from barloom.llm.wordrepeats import _mix, rolling, word_digests

SHINGLE = 5
ROWS, BANDS = 4, 11
IDF_FLOOR = 256
IDF_SHARE = 0.25
IDF_WORDS = 1 << 18
#: Documents of one band value that meet in a task.
CHUNK = 512
#: Text that blocks of `crossing_links` hold beside that.
CHUNK_BYTES = 16 << 20
#: How often the hubs of the chunks of one band value meet again; what has not met by then does in `crossing_links`.
ROUNDS = 4
#: Estimated similarity from which a pair of a large chunk looks close, and bytes of the outline that estimates it.
HINT, OUTLINE = 0.70, 256
#: A pair is verified if neither estimate lies SIGMAS standard deviations under what a pair at the threshold would show.
SIGMAS = 3.0
#: Equal samples that this asks for at a similarity of 0.8.
LEAST = math.floor(0.8 * ROWS * BANDS - SIGMAS * math.sqrt(0.8 * 0.2 * ROWS * BANDS)) + 1
#: Documents in a chunk up to which all its close pairs are verified.
SMALL = 24
#: Characters of text that are cut into shingles at a time, which bounds what a worker holds beside its batch.
PART = 1 << 20

_tables: list[np.ndarray] = []


def _random_tables() -> list[np.ndarray]:
    """Gamma(2, 1), its inverse, log Gamma(2, 1) and uniform values, drawn once from a fixed seed by any process."""
    if not _tables:
        rng = np.random.Generator(np.random.PCG64(20240229))
        r = rng.gamma(2.0, 1.0, 1 << 16).astype(np.float32)
        _tables.extend([r, 1 / r, np.log(rng.gamma(2.0, 1.0, 1 << 16)).astype(np.float32), rng.random(1 << 16).astype(np.float32)])
    return _tables


def shingles(texts: list[str], idf: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(digests, weights, number of each text): different shingles of each text, rising within it.

    Texts of fewer than five words are one shingle of all their words; texts without words have none.
    """
    data = [t.encode() for t in texts]
    words, counts = word_digests(data)
    end = np.cumsum(counts)
    known, value = idf
    if len(known) and len(words):
        at = np.minimum(np.searchsorted(known, words), len(known) - 1)
        share = np.where(known[at] == words, value[at], 1.0)
    else:
        share = np.ones(len(words))
    h = rolling(words, SHINGLE)
    total = np.concatenate([[0.0], np.cumsum(share)])
    mean = (total[SHINGLE:] - total[:-SHINGLE]) / SHINGLE if len(h) else np.empty(0)
    at = np.flatnonzero(np.arange(len(h)) + SHINGLE <= np.repeat(end, counts)[: len(h)])
    owner = np.repeat(np.arange(len(texts)), counts)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    single = [(xxhash.xxh3_64_intdigest(words[end[k] - counts[k] : end[k]].tobytes()), share[end[k] - counts[k] : end[k]].mean(), k) for k in short]
    g = np.concatenate([h[at], np.array([s[0] for s in single], np.uint64)])
    m = np.concatenate([mean[at], np.array([s[1] for s in single], float)])
    o = np.concatenate([owner[at], np.array([s[2] for s in single], np.int64)])
    order = np.argsort(g, kind="stable")
    order = order[np.argsort(o[order], kind="stable")]
    g, m, o = g[order], m[order], o[order]
    first = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (o[1:] != o[:-1])])[: len(g)])
    tf = np.diff(np.append(first, len(g)))
    return g[first], tf * (1 + IDF_SHARE * m[first]), np.bincount(o[first], minlength=len(texts))


def parts(texts: list[str]) -> Iterator[slice]:
    """Slices of at most PART characters, or of one text."""
    start, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t) > PART:
            yield slice(start, k)
            start, size = k, 0
        size += len(t)
    if len(texts):
        yield slice(start, len(texts))


def shingle_sets(texts: list[str], idf: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(digests, weights) of each text."""
    for cut in parts(texts):
        g, w, counts = shingles(texts[cut], idf)
        end = np.cumsum(counts)
        for n, e in zip(counts, end, strict=True):
            yield g[e - n : e], w[e - n : e]


def sketches(g: np.ndarray, weight: np.ndarray, counts: np.ndarray, samples: int) -> np.ndarray:
    """One row of `samples` digests for each non-empty set."""
    r, inverse, log_c, beta = _random_tables()
    used = counts[counts > 0]
    start = np.cumsum(used) - used
    log_w = np.log(weight).astype(np.float32)
    out = np.empty((len(used), samples), np.uint64)
    for k in range(samples):
        x = _mix(g + np.uint64((0x9E3779B97F4A7C15 * (k + 1)) & 0xFFFFFFFFFFFFFFFF))
        i, j, l = (x & np.uint64(0xFFFF)).astype(np.int64), ((x >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int64), ((x >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.int64)
        b = beta[l]
        t = np.floor(log_w * inverse[i] + b)
        a = log_c[j] - r[i] * (t - b + 1)
        low = np.minimum.reduceat(a, start)
        at = np.flatnonzero(a == np.repeat(low, used))
        row = np.searchsorted(start, at, "right") - 1
        at = at[np.concatenate([[True], row[1:] != row[:-1]])]
        out[:, k] = _mix(g[at] + t[at].astype(np.int64).view(np.uint64) * np.uint64(0xD1342543DE82EF95))
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sets given as (rising digests, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / max(a[1].sum() + b[1].sum() - both, 1e-300))


def word_shares(texts: DataFrame, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(digests, idf from 0 to 1) of the most frequent words; all others have 1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, found = b["text"].tolist(), []
            for cut in parts(texts):
                words, counts = word_digests([t.encode() for t in texts[cut]])
                owner = np.repeat(np.arange(len(counts)), counts)
                order = np.argsort(words, kind="stable")  # documents stay in order within a word
                w, o = words[order], owner[order]
                w = w[np.concatenate([[True], (w[1:] != w[:-1]) | (o[1:] != o[:-1])])[: len(w)]]
                found.append(np.unique(w, return_counts=True))
            if found:
                words, place = np.unique(np.concatenate([x[0] for x in found]), return_inverse=True)
                df = np.bincount(place, np.concatenate([x[1] for x in found]), len(words)).astype(np.int64)
                yield pd.DataFrame({"word": words.view(np.int64), "df": df})

    df = texts.select("text").mapInPandas(run, "word long, df long").groupBy("word").agg(F.sum("df").alias("df"))
    rows = df.filter(F.col("df") * IDF_FLOOR >= n_docs).orderBy(F.col("df").desc(), "word").limit(IDF_WORDS).collect()
    words = np.array([r["word"] for r in rows], np.int64).view(np.uint64)
    share = np.array([max(0.0, np.log(max(n_docs, 1) / r["df"])) / np.log(IDF_FLOOR) for r in rows])
    order = np.argsort(words)
    return words[order], share[order]


def outlines(g: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """OUTLINE bytes for each non-empty set: of each bin of one hash, 8 bits of the least digest, 0 for an empty bin.

    Equal bytes among the bins that one of two sets fills estimate the plain Jaccard similarity to about 0.025.
    """
    used = counts[counts > 0]
    owner = np.repeat(np.arange(len(used)), used)
    h = _mix(g ^ np.uint64(0x5851F42D4C957F2D))
    least = np.full(len(used) * OUTLINE, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, owner * OUTLINE + (h % np.uint64(OUTLINE)).astype(np.int64), h >> np.uint64(9))
    full = least != np.iinfo(np.uint64).max
    return np.where(full, (_mix(least) % np.uint64(255)).astype(np.uint8) + 1, 0).astype(np.uint8).reshape(-1, OUTLINE)


def repetition(texts: list[str], counts: np.ndarray) -> np.ndarray:
    """Of each text with shingles, which share of its shingles stood there before, in 255ths, rounded up."""
    every = np.array([max(len(t.split()) - SHINGLE + 1, 1) for t in texts])[counts > 0]
    return np.ceil(255 * np.maximum(0, 1 - counts[counts > 0] / np.maximum(every, 1))).astype(np.uint8)


def possible(sketch: np.ndarray, k: int, others: np.ndarray, threshold: float = 0.8) -> np.ndarray:
    """Those of `others` that, by both estimates, may reach the threshold with row k.

    Of two sets with a weighted similarity t, shingles held once weighing 1 to 1 + IDF_SHARE, let r be the lesser share
    of repeated shingles. Repetition can add (1 + IDF_SHARE) * r to the similarity at most, so without it there is
    y = t - (1 + IDF_SHARE) * r, and the plain similarity is at least y / (y + (1 - y) * (1 + IDF_SHARE)).
    """
    samples = slice(OUTLINE, OUTLINE + ROWS * BANDS)
    others = others[(sketch[others, samples] == sketch[k, samples]).sum(1) >= LEAST]
    x, own = sketch[others, :OUTLINE], sketch[k, :OUTLINE]
    plain = ((x == own) & (own > 0)).sum(1) / np.maximum(((x > 0) | (own > 0)).sum(1), 1)
    y = np.maximum(threshold - (1 + IDF_SHARE) * np.minimum(sketch[others, -1], sketch[k, -1]) / 255, 0)
    least = y / (y + (1 - y) * (1 + IDF_SHARE))
    return others[plain >= least - SIGMAS * np.sqrt(least * (1 - least) / OUTLINE)]


def _alike(sketch: np.ndarray) -> np.ndarray:
    """Estimated similarities of all rows of a chunk.

    The estimate is the greater one of the plain similarity (outlines) and the weighted one (samples).
    """
    outline, sample = sketch[:, :OUTLINE], sketch[:, OUTLINE : OUTLINE + ROWS * BANDS]
    out = np.empty((len(sketch), len(sketch)), np.float32)
    full = outline > 0
    for k, (x, f, y) in enumerate(zip(outline, full, sample, strict=True)):
        out[k] = np.maximum(((outline == x) & f).sum(1) / np.maximum((full | f).sum(1), 1), (sample == y).sum(1) / (ROWS * BANDS))
    np.fill_diagonal(out, 0)
    return out


def _chunk_pairs(docs: np.ndarray, sketch: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Pairs of a chunk to verify, and the rows that stand for it when chunks of one band value meet.

    A small chunk gives all possible pairs. In a larger one, hubs are chosen one by one, each for the most
    documents that look linked to it and have no hub yet; every document is paired with its hub, hubs with each
    other, and every document with its three most similar ones: what holds each class together, a few pairs a
    document, instead of the square of the group.
    """
    pairs: set[tuple[int, int]] = set()
    n = len(docs)

    def add(i: int, others) -> None:
        for j in others:
            x, y = int(docs[i]), int(docs[j])
            if x != y:
                pairs.add((min(x, y), max(x, y)))

    if n <= SMALL:
        for k in range(n):
            add(k, possible(sketch, k, np.arange(k)))
        return sorted(pairs), np.arange(n)
    near = _alike(sketch)
    linked = near >= 0.8
    alone = ~linked.any(1)
    waiting, hubs = ~alone, []
    while waiting.any():
        k = int((linked & waiting).sum(1).argmax())
        add(k, np.flatnonzero(linked[k] & waiting))
        waiting &= ~linked[k]
        waiting[k] = False
        hubs.append(k)
    for k in hubs:
        add(k, [j for j in hubs if near[k, j] >= HINT])
    best = np.argpartition(-near, 3, axis=1)[:, :3]
    for k in range(n):
        add(k, best[k][near[k, best[k]] >= HINT])
    return sorted(pairs), np.concatenate([np.array(hubs, np.int64), np.flatnonzero(alone)])


def candidate_pairs(signed: DataFrame) -> DataFrame:
    """(a, b): pairs of documents worth verifying, from (doc_id, sketch, bands)."""
    spark = signed.sparkSession
    entries = signed.select("doc_id", F.posexplode("bands").alias("band", "value"))
    counts = entries.groupBy("band", "value").agg(F.count("*").alias("n")).filter("n > 1")
    met = entries.join(counts, ["band", "value"])
    met = met.groupBy("doc_id").agg(F.collect_list(F.struct("band", "value", "n")).alias("met"))
    members = signed.join(met, "doc_id").select("doc_id", "sketch", F.explode("met").alias("m")).select("doc_id", "sketch", "m.band", "m.value", "m.n")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def settle() -> pd.DataFrame:
            b = pd.concat(held)
            key = b[["band", "value", "chunk"]].to_numpy(np.int64)
            cut = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(1)]))
            docs = b["doc_id"].to_numpy(np.int64)
            sketch = np.frombuffer(b"".join(b["sketch"]), np.uint8).reshape(len(b), -1)
            out = []
            for s, e in zip(cut, np.append(cut[1:], len(b)), strict=True):
                pairs, leaders = _chunk_pairs(docs[s:e], sketch[s:e])
                out += [(0, x, y, None, 0, 0, 0) for x, y in pairs]
                if b["chunks"].iloc[s] > 1:
                    out += [(1, int(docs[s + k]), 0, b["sketch"].iloc[s + k], *map(int, key[s][:2]), len(leaders)) for k in leaders]
            return pd.DataFrame(out, columns=["what", "a", "b", "sketch", "band", "value", "n"])

        for b in batches:
            if not len(b):
                continue
            key = b[["band", "value", "chunk"]].to_numpy(np.int64)
            last = (key == key[-1]).all(1)
            cut = len(b) - int(last.sum())
            if held and (key[0] != held[-1][["band", "value", "chunk"]].to_numpy(np.int64)[-1]).any():
                yield settle()
                held = []
            if cut:
                held.append(b[:cut])
                yield settle()
                held = []
                b = b[cut:]
            held.append(b)
        if held:
            yield settle()

    found, depth = None, 0
    while True:
        chunks = F.ceil(F.col("n") / CHUNK)
        dealt = members.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("doc_id", "band", F.lit(depth)), F.col("chunks")))
        dealt = dealt.repartition(width(spark), "band", "value", "chunk").sortWithinPartitions("band", "value", "chunk")
        done = dealt.mapInPandas(run, "what int, a long, b long, sketch binary, band int, value long, n long")
        done = materialize(done, "pair-round")
        pairs = done.filter("what = 0").select("a", "b")
        found = pairs if found is None else found.unionByName(pairs)
        again = done.filter("what = 1")
        total = again.groupBy("band", "value").agg(F.count("*").alias("n"))
        left = total.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.max("n").alias("most")).first()
        if not left["rows"]:
            return found.distinct()
        depth += 1
        if depth > ROUNDS:
            return found.distinct()
        members = again.drop("n").join(total, ["band", "value"]).select(F.col("a").alias("doc_id"), "sketch", "band", "value", "n")


def similarities(own: tuple[np.ndarray, np.ndarray], others: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Weighted Jaccard similarity of a non-empty set to each of several non-empty ones."""
    g, w = (np.concatenate([x[k] for x in others]) for k in (0, 1))
    start = np.cumsum([0] + [len(x[0]) for x in others[:-1]])
    at = np.minimum(np.searchsorted(own[0], g), len(own[0]) - 1)
    both = np.add.reduceat(np.where(own[0][at] == g, np.minimum(w, own[1][at]), 0.0), start)
    return both / (own[1].sum() + np.add.reduceat(w, start) - both)


def crossing_links(signed: DataFrame, found: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """(a, b, similarity): all links between different classes that share a band value of more than SMALL documents.

    The documents of a band value are dealt to blocks, a class of CHUNK or more to its own ones, and every two blocks
    meet but those of one class, with the texts of both: possible pairs are verified where they meet, so that no
    pair becomes a row but a link, and a text is cut into shingles once a meeting. A block has about CHUNK documents
    or CHUNK_BYTES of text at most. A pair is compared in the first band that it shares. Smaller values have been
    compared whole by `candidate_pairs`. `signed` has digest and size beside the sketches, `texts` digest and text.
    """
    spark = signed.sparkSession
    shared = spark.sparkContext.broadcast(idf)
    known = signed.join(found, "doc_id", "left").select("doc_id", "digest", "size", F.coalesce("class_id", "doc_id").alias("class_id"), "sketch", "bands")
    entries = known.select("doc_id", "class_id", "size", F.posexplode("bands").alias("band", "value"))
    sizes = entries.groupBy("band", "value", "class_id").agg(F.count("*").alias("n"), (F.count("*") / CHUNK + F.sum("size") / CHUNK_BYTES).alias("load"))
    large = F.col("load") >= 1
    mixed = sizes.groupBy("band", "value").agg(F.sum(F.when(large, 0).otherwise(F.col("load"))).alias("rest"), F.sum("n").alias("total"), F.count("*").alias("several"))
    mixed = mixed.filter((F.col("total") > SMALL) & (F.col("several") > 1)).drop("several", "total")
    parts = F.greatest(F.lit(1), F.ceil(F.when(large, F.col("load")).otherwise(F.col("rest"))))
    dealt = materialize(sizes.join(mixed, ["band", "value"]).select("band", "value", "class_id", large.alias("own"), parts.alias("parts")), "class-sizes")
    if dealt.isEmpty():
        return spark.createDataFrame([], "a long, b long, similarity double")
    block = F.struct("own", F.when(F.col("own"), F.col("class_id")).otherwise(F.lit(0)).alias("of"), F.pmod(F.xxhash64("doc_id", "band"), "parts").alias("part"))
    placed = entries.join(dealt, ["band", "value", "class_id"]).select("doc_id", "band", "value", block.alias("block"))
    placed = materialize(placed, "blocks")
    blocks = placed.select("band", "value", "block").distinct()
    other = blocks.select("band", "value", F.col("block").alias("right"))
    meets = blocks.withColumnRenamed("block", "left").join(other, ["band", "value"]).filter("left <= right AND NOT (left.own AND right.own AND left.of = right.of)")
    meets = materialize(meets.select("band", "value", "left", "right", F.monotonically_increasing_id().alias("meet")), "meets")
    sides = meets.select("band", "value", F.col("left").alias("block"), "meet", F.lit(0).alias("side")).unionByName(meets.filter("left != right").select("band", "value", F.col("right").alias("block"), "meet", F.lit(1).alias("side")))
    spread = texts.groupBy("digest").agg(F.first("text").alias("text"))
    present = known.join(placed.select("doc_id").distinct(), "doc_id").join(spread, "digest").drop("digest", "size")
    rows = placed.join(sides, ["band", "value", "block"]).select("doc_id", "band", "meet", "side").join(present, "doc_id")
    rows = rows.repartition(width(spark), "meet").sortWithinPartitions("meet", "side")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in grouped(batches, "meet"):
            for _, b in whole.groupby("meet"):
                docs, label, side = (b[c].to_numpy(np.int64) for c in ("doc_id", "class_id", "side"))
                sketch = np.frombuffer(b"".join(b["sketch"]), np.uint8).reshape(len(b), -1)
                bands, band = np.stack(b["bands"].tolist()), int(b["band"].iloc[0])
                left, right, near = np.flatnonzero(side == 0), np.flatnonzero(side == 1), {}
                for k in left:
                    j = right if len(right) else left[left > k]
                    j = j[label[j] != label[k]]
                    j = possible(sketch, k, j[(bands[j] == bands[k]).argmax(1) == band])
                    if len(j):
                        near[k] = j
                used = np.unique(np.concatenate([np.array(list(near), np.int64), *near.values()]))
                sets = dict(zip(used, shingle_sets(b["text"].iloc[used].tolist(), shared.value), strict=True))
                links: list[tuple[int, int, float]] = []
                for k, j in near.items():
                    x = similarities(sets[k], [sets[i] for i in j])
                    links += [(min(docs[k], docs[i]), max(docs[k], docs[i]), y) for i, y in zip(j, x, strict=True) if y >= threshold - 1e-9]
                yield pd.DataFrame(links, columns=["a", "b", "similarity"]).astype({"a": "int64", "b": "int64", "similarity": "float64"})

    return rows.mapInPandas(run, "a long, b long, similarity double")


def verified(pairs: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """(a, b, similarity) of the pairs at or above the threshold, from the whole texts of both; `pairs` has the digests
    da and db beside a and b, `texts` has digest and text, copies and all."""
    spark = pairs.sparkSession
    shared = spark.sparkContext.broadcast(idf)
    spread = texts.groupBy("digest").agg(F.first("text").alias("text"))
    sizes = pairs.groupBy("a", "da").agg(F.count("*").alias("_n"))
    salts = F.greatest(F.lit(1), F.ceil(F.col("_n") / 64)).cast("int")
    members = pairs.join(sizes.drop("da"), "a").select("a", F.col("b").alias("doc_id"), F.col("db").alias("digest"), F.pmod(F.xxhash64("b"), salts).cast("int").alias("salt"))
    members = members.join(spread, "digest").select("a", "salt", F.lit(1).alias("role"), "doc_id", "text")
    leaders = sizes.select("a", F.col("da").alias("digest"), salts.alias("salts")).join(spread, "digest")
    leaders = leaders.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"), F.col("a").alias("doc_id"), "text")
    dealt = members.unionByName(leaders).repartition(width(spark), "a", "salt").sortWithinPartitions("a", "salt", "role")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        leader, own = None, None
        for whole in batches:
            rows = []
            for a, role, doc, found in zip(whole["a"], whole["role"], whole["doc_id"], shingle_sets(whole["text"].tolist(), shared.value), strict=True):
                if role == 0:
                    leader, own = a, tuple(x.copy() for x in found)
                elif leader == a:
                    x = similarity(own, found)
                    if x >= threshold - 1e-9:
                        rows.append((a, doc, x))
            yield pd.DataFrame(rows, columns=["a", "b", "similarity"]).astype({"a": "int64", "b": "int64", "similarity": "float64"})

    return dealt.mapInPandas(run, "a long, b long, similarity double")


def components(links: DataFrame) -> DataFrame:
    """(doc_id, class_id): for every document of a stored table of links (a, b) one document of its connected component.

    In a round each document takes the one with the least digest among itself and its neighbours, and links become links
    between the documents taken. Those within one vanish, so that what a round joins shrinks by a constant share, on long
    chains as well. An order of digests serves two rounds: a star, whatever its size, is gone after these.
    """
    edges, labels, depth = links.select("a", "b").filter("a != b"), None, 0
    while True:
        rank = {x: F.struct(F.xxhash64(x, F.lit(depth // 2)).alias("digest"), F.col(x).alias("of")) for x in "ab"}
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        taken = both.groupBy("a").agg(F.min(rank["b"]).alias("near")).select("a", F.least(rank["a"], "near").alias("least")).select("a", F.col("least.of").alias("to"))
        taken = materialize(taken, "taken")
        if labels is None:
            labels = taken.select(F.col("a").alias("doc_id"), F.col("to").alias("class_id"))
        else:
            further = taken.select(F.col("a").alias("class_id"), "to")
            labels = materialize(labels.join(further, "class_id", "left").select("doc_id", F.coalesce("to", "class_id").alias("class_id")), "labels")
        edges = edges.join(taken.withColumnRenamed("to", "x"), "a").join(taken.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
        edges = materialize(edges.filter("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return labels
        depth += 1


def joined_classes(found: DataFrame, crossing: DataFrame) -> DataFrame:
    """`found` (doc_id, class_id) after the links (a, b) of a stored table between its classes, or documents without one."""
    alone = crossing.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct().join(found, "doc_id", "left_anti")
    every = materialize(found.unionByName(alone.select("doc_id", F.col("doc_id").alias("class_id"))), "classes-before")
    between = crossing.select("a", "b").join(every.select(F.col("doc_id").alias("a"), F.col("class_id").alias("x")), "a").join(every.select(F.col("doc_id").alias("b"), F.col("class_id").alias("y")), "b")
    whole = components(materialize(between.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "class-links"))
    whole = whole.select(F.col("doc_id").alias("class_id"), F.col("class_id").alias("whole"))
    return every.join(whole, "class_id", "left").select("doc_id", F.coalesce("whole", "class_id").alias("class_id"))


def class_table(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """A stored table with one row for each different text: digest (its MD5), class_id, n_links, keeper (the digest of the
    text that stands for its class), keeper_id (the least doc_id of that text)."""
    spark = docs.sparkSession
    texts = whole_texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5("text")).alias("digest"), "text")
    named = texts.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max(F.octet_length("text")).alias("size"))
    named = materialize(named.withColumn("node", F.monotonically_increasing_id()), "named-texts")
    n_docs = docs.count()
    idf = word_shares(texts, n_docs)
    shared = spark.sparkContext.broadcast(idf)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            whole = whole.drop_duplicates("digest")
            for cut in parts(whole["text"].tolist()):
                b = whole.iloc[cut]
                part = b["text"].tolist()
                g, w, counts = shingles(part, shared.value)
                if not len(g):
                    continue
                s = sketches(g, w, counts, ROWS * BANDS)
                bands = np.stack([_mix(rolling_row(s[:, ROWS * k : ROWS * k + ROWS])) for k in range(BANDS)], 1).view(np.int64)
                yield pd.DataFrame({"digest": b["digest"][counts > 0], "sketch": [x.tobytes() for x in np.hstack([outlines(g, counts), s.astype(np.uint8), repetition(part, counts)[:, None]])], "bands": list(bands)})

    signed = texts.select("digest", "text").mapInPandas(sign, "digest binary, sketch binary, bands array<long>")
    signed = signed.join(named, "digest").select(F.col("node").alias("doc_id"), "digest", "size", "sketch", "bands").dropDuplicates(["doc_id"])
    signed = materialize(signed, "sketches")
    ends = [named.select(F.col("node").alias(x), F.col("digest").alias(f"d{x}")) for x in "ab"]

    pairs = materialize(candidate_pairs(signed), "pairs")
    links = materialize(verified(pairs.join(ends[0], "a").join(ends[1], "b"), texts.select("digest", "text"), idf, threshold).dropDuplicates(["a", "b"]), "links")
    found = components(links)
    crossing = materialize(crossing_links(signed, found, texts.select("digest", "text"), idf, threshold), "crossing")
    if not crossing.isEmpty():
        links = links.unionByName(crossing)
        found = joined_classes(found, crossing)
    found = found.withColumnRenamed("doc_id", "node")
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n"))
    known = named.join(found, "node", "left").join(degree, "node", "left").select("digest", "least", F.coalesce("class_id", "node").alias("class"), F.coalesce("n", F.lit(0)).alias("n_links"))
    known = materialize(known, "classes")
    order = F.struct(F.col("least").isNull().alias("none"), "least", "digest")
    keepers = materialize(known.groupBy("class").agg(F.min(order).alias("k")), "keepers")
    # stored, so that no aggregation stands before the joins and a large class or a hot text can be split
    known = known.join(keepers, "class").select("digest", F.col("k.least").alias("class_id"), "n_links", F.col("k.digest").alias("keeper"), F.col("k.least").alias("keeper_id"))
    return materialize(known, "class-table")


def classes(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id, class_id (the least doc_id of the class), n_links (of its text), a row for each row of `docs`.

    n_links counts the links that were verified: all but those inside a class that share only band values of more than
    SMALL documents, of which it holds those that were needed to find the class.

    Equal texts, NULL and empty ones included, are one class. Texts without words are like no other text. Different texts
    under one doc_id are items of their own; a NULL doc_id takes the class of its text, and a class of such rows
    alone has the class_id NULL. Texts of any length are read whole, repeated rows are one item, an empty table gives
    no rows, other columns are not read.
    """
    keyed = whole_texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5("text")).alias("digest"))
    return keyed.join(class_table(docs, threshold), "digest").select("doc_id", "class_id", "n_links")


def keepers(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The rows of `docs` that stand for their class, with all their columns: of each class one row, the text with the least
    doc_id (rows with a NULL doc_id stand only for classes that have no other)."""
    table = class_table(docs, threshold)
    kept = table.filter("digest = keeper").select("digest", "keeper_id")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").cast("long").alias("_id"), F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")))).alias("digest"))
    met = rows.join(kept, "digest").filter(F.col("_id").eqNullSafe(F.col("keeper_id")))
    return met.dropDuplicates(["digest"]).select("_row.*")


def rolling_row(x: np.ndarray) -> np.ndarray:
    """A digest of each row."""
    out = np.zeros(len(x), np.uint64)
    for k in range(x.shape[1]):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + x[:, k])
    return out
