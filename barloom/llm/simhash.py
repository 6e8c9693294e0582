"""SimHash near-duplicates by a hierarchical index in Gray order (operator 13).

1. `fingerprints`: each text's 3-word shingles are hashed, and the majority of each bit makes 64 bits.
2. `routes`: of three parts of the 64 bits, two fingerprints that differ in at most two bits share at least one. Each
   different fingerprint goes to the group of each of its parts. A group of more than LIMIT fingerprints is dealt again,
   by the parts of the bits that its members do not share yet; after four such steps a group has few free bits left, so
   that no group, however common its part, grows with the input.
3. `near_pairs`: the members of a group, sorted by Gray rank, are the leaves of a tree. Neighbours in Gray order share most
   bits; a node holds, as a masked pattern, the bits that all below it share beyond those of its parent. A search
   adds the differences along the path from the root and leaves a whole group as soon as they exceed the radius.
4. `stars`: a group hands on one link for each member that is linked, to the least of its component, not all pairs.
   Links of all groups are contracted into components of fingerprints.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.byterepeats import grouped
from barloom.llm.common import materialize, numbered_texts, width, with_missing_ids
from barloom.llm.neardup import components

SHINGLE = 3
SEED = 42
BITS = 64
#: Members of a group beyond which it is dealt again by further bits.
LIMIT = 2048
#: Children of a node.
FAN = 16
#: Rows of a search that are expanded at once, and rows of whole groups that are searched together.
FRONTIER = 1 << 18
ROWS = 1 << 15
#: Bytes of a text that are hashed at once.
PART = 1 << 20

_LOWER = bytes(range(256)).replace(bytes(range(65, 91)), bytes(range(97, 123)))
_SPACE = re.compile(rb"[ \t-\r]").search
_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def _word_parts(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in order, by about PART bytes at a time."""
    at = 0
    while at < len(raw):
        cut = _SPACE(raw, at + PART)
        end = cut.start() if cut else len(raw)
        yield raw[at:end].translate(_LOWER).split()
        at = end


def fingerprint(text: str) -> int:
    """The 64 bits of a text: a bit is set where more than half of its shingles' hashes have it; 0 without words."""
    total, ones, held = 0, np.zeros(BITS, np.int64), []

    def add(shingles) -> int:
        h = np.fromiter(map(_hash, shingles), "<u8")
        if len(h):
            ones[:] += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
        return len(h)

    for words in _word_parts(text.encode()):
        held += words
        total += add(map(b" ".join, zip(held, held[1:], held[2:])))
        held = held[1 - SHINGLE :]
    if not total and held:
        total = add([b" ".join(held)])
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, print) for each row of `docs`, the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = np.array([fingerprint(t) for t in b["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": b["doc_id"], "no_id": b["no_id"], "print": found.view(np.int64)})

    return with_missing_ids(numbered_texts(docs).mapInPandas(run, "doc_id long, no_id boolean, print long"))


def thirds(free: int) -> list[int]:
    """Three masks that share out the set bits of `free`, from the highest down."""
    places = [k for k in reversed(range(BITS)) if free >> k & 1]
    n = len(places)
    return [sum(1 << k for k in places[n * j // 3 : n * (j + 1) // 3]) for j in range(3)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def gray_rank(bits: Column) -> Column:
    """The place of a 64-bit pattern in the Gray order (unsigned, as the bits of a long)."""
    for k in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, k))
    return bits


def _dealt(rows: DataFrame, used: dict[int, int]) -> tuple[DataFrame, dict[int, int]]:
    """`rows` (path, print) once for each third of the bits that `used` leaves free on their path: (path, key, print)."""
    further = {path * 3 + j + 1: (mask, part | mask) for path, mask in used.items() for j, part in enumerate(thirds(~mask & ((1 << BITS) - 1)))}
    ways = F.create_map(*[x for path in used for x in (F.lit(path), F.array(*[F.struct(F.lit(p).alias("path"), F.lit(_signed(m)).cast("long").alias("mask")) for p, (_, m) in further.items() if (p - 1) // 3 == path]))])
    spread = rows.select(F.explode(F.element_at(ways, F.col("path"))).alias("way"), "print")
    return spread.select("way.path", F.xxhash64("way.path", F.col("print").bitwiseAND(F.col("way.mask"))).alias("key"), "print"), {p: m for p, (_, m) in further.items()}


def routes(prints: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(key, print): groups in which any two of the different `prints` within two bits meet at least once."""
    rows, used, done = prints.select(F.lit(0).alias("path"), "print"), {0: 0}, []
    while True:
        rows, used = _dealt(rows, used)
        fewest = min(BITS - m.bit_count() for m in used.values())
        if fewest <= limit.bit_length() or len(used) > 100:
            return _union([*done, rows.select("key", "print")])
        rows = materialize(rows, "simhash-routes")
        hot = materialize(rows.groupBy("key").count().filter(F.col("count") > limit).select("key"), "simhash-hot")
        if hot.isEmpty():
            return _union([*done, rows.select("key", "print")])
        done.append(rows.join(hot, "key", "left_anti").select("key", "print"))
        rows = rows.join(hot, "key", "left_semi").select("path", "print")


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


def tree(prints: np.ndarray, group: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Levels from the leaves up to one root for each group, each (pattern, mask of the bits it adds to its parent's, end of
    its leaves, first child, end of children). `prints` stand in Gray order within the rising numbers `group`."""
    low, high, end, owner = prints, prints, np.arange(1, len(prints) + 1), group
    child = stop = np.empty(0, np.int64)
    levels = []
    while True:
        shared = ~(low ^ high)
        alone = len(owner) == owner[-1] + 1
        if alone:
            levels.append((low, shared, end, child, stop))
            return levels
        fresh = np.concatenate([[True], owner[1:] != owner[:-1]])
        place = np.arange(len(owner))
        inner = place - np.maximum.accumulate(np.where(fresh, place, 0))
        cut = inner % FAN == 0
        at = np.flatnonzero(cut)
        parent = np.cumsum(cut) - 1
        up_low, up_high = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)
        levels.append((low, shared & (up_low ^ up_high)[parent], end, child, stop))
        child, stop = at, np.append(at[1:], len(owner))
        low, high, end, owner = up_low, up_high, end[stop - 1], owner[at]


def near_pairs(prints: np.ndarray, group: np.ndarray, radius: int = 2) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) arrays, i < j, of all pairs of a group that differ in at most `radius` bits."""
    levels = tree(prints, group)
    top = len(levels) - 1
    if not top:  # every group has one member
        return
    rows = np.arange(len(prints))
    work = [(top, rows[k : k + FRONTIER], group[k : k + FRONTIER], np.zeros(min(FRONTIER, len(rows) - k), np.int64)) for k in range(0, len(rows), FRONTIER)]
    while work:
        level, query, node, apart = work.pop()
        if level == 0:
            yield query, node
            continue
        if len(query) > FRONTIER:
            half = len(query) // 2
            work += [(level, query[:half], node[:half], apart[:half]), (level, query[half:], node[half:], apart[half:])]
            continue
        child, stop = levels[level][3], levels[level][4]
        n = stop[node] - child[node]
        query, apart, first = np.repeat(query, n), np.repeat(apart, n), np.repeat(child[node] - np.cumsum(n) + n, n)
        node = first + np.arange(len(query))
        pattern, mask, end = levels[level - 1][:3]
        ahead = end[node] > query + 1  # only pairs with a later leaf
        query, node, apart = query[ahead], node[ahead], apart[ahead]
        apart = apart + np.bitwise_count((prints[query] ^ pattern[node]) & mask[node])
        near = apart <= radius
        if near.any():
            work.append((level - 1, query[near], node[near], apart[near]))


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """`label`, the least member of each row's component, after the links (i, j)."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return label
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = label[label]
            if (further == label).all():
                break
            label = further


def stars(routed: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): each linked fingerprint of a group beside the first of its component there."""
    spark = routed.sparkSession
    dealt = routed.withColumn("rank", gray_rank(F.col("print")).bitwiseXOR(F.lit(-(1 << 63)))).repartition(width(spark), "key").sortWithinPartitions("key", "rank").drop("rank")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in grouped(batches, "key", ROWS):
            key, prints = whole["key"].to_numpy(), whole["print"].to_numpy().view(np.uint64)
            group = np.cumsum(np.concatenate([[False], key[1:] != key[:-1]]))
            label = np.arange(len(prints))
            for i, j in near_pairs(prints, group, radius):
                label = merge(label, i, j)
            linked = np.flatnonzero(label != np.arange(len(label)))
            yield pd.DataFrame({"a": prints[linked].view(np.int64), "b": prints[label[linked]].view(np.int64)})

    return dealt.mapInPandas(run, "a long, b long")


def simhash_components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id (the least doc_id reachable over links of at most two
    differing bits, itself included) for each row of `docs`.

    NULL and empty texts and texts without words have the fingerprint zero, linked like any other; a text of one or two
    words is one shingle. Texts of any length are read whole. Equal fingerprints are linked, so ties and repeated rows
    share a component; a NULL doc_id is kept and names no component: one that holds no other id has the component_id
    NULL. An empty table gives no rows. Other columns of `docs` are not read.
    """
    found = materialize(fingerprints(docs), "fingerprints")
    prints = materialize(found.groupBy("print").agg(F.min("doc_id").alias("least")), "prints")
    links = materialize(stars(routes(prints)).distinct(), "simhash-links")
    joined = materialize(prints.join(components(links).withColumnRenamed("doc_id", "print"), "print", "left").withColumn("class_id", F.coalesce("class_id", "print")), "simhash-classes")
    least = joined.groupBy("class_id").agg(F.min("least").alias("component_id"))
    # stored, so that no aggregation stands before the join and a hot fingerprint can be split
    named = materialize(joined.select("print", "class_id").join(least, "class_id").select("print", "component_id"), "simhash-components")
    return found.join(named, "print").select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
