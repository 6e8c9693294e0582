"""Removal of repeated word sequences by fixed-block anchors (operator 5).

A window is 35 words. Every document is cut into non-overlapping reference blocks of 18 words; any window holds at
least one whole block, so a window that occurs twice is found by probing the index of blocks with every rolling
18-word window. Anchors that meet are then extended: all windows around them are compared by 96 bits of digest beside
their bucket, which leaves exactly the maximal repeats, and every word under one is removed.

Only digests travel. A batch of documents sends each bucket of the index one row of packed arrays (32 bits a probe
within its bucket, the position as a difference), at most one probe for each different sequence of the batch, so
a passage that a third of all documents share costs a bucket one probe for each batch. Answers go back as
positions by batch. The number of buckets follows the bytes of all texts, so that no bucket grows with the corpus, and
buckets are dealt out evenly. Texts are dealt out once by row and read twice from that exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import numbered_texts, width, with_missing_ids

CHUNK = 1 << 21
PART_CHARS = 6 << 20
BASE, OTHER = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
#: Words of more bytes are digested one by one.
LONG_WORD = 256
ROWS = "route long, batch long, kind int, a binary, b binary, c binary"
ASK, TABLE, KNOWN = 0, 1, 2
#: What names a row of the input, the same in each scan of it: its doc_id, or that it has none, and 128 bits of its text.
KEY = ["_id", "_none", "_text", "_more"]
#: Text bytes of a bucket of the index.
BUCKET_BYTES = 8 << 20
_lane = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _pairs(x: np.ndarray, y: np.ndarray, base: int) -> np.ndarray:
    return _mix(x * np.uint64(base) + y)


def _levels(values: np.ndarray, size: int, base: int) -> dict[int, np.ndarray]:
    """Digests of every 1, 2, 4 .. consecutive values, up to `size`."""
    out, span = {1: values}, 1
    while span * 2 <= size:
        out[span * 2] = _pairs(out[span][:-span], out[span][span:], base)
        span *= 2
    return out


def _chained(levels: dict[int, np.ndarray], spans: list[int], n: int, base: int) -> np.ndarray:
    out, at = None, 0
    for span in spans:
        part = levels[span][at : at + n]
        out, at = part if out is None else _pairs(out, part, base), at + span
    return out


def rolling(values: np.ndarray, size: int, base: int = BASE) -> np.ndarray:
    """Digests of every `size` consecutive values: of halves, mixed again at each level, not a sum of powers, in which
    patterned sequences could cancel out."""
    n = len(values) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    return _chained(_levels(values, size, base), [1 << k for k in range(size.bit_length()) if size >> k & 1], n, base)


def rolling_twice(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two digests of every `size` consecutive values that cut them in different places."""
    n = len(values) - size + 1
    if n < 1:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    spans = [1 << k for k in range(size.bit_length()) if size >> k & 1]
    levels = _levels(values, size, BASE)
    if len(spans) == 1:
        return levels[size], rolling(values, size, OTHER)
    return _chained(levels, spans, n, BASE), _chained(levels, spans[::-1], n, OTHER)


def word_places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and end bytes of the words."""
    blank = np.concatenate([[True], _space[np.frombuffer(data, np.uint8)], [True]])
    return np.flatnonzero(blank[:-1] & ~blank[1:]), np.flatnonzero(~blank[:-1] & blank[1:])


def word_digests(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(digests of all words, text after text; number of words of each text), in chunks that end at white space."""
    out, counts = [], np.zeros(len(texts), np.int64)

    def take(data: bytes, owners: list[int], ends: list[int]) -> None:
        a, b = word_places(data)
        size = b - a
        eight = np.ndarray(len(data) + 1, "<u8", data + bytes(8), strides=(1,))  # the eight bytes from each place on
        h = _mix((size.astype(np.uint64) + np.uint64(1)) * np.uint64(BASE))
        for k in range(0, min(int(size.max(initial=0)), LONG_WORD), 8):
            left = np.flatnonzero(size > k) if k else slice(None)
            rest = np.minimum(size[left] - k, 8)
            h[left] = _mix(h[left] ^ (eight[a[left] + k] & _lane[rest]))
        for k in np.flatnonzero(size > LONG_WORD):
            h[k] = xxhash.xxh3_64_intdigest(data[a[k] : b[k]])
        out.append(h)
        np.add.at(counts, owners, np.diff(np.searchsorted(a, [0, *ends])))

    held, owners, ends, total = [], [], [], 0
    for k, t in enumerate(texts):
        at = 0
        while len(t) - at > CHUNK:  # a long text goes by parts that end at white space
            end = at + CHUNK
            while end < len(t) and not _space[t[end]]:
                end += 1
            if held:
                take(b" ".join(held), owners, ends)
                held, owners, ends, total = [], [], [], 0
            take(t[at:end], [k], [end - at])
            at = end
        if total + len(t) - at > CHUNK and held:
            take(b" ".join(held), owners, ends)
            held, owners, ends, total = [], [], [], 0
        held.append(t[at:])
        total += len(t) - at + 1
        owners.append(k)
        ends.append(total)
    if held:
        take(b" ".join(held), owners, ends)
    return np.concatenate([*out, np.empty(0, np.uint64)]), counts


def pack_rising(x: np.ndarray) -> bytes:
    """Rising non-negative integers as differences, byte planes apart: small steps compress to one byte."""
    d = np.diff(x, prepend=0).astype("<u4")
    return d.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack_rising(b: bytes) -> np.ndarray:
    d = np.frombuffer(b, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
    return np.cumsum(d.astype(np.int64))


def _rows(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["route", "batch", "kind", "a", "b", "c"])


def _spread(batch: int) -> int:
    return int(_mix(np.array([batch], np.uint64)).view(np.int64)[0])


def ask(batch: int, rows: np.ndarray, counts: np.ndarray, at: np.ndarray, digest: np.ndarray, extra: np.ndarray, block: np.ndarray, buckets: int) -> Iterator[pd.DataFrame]:
    """Requests of one batch: a digest (and `extra` bits) at each rising place of `at`, sent once for each different one.

    What occurs more than once in the batch is known at once. `block` marks places that are reference blocks.
    """
    order = np.argsort(digest, kind="stable")
    d = digest[order]
    first = np.concatenate([[True], d[1:] != d[:-1]])[: len(d)]
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, len(d)))
    known = np.sort(at[order[np.repeat(sizes > 1, sizes)]])
    held = np.add.reduceat(block[order].astype(np.int64), starts) > 0 if len(starts) else np.empty(0, bool)
    leader = order[starts]
    yield _rows([(_spread(batch), batch, TABLE, np.ascontiguousarray(rows, "<i8").tobytes(), counts.astype("<i8").tobytes(), pack_rising(known))])
    bucket = ((digest[leader] >> np.uint64(33)) % np.uint64(buckets)).astype(np.uint32)
    sort = np.lexsort((at[leader], bucket))
    leader, bucket, held = leader[sort], bucket[sort], held[sort]
    low = (digest[leader] & np.uint64(0xFFFFFFFF)).astype("<u4")
    cut = np.searchsorted(bucket, np.arange(buckets + 1))
    out = []
    for k in np.flatnonzero(np.diff(cut)):
        s = slice(cut[k], cut[k + 1])
        out.append((int(k), batch, ASK, low[s].tobytes() + extra[leader[s]].tobytes(), pack_rising(at[leader[s]]), np.packbits(held[s]).tobytes()))
    yield _rows(out)


def answer(asked: DataFrame, extra_bytes: int, need_block: bool) -> DataFrame:
    """(batch, kind, a, b, c): of each bucket, the places of digests that several batches sent."""

    def settle(rows: list[tuple[int, bytes, bytes, bytes]]) -> pd.DataFrame:
        sizes = [len(p) // 4 for _, _, p, _ in rows]
        low = np.concatenate([np.frombuffer(a, "<u4", n) for (_, a, _, _), n in zip(rows, sizes, strict=True)])
        owner = np.repeat(np.arange(len(rows)), sizes)
        keys = [low]
        if extra_bytes:
            more = [np.frombuffer(a, np.uint8, offset=4 * n).reshape(n, extra_bytes) for (_, a, _, _), n in zip(rows, sizes, strict=True)]
            wide = np.zeros((len(low), 8), np.uint8)
            wide[:, :extra_bytes] = np.concatenate(more)
            keys.insert(0, wide.view("<u8").ravel())
        order = np.lexsort(keys) if len(keys) > 1 else np.argsort(low, kind="stable")
        new = np.zeros(len(order), bool)
        new[:1] = True
        for k in keys:
            x = k[order]
            new[1:] |= x[1:] != x[:-1]
        starts = np.flatnonzero(new)
        count = np.diff(np.append(starts, len(order)))
        ok = count > 1
        if need_block:
            flags = np.concatenate([np.unpackbits(np.frombuffer(c, np.uint8), count=n) for (_, _, _, c), n in zip(rows, sizes, strict=True)])
            ok &= np.add.reduceat(flags[order].astype(np.int64), starts) > 0
        hit = np.zeros(len(order), bool)
        hit[order] = np.repeat(ok, count)
        out, begin = [], 0
        for (batch, _, p, _), n in zip(rows, sizes, strict=True):
            h = hit[begin : begin + n]
            begin += n
            if h.any():
                out.append((batch, KNOWN, None, None, pack_rising(unpack_rising(p)[h])))
        return pd.DataFrame(out, columns=["batch", "kind", "a", "b", "c"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        route, rows = None, []
        for b in batches:
            table = b[b["kind"] == TABLE]
            if len(table):
                yield table[["batch", "kind", "a", "b", "c"]]
            for r, batch, kind, x, y, z in b[["route", "batch", "kind", "a", "b", "c"]].itertuples(index=False, name=None):
                if kind == TABLE:
                    continue
                if r != route and rows:
                    yield settle(rows)
                    rows = []
                route = r
                rows.append((batch, x, y, z))
        if rows:
            yield settle(rows)

    n = width(asked.sparkSession)
    dealt = asked.repartitionById(n, F.pmod("route", F.lit(n)).cast("int")).sortWithinPartitions("kind", "route", "batch")
    return dealt.mapInPandas(run, "batch long, kind int, a binary, b binary, c binary")


def deliver(answers: DataFrame) -> DataFrame:
    """(KEY, places): the places of each document, packed; documents without any are left out.

    Equal rows are the same document more than once. All their windows repeat, so each of them has the same places.
    """

    def settle(rows: list[tuple]) -> pd.DataFrame:
        table = next(r for r in rows if r[1] == TABLE)
        ids, counts = np.frombuffer(table[2], "<i8").reshape(-1, len(KEY)), np.frombuffer(table[3], "<i8")
        at = np.unique(np.concatenate([unpack_rising(r[4]) for r in rows]))
        if not len(at):
            return pd.DataFrame({**{k: np.empty(0, np.int64) for k in KEY}, "places": []})
        end = np.cumsum(counts)
        doc = np.searchsorted(end, at, "right")
        cut = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        out = []
        for s, e in zip(cut, np.append(cut[1:], len(at)), strict=True):
            k = doc[s]
            out.append((*ids[k], pack_rising(at[s:e] - (end[k] - counts[k]))))
        return pd.DataFrame(out, columns=[*KEY, "places"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, rows = None, []
        for b in batches:
            for r in b[["batch", "kind", "a", "b", "c"]].itertuples(index=False, name=None):
                if r[0] != last and rows:
                    yield settle(rows)
                    rows = []
                last = r[0]
                rows.append(r)
        if rows:
            yield settle(rows)

    dealt = answers.repartition(width(answers.sparkSession), "batch").sortWithinPartitions("batch", "kind")
    return dealt.mapInPandas(run, ", ".join(f"{k} long" for k in KEY) + ", places binary").dropDuplicates(KEY)


def _numbered(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame]]:
    """Parts of about PART_CHARS of text (or one longer text), each with a number that a repeated run of the same task
    gives again. The arrays of a part are a few dozen times its size, so this bounds a worker's memory."""
    number = TaskContext.get().partitionId() << 24
    for b in batches:
        if not len(b):
            continue
        size = b["text"].str.len().to_numpy(np.int64)
        part = (np.cumsum(size) - 1) // PART_CHARS
        cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        for s, e in zip(cut, np.append(cut[1:], len(b)), strict=True):
            yield number, b.iloc[s:e]
            number += 1


def probe_blocks(docs: DataFrame, block: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, b in _numbered(batches):
            words, counts = word_digests([t.encode() for t in b["text"]])
            end = np.cumsum(counts)
            h = rolling(words, block)
            doc_end = np.repeat(end, counts)[: len(h)]
            inner = np.arange(len(words)) - np.repeat(end - counts, counts)
            at = np.flatnonzero(np.arange(len(h)) + block <= doc_end)
            yield from ask(batch, b[KEY].to_numpy(np.int64), counts, at, h[at], np.empty((len(at), 0), np.uint8), inner[at] % block == 0, buckets)

    return docs.mapInPandas(run, ROWS)


def compare_windows(joined: DataFrame, window: int, block: int, buckets: int) -> DataFrame:
    """Requests for all windows that hold an anchor: 32 bits of one digest and 64 of another."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, b in _numbered(batches):
            words, counts = word_digests([t.encode() for t in b["text"]])
            end = np.cumsum(counts)
            anchors = [unpack_rising(p) + e - c for p, e, c in zip(b["places"], end, counts, strict=True)]
            anchors = np.concatenate([*anchors, np.empty(0, np.int64)])
            h, other = rolling_twice(words, window)
            near = np.zeros(len(words) + 1, np.int64)
            begin = np.repeat(end - counts, counts)
            np.add.at(near, np.maximum(begin[anchors], anchors - (window - block)), 1)
            np.add.at(near, anchors + 1, -1)
            at = np.flatnonzero((np.cumsum(near[: len(h)]) > 0) & (np.arange(len(h)) + window <= np.repeat(end, counts)[: len(h)]))
            extra = other[at].astype("<u8").view(np.uint8).reshape(-1, 8)
            yield from ask(batch, b[KEY].to_numpy(np.int64), counts, at, h[at], extra, np.zeros(len(at), bool), buckets)

    return joined.mapInPandas(run, ROWS)


def remove_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """doc_id, n_words, removed (array of first and end words of removed runs), kept (text), a row for each row of `docs`.

    Each row is a document of its own, so repeated rows are repeats; NULL and empty texts have no words; texts shorter
    than a window stay whole; an empty table gives no rows; other columns are not read; a NULL doc_id is kept.
    """
    spark = docs.sparkSession
    block = (window + 1) // 2
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4 * width(spark), -(-size // BUCKET_BYTES))
    # one set of columns for both reads of the dealt texts, so that they share one exchange
    named = numbered_texts(docs).select(F.col("doc_id").alias("_id"), F.col("no_id").cast("long").alias("_none"), "text")
    base = named.select("_id", "_none", "text", F.xxhash64("text").alias("_text"), F.xxhash64(F.lit(OTHER - (1 << 64)), "text").alias("_more"))
    anchors = deliver(answer(probe_blocks(base, block, buckets), 0, True))
    spread = base.repartition(width(spark), *KEY)
    joined = spread.join(anchors, KEY).select(*KEY, "text", "places").sortWithinPartitions(*KEY)
    repeated = deliver(answer(compare_windows(joined, window, block, buckets), 8, False))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, none, text, places in zip(b["_id"], b["_none"], b["text"], b["places"], strict=True):
                data = text.encode()
                a, e = word_places(data)
                gone = np.zeros(len(a) + 1, np.int64)
                if places is not None:
                    at = unpack_rising(places)
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + window, -1)
                covered = np.cumsum(gone[:-1]) > 0
                edge = np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8))
                runs = [{"start": int(s), "end": int(t)} for s, t in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]
                kept = b" ".join([data[s:t] for s, t in zip(a[~covered].tolist(), e[~covered].tolist(), strict=True)])
                rows.append((doc, none > 0, len(a), runs, kept.decode()))
            yield pd.DataFrame(rows, columns=["doc_id", "no_id", "n_words", "removed", "kept"])

    out = spread.join(repeated, KEY, "left").select("_id", "_none", "text", "places").mapInPandas(
        cut, "doc_id long, no_id boolean, n_words long, removed array<struct<start:long,end:long>>, kept string"
    )
    return with_missing_ids(out)


def digest(removed: DataFrame) -> DataFrame:
    n = F.aggregate("removed", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    return removed.select("doc_id", "n_words", n.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
