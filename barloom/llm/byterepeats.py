"""Removal of byte strings that occurred before, by run-length indexes (operator 9).

Every 100-byte window of the corpus belongs to the segment of consecutive windows that share their minimiser (the
least hash of the window's 32-byte grams), so equal windows, wherever they stand, lie in segments of equal
minimiser. That routes the work without moving texts:

1. `segments`: each document becomes (minimiser, digest of the segment, place) rows. Segments equal to an earlier one of
   the same batch are removed at once, which is also what keeps copies from meeting in one task.
2. `first_segments`: rows meet by minimiser. Of equal segments the first stays, the others are removed. Segments that
   share a minimiser but not their bytes (the edges of passages), or repeat inside, are examined.
3. `examine`: the bytes of examined segments meet by minimiser in blocks of bounded size; a run-length index of the
   block streams the matches of each position and marks windows that begin earlier in the block.
4. A minimiser with several different segments in one batch is hot. Its segments are dealt out by themselves in
   step 2 and by a salt in step 3; what is new in its block goes on by the digest of each window, so that no
   minimiser, however common, meets in one task.

Positions order by (doc_id, text_id, start): a row is named by its doc_id and a digest of its text. Rows that repeat both
are one document, which is no earlier copy of itself: each has the result of that document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import materialize, whole_texts, width, with_missing_ids
from barloom.llm.runindex import RunIndex

GRAM = 32
#: Different segments of one minimiser in a batch from which on it is hot.
HOT = 4
CHUNK = 1 << 20
BLOCK_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
SEGMENTS = "route long, digest long, doc_id long, text_id long, place long, kind int"
PLAIN, HOT_ROW, MARK, GONE = 0, 1, 2, 3


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = np.full(n, BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_table: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Mixed polynomial hashes, modulo 2**64, of all grams of a byte array."""
    n = len(data)
    if CHUNK * 2 not in _table:
        _table[CHUNK * 2] = _powers(CHUNK * 2)
    up, down = _table[CHUNK * 2] if n < CHUNK * 2 else _powers(n + 1)
    s = np.zeros(n + 1, np.uint64)
    np.cumsum(_mix(data.astype(np.uint64) + np.uint64(1)) * down[:n], out=s[1:])
    # (s[i + gram] - s[i]) * BASE**i is the same for equal grams
    return _mix((s[gram:] - s[:-gram]) * up[: n - gram + 1])


def window_minima(h: np.ndarray, span: int) -> np.ndarray:
    """Places of the leftmost least hash of every `span` consecutive ones."""
    low = np.uint64((1 << 23) - 1)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= span:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    if size < span:
        key = np.minimum(key[: len(key) - (span - size)], key[span - size :])
    return (key & low).astype(np.int64)


def pieces(sizes: np.ndarray, width_: int) -> Iterator[list[tuple[int, int, int]]]:
    """(document, first byte, end byte) lists of up to about CHUNK bytes; long documents overlap by width_ - 1."""
    held, total = [], 0
    for d, n in enumerate(sizes.tolist()):
        at = 0
        while n - at >= width_:
            end = min(n, at + CHUNK)
            if total and total + end - at > CHUNK:
                yield held
                held, total = [], 0
            held.append((d, at, end))
            total += end - at
            at = end - width_ + 1
            if end == n:
                break
    if held:
        yield held


def batch_segments(data: list[bytes], window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, start, number of windows, minimiser, digest, repeats inside) of the segments of a batch."""
    span = window - GRAM + 1
    for held in pieces(np.array([len(b) for b in data], np.int64), window):
        views = [memoryview(data[d])[a:b] for d, a, b in held]
        raw = b"".join(views)
        text = np.frombuffer(raw, np.uint8)
        sizes = np.array([b - a for _, a, b in held], np.int64)
        begin = np.cumsum(sizes) - sizes
        h = gram_hashes(text, GRAM)
        least = window_minima(h, span)  # one for each window start of the joined bytes
        inside = np.zeros(len(least) + 1, np.int64)
        np.add.at(inside, begin, 1)
        np.add.at(inside, np.minimum(begin + sizes - window + 1, len(least)), -1)
        starts = np.flatnonzero(np.cumsum(inside[:-1]) > 0)  # windows that stay in one document
        value, where = h[least[starts]], least[starts]
        cut = np.concatenate([[True], (value[1:] != value[:-1]) | (starts[1:] != starts[:-1] + 1)])
        moved = np.concatenate([[0], (where[1:] != where[:-1]) & ~cut[1:]])
        first = np.flatnonzero(cut)
        count = np.diff(np.append(first, len(starts)))
        inner = np.add.reduceat(moved, first) > 0 if len(first) else np.empty(0, bool)
        at = starts[first]
        end = at + count + window - 1
        one = xxhash.xxh3_64_intdigest
        view = memoryview(raw)
        digest = np.fromiter((one(view[a:b]) for a, b in zip(at.tolist(), end.tolist(), strict=True)), np.uint64, len(at))
        owner = np.searchsorted(begin, at, "right") - 1
        docs = np.array([d for d, _, _ in held], np.int64)[owner]
        offset = np.array([a for _, a, _ in held], np.int64)[owner]
        yield docs, at - begin[owner] + offset, count, value[first].view(np.int64), digest.view(np.int64), inner


def pack_place(start: np.ndarray, count: np.ndarray, inner) -> np.ndarray:
    return (start << 24) | (count << 1) | inner


def unpack_place(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 24, (place >> 1) & ((1 << 23) - 1), (place & 1).astype(bool)


def _runs(doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Joins (doc, start, count) rows, in order, whose windows follow one another."""
    if not len(doc):
        return doc, start, count
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + count[:-1])])
    first = np.flatnonzero(new)
    count = np.add.reduceat(count, first)
    most = (1 << 23) - 1
    if (count > most).any():  # a place holds so many windows at most
        rows = [(d, s + k, min(most, c - k)) for d, s, c in zip(doc[first].tolist(), start[first].tolist(), count.tolist(), strict=True) for k in range(0, c, most)]
        return tuple(np.array(x, np.int64) for x in zip(*rows, strict=True))
    return doc[first], start[first], count


def _names(doc: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each row's name, rising by doc_id and text_id; a row of each name)."""
    order = np.lexsort((text, doc))
    d, t = doc[order], text[order]
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (t[1:] != t[:-1])])[: len(d)]
    number = np.empty(len(doc), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]


def _later(fresh: np.ndarray, name: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Rows that follow the first of their group, but for those that are that row again."""
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))
    return ~fresh & ((name != name[first]) | (place != place[first]))


def _frame(**columns) -> pd.DataFrame:
    return pd.DataFrame(columns)


def segments(docs: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, names = b["doc_id"].to_numpy(np.int64), b["text_id"].to_numpy(np.int64)
            order = _names(ids, names)[1]
            ids, names = ids[order], names[order]
            data = [b["text"].iloc[k].encode() for k in order]
            got = [np.concatenate(x) for x in zip(*batch_segments(data, window), strict=True)]
            if not got:
                continue
            doc, start, count, route, digest, inner = got
            sort = np.lexsort((np.arange(len(doc)), digest, route))
            r, g = route[sort], digest[sort]
            same = np.concatenate([[False], (r[1:] == r[:-1]) & (g[1:] == g[:-1])])
            again = np.zeros(len(doc), bool)
            again[sort[same]] = True
            gone = np.flatnonzero(again)
            d, s, c = _runs(doc[gone], start[gone], count[gone])
            yield _frame(route=_mix(ids[d].astype(np.uint64)).view(np.int64), digest=np.zeros(len(d), np.int64), doc_id=ids[d], text_id=names[d], place=pack_place(s, c, 0), kind=np.full(len(d), GONE, np.int32))
            left = sort[~same]
            r = route[left]
            first = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
            sizes = np.diff(np.append(first, len(r)))
            hot = np.repeat(sizes >= HOT, sizes)
            own = np.where(hot, _mix((r ^ (digest[left] * 3)).view(np.uint64)).view(np.int64), r)
            yield _frame(route=own, digest=digest[left], doc_id=ids[doc[left]], text_id=names[doc[left]], place=pack_place(start[left], count[left], inner[left]), kind=np.where(hot, HOT_ROW, PLAIN).astype(np.int32))
            marks = r[first[sizes >= HOT]]
            yield _frame(route=marks, digest=np.zeros(len(marks), np.int64), doc_id=np.zeros(len(marks), np.int64), text_id=np.zeros(len(marks), np.int64), place=np.zeros(len(marks), np.int64), kind=np.full(len(marks), MARK, np.int32))

    return docs.mapInPandas(run, SEGMENTS)


def grouped(batches: Iterator[pd.DataFrame], key: str, least: int = 0, weigh=None) -> Iterator[pd.DataFrame]:
    """Frames of whole groups from batches that are sorted by `key`."""
    held: list[pd.DataFrame] = []
    size = 0
    for b in batches:
        if not len(b):
            continue
        k = b[key].to_numpy()
        cut = len(k) - int((k == k[-1]).sum()) if k[0] != k[-1] else 0
        if held and k[0] != held[-1][key].iloc[-1] and size >= least:
            yield pd.concat(held)
            held, size = [], 0
        if cut and size + (weigh(b[:cut]) if weigh else cut) >= least:
            yield pd.concat([*held, b[:cut]])
            held, size = [], 0
            b = b[cut:]
        held.append(b)
        size += weigh(b) if weigh else len(b)
    if held:
        yield pd.concat(held)


def first_segments(found: DataFrame) -> DataFrame:
    """(what, key, doc_id, text_id, place): what 0: removed; 1: examine under its minimiser; 2: examine as hot."""
    dealt = found.repartition(width(found.sparkSession), "route").sortWithinPartitions("route", "digest", "doc_id", "text_id", "place")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in grouped(batches, "route"):
            route, digest, ids, names, place, kind = (b[c].to_numpy() for c in ("route", "digest", "doc_id", "text_id", "place", "kind"))
            doc, of = _names(ids, names)
            group = np.cumsum(np.concatenate([[False], route[1:] != route[:-1]]))
            marked = np.zeros(group[-1] + 1, bool)
            marked[group[kind == MARK]] = True
            real = np.flatnonzero((kind == PLAIN) | (kind == HOT_ROW))
            g, dg = group[real], digest[real]
            fresh = np.concatenate([[True], (g[1:] != g[:-1]) | (dg[1:] != dg[:-1])])[: len(real)]
            gone = np.concatenate([real[_later(fresh, doc[real], place[real])], np.flatnonzero(kind == GONE)])
            d, s, c = doc[gone], *unpack_place(place[gone])[:2]
            order = np.lexsort((s, d))
            d, s, c = _runs(d[order], s[order], c[order])
            yield _frame(what=np.zeros(len(d), np.int32), key=np.zeros(len(d), np.int64), doc_id=ids[of[d]], text_id=names[of[d]], place=pack_place(s, c, 0))
            reps = real[fresh]
            g = group[reps]
            several = np.bincount(g, minlength=group[-1] + 1)[g] > 1
            hot = (kind[reps] == HOT_ROW) | marked[g]
            look = hot | several | (place[reps] & 1).astype(bool)
            x = reps[look]
            yield _frame(what=np.where(hot[look], 2, 1).astype(np.int32), key=route[x], doc_id=ids[x], text_id=names[x], place=place[x])

    return dealt.mapInPandas(run, "what int, key long, doc_id long, text_id long, place long")


def examine(look: DataFrame, texts: DataFrame, window: int, salts: int) -> DataFrame:
    """(key, digest, doc_id, text_id, place, kind): removed runs (GONE) and, of hot blocks, windows that are new there (PLAIN)."""
    spark = look.sparkSession
    wanted = look.groupBy("doc_id", "text_id").agg(F.collect_list(F.struct("what", "key", "place")).alias("wanted"))
    joined = wanted.join(texts, ["doc_id", "text_id"])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            b = b.drop_duplicates(["doc_id", "text_id"])
            for doc, name, wanted_, text in zip(b["doc_id"], b["text_id"], b["wanted"], b["text"], strict=True):
                data = text.encode()
                salt = xxhash.xxh3_64_intdigest(int(doc).to_bytes(8, "little", signed=True) + int(name).to_bytes(8, "little", signed=True)) % salts
                for x in wanted_:
                    start, count = x["place"] >> 24, (x["place"] >> 1) & ((1 << 23) - 1)
                    rows.append((x["what"], salt if x["what"] == 2 else x["key"], doc, name, start, data[start : start + count + window - 1]))
            yield pd.DataFrame(rows, columns=["what", "key", "doc_id", "text_id", "start", "piece"])

    pieces_ = joined.mapInPandas(cut, "what int, key long, doc_id long, text_id long, start long, piece binary")
    dealt = pieces_.repartition(width(spark), "what", "key").sortWithinPartitions("what", "key", "doc_id", "text_id", "start")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        two = xxhash.xxh3_128_digest
        for whole in grouped(batches, "key", BLOCK_BYTES, lambda b: int(b["piece"].str.len().sum())):
            for what, b in whole.groupby("what"):
                b = b.drop_duplicates(["doc_id", "text_id", "start"]).sort_values(["doc_id", "text_id", "start"], kind="stable")
                strings = b["piece"].tolist()
                ids, names, start = (b[c].to_numpy(np.int64) for c in ("doc_id", "text_id", "start"))
                doc, of = _names(ids, names)
                index = RunIndex(strings, window)
                valid, again = index.repeated()
                at = np.flatnonzero(again)
                s = np.searchsorted(index.start, at, "right") - 1
                d, f, c = _runs(doc[s], start[s] + at - index.start[s], np.ones(len(at), np.int64))
                yield _frame(key=_mix(ids[of[d]].astype(np.uint64)).view(np.int64), digest=np.zeros(len(d), np.int64), doc_id=ids[of[d]], text_id=names[of[d]], place=pack_place(f, c, 0), kind=np.full(len(d), GONE, np.int32))
                if what == 2:
                    at = np.flatnonzero(valid & ~again)
                    s = np.searchsorted(index.start, at, "right") - 1
                    inner = at - index.start[s]
                    h = np.frombuffer(b"".join(two(strings[k][i : i + window]) for k, i in zip(s.tolist(), inner.tolist(), strict=True)), np.int64).reshape(-1, 2)
                    yield _frame(key=h[:, 0], digest=h[:, 1], doc_id=ids[s], text_id=names[s], place=pack_place(start[s] + inner, np.int64(1), 0), kind=np.full(len(at), PLAIN, np.int32))

    return dealt.mapInPandas(run, "key long, digest long, doc_id long, text_id long, place long, kind int")


def merge_windows(found: DataFrame) -> DataFrame:
    """(doc_id, text_id, place) of removed runs: of equal windows of different blocks the first stays."""
    dealt = found.repartition(width(found.sparkSession), "key").sortWithinPartitions("key", "digest", "doc_id", "text_id", "place")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in grouped(batches, "key"):
            key, digest, ids, names, place, kind = (b[c].to_numpy() for c in ("key", "digest", "doc_id", "text_id", "place", "kind"))
            doc, of = _names(ids, names)
            x = np.flatnonzero(kind == PLAIN)
            fresh = np.concatenate([[True], (key[x][1:] != key[x][:-1]) | (digest[x][1:] != digest[x][:-1])])[: len(x)]
            gone = np.concatenate([x[_later(fresh, doc[x], place[x])], np.flatnonzero(kind == GONE)])
            d, s, c = doc[gone], *unpack_place(place[gone])[:2]
            order = np.lexsort((s, d))
            d, s, c = _runs(d[order], s[order], c[order])
            yield _frame(doc_id=ids[of[d]], text_id=names[of[d]], place=pack_place(s, c, 0))

    return dealt.mapInPandas(run, "doc_id long, text_id long, place long")


def byte_runs(starts: np.ndarray, counts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal byte runs that removed windows cover."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    a, b = starts[order], (starts + counts + window - 1)[order]
    reach = np.maximum.accumulate(b)
    first = np.flatnonzero(np.concatenate([[True], a[1:] > reach[:-1]]))
    last = np.append(first[1:], len(a)) - 1
    return list(zip(a[first].tolist(), reach[last].tolist(), strict=True))


def remove_repeats(docs: DataFrame, window: int = 100) -> DataFrame:
    """doc_id, n_bytes, spans (array of start, end in bytes), kept (binary: what is left), one row for each row of `docs`.

    NULL and empty texts have no bytes; texts shorter than `window` stay whole; an empty table gives no rows; other
    columns are not read. A NULL doc_id orders before all others: it counts as one less than the least (where that is -2**63,
    a row of that id and one without an id count as one document if their texts are equal). Rows that repeat a doc_id
    and its text have the result of one document. A text of any length is cut whole.
    """
    spark = docs.sparkSession
    least = docs.agg(F.min(F.col("doc_id").cast("long"))).first()[0]
    before = max(-(1 << 63), (0 if least is None else least) - 1)
    texts = whole_texts(docs).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(before).cast("long")).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), F.xxhash64("text").alias("text_id"), "text")
    verdicts = materialize(first_segments(segments(texts.drop("no_id"), window)), "segment-verdicts")
    n_hot = verdicts.filter("what = 2").count()
    spread = texts.repartition(width(spark), "doc_id", "text_id")
    look = verdicts.filter("what > 0")
    later = merge_windows(examine(look, spread.drop("no_id"), window, max(width(spark), -(-n_hot // 16_384))))
    gone = verdicts.filter("what = 0").select("doc_id", "text_id", "place").unionByName(later).groupBy("doc_id", "text_id").agg(F.collect_list("place").alias("places"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, none, text, places in zip(b["doc_id"], b["no_id"], b["text"], b["places"], strict=True):
                data = text.encode()
                p = np.array([] if places is None else places, np.int64)
                runs = [(s, min(e, len(data))) for s, e in byte_runs(*unpack_place(p)[:2], window) if s < len(data)]
                kept, at = [], 0
                for s, e in runs:
                    kept.append(data[at:s])
                    at = e
                rows.append((doc, none, len(data), [{"start": s, "end": e} for s, e in runs], b"".join([*kept, data[at:]])))
            yield pd.DataFrame(rows, columns=["doc_id", "no_id", "n_bytes", "spans", "kept"])

    out = spread.join(gone, ["doc_id", "text_id"], "left").mapInPandas(cut, "doc_id long, no_id boolean, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return with_missing_ids(out)


def digest(removed: DataFrame) -> DataFrame:
    return removed.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
