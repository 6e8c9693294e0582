"""Alignment of two tokenizers' tokens, and how often their tokens end together (operator 12).

1. `partial_counts`: each task encodes whole texts by both tokenizers and counts the pairs of tokens that end at the same
   byte, packed into one int64 (B id above A id), by np.unique.
2. `count_runs`: the partial counts, dealt out by ranges of the packed pair and sorted, are summed run by run.
3. `store_shards`: the sorted counts go to the shared folder as flat int64 files, which tasks map into memory.
4. `align`: a second scan looks each pair up by searchsorted in the mapped shards. Tokenising again from a memo of words
   costs less than storing all tokens.

Both tokenizers cut at spaces and line ends, so a text falls into segments whose tokens do not depend on what surrounds
them (see `SEGMENT`); a segment ends where both end a token, so groups and links lie within it. A segment that was met
before costs one dictionary lookup.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import fresh_path, materialize, numbered_texts, width, with_missing_ids
from barloom.llm.wordmemo import _CHARS

#: Segments kept by a worker before it starts anew: bounds memory, never changes a result.
MEMO_SEGMENTS = 500_000
#: Pairs of a shard file.
SHARD_PAIRS = 1 << 20
#: Characters of a text that are cut into segments at once.
PART = 1 << 20

_SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # what tokenizer A takes as white space
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = ".,!?;:|$%&*#"
#: A text with a leading space, cut into: a line end between words; a word of plain letters; the marks behind one; any
#: other word; else all up to the next place where a space or a line end follows another character, or the rest.
SEGMENT = re.compile(
    f"\n(?=[^{_SPACES}])| ?[{_LETTERS}]++(?=[{_MARKS}]*+(?:[ \n]|\\Z))|(?<=[{_LETTERS}])[{_MARKS}]++(?=[ \n]|\\Z)"
    f"| ?[^{_SPACES}]++(?=[ \n]|\\Z)|[\\s\\S]+?(?<=[^{_SPACES}])(?=[ \n]|\\Z)|[\\s\\S]+"
).findall
_BREAK = re.compile(f"(?<=[^{_SPACES}])[ \n]").search


class Segments:
    """Tokens, groups and links of the segments met so far, each by its number; -1 where the bytes differ from the text.

    New segments are encoded many at once, and aligned at once: their bytes, end to end, are one axis for the tokens of both.
    """

    def __init__(self, a_path: str, b_path: str, named: bool = True):
        self.named = named  # whether the ids of groups are kept
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(a_path)
        self.tokenizer.encode_special_tokens = True
        char_byte = {ord(c): k for k, c in enumerate(_CHARS)}
        self.a_bytes = [b""] * self.tokenizer.get_vocab_size()
        for token, k in self.tokenizer.get_vocab().items():
            self.a_bytes[k] = bytes(char_byte[ord(c)] for c in token) if all(ord(c) in char_byte for c in token) else token.encode()
        self.model = sentencepiece.SentencePieceProcessor(model_file=b_path)
        n = self.model.get_piece_size()
        self.b_bytes = [bytes([int(self.model.id_to_piece(k)[3:5], 16)]) if self.model.is_byte(k) else self.model.id_to_piece(k).replace("▁", " ").encode() for k in range(n)]
        pieces = [self.model.id_to_piece(k) for k in range(n) if not (self.model.is_byte(k) or self.model.is_control(k) or self.model.is_unknown(k))]
        if any(re.search(f"[^▁]▁|.\n|\n.|[{_LETTERS}][{_MARKS}]", p) for p in pieces) or not all(self.a_bytes) or not all(self.b_bytes):
            raise ValueError(f"{b_path}: a piece reaches across a space, a line end or the end of a word")
        self.a_length, self.b_length = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))
        self.start()

    def start(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.size = 0
        self.n_a, self.n_b, self.n_groups, self.pairs = [], [], [], []

    def columns(self) -> list[np.ndarray]:
        """Numbers of tokens of A, of B and of groups of each segment, and the pairs of all, one after the other."""
        for column in (self.n_a, self.n_b, self.n_groups, self.pairs):
            column[:] = [np.concatenate(column) if column else np.zeros(0, np.int64)]
        return [c[0] for c in (self.n_a, self.n_b, self.n_groups, self.pairs)]

    def full(self, limit: int) -> bool:
        return len(self.known) > limit

    def _a_ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, new: list[str]) -> None:
        """Numbers segments that are not known yet."""
        if not new:
            return
        led = [w[0] == " " and w[1:2] not in ("", " ") for w in new]  # a leading space is the one that B adds
        b = self.model.encode([w[1:] if x else "\n" + w for w, x in zip(new, led, strict=True)], num_threads=1)
        good, found = self.aligned(new, self._a_ids(new), [ids if x else ids[2:] for ids, x in zip(b, led, strict=True)])
        number = np.full(len(new), -1)
        number[good] = self.size + np.arange(len(good))
        self.known.update(zip(new, number.tolist(), strict=True))
        self.size += len(good)
        for column, x in zip((self.n_a, self.n_b, self.n_groups, self.pairs), found, strict=False):
            column.append(x)
        if self.named:
            self.groups += found[4]

    def aligned(self, texts: list[str], a: list[list[int]], b: list[list[int]]):
        """The texts that the tokens of both sides give back, and of these (tokens of A, of B, groups, linked pairs one after
        the other, the groups' ids)."""
        raw = [t.encode() for t in texts]
        good, size, whole = np.arange(len(raw)), np.fromiter(map(len, raw), np.int64, len(raw)), b"".join(raw)
        sides = []
        for side, by, length in ((a, self.a_bytes, self.a_length), (b, self.b_bytes, self.b_length)):
            ids, n = list(itertools.chain.from_iterable(side)), np.fromiter(map(len, side), np.int64, len(side))
            at = np.concatenate([[0], np.cumsum(length[np.array(ids, np.int64)])])
            stop = np.cumsum(n)
            if b"".join(map(by.__getitem__, ids)) != whole or (at[stop] - at[stop - n] != size).any():
                good = np.array([k for k in good if b"".join([by[x] for x in side[k]]) == raw[k]], np.int64)
            sides.append((ids, at[1:], n))
        if len(good) < len(raw):
            return good, self.aligned(*([side[k] for k in good] for side in (texts, a, b)))[1]
        (a_ids, a_end, n_a), (b_ids, b_end, n_b) = sides
        common = np.intersect1d(a_end, b_end, assume_unique=True)
        x, y = np.searchsorted(a_end, common), np.searchsorted(b_end, common)
        stop = np.searchsorted(common, np.cumsum(size)) + 1  # the end of a text is the end of a group
        pairs = np.array(b_ids, np.int64)[y] << 32 | np.array(a_ids, np.int64)[x]
        return good, (n_a, n_b, np.diff(stop, prepend=0), pairs, self._named(a_ids, b_ids, x, y, stop) if self.named else [])

    @staticmethod
    def _named(a_ids: list[int], b_ids: list[int], x: np.ndarray, y: np.ndarray, stop: np.ndarray) -> list[str]:
        a_text, b_text, groups, p, q = list(map(str, a_ids)), list(map(str, b_ids)), [], 0, 0
        for end_x, end_y in zip((x + 1).tolist(), (y + 1).tolist(), strict=True):
            groups.append((a_text[p] if end_x - p == 1 else ",".join(a_text[p:end_x])) + "|" + (b_text[q] if end_y - q == 1 else ",".join(b_text[q:end_y])))
            p, q = end_x, end_y
        stop = stop.tolist()
        return [";".join(groups[g:end]) for g, end in zip([0, *stop], stop, strict=False)]

    def parts(self, text: str) -> Iterator[list[str]]:
        """The segments of a text, by about PART characters at a time."""
        spaced, at = " " + text, 0
        while at < len(spaced):
            cut = _BREAK(spaced, at + PART) if len(spaced) - at > PART else None
            end = cut.start() if cut else len(spaced)
            yield SEGMENT(spaced[at:end])
            at = end

    def numbers(self, texts: list[str | None]) -> list[list[np.ndarray] | None]:
        """The numbers of the segments of each text, part by part; None for no text, or where a segment has no tokens."""
        out: list[list] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []

        def settle() -> None:
            known = self.known
            self.learn([w for w in set(itertools.chain.from_iterable(x for _, x in held)) if w not in known])
            for k, found in held:
                out[k].append(np.fromiter(map(known.__getitem__, found), np.int64, len(found)))
            held.clear()

        size = 0
        for k, text in enumerate(texts):
            for found in self.parts(text) if text else ():
                held.append((k, found))
                size += len(found)
                if size > PART // 8:
                    settle()
                    size = 0
        settle()
        return [None if not x or any(len(part) and part.min() < 0 for part in x) else x for x in out]

    def whole(self, text: str) -> tuple[int, int, int, np.ndarray, str] | None:
        """Tokens of A, of B, groups, pairs and the groups' ids of one text, by both libraries on the whole of it."""
        spaced = " " + text
        good, (n_a, n_b, n, pairs, named) = self.aligned([spaced], self._a_ids([spaced]), [self.model.encode(text)])
        return (int(n_a[0]), int(n_b[0]), int(n[0]), pairs, "".join(named)) if len(good) else None

    def links(self, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of `used`, pair) of all links of the segments numbered `used`."""
        *_, every, pairs = self.columns()
        end, n = np.cumsum(every), every[used]
        row = np.repeat(np.arange(len(used)), n)
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat((end - every)[used], n)
        return row, pairs[place]


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about 4 * PART characters, or of one longer text."""
    begin = size = 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size > 4 * PART:
            yield begin, k + 1
            begin, size = k + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


_made: dict[tuple[str, str, bool], Segments] = {}


def _segments(a_path: str, b_path: str, named: bool = True) -> Segments:
    """The one memo of a worker process."""
    if (a_path, b_path, named) not in _made:
        _made.clear()
        _made[a_path, b_path, named] = Segments(a_path, b_path, named)
    return _made[a_path, b_path, named]


def partial_counts(docs: DataFrame, a_path: str, b_path: str, memo_segments: int = MEMO_SEGMENTS) -> DataFrame:
    """(pair, n): links of each pair, added up within a task (or within a memo, where that starts anew)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, held, times = _segments(a_path, b_path, named=False), [], np.zeros(0, np.int64)

        def unique(pair: np.ndarray, n: np.ndarray) -> pd.DataFrame:
            values, place = np.unique(pair, return_inverse=True)
            total = np.zeros(len(values), np.int64)
            np.add.at(total, place, n)
            return pd.DataFrame({"pair": values, "n": total})

        def add() -> None:
            nonlocal held, times
            if held:
                got = np.bincount(np.concatenate(held), minlength=len(times))
                got[: len(times)] += times
                held, times = [], got

        def flush() -> pd.DataFrame:
            nonlocal times
            add()
            used = np.flatnonzero(times)
            row, pair = memo.links(used)
            out = unique(pair, times[used][row])
            times = np.zeros(0, np.int64)
            return out

        for b in batches:
            texts = b["text"].tolist()
            for begin, end in slices(texts):
                if memo.full(memo_segments):
                    yield flush()
                    memo.start()
                for text, parts in zip(texts[begin:end], memo.numbers(texts[begin:end]), strict=True):
                    if parts is not None:
                        held += parts
                    elif text and (found := memo.whole(text)) is not None:
                        yield unique(found[3], np.ones(len(found[3]), np.int64))
                add()
        yield flush()

    return docs.select("text").mapInPandas(run, "pair long, n long")


def count_runs(partial: DataFrame) -> DataFrame:
    """(pair, n): one row a pair, in ranges of pairs, sorted. `partial` is a stored table."""
    ranged = partial.repartitionByRange(width(partial.sparkSession), "pair").sortWithinPartitions("pair")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, total = None, 0
        for b in batches:
            if not len(b):
                continue
            pair, n = b["pair"].to_numpy(), b["n"].to_numpy()
            first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
            pair, n = pair[first], np.add.reduceat(n, first)
            if last == pair[0]:
                n[0] += total
            elif last is not None:
                yield pd.DataFrame({"pair": [last], "n": [total]})
            yield pd.DataFrame({"pair": pair[:-1], "n": n[:-1]})
            last, total = pair[-1], n[-1]
        if last is not None:
            yield pd.DataFrame({"pair": [last], "n": [total]})

    return ranged.mapInPandas(run, "pair long, n long")


def _file_system(uri: str):
    """(pyarrow file system, path) of a place in the shared folder."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def store_shards(counts: DataFrame, folder: str) -> DataFrame:
    """(first, last, n, path) of the files written to the shared `folder`: n sorted pairs, then their counts, as int64. `counts`
    is a stored table of sorted files. A file gets its name when it is whole, so a task that is lost leaves nothing."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = _file_system(folder)
        store.create_dir(top)
        held, size = [], 0

        def write() -> pd.DataFrame:
            pair, n = (np.concatenate([b[c].to_numpy(np.int64) for b in held]) for c in ("pair", "n"))
            name = uuid.uuid4().hex
            with store.open_output_stream(f"{top}/.{name}") as f:
                f.write(pair.tobytes())
                f.write(n.tobytes())
            store.move(f"{top}/.{name}", f"{top}/{name}")
            return pd.DataFrame({"first": pair[:1], "last": pair[-1:], "n": [len(pair)], "path": [f"{folder}/{name}"]})

        for whole in batches:
            falls = np.flatnonzero(np.diff(whole["pair"].to_numpy()) <= 0) + 1  # a batch may reach into the next file
            for begin, end in zip([0, *falls], [*falls, len(whole)], strict=True):
                b = whole[begin:end]
                if held and (size + len(b) > SHARD_PAIRS or len(b) and b["pair"].iloc[0] <= held[-1]["pair"].iloc[-1]):
                    yield write()
                    held, size = [], 0
                if len(b):
                    held.append(b)
                    size += len(b)
        if held:
            yield write()

    return counts.mapInPandas(run, "first long, last long, n long, path string")


class Shards:
    """Counts of pairs from files mapped into memory; a file is opened when a pair first falls into its range."""

    def __init__(self, catalog: list[tuple[int, int, int, str]]):
        self.catalog = sorted(catalog)
        self.maps: dict[str, np.ndarray] = {}

    def _map(self, path: str, n: int) -> np.ndarray:
        if path not in self.maps:
            store, place = _file_system(path)
            if store.type_name == "local":
                self.maps[path] = np.memmap(place, np.int64, "r", shape=(2, n))
            else:  # mapped from a nameless copy, which goes with the task
                copy = tempfile.TemporaryFile()
                with store.open_input_stream(place) as f:
                    shutil.copyfileobj(f, copy)
                copy.flush()
                self.maps[path] = np.memmap(copy, np.int64, "r", shape=(2, n))
        return self.maps[path]

    def counts(self, pairs: np.ndarray) -> np.ndarray:
        """The count of each pair; all must be known."""
        values, place = np.unique(pairs, return_inverse=True)
        found = np.zeros(len(values), np.int64)
        for first, last, n, path in self.catalog:
            a, b = np.searchsorted(values, first), np.searchsorted(values, last, "right")
            if a < b:
                shard = self._map(path, n)
                at = np.minimum(np.searchsorted(shard[0], values[a:b]), n - 1)
                found[a:b] += np.where(shard[0][at] == values[a:b], shard[1][at], 0)
        if len(values) and found.min() < 1:
            raise ValueError("a pair has no count: the documents changed between two scans")
        return found[place]


def align(docs: DataFrame, a_path: str, b_path: str, memo_segments: int = MEMO_SEGMENTS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row of `docs`.

    A encodes a space and the text, B the text, to which it adds the space; special strings in a text are text. NULL and
    empty texts, and those whose tokens do not give back the text, have no tokens: zeros and ''. Texts of any length are
    aligned whole; repeated rows each count, as rows and in the counts of pairs; of pairs with equal counts all are best.
    A NULL doc_id is kept; an empty table gives no rows; other columns are not read. Pairs are counted when the
    function is called, the second scan is lazy. `docs` must give the same texts in both scans.
    """
    spark = docs.sparkSession
    texts = numbered_texts(docs)
    counts = materialize(count_runs(materialize(partial_counts(texts, a_path, b_path, memo_segments), "pair-parts")), "pair-counts")
    folder = fresh_path(spark, "pair-shards")
    catalog = [tuple(r) for r in store_shards(counts, folder).collect()]  # one row a file
    b_id = F.shiftright("pair", 32)
    most = counts.groupBy(b_id.cast("int").alias("b")).agg(F.max("n").alias("n")).toPandas()  # at most the vocabulary of B
    best = np.zeros(int(most["b"].max()) + 1 if len(most) else 1, np.int64)
    best[most["b"].to_numpy(np.int64)] = most["n"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast((catalog, best))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, (catalog, best) = _segments(a_path, b_path), shared.value
        shards = Shards(catalog)
        looked = np.zeros((3, 0), np.int64)  # known, count_sum and n_best of each segment

        def scored(row: np.ndarray, pair: np.ndarray, n: int) -> np.ndarray:
            count, out = shards.counts(pair), np.zeros((2, n), np.int64)
            np.add.at(out[0], row, count)
            np.add.at(out[1], row, count == best[pair >> 32])
            return out

        def look(numbers: np.ndarray) -> None:
            nonlocal looked
            if looked.shape[1] < memo.size:
                looked = np.pad(looked, ((0, 0), (0, memo.size - looked.shape[1])))
            new = np.unique(numbers[looked[0, numbers] == 0])
            if len(new):
                looked[0, new] = 1
                looked[1:, new] = scored(*memo.links(new), len(new))

        def rows(b: pd.DataFrame, found: list) -> pd.DataFrame:
            """The rows of `b`; of each text the numbers of its segments, a row of its own, or None."""
            given = [np.concatenate(x) for x in found if isinstance(x, list)]
            if given:
                look(np.concatenate(given))
            columns = memo.columns()[:3]
            out = []
            for x in found:
                if isinstance(x, list):
                    named, first = hashlib.sha256(), True
                    for part in x:
                        if len(part):
                            named.update((("" if first else ";") + ";".join(map(memo.groups.__getitem__, part.tolist()))).encode())
                            first = False
                    every = np.concatenate(x)
                    sums = [int(c[every].sum()) for c in columns]
                    out.append((*sums, sums[2], int(looked[2, every].sum()), int(looked[1, every].sum()), named.hexdigest()))
                else:
                    out.append(x or (0, 0, 0, 0, 0, 0, ""))
            frame = pd.DataFrame(out, columns=["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
            frame.insert(0, "doc_id", b["doc_id"].to_numpy())
            frame.insert(1, "no_id", b["no_id"].to_numpy())
            return frame

        for b in batches:
            texts = b["text"].tolist()
            for begin, end in slices(texts):
                if memo.full(memo_segments):
                    memo.start()
                    looked = np.zeros((3, 0), np.int64)
                found = memo.numbers(texts[begin:end])
                for k, text in enumerate(texts[begin:end]):
                    if text and found[k] is None and (got := memo.whole(text)) is not None:
                        n_a, n_b, n, pairs, named = got
                        total, top = scored(np.zeros(len(pairs), np.int64), pairs, 1)[:, 0].tolist()
                        found[k] = (n_a, n_b, n, len(pairs), top, total, hashlib.sha256(named.encode()).hexdigest())
                yield rows(b[begin:end], found)

    schema = "doc_id long, no_id boolean, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return with_missing_ids(texts.mapInPandas(run, schema))
