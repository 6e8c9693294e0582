"""Best-fit packing of token sequences (operator 7).

A configuration is a multiset of piece lengths that fits one sequence. The covering linear program over the
length histogram (at most `capacity` numbers, so it fits the driver whatever the corpus) is solved by
multiplicative weights: each round prices configurations with an unbounded-knapsack dynamic program, lowers the
weights of what they cover. Configurations are then taken in whole numbers, most used first, as often as the plan uses
them and the pieces left allow; the program is solved again on what is left, and the last rest is packed best fit, all on
the histogram. The plan maps (length, rank among pieces of that
length) to (sequence, offset), so assigning is one pass over the pieces; only their (length, bucket) ranks need a shuffle,
of a few bytes a piece.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import materialize, numbered_texts, with_missing_ids
from barloom.llm.wordmemo import LowerWordIds, memo

PIECES = "doc_id long, no_id boolean, piece int, start long, length long, ids_crc32 long"
COLUMNS = ["doc_id", "no_id", "piece", "start", "length", "ids_crc32"]
#: How often the program is solved again on what its whole configurations leave, and the rounds of each of these.
AGAIN, AGAIN_ROUNDS = 6, 10
#: At how many places the list of whole configurations is tried to end before best fit takes over.
CUTS = 24
#: Pieces of one length that are ranked in one group.
BUCKET_ROWS = 50_000


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = 0) -> DataFrame:
    """Each document's ids, then `end_id`, cut at multiples of `capacity`; no_id marks a missing doc_id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = memo(LowerWordIds, tokenizer_path).ids
        end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity
        for b in batches:
            sizes, sums = np.empty(len(b), np.int64), []
            for k, text in enumerate(b["text"]):
                data = ids(text) + end
                sizes[k] = len(data) // 4
                sums += [zlib.crc32(data[at : at + step]) for at in range(0, len(data), step)]
            n = -(-sizes // capacity)
            row = np.repeat(np.arange(len(b)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            yield pd.DataFrame(
                {
                    "doc_id": b["doc_id"].to_numpy()[row],
                    "no_id": b["no_id"].to_numpy()[row],
                    "piece": piece.astype(np.int32),
                    "start": start,
                    "length": np.minimum(capacity, sizes[row] - start),
                    "ids_crc32": np.array(sums, np.int64),
                }
            )

    return numbered_texts(docs).mapInPandas(run, PIECES)


def _prices(value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack over the lengths with a value: (greatest value, length that it takes) for each room."""
    best, pick = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    lengths = np.flatnonzero(value > 0)
    gain = value[lengths]
    for room, n in zip(range(capacity + 1), np.searchsorted(lengths, np.arange(capacity + 1), "right").tolist(), strict=True):
        if n:
            total = best[room - lengths[:n]] + gain[:n]
            k = int(total.argmax())
            best[room], pick[room] = total[k], lengths[k]
    return best, pick


def _filled(pick: np.ndarray, first: int, room: int) -> tuple[tuple[int, int], ...]:
    """The configuration of length `first` and the best use of the room beside it, as (length, times) pairs."""
    counts = {first: 1}
    while room > 0 and pick[room]:
        counts[int(pick[room])] = counts.get(int(pick[room]), 0) + 1
        room -= pick[room]
    return tuple(sorted(counts.items()))


def fractional(need: np.ndarray, capacity: int, rounds: int, eps: float = 0.1, gap: float = 0.002) -> dict[tuple[tuple[int, int], ...], float]:
    """Configurations and how often each is used in a fractional plan as large as `need`, counted in tokens.

    Each round prices every length by its weight, takes for each length the best configuration that holds it and, of
    these, those nearly as good as the best; the weights of what they cover fall. The weights over the price of
    the best configuration are a dual solution, so their value bounds every plan from below: rounds end there, or after
    `rounds`. Short lengths, which fill gaps everywhere, are covered several times over; rounding leaves the excess out.
    """
    lengths = np.flatnonzero(need)
    weight = np.zeros(capacity + 1)
    weight[lengths] = lengths / capacity
    covered, used, spent, bound = np.zeros(capacity + 1), {}, 0.0, 0.0
    for _ in range(rounds):
        best, pick = _prices(weight, capacity)
        bound = max(bound, float(weight @ need) / best[capacity])
        total = weight[lengths] + best[capacity - lengths]
        added = np.zeros(capacity + 1)
        for config in {_filled(pick, int(x), capacity - int(x)) for x in lengths[total >= (1 - eps / 2) * best[capacity]]}:
            ls, cs = np.array(config).T
            times = float((need[ls] / cs).min()) * eps
            used[config] = used.get(config, 0.0) + times
            spent += times
            added[ls] += times * cs
        covered += added
        weight[lengths] *= np.exp(-np.minimum(added[lengths] / need[lengths], 1.0))
        weight /= weight.max()
        weight[lengths] = np.maximum(weight[lengths], 1e-12)
        least = float((covered[lengths] / need[lengths]).min())
        if least > 0 and spent / least <= (1 + gap) * bound:
            break
    scale = float(covered[lengths] @ lengths) / float(need[lengths] @ lengths)
    return {config: x / scale for config, x in used.items()}


def rounded(need: np.ndarray, capacity: int, rounds: int) -> tuple[list[tuple[dict[int, int], int]], np.ndarray]:
    """Whole configurations that `need` holds, least waste first, and the pieces beside them.

    A configuration is taken as often as the plan uses it, at least once, if the pieces left allow it.
    """
    left, plan = need.copy(), []
    for k in range(1 + AGAIN):
        before = int(left.sum())
        for config, x in sorted(fractional(left, capacity, AGAIN_ROUNDS if k else rounds).items(), key=lambda kv: (-kv[1], kv[0])):
            times = min(max(1, int(x)), *(int(left[length]) // n for length, n in config))
            if times:
                for length, n in config:
                    left[length] -= times * n
                plan.append((dict(config), times))
        if not left.any() or left.sum() == before:
            break
    plan.sort(key=lambda c: capacity - sum(length * n for length, n in c[0].items()))
    return plan, left


def best_fit(histogram: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best fit decreasing, all pieces of a length at once: (configuration, times) pairs.

    Sequences with the same contents are one group. A length goes to the groups with the least room that
    takes it, as often as it fits, as piece by piece best fit would do.
    """
    left = {}  # room: groups of (configuration, times)
    rooms: list[int] = []
    done: list[tuple[dict[int, int], int]] = []

    def put(config: dict[int, int], times: int, room: int) -> None:
        if not room:
            done.append((config, times))
            return
        if room not in left:
            insort(rooms, room)
        left.setdefault(room, []).append((config, times))

    for length in np.flatnonzero(histogram)[::-1].tolist():
        n = int(histogram[length])
        while n:
            at = bisect_left(rooms, length)
            room = rooms[at] if at < len(rooms) else capacity
            most = room // length
            config, times = left[room].pop() if at < len(rooms) else ({}, -(-n // most))
            if at < len(rooms) and not left[room]:
                del left[room], rooms[at]
            whole = min(times, n // most)
            if whole:
                put(config | {length: most}, whole, room - most * length)
                n, times = n - whole * most, times - whole
            if times and n:  # the last, partly filled one
                put(config | {length: n}, 1, room - n * length)
                n, times = 0, times - 1
            if times and config:
                put(config, times, room)
    return done + [g for groups in left.values() for g in groups]


def solve(histogram: np.ndarray, capacity: int, rounds: int = 40) -> list[tuple[np.ndarray, int]]:
    """(counts by length, times) whose sum is the histogram; histogram[l] is the number of pieces of length l.

    The program's whole configurations, then best fit. Its most wasteful ones are left to best fit where that needs
    fewer sequences: of CUTS + 1 places to end the list, the one with the fewest sequences is taken, of these the last. None of
    the list is one of them, so the plan is never longer than best fit alone.
    """
    need = histogram.astype(np.int64).copy()
    need[capacity] = 0  # a full piece is a sequence by itself
    plan: list[tuple[dict[int, int], int]] = []
    if need.any():
        whole, left = rounded(need, capacity, rounds)
        end, fewest = len(whole), None
        for at in sorted({len(whole) * k // CUTS for k in range(CUTS + 1)}, reverse=True):
            for config, times in whole[at:end]:
                for length, n in config.items():
                    left[length] += n * times
            end = at
            tried = best_fit(left, capacity)
            total = sum(t for _, t in whole[:at]) + sum(t for _, t in tried)
            if fewest is None or total < fewest:
                plan, fewest = whole[:at] + tried, total
    if histogram[capacity]:
        plan.append(({capacity: 1}, int(histogram[capacity])))
    out = []
    for config, times in plan:
        counts = np.zeros(capacity + 1, np.int64)
        counts[list(config)] = list(config.values())
        out.append((counts, times))
    return out


def slots(plan: list[tuple[np.ndarray, int]], capacity: int) -> dict[str, np.ndarray]:
    """Rank ranges by length, sorted for a binary search on length * 2**40 + rank."""
    rows, taken, sequence = [], np.zeros(capacity + 1, np.int64), 0
    for config, times in plan:
        offset = 0
        for length in np.flatnonzero(config)[::-1]:
            n = int(config[length])
            rows.append((int(length), int(taken[length]), sequence, n, offset))
            taken[length] += n * times
            offset += n * int(length)
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {"key": (table[:, 0] << 40) + table[:, 1], "first": table[:, 1], "sequence": table[:, 2], "n": table[:, 3], "offset": table[:, 4]}


def pack(pieces: DataFrame, capacity: int = 2048, rounds: int = 40) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces with a `length` from 1 to `capacity`.

    `pieces` is read twice and must be stored, with a number `row` of its own for each piece. Ties in length are broken
    by bucket, doc_id and row. An empty table gives no rows. Pieces of one length are ranked in buckets of about
    BUCKET_ROWS by a hash of row, so no task holds a length, or a doc_id, that many pieces share.
    """
    spark = pieces.sparkSession
    histogram = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most `capacity` rows
        histogram[r["length"]] = r["count"]
    plan = spark.sparkContext.broadcast(slots(solve(histogram, capacity, rounds), capacity))
    parts = spark.createDataFrame([(int(n), -(-int(histogram[n]) // BUCKET_ROWS)) for n in np.flatnonzero(histogram)], "length long, _parts long")
    bucketed = pieces.join(F.broadcast(parts), "length").withColumn("_bucket", F.pmod(F.xxhash64("row"), "_parts"))
    sizes = bucketed.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = sizes.select(
        "length", "_bucket", (F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("_n")).alias("_before")
    )
    ranked = bucketed.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "no_id", "piece", "row")) - 1)
    ranked = ranked.join(before, ["length", "_bucket"]).withColumn("_rank", F.col("_rank") + F.col("_before"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = plan.value
        for b in batches:
            length, rank = b["length"].to_numpy(np.int64), b["_rank"].to_numpy(np.int64)
            at = np.searchsorted(p["key"], (length << 40) + rank, "right") - 1
            within = rank - p["first"][at]
            yield pd.DataFrame(
                {
                    **{c: b[c] for c in COLUMNS},
                    "sequence_id": p["sequence"][at] + within // p["n"][at],
                    "offset": p["offset"][at] + within % p["n"][at] * length,
                }
            )

    return with_missing_ids(ranked.select(*COLUMNS, "_rank").mapInPandas(place, PIECES + ", sequence_id long, offset long"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048) -> DataFrame:
    """One row for each piece of each document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    NULL and empty texts are one piece that holds only the end id. Repeated rows are packed each. Other columns
    are ignored, an empty table gives no rows, a NULL doc_id is kept as it is. Documents beyond `capacity`, however
    long, are cut into full pieces and a last one; all others stay whole. Ties in length are broken by bucket and doc_id.
    """
    pieces = tokenize_pieces(docs, tokenizer_path, capacity).withColumn("row", F.monotonically_increasing_id())
    return pack(materialize(pieces, "pieces"), capacity)
