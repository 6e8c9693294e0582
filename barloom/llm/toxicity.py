"""Toxic spans and document scores by a linear-chain conditional random field (operator 8).

The table labels documents, not tokens. Token labels are derived: in a toxic training document a token is labelled
toxic if it or one of its prefixes occurs in toxic training documents far more often than chance allows and
hardly ever in clean ones. A two-state chain (clean, toxic) with word and prefix features and a transition matrix
is trained on these tokens by maximum likelihood with exact forward-backward gradients. Scoring runs
forward-backward over every whole text; the document's evidence is -sum log(1 - marginal), calibrated to a
probability by a logistic fit on the training documents, and tokens over a marginal of 0.5 give the spans.

Fitting reads at most `max_train` labelled documents (the lowest hashes of doc_id), in one task; the number is a
parameter and bounds both the time and the memory of the fit. Everything else covers all rows.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import numbered_texts, whole_texts, with_missing_ids

MAX_TRAIN = 3000
_words = re.compile(r"[^\t-\r ]+")
_edges = re.compile(r"^[^\w]+|[^\w]+$")


def features(word: str) -> list[str]:
    core = _edges.sub("", word).lower()
    return [f"w:{core}", *(f"{n}:{core[:n]}" for n in (4, 5, 6) if len(core) > n)]


class Lengths:
    """Order of the positions of a batch of sequences for steps that handle all sequences at once."""

    def __init__(self, lengths: np.ndarray):
        self.start = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        order = np.argsort(-lengths, kind="stable")
        self.first, self.length = self.start[order], lengths[order]
        rising = np.sort(lengths)
        self.active = len(lengths) - np.searchsorted(rising, np.arange(int(lengths.max(initial=0))), "right")


def marginals(emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray, initial: float):
    """Log-odds of toxic by forward and by backward steps: (forward incl. emission, backward)."""
    at = Lengths(lengths)
    (t00, t01), (t10, t11) = np.exp(trans)
    forward, backward = np.empty_like(emit), np.zeros_like(emit)
    prev = None
    for t, n in enumerate(at.active):
        where = at.first[:n] + t
        if t == 0:
            prev = emit[where] + initial
        else:
            odds = np.exp(np.clip(prev[:n], -40, 40))
            prev = emit[where] + np.log((odds * t11 + t01) / (odds * t10 + t00))
        forward[where] = prev
    last = at.first + at.length - 1
    for t, n in enumerate(at.active):
        if t == 0:
            continue
        where = last[:n] - t
        odds = np.exp(np.clip(emit[where + 1] + backward[where + 1], -40, 40))
        backward[where] = np.log((t10 + odds * t11) / (t00 + odds * t01))
    return forward, backward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _fresh(texts: list[str]) -> list[int]:
    """Rows that are not mostly made of five-word shingles met before: copies would count one passage many times."""
    met: set[int] = set()
    kept = []
    for k, t in enumerate(texts):
        w = _words.findall(t)
        own = {hash(tuple(w[i : i + 5])) for i in range(max(1, len(w) - 4))}
        if 2 * len(own & met) <= len(own):
            kept.append(k)
        met |= own
    return kept


def fit(texts: list[str], labels: list[int], rounds: int = 60) -> dict:
    """The model: feature weights, transition matrix, initial log-odds, calibration."""
    kept = _fresh(texts)
    tokens = [_words.findall(texts[k]) for k in kept]
    toxic = np.array([labels[k] for k in kept], bool)
    base = {"weights": {}, "bias": -20.0, "trans": np.zeros((2, 2)), "initial": 0.0, "scale": 0.0, "shift": float(np.log((toxic.sum() + 0.5) / ((~toxic).sum() + 0.5))) if len(toxic) else 0.0}
    if not toxic.any() or toxic.all():
        return base
    vocabulary: dict[str, int] = {}
    ids = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in ws], np.int64) for ws in tokens]
    names: dict[str, int] = {}
    by_word = [[names.setdefault(f, len(names)) for f in features(w)] for w in vocabulary]
    flat = np.array([f for fs in by_word for f in fs], np.int64)
    owner = np.repeat(np.arange(len(by_word)), [len(fs) for fs in by_word])
    counts = [np.zeros(len(names)), np.zeros(len(names))]
    for x, t in zip(ids, toxic, strict=True):
        counts[int(t)][list({f for w in set(x.tolist()) for f in by_word[w]})] += 1
    rate = toxic.mean()
    surprise = counts[1] * np.log(1 / rate) - counts[0] * 4
    seeds = (surprise > np.log(max(len(names), 5) / 5)) & (counts[1] / toxic.sum() > 20 * (counts[0] + 0.25) / (~toxic).sum())
    seeded = np.zeros(len(by_word), bool)
    np.logical_or.at(seeded, owner, seeds[flat])

    lengths = np.array([len(x) for x in ids], np.int64)
    used = lengths > 0
    x = np.concatenate([*[i for i in ids if len(i)], np.empty(0, np.int64)])
    lengths, of = lengths[used], np.repeat(toxic[used], lengths[used])
    y = (seeded[x] & of).astype(float)
    start = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    inner = np.ones(len(x), bool)
    inner[start] = False
    nxt = np.flatnonzero(inner)  # positions with a predecessor
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[nxt - 1].astype(int), y[nxt].astype(int)), 1)
    share = min(max(y.mean(), 1e-6), 0.5)
    weight, bias, trans, initial = np.zeros(len(names)), float(np.log(share / (1 - share))), np.zeros((2, 2)), 0.0
    moments = [[np.zeros(len(names)), np.zeros(len(names))], [0.0, 0.0], [np.zeros((2, 2)), np.zeros((2, 2))], [0.0, 0.0]]
    for k in range(1, rounds + 1):
        per_word = np.bincount(owner, weight[flat], len(by_word)) + bias
        emit = per_word[x]
        f, b = marginals(emit, lengths, trans, initial)
        p = _sigmoid(f + b)
        # pairs: P(a, c) is alpha(t-1, a) T(a, c) e(t, c) beta(t, c), normalised
        one, two = f[nxt - 1], emit[nxt] + b[nxt]
        joint = np.exp(np.clip(np.stack([np.zeros_like(one) + trans[0, 0], two + trans[0, 1], one + trans[1, 0], one + two + trans[1, 1]]), -80, 80))
        joint = (joint / joint.sum(0)).sum(1).reshape(2, 2)
        gap = y - p
        grads = [
            np.bincount(flat, np.bincount(x, gap, len(by_word))[owner], len(names)) - 0.5 * weight,
            float(gap.sum()),
            seen - joint - 0.01 * trans,
            float(gap[start].sum()),
        ]
        steps = []
        for g, m in zip(grads, moments, strict=True):  # Adam
            m[0] = 0.8 * m[0] + 0.2 * g
            m[1] = 0.95 * m[1] + 0.05 * g * g
            steps.append(0.25 * (m[0] / (1 - 0.8**k)) / (np.sqrt(m[1] / (1 - 0.95**k)) + 1e-8))
        weight, bias, trans, initial = weight + steps[0], bias + steps[1] * 0.4, trans + 0.4 * steps[2], initial + 0.4 * steps[3]
    per_word = np.bincount(owner, weight[flat], len(by_word)) + bias
    f, b = marginals(per_word[x], lengths, trans, initial)
    heavy = np.add.reduceat(np.log1p(-np.minimum(_sigmoid(f + b), 1 - 1e-9)), start) if len(start) else np.empty(0)
    z = np.full(len(toxic), np.log(1e-4))
    z[used] = np.log(1e-4 - heavy)
    scale, shift = 0.0, base["shift"]
    target = np.where(toxic, (toxic.sum() + 1) / (toxic.sum() + 2), 1 / ((~toxic).sum() + 2))  # Platt's targets
    for _ in range(50):
        q = _sigmoid(scale * z + shift)
        v = q * (1 - q) + 1e-9
        h = np.array([[(v * z * z).sum() + 1e-3, (v * z).sum()], [(v * z).sum(), v.sum() + 1e-3]])
        step = np.linalg.solve(h, np.array([((target - q) * z).sum(), (target - q).sum()]))
        scale, shift = scale + float(np.clip(step[0], -1, 1)), shift + float(np.clip(step[1], -2, 2))
    strong = np.flatnonzero(np.abs(weight) > 1e-4)
    listed = list(names)
    return {"weights": {listed[k]: float(weight[k]) for k in strong}, "bias": bias, "trans": trans, "initial": initial, "scale": scale, "shift": shift}


class Scorer:
    def __init__(self, model: dict):
        self.model, self.known = model, {}

    def _emit(self, word: str) -> float:
        w = self.model["weights"]
        return self.model["bias"] + sum(w.get(f, 0.0) for f in features(word))

    def evidence(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score of each text, marginals of all its words one text after the other, words of each text)."""
        known, parts, lengths = self.known, [], np.empty(len(texts), np.int64)
        if len(known) > 500_000:
            known.clear()
        for k, t in enumerate(texts):
            ws = _words.findall(t)
            for w in ws:
                if w not in known:
                    known[w] = self._emit(w)
            lengths[k] = len(ws)
            parts.append(np.fromiter(map(known.__getitem__, ws), float, len(ws)))
        emit = np.concatenate([*parts, np.empty(0)])
        used = lengths > 0
        f, b = marginals(emit, lengths[used], self.model["trans"], self.model["initial"])
        p = _sigmoid(f + b)
        z = np.full(len(texts), np.log(1e-4))
        if used.any():
            start = np.concatenate([[0], np.cumsum(lengths[used])[:-1]]).astype(np.int64)
            z[used] = np.log(1e-4 - np.add.reduceat(np.log1p(-np.minimum(p, 1 - 1e-9)), start))
        return _sigmoid(self.model["scale"] * z + self.model["shift"]), p, lengths


def train(docs: DataFrame, labels: DataFrame, usable=None, max_train: int = MAX_TRAIN) -> dict:
    """Fits on at most `max_train` labelled documents for which `usable` (a column over doc_id) holds.

    Their ids (a bounded number) are broadcast to the documents; their texts meet in one task, which fits. Rows
    with a NULL label or doc_id are not used; of several labels of one doc_id the greatest counts, of several texts the
    first in order; repeated rows are one by then. Without labels, or documents, the model scores every text alike.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("_toxic")).dropna()
    if usable is not None:
        known = known.filter(usable(F.col("_id")))
    known = known.groupBy("_id").agg(F.max("_toxic").alias("_toxic")).orderBy(F.xxhash64("_id"), "_id").limit(max_train)
    met = whole_texts(docs).join(F.broadcast(known), F.col("doc_id") == F.col("_id"))
    rows = met.groupBy("doc_id", "_toxic").agg(F.min("text").alias("text")).repartition(1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = pd.concat([*batches, pd.DataFrame({"doc_id": [], "text": [], "_toxic": []})]).sort_values("doc_id")
        yield pd.DataFrame({"model": [pickle.dumps(fit(got["text"].tolist(), got["_toxic"].astype(int).tolist()))]})

    row = rows.mapInPandas(run, "model binary").first()  # an empty input may leave no task to run
    return pickle.loads(row["model"]) if row else fit([], [])


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score, spans (array of start, end, probability: code points of words with a marginal over 0.5).

    NULL and empty texts get the score of no evidence; texts of any length are read whole; repeated rows are scored
    each; a NULL doc_id is kept; an empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for whole in batches:
            for at in range(0, len(whole), 2000):
                b = whole.iloc[at : at + 2000]
                texts = b["text"].tolist()
                s, p, lengths = scorer.evidence(texts)
                ends, spans = np.cumsum(lengths), [[] for _ in texts]
                for k in np.flatnonzero(p > 0.5):
                    row = int(np.searchsorted(ends, k, "right"))
                    spans[row].append(int(k - ends[row] + lengths[row]))
                for row, hits in enumerate(spans):
                    if hits:
                        places = [m.span() for m in _words.finditer(texts[row])]
                        first = int(ends[row] - lengths[row])
                        spans[row] = [{"start": places[h][0], "end": places[h][1], "probability": float(p[first + h])} for h in hits]
                yield pd.DataFrame({"doc_id": b["doc_id"].to_numpy(), "no_id": b["no_id"].to_numpy(), "score": s, "spans": spans})

    return with_missing_ids(numbered_texts(docs).mapInPandas(run, "doc_id long, no_id boolean, score double, spans array<struct<start:int,end:int,probability:double>>"))


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from rows that are not held out and scores all."""
    model = train(docs, labels, lambda i: ~held_out(i))
    return score(docs, model).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("spans").cast("long").alias("n_spans")
    )
