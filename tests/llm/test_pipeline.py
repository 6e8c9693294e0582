"""The pipeline against a brute-force version on the smallest tables."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from barloom.llm import queries, secrets
from tests.conftest import SF

WORD = re.compile(r"[^\x20\t-\r]+")


def _kept(t):
    w = WORD.findall(t)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    repeat = len({j for i, x in enumerate(windows) if n[x] > 1 for j in range(i, i + 5)})
    if len(w) < 10 or 100 * repeat > 20 * len(w):
        return False
    lines = [x for x in t.split("\n") if WORD.search(x)]
    loud = sum(bool(re.search("[A-ZÀ-ÖØ-Þ].*[A-ZÀ-ÖØ-Þ]", x)) and not any(c.islower() for c in x) for x in w)
    stutter = sum(a == b for a, b in zip(w, w[1:], strict=False))
    chars = sum(map(len, w))
    return not (
        100 * len(re.findall(r"[#*$%&|<>]", t)) > 10 * len(w)
        or 100 * (len(lines) - len(set(lines))) > 50 * len(lines)
        or not 2 * len(w) <= chars <= 15 * len(w)
        or 100 * loud > 50 * len(w)
        or 100 * stutter > 30 * len(w)
    )


def _similar(a, b):
    x, y = (Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) for w in (WORD.findall(a), WORD.findall(b)))
    both = sum((x & y).values())
    return both / (sum(x.values()) + sum(y.values()) - both)


def _redacted(t):
    found = []
    for r in secrets.BASE + secrets.MORE:
        found += [m.span() + (r.name,) for m in re.finditer(r.regex, t) if len(m[r.group]) >= r.least]
    found.sort()
    out, at = [], 0
    for s, e, name in found:
        if s >= at:
            out += [t[at:s], f"<{name.upper()}>"]
        at = max(at, e)
    return "".join([*out, t[at:]])


def test_run_against_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r["text"] and _kept(r["text"])}
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    root = {k: k for k in docs}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in docs:
        for b in docs:
            if a < b and find(a) != find(b) and _similar(docs[a], docs[b]) >= 0.8:
                root[max(find(a), find(b))] = min(find(a), find(b))
    left = {k: _redacted(t) for k, t in docs.items() if find(k) == k and not any(i in t for i in items)}
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for k, t in left.items():
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 0], "<u4")
        for p in range(0, len(ids), 2048):
            want[k, p // 2048] = zlib.crc32(ids[p : p + 2048].tobytes())
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {(r["doc_id"], r["piece"]): r["ids_crc32"] for r in rows} == want
    ends = Counter()
    for r in rows:
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 2048


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF).dtypes == docs.dtypes


def test_oracles(spark):
    db = duckdb.connect()
    for table in ("documents", "benchmark"):
        db.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        got = queries.QUERIES[name](spark, SF)
        names = sorted(got.columns)
        want = db.execute(f"select {', '.join(names)} from ({sql}) x").fetchall()
        assert sorted(map(tuple, got.select(names).collect())) == sorted(want), name


def test_hostile_tables(spark, tmp_path):
    big = (1 << 60) + 7
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    clean = [f"the {k} river " + " ".join(f"word{k}x{j}" for j in range(60)) for k in range(6)]
    bad = clean[4] + " " + item
    rows = [(1, clean[0]), (1, clean[1]), (1, clean[2]), (None, clean[0]), (None, clean[3]), (None, bad), (None, None), (None, ""), (big, clean[5]), (big, clean[5]), (big + 1, clean[5] + " end")]
    df = spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        kept.append(sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str))
    left = sorted([(1, clean[0]), (1, clean[1]), (1, clean[2]), (None, clean[3]), (None, bad), (big, clean[5])], key=str)
    assert len(kept[0]) == 9 and kept[1] == left and kept[2] == kept[3] == [x for x in left if x[1] != bad]
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r["doc_id"] for r in out) == {1: 3, None: 1, big: 1}
    df.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
