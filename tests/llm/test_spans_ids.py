"""Replacing very many spans, terms whose case changes their length, ids at the ends of their range."""

import random
import time

import pytest
from pyspark.sql import functions as F

from barloom.llm import byterepeats, pii, spans

SPANS = spans.SPAN_TYPE


def replaced(text, found):
    """One span after the other, by hand."""
    out, at = "", 0
    merged = []
    for start, _, end, _ in found:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    for start, end in merged:
        out += text[at:start] + f"<{end - start}>"
        at = end
    return out + text[at:]


@pytest.mark.parametrize("seed", range(4))
def test_replace(spark, seed):
    r = random.Random(seed)
    rows = []
    for n in (0, 1, 3, 40, 700, 3000):
        text = "".join(r.choice("ab é🙂\n") for _ in range(r.choice([30, 5000, 20000])))
        found = sorted((a := r.randrange(len(text)), r.randrange(3), min(len(text), a + r.choice([1, 3, 30])), "v") for _ in range(n))
        rows.append((text, found))
    df = spark.createDataFrame(rows, f"text string, found {SPANS}")
    got = df.select("text", spans.replace(F.col("text"), F.col("found"), lambda s: F.concat(F.lit("<"), (s["end"] - s["start"]).cast("string"), F.lit(">"))).alias("t")).collect()
    assert {x["text"]: x["t"] for x in got} == {t: replaced(t, f) for t, f in rows}


def test_a_hundred_thousand_spans_in_one_text(spark):
    n = 100_000
    df = spark.range(1).select(F.repeat(F.lit("a b c d "), n).alias("text"), F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.struct((k * 8).cast("int").alias("start"), F.lit(0).alias("kind"), (k * 8 + 1).cast("int").alias("end"), F.lit("a").alias("value"))).alias("found"))
    begun = time.time()
    t = df.select(spans.replace(F.col("text"), F.col("found"), lambda s: F.lit("<X>")).alias("t")).first()["t"]
    assert t == "<X> b c d " * n and time.time() - begun < 60


def test_terms_whose_lower_case_is_longer(spark):
    rows = [(k, f"{'İstanbul' if k % 2 else 'istanbul'} reach me at shared@example.org in {'abcdefgh'[k % 8]}") for k in range(8)]
    rows += [(100 + k, f"nothing {k} to see here") for k in range(300)]
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.scan(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert all(got[k].startswith("removed:0:8") for k in range(8)), got[1]


def test_ids_at_the_ends_of_their_range(spark):
    text = "".join(random.Random(3).choices("abcdefghij ", k=240))
    ids = [-(1 << 62), -(1 << 63), (1 << 63) - 1, 0]
    got = {r["doc_id"]: r["n_removed"] for r in byterepeats.digest(byterepeats.remove_repeats(spark.createDataFrame([(i, text) for i in ids], "doc_id long, text string"))).collect()}
    n = len(text)
    assert got == {-(1 << 63): 0, -(1 << 62): n, 0: n, (1 << 63) - 1: n}
    got = {r["doc_id"]: r["n_removed"] for r in byterepeats.digest(byterepeats.remove_repeats(spark.createDataFrame([(None, text), (-(1 << 62), text), (5, text)], "doc_id long, text string"))).collect()}
    assert got == {None: 0, -(1 << 62): n, 5: n}
