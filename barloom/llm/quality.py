"""Quality rules as a short-circuit cascade (operator 6). DataFrame functions only, no shuffle.

The base statistics of a document come from its whole text. The cascade holds further rules; each rule's cost
(seconds of a job over a stored sample) and selectivity (share of the sample that it rejects) are measured, and
rules run in order of rejection per cost inside one conditional expression, so a rule that needs its own pass
over the words runs only for documents that every rule before it let through. The order never changes a verdict.

NULL and empty texts have no words and fail the base test; repeated rows are judged each; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import materialize, whole_texts

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
SAMPLE_ROWS = 2000


@dataclass(frozen=True)
class Rule:
    """`reject` is a boolean column over the columns of `statistics`."""

    name: str
    reject: Column


def _share(count: Column, whole: Column, percent: int) -> Column:
    """True where `count` is over `percent` % of `whole`."""
    return 100 * count > percent * whole


def rules() -> list[Rule]:
    words, n = F.col("_words"), F.col("n_words")
    shouted = F.size(F.filter(words, lambda w: w.rlike(r"\p{Lu}.*\p{Lu}") & ~w.rlike(r"\p{Ll}")))
    stutter = F.size(F.filter(words, lambda w, i: w == F.coalesce(F.get(words, i - 1), F.lit(""))))
    return [
        Rule("symbols", _share(F.col("n_symbols"), n, 10)),
        Rule("repeated_lines", _share(F.col("n_dup_lines"), F.col("_n_lines"), 50)),
        Rule("word_length", (F.col("word_chars") > 15 * n) | (F.col("word_chars") < 2 * n)),
        Rule("shouting", _share(shouted, n, 50)),
        Rule("stutter", _share(stutter, n, 30)),
    ]


def statistics(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id, text, the base statistics and the arrays that the rules read; with `carry` the input row as _row."""
    more = ["_row"] if carry else []
    d = whole_texts(docs, carry).select(
        "doc_id",
        "text",
        *more,
        F.array_remove(F.split("text", SPACE), "").alias("_words"),
        F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0).alias("_lines"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    words = F.col("_words")
    d = d.select(
        "doc_id",
        "text",
        *more,
        "_words",
        F.size("_words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("_lines").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("_words") >= WINDOW,
            F.transform(F.sequence(F.lit(0), F.size("_words") - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])),
        ).alias("_windows"),
    )
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    d = d.withColumn(
        "_sorted", F.when(repeated, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    ).drop("_windows")
    s = F.col("_sorted")

    def met_again(e: Column, j: Column) -> Column:
        return (e["h"] == F.get(s, j - 1)["h"]) | (e["h"] == F.get(s, j + 1)["h"])

    starts = F.sort_array(F.transform(F.filter(s, lambda e, j: F.coalesce(met_again(e, j), F.lit(False))), lambda e: e["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_sorted").withColumn(
        "base_failed", (F.col("n_words") < 10) | _share(F.col("n_repeat_words"), F.col("n_words"), 20)
    )


def ranked(docs: DataFrame, found: list[Rule]) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) by rejection per cost on about SAMPLE_ROWS rows, spread by a hash of doc_id.

    The sample serves this order alone; every document is judged by every rule that it reaches.
    """
    n = docs.count()
    every = max(1, math.ceil(n / SAMPLE_ROWS))
    part = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    sample = materialize(statistics(part).drop("text"), "quality-sample").filter(~F.col("base_failed"))
    timed = []
    for rule in found:
        began = time.perf_counter()
        row = sample.agg(F.count("*").alias("n"), F.count_if(rule.reject).alias("k")).first()
        timed.append((rule, time.perf_counter() - began, row["k"] / max(row["n"], 1)))
    return sorted(timed, key=lambda x: (-x[2] / max(x[1], 1e-6), x[0].name))


def judge(docs: DataFrame, found: list[Rule] | None = None, carry: bool = False) -> DataFrame:
    """statistics() with `rejected_by` (NULL: none) and `kept`."""
    order = [r for r, _, _ in ranked(docs, rules() if found is None else found)]
    verdict = F.when(F.col("base_failed"), F.lit("base"))
    for rule in order:
        verdict = verdict.when(rule.reject, F.lit(rule.name))
    return statistics(docs, carry).withColumn("rejected_by", verdict).withColumn("kept", F.col("rejected_by").isNull())


def digest(judged: DataFrame) -> DataFrame:
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), s AS (
  SELECT doc_id, words, lines, len(words)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    len(list_filter(words, lambda x: regexp_matches(x, '\p{Lu}.*\p{Lu}') AND NOT regexp_matches(x, '\p{Ll}'))) AS shouted,
    len(list_filter(list_zip(words[2:], words), lambda p: p[1] IS NOT NULL AND p[1] = p[2])) AS stutter FROM w
), p AS (
  SELECT doc_id, unnest(list_transform(range(1, len(words) - 3), lambda i: {'i': i, 's': array_to_string(words[i:i+4], ' ')})) AS u FROM w WHERE len(words) >= 5
), q AS (
  SELECT doc_id, u.i AS i, count(*) OVER (PARTITION BY doc_id, u.s) AS c FROM p
), r AS (
  SELECT doc_id, count(DISTINCT j)::BIGINT AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM q WHERE c > 1) x GROUP BY doc_id
), a AS (
  SELECT s.*, coalesce(r.n_repeat_words, 0) AS n_repeat_words,
    n_words < 10 OR 100 * coalesce(r.n_repeat_words, 0) > 20 * n_words AS base_failed
  FROM s LEFT JOIN r ON s.doc_id = r.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 50 * len(lines)
    OR word_chars > 15 * n_words OR word_chars < 2 * n_words OR 100 * shouted > 50 * n_words OR 100 * stutter > 30 * n_words) AS kept
FROM a
"""
