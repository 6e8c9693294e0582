"""Spans of regular-expression matches as array columns, with DataFrame functions only.

A span is struct(start, kind, end, value): code points, end exclusive, kind as a number that orders like the
listed kinds, so that sorting the structs sorts by start, then kind.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN_TYPE = "array<struct<start:int,kind:int,end:int,value:string>>"
GROUP = 256
#: Code points of the blocks that a text is cut into, first into large ones and these into small ones.
LARGE, BLOCK = 1 << 18, 1 << 12
PLACED = "array<struct<at:int,parts:array<struct<gap:string,m:string,v:string>>>>"


def let(value: Column, body) -> Column:
    """`body(v)` with `v` standing for `value`, worked out once: written into another lambda itself, an expression is
    worked out again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def grouped(p: Column) -> Column:
    """An array cut into arrays of at most GROUP elements."""
    several = F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / GROUP).cast("int")), lambda k: F.slice(p, k * GROUP + 1, GROUP))
    return F.when(F.size(p) <= GROUP, F.array(p)).otherwise(several)


def no_spans() -> Column:
    return F.array().cast(SPAN_TYPE)


def find(text: Column, pattern: Column | str, kind: int, accept=None, group: int = 0) -> Column:
    """Leftmost non-overlapping matches of `pattern`. `accept(value)` drops matches by their `group`, without a retry.

    The text between matches comes from split, the matches from regexp_extract_all: their lengths add up to places.
    Places are summed over groups of GROUP matches, then inside each group, so that a text with very many matches
    costs a little more than their number, not its square.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(group)) if group else whole
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("m"), judged.alias("v"))

    groups = let(parts, grouped)

    def step(a: Column, p: Column) -> Column:
        at = a["at"] + F.length(p["gap"])
        end = at + F.length(p["m"])
        ok = p["m"].isNotNull() if accept is None else p["m"].isNotNull() & accept(p["v"])
        span = F.struct(at.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), p["m"].alias("value"))
        return F.struct(F.coalesce(end, at).alias("at"), F.when(ok, F.array_append(a["out"], span)).otherwise(a["out"]).alias("out"))

    def sizes(a: Column, g: Column) -> Column:
        size = F.aggregate(g, F.lit(0), lambda n, p: n + F.length(p["gap"]) + F.coalesce(F.length(p["m"]), F.lit(0)))
        return F.struct((a["at"] + size).alias("at"), F.array_append(a["out"], F.struct(a["at"].alias("at"), g.alias("parts"))).alias("out"))

    def spans_of(g: Column) -> Column:
        return F.aggregate(g["parts"], F.struct(g["at"].alias("at"), no_spans().alias("out")), step, lambda a: a["out"])

    placed = F.aggregate(groups, F.struct(F.lit(0).alias("at"), F.array().cast(PLACED).alias("out")), sizes, lambda a: a["out"])
    return F.when(F.regexp_like(text, pattern), F.flatten(F.transform(placed, spans_of))).otherwise(no_spans())


def text_of(spans: Column, names: list[str]) -> Column:
    """kind:start:end, comma-joined, in the order of the array."""
    kinds = F.array(*[F.lit(n) for n in names])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def count_of(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _blocks(text: Column) -> Column:
    """The text in pieces of BLOCK code points. Finding a place in a string takes a walk from its start, so a long text is cut
    in two steps, and a place in it costs one walk through a block."""

    def cut(x: Column, n: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.length(x), F.lit(1)) - 1) / n).cast("int")), lambda k: F.substring(x, k * n + 1, F.lit(n)))

    return F.flatten(F.transform(cut(text, LARGE), lambda x: cut(x, BLOCK)))


def _between(blocks: Column, a: Column, b: Column) -> Column:
    """The code points from place a up to place b."""
    i, j, inside = F.floor(a / BLOCK).cast("int"), F.floor((b - 1) / BLOCK).cast("int"), (a % BLOCK + 1).cast("int")
    first = F.get(blocks, i)
    several = F.concat(F.substring(first, inside, F.lit(BLOCK)), F.array_join(F.slice(blocks, i + 2, j - i - 1), ""), F.substring(F.get(blocks, j), F.lit(1), b - j * BLOCK))
    return F.when(a >= b, "").when(i == j, F.substring(first, inside, b - a)).otherwise(several)


def replace(text: Column, spans: Column, by) -> Column:
    """`text` with each span of a sorted array replaced by `by(span)`; of overlapping spans the one that starts first stands, to
    the greatest end.

    A span stands if it starts at or after the greatest end before it. These ends are carried over groups of GROUP spans, then
    through each group, so that the work grows with the number of spans and the length of the text.
    """

    def reach(groups: Column) -> Column:
        """The greatest end before each group."""
        last = F.transform(groups, lambda g: F.array_max(F.transform(g, lambda s: s["end"])))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(last, start, lambda a, t: F.struct(F.greatest(a["at"], t).alias("at"), F.array_append(a["out"], a["at"]).alias("out")), lambda a: F.array_append(a["out"], a["at"]))

    standing = SPAN_TYPE.replace("struct<", "struct<before:int,")

    def through(g: Column, at: Column) -> Column:
        def step(a: Column, s: Column) -> Column:
            found = F.struct(a["at"].alias("before"), s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value"))
            return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] >= a["at"], F.array_append(a["out"], found)).otherwise(a["out"]).alias("out"))

        return F.aggregate(g, F.struct(at.alias("at"), F.array().cast(standing).alias("out")), step, lambda a: a["out"])

    def whole(groups: Column) -> Column:
        return let(reach(groups), lambda ends: let(F.flatten(F.transform(groups, lambda g, i: through(g, F.get(ends, i)))), lambda kept: let(_blocks(text), lambda blocks: joined(kept, blocks, F.element_at(ends, -1)))))

    def joined(kept: Column, blocks: Column, end: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            return F.concat(_between(blocks, s["before"], s["start"]), by(s.withField("end", F.coalesce(F.get(kept, i + 1)["before"], end))))

        return F.concat(F.array_join(F.transform(kept, piece), ""), _between(blocks, end, F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(let(grouped(spans), whole))
