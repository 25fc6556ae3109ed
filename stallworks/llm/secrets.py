"""Secrets: assignments, access keys, hex runs, and windows of high entropy.

Three patterns give the base spans. Beyond them, candidate strings (long runs of key
characters) are slid over with a window whose Shannon entropy follows from counts that one
character enters and one leaves at each step: with ``c`` occurrences of each character,
``H = log2(W) - sum(c * log2(c)) / W``. Hex strings and mixed strings have thresholds of
their own. Windows at or above it join into spans. A candidate shorter than a window is one
window, with the threshold scaled to what so few characters can hold. Strings on the
allow-list (words of one case, capitalised or joined humps, and numbers, as they stand in
names and paths; UUIDs) are left alone, other strings of letters are judged like any; base
spans are never suppressed.

All in DataFrame functions on single rows: no shuffle, no Python in the tasks. Positions
are code points, ends exclusive.

Defined results: null or empty text has no span; repeated rows and null ids are scanned
like any row; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallworks.llm.common import let

#: Patterns and least lengths of the base kinds (fixed values). Hex runs and access keys
#: are maximal, so their least length can stand in the pattern.
ASSIGN = (
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 12
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
#: Least entropy of a window, in bits, of hex and of other strings.
HEX_BITS, MIXED_BITS = 3.0, 3.7
HEX_STRING = "^[0-9A-Fa-f]+$"
#: What names and paths consist of: a string with nothing else is allowed. Each part is
#: found on its own, so that long strings need no nested repetition.
ALLOWED_PARTS = "|".join(
    (
        r"[_/=+-]+",
        r"(?<![A-Za-z0-9])(?:[A-Z]+|[0-9]+)(?![A-Za-z0-9])",
        r"(?<![A-Za-z0-9])[a-z]+(?![a-z0-9])",
        r"[A-Z][a-z]{2,}(?![a-z0-9])",
    )
)
ALLOWED = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"

SPANS = "array<struct<start:int,end:int,kind:int>>"
_FIRST, _LAST = ord("+"), ord("z")


def _span(start: Column, end: Column, kind: int) -> Column:
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), F.lit(kind).alias("kind"))


def places(text: Column, pattern: str) -> Column:
    """``start, value`` of every match, leftmost and not overlapping.

    The text between matches comes from ``split``, so the lengths of both lists give the
    positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    state = F.struct(F.lit(0).alias("at"), F.lit([]).cast("array<struct<start:int,value:string>>").alias("all"))

    def walk(gaps: Column, values: Column) -> Column:
        lengths = F.zip_with(
            F.slice(gaps, F.lit(1), F.size(values)), values, lambda g, v: F.struct(F.length(g).alias("gap"), v.alias("value"))
        )
        return F.aggregate(
            lengths,
            state,
            lambda s, x: F.struct(
                (s["at"] + x["gap"] + F.length(x["value"])).alias("at"),
                F.concat(
                    s["all"], F.array(F.struct((s["at"] + x["gap"]).alias("start"), x["value"].alias("value")))
                ).alias("all"),
            ),
            lambda s: s["all"],
        )

    each = let(found, lambda values: walk(F.split(text, pattern, -1), values))
    empty = F.lit([]).cast("array<struct<start:int,value:string>>")
    return F.when(text.rlike(pattern), each).otherwise(empty)


def _whole(text: Column, pattern: str, kind: int) -> Column:
    return F.transform(
        places(text, pattern), lambda x: _span(x["start"], x["start"] + F.length(x["value"]), kind)
    )


def base_spans(text: Column) -> Column:
    """The spans of the three patterns, failing matches dropped."""
    long = F.filter(
        places(text, ASSIGN), lambda x: F.length(F.regexp_extract(x["value"], ASSIGN, 1)) >= ASSIGN_LEAST
    )
    assign = F.transform(long, lambda x: _span(x["start"], x["start"] + F.length(x["value"]), 0))
    return F.concat(assign, _whole(text, ACCESS, 1), _whole(text, HEX, 2))


def dense_windows(value: Column, least: Column) -> Column:
    """``start, end`` of joined windows of ``value`` with at least ``least`` bits.

    Windows are ``WINDOW`` characters wide, or as wide as a shorter ``value``.
    """
    wide = F.least(F.length(value), F.lit(WINDOW))
    return let(F.struct(value.alias("value"), wide.alias("width")), lambda x: _dense(x["value"], x["width"], least))


def _dense(value: Column, width: Column, least: Column) -> Column:
    bound = F.log2(width) * (1 - least / math.log2(WINDOW))
    weight = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]
    table = F.array(*map(F.lit, weight))
    slots = F.array_repeat(F.lit(0), _LAST - _FIRST + 1)
    spans = F.lit([]).cast("array<struct<start:int,end:int>>")
    state = F.struct(slots.alias("counts"), F.lit(0.0).alias("sum"), spans.alias("spans"))

    def code(at: Column) -> Column:
        return F.ascii(F.substring(value, at, F.lit(1))) - _FIRST

    def enter(s: Column, at: Column) -> Column:
        def moved(into: Column, out: Column) -> Column:
            had_in, had_out = F.get(s["counts"], into), F.get(s["counts"], out)
            gain = F.get(table, had_in + 1) - F.get(table, had_in)
            loss = F.get(table, had_out) - F.get(table, had_out - 1)
            same = into == out
            total = s["sum"] + F.when(same, 0.0).otherwise(gain - F.coalesce(loss, F.lit(0.0)))
            counts = F.transform(
                s["counts"],
                lambda c, i: c + (i == into).cast("int") - (i == out).cast("int"),
            )
            return F.struct(counts.alias("counts"), total.alias("sum"))

        leaving = F.when(at > width, code(at - width)).otherwise(F.lit(-1))
        return let(F.struct(code(at).alias("into"), leaving.alias("out")), lambda x: moved(x["into"], x["out"]))

    def step(s: Column, at: Column) -> Column:
        def marked(new: Column) -> Column:
            dense = (at >= width) & (new["sum"] / width <= bound + 1e-12)
            last = F.try_element_at(s["spans"], F.lit(-1))
            begin = (at - width).cast("int")
            joined = F.concat(
                F.slice(s["spans"], F.lit(1), F.size(s["spans"]) - 1),
                F.array(F.struct(last["start"].alias("start"), at.cast("int").alias("end"))),
            )
            added = F.concat(s["spans"], F.array(F.struct(begin.alias("start"), at.cast("int").alias("end"))))
            near = F.coalesce(last["end"] >= begin, F.lit(False))
            out = F.when(~dense, s["spans"]).when(near, joined).otherwise(added)
            return F.struct(new["counts"].alias("counts"), new["sum"].alias("sum"), out.alias("spans"))

        return let(enter(s, at), marked)

    return F.aggregate(F.sequence(F.lit(1), F.length(value)), state, step, lambda s: s["spans"])


def entropy_spans(text: Column) -> Column:
    """Dense windows of the candidate strings that no allowed pattern covers."""

    def kept(x: Column) -> Column:
        return ~x["value"].rlike(ALLOWED) & (F.regexp_replace(x["value"], ALLOWED_PARTS, "") != "")

    def spans(x: Column) -> Column:
        least = F.when(x["value"].rlike(HEX_STRING), HEX_BITS).otherwise(MIXED_BITS)
        return F.transform(
            dense_windows(x["value"], least),
            lambda w: _span(x["start"] + w["start"], x["start"] + w["end"], 3),
        )

    return F.flatten(F.transform(F.filter(places(text, CANDIDATE), kept), spans))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id`` with ``base`` and ``spans``, arrays of ``start, end, kind`` in order."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def ordered(spans: Column) -> Column:
        keyed = F.transform(spans, lambda x: F.struct(x["start"], x["kind"], x["end"]))
        return F.transform(
            F.sort_array(keyed), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))
        )

    found = rows.select("doc_id", base_spans(F.col("text")).alias("base"), entropy_spans(F.col("text")).alias("more"))
    return found.select("doc_id", ordered(F.col("base")).alias("base"), ordered(F.concat("base", "more")).alias("spans"))


def spelled(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))),
        ",",
    )
