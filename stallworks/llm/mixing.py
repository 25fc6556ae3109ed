"""Mixing of sources by temperature, in DataFrame functions alone.

A source with the share ``s`` of all tokens gets the weight ``s ** t``, normalised; ``t``
of 1 keeps the shares, 0 makes all sources equal. Bisection finds the ``t`` that meets a
target entropy of the weights, or the smallest one at which no source is repeated more
often than a limit. Weights become token budgets; the total is either given or so large
that every source is used whole at least once.

A budget is realised as whole passes over the source and one part of a pass: documents
stand in a permutation made of blocks (a hash gives the block and the order inside it),
and the last pass takes whole blocks, then the head of the one in which the budget ends.
Blocks have ``BLOCK_ROWS`` documents on average, and as many blocks make a group. The end
of a budget is looked for among a source's groups, then among the blocks of one group, then
among the documents of one block, so neither a large source nor the corpus is ever ordered
in one task. Texts are not shuffled at all: what a document needs to know is one row for
its source. Its place in the permutation is put out with its copies.

Tokens are words between white space. Defined results: null text has no token; a null
source is a source of its own; repeated rows share their copies' fate; a null ``doc_id``
takes part like any other; an empty table gives no row; columns named like the results
are replaced. A source without tokens is used once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallworks.llm.common import cut

BLOCK_ROWS = 1024
SEED = 20
RESULTS = ("mix_weight", "mix_copies", "mix_block", "mix_place")
WORD = r"[^\x20\x09-\x0D]+"
#: Sources are a dimension, not data; more than this is refused.
MOST_SOURCES = 100_000
#: What is known of a source: its weight, its passes, what the last one takes, and its blocks.
PLAN = pa.schema(
    [("_source", pa.string()), ("_weight", pa.float64()), ("_full", pa.int64()), ("_rest", pa.int64()), ("_blocks", pa.int64())]
)


@dataclass(frozen=True)
class Mix:
    """An exponent, and by source its weight, its budget and its passes."""

    exponent: float
    total: float
    weight: dict[str | None, float]

    def entropy(self) -> float:
        return -sum(w * math.log(w) for w in self.weight.values() if w > 0)


def weights(tokens: dict[str | None, int], exponent: float) -> dict[str | None, float]:
    """Normalised weights; sources without tokens weigh nothing."""
    whole = sum(tokens.values())
    raw = {k: (n / whole) ** exponent if n else 0.0 for k, n in tokens.items()}
    total = math.fsum(raw.values())
    return {k: x / total for k, x in raw.items()}


def _passes(tokens: dict[str | None, int], weight: dict[str | None, float], total: float) -> float:
    return max(weight[k] * total / n for k, n in tokens.items() if n)


def _whole(tokens: dict[str | None, int], weight: dict[str | None, float]) -> float:
    """The smallest total with which every source is used whole once."""
    return max(n / weight[k] for k, n in tokens.items() if n)


def solve(
    tokens: dict[str | None, int],
    entropy: float | None = None,
    repetition: float | None = None,
    total: float | None = None,
) -> Mix:
    """The exponent by bisection on ``[0, 1]``; a target out of reach gives the nearer end.

    The entropy falls as the exponent grows, and so does the largest number of passes.
    """
    if (entropy is None) == (repetition is None):
        raise ValueError("give a target entropy or a repetition limit")
    if not any(tokens.values()):
        return Mix(1.0, 0.0, dict.fromkeys(tokens, 0.0))

    def beyond(t: float) -> bool:
        """Whether the exponent is still too small."""
        w = weights(tokens, t)
        if entropy is not None:
            return -sum(x * math.log(x) for x in w.values() if x > 0) > entropy
        return _passes(tokens, w, _whole(tokens, w) if total is None else total) > repetition

    low, high = 0.0, 1.0
    if not beyond(low):
        high = low
    elif not beyond(high):
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if beyond(mid) else (low, mid)
    w = weights(tokens, high)
    return Mix(high, _whole(tokens, w) if total is None else float(total), w)


def _order(seed: int) -> tuple[Column, Column]:
    """A document's hash, which gives its block and its place inside it."""
    h = F.xxhash64(F.lit(seed), F.col("doc_id"))
    return F.pmod(h, F.col("_blocks")).alias("block"), h.alias("place")


def _crossing(rows: DataFrame, by: str) -> DataFrame:
    """``_source``, ``by`` and the ``room`` left in it, where running ``n`` passes ``room``."""
    before = F.sum("n").over(Window.partitionBy("_source").orderBy(by)) - F.col("n")
    found = rows.withColumn("before", before).where("before <= room AND before + n > room")
    return found.select("_source", by, (F.col("room") - F.col("before")).alias("room"))


def mix_sources(
    docs: DataFrame,
    entropy: float | None = None,
    repetition: float | None = None,
    total: float | None = None,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with ``mix_weight`` and ``mix_copies``, how often a document is used.

    ``mix_block`` and ``mix_place`` order a source's documents: every pass over it follows
    them, and the last one, a part, is a beginning of that order.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # a null source is a key of its own
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("_source")
    counted = F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens")
    rows = cut(docs.select(key, "doc_id", counted))
    sums = rows.groupBy("_source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))
    listed = sums.limit(MOST_SOURCES + 1).collect()
    if len(listed) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    mix = solve({r["_source"]: r["tokens"] for r in listed}, entropy, repetition, total)
    plan = []
    for r in listed:
        budget, own = mix.weight[r["_source"]] * mix.total, r["tokens"]
        full = math.floor(budget / own + 1e-9) if own else 1
        rest = int(max(0.0, budget - full * own)) if own else 0
        plan.append((r["_source"], mix.weight[r["_source"]], full, rest, max(1, r["docs"] // BLOCK_ROWS)))
    # a row for each source, from here on; rows of an Arrow table need no Python worker
    plans = F.broadcast(spark.createDataFrame(pa.Table.from_pylist([dict(zip(PLAN.names, r, strict=True)) for r in plan], PLAN)))
    placed = rows.join(plans, "_source").where("_rest > 0").select("_source", "tokens", "_rest", *_order(seed))
    sums = placed.groupBy("_source", "block", "_rest").agg(F.sum("tokens").alias("n"))
    sums = cut(sums.withColumn("group", F.expr(f"block div {BLOCK_ROWS}")))
    # the group in which a source's budget ends, then the block: a row for each source
    groups = sums.groupBy("_source", "group", "_rest").agg(F.sum("n").alias("n")).withColumnRenamed("_rest", "room")
    blocks = sums.drop("_rest").join(F.broadcast(_crossing(groups, "group")), ["_source", "group"])
    ending = cut(_crossing(blocks, "block"))
    # and the last place in it that still fits
    inside = placed.join(F.broadcast(ending), ["_source", "block"])
    filled = F.sum("tokens").over(Window.partitionBy("_source").orderBy("place"))
    last = inside.withColumn("filled", filled).where("filled <= room")
    last = last.groupBy("_source").agg(F.max("place").alias("last"))
    ends = ending.join(last, "_source", "left").select("_source", F.col("block").alias("_end"), F.col("last").alias("_last"))
    plans = F.broadcast(plans.join(F.broadcast(ends), "_source", "left"))
    kept = [c for c in docs.columns if c not in RESULTS]
    block, place = _order(seed)
    joined = docs.select(*kept, key).join(plans, "_source")
    part = (block < F.col("_end")) | ((block == F.col("_end")) & (place <= F.col("_last")))
    more = F.when((F.col("_rest") > 0) & F.coalesce(part, F.lit(False)), 1).otherwise(0)
    copies = (F.col("_full") + more).cast("int").alias("mix_copies")
    order = (block.alias("mix_block"), place.alias("mix_place"))
    return joined.select(*kept, F.col("_weight").alias("mix_weight"), copies, *order)


def repeated(mixed: DataFrame) -> DataFrame:
    """A row for each copy, without the columns of the mix."""
    passes = F.explode(F.sequence(F.lit(1), F.col("mix_copies")))
    rows = mixed.where("mix_copies > 0").withColumn("_pass", passes)
    return rows.drop("_pass", *RESULTS)
