"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Trees are grown on at most ``LABEL_BOUND`` labelled rows. Every path from a root to a node
below it is a rule, a conjunction of thresholds on statistics. A logistic regression with
an L1 penalty weighs the rules and drops most of them; what is left is compiled into one
Spark column expression, so scoring is a sum of comparisons in the JVM. Statistics are
counted over whole texts by numpy in the tasks.

Defined results: null or empty text has all statistics zero and is scored like any other;
repeated rows get the same score; a null doc_id is scored too; an empty table gives no
row; columns named like the results are replaced. Without labelled rows of both kinds
there is no rule and every score is the smoothed share of good rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stallworks.llm.common import coded_words, cut, slices

TREES = 16
DEPTH = 3
PENALTY = 0.002
SLICE_BYTES = 4 << 20

STATISTICS = (
    "log_words", "word_length", "longest_word", "upper", "digit", "symbol", "mark", "high",
    "newline", "distinct_words", "distinct_pairs", "doubled_words", "short_words",
    "marked_words", "top_word", "repeated_lines", "line_words",
)

_CLASSES = ("upper", "digit", "symbol", "mark", "high", "newline")
_TABLE = np.zeros(256, np.uint8)
_TABLE[65:91] = 1
_TABLE[48:58] = 2
_TABLE[[ord(c) for c in "#*$%&|<>{}[]\\^~_=@+/"]] = 3
_TABLE[[ord(c) for c in ".,;:!?'\"()-"]] = 4
_TABLE[128:] = 5
_TABLE[10] = 6


def _per_text(owner: np.ndarray, codes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of each text and how often its most frequent one occurs."""
    if not len(codes):
        return np.zeros(rows), np.zeros(rows)
    width = int(codes.max()) + 1
    held, times = np.unique(owner.astype(np.int64) * width + codes, return_counts=True)
    text = held // width
    top = np.zeros(rows)
    np.maximum.at(top, text, times)
    return np.bincount(text, minlength=rows).astype(float), top


def measure(texts: pa.Array) -> pd.DataFrame:
    """The statistics of each text."""
    rows = len(texts)
    blob = np.frombuffer(b"".join(texts.cast(pa.binary()).to_pylist()), np.uint8)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    kind = _TABLE[blob]
    out: dict[str, np.ndarray] = {}
    n = np.maximum(sizes, 1)
    for k, name in enumerate(_CLASSES, 1):
        at = np.flatnonzero(kind == k)
        out[name] = np.diff(np.searchsorted(at, ends)) / n
    words, codes, bounds = coded_words(texts)
    length = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    last = pc.utf8_slice_codeunits(words, -1)
    marked = pc.is_in(last, pa.array(list("#*$%&|<>!"))).to_numpy(zero_copy_only=False)
    count = np.diff(bounds)
    w = np.maximum(count, 1)
    owner = np.repeat(np.arange(rows), count)

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=flags[codes].astype(float), minlength=rows) / w

    distinct, top = _per_text(owner, codes, rows)
    same = owner[1:] == owner[:-1]
    pairs = codes[:-1].astype(np.int64) * max(1, len(length)) + codes[1:]
    _, pair_codes = np.unique(pairs[same], return_inverse=True)
    pair_kinds, _ = _per_text(owner[1:][same], pair_codes, rows)
    doubled = np.bincount(owner[1:][same & (codes[1:] == codes[:-1])], minlength=rows)
    longest = np.zeros(rows)
    np.maximum.at(longest, owner, length[codes])
    split = pc.split_pattern(texts, "\n")
    line_bounds = split.offsets.to_numpy().astype(np.int64)
    lines = split.values.slice(line_bounds[0], line_bounds[-1] - line_bounds[0]).dictionary_encode()
    n_lines = np.diff(line_bounds)
    line_kinds, _ = _per_text(np.repeat(np.arange(rows), n_lines), lines.indices.to_numpy(), rows)
    out |= {
        "log_words": np.log1p(count),
        "word_length": share(length),
        "longest_word": np.log1p(longest),
        "distinct_words": distinct / w,
        "distinct_pairs": pair_kinds / np.maximum(count - 1, 1),
        "doubled_words": doubled / w,
        "short_words": share(length <= 3),
        "marked_words": share(marked),
        "top_word": top / w,
        "repeated_lines": (n_lines - line_kinds) / np.maximum(n_lines, 1),
        "line_words": np.log1p(count / np.maximum(n_lines, 1)),
    }
    return pd.DataFrame({c: np.asarray(out[c], float) for c in STATISTICS})


@F.pandas_udf(StructType([StructField(c, DoubleType()) for c in STATISTICS]))
def statistics(texts: pd.Series) -> pd.DataFrame:
    column = pa.array(texts.fillna(""), pa.string())
    parts = [measure(column.slice(a, b - a)) for a, b in slices(column, SLICE_BYTES)]
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=list(STATISTICS), dtype=float)


@dataclass(frozen=True)
class Rule:
    """A conjunction of ``statistic <= bound`` or ``statistic > bound``, with its weight."""

    terms: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def column(self, prefix: str) -> Column:
        out = F.lit(True)
        for name, below, bound in self.terms:
            value = F.col(f"{prefix}{name}")
            out = out & ((value <= bound) if below else (value > bound))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {'<=' if b else '>'} {x:.6g}" for n, b, x in self.terms)


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules and an intercept; ``score`` is the logistic of their sum."""

    rules: tuple[Rule, ...]
    intercept: float

    def score(self, prefix: str = "") -> Column:
        total = F.lit(self.intercept)
        for rule in self.rules:
            total = total + F.when(rule.column(prefix), rule.weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _paths(node, terms: tuple[tuple[str, bool, float], ...] = ()) -> list[Rule]:
    """The rules of a fitted tree: one for each node below the root."""
    found = [Rule(terms)] if terms else []
    if node.getClass().getSimpleName() == "InternalNode":
        split = node.split()
        name, bound = STATISTICS[split.featureIndex()], float(split.threshold())
        found += _paths(node.leftChild(), (*terms, (name, True, bound)))
        found += _paths(node.rightChild(), (*terms, (name, False, bound)))
    return found


def fit(docs: DataFrame, sample: DataFrame) -> RuleModel:
    """Rules from ``sample`` (``doc_id, label``, bounded, hence broadcast)."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(sample), "doc_id")
    rows = rows.select((F.col("label") > 0).cast("double").alias("label"), statistics("text").alias("s"))
    # measured in the tasks of the scan; only labelled rows, a bounded number, are dealt,
    # and their order depends on their values alone
    rows = rows.select("label", "s.*").repartition(8, "label", *STATISTICS)
    rows = cut(rows.sortWithinPartitions("label", *STATISTICS))
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    good, bad = totals.get(1.0, 0), totals.get(0.0, 0)
    if not good or not bad:
        return RuleModel((), math.log((good + 0.5) / (bad + 0.5)))
    table = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(rows)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="onethird", minInstancesPerNode=5, seed=7
    ).fit(table)
    rules = list(dict.fromkeys(r for tree in forest.trees for r in _paths(tree._call_java("rootNode"))))
    if not rules:
        return RuleModel((), math.log((good + 0.5) / (bad + 0.5)))
    flags = rows.select("label", *(r.column("").cast("double").alias(f"r{i}") for i, r in enumerate(rules)))
    table = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(flags)
    table = table.select("label", "features").cache()
    fitted = LogisticRegression(
        regParam=PENALTY, elasticNetParam=1.0, standardization=False, maxIter=60
    ).fit(table)
    table.unpersist()
    weights = fitted.coefficients.toArray()
    kept = tuple(Rule(r.terms, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6)
    return RuleModel(kept, float(fitted.intercept))


def score(docs: DataFrame, model: RuleModel) -> DataFrame:
    """``docs`` with ``quality`` (0..1) and the statistics it rests on as one struct."""
    kept = [c for c in docs.columns if c not in ("quality", "quality_statistics")]
    out = docs.select(*kept, statistics(F.col("text").cast("string")).alias("quality_statistics"))
    return out.select(*kept, model.score("quality_statistics.").alias("quality"), "quality_statistics")
