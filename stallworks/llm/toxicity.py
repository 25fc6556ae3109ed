"""Toxic passages as maximal scoring segments over token log-odds.

Fitting. On at most ``LABEL_BOUND`` labelled rows, every distinct text once, the texts of
either label that hold a unit are counted. Units are words and, for languages that build
words from stems, the first ``STEM`` letters of longer words. Each token is scored by its
own smoothed log-odds against the share of toxic texts, positive or negative: a stem takes a
Dirichlet prior of ``STEM_PRIOR`` texts at that share, a word one of ``WORD_PRIOR`` texts at
its stem's share. Units of fewer than ``LEAST_TEXTS`` texts add no count, so such words have
their prior's log-odds. ``GAP`` is added to every token, so that a passage must be denser
than the text around it.

Scoring. One linear pass over a text's tokens keeps all maximal scoring segments (no
segment can be extended or split for a larger score). Karlin and Altschul's theory gives
the scale ``lambda`` of the scores from the clean token distribution and the constant
``K`` from the segments of clean texts, so a segment with score ``S`` in ``n`` tokens has
``E = K n exp(-lambda S)``. A text's statistic is the sum of ``-ln E`` over its
significant segments; a logistic curve fitted on the labelled rows maps it to 0..1. For
``lambda``, ``K`` and the curve a labelled text is scored with the counts of the other folds.
Tasks count token scores, segment scores and statistics in bins; only the bins come to the
driver. Unit counts, bounded by the labelled rows, go to the tasks as hashes and numbers.

Defined results: null or empty text has no token, no passage, and the score of texts
without a passage; repeated rows get the same score; a null doc_id is scored too; an
empty table gives no row; columns named like the results are replaced. Without labelled
rows of both kinds no unit is counted and every score is the prior share.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallworks.llm.common import coded_words, cut, lean, slices

STEM = 4
STEM_PRIOR = 40.0
WORD_PRIOR = 4.0
LEAST_TEXTS = 2
GAP = -1.0
SIGNIFICANT = 0.05
FOLDS = 4
SLICE_BYTES = 4 << 20
#: Bins for a score of 1, and the score that the last bin stands for.
BINS, TOP = 64, 1000.0

_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")
PASSAGES = "array<struct<start:int,end:int,score:double,e_value:double>>"


def units(word: str) -> tuple[str, str]:
    """The bare lower-case word and its stem with a mark, either may be empty."""
    bare = word.lower()
    if not bare.isalpha():
        bare = _EDGE.sub("", bare)
    return bare, f"{bare[:STEM]}*" if len(bare) > STEM else ""


def unit_hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each word the hashes of the bare word and of its stem; 0 stands for none."""
    out = []
    for listed in zip(*map(units, words), strict=True) if words else ((), ()):
        hashed = pd.util.hash_array(np.array(listed, dtype=object), categorize=False).view(np.int64)
        out.append(np.where(np.array([x != "" for x in listed], bool), hashed, 0))
    return out[0], out[1]


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)``, end exclusive, in one pass.

    Open candidates are kept with the running totals before and after them, and with the
    place of the last candidate before them that began lower, so that a search passes no
    candidate twice. A new one is joined with the last candidate that began lower and ended
    lower, until none is left.
    """
    found: list[tuple[int, int, float, float, int]] = []
    total = 0.0
    for at, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        start, left, right = at, before, total
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                found.append((start, at + 1, left, right, j))
                break
            start, _, left, _, beyond = found[j]
            del found[j:]
            j = beyond
    return [(a, b, right - left) for a, b, left, right, _ in found]


def _logit(share: np.ndarray | float) -> np.ndarray:
    return np.log(share) - np.log1p(-np.asarray(share))


@dataclass
class ToxicModel:
    """Counts of units by fold and label, and the constants of the scores' extreme-value distribution."""

    units: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    #: Texts by unit, fold and label, and by fold and label.
    counts: np.ndarray = field(default_factory=lambda: np.empty((0, FOLDS, 2), np.int32))
    texts: np.ndarray = field(default_factory=lambda: np.zeros((FOLDS, 2)))
    scale: float = 1.0
    constant: float = 1.0
    intercept: float = -2.0
    slope: float = 0.0

    def without(self, fold: int) -> ToxicModel:
        """The model as the other folds have it."""
        rest = [k for k in range(FOLDS) if k != fold]
        return replace(self, counts=self.counts[:, rest], texts=self.texts[rest])

    def log_odds(self, words: list[str]) -> np.ndarray:
        """Each word's smoothed log-odds; 0 where it has no letter."""
        if not len(self.units) or not words:
            return np.zeros(len(words))
        total = self.texts.sum(axis=0)
        share = float(np.clip(total[1] / total.sum(), 1e-6, 1 - 1e-6))
        bare, stem = unit_hashes(words)

        def counted(hashes: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(self.units, hashes), len(self.units) - 1)
            known = (self.units[at] == hashes) & (hashes != 0)
            return np.where(known[:, None], self.counts[at].sum(axis=1), 0)

        def smoothed(n: np.ndarray, prior: np.ndarray | float, strength: float) -> np.ndarray:
            return (n[:, 1] + strength * prior) / (n.sum(axis=1) + strength)

        by_stem = smoothed(counted(stem), share, STEM_PRIOR)
        by_word = smoothed(counted(bare), by_stem, WORD_PRIOR)
        return np.where(bare != 0, _logit(by_word) - _logit(share), 0.0)

    def token_scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The scores of all texts' tokens, and every text's bounds in them."""
        words, codes, bounds = coded_words(texts)
        return (self.log_odds(words.to_pylist()) + GAP)[codes], bounds

    def segments(self, texts: pa.Array) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
        """For each text its number of tokens and its maximal scoring segments."""
        yield from self.segments_of(*self.token_scores(texts))

    def segments_of(self, each: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
        # neighbouring tokens of one sign are never parted, so each stretch of them is one entry
        above = each > 0
        change = np.ones(len(each), bool)
        change[1:] = above[1:] != above[:-1]
        change[bounds[:-1][bounds[:-1] < len(each)]] = True
        starts = np.flatnonzero(change)
        sums = np.add.reduceat(each, starts) if len(starts) else np.empty(0)
        ends = np.append(starts[1:], len(each))
        first = np.searchsorted(starts, bounds)
        for a, b, low, high in zip(bounds[:-1], bounds[1:], first[:-1], first[1:], strict=True):
            spans = maximal_segments(sums[low:high].tolist())
            yield int(b - a), [(int(starts[low + s] - a), int(ends[low + e - 1] - a), v) for s, e, v in spans]

    def passages(self, tokens: int, spans: list[tuple[int, int, float]]) -> list[tuple[int, int, float, float]]:
        """The significant segments with their E-values."""
        base = math.log(self.constant * max(1, tokens))
        valued = ((a, b, s, math.exp(min(50.0, base - self.scale * s))) for a, b, s in spans)
        return [x for x in valued if x[3] <= SIGNIFICANT]

    def statistic(self, found: list[tuple[int, int, float, float]]) -> float:
        return sum(-math.log(max(e, 1e-300)) for *_, e in found)

    def score(self, statistic: float) -> float:
        return 1 / (1 + math.exp(-self.intercept - self.slope * math.log1p(statistic)))


def unit_counts(rows: DataFrame) -> DataFrame:
    """``unit`` (hash) and the texts that hold it, ``n0`` … by fold and label; rare units left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = 2 * batch.column(2).to_numpy() + (batch.column(1).to_numpy() > 0)
            for low, high in slices(batch.column(0), SLICE_BYTES):
                words, codes, bounds = coded_words(batch.column(0).slice(low, high - low))
                owner = np.repeat(np.arange(high - low), np.diff(bounds))
                names, unit = np.unique(np.stack(unit_hashes(words.to_pylist()), axis=1), return_inverse=True)
                held = np.unique((owner[:, None] * len(names) + unit.reshape(-1, 2)[codes]).ravel())
                slot = slots[low:high][held // max(1, len(names))]
                pairs, n = np.unique(held % max(1, len(names)) * 2 * FOLDS + slot, return_counts=True)
                name = names[pairs // (2 * FOLDS)] if len(pairs) else np.empty(0, np.int64)
                kept = name != 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name[kept], pa.int64()), pa.array((pairs % (2 * FOLDS))[kept], pa.int32()), pa.array(n[kept], pa.int64())],
                    ["unit", "slot", "n"],
                )

    partial = rows.select("text", "label", "fold").mapInArrow(lean(run), "unit long, slot int, n long")
    by_slot = [F.sum(F.when(F.col("slot") == k, F.col("n")).otherwise(0)).cast("int").alias(f"n{k}") for k in range(2 * FOLDS)]
    return partial.groupBy("unit").agg(*by_slot, F.sum("n").alias("all")).where(F.col("all") >= LEAST_TEXTS).drop("all")


def _scale(score: np.ndarray, share: np.ndarray) -> float:
    """``lambda`` with ``sum p exp(lambda s) = 1`` over clean tokens, by bisection."""

    def excess(x: float) -> float:
        return float((share * np.exp(np.minimum(x * score, 700))).sum() - 1)

    low, high = 1e-3, 1.0
    if excess(low) >= 0:
        return low
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return low


def _curve(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Logistic intercept and slope (not negative) for weighted points, lightly penalised."""
    a, b = -2.0, 1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a + b * x)))
        w = n * p * (1 - p)
        grad = np.array([(n * (y - p)).sum() - 0.01 * a, (n * (y - p) * x).sum() - 0.01 * b])
        hess = np.array([[w.sum() + 0.01, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 0.01]])
        step = np.clip(np.linalg.solve(hess, grad), -2, 2)
        a, b = a + step[0], b + step[1]
    if b < 0:
        share = float(np.clip((n * y).sum() / n.sum(), 1e-3, 1 - 1e-3))
        return math.log(share / (1 - share)), 0.0
    return float(a), float(b)


def extreme_values(tokens: dict[int, int], segments: dict[int, int]) -> tuple[float, float]:
    """``lambda`` and ``K`` from the binned scores of clean tokens and of clean texts' segments.

    ``K`` makes the expected number of segments in clean texts that of the best hundredth.
    """
    if not tokens:
        return 1.0, 1.0
    n = sum(tokens.values())
    scale = _scale(np.array(list(tokens)) / BINS, np.array(list(tokens.values())) / n)
    above, least, level = 0, max(1, sum(segments.values()) // 100), 0.0
    for bin_, times in sorted(segments.items(), reverse=True):
        above, level = above + times, bin_ / BINS
        if above >= least:
            break
    return scale, min(1.0, (above + 1) * math.exp(min(50.0, scale * level)) / n)


def fit(docs: DataFrame, sample: DataFrame) -> ToxicModel:
    """A model from ``sample`` (``doc_id, label``, bounded, hence broadcast)."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(sample), "doc_id").groupBy("text").agg(F.max("label").alias("label"))
    rows = cut(rows.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int")))  # bounded like the sample
    model = ToxicModel()
    for r in rows.groupBy("fold", (F.col("label") > 0).cast("int").alias("toxic")).count().collect():
        model.texts[r["fold"], r["toxic"]] = r["count"]
    clean, toxic = model.texts.sum(axis=0)
    if not clean or not toxic:
        share = 0.5 / (1 + clean) if not toxic else 0.5
        model.intercept = math.log(share / (1 - share))
        return model
    table = unit_counts(rows).orderBy("unit").toArrow()
    model.units = table.column("unit").to_numpy()
    by_slot = [table.column(f"n{k}").to_numpy() for k in range(2 * FOLDS)]
    model.counts = np.stack(by_slot, axis=1).reshape(-1, FOLDS, 2).astype(np.int32)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[ToxicModel, pa.Array, np.ndarray]]:
        """Texts and labels with the model of the other folds."""
        models = [model.without(k) for k in range(FOLDS)]
        for batch in batches:
            folds, labels = batch.column(2).to_numpy(), batch.column(1).to_numpy()
            for low, high in slices(batch.column(0), SLICE_BYTES):
                for fold in np.unique(folds[low:high]):
                    at = low + np.flatnonzero(folds[low:high] == fold)
                    yield models[fold], batch.column(0).take(pa.array(at)), labels[at] > 0

    def binned(kind: int, values: np.ndarray) -> pa.RecordBatch:
        bins, n = np.unique(values, return_counts=True)
        arrays = [pa.array(np.full(len(bins), kind), pa.int32()), pa.array(bins, pa.int64()), pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["kind", "bin", "n"])

    def clean_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for other, texts, is_toxic in parts(batches):
            each, bounds = other.token_scores(texts.filter(pa.array(~is_toxic)))
            found = [s for _, spans in other.segments_of(each, bounds) for *_, s in spans]
            yield binned(0, np.rint(each * BINS).astype(np.int64))
            yield binned(1, np.floor(np.minimum(np.array(found, float), TOP) * BINS).astype(np.int64))

    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for other, texts, is_toxic in parts(batches):
            got = [math.log1p(other.statistic(other.passages(n, spans))) for n, spans in other.segments(texts)]
            bins = np.rint(np.array(got, float) * BINS).astype(np.int64)
            for kind in (0, 1):
                yield binned(kind, bins[is_toxic == kind])

    def counted(run) -> list[dict[int, int]]:
        out: list[dict[int, int]] = [{}, {}]
        binned_rows = rows.select("text", "label", "fold").mapInArrow(lean(run), "kind int, bin long, n long")
        for r in binned_rows.groupBy("kind", "bin").agg(F.sum("n").alias("n")).collect():
            out[r["kind"]][r["bin"]] = r["n"]
        return out

    model.scale, model.constant = extreme_values(*counted(clean_scores))
    points = [(b / BINS, float(kind), float(n)) for kind, bins in enumerate(counted(statistics)) for b, n in sorted(bins.items())]
    model.intercept, model.slope = _curve(*np.array(points).T)
    return model


def score(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """``docs`` with ``toxicity`` (0..1) and ``toxic_passages`` (token spans, E-values)."""

    @F.pandas_udf(f"toxicity double, toxic_passages {PASSAGES}")
    @lean
    def scan(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in columns:
            column = pa.array(texts.fillna(""), pa.string())
            scores: list[float] = []
            passages: list[list[tuple[int, int, float, float]]] = []
            for low, high in slices(column, SLICE_BYTES):
                for tokens, spans in model.segments(column.slice(low, high - low)):
                    found = model.passages(tokens, spans)
                    scores.append(model.score(model.statistic(found)))
                    passages.append(
                        [dict(start=a, end=b, score=s, e_value=e) for a, b, s, e in found]  # type: ignore[misc]
                    )
            yield pd.DataFrame({"toxicity": scores, "toxic_passages": passages})

    kept = [c for c in docs.columns if c not in ("toxicity", "toxic_passages")]
    scored = docs.select(*kept, scan(F.col("text").cast("string")).alias("_scan"))
    return scored.select(*kept, "_scan.toxicity", "_scan.toxic_passages")
