"""Periodic runs of words, found on a Re-Pair grammar.

A run is a stretch of words with smallest period ``q`` that holds two periods at least and
``min_length`` words, and that no neighbouring word extends. A task takes its documents in
slices of a few megabytes and compresses a slice's word ids by Re-Pair: round by round,
wherever pairs of neighbours compete for a symbol the more frequent one becomes a
nonterminal. What is left of each document is paired up until one symbol derives it.

A run lies within the lowest nonterminal that derives it whole, and crosses the boundary
between that nonterminal's two halves. So every nonterminal of ``min_length`` words or more
is looked at once, at one place: a period is a distance at which the word next to the
boundary comes again, and common extensions to both sides, by hashes of stretches, give
the run's part inside the nonterminal. These parts are carried to all places that the
nonterminal derives, top down; parts inside a longer part with the same period are
dropped, and what stays is compared word by word with itself one period on.

Defined results: null and empty texts have no words and no run; ties for the longest run
go to the smallest start, then the smallest period; repeated documents are judged one by
one; a text is treated as a whole, however long, by the task that reads it; an empty table
gives no row; other columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallworks.llm.common import slices

MIN_LENGTH = 12
SLICE_BYTES = 4 << 20
#: Re-Pair ends when a round replaces less than this share of the symbols left.
LEAST_GAIN = 0.01
#: Words compared at a time while boundaries are looked at.
PORTION = 1 << 21

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"

Reorder = Callable[[int | None, int], "np.ndarray | None"]


@dataclass
class Grammar:
    """Rules ``symbol -> left right``; symbols below ``words`` are words."""

    words: int
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray  # words that a symbol derives, of all symbols
    place: np.ndarray  # where one derivation of the rule begins
    round: np.ndarray  # the round that made the rule
    roots: np.ndarray  # one symbol for each document that has words
    starts: np.ndarray


class _Rules:
    def __init__(self, words: int):
        self.words, self.size, self.rounds = words, words, 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.keys, self.symbols = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def named(self, keys: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The symbols of distinct, ascending pairs; known pairs keep theirs."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        fresh = np.flatnonzero(~known)
        symbols = np.empty(len(keys), np.int64)
        if len(self.keys):
            symbols[known] = self.symbols[at[known]]
        symbols[fresh] = self.add(keys[fresh] >> 32, keys[fresh] & 0xFFFFFFFF, places[fresh])
        where = np.searchsorted(self.keys, keys[fresh])
        self.keys = np.insert(self.keys, where, keys[fresh])
        self.symbols = np.insert(self.symbols, where, symbols[fresh])
        return symbols

    def add(self, left: np.ndarray, right: np.ndarray, places: np.ndarray) -> np.ndarray:
        symbols = np.arange(self.size, self.size + len(left))
        self.size += len(left)
        self.parts.append((left, right, places, np.full(len(left), self.rounds)))
        return symbols


def _chosen(symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose pair is replaced, and their pairs: frequent ones before their neighbours."""
    inside = owner[1:] == owner[:-1]
    keys = symbols[:-1] << 32 | symbols[1:]
    _, number, times = np.unique(keys[inside], return_inverse=True, return_counts=True)
    rank = np.zeros(len(symbols) + 1, np.int64)  # a place before the first and after the last pair
    again = times[number]
    rank[1:-1][inside] = np.where(again > 1, again * np.int64(len(times) + 1) + number + 1, 0)
    own, before, after = rank[1:-1], rank[:-2], rank[2:]
    # equal pairs in a row are copies of one symbol: every other one of them
    same = own == before
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(own))))
    even = (np.arange(len(own)) - first) % 2 == 0
    taken = np.flatnonzero((own > 0) & ((own > before) | (same & even)) & (own >= after))
    return taken, keys[taken]


def repair(words: np.ndarray, bounds: np.ndarray, vocabulary: int) -> Grammar:
    """A grammar that derives each document from one symbol."""
    rules = _Rules(vocabulary)
    symbols, places = words.astype(np.int64), np.arange(len(words))
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    while len(symbols) > 1:
        rules.rounds += 1
        taken, keys = _chosen(symbols, owner)
        if not len(taken):
            break
        pairs, first, number = np.unique(keys, return_index=True, return_inverse=True)
        symbols[taken] = rules.named(pairs, places[taken[first]])[number]
        left = np.ones(len(symbols), bool)
        left[taken + 1] = False
        enough = len(taken) >= LEAST_GAIN * len(symbols)
        symbols, places, owner = symbols[left], places[left], owner[left]
        if not enough:
            break
    while True:
        rules.rounds += 1
        first = np.maximum.accumulate(np.where(np.diff(owner, prepend=-1) != 0, np.arange(len(owner)), 0))
        even = (np.arange(len(owner)) - first) % 2 == 0
        taken = np.flatnonzero(even[:-1] & (owner[1:] == owner[:-1])) if len(owner) else owner
        if not len(taken):
            break
        symbols[taken] = rules.add(symbols[taken], symbols[taken + 1], places[taken])
        left = np.ones(len(symbols), bool)
        left[taken + 1] = False
        symbols, places, owner = symbols[left], places[left], owner[left]
    parts = [np.concatenate([p[i] for p in rules.parts] or [np.zeros(0, np.int64)]) for i in range(4)]
    length = np.ones(rules.size, np.int64)
    ends = np.cumsum([0, *(len(p[0]) for p in rules.parts)])
    for low, high in zip(ends[:-1], ends[1:], strict=True):
        length[vocabulary + low : vocabulary + high] = length[parts[0][low:high]] + length[parts[1][low:high]]
    return Grammar(vocabulary, parts[0], parts[1], length, parts[2], parts[3], symbols, places)


class Stretches:
    """Common extensions of two places of a text, by sums of random numbers times powers."""

    def __init__(self, words: np.ndarray, vocabulary: int, seed: int):
        rng = np.random.default_rng(seed)
        value = rng.integers(0, 1 << 64, vocabulary, np.uint64, endpoint=False)
        base = int(rng.integers(1 << 62, 1 << 63)) * 2 + 1 & (1 << 64) - 1
        self.power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(words), base, np.uint64)]))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value[words] * self.power[:-1])])

    def equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` words from ``a`` equal those from ``b``, for ``a <= b``."""
        return (self.sums[a + size] - self.sums[a]) * self.power[b - a] == self.sums[b + size] - self.sums[b]

    def after(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from ``a`` on equal those from ``b`` on, ``most`` at most."""
        return self._longest(most, lambda i, size: self.equal(a[i], b[i], size))

    def before(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words up to and with ``a`` equal those up to and with ``b``."""
        return self._longest(most, lambda i, size: self.equal(a[i] - size + 1, b[i] - size + 1, size))

    @staticmethod
    def _longest(most: np.ndarray, holds: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        low, high = np.zeros(len(most), np.int64), most.copy()
        live = np.flatnonzero(low < high)
        while len(live):
            middle = (low[live] + high[live] + 1) >> 1
            fits = holds(live, middle)
            low[live[fits]] = middle[fits]
            high[live[~fits]] = middle[~fits] - 1
            live = live[low[live] < high[live]]
        return low


def _spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lists of these sizes, one after the other: each entry's list and its number in there."""
    lists = np.repeat(np.arange(len(sizes)), sizes)
    return lists, np.arange(len(lists)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _near(words: np.ndarray, at: np.ndarray, period: np.ndarray, low: np.ndarray, high: np.ndarray, need: int) -> np.ndarray:
    """Candidates with ``need`` equal words in a row around ``at``, looked at one by one."""
    found = np.ones(len(at), np.int64)
    for step in (1, -1):
        live = np.arange(len(at))
        for far in range(1, need):
            here = at[live] + step * far
            inside = (here >= low[live]) & (here + period[live] < high[live])
            live, here = live[inside], here[inside]
            live = live[words[here] == words[here + period[live]]]
            if not len(live):
                break
            found[live] += 1
    return np.flatnonzero(found >= need)


def crossing(words: np.ndarray, grammar: Grammar, stretches: Stretches, min_length: int) -> np.ndarray:
    """Rows ``rule, start, end, period``: runs over the rule's boundary, within what it derives."""
    size = grammar.length[grammar.words :]
    rules = np.flatnonzero(size >= min_length)
    found = [np.zeros((4, 0), np.int64)]
    held = np.cumsum(size[rules])
    at = 0
    while at < len(rules):
        to = max(at + 1, int(np.searchsorted(held, (held[at - 1] if at else 0) + PORTION, "right")))
        own = rules[at:to]
        at = to
        row, number = _spread(size[own])
        low = grammar.place[own][row]
        middle = low + grammar.length[grammar.left[own]][row]
        here = low + number
        right = here >= middle
        live = np.flatnonzero(words[here] == words[np.where(right, middle - 1, middle)])
        row, low, middle, here, right = row[live], low[live], middle[live], here[live], right[live]
        period = np.where(right, here - middle + 1, middle - here)
        anchor = np.where(right, middle - 1, here)  # equals the word one period on
        high = low + size[own][row]
        near = _near(words, anchor, period, low, high, (min_length + 1) // 2)
        row, low, high, period, anchor = row[near], low[near], high[near], period[near], anchor[near]
        ahead = stretches.after(anchor, anchor + period, high - anchor - period)
        back = stretches.before(anchor, anchor + period, anchor - low + 1)
        start, end = anchor - back + 1, anchor + period + ahead
        long = end - start >= np.maximum(min_length, 2 * period)
        found.append(np.stack([own[row], start - low, end - low, period])[:, long])
    runs = np.concatenate(found, axis=1)
    # of the periods of one stretch the smallest; the others are its multiples
    runs = runs[:, np.lexsort((runs[3], runs[2], runs[1], runs[0]))]
    fresh = np.ones(runs.shape[1], bool)
    fresh[1:] = (runs[:3, 1:] != runs[:3, :-1]).any(axis=0)
    return runs[:, fresh]


def derived(grammar: Grammar, runs: np.ndarray) -> np.ndarray:
    """Rows ``start, end, period`` of the rules' runs at every place that the rules derive."""
    rules = len(grammar.left)
    first = np.searchsorted(runs[0], np.arange(rules + 1))
    own = np.diff(first)
    wanted = np.concatenate([np.zeros(grammar.words, bool), own > 0])
    for number in range(1, int(grammar.round.max(initial=0)) + 1):
        part = np.arange(*np.searchsorted(grammar.round, [number, number + 1]))
        wanted[grammar.words + part] |= wanted[grammar.left[part]] | wanted[grammar.right[part]]
    symbols, places = grammar.roots, grammar.starts
    found = [np.zeros((3, 0), np.int64)]
    while len(symbols):
        live = wanted[symbols]
        rule, places = symbols[live] - grammar.words, places[live]
        row, number = _spread(own[rule])
        part = runs[:, first[rule[row]] + number]
        found.append(np.stack([part[1] + places[row], part[2] + places[row], part[3]]))
        left, right = grammar.left[rule], grammar.right[rule]
        symbols = np.concatenate([left, right])
        places = np.concatenate([places, places + grammar.length[left]])
    return np.concatenate(found, axis=1)


def maximal(runs: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Runs not inside another of the same document and period, by start and then period."""
    doc = owner[runs[0]]
    order = np.lexsort((-runs[1], runs[0], runs[2], doc))
    runs, doc = runs[:, order], doc[order]
    group = np.zeros(len(doc), np.int64)
    group[1:] = np.cumsum((doc[1:] != doc[:-1]) | (runs[2, 1:] != runs[2, :-1]))
    # ends count up from group to group, so that a running maximum stays in its group
    lifted = runs[1] + group * np.int64(len(owner) + 1)
    before = np.concatenate([[-1], np.maximum.accumulate(lifted)[:-1]]) if len(doc) else lifted
    runs = runs[:, lifted > before]
    return runs[:, np.lexsort((runs[2], runs[0]))]


def _holds(words: np.ndarray, runs: np.ndarray, bounds: np.ndarray, owner: np.ndarray) -> bool:
    """Whether each run repeats itself word by word and no neighbouring word extends it."""
    for start, end, period in runs.T.tolist():
        doc = owner[start]
        if not np.array_equal(words[start : end - period], words[start + period : end]):
            return False
        if start > bounds[doc] and words[start - 1] == words[start - 1 + period]:
            return False
        if end < bounds[doc + 1] and words[end] == words[end - period]:
            return False
    return True


def runs_of(words: np.ndarray, bounds: np.ndarray, vocabulary: int, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows ``start, end, period`` of all maximal runs of documents of word ids, by start."""
    if len(words) < min_length:
        return np.zeros((3, 0), np.int64)
    grammar = repair(words, bounds, vocabulary)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    for seed in count():  # hashes that take different stretches for equal are drawn anew
        stretches = Stretches(words, vocabulary, seed)
        runs = maximal(derived(grammar, crossing(words, grammar, stretches, min_length)), owner)
        if _holds(words, runs, bounds, owner):
            return runs
    raise AssertionError


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words between ASCII white space, the texts' words as codes, and their bounds."""
    split = pc.ascii_split_whitespace(texts)
    bounds = split.offsets.to_numpy().astype(np.int64)
    coded = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
    codes, bounds = coded.indices.to_numpy().astype(np.int64), bounds - bounds[0]
    empty = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    if empty >= 0:  # white space at either end of a text leaves an empty word there
        real = codes != empty
        bounds, codes = np.concatenate([[0], np.cumsum(real)])[bounds], codes[real]
    return coded.dictionary, codes, bounds


def _slice(keys: pa.Array, texts: pa.Array, min_length: int, reorder: Reorder | None) -> list[pa.Array]:
    dictionary, codes, bounds = _words(texts)
    if reorder is not None:
        for key, low, high in zip(keys.to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            order = reorder(key, high - low)
            if order is not None:
                codes[low:high] = codes[low:high][order]
    runs = runs_of(codes, bounds, len(dictionary), min_length)
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, runs[0] + runs[2], 1)
    np.add.at(change, runs[1], -1)
    kept = np.cumsum(change[:-1]) == 0
    offsets = np.concatenate([[0], np.cumsum(kept)])[bounds]
    left = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), dictionary.take(pa.array(codes[kept])))
    first = np.searchsorted(runs[0], bounds)
    begins = np.repeat(bounds[:-1], np.diff(first))
    rows = pa.StructArray.from_arrays(
        [pa.array(runs[0] - begins), pa.array(runs[1] - runs[0]), pa.array(runs[2])], ["start", "length", "period"]
    )
    return [
        keys,
        pa.array(np.diff(bounds), pa.int64()),
        pa.ListArray.from_arrays(pa.array(first, pa.int32()), rows),
        pc.binary_join(left, " "),
    ]


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, reorder: Reorder | None = None) -> DataFrame:
    """``doc_id, n_words, runs, collapsed``: each text's runs, and its words less their repetitions.

    ``collapsed`` joins by a space the words outside the runs and those of each run's first
    period. ``reorder`` may put words in another order first: of a document's id and its
    number of words it gives their new order, or None.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for low, high in slices(texts, SLICE_BYTES):
                part = slice(low, high)
                columns = _slice(batch.column(0)[part], texts[part], min_length, reorder)
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def longest(runs: Column) -> Column:
    """The longest run, or null; ties go to the smallest start, then the smallest period."""
    ranked = F.transform(runs, lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run")))
    return F.array_max(ranked)["run"]


def spelled(runs: Column) -> Column:
    """A line ``start,length,period`` for each run."""
    line = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
