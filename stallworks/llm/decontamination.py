"""Benchmark passages in documents, found in suffix arrays over the documents' words.

Words are runs of letters, digits and non-ASCII characters, in lower case (A-Z only). A
task cuts its documents into shards of a few megabytes and sorts, in each, the suffixes
that could begin a match: those followed by enough words that the benchmark knows. Every
suffix of every benchmark item is looked up by binary search: the suffixes that share its
first ``window`` words (all words of a shorter item) are one range of the array, and their
places are all its verbatim occurrences. From each place that cannot be extended to the
left the match is followed to its end, which gives the longest verbatim matches.

Order is settled to the depth of a window, by doubling ranks; no lookup asks for more.
The benchmark is sent to the tasks in blocks of at most ``block_bytes`` of text (a single
longer item is a block of its own); beyond one block the documents are kept as a table
with row numbers and searched block by block, and what the blocks found is put together.

Defined results: null and empty texts have no words and are never hit; items without words
match nothing; an item whose id is null marks words but is not listed; an item id given
twice is listed once; repeated documents are judged one by one; a text is searched as a
whole, however long; an empty benchmark leaves every document clean; an empty table gives
no row; other columns of the input are carried by ``decontaminate`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallworks.llm.common import cut, slices

WINDOW = 10
BLOCK_BYTES = 32 << 20
SHARD_BYTES = 8 << 20

FOUND = "n_words long, spans array<struct<start:int,end:int>>, items array<long>, longest int, longest_start int"

#: Lower case for A-Z, and a space for every other ASCII character but digits and letters.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def word_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the words of all texts as codes, and the bounds of each text."""
    texts = pc.fill_null(pc.cast(texts, pa.large_string()), "")
    if texts.offset:
        texts = pa.concat_arrays([texts])
    _, offsets, data = texts.buffers()
    folded = pa.py_buffer((data.to_pybytes() if data else b"").translate(_FOLD))
    split = pc.ascii_split_whitespace(pa.LargeStringArray.from_buffers(len(texts), offsets, folded))
    bounds = split.offsets.to_numpy().astype(np.int64)
    coded = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
    codes, bounds = coded.indices.to_numpy().astype(np.int64), bounds - bounds[0]
    # white space at either end of a text leaves an empty word there
    empty = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    if empty >= 0:
        real = codes != empty
        bounds = np.concatenate([[0], np.cumsum(real)])[bounds]
        codes = codes[real]
    return coded.dictionary, codes, bounds


@dataclass(frozen=True)
class TestBlock:
    """Some items of a benchmark: their distinct windows, and the items of each window."""

    vocabulary: pa.Array
    words: np.ndarray  # all items' words, numbered from 1, with a 0 after each item
    starts: np.ndarray  # where a window begins in ``words``, one place for equal windows
    lengths: np.ndarray  # words of that window
    owners: np.ndarray  # the window's items, one window after the other
    owner_ends: np.ndarray
    shares: np.ndarray  # other places of equal windows, for longest matches
    share_ends: np.ndarray


def prepare(ids: list[int | None], texts: list[str | None], window: int = WINDOW) -> TestBlock:
    """The windows of the given items."""
    vocabulary, codes, bounds = word_lists(pa.array(texts, pa.string()))
    words, places = [], {}
    at = 0
    for item, low, high in zip(ids, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        own = (codes[low:high] + 1).tolist()
        width = min(window, len(own))
        for i in range(len(own) - width + 1 if own else 0):
            places.setdefault(tuple(own[i : i + width]), []).append((at + i, item))
        words += [*own, 0]
        at += len(own) + 1
    owners = [sorted({item for _, item in found if item is not None}) for found in places.values()]
    shares = [[place for place, _ in found] for found in places.values()]

    def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        return np.asarray([x for own in lists for x in own], np.int64), np.cumsum([len(own) for own in lists], dtype=np.int64)

    return TestBlock(
        vocabulary,
        np.asarray(words, np.int64),
        np.asarray([own[0] for own in shares], np.int64),
        np.asarray([len(own) for own in places], np.int64),
        *flat(owners),
        *flat(shares),
    )


def _packed(words: np.ndarray, places: np.ndarray, lengths: np.ndarray, width: int, depth: int, fill: int) -> list[np.ndarray]:
    """``depth`` words from each place, several to a key; beyond ``lengths`` words stands ``fill``."""
    each = max(1, 62 // width)
    keys = []
    for first in range(0, depth, each):
        key = np.zeros(len(places), np.int64)
        for i in range(first, first + each):
            inside = i < lengths if i < depth else np.zeros(len(places), bool)
            key = key << width | np.where(inside, words[np.minimum(places + i, len(words) - 1)], fill)
        keys.append(key)
    return keys


def _bisect(keys: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray, beyond: bool) -> np.ndarray:
    """The first place of ``low..high`` whose key is not below (``beyond``: is above) the wanted one."""
    low, high = low.copy(), high.copy()
    live = np.flatnonzero(low < high)
    while len(live):
        middle = (low[live] + high[live]) >> 1
        above = keys[middle] > wanted[live] if beyond else keys[middle] >= wanted[live]
        high[live[above]] = middle[above]
        low[live[~above]] = middle[~above] + 1
        live = live[low[live] < high[live]]
    return low


class SuffixArray:
    """The suffixes of a shard with ``shortest`` known words or more, by their first ``depth`` words.

    Words are numbered from 1; 0 ends a text and stands for a word that no item has.
    """

    def __init__(self, words: np.ndarray, size: int, depth: int, shortest: int):
        self.words, self.depth, self.width = words, depth, max(1, int(size).bit_length())
        gaps = np.append(np.flatnonzero(words == 0), len(words))
        left = np.repeat(gaps, np.diff(gaps, prepend=-1))[: len(words)] - np.arange(len(words))
        chosen = np.flatnonzero(left >= shortest)
        keys = _packed(words, chosen, left[chosen], self.width, depth, 0)
        order = np.lexsort(keys[::-1]) if len(chosen) else chosen
        self.places = chosen[order]
        self.keys = [key[order] for key in keys]

    def _bound(self, wanted: list[np.ndarray], beyond: bool) -> np.ndarray:
        low = np.searchsorted(self.keys[0], wanted[0], "left")
        high = np.searchsorted(self.keys[0], wanted[0], "right")
        for keys, part in zip(self.keys[1:], wanted[1:], strict=True):
            low, high = _bisect(keys, part, low, high, False), _bisect(keys, part, low, high, True)
        return high if beyond else low

    def ranges(self, words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each given stretch of words."""
        ones = (1 << self.width) - 1
        least = _packed(words, starts, lengths, self.width, self.depth, 0)
        most = _packed(words, starts, lengths, self.width, self.depth, ones)
        return self._bound(least, False), self._bound(most, True)


def _spread(ends: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the lists ``which`` in a flat array whose lists end at ``ends``, and their owners' rows."""
    begins = np.append(0, ends[:-1])[which]
    sizes = ends[which] - begins
    rows = np.repeat(np.arange(len(which)), sizes)
    return np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begins[rows], rows


def _portions(sizes: np.ndarray, most: int = 1 << 20) -> Iterator[slice]:
    """Ranges of rows that spread over about ``most`` places, one row at least."""
    held = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(held, (held[at - 1] if at else 0) + most, "right")))
        yield slice(at, to)
        at = to


def occurrences(text: np.ndarray, block: TestBlock) -> tuple[np.ndarray, np.ndarray]:
    """All windows that occur in a shard, and the first word of each occurrence."""
    if not len(block.starts) or not len(text):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    index = SuffixArray(text, len(block.vocabulary), int(block.lengths.max()), int(block.lengths.min()))
    if not len(index.places):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, high = index.ranges(block.words, block.starts, block.lengths)
    at, windows = _spread(np.cumsum(high - low), np.arange(len(low)))
    begins = np.cumsum(high - low) - (high - low)
    return windows, index.places[at - begins[windows] + low[windows]]


def longest_matches(text: np.ndarray, block: TestBlock, windows: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, int]]:
    """``(place, words)`` of the matches with an item that go no further left.

    An occurrence whose word before also matches is part of a match that begins further left.
    """
    sizes = np.diff(block.share_ends, prepend=0)[windows]
    for part in _portions(sizes):
        rows, owner = _spread(block.share_ends, windows[part])
        test, train = block.shares[rows], places[part][owner]
        before = np.where(train > 0, text[np.maximum(train - 1, 0)], 0)
        known = np.where(test > 0, block.words[np.maximum(test - 1, 0)], 0)
        first = (before != known) | (before == 0)
        test, train = test[first], train[first]
        size = block.lengths[windows[part][owner[first]]].copy()
        live = np.arange(len(test))
        while len(live):
            a, b = test[live] + size[live], train[live] + size[live]  # both end with a 0
            live = live[(block.words[a] == text[b]) & (text[b] != 0)]
            size[live] += 1
        yield from zip(train.tolist(), size.tolist(), strict=True)


def _found(texts: pa.Array, block: TestBlock) -> list[pa.Array]:
    """The columns of ``FOUND`` for the texts of one shard."""
    dictionary, codes, bounds = word_lists(texts)
    numbers = pc.fill_null(pc.index_in(dictionary, value_set=block.vocabulary), -1).to_numpy(zero_copy_only=False)
    counts = np.diff(bounds)
    # a 0 after each text
    begins = bounds[:-1] + np.arange(len(counts))
    text = np.zeros(len(codes) + len(counts), np.int64)
    if len(codes):
        text[np.arange(len(codes)) + np.repeat(np.arange(len(counts)), counts)] = numbers[codes] + 1
    windows, places = occurrences(text, block)

    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, places, 1)
    np.add.at(change, places + block.lengths[windows], -1)
    hit = np.concatenate([[False], np.cumsum(change[:-1]) > 0, [False]])
    edges = np.flatnonzero(hit[1:] != hit[:-1])
    starts, ends = edges[0::2], edges[1::2]
    doc = np.searchsorted(begins, starts, "right") - 1
    spans = pa.StructArray.from_arrays(
        [pa.array(starts - begins[doc], pa.int32()), pa.array(ends - begins[doc], pa.int32())], ["start", "end"]
    )
    offsets = np.searchsorted(doc, np.arange(len(counts) + 1))

    seen = np.unique(np.stack([np.searchsorted(begins, places, "right") - 1, windows]), axis=1)
    pairs = np.zeros((2, 0), np.int64)
    for part in _portions(np.diff(block.owner_ends, prepend=0)[seen[1]]):
        rows, owner = _spread(block.owner_ends, seen[1, part])
        own = np.stack([seen[0, part][owner], block.owners[rows]])
        pairs = np.unique(np.concatenate([pairs, own], axis=1), axis=1)
    item_offsets = np.searchsorted(pairs[0], np.arange(len(counts) + 1))

    best: dict[int, tuple[int, int]] = {}
    for place, size in longest_matches(text, block, windows, places):
        at = int(np.searchsorted(begins, place, "right")) - 1
        best[at] = max(best.get(at, (0, 0)), (size, int(begins[at]) - place))
    return [
        pa.array(counts, pa.int64()),
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans),
        pa.ListArray.from_arrays(pa.array(item_offsets, pa.int32()), pa.array(pairs[1], pa.int64())),
        pa.array([best.get(i, (0, 0))[0] for i in range(len(counts))], pa.int32()),
        pa.array([-best[i][1] if i in best else None for i in range(len(counts))], pa.int32()),
    ]


def _search(docs: DataFrame, key: str, block: TestBlock) -> DataFrame:
    """``key`` and what one block of items has in each text."""
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for low, high in slices(texts, SHARD_BYTES):
                columns = _found(texts.slice(low, high - low), held)
                keys = batch.column(0).slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [keys, *columns], [key, "n_words", "spans", "items", "longest", "longest_start"]
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col("text").cast("string")).mapInArrow(run, f"{key} {kind}, {FOUND}")


def _blocks(benchmark: DataFrame, block_bytes: int, window: int) -> Iterator[TestBlock]:
    """The benchmark in blocks, one at a time; a text given twice goes to one block."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string").alias("text"))
    items = items.where("text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    count = max(1, -(-2 * total // block_bytes)) if total > block_bytes else 1
    for number in range(count):
        block = F.pmod(F.xxhash64("text"), F.lit(count)) == number
        rows = items.where(block).collect() if count > 1 else items.collect()
        yield prepare([r[0] for r in rows], [r[1] for r in rows], window)


def joined_spans(spans: Column) -> Column:
    """Spans that overlap or touch made one, by start."""
    step = lambda held, x: F.when(
        (F.size(held) > 0) & (F.element_at(held, -1)["end"] >= x["start"]),
        F.concat(
            F.slice(held, 1, F.size(held) - 1),
            F.array(
                F.struct(
                    F.element_at(held, -1)["start"].alias("start"),
                    F.greatest(F.element_at(held, -1)["end"], x["end"]).alias("end"),
                )
            ),
        ),
    ).otherwise(F.concat(held, F.array(x)))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    return F.aggregate(F.array_sort(spans), empty, step)


def find_items(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """For each text: its words, the spans hit, the items found, and the longest verbatim match."""
    blocks = _blocks(benchmark, block_bytes, window)
    first = next(blocks)
    second = next(blocks, None)
    if second is None:
        return _search(docs, key, first)
    rows = cut(docs.select(F.col(key).alias("_key"), "text", F.monotonically_increasing_id().alias("_row")))
    parts = [_search(rows.select("_row", "text"), "_row", block) for block in (first, second, *blocks)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part.where("size(spans) > 0"))
    found = found.groupBy("_row").agg(
        F.max("n_words").alias("n_words"),
        joined_spans(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max(F.struct("longest", (-F.col("longest_start")).alias("start"))).alias("best"),
    )
    found = found.withColumns({"longest": F.col("best.longest"), "longest_start": (-F.col("best.start")).cast("int")}).drop("best")
    return rows.select(F.col("_key").alias(key), "_row").join(found, "_row").drop("_row")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id``, the counts of words, hit words and items, the items themselves, and the verdict."""
    found = find_items(docs.select(F.col("doc_id").cast("long"), "text"), benchmark, "doc_id", window, block_bytes)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        "items",
        "spans",
        "longest",
        "longest_start",
        (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text no item hits."""
    digest = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    found = find_items(docs.select(digest.alias("digest"), "text"), benchmark, "digest", window, block_bytes)
    hit = found.where("size(spans) > 0").select(F.col("digest").alias("_hit_digest")).distinct()
    return docs.join(hit, digest == hit["_hit_digest"], "left_anti")


#: The same rows by a join of windows.
SQL = """
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
), i AS (
    SELECT item_id, w, least(10, len(w)) AS size FROM (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
        FROM benchmark) WHERE len(w) > 0
), windows AS (
    SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS words
    FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS p FROM i)
), sizes AS (
    SELECT DISTINCT size FROM windows
), places AS (
    SELECT r, p, size, array_to_string(w[p:p + size - 1], ' ') AS words
    FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, sizes WHERE len(w) >= size)
), hits AS (
    SELECT r, p, size, item_id FROM places JOIN windows USING (size, words)
), marked AS (
    SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(p, p + size)) AS word FROM hits) GROUP BY r
), items AS (
    SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (r) LEFT JOIN items USING (r)
"""
