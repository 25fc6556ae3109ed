"""Best-fit packing of tokenised documents by the sum-of-squares rule.

Documents become token ids, documents longer than a sequence are cut into pieces of the
sequence length, and pieces are placed one after the other. With ``n(g)`` open sequences
that have ``g`` tokens left, a piece goes where the sum of ``n(g)**2`` becomes smallest;
ties go to the smallest gap that fits. A large residual count is thus broken up before
it builds up, and gaps stay spread so that later pieces find an exact fit.

Pieces of full length are sequences of their own and are held by no task. The others, one
for each document at most, are dealt evenly over blocks, as many as keep the number of
documents of a block at ``block_rows``, and every block is packed on its own, so a task's
memory grows neither with the corpus nor with the length of its texts. A block leaves a
handful of sequences with room at its end.

Defined results: null text is the empty text, which is one piece holding the end id
alone; repeated rows are packed once each; a null doc_id is packed like any other; an
empty table gives no row; other columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stallworks.llm.common import slices

SEQUENCE_LENGTH = 4096
END_ID = 1
BLOCK_ROWS = 16384
#: Text bytes tokenised at a time, words a worker remembers before it starts anew, and rows given back at a time.
SLICE_BYTES = 1 << 20
WORD_CACHE = 100_000
YIELD_ROWS = 512

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids binary"

#: Letters, then one run of marks: splits the same way in the tokenizer's own pattern.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")


class WordEncoder:
    """Token ids of white-space separated words, each distinct word encoded once.

    The tokenizer drops white space and never merges across it, so a text's ids are its
    words' ids one after the other. A word that is letters and then marks is two units of
    the tokenizer's pre-tokenisation; its halves go, in lower case and in the tokenizer's
    byte alphabet, straight to its merge model. Any other word takes the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        whole = Tokenizer.from_file(path)
        self._encode, self._merge = whole.encode, whole.model.tokenize
        in_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(i) for i in range(0xDF, 0x100) if chr(i).isalpha()]
        self._alphabet = {ord(c): in_bytes.pre_tokenize_str(c)[0][0] for c in letters}
        self._words: dict[str, bytes] = {}
        self._units: dict[str, bytes] = {}

    def _unit(self, unit: str) -> bytes:
        found = self._units.get(unit)
        if found is None:
            spelled = unit if unit.isascii() else unit.translate(self._alphabet)
            tokens = [token.id for token in self._merge(spelled)]
            found = array("I", tokens).tobytes()
            if len(self._units) >= WORD_CACHE:
                self._units.clear()
            self._units[unit] = found
        return found

    def _word(self, word: str) -> bytes:
        plain = _PLAIN.fullmatch(word) if len(word) <= 64 else None
        if plain is None:
            found = array("I", self._encode(word, add_special_tokens=False).ids).tobytes()
        else:
            letters, marks = plain.groups()
            found = self._unit(letters.lower()) if letters else b""
            if marks:
                found += self._unit(marks)
        if len(self._words) >= WORD_CACHE:
            self._words.clear()
        if len(word) <= 64:
            self._words[word] = found
        return found

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and the offsets at which each text's ids begin."""
        split = pc.ascii_split_whitespace(texts)
        bounds = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        known, new = self._words.get, self._word
        units = [known(w) or new(w) for w in coded.dictionary.to_numpy(zero_copy_only=False)]
        sizes = np.fromiter(map(len, units), np.int64, len(units)) // 4
        table = np.frombuffer(b"".join(units), "<u4")
        begins = np.cumsum(sizes) - sizes
        codes = coded.indices.to_numpy()
        each = sizes[codes]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        ids = table[np.arange(total) + np.repeat(begins[codes] - (ends - each), each)]
        return ids, np.concatenate([[0], ends])[bounds - bounds[0]]


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One encoder for each worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    sequence_length: int = SEQUENCE_LENGTH,
    end_id: int = END_ID,
) -> DataFrame:
    """``doc_id, piece, start, length, ids``: ids are little-endian unsigned 32-bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        end = np.asarray([end_id], "<u4")
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for low, high in slices(texts, SLICE_BYTES):
                ids, bounds = encoder.texts(texts.slice(low, high - low))
                rows: list[tuple[int, int, int, int, bytes]] = []
                keys = batch.column(0).slice(low, high - low).to_pylist()
                for key, a, b in zip(keys, bounds[:-1], bounds[1:], strict=True):
                    own = np.concatenate([ids[a:b], end])
                    for piece, start in enumerate(range(0, len(own), sequence_length)):
                        part = own[start : start + sequence_length]
                        rows.append((key, piece, start, len(part), part.tobytes()))
                cols = list(zip(*rows, strict=True))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, PIECE_SCHEMA)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length, placed in the given order.

    Putting a piece of ``s`` tokens into a gap ``g`` changes the sum of squares by
    ``2 * (n(g - s) - n(g) + 1)``; a gap that is filled up leaves the sum, and a new
    sequence enters it. One pass over the open gaps finds the smallest change.
    """
    count = np.zeros(capacity + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = 0
    for i, s in enumerate(lengths.tolist()):
        open_gaps = count[s:capacity]
        change = np.where(open_gaps > 0, 2 * (count[: capacity - s] - open_gaps + 1), np.iinfo(np.int64).max)
        if len(change):
            change[0] -= 1 if open_gaps[0] else 0  # filled up: it leaves the sum
        best = int(change.argmin()) if len(change) else -1
        fresh = 2 * count[capacity - s] + 1 if s < capacity else 0
        if best < 0 or change[best] > fresh or not open_gaps[best]:
            gap, own = capacity, opened
            opened += 1
        else:
            gap = best + s
            own = stacks[gap].pop()
            count[gap] -= 1
        sequence[i], offset[i] = own, capacity - gap
        if gap > s:
            stacks[gap - s].append(own)
            count[gap - s] += 1
    return sequence, offset


def _block(
    batches: Iterator[pa.RecordBatch], at: int, sequence_length: int, first: int, names: list[str]
) -> Iterator[pa.RecordBatch]:
    """One block's pieces with their places; ``at`` is the column of lengths, ``first`` the first sequence.

    The pieces that wait for the others are held once, as they came where none is left out.
    """

    def placed(part: pa.RecordBatch, sequence: np.ndarray, offset: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*part.columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names)

    held, full = [], first + (1 << 39)
    for batch in batches:
        whole = pc.greater_equal(batch.column(at), sequence_length)
        if pc.any(whole, skip_nulls=False).as_py() is not False:
            part = batch.filter(whole)
            if len(part):
                yield placed(part, full + np.arange(len(part)), np.zeros(len(part), np.int64))
                full += len(part)
            batch = batch.filter(pc.invert(whole))
        held.append(batch)
    every = pa.Table.from_batches(held) if held else None
    if not every:
        return
    order = pc.sort_indices(every, [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
    lengths = every.column(at).to_numpy()[order.to_numpy()].astype(np.int64)
    sequence, offset = sum_of_squares(lengths, sequence_length)
    for low in range(0, len(lengths), YIELD_ROWS):
        cut = slice(low, low + YIELD_ROWS)
        for part in every.take(order[cut]).combine_chunks().to_batches():
            yield placed(part, first + sequence[cut], offset[cut])


def pack(
    pieces: DataFrame, blocks: int, sequence_length: int = SEQUENCE_LENGTH
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; needs ``doc_id, piece, length``.

    Rows are dealt evenly over ``blocks`` tasks, whatever their keys, and each task packs
    what it got, ordered by length and key so that a repeated task gives the same answer.
    Pieces of full length are sequences of their own and are passed on as they come; only
    the shorter ones, one for each document at most, are held until all have come. Other
    columns (the ids, or digests of them) ride along.
    """
    rows = pieces.drop("sequence_id", "offset")
    schema = StructType(
        [*rows.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())]
    )
    at = rows.columns.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _block(batches, at, sequence_length, TaskContext.get().partitionId() << 40, schema.names)

    return rows.repartition(blocks).mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    sequence_length: int = SEQUENCE_LENGTH,
    end_id: int = END_ID,
    block_rows: int = BLOCK_ROWS,
    digest: bool = False,
) -> DataFrame:
    """Pieces of all documents with their ids and places; ``digest`` keeps a CRC instead of ids.

    A document has at most one piece that shares a sequence, so the number of documents
    sets the number of blocks.
    """
    blocks = max(1, math.ceil(docs.count() / block_rows))
    pieces = token_pieces(docs, tokenizer_path, sequence_length, end_id)
    if digest:
        pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(pieces, blocks, sequence_length)
