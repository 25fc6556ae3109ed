"""Tokens of two tokenizers aligned by the bytes they stand for.

A text goes through tokenizer A with a space in front and through tokenizer B, which puts
one there itself. Neither merges a character that is no white space with a space after it,
so texts are cut in front of such spaces, and equal parts ("units") of a slice of texts are
tokenised and aligned once. The alignment is a chain of Arrow steps over all units of a
slice: token lists are flattened and keep their unit by parent index; cumulative sums of
token sizes, less their unit's base, are the places where tokens end; an Acero full join on
(unit, end) puts the ends of both sides in one table. Ends of both sides cut a unit into
groups. Between two ends next to each other lies one pair of tokens that overlap, a link,
and the tokens of a row without an end of their own are those of the next end.

Table.group_by counts the links of each id pair in a slice, Spark adds the counts up. A
second pass gives every slice the totals of its own pairs: one row for each distinct pair
of a slice, not one for each link, and a task holds one slice, whatever the corpus.

Defined results: null and empty texts, and texts that either side does not give back byte
by byte, have no tokens: zeros and an empty string; ties for a B id's best pair all count;
repeated documents are counted and returned one by one; one text is one slice at least, so
a task's memory follows the longest text; an empty table gives no row; other columns of
the input, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import threading
import uuid
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallworks.llm.common import slices
from stallworks.session import shared_dir

SLICE_BYTES = 4 << 20
#: Parts of units that a worker remembers before it starts anew.
PART_CACHE = 100_000

STORED = (
    "slice long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "units array<int>, pairs array<long>, times array<long>, unit_ends array<int>, links array<int>"
)
COUNTED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"

#: A piece that stands for one byte.
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
_LETTERS = "".join(chr(i) for i in [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])
#: Letters, then one run of marks: parts that A's pattern splits in the same way.
_PLAIN = re.compile(rf"([A-Za-z{_LETTERS}]*)([!-&(-/:-@\[-`{{-~]*)")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class TwoTokenizers:
    """Ids of both tokenizers for units, and the bytes that ids stand for."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the task has one core
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            known = all(c in alphabet for c in entry)
            self.bytes_a[i] = bytes(alphabet[c] for c in entry) if known else entry.encode()
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = _BYTE.fullmatch(piece)
            self.bytes_b.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        self.spelled_a, self.spelled_b = pa.array(self.bytes_a, pa.binary()), pa.array(self.bytes_b, pa.binary())
        self.size_a = np.asarray([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.asarray([len(x) for x in self.bytes_b], np.int64)
        self._encode, self._merge = self.a.encode_batch_fast, self.a.model.tokenize
        sign = {b: c for c, b in alphabet.items()}
        self._space = sign[32]
        self._letter = {ord(c): "".join(sign[b] for b in c.encode()) for c in _LETTERS + " "}
        self._known: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        """Ids of a part that A's pattern leaves whole, in its byte alphabet through its merges."""
        found = self._known.get(part)
        if found is None:
            spelled = part.replace(" ", self._space) if part.isascii() else part.translate(self._letter)
            found = array("i", [token.id for token in self._merge(spelled)]).tobytes()
            if len(self._known) >= PART_CACHE:
                self._known.clear()
            if len(part) <= 64:
                self._known[part] = found
        return found

    def encode(self, units: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Both sides' ids of each unit; a unit's leading space is left out in ``units``."""
        left, others = [], []
        for i, unit in enumerate(units):
            plain = _PLAIN.fullmatch(unit)
            if plain is None:
                others.append(i)
                left.append(b"")
                continue
            letters, marks = plain.groups()
            if letters:
                left.append(self._part(" " + letters) + self._part(marks) if marks else self._part(" " + letters))
            else:
                left.append(self._part(" " + marks))
        for low in range(0, len(others), 4096):
            part = others[low : low + 4096]
            for i, found in zip(part, self._encode([" " + units[i] for i in part], add_special_tokens=False), strict=True):
                left[i] = array("i", found.ids).tobytes()
        right = self.b.encode(units, num_threads=1)
        sizes = np.fromiter(map(len, right), np.int64, len(right))
        ids = np.fromiter(chain.from_iterable(right), np.int32, int(sizes.sum()))
        ends = [np.cumsum(np.fromiter(map(len, left), np.int64, len(left)) // 4), np.cumsum(sizes)]
        flat = [np.frombuffer(b"".join(left), np.int32), ids]
        return tuple(
            pa.ListArray.from_arrays(pa.array(np.append(0, end), pa.int32()), pa.array(x))
            for end, x in zip(ends, flat, strict=True)
        )


_READY: dict[tuple[str, str], TwoTokenizers] = {}
_LOCK = threading.Lock()


def tokenizers(path_a: str, path_b: str) -> TwoTokenizers:
    """One pair of tokenizers for each worker process."""
    with _LOCK:
        if (path_a, path_b) not in _READY:
            _READY[path_a, path_b] = TwoTokenizers(path_a, path_b)
        return _READY[path_a, path_b]


def _ends_plainly(words: pa.Array) -> np.ndarray:
    """Whether a space may be cut off after each word: it does not end in white space."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int32, len(words) + 1, words.offset * 4)
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    last = np.zeros(len(words), np.uint8)
    some = ends[1:] > ends[:-1]
    last[some] = held[ends[1:][some] - 1]
    plain = (last > 0x20) & (last < 0x7F)
    for i in np.flatnonzero(last >= 0x80).tolist():
        plain[i] = words[i].as_py()[-1].isalnum()
    return plain


def _numbered(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes that occur, and all of them renumbered without gaps."""
    seen = np.zeros(size, bool)
    seen[codes] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[codes]


def cut_units(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct units less the space in front of each, the texts' units as codes, and their bounds.

    Words between single spaces; one that is empty or ends in what may be white space stays
    with the next, and an empty last one with the word before.
    """
    split = pc.split_pattern(texts, " ")
    bounds = split.offsets.to_numpy().astype(np.int64)
    coded = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
    bounds -= bounds[0]
    words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
    plain = _ends_plainly(coded.dictionary)[codes]
    empty = (pc.binary_length(coded.dictionary).to_numpy() == 0)[codes]
    last = np.zeros(len(codes), bool)
    last[bounds[1:] - 1] = True
    glued = ~plain
    glued[:-1] |= last[1:] & empty[1:]
    glued[last] = False
    starts = np.flatnonzero(np.concatenate([[True], ~glued[:-1]])) if len(codes) else codes
    sizes = np.diff(np.append(starts, len(codes)))
    units = codes[starts]
    joined: dict[str, int] = {}
    for i in np.flatnonzero(sizes > 1).tolist():
        unit = " ".join(words[c] for c in codes[starts[i] : starts[i] + sizes[i]].tolist())
        units[i] = joined.setdefault(unit, len(words) + len(joined))
    words += joined
    used, units = _numbered(units, len(words))
    return [words[i] for i in used.tolist()], units, np.searchsorted(starts, bounds)


def _token_ends(ids: pa.ListArray, sizes: np.ndarray, side: str) -> pa.Table:
    """A row ``unit, end, id`` for each token, ends counted from the unit's first byte."""
    flat, unit = pc.list_flatten(ids), pc.list_parent_indices(ids)
    summed = pc.cumulative_sum(pa.array(sizes[flat.to_numpy()]))
    base = np.concatenate([[0], summed.to_numpy()])[ids.offsets.to_numpy()[:-1]]
    ends = pc.subtract(summed, pa.array(base, pa.int64()).take(unit))
    return pa.table({"unit": unit, "end": ends, side: flat})


def align(ids_a: pa.ListArray, ids_b: pa.ListArray, pair: TwoTokenizers) -> pa.Table:
    """The links of all units in order: ``unit, end, a, b, both``; ``both`` ends a group."""
    left, right = _token_ends(ids_a, pair.size_a, "a"), _token_ends(ids_b, pair.size_b, "b")
    rows = left.join(right, keys=["unit", "end"], join_type="full outer", use_threads=False)
    rows = rows.sort_by([("unit", "ascending"), ("end", "ascending")]).combine_chunks()
    a, b = rows["a"].combine_chunks(), rows["b"].combine_chunks()
    return pa.table(
        {
            "unit": rows["unit"].combine_chunks(),
            "a": pc.fill_null_backward(a),
            "b": pc.fill_null_backward(b),
            "ends_a": pc.is_valid(a),
            "ends_b": pc.is_valid(b),
            "both": pc.and_(pc.is_valid(a), pc.is_valid(b)),
        }
    )


def group_texts(links: pa.Table, count: int) -> pa.Array:
    """Each unit's groups: ``a1,a2|b1;a3|b2``."""
    unit = links["unit"].to_numpy()
    both = links["both"].to_numpy(zero_copy_only=False)
    group = np.cumsum(both) - both
    closes = np.append(unit[1:] != unit[:-1], True) if len(unit) else both
    parts, keys, owners = [], [], []
    for side, (id_name, ends, between) in enumerate((("a", "ends_a", "|"), ("b", "ends_b", ";"))):
        own = np.flatnonzero(links[ends].to_numpy(zero_copy_only=False))
        mark = np.where(both[own], between, ",").astype(object)
        if side:
            mark[closes[own]] = ""
        ids = pc.cast(links[id_name].combine_chunks().take(pa.array(own)), pa.string())
        parts.append(pc.binary_join_element_wise(ids, pa.array(mark, pa.string()), ""))
        keys.append(group[own] * 2 + side)
        owners.append(unit[own])
    order = np.argsort(np.concatenate(keys), kind="stable")
    offsets = np.searchsorted(np.concatenate(owners)[order], np.arange(count + 1))
    rows = pa.concat_arrays(parts).take(pa.array(order))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows), "")


def _given_back(texts: pa.Array, units: list[str], codes: np.ndarray, bounds: np.ndarray, ids: pa.ListArray, spelled: pa.Array) -> np.ndarray:
    """Which texts the tokens of one side join up to, with the space in front."""
    own = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, spelled.take(ids.values)), b"")
    want = pc.cast(pc.binary_join_element_wise("", pa.array(units, pa.string()), " "), pa.binary())
    differs = pc.not_equal(own, want).to_numpy(zero_copy_only=False)
    good = np.ones(len(texts), bool)
    for i in np.unique(np.searchsorted(bounds, np.flatnonzero(differs[codes]), "right") - 1).tolist():
        whole = b"".join(own.take(pa.array(codes[bounds[i] : bounds[i + 1]])).to_pylist())
        good[i] = whole == b" " + texts[i].as_py().encode()
    return good


def _aligned(number: int, keys: pa.Array, texts: pa.Array, pair: TwoTokenizers, digest: bool) -> pa.RecordBatch:
    """A slice's documents, and one row with its links, as ``STORED``."""
    some = np.flatnonzero(pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    chosen = texts.take(pa.array(some))
    units, codes, bounds = cut_units(chosen) if len(some) else ([], np.zeros(0, np.int64), np.zeros(1, np.int64))
    ids_a, ids_b = pair.encode(units)
    good = _given_back(chosen, units, codes, bounds, ids_a, pair.spelled_a)
    good &= _given_back(chosen, units, codes, bounds, ids_b, pair.spelled_b)
    # units of texts without tokens are not counted; units of none are not aligned
    codes = codes[np.repeat(good, np.diff(bounds))]
    some, sizes = some[good], np.diff(bounds)[good]
    used, codes = _numbered(codes, len(units))
    if len(used) < len(units):
        ids_a, ids_b = ids_a.take(pa.array(used)), ids_b.take(pa.array(used))
    bounds = np.concatenate([[0], np.cumsum(sizes)])

    links = align(ids_a, ids_b, pair)
    unit = links["unit"].to_numpy()
    words = group_texts(links, len(used))
    texts_of = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), words.take(pa.array(codes))), ";")
    groups = [hashlib.sha256(x.as_buffer()).hexdigest() for x in texts_of] if digest else texts_of.to_pylist()

    times = pa.table({"unit": pa.array(codes)}).group_by("unit").aggregate([("unit", "count")])
    often = np.zeros(len(used), np.int64)
    often[times["unit"].to_numpy()] = times["unit_count"].to_numpy()
    packed = pc.bit_wise_or(
        pc.shift_left(links["a"].cast(pa.int64()), pa.scalar(32, pa.int64())), links["b"].cast(pa.int64())
    ).combine_chunks()
    coded = packed.dictionary_encode()
    counted = pa.table({"pair": coded.indices, "n": pa.array(often[unit])}).group_by("pair").aggregate([("n", "sum")])
    totals = np.zeros(len(coded.dictionary), np.int64)
    totals[counted["pair"].to_numpy()] = counted["n_sum"].to_numpy()

    def summed(each: np.ndarray) -> np.ndarray:
        held = np.concatenate([[0], np.cumsum(each[codes])])
        full = np.zeros(len(texts), np.int64)
        full[some] = np.diff(held[bounds])
        return full

    per_unit = lambda name: np.bincount(unit, links[name].to_numpy(zero_copy_only=False), len(used)).astype(np.int64)
    all_groups: list[str | None] = [""] * len(texts)
    for i, text in zip(some.tolist(), groups, strict=True):
        all_groups[i] = text
    ends = np.zeros(len(texts), np.int64)
    ends[some] = sizes
    n = len(texts)
    unit_lists = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(ends)]), pa.int32()), pa.array(codes, pa.int32())
    )

    def last(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.array([None] * n + [values], pa.list_(kind))

    def rows(values: np.ndarray) -> pa.Array:
        return pa.concat_arrays([pa.array(values, pa.int64()), pa.nulls(1, pa.int64())])

    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n + 1, number), pa.int64()),
            pa.concat_arrays([pc.cast(keys, pa.int64()), pa.nulls(1, pa.int64())]),
            rows(summed(per_unit("ends_a"))),
            rows(summed(per_unit("ends_b"))),
            rows(summed(per_unit("both"))),
            rows(summed(np.bincount(unit, minlength=len(used)))),
            pa.array([*all_groups, None], pa.string()),
            pa.concat_arrays([unit_lists, pa.nulls(1, unit_lists.type)]),
            last(coded.dictionary.to_numpy(), pa.int64()),
            last(totals, pa.int64()),
            last(np.cumsum(np.bincount(unit, minlength=len(used))), pa.int32()),
            last(coded.indices.to_numpy(), pa.int32()),
        ],
        [part.split()[0] for part in STORED.split(", ")],
    )


def aligned_slices(docs: DataFrame, path_a: str, path_b: str, digest: bool = False) -> DataFrame:
    """Documents with their units, and a row for each slice's links, as ``STORED``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for low, high in slices(texts, SLICE_BYTES):
                yield _aligned(number, batch.column(0)[low:high], texts[low:high], pair, digest)
                number += 1

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, STORED)


def pair_counts(stored: DataFrame) -> DataFrame:
    """``pair, count, best``: links of each id pair in the corpus, and whether its B id has none with more."""
    part = stored.where("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = part.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("count"))
    counts = counts.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _with_counts(left: pa.Table, right: pa.Table) -> pa.Table:
    """A slice's documents with the sums over their links of what the corpus counted."""
    is_links = pc.is_valid(left["pairs"])
    own, docs = left.filter(is_links), left.filter(pc.invert(is_links)).combine_chunks()
    pairs = pa.table({"pair": own["pairs"].combine_chunks().flatten()})
    number = pa.array(np.arange(len(pairs)))
    totals = pairs.append_column("number", number).join(right.select(["pair", "count", "best"]), "pair", use_threads=False)
    totals = totals.sort_by("number")
    links = own["links"].combine_chunks().flatten().to_numpy()
    ends = own["unit_ends"].combine_chunks().flatten().to_numpy()
    units = docs["units"].combine_chunks() if len(docs) else pa.array([], pa.list_(pa.int32()))
    flat, parent = pc.list_flatten(units).to_numpy(), pc.list_parent_indices(units).to_numpy()

    def summed(values: np.ndarray) -> pa.Array:
        held = np.concatenate([[0], np.cumsum(values[links])])
        each = np.diff(held[np.concatenate([[0], ends])])
        full = np.zeros(len(docs), np.int64)
        found = pa.table({"row": parent, "n": each[flat]}).group_by("row").aggregate([("n", "sum")])
        full[found["row"].to_numpy()] = found["n_sum"].to_numpy()
        return pa.array(full)

    best = summed(totals["best"].to_numpy().astype(np.int64))
    count_sum = summed(totals["count"].to_numpy())
    named = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    return named.append_column("n_best", best).append_column("count_sum", count_sum).append_column("groups", docs["groups"])


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, digest: bool = False) -> DataFrame:
    """Each text's alignment (``COUNTED``); ``groups`` holds the groups or, as ``digest``, their SHA-256.

    The slices are written to the folder that ``spark.checkpoint.dir`` names, so that a lost
    executor repeats no tokenising and both passes see the same slices.
    """
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/aligned-{uuid.uuid4().hex[:12]}"
    aligned_slices(docs, path_a, path_b, digest).write.parquet(path)
    links = spark.read.parquet(path).where("pairs IS NOT NULL")
    own = links.select(F.col("slice").alias("of"), F.explode("pairs").alias("pair"))
    totals = own.join(pair_counts(links), "pair")
    return spark.read.parquet(path).groupBy("slice").cogroup(totals.groupBy("of")).applyInArrow(_with_counts, COUNTED)
