"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallworks.session import shared_dir

#: Labelled rows that a classifier is fitted on, at most; every row is scored.
LABEL_BOUND = 40_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once for a row.

    A lambda's body is evaluated for every element, with all that the optimizer has put
    into it; a lambda variable is the one thing that it never expands.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def fold(key: Column, folds: int) -> Column:
    """``crc32(key as text) mod folds``; a null key is in fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(0))


def labelled_sample(labels: DataFrame, label: str, learn: Column, bound: int = LABEL_BOUND) -> DataFrame:
    """``doc_id, label`` of at most ``bound`` rows, those with the smallest hash of the key.

    A key labelled more than once keeps its larger label. The size is bounded, so the rows
    may be broadcast.
    """
    rows = labels.where(learn & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    rows = rows.groupBy("doc_id").agg(F.max(F.col(label)).cast("int").alias("label"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about ``most`` bytes of text, one row at least."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for i, size in enumerate(sizes):
        if i > at and held + size > most:
            yield at, i
            at, held = i, 0
        held += int(size)
    if at < len(sizes):
        yield at, len(sizes)


def coded_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words between ASCII white space, every text's words as codes, and its bounds."""
    split = pc.ascii_split_whitespace(texts)
    bounds = split.offsets.to_numpy().astype(np.int64)
    flat = split.values.slice(bounds[0], bounds[-1] - bounds[0])
    coded = flat.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), bounds - bounds[0]


def lean[In, Out](run: Callable[[Iterator[In]], Iterator[Out]]) -> Callable[[Iterator[In]], Iterator[Out]]:
    """``run`` for a task that, when it ends, gives back what Arrow keeps for later.

    A worker outlives its tasks, and would hold that memory while other stages run.
    """

    @wraps(run)
    def task(batches: Iterator[In]) -> Iterator[Out]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return task


def cut(rows: DataFrame) -> DataFrame:
    """``rows`` computed once and kept in the folder that ``spark.checkpoint.dir`` names.

    Only on a local master, as in tests, may the session name none.
    """
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(rows.sparkSession))
    return rows.checkpoint()
