"""MinHash near-duplicates with sequential Bayesian verification.

1. A text's set holds the hashes of its distinct word shingles. Texts of equal sets are one
   class with a number of its own, and its smallest ``doc_id`` and text hash stand for it;
   only these go on.
2. A signature of ``BANDS * ROWS`` minima is cut into bands; classes that share a band are a
   bucket. A pair with the least similarity of 0.85 shares none with probability
   ``(1 - 0.85**4)**16``, under 1e-5.
3. Rounds: every bucket picks a hub among its members and compares the others with it. A
   pair's signatures are compared batch after batch; it is given up as soon as the
   posterior probability that its similarity reaches the threshold falls below
   ``MISS``, and what survives all batches is verified on the full shingle sets.
4. Links give components (iterated hooking of labels). A bucket whose members lie in one
   component is done. In the others, all members outside the bucket's largest component
   are compared with the members of other components, in blocks of ``BLOCK`` rows, so no
   pair that could join two components is left out and none inside a component is tried. A
   block verifies on the full sets itself and returns the links that join its components.

Nothing is capped: a large bucket costs more blocks, not fewer comparisons. Hashes have 64
bits. Defined results: null text has no set, no link and stands alone; texts with fewer
words than a shingle have their whole word sequence as the one shingle; different texts of
one ``doc_id`` are documents of their own, rows of the same ``doc_id`` and text are one that
counts its rows; a null ``doc_id`` is not in the result, and ``unnamed`` gives those rows, each on its own; an
empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallworks.llm.common import coded_words, cut, lean, slices

BANDS, ROWS = 16, 4
MISS = 1e-10
BATCH = 8
BLOCK = 1024
SLICE_BYTES = 2 << 20

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words; only A to Z are lower-cased."""
    lower = pc.ascii_lower(words)
    return pd.util.hash_array(lower.to_numpy(zero_copy_only=False), categorize=False).astype(np.uint64)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, codes, bounds = coded_words(texts)
    # empty strings stand where a text begins or ends with white space
    filled = (pc.binary_length(words).to_numpy(zero_copy_only=False) > 0)[codes] if len(codes) else np.zeros(0, bool)
    hashes = (_word_hashes(words) if len(words) else np.zeros(0, np.uint64))[codes][filled]
    kept = np.concatenate([[0], np.cumsum(filled)])[bounds]
    out = []
    for a, b in zip(kept[:-1], kept[1:], strict=True):
        own, n = hashes[a:b], min(size, int(b - a))
        if not n:
            out.append(own)
            continue
        total = np.full(len(own) - n + 1, n, np.uint64)
        for k in range(n):
            total = mix(total + own[k : len(own) - n + 1 + k] + np.uint64(0x9E3779B97F4A7C15))
        out.append(np.unique(total))
    return out


def signature(hashes: np.ndarray, width: int) -> np.ndarray:
    """The minima of ``width`` hash functions over a set, 32 bits each."""
    salts = mix(np.arange(1, width + 1, dtype=np.uint64))
    least = np.full(width, np.uint32(0xFFFFFFFF), np.uint32)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096]
        spread = ((part[:, None] ^ salts) * _MIX1 >> np.uint64(32)).astype(np.uint32)
        least = np.minimum(least, spread.min(axis=0))
    return least


def signatures(docs: DataFrame, size: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, key, n_shingles, digest, signature``: the digest identifies the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(2), "")
            for low, high in slices(texts, SLICE_BYTES):
                sets = shingle_sets(texts.slice(low, high - low), size)
                sums = [hashlib.blake2b(s, digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        batch.column(1).slice(low, high - low),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(sums, pa.binary()),
                        pa.array([signature(s, bands * rows).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["doc_id", "key", "n_shingles", "digest", "signature"],
                )

    return _keyed(docs).mapInArrow(lean(run), "doc_id long, key long, n_shingles long, digest binary, signature binary")


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, key, text``; ``key`` is the text's hash, with null as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("key"), text.alias("text"))


def unnamed(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for rows without a ``doc_id``."""
    rows = signatures(docs.where(F.col("doc_id").cast("long").isNull()), shingle, 1, 1)
    return rows.select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"))


def least_matches(threshold: float, width: int, batch: int, miss: float) -> list[int]:
    """For each batch the fewest equal minima so far that keep a pair in the race.

    With a uniform prior on the similarity ``s``, ``m`` of ``n`` equal minima give a
    ``Beta(m + 1, n - m + 1)`` posterior; the pair stays while ``P(s >= threshold)`` is at
    least ``miss``. The tail is a binomial sum: ``P(Beta(a, b) >= t) = P(Bin(a+b-1, t) < a)``.
    """
    out = []
    for n in range(batch, width + 1, batch):
        tail, m = 0.0, -1
        while tail < miss and m < n:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def survivors(left: np.ndarray, right: np.ndarray, needed: list[int], batch: int) -> np.ndarray:
    """Which pairs of signature rows pass every batch; later batches see survivors alone."""
    alive = np.arange(len(left))
    equal = np.zeros(len(left), np.int64)
    for k, least in enumerate(needed):
        cols = slice(k * batch, (k + 1) * batch)
        equal[alive] += (left[alive, cols] == right[alive, cols]).sum(axis=1)
        alive = alive[equal[alive] >= least]
    return alive


def _rows_of(blobs: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.uint32).reshape(len(blobs), width)


def _buckets(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """``bucket, band, rep, size`` of buckets with two members or more."""
    width = 4 * rows
    keys = F.array(
        *(F.xxhash64(F.lit(b), F.expr(f"substring(signature, {b * width + 1}, {width})")) for b in range(bands))
    )
    each = classes.select("rep", F.posexplode(keys).alias("band", "bucket"))
    sizes = each.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return each.join(sizes, "bucket").select("bucket", "band", "rep", "size")


def _similar(pairs: DataFrame, classes: DataFrame, needed: list[int], width: int) -> DataFrame:
    """The pairs whose signatures pass every batch of the sequential test."""
    left = classes.select(F.col("rep").alias("a"), F.col("signature").alias("sa"))
    right = classes.select(F.col("rep").alias("b"), F.col("signature").alias("sb"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            alive = survivors(_rows_of(frame["sa"], width), _rows_of(frame["sb"], width), needed, BATCH)
            yield frame[["a", "b"]].iloc[alive]

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInPandas(lean(run), "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have ``100 * intersection >= percent * union``."""
    left = sets.select(F.col("rep").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("rep").alias("b"), F.col("hashes").alias("hb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "ha", "hb")
    return rows.mapInArrow(lean(run), "a long, b long")


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same components from fewer links: each portion's nodes linked to the smallest they reach in it."""
    for batch in batches:
        names, ends = np.unique(np.concatenate([batch.column(0).to_numpy(), batch.column(1).to_numpy()]), return_inverse=True)
        root = list(range(len(names)))
        for x, y in zip(ends[: len(batch)].tolist(), ends[len(batch) :].tolist(), strict=True):
            while root[x] != x:
                root[x] = x = root[root[x]]
            while root[y] != y:
                root[y] = y = root[root[y]]
            root[max(x, y)] = min(x, y)
        for i, above in enumerate(root):  # a root is never above what hangs from it
            root[i] = root[above]
        own = np.asarray(root, np.int64)
        far = np.flatnonzero(own != np.arange(len(names)))
        yield pa.RecordBatch.from_arrays([pa.array(names[own[far]]), pa.array(names[far])], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """``rep, component``: the smallest member of every connected component of ``a, b``.

    Links are thinned portion by portion first. Each turn takes the smallest label among the
    neighbours and then the label's own label, so chains shorten by half; the loop ends when
    no label changes.
    """
    thin = links.select("a", "b").where("a <> b").mapInArrow(lean(_forests), "a long, b long")
    both = cut(thin.union(thin.select("b", "a")).distinct())
    labels = cut(both.groupBy(F.col("a").alias("rep")).agg(F.least(F.min("b"), F.min("a")).alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("rep", "b"), "b").select(F.col("a").alias("rep"), "component", F.lit(None).cast("long").alias("old"))
        own = labels.select("rep", "component", F.col("component").alias("old"))
        stepped = near.union(own).groupBy("rep").agg(F.max("old").alias("old"), F.min("component").alias("component"))
        target = labels.select(F.col("rep").alias("component"), F.col("component").alias("beyond"))
        stepped = cut(
            stepped.join(target, "component", "left").select(
                "rep", "old", F.coalesce(F.least("component", "beyond"), "component").alias("component")
            )
        )
        labels = stepped.select("rep", "component")
        if stepped.where("component < old").isEmpty():
            return labels


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("component", F.col("rep"))
    return members.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def _open(members: DataFrame) -> DataFrame:
    """Members of the buckets that more than one component is left in."""
    spread = members.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    return members.join(spread.where("x <> y").select("bucket"), "bucket", "left_semi")


def _overlaps(own: np.ndarray, codes: np.ndarray, begins: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """How many codes of each of many sets, laid end to end, are among ``own``."""
    flags[own] = 1
    counts = np.add.reduceat(flags[codes], begins)
    flags[own] = 0
    return counts


def _block_links(frame: pd.DataFrame, needed: list[int], rows: int, bands: int, percent: int) -> list[tuple[int, int]]:
    """Verified links between the two sides of a block, as many as join its components.

    A pair is tried in the first band it shares, if no link found so far connects it. The
    sequential test on signatures comes first, then the full sets.
    """
    width = rows * bands
    left, right = (frame[frame["side"] == k] for k in (0, 1))
    if not len(left) or not len(right):
        return []
    band = int(frame["band"].iloc[0])
    one, two = _rows_of(left["signature"], width), _rows_of(right["signature"], width)
    reps, outside = right["rep"].to_numpy(), right["outside"].to_numpy()
    names, roots = np.unique(np.concatenate([left["component"], right["component"]]), return_inverse=True)
    root = np.arange(len(names))
    mine, theirs = roots[: len(left)], roots[len(left) :]
    blobs = [np.frombuffer(x, np.uint64) for x in (*left["hashes"], *right["hashes"])]
    sizes = np.fromiter(map(len, blobs), np.int64, len(blobs))
    _, codes = np.unique(np.concatenate(blobs), return_inverse=True)
    begins = np.cumsum(sizes) - sizes
    flags = np.zeros(int(codes.max()) + 1, np.int64)
    found: list[tuple[int, int]] = []
    for i, (rep, own) in enumerate(zip(left["rep"].to_numpy(), one, strict=True)):
        tried = np.flatnonzero((root[theirs] != root[mine[i]]) & (~outside | (reps > rep)))
        for earlier in range(band):
            part = slice(earlier * rows, (earlier + 1) * rows)
            tried = tried[(two[tried, part] != own[part]).any(axis=1)]
        alive = tried[survivors(np.broadcast_to(own, (len(tried), width)), two[tried], needed, BATCH)]
        if not len(alive):
            continue
        mass = sizes[len(left) + alive]
        ends = np.cumsum(mass)
        spots = np.repeat(begins[len(left) + alive] - (ends - mass), mass) + np.arange(ends[-1])
        both = _overlaps(codes[begins[i] : begins[i] + sizes[i]], codes[spots], ends - mass, flags)
        linked = alive[100 * both >= percent * (sizes[i] + mass - both)]
        for j in linked:
            if root[theirs[j]] != root[mine[i]]:
                root[root == root[theirs[j]]] = root[mine[i]]
                found.append((int(rep), int(reps[j])))
    return found


def _between(members: DataFrame, classes: DataFrame, sets: DataFrame, needed: list[int], rows: int, bands: int, percent: int) -> DataFrame:
    """Links between different components within buckets, block by block.

    Members outside a bucket's largest component are held against all of another one.
    """
    sized = members.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    most = sized.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("all"))
    each = members.select("bucket", "band", "rep", "component").join(most, "bucket")
    each = each.join(classes.select("rep", "signature").join(sets, "rep"), "rep")
    blocks = F.ceil(F.col("all") / BLOCK).cast("int")
    each = each.select(
        "bucket", "band", "rep", "component", "signature", "hashes",
        (F.col("component") != F.col("main")).alias("outside"),
        blocks.alias("blocks"),
        F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("own"),
    )
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = each.where("outside").withColumn("other", every).withColumn("side", F.lit(0))
    right = each.withColumnsRenamed({"own": "other"}).withColumn("own", every).withColumn("side", F.lit(1))
    names = ["bucket", "own", "other", "side", "band", "rep", "component", "signature", "hashes", "outside"]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_block_links(frame, needed, rows, bands, percent), columns=["a", "b"], dtype="int64")

    both = left.select(*names).union(right.select(*names))
    return both.groupBy("bucket", "own", "other").applyInPandas(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    star_rounds: int = 1,
) -> DataFrame:
    """``doc_id, key, n_shingles, component_id, kept, n_rows`` for every text of every document.

    ``key`` is the text's ``xxhash64``; one ``doc_id`` and ``key`` of a component is kept;
    ``n_rows`` counts the input's rows of it.
    """
    width = bands * rows
    needed = least_matches(percent / 100, width, BATCH, MISS)
    named = docs.where(F.col("doc_id").cast("long").isNotNull())
    signed = signatures(named, shingle, bands, rows).groupBy("doc_id", "key").agg(
        F.max_by(F.struct("n_shingles", "digest", "signature"), F.struct("n_shingles", "digest")).alias("s"),
        F.count("*").alias("n_rows"),
    )
    signed = cut(signed.select("doc_id", "key", "n_rows", "s.*"))
    classes = cut(
        signed.where("n_shingles > 0")
        .groupBy("digest")
        .agg(F.min(F.struct("doc_id", "key")).alias("first"), F.min("signature").alias("signature"))
        .select(F.monotonically_increasing_id().alias("rep"), "first", "digest", "signature")
    )
    members = _buckets(classes, bands, rows)
    central = members.groupBy("rep").agg(F.sum("size").alias("near"))
    members = cut(members.join(central, "rep").select("bucket", "band", "rep", "near"))
    wanted = classes.join(members.select("rep").distinct(), "rep").select("rep", "first.*")
    sets = cut(_sets(docs, wanted, shingle))
    links: DataFrame | None = None
    labels: DataFrame | None = None
    for turn in range(star_rounds + 1):
        left = _open(_labelled(members, labels))
        if turn < star_rounds:
            hubs = left.groupBy("bucket").agg(F.max_by("rep", F.struct("near", F.xxhash64("rep"))).alias("hub"))
            hubs_of = cut(left.join(hubs, "bucket").select("bucket", "band", "rep", "near", "component", "hub"))
            far = hubs_of.select("bucket", F.col("rep").alias("hub"), F.col("component").alias("own"))
            tried = hubs_of.join(far, ["bucket", "hub"]).where("component <> own")
            pairs = tried.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()
            linked = _verified(_similar(pairs, classes, needed, width), sets, percent)
            members = hubs_of.where("rep <> hub").select("bucket", "band", "rep", "near")
        else:
            left = cut(left)
            if left.isEmpty():
                break
            linked = _between(left, classes, sets, needed, rows, bands, percent)
        links = cut(linked if links is None else links.union(linked))
        labels = components(links)
    by_class = _labelled(classes.select("rep", "first", "digest"), labels)
    firsts = by_class.groupBy("component").agg(F.min("first").alias("first"))
    by_class = by_class.select("digest", "component").join(firsts, "component").select("digest", "first")
    out = signed.select("doc_id", "key", "n_rows", "n_shingles", "digest").join(by_class, "digest", "left")
    own = F.struct("doc_id", "key")
    first = F.when(F.col("n_shingles") > 0, F.col("first")).otherwise(own)
    return out.select("doc_id", "key", "n_shingles", first["doc_id"].alias("component_id"), (first == own).alias("kept"), "n_rows")


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``rep, hashes``: the sorted full set of each wanted ``doc_id, key``, 8 bytes a shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for low, high in slices(texts, SLICE_BYTES):
                blobs = [s.tobytes() for s in shingle_sets(texts.slice(low, high - low), size)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(blobs, pa.binary())], ["rep", "hashes"]
                )

    rows = _keyed(docs).join(wanted, ["doc_id", "key"]).select("rep", "text")
    sets = rows.mapInArrow(lean(run), "rep long, hashes binary")
    return sets.groupBy("rep").agg(F.max_by("hashes", F.struct(F.length("hashes"), F.xxhash64("hashes"))).alias("hashes"))
