"""Document fingerprints by winnowing, in DataFrame functions alone.

The hashes of ``GRAM`` neighbouring words are rolled over the text; of every ``SPAN``
neighbouring hashes the smallest is kept, the rightmost of equal ones, with its place.
Two texts that share a run of ``GRAM + SPAN - 1`` words therefore share a kept hash, and
its places tell where. A text with fewer hashes than a window keeps its smallest; one with
fewer words than a gram has the hash of the words it has. White space separates words and
is otherwise ignored.

A kept entry is one long: 36 bits of hash above 27 bits that count places from the right,
so the smallest long is the smallest hash and of these the rightmost.

Defined results: null or empty text has no word and an empty fingerprint, and two empty
fingerprints are alike (1.0); repeated rows are ordered by their text and get a row each;
a null doc_id comes after all others; an empty table gives no row; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallworks.llm.common import let

GRAM, SPAN = 3, 8
PLACE_BITS = 27
_PLACES = (1 << PLACE_BITS) - 1
GAP = r"[\x20\x09-\x0D]+"


def entries(text: Column, gram: int = GRAM, span: int = SPAN) -> Column:
    """The kept entries of a text in the order of their places."""

    def rolled(h: Column) -> Column:
        count = F.size(h) - F.least(F.size(h), F.lit(gram)) + 1
        whole = F.array(F.xxhash64(h))
        many = F.transform(
            F.slice(h, F.lit(1), count), lambda _, i: F.xxhash64(*(F.get(h, i + k) for k in range(gram)))
        )
        return F.when(F.size(h) < gram, whole).otherwise(many)

    def packed(h: Column) -> Column:
        return F.transform(
            rolled(h),
            lambda x, i: F.shiftleft(F.shiftrightunsigned(x, 64 - 36), PLACE_BITS) + (F.lit(_PLACES) - i),
        )

    def kept(p: Column) -> Column:
        windows = F.transform(
            F.slice(p, F.lit(1), F.greatest(F.size(p) - (span - 1), F.lit(1))),
            lambda _, i: F.array_min(F.slice(p, i + 1, F.lit(span))),
        )
        return F.array_distinct(windows)

    words = F.array_remove(F.split(text, GAP, -1), "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    none = F.lit([]).cast("array<bigint>")
    return let(
        hashes, lambda h: F.when(F.size(h) == 0, none).otherwise(let(packed(h), kept))
    )


def hashes_of(kept: Column) -> Column:
    """The kept hashes, 36 bits each."""
    return F.transform(kept, lambda x: F.shiftright(x, PLACE_BITS))


def places_of(kept: Column) -> Column:
    """Where the kept grams begin, in words from 0."""
    return F.transform(kept, lambda x: (F.lit(_PLACES) - x.bitwiseAND(F.lit(_PLACES))).cast("int"))


def likeness(left: Column, right: Column) -> Column:
    """Shared over all distinct kept hashes of two fingerprints."""
    either = F.size(F.array_union(left, right))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(left, right)) / either)


def spelled(hashes: Column) -> Column:
    """A fingerprint as text: nine hex digits for each kept hash, by place."""
    return F.lower(F.array_join(F.transform(hashes, lambda x: F.lpad(F.hex(x), 9, "0")), ""))


def fingerprints(docs: DataFrame, gram: int = GRAM, span: int = SPAN) -> DataFrame:
    """``doc_id``, the kept ``hashes`` and their ``places``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kept = docs.select("doc_id", entries(text, gram, span).alias("kept"))
    return kept.select("doc_id", hashes_of(F.col("kept")).alias("hashes"), places_of(F.col("kept")).alias("places"))


def with_next(rows: DataFrame, carried: list[str], key: str = "doc_id") -> DataFrame:
    """``rows`` with ``next``, a struct of ``carried`` of the row after in descending ``key``.

    After the last row comes the first. Keys are cut into as many ranges as there are
    shuffle partitions; a range is sorted on its own and ends with a copy of the row that
    the next range begins with, so nothing is ordered in one place.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.coalesce(F.col(key), F.lit(-(1 << 63))).cast("double").alias("_place")
    placed = rows.select(*rows.columns, place)
    inner = [i / parts for i in range(1, parts)]
    cuts = placed.approxQuantile("_place", inner, 1 / (4 * parts)) if inner else []
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    if cuts:
        ranged = Bucketizer(splits=splits, inputCol="_place", outputCol="_range").transform(placed)
    else:
        ranged = placed.withColumn("_range", F.lit(0.0))
    tops = ranged.groupBy("_range").agg(F.max("_place").alias("_place")).collect()  # a row for each range
    tops = sorted(((r["_range"], r["_place"]) for r in tops), reverse=True)
    if not tops:
        return rows.withColumn("next", F.struct(*carried))
    before = [(*top, tops[i - 1][0]) for i, top in enumerate(tops)]
    copies = spark.createDataFrame(before, "_range double, _place double, _into double")
    copied = ranged.join(F.broadcast(copies), ["_range", "_place"])
    copied = copied.drop("_range").withColumnRenamed("_into", "_range").withColumn("_copy", F.lit(True))
    both = ranged.withColumn("_copy", F.lit(False)).unionByName(copied)
    order = Window.partitionBy("_range").orderBy("_copy", F.desc_nulls_last(key), *carried)
    led = both.withColumn("next", F.lead(F.struct(*carried)).over(order)).where(~F.col("_copy"))
    return led.select(*rows.columns, "next")


def compared(docs: DataFrame, gram: int = GRAM, span: int = SPAN) -> DataFrame:
    """Each text's fingerprint beside its edited text's and the next document's.

    The edited text has its last third replaced by the beginning of the next document.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    rows = rows.withColumn("hashes", hashes_of(entries(F.col("text"), gram, span)))
    near = with_next(rows, ["text", "hashes"])
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.left("text", F.length("text") - third), F.left(F.col("next.text"), third))
    near = near.select("doc_id", "hashes", F.length("text").cast("long").alias("n_chars"), edited.alias("edited"), F.col("next.hashes").alias("next_hashes"))
    return near.select(
        "doc_id",
        "n_chars",
        "hashes",
        "next_hashes",
        F.sha2("edited", 256).alias("edited_sha256"),
        hashes_of(entries(F.col("edited"), gram, span)).alias("edited_hashes"),
    )
