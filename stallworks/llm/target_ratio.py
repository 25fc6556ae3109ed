"""Quality rules and a hashed n-gram likelihood ratio, in DataFrame functions alone.

Two multinomials over hashed word n-grams are counted: one over trusted target texts, one
over the whole raw corpus. A document's score is the mean log ratio of the two over its
n-grams, so its length does not matter, and every document is held against one threshold;
nothing is drawn at random. The table of ratios has ``BUCKETS`` entries, whatever the
corpus, and reaches the tasks as one array.

Counts are aggregated in the map tasks before they are shuffled, so a frequent n-gram, a
hot source or a group of copies is a few rows.

Defined results: null text counts as no words; a text without n-grams has score zero;
repeated rows count and are scored once each; a null doc_id is scored; empty tables give
no row; without target texts the ratios are all zero; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallworks.llm.common import let

BUCKETS = 1 << 14
SMOOTHING = 1.0
#: A document is kept from this mean log ratio on.
THRESHOLD = -0.1
#: White space between words, and a word's complement of it.
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 8


def words_of(text: Column) -> Column:
    """The words of a text; null gives none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP, -1), "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that occur twice or more, the first included.

    Window hashes are compared first; where none repeats, the answer is zero. Else they are
    sorted with their places, and a place counts if a neighbour of equal hash has the same
    words. Its words are covered up to the next such place or the window's end.
    """

    def places(w: Column, hashes: Column) -> Column:
        def again(rows: Column, x: Column, at: Column) -> Column:
            near = F.get(rows, at)
            same = F.slice(w, x["i"], F.lit(window)) == F.slice(w, near["i"], F.lit(window))
            return F.coalesce((x["h"] == near["h"]) & same, F.lit(False))

        rows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), (i + 1).alias("i"))))
        twice = let(rows, lambda r: F.filter(r, lambda x, k: again(r, x, k - 1) | again(r, x, k + 1)))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def counted(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - (window - 1))
        hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, F.lit(window))))
        return let(
            hashes,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
                _covered(places(w, h), window)
            ),
        )

    return let(words, lambda w: F.when(F.size(w) <= window, F.lit(0).cast("long")).otherwise(counted(w)))


def _covered(places: Column, window: int) -> Column:
    """Positions covered by windows that begin at ``places``, which ascend."""
    state = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("end"))
    return F.aggregate(
        places,
        state,
        lambda a, i: F.struct(
            (a["sum"] + F.lit(window) - F.greatest(a["end"] - i, F.lit(0))).cast("long").alias("sum"),
            (i + F.lit(window)).alias("end"),
        ),
        lambda a: a["sum"],
    )


def base_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, the four counts, the number of words, and the verdict on them."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("words", words_of(F.col("text")))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    joined = F.length(F.array_join("words", "")).cast("long")
    counted = rows.withColumn("lines", lines).select(
        "doc_id",
        "words",
        F.size("words").cast("long").alias("n_words"),
        joined.alias("word_chars"),
        F.length(F.regexp_replace("text", SYMBOLS, "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def buckets_of(words: Column, buckets: int = BUCKETS) -> Column:
    """The buckets of a text's single words and pairs of neighbours, in lower case."""

    def grams(hashes: Column) -> Column:
        single = F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
        pairs = F.transform(
            F.slice(hashes, F.lit(2), F.size(hashes) - 1),
            lambda h, i: F.pmod(F.xxhash64(F.get(hashes, i), h), F.lit(buckets)).cast("int"),
        )
        return F.when(F.size(hashes) > 1, F.concat(single, pairs)).otherwise(single)

    return let(F.transform(words, lambda w: F.xxhash64(F.lower(w))), grams)


def gram_counts(docs: DataFrame, targets: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, target, raw``: n-grams of the trusted texts and of all texts.

    ``targets`` has the ``doc_id`` of the trusted texts, however many there are; texts meet
    them by a sort-merge join, whatever the size.
    """
    own = targets.select("doc_id").distinct().withColumn("trusted", F.lit(1))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(own.hint("merge"), "doc_id", "left")
    gram = rows.select(
        F.explode(buckets_of(words_of(F.col("text")), buckets)).alias("bucket"),
        F.coalesce("trusted", F.lit(0)).alias("trusted"),
    )
    return gram.groupBy("bucket").agg(F.sum("trusted").alias("target"), F.count("*").alias("raw"))


def ratios(counts: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """For each bucket the smoothed log share in the targets over that in all texts."""
    target, raw = [0] * buckets, [0] * buckets
    for row in counts.collect():  # one row for each bucket at most
        target[row["bucket"]], raw[row["bucket"]] = row["target"], row["raw"]
    if not any(target):
        return [0.0] * buckets
    level = math.log((sum(raw) + SMOOTHING * buckets) / (sum(target) + SMOOTHING * buckets))
    return [level + math.log((t + SMOOTHING) / (r + SMOOTHING)) for t, r in zip(target, raw, strict=True)]


def score(docs: DataFrame, table: list[float], words: str = "words") -> DataFrame:
    """``docs`` with ``target_ratio``, the mean log ratio of its n-grams."""
    array = F.split(F.lit(",".join(map(repr, table))), ",").cast("array<double>")  # folded into a constant
    grams = buckets_of(F.col(words), len(table))
    total = F.aggregate(grams, F.lit(0.0), lambda sum_, g: sum_ + F.get(array, g))
    n = F.size(words) + F.greatest(F.size(words) - 1, F.lit(0))
    return docs.withColumn("target_ratio", F.when(n > 0, total / n).otherwise(0.0))
